"""The written marts (S18): one writer, one layout, for full builds and for single dates.

Under the marts folder:

* ``fact_traffic``, ``kpi_congestion``, ``_rollup``, ``_metrics``: one folder per
  date (``_day=``); rows without a date have a folder of their own;
* ``dashboard_traffic``: one folder per filter type and date (``_type=/_day=``);
* ``dim_time``, ``dim_locations``, ``dim_filters``: whole tables;
* ``_filter_counts``: reference counts from which a run makes these three;
* ``_build_record``: per date, which raw files it was built from (count, bytes,
  latest change), with which options, and how many rows went into the fact.

The record is appended last.  A date is pending when its raw files differ from
its record, so whatever stops a run -- or changes a date later -- the next run
finds the dates that are not finished, and rebuilds them as a whole.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollflow.operators import dashboard as D
from tollflow.operators import quality
from tollflow.operators.kpi import kpi_congestion
from tollflow.plans.filter_counts import FilterCounts
from tollflow.plans.models import TrafficModels
from tollflow.session import scratch_path
from tollflow.sources import files

TABLES = ("dim_time", "dim_locations", "dim_filters", "fact_traffic", "kpi_congestion",
          "dashboard_traffic")
PARTS = {"fact_traffic": ["_day"], "kpi_congestion": ["_day"], "_rollup": ["_day"],
         "_metrics": ["_day"], "dashboard_traffic": ["_type", "_day"]}
RECORD = "_build_record"
COUNTS = "_filter_counts"
VIOLATIONS = "_violations"
RECORD_SCHEMA = ("day date, n_files long, n_bytes long, modified timestamp, fact_rows long, "
                 "peak_scope string, dedupe_filters boolean, built_at timestamp")


class MixedOptionsError(RuntimeError):
    """The marts were built with other options; rebuild them in full to change options."""


class QualityError(RuntimeError):
    """A declared test found violations in the written marts."""


def path_of(marts: str, name: str) -> str:
    return f"{marts.rstrip('/')}/{name}"


def _in_days(dates: Iterable) -> Column:
    """Partition filter on ``_day``; None stands for the rows without a date."""
    day = F.col("_day").cast("string")
    listed = day.isin(sorted({str(d)[:10] for d in dates if d is not None}))
    return listed | day.isNull() if None in set(dates) else listed


def read_table(spark: SparkSession, marts: str, name: str, dates=None) -> DataFrame:
    """A written table; with ``dates`` only the folders of those dates are read."""
    df = spark.read.parquet(path_of(marts, name))
    if dates is not None:
        df = df.where(_in_days(dates))
    return df.drop("_day", "_type")


def write_table(df: DataFrame, marts: str, name: str, only_present: bool = False) -> None:
    """Write a mart in its layout: everything, or only the partitions present in ``df``."""
    parts = PARTS.get(name, [])
    if "_day" in parts:
        df = df.withColumn("_day", F.date_format("toll_date", "yyyy-MM-dd"))
    if "_type" in parts:
        df = df.withColumn("_type", F.col("filter_type"))
    if parts:
        df = df.hint("rebalance", *parts)
    # named on each write, whatever the session default is
    mode = "dynamic" if only_present else "static"
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", mode)
    (writer.partitionBy(*parts) if parts else writer).parquet(path_of(marts, name))


def register(spark: SparkSession, marts: str, database: str) -> None:
    """Put the written tables into a catalog schema as external tables."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.catalog.createTable(f"{database}.{name}", path=path_of(marts, name), source="parquet")
        if name in PARTS:
            spark.sql(f"MSCK REPAIR TABLE {database}.{name}")


def publish(spark: SparkSession, raw_path: str, root: str, database: str, peak_scope: str = "date",
            dedupe_filters: bool = False) -> str:
    """Build all marts in a fresh folder under ``root``, test them, and only then show them.

    Readers of ``database`` see views, each of which is replaced in one catalog
    call: a table's old rows or its new rows, never a part of either, and
    nothing that failed a declared test.  Returns the folder; earlier ones stay
    until ``drop_unpublished``, so queries that began before the switch end.
    """
    fresh = f"{root.rstrip('/')}/build-{uuid.uuid4().hex[:12]}"
    build(spark, raw_path, fresh, peak_scope, dedupe_filters)
    require_checks(spark, fresh)
    switch(spark, fresh, database)
    return fresh


def switch(spark: SparkSession, marts: str, database: str) -> None:
    """Let the views of ``database`` read the marts in ``marts``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in TABLES:
        columns = ", ".join(f"`{c}`" for c in read_table(spark, marts, name).columns)
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS "
                  f"SELECT {columns} FROM parquet.`{path_of(marts, name)}`")


def drop_unpublished(spark: SparkSession, root: str, keep: list[str]) -> None:
    """Delete the build folders under ``root`` that are not in ``keep``."""
    kept = {k.rstrip("/").rsplit("/", 1)[-1] for k in keep}
    for name in files.folder_names(spark, root):
        if name.startswith("build-") and name not in kept:
            files.delete(spark, f"{root.rstrip('/')}/{name}")


def staging_views(models: TrafficModels) -> None:
    """Staging as views, not tables."""
    models.stg_entries.createOrReplaceTempView("stg_entries")
    models.stg_interval.createOrReplaceTempView("stg_interval")


# ---- build record -------------------------------------------------------------------
def build_record(spark: SparkSession, marts: str) -> DataFrame:
    """The latest record of every date that was built."""
    path = path_of(marts, RECORD)
    if not files.exists(spark, path):
        return spark.createDataFrame([], RECORD_SCHEMA)
    rows = spark.read.schema(RECORD_SCHEMA).parquet(path)
    fields = [c for c in rows.columns if c != "day"]
    return rows.groupBy("day").agg(F.max_by(F.struct(*fields), "built_at").alias("r")) \
        .select("day", "r.*")


def pending_dates(spark: SparkSession, raw_path: str, marts: str) -> list[dt.date | None]:
    """Dates whose raw files differ from the record (new, changed, gone); at most one per day."""
    now = files.fingerprint(spark, raw_path, files.RAW_DAY_IN_PATH).alias("n")
    old = build_record(spark, marts).alias("o")
    same = all_equal("n.n_files", "o.n_files") & all_equal("n.n_bytes", "o.n_bytes") \
        & all_equal("n.modified", "o.modified")
    joined = now.withColumn("in_raw", F.lit(True)).alias("n").join(
        old.withColumn("in_record", F.lit(True)).alias("o"), F.col("n.day").eqNullSafe(F.col("o.day")), "full")
    gone = F.col("in_raw").isNull() & (F.col("o.n_files") > 0)
    changed = F.col("in_raw").isNotNull() & (F.col("in_record").isNull() | ~same)
    day = F.when(F.col("in_raw").isNotNull(), F.col("n.day")).otherwise(F.col("o.day"))
    return [r["day"] for r in joined.where(gone | changed).select(day.alias("day")).collect()]


def all_equal(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _append_record(spark: SparkSession, raw_files: DataFrame, marts: str, dates,
                   models: TrafficModels) -> None:
    """One record per date in ``dates`` (None: all dates in raw), from the listing taken before."""
    counts = read_table(spark, marts, "_rollup", dates).where(
        "toll_date is not null and detection_region is not null") \
        .groupBy(F.col("toll_date").alias("d")).agg(F.sum("records").alias("fact_rows"))
    listed = raw_files
    if dates is not None:
        wanted = spark.createDataFrame([(d,) for d in dates], "w date")
        listed = wanted.join(raw_files, F.col("w").eqNullSafe(F.col("day")), "left") \
            .drop("day").withColumnRenamed("w", "day")
    record = listed.join(counts, F.col("day") == F.col("d"), "left").select(
        "day", F.coalesce("n_files", F.lit(0)).cast("long").alias("n_files"),
        F.coalesce("n_bytes", F.lit(0)).cast("long").alias("n_bytes"), "modified",
        F.coalesce("fact_rows", F.lit(0)).cast("long").alias("fact_rows"),
        F.lit(models.peak_scope).alias("peak_scope"),
        F.lit(models.dedupe_filters).alias("dedupe_filters"),
        F.current_timestamp().alias("built_at"))
    record.coalesce(1).write.mode("append" if dates is not None else "overwrite").parquet(
        path_of(marts, RECORD))


def _listing(spark: SparkSession, raw_path: str) -> DataFrame:
    """The raw files per date as they are now, kept: files that come later make their date pending."""
    path = scratch_path(spark, "raw-listing")
    files.fingerprint(spark, raw_path, files.RAW_DAY_IN_PATH).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


# ---- building --------------------------------------------------------------------------
def build(spark: SparkSession, raw_path: str, marts: str, peak_scope: str = "date",
          dedupe_filters: bool = False) -> None:
    """Every mart from the whole raw table: one pass for the fact, one for the rollup."""
    listing = _listing(spark, raw_path)
    options = {"peak_scope": peak_scope, "dedupe_filters": dedupe_filters}
    m = TrafficModels(files.read_raw(spark, raw_path), **options)
    staging_views(m)
    write_table(m.fact_traffic, marts, "fact_traffic")
    write_table(m.rollup, marts, "_rollup")
    small = TrafficModels(None, rollup=read_table(spark, marts, "_rollup"), **options)
    write_table(kpi_congestion(read_table(spark, marts, "fact_traffic")), marts, "kpi_congestion")
    write_table(small.metrics_with_peak, marts, "_metrics")
    counts = FilterCounts(spark, path_of(marts, COUNTS))
    counts.apply(small.rollup, None)
    write_table(counts.dim_time(), marts, "dim_time")
    write_table(counts.dim_locations(), marts, "dim_locations")
    write_table(counts.dim_filters(dedupe_filters), marts, "dim_filters")
    write_table(D.dashboard_traffic(read_table(spark, marts, "_metrics"),
                                    read_table(spark, marts, "dim_filters")),
                marts, "dashboard_traffic")
    _append_record(spark, listing, marts, None, small)


def update(spark: SparkSession, raw_path: str, marts: str, dates: list, peak_scope: str = "date",
           dedupe_filters: bool = False) -> None:
    """Rebuild ``dates`` in every mart, as a full build would leave them.

    Tables that depend on one date are rewritten for these dates.  The
    dimensions depend on all dates; they come from reference counts, to which
    the dates' new rows are added and their old rows subtracted.  Of the
    dashboard's other dates only the filter types whose rows changed are rewritten.
    """
    listing = _listing(spark, raw_path)
    options = {"peak_scope": peak_scope, "dedupe_filters": dedupe_filters}
    m = TrafficModels(files.read_raw(spark, raw_path, dates=dates), **options)
    for name in ("fact_traffic", "kpi_congestion", "_rollup", "_metrics"):
        files.drop_folders(spark, path_of(marts, name), dates)
    write_table(m.fact_traffic, marts, "fact_traffic", only_present=True)
    write_table(m.rollup, marts, "_rollup", only_present=True)
    part = TrafficModels(None, rollup=read_table(spark, marts, "_rollup", dates), **options)
    write_table(kpi_congestion(read_table(spark, marts, "fact_traffic", dates)), marts,
                "kpi_congestion", only_present=True)
    write_table(part.metrics_with_peak, marts, "_metrics", only_present=True)

    counts = FilterCounts(spark, path_of(marts, COUNTS))
    if counts.kept:
        counts.apply(part.rollup, dates)
    else:                                       # marts that were built before the counts were kept
        counts.apply(read_table(spark, marts, "_rollup"), None)
    path = scratch_path(spark, "dim-filters")
    counts.dim_filters(dedupe_filters).coalesce(1).write.parquet(path)
    filters = spark.read.parquet(path)
    changed = _changed_types(read_table(spark, marts, "dim_filters"), filters)
    dashboard = path_of(marts, "dashboard_traffic")
    for kind in files.subfolders(spark, dashboard, "_type"):       # six at most
        if kind in changed:
            files.delete(spark, f"{dashboard}/_type={kind}")
        else:
            files.drop_folders(spark, f"{dashboard}/_type={kind}", dates)
    for days, kinds in ((dates, ~F.col("filter_type").isin(changed)),
                        (None, F.col("filter_type").isin(changed))):
        if days is None and not changed:
            continue
        write_table(D.dashboard_traffic(read_table(spark, marts, "_metrics", days),
                                        filters.where(kinds)),
                    marts, "dashboard_traffic", only_present=True)
    # calendar and locations are rewritten where they changed; the filter table last, so that a
    # run that stops before it finds the change again
    held = read_table(spark, marts, "dim_time").agg(F.min("toll_date"), F.max("toll_date")).first()
    if tuple(held) != counts.bounds():
        write_table(counts.dim_time(), marts, "dim_time")
    if "location" in changed:
        write_table(counts.dim_locations(), marts, "dim_locations")
    write_table(filters, marts, "dim_filters")
    _append_record(spark, listing, marts, dates, part)


def _changed_types(old: DataFrame, new: DataFrame) -> list[str]:
    """Filter types whose bags of rows differ (six types at most)."""
    def marks(df):
        return df.groupBy("filter_type").agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("filter_value", "filter_display").cast("decimal(38,0)")).alias("h"))
    a, b = marks(old).alias("a"), marks(new).alias("b")
    both = a.join(b, F.col("a.filter_type") == F.col("b.filter_type"), "full")
    differs = ~(F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.h").eqNullSafe(F.col("b.h")))
    return sorted(r[0] for r in both.where(differs).select(
        F.coalesce("a.filter_type", "b.filter_type")).collect())


def check_options(spark: SparkSession, marts: str, peak_scope: str, dedupe_filters: bool) -> None:
    other = build_record(spark, marts).where(
        ~(F.col("peak_scope").eqNullSafe(F.lit(peak_scope))
          & F.col("dedupe_filters").eqNullSafe(F.lit(dedupe_filters)))).first()
    if other is not None:
        raise MixedOptionsError(f"marts hold dates built with peak_scope={other['peak_scope']}, "
                                f"dedupe_filters={other['dedupe_filters']}")


# ---- test step ----------------------------------------------------------------------------
def checks(spark: SparkSession, marts: str) -> DataFrame:
    """One row per declared test, over the written tables, each read once."""
    return quality.all_checks({t: read_table(spark, marts, t) for t in TABLES},
                              staging_rollup=read_table(spark, marts, "_rollup"))


def require_checks(spark: SparkSession, marts: str) -> None:
    """Fail on any violation; the violating rows are left in ``_violations/<table>`` with their checks."""
    bad = [r.asDict() for r in checks(spark, marts).where("violations > 0").collect()]
    if bad:
        for table in sorted({r["table_name"] for r in bad if r["table_name"] in TABLES}):
            rows = quality.split(quality.tagged(table, read_table(spark, marts, table)))[1]
            rows.write.mode("overwrite").parquet(path_of(marts, f"{VIOLATIONS}/{table}"))
        raise QualityError("; ".join(f"{r['check_name']} {r['table_name']}.{r['column_name']}: "
                                     f"{r['violations']}" for r in bad))
