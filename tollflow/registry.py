"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (``events`` mapped to raw toll
records) so its work grows with them.  Parameters such as date bounds are
scenario values shared with ``tollflow.oracle``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollflow import oracle as O
from tollflow.functions import columns as C
from tollflow.operators import audits, quality, reports
from tollflow.operators.dims import time_periods
from tollflow.operators.fact import join_location, join_time
from tollflow.plans import daily, marts
from tollflow.plans import incremental as inc
from tollflow.plans.filter_counts import FilterCounts
from tollflow.plans.models import TrafficModels
from tollflow.session import scratch_path
from tollflow.sources import files, pages
from tollflow.sources.fixture import load_raw, read_table
from tollflow.streaming import landing

Query = Callable[[SparkSession, str], DataFrame]


def models(spark: SparkSession, sf_dir: str, **options) -> TrafficModels:
    return TrafficModels(load_raw(spark, sf_dir), **options)


def _model(name: str, **options) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(models(spark, sf_dir, **options), name)
    run.__name__ = name
    return run


# ---- sources ------------------------------------------------------------------
def src_pages(spark, sf_dir):
    """Land the raw records as JSON pages in the shared scratch folder, read them back."""
    path = scratch_path(spark, "pages")
    pages.land_pages(load_raw(spark, sf_dir), path, page_rows=1000)
    return pages.read_pages(spark, path)


def src_select(spark, sf_dir):
    return pages.select_fields(load_raw(spark, sf_dir))


def src_range_filter(spark, sf_dir):
    return pages.range_filter(load_raw(spark, sf_dir), O.RANGE_START, O.RANGE_END)


def src_day_filter(spark, sf_dir):
    return pages.day_filter(load_raw(spark, sf_dir), O.ONE_DAY)


def src_ordered(spark, sf_dir):
    return pages.ordered(load_raw(spark, sf_dir))


def src_page_window(spark, sf_dir):
    return pages.page_window(load_raw(spark, sf_dir), O.PAGE_SKIP, O.PAGE_TOP)


def src_page_walk(spark, sf_dir):
    """Every record with the number of its page, pages being found one from the other."""
    raw = load_raw(spark, sf_dir)
    top = max(O.WALK_TOP, raw.count() // O.WALK_PAGES + 1)
    pages_ = [p.withColumn("page", F.lit(i)) for i, p in enumerate(pages.walk_pages(raw, top))]
    return functools.reduce(DataFrame.unionByName, pages_)


def src_latest_available(spark, sf_dir):
    return pages.latest_available(load_raw(spark, sf_dir))


def fn_iso_date(spark, sf_dir):
    return pages.iso_dates(load_raw(spark, sf_dir))


def fn_partition_path(spark, sf_dir):
    days = models(spark, sf_dir).stg_entries.select("toll_date").distinct()
    return days.select("toll_date", C.partition_path("toll_date").alias("partition_path"))


def fn_file_date(spark, sf_dir):
    """Files with the date in their name are written, listed by ``_metadata`` and parsed."""
    d = F.col("toll_date")
    days = models(spark, sf_dir).stg_entries.groupBy("toll_date").agg(F.count("*").alias("records"))
    name = F.concat(
        F.lit("year_"), F.date_format(d, "yyyy"), F.lit("_month_"), F.date_format(d, "MM"),
        F.lit("_day_"), F.date_format(d, "dd"), F.lit("_toll_entries_"),
        F.date_format(d, "yyyyMMdd"), F.lit(".parquet"))
    path = scratch_path(spark, "named-days")
    days.withColumn("file", name).write.partitionBy("file").parquet(path)
    listed = files.file_dates(files.source_files(spark.read.parquet(path)))
    return listed.select(
        F.concat(F.lit("landing/"), F.regexp_extract("file_path", r"/file=([^/]+)/", 1)).alias("file_path"),
        "file_date")


# ---- round trips through the written layouts -----------------------------------
def _pages_with_faults(raw):
    """Pages of one record each as text, some cut off and some with a bad count."""
    record = F.struct(*[(F.when(F.col("minute_of_hour") == O.BAD_COUNT_MINUTE, "lots")
                         .otherwise(F.col(n).cast("string")) if n == "crz_entries" else F.col(n)).alias(n)
                        for n in raw.columns])
    line = F.to_json(F.struct(F.array(record).alias("value")))
    cut = F.when(F.col("hour_of_day") == O.CUT_PAGE_HOUR, F.left(line, F.lit(60))).otherwise(line)
    return raw.select(cut.alias("value"))


def src_pages_rejects(spark, sf_dir):
    """What is read and what is rejected of pages with faults."""
    path = scratch_path(spark, "pages-rejects")
    _pages_with_faults(load_raw(spark, sf_dir)).write.text(path)
    records, rejects = pages.read_pages_checked(spark, path)
    good = records.select(F.to_date("toll_date").alias("toll_date"), F.lit("").alias("failed_fields"))
    return good.unionByName(rejects.select("toll_date", "failed_fields")) \
        .groupBy("toll_date", "failed_fields").agg(F.count("*").alias("records"))


def src_pages_multiline(spark, sf_dir, page_records=pages.PAGE_FILE_RECORDS):
    """One page a file, over many lines: what is read and rejected, with a cut page and an empty one.

    A page of many records is served in parts, a file each; nothing follows where the cut page ends.
    """
    raw = load_raw(spark, sf_dir)
    record = F.struct(*[(F.when(F.col("minute_of_hour") == O.BAD_COUNT_MINUTE, "lots")
                         .otherwise(F.col(n).cast("string")) if n == "crz_entries" else F.col(n)).alias(n)
                        for n in raw.columns])
    name = F.concat(F.date_format("toll_date", "yyyyMMdd"), F.lit("-"),
                    F.floor(F.col("hour_of_day") / O.PAGE_HOURS).cast("string"))
    page = pages.deal_pages(raw, name, page_records).groupBy("page_name", "page_part") \
        .agg(F.collect_list(record).alias("value"))
    text = F.to_json(F.struct("value"), {"pretty": "true"})
    is_cut = F.col("page_name").eqNullSafe(F.lit(O.CUT_PAGE_NAME))
    cut = F.when(is_cut, F.left(text, F.lit(500))).otherwise(text)
    file_name = F.concat(F.coalesce("page_name", F.lit("undated")), F.lit("-part"), F.col("page_part"))
    landed = page.where(~is_cut | (F.col("page_part") == 0)).select(file_name.alias("page_name"), cut.alias("text"))
    empty = spark.createDataFrame([("empty", '{\n  "value": []\n}')], "page_name string, text string")
    path = scratch_path(spark, "pages-multiline")
    pages.land_page_files(landed.unionByName(empty), path)
    records, rejects = pages.read_pages_checked(spark, path, multi_line=True)
    good = records.select(F.to_date("toll_date").alias("toll_date"), F.lit("").alias("failed_fields"))
    return good.unionByName(rejects.select("toll_date", "failed_fields")) \
        .groupBy("toll_date", "failed_fields").agg(F.count("*").alias("records"))


def load_resumed(spark, sf_dir):
    """Pages with faults, loaded by a stream that stops on its way, goes on, and is run once more."""
    path, out, ckpt = (scratch_path(spark, f"resumed-{n}") for n in ("pages", "out", "checkpoint"))
    _pages_with_faults(load_raw(spark, sf_dir)).repartition(6).write.text(path)
    try:
        landing.run_page_load(spark, path, out, ckpt, files_per_batch=2, stop_after=1)
    except landing.LoadStopped:
        pass
    for _ in range(2):
        landing.run_page_load(spark, path, out, ckpt, files_per_batch=2)
    return landing.read_page_records(spark, out)


def sink_full(spark, sf_dir):
    base = scratch_path(spark, "sink-full")
    files.write_full(load_raw(spark, sf_dir), base, run_id="20250101000000")
    return files.read_newest_run(spark, base)


def sink_daily(spark, sf_dir):
    landing = scratch_path(spark, "sink-daily")
    files.write_daily(load_raw(spark, sf_dir), landing)
    return files.read_daily(spark, landing)


def load_full(spark, sf_dir):
    base, raw_path = scratch_path(spark, "full-runs"), scratch_path(spark, "full-raw")
    raw = load_raw(spark, sf_dir)
    files.write_full(_loaded_part(raw), base, run_id="20250101000000")
    files.write_full(raw, base, run_id="20250102000000")
    daily.load_full(spark, base, raw_path)
    return files.read_raw(spark, raw_path)


def _daily_run(spark, sf_dir) -> tuple[str, str]:
    """Marts built over the loaded part, then one daily run over a landing with everything."""
    landed, raw_path, marts_path = (scratch_path(spark, f"daily-{n}") for n in ("landing", "raw", "marts"))
    raw = load_raw(spark, sf_dir)
    files.write_daily(raw, landed)
    files.write_raw(_loaded_part(raw), raw_path)
    daily.build_marts(spark, raw_path, marts_path)
    daily.run_daily(spark, landed, raw_path, marts_path)
    return raw_path, marts_path


def load_ledger(spark, sf_dir):
    """A full load, daily landings, a rejected day that lands late, and a late part of a loaded day."""
    full, feed, landed, raw_path = (scratch_path(spark, f"ledger-{n}") for n in ("full", "pages", "landing", "raw"))
    raw, day = load_raw(spark, sf_dir), F.to_date("toll_date")
    rejected = day == F.lit(O.REJECTED_DAY).cast("date")
    late = (day == F.lit(O.LATE_DAY).cast("date")) & (F.col("minute_of_hour") >= O.LATE_MINUTE)
    files.write_full(_loaded_part(raw).where(~rejected & ~late), full)
    daily.load_full(spark, full, raw_path)
    files.write_daily(raw.where(day > F.lit(O.LOADED_THROUGH).cast("date")), landed)
    bad = F.to_json(F.struct(F.array(F.struct(
        *[F.lit("lots").alias(n) if n == "crz_entries" else F.col(n) for n in raw.columns])).alias("value")))
    for record in (bad, F.to_json(F.struct(F.array(F.struct(*raw.columns)).alias("value")))):
        raw.where(rejected).select(record.alias("value")).write.mode("overwrite").text(feed)
        daily.land_daily_pages(spark, feed, landed)       # not landed the first time
        daily.load_landed(spark, landed, raw_path)
    files.write_daily(raw.where(late), landed)
    daily.load_landed(spark, landed, raw_path)
    return files.read_raw(spark, raw_path)


def load_named_files(spark, sf_dir):
    """Files of single days, and files without a date in their name, beside a full load of the first days."""
    full, base, raw_path = (scratch_path(spark, f"named-{n}") for n in ("full", "files", "raw"))
    raw, d = load_raw(spark, sf_dir), F.to_date("toll_date")
    files.write_full(_loaded_part(raw), full)
    name = F.concat(F.lit("day_"), F.date_format(d, "dd"), F.lit("_toll_entries_"), F.date_format(d, "yyyyMMdd"))
    new = raw.where(d > F.lit(O.LOADED_THROUGH).cast("date"))
    named = new.withColumn("file", name).unionByName(new.withColumn("file", F.lit("summary_toll_entries")))
    named.write.partitionBy("file").parquet(base)
    daily.load_full(spark, full, raw_path)
    for _ in range(2):                                    # the second finds nothing new
        daily.load_named_files(spark, base, raw_path)
    return files.read_raw(spark, raw_path)


def load_incremental(spark, sf_dir):
    return files.read_raw(spark, _daily_run(spark, sf_dir)[0])


def daily_run_dashboard(spark, sf_dir):
    return marts.read_table(spark, _daily_run(spark, sf_dir)[1], "dashboard_traffic")


# ---- incremental control ------------------------------------------------------
def _loaded_part(raw):
    return raw.where(F.to_date("toll_date") <= F.lit(O.LOADED_THROUGH).cast("date"))


def _loaded_state(spark, sf_dir):
    """Landing = every raw record; loaded = the part up to LOADED_THROUGH."""
    raw = load_raw(spark, sf_dir)
    loaded = _loaded_part(raw)
    fact = TrafficModels(loaded).fact_traffic
    return raw, loaded, fact


def inc_watermark(spark, sf_dir):
    raw, loaded, fact = _loaded_state(spark, sf_dir)
    return inc.watermark(spark, loaded, fact)


def _wm_col(spark, loaded, fact):
    return inc.watermark(spark, loaded, fact).scalar()


def inc_new_dates(spark, sf_dir):
    raw, loaded, fact = _loaded_state(spark, sf_dir)
    return inc.new_dates(raw, _wm_col(spark, loaded, fact))


def _backfill(spark, sf_dir):
    raw, loaded, fact = _loaded_state(spark, sf_dir)
    return raw, inc.backfill_dates(spark, _wm_col(spark, loaded, fact), inc.max_date(raw))


def inc_backfill_dates(spark, sf_dir):
    return _backfill(spark, sf_dir)[1]


def inc_backfill_nonempty(spark, sf_dir):
    raw, dates = _backfill(spark, sf_dir)
    return inc.nonempty_backfill(dates, raw)


# ---- audits -------------------------------------------------------------------
def audit_history_gate(spark, sf_dir):
    return audits.history_gate(models(spark, sf_dir).fact_traffic)


def audit_completeness(spark, sf_dir):
    return audits.completeness(load_raw(spark, sf_dir))


def audit_loaded_dates(spark, sf_dir):
    return audits.loaded_dates(load_raw(spark, sf_dir))


def _written_raw(spark, sf_dir, name):
    path = scratch_path(spark, name)
    files.write_raw(load_raw(spark, sf_dir), path)
    return path


def audit_statistics(spark, sf_dir):
    """Per date of the written raw table: rows and rows with a known count, from footers."""
    return files.raw_statistics(spark, _written_raw(spark, sf_dir, "statistics-raw"))


def audit_completeness_footers(spark, sf_dir):
    return audits.completeness_of(files.raw_statistics(spark, _written_raw(spark, sf_dir, "footers-raw")))


def audit_row_count(spark, sf_dir):
    return audits.row_count(load_raw(spark, sf_dir), "raw")


# ---- models -------------------------------------------------------------------
def join_inner_time(spark, sf_dir):
    m = models(spark, sf_dir)
    return join_time(m.stg_entries, m.dim_time)


def join_inner_location(spark, sf_dir):
    m = models(spark, sf_dir)
    return join_location(m.stg_entries, m.dim_locations)


def peak_hours_top1(spark, sf_dir):
    return models(spark, sf_dir).peak_hours_top1


def distinct_time_periods(spark, sf_dir):
    return time_periods(models(spark, sf_dir).dim_time)


def dim_filters_incremental(spark, sf_dir):
    """The filter table after dates came, changed and left, each step from its own dates alone."""
    path, day = scratch_path(spark, "filter-counts"), F.to_date("toll_date")
    raw = load_raw(spark, sf_dir)
    through, late = F.lit(O.LOADED_THROUGH).cast("date"), day == F.lit(O.LATE_DAY).cast("date")
    passing = raw.where(day == F.lit(O.ONE_DAY).cast("date")).withColumns({   # a day that leaves again
        c: F.col(c) + F.expr("INTERVAL 200 DAYS") for c in ("toll_date", "toll_hour")})
    passing = passing.withColumn("detection_region", F.lit("Closed Gate"))
    first = raw.where((day <= through) & (~late | (F.col("hour_of_day") < 12))).unionByName(passing)
    FilterCounts(spark, path).apply(TrafficModels(first).rollup, None)
    dates = [r[0] for r in raw.where(late | (day > through)).unionByName(passing)
             .select(day).distinct().collect()]                               # one per calendar day
    second = raw.where(late | (day > through))
    for _ in range(2):                                     # the second time changes nothing
        FilterCounts(spark, path).apply(TrafficModels(second).rollup, dates)
    return FilterCounts(spark, path).dim_filters()


# ---- data quality -------------------------------------------------------------
def dq_not_null(spark, sf_dir):
    return quality.not_null_summary(models(spark, sf_dir).tables())


def dq_unique(spark, sf_dir):
    return quality.unique_summary(models(spark, sf_dir).tables())


def dq_all(spark, sf_dir):
    return quality.all_checks(models(spark, sf_dir).tables())


def _seeded_fact(spark, sf_dir):
    """The fact with values broken by rule, so that every check has rows to find."""
    fact, n = models(spark, sf_dir).fact_traffic, F.col("entries")
    return fact.select(*[F.when(n % O.SEEDS[c][0] == O.SEEDS[c][1], F.expr(O.SEEDS[c][2])).otherwise(F.col(c))
                         .cast(t).alias(c) if c in O.SEEDS else F.col(c) for c, t in fact.dtypes])


def dq_violating_rows(spark, sf_dir):
    """The rows of the fact that violate a check, with the checks they violate."""
    rows = quality.split(quality.tagged("fact_traffic", _seeded_fact(spark, sf_dir)))[1]
    return rows.withColumn("broken", F.concat_ws(",", "broken"))


def dq_sound_rows(spark, sf_dir):
    """What the quarantine leaves of the fact."""
    return quality.split(quality.tagged("fact_traffic", _seeded_fact(spark, sf_dir)))[0]


def dq_violating_keys(spark, sf_dir):
    """Rows of the location dimension that violate a check: one region twice, one row without a region."""
    dim = models(spark, sf_dir).dim_locations
    more = dim.where(F.col("detection_region") == O.TWICE).unionByName(
        dim.where(F.col("detection_region") == O.TWICE).withColumn(
            "detection_region", F.lit(None).cast("string")))
    rows = quality.split(quality.tagged("dim_locations", dim.unionByName(more)))[1]
    return rows.withColumn("broken", F.concat_ws(",", "broken"))


def _dq(check: str, fn) -> Query:
    def run(spark, sf_dir):
        return quality.violation_count(check, fn(models(spark, sf_dir).fact_traffic))
    run.__name__ = f"dq_{check}"
    return run


# ---- column functions ---------------------------------------------------------
def fn_severity(spark, sf_dir):
    stg = models(spark, sf_dir).stg_entries
    return stg.select("toll_date", "detection_region", "crz_entries",
                      C.severity_level("crz_entries").alias("severity_level"))


def fn_categorize_vehicle(spark, sf_dir):
    raw = load_raw(spark, sf_dir)
    codes = raw.groupBy("vehicle_class", C.vehicle_code("vehicle_class").alias("vehicle_code")) \
        .agg(F.count(F.lit(1)).alias("records"))
    return codes.select("vehicle_class", "vehicle_code",
                        C.categorize_vehicle("vehicle_code").alias("vehicle_label"), "records")


def fn_get_borough(spark, sf_dir):
    stg = models(spark, sf_dir).stg_entries
    return stg.groupBy("detection_region").agg(F.count(F.lit(1)).alias("records")) \
        .select("detection_region", C.simple_borough("detection_region").alias("borough"), "records")


def fn_to_miles(spark, sf_dir):
    stg = models(spark, sf_dir).stg_entries
    return stg.select("toll_date", "detection_region", "crz_entries",
                      C.to_miles("crz_entries").alias("miles"))


def fn_to_dollars(spark, sf_dir):
    stg = models(spark, sf_dir).stg_entries
    return stg.select("toll_date", "detection_region", "excluded_roadway_entries",
                      C.to_dollars("excluded_roadway_entries").alias("dollars"))


def fn_ten_minute_block(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    return events.groupBy(C.ten_minute_block("ts").alias("block_start")) \
        .agg(F.count(F.lit(1)).alias("events"))


# ---- reports --------------------------------------------------------------------
def _report(fn) -> Query:
    def run(spark, sf_dir):
        return fn(models(spark, sf_dir).fact_traffic)
    run.__name__ = fn.__name__
    return run


def report_time_period(spark, sf_dir):
    return reports.time_period_split(load_raw(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "src_pages": src_pages,
    "src_select": src_select,
    "src_range_filter": src_range_filter,
    "src_day_filter": src_day_filter,
    "src_ordered": src_ordered,
    "src_page_window": src_page_window,
    "src_page_walk": src_page_walk,
    "src_latest_available": src_latest_available,
    "fn_iso_date": fn_iso_date,
    "fn_partition_path": fn_partition_path,
    "fn_file_date": fn_file_date,
    "src_pages_rejects": src_pages_rejects,
    "src_pages_multiline": src_pages_multiline,
    "sink_full": sink_full,
    "sink_daily": sink_daily,
    "load_full": load_full,
    "load_incremental": load_incremental,
    "daily_run_dashboard": daily_run_dashboard,
    "load_ledger": load_ledger,
    "load_named_files": load_named_files,
    "load_resumed": load_resumed,
    "inc_watermark": inc_watermark,
    "inc_new_dates": inc_new_dates,
    "inc_backfill_dates": inc_backfill_dates,
    "inc_backfill_nonempty": inc_backfill_nonempty,
    "audit_history_gate": audit_history_gate,
    "audit_completeness": audit_completeness,
    "audit_loaded_dates": audit_loaded_dates,
    "audit_row_count": audit_row_count,
    "audit_statistics": audit_statistics,
    "audit_completeness_footers": audit_completeness_footers,
    "stg_entries": _model("stg_entries"),
    "stg_interval": _model("stg_interval"),
    "dim_time": _model("dim_time"),
    "dim_locations": _model("dim_locations"),
    "dim_filters": _model("dim_filters"),
    "dim_filters_incremental": dim_filters_incremental,
    "fact_traffic": _model("fact_traffic"),
    "join_inner_time": join_inner_time,
    "join_inner_location": join_inner_location,
    "kpi_congestion": _model("kpi_congestion"),
    "daily_metrics": _model("daily_metrics"),
    "hourly_metrics": _model("hourly_metrics"),
    "peak_hours_ranked": _model("peak_hours_ranked"),
    "peak_hours_top1": peak_hours_top1,
    "peak_hours_by_group": _model("peak_hours_top1", peak_scope="group"),
    "join_left_peak": _model("final_metrics"),
    "join_exists_dow": _model("day_of_week_matches"),
    "dashboard_traffic": _model("dashboard_traffic"),
    "dashboard_dedup_filters": _model("dashboard_traffic", dedupe_filters=True),
    "distinct_vehicle_classes": _model("vehicle_classes"),
    "distinct_time_periods": distinct_time_periods,
    "dq_all": dq_all,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_violating_rows": dq_violating_rows,
    "dq_sound_rows": dq_sound_rows,
    "dq_violating_keys": dq_violating_keys,
    "dq_peak_hours": _dq("peak_hours", quality.bad_hours),
    "dq_vehicle_classes": _dq("vehicle_classes", quality.bad_vehicle_classes),
    "dq_non_negative": _dq("non_negative", quality.negative_counts),
    "dq_valid_dates": _dq("valid_dates", quality.future_dates),
    "fn_severity": fn_severity,
    "fn_categorize_vehicle": fn_categorize_vehicle,
    "fn_get_borough": fn_get_borough,
    "fn_to_miles": fn_to_miles,
    "fn_to_dollars": fn_to_dollars,
    "fn_ten_minute_block": fn_ten_minute_block,
    "report_total_entries": _report(reports.total_entries_per_date),
    "report_vehicle_mix": _report(reports.vehicle_mix),
    "report_hour_profile": _report(reports.hour_profile),
    "report_entry_points": _report(reports.entry_points),
    "report_exempt_ratio": _report(reports.exempt_ratio_by_class),
    "report_time_period": report_time_period,
}
