"""The load ledger: which version of which day is in the raw table.

Every writer of the raw table -- full loads, the daily run, the landing stream,
loads of named files -- appends one record per day that it wrote.  What is to
be loaded is the listing of a landing folder minus what the ledger holds, not
what lies after a watermark: a day that lands late, or changes after it was
loaded, is found whatever its date, and so is a day whose load stopped before
its record.  The ledger stands beside the raw table, in ``<raw>_ledger``.

A day's record says where its rows came from:

* ``landing`` / ``files``: a whole folder of files, known by its mark (count,
  bytes, latest change).  Another mark: loaded again.
* ``full``: a full-load run, written at ``as_of``.  A landed folder that changed
  at that time or later is loaded.  Its files from that time on add to the
  run's rows of the day (``full_days="add"``, as late files do), or the folder
  is the whole day and takes their place (``full_days="replace"``).  Either way
  the day is written from its sources, so loading it twice changes nothing.
* ``found``: a raw table that is older than its ledger; ``as_of`` is the change
  time of the day's raw files.
* ``start``: nothing was loaded yet; days up to it are not wanted (C2).
* ``loading``: a full load began and did not end.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollflow.operators import audits
from tollflow.plans.incremental import DEFAULT_WATERMARK
from tollflow.schema import RAW_FIELDS
from tollflow.sources import files

SCHEMA = "source string, day date, mark string, run string, as_of timestamp, loaded_at timestamp"
NAMED, LANDING = "files", "landing"


class UnfinishedLoadError(RuntimeError):
    """A full load stopped while it replaced the raw table; it has to be run again."""


def path_of(raw_path: str) -> str:
    return raw_path.rstrip("/") + "_ledger"


def read(spark: SparkSession, raw_path: str) -> DataFrame:
    """The latest record of every day (and of ``start``, whose day is its bound)."""
    path = path_of(raw_path)
    if not files.exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(SCHEMA).parquet(path)
    start = F.col("source") == "start"
    fields = [c for c in rows.columns if c != "day"]
    return rows.groupBy("day", start.alias("_start")).agg(
        F.max_by(F.struct(*fields), "loaded_at").alias("r")).select("day", "r.*")


def _write(records: DataFrame, raw_path: str, mode: str) -> None:
    known = {f.split()[0]: f.split()[1] for f in SCHEMA.split(", ")}
    out = [(F.col(c) if c in records.columns else F.lit(None)).cast(t).alias(c)
           for c, t in known.items() if c != "loaded_at"]
    records.select(*out, F.current_timestamp().alias("loaded_at")).coalesce(1) \
        .write.mode(mode).parquet(path_of(raw_path))


def append(spark: SparkSession, raw_path: str, rows: list, source: str) -> None:
    """Records of days loaded from files; ``rows``: those of ``to_load`` (one per day)."""
    out = [(source, r["day"], r["mark"], r["run"], r["as_of"]) for r in rows]
    if out:
        _write(spark.createDataFrame(out, "source string, day date, mark string, run string, as_of timestamp"),
               raw_path, "append")


def _initialised(spark: SparkSession, raw_path: str, from_start: bool) -> None:
    """A ledger for a raw table that has none yet."""
    if files.exists(spark, path_of(raw_path)):
        return
    found = files.fingerprint(spark, raw_path, files.RAW_DAY_IN_PATH).select(
        F.lit("found").alias("source"), "day", F.col("modified").alias("as_of"))
    if from_start and found.isEmpty():
        found = spark.createDataFrame([("start", dt.date.fromisoformat(DEFAULT_WATERMARK))],
                                      "source string, day date")
    _write(found, raw_path, "overwrite")


# ---- what is to be loaded ------------------------------------------------------------
def to_load(spark: SparkSession, listed: DataFrame, raw_path: str, from_start: bool = True) -> list:
    """Rows (day, mark, run, as_of) of the listed days that raw lacks or holds in another version.

    ``listed``: ``files.fingerprint`` of the files on offer, one row per day, so
    at most one row per calendar day comes to the driver.  ``from_start``: a
    table without any rows begins after the default watermark.
    """
    _initialised(spark, raw_path, from_start)
    known = read(spark, raw_path)
    if not known.where(F.col("source") == "loading").isEmpty():
        raise UnfinishedLoadError(f"a full load into {raw_path} did not end; run it again")
    start = known.where(F.col("source") == "start").agg(F.max("day")).scalar()
    days = known.where(F.col("source") != "start").select(
        F.col("day").alias("_day"), F.lit(True).alias("known"), F.col("mark").alias("old_mark"),
        "run", "as_of")
    both = listed.withColumn("mark", files.mark()).join(days, F.col("day").eqNullSafe(F.col("_day")), "left")
    wanted = F.coalesce(F.col("day") > start, F.lit(True))
    changed = F.when(F.col("old_mark").isNotNull(), F.col("old_mark") != F.col("mark")).otherwise(
        F.coalesce(F.col("modified") >= F.col("as_of"), F.lit(True)))
    return both.where((F.col("known").isNull() & wanted) | (F.col("known") & changed)) \
        .select("day", "mark", "run", "as_of").orderBy("day").collect()


def as_rows(listed: DataFrame) -> list:
    """Listed days as rows of ``to_load``, without a look at the ledger (one per day)."""
    return listed.select("day", files.mark().alias("mark"), F.lit(None).cast("string").alias("run"),
                         F.lit(None).cast("timestamp").alias("as_of")).collect()


def _on(days) -> Column:
    """Records of the given dates (None: without a date), as a filter that reaches the scan."""
    day = F.to_date("toll_date")
    listed = F.coalesce(day.isin([d for d in days if d is not None]), F.lit(False))
    return listed | day.isNull() if None in days else listed


def with_run_rows(spark: SparkSession, batch: DataFrame, rows: list,
                  full_days: str = "add") -> tuple[DataFrame, DataFrame | None]:
    """(landed, kept): the rows to take from the files, and those of full-load runs that stay beside them.

    ``batch`` is read from the files themselves, so the change time of a row's file is at hand.
    """
    if full_days not in ("add", "replace"):
        raise ValueError(f"full_days must be 'add' or 'replace', not {full_days!r}")
    kept = None
    runs = {r["run"]: r["as_of"] for r in rows if r["run"]} if full_days == "add" else {}
    for run, as_of in sorted(runs.items()):
        days = [r["day"] for r in rows if r["run"] == run]
        batch = batch.where(~_on(days) | (F.col("_metadata.file_modification_time") >= F.lit(as_of)))
        part = files.read_run(spark, run).where(_on(days))
        kept = part if kept is None else kept.unionByName(part)
    return batch, kept


# ---- full loads --------------------------------------------------------------------------
def full_load_begins(spark: SparkSession, raw_path: str) -> None:
    _write(spark.createDataFrame([("loading",)], "source string"), raw_path, "overwrite")


def full_load_ended(spark: SparkSession, raw_path: str, run: str) -> None:
    """One record per day of the run, with the run's change time."""
    as_of = files.changed_at(spark, run)
    days = audits.loaded_dates(files.read_run(spark, run)).select(
        F.lit("full").alias("source"), F.col("toll_date").alias("day"), F.lit(run).alias("run"),
        F.lit(as_of).cast("timestamp").alias("as_of"))
    _write(days, raw_path, "overwrite")
