"""Parquet landing and raw-table files.

Layouts
-------
* full load:  ``{base}/run_id=<UTC yyyyMMddHHmmss>/part-*.parquet`` (S9); the
  raw table is replaced from the newest complete run folder, all of its files (S12, Q7).
* daily load: ``{landing}/year=YYYY/month=MM/day=DD/part-*.parquet``, each day
  replaced by itself through dynamic partition overwrite (S10, S11).
* raw table:  ``{raw}/toll_day=YYYY-MM-DD/part-*.parquet``; loads overwrite only
  the dates they carry, so running a load twice equals running it once (Q6).

Rows without a date keep a folder of their own (the NULL partition) in every
layout.  The files' own schema is checked before a read: Spark would fill a
missing column with NULL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollflow.functions import columns as C
from tollflow.schema import RAW_FIELDS, RAW_SCHEMA, check_schema

DAILY_PARTS = ["year", "month", "day"]
RAW_PART = "toll_day"


# Date of a file's folder, as a regular expression with one group per date part.
RAW_DAY_IN_PATH = r"/toll_day=(\d{4}-\d{2}-\d{2})/"
LANDING_DAY_IN_PATH = r"/year=(\d{4})/month=(\d{2})/day=(\d{2})/"


# ---- folders ---------------------------------------------------------------
def _fs(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or any path of a glob pattern, exists."""
    fs, jpath = _fs(spark, pattern)
    return bool(fs.globStatus(jpath))


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names right under ``path``, from one listing."""
    fs, jpath = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(jpath)] if fs.exists(jpath) else []


def subfolders(spark: SparkSession, path: str, column: str) -> list[str]:
    """Partition values of ``column`` right under ``path``."""
    names = folder_names(spark, path)
    return [n.split("=", 1)[1] for n in names if n.startswith(column + "=")]


def drop_folders(spark: SparkSession, path: str, dates) -> None:
    """Delete the ``_day=`` folders of ``dates`` that exist: one listing, then one call per folder.

    A date whose new input yields no rows must not keep its old folder
    (dynamic overwrite replaces only the folders that it writes).
    """
    gone = {"__HIVE_DEFAULT_PARTITION__" if d is None else str(d)[:10] for d in dates}
    for value in set(subfolders(spark, path, "_day")) & gone:
        delete(spark, f"{path}/_day={value}")


FINGERPRINT = "day date, n_files long, n_bytes long, modified timestamp"


def listing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, modificationTime, length) of the Parquet files under ``paths``.

    The binary source lists the files; their content is not read, since the
    column that holds it is not used.
    """
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", "*.parquet").load(paths).select("path", "modificationTime", "length")


def _per_day(listed: DataFrame, day: Column) -> DataFrame:
    return listed.groupBy(day.alias("day")).agg(
        F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"),
        F.max("modificationTime").alias("modified"))


def fingerprint(spark: SparkSession, path: str, day_in_path: str, folders: list[str] | None = None) -> DataFrame:
    """(day, n_files, n_bytes, modified) per date folder, from file listings only.

    ``folders``: the folders below ``path`` to list; all of it otherwise.
    """
    at = [path] if folders is None else [f"{path.rstrip('/')}/{f}" for f in folders]
    at = [p for p in at if exists(spark, p)]
    if not at:
        return spark.createDataFrame([], FINGERPRINT)
    groups = day_in_path.count("(")
    text = F.concat_ws("-", *[F.regexp_extract("path", day_in_path, i + 1) for i in range(groups)])
    return _per_day(listing(spark, at), F.try_to_date(text, "yyyy-MM-dd"))


def changed_at(spark: SparkSession, path: str) -> dt.datetime | None:
    """Latest change of the files under ``path``."""
    return listing(spark, [path]).agg(F.max("modificationTime")).first()[0]


def mark() -> Column:
    """The fingerprint as one text."""
    return F.concat_ws("/", F.col("n_files").cast("string"), F.col("n_bytes").cast("string"),
                       F.unix_micros("modified").cast("string"))


def _checked(spark: SparkSession, path: str, what: str, extra: list[str] = ()) -> DataFrame:
    """Parquet under the declared schema, after checking the files' own schema."""
    check_schema(spark.read.parquet(path), RAW_SCHEMA, f"{what} at {path}")
    return spark.read.schema(_with_fields(RAW_SCHEMA, list(extra))).parquet(path)


def _with_fields(schema: T.StructType, names: list[str]) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(n, T.StringType()) for n in names])


# ---- full load -------------------------------------------------------------
def write_full(raw: DataFrame, base: str, run_id: str | None = None) -> str:
    """Write one full-history run folder (S9); returns the run id."""
    run_id = run_id or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S")
    raw.select(*RAW_FIELDS).write.mode("overwrite").parquet(f"{base}/run_id={run_id}")
    return run_id


def read_newest_run(spark: SparkSession, base: str) -> DataFrame:
    """All files of the newest run folder that was written to its end.

    A run without its ``_SUCCESS`` marker stopped while it was written; it is
    passed over, whatever its id.
    """
    return read_run(spark, newest_run(spark, base))


def newest_run(spark: SparkSession, base: str) -> str:
    """Folder of the newest complete run."""
    runs = [r for r in subfolders(spark, base, "run_id")
            if exists(spark, f"{base}/run_id={r}/_SUCCESS")]
    if not runs:
        raise FileNotFoundError(f"no complete run under {base}")
    return f"{base.rstrip('/')}/run_id={max(runs)}"


def read_run(spark: SparkSession, run: str) -> DataFrame:
    """All files of one full-load run folder."""
    return _checked(spark, run, "full load").select(*RAW_FIELDS)


# ---- daily landing -----------------------------------------------------------
def with_daily_parts(raw: DataFrame) -> DataFrame:
    d = F.to_date("toll_date")
    return raw.select(*RAW_FIELDS, F.date_format(d, "yyyy").alias("year"),
                      F.date_format(d, "MM").alias("month"), F.date_format(d, "dd").alias("day"))


def write_daily(raw: DataFrame, landing: str) -> None:
    """Each date present in ``raw`` replaces its own folder, others stay."""
    (with_daily_parts(raw).hint("rebalance", *DAILY_PARTS).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*DAILY_PARTS).parquet(landing))


def read_daily(spark: SparkSession, landing: str) -> DataFrame:
    """Daily landing with its zero-padded partition values kept as strings."""
    return _checked(spark, landing, "daily landing", DAILY_PARTS)


def daily_date(year="year", month="month", day="day"):
    """Date of a daily landing folder, from partition columns only (prunable)."""
    return F.to_date(F.concat_ws("-", C.as_col(year), C.as_col(month), C.as_col(day)))


def daily_folders(dates) -> Column:
    """Partition filter selecting the landing folders of ``dates`` (one per
    calendar day at most); None selects the rows without a date."""
    dates = list(dates)
    wanted = F.concat_ws("-", *DAILY_PARTS).isin(sorted({str(d)[:10] for d in dates if d is not None}))
    return wanted | F.col("year").isNull() if None in dates else wanted


# ---- raw table ---------------------------------------------------------------
def write_raw(records: DataFrame, raw_path: str) -> None:
    """Replace exactly the dates present in ``records`` in the raw table."""
    out = records.select(*RAW_FIELDS,
                         F.date_format(F.to_date("toll_date"), "yyyy-MM-dd").alias(RAW_PART))
    (out.hint("rebalance", RAW_PART).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(RAW_PART).parquet(raw_path))


def read_raw(spark: SparkSession, raw_path: str, dates=None, keep_day: bool = False) -> DataFrame:
    """The raw table; with ``dates``, only those date folders are listed and read.

    ``keep_day`` keeps the partition column, with which ``pages.day_filter`` and
    ``pages.range_filter`` prune folders.
    """
    df = _checked(spark, raw_path, "raw table", [RAW_PART])
    if dates is not None:
        dates = list(dates)
        day = F.col(RAW_PART)
        wanted = day.isin(sorted({str(d)[:10] for d in dates if d is not None}))
        df = df.where(wanted | day.isNull() if None in dates else wanted)
    return df.select(*RAW_FIELDS, *([RAW_PART] if keep_day else []))


def raw_statistics(spark: SparkSession, raw_path: str) -> DataFrame:
    """(toll_date, records, entries_known) per date, from folder names and file footers.

    The counts are pushed into the V2 Parquet reader, so no column of the raw
    table is read, and least and greatest dates follow from the folders.  (Least
    and greatest values cannot be pushed: the reader fails on a file that holds
    nothing but NULL.)  The two settings that this needs hold in a session of
    its own.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    df = own.read.schema(_with_fields(RAW_SCHEMA, [RAW_PART])).parquet(raw_path)
    return df.groupBy(RAW_PART).agg(
        F.count("*").alias("records"), F.count("crz_entries").alias("entries_known")) \
        .select(F.to_date(RAW_PART).alias("toll_date"), "records", "entries_known")


def replace_raw(records: DataFrame, raw_path: str) -> None:
    """Truncate-and-load of the raw table (full refresh)."""
    out = records.select(*RAW_FIELDS,
                         F.date_format(F.to_date("toll_date"), "yyyy-MM-dd").alias(RAW_PART))
    # Static overwrite: a full refresh drops every date, whatever the session default.
    (out.hint("rebalance", RAW_PART).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy(RAW_PART).parquet(raw_path))


# ---- files by the date in their name ---------------------------------------------
def source_files(df: DataFrame) -> DataFrame:
    """The files that a frame read from files comes from (file_path), each once."""
    return df.select(F.col("_metadata.file_path").alias("file_path")).distinct()


def file_dates(listed: DataFrame, path_col: str = "file_path") -> DataFrame:
    """(file_path, file_date) with the date parsed from the name; no match -> dropped."""
    return listed.select(path_col, C.date_from_file_name(path_col).alias("file_date")) \
        .where(F.col("file_date").isNotNull())


def named_fingerprint(spark: SparkSession, base: str) -> DataFrame:
    """(day, n_files, n_bytes, modified) of the files under ``base`` by the date in their name,
    from the listing only.  Files whose name holds no date are left out (S14)."""
    if not matches(spark, base):
        return spark.createDataFrame([], FINGERPRINT)
    listed = listing(spark, [base]).withColumn("_day", C.date_from_file_name("path"))
    return _per_day(listed.where("_day is not null"), F.col("_day"))


def read_named_days(spark: SparkSession, base: str, days) -> DataFrame:
    """Raw records of the files whose name carries one of ``days`` (S14, S15); the filter is on
    ``_metadata``, so files of other days, or without a date, are not opened."""
    wanted = [F.lit(str(d)[:10]).cast("date") for d in days]
    df = _checked(spark, base, "daily files")
    return df.where(C.date_from_file_name(F.col("_metadata.file_path")).isin(wanted))
