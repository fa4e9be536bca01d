"""Landed page files and source-side selection.

The source serves JSON pages ``{"value": [record, ...], "@odata.nextLink":
...}``.  Pages are landed as files (one page per line, or one per file);
reading them is a plain JSON scan under the declared envelope schema
followed by ``inline(value)``.  An empty page contributes no rows.
"""

from __future__ import annotations

import datetime as dt
import functools

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollflow.functions import columns as C
from tollflow.schema import PAGE_SCHEMA, RAW_FIELDS, RAW_SCHEMA
from tollflow.session import scratch_path
from tollflow.sources.files import RAW_PART

# Envelope with every record field as text: nothing fails while parsing, and
# each value is then cast with try_cast so bad values can be routed aside.
PAGE_TEXT_SCHEMA = T.StructType([
    T.StructField("value", T.ArrayType(T.StructType(
        [T.StructField(n, T.StringType()) for n in RAW_FIELDS]))),
    T.StructField("@odata.nextLink", T.StringType()),
])

# The history window of the full load (strict start, inclusive end).
HISTORY_START = "2025-01-01"
HISTORY_END = "2025-04-12"
BAD_PAGE = "page"          # failed_fields of a page that cannot be read at all
PAGE_FILE_RECORDS = 20_000  # records of a page file (about 11 MB as pretty-printed text)
# Separates pages where one file is one page, so it occurs in none: JSON has no raw control characters.
_NO_SEPARATOR = "\u001e-- no page holds this line --\u001e"
_CORRUPT = "_corrupt_record"


def read_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Raw records from landed pages under ``path`` (S1), explicit schema.

    ``multi_line=True`` reads one pretty-printed page per file; the default
    reads JSON Lines (one page per line), which also splits across tasks.  A
    page that does not parse, or whose ``value`` is missing, fails the read;
    only ``[]`` is an empty page.
    """
    pages = spark.read.schema(PAGE_SCHEMA).option("mode", "FAILFAST").json(
        path, multiLine=multi_line)
    value = F.coalesce("value", F.raise_error(F.lit("landed page without records")))
    return pages.select(F.inline(value.cast(PAGE_SCHEMA["value"].dataType))).select(*RAW_FIELDS)


def tagged_records(pages: DataFrame) -> DataFrame:
    """Page envelopes read as text -> one row per record, and one per unreadable page.

    Columns: the typed fields, file_path, source (the text), failed_fields ('' for
    a good record, ``BAD_PAGE`` for a page, else the fields that do not cast).
    """
    nothing = F.lit(None).cast(PAGE_TEXT_SCHEMA["value"].dataType.elementType)
    broken = F.col(_CORRUPT).isNotNull() | F.col("value").isNull()
    rows = pages.select(
        F.col("file_path"), broken.alias("broken"), F.col(_CORRUPT).alias("page_text"),
        F.explode(F.when(broken, F.array(nothing)).otherwise(F.col("value"))).alias("r"))
    fields = [F.col(f"r.{n}").try_cast(RAW_SCHEMA[n].dataType).alias(n) for n in RAW_FIELDS]
    failed = [F.when(F.col(f"r.{n}").isNotNull()
                     & F.col(f"r.{n}").try_cast(RAW_SCHEMA[n].dataType).isNull()
                     | ((F.lit(n) == "toll_date") & F.col(f"r.{n}").isNull()), F.lit(n))
              for n in RAW_FIELDS]
    return rows.select(
        *fields, "file_path", F.coalesce("page_text", F.to_json("r")).alias("source"),
        F.when(F.col("broken"), BAD_PAGE).otherwise(F.concat_ws(",", *failed)).alias("failed_fields"))


def text_envelopes(reader):
    """A JSON reader (batch or stream) set to keep what it cannot parse."""
    schema = T.StructType([*PAGE_TEXT_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    return reader.schema(schema).option("columnNameOfCorruptRecord", _CORRUPT)


def split_tagged(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of ``tagged_records``; rejects: toll_date, failed_fields, file_path, source."""
    return (tagged.where(F.col("failed_fields") == "").select(*RAW_FIELDS),
            tagged.where(F.col("failed_fields") != "").select(
                F.to_date("toll_date").alias("toll_date"), "failed_fields", "file_path", "source"))


def read_pages_checked(spark: SparkSession, path: str,
                       multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """Landed pages split into (records, rejects) instead of failing the read.

    A record is rejected when any present value does not cast to its declared
    type, or when it has no readable date; a page that does not parse or has no
    ``value`` is a reject of its own, without a date.  The pages are parsed once,
    into a typed table in the shared scratch folder that both frames read.

    With ``multi_line`` a file (UTF-8) is one page, taken as one record of the
    JSON Lines reader by a separator that no page holds.  Spark's ``multiLine``
    reader goes back to the file for the text of every number (about 9 KB each).
    """
    reader = text_envelopes(spark.read)
    if multi_line:
        reader = reader.option("lineSep", _NO_SEPARATOR)
    tagged = tagged_records(reader.json(path).withColumn("file_path", F.col("_metadata.file_path")))
    kept = scratch_path(spark, "page-records")
    tagged.write.parquet(kept)
    return split_tagged(spark.read.schema(tagged.schema).parquet(kept))


def split_healthy_days(records: DataFrame, rejects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keep the records of days without rejects; report every day (C4).

    Mirrors the per-day error handling of the daily fetch: a day with a bad
    record is skipped whole and reported, the other days load.  Returns
    (records of healthy days, per-day report with records, rejected, loaded).
    The bad days are one value per calendar day at most, so they become a filter.
    """
    day = F.to_date("toll_date")
    good = records.groupBy(day.alias("toll_date")).agg(F.count(F.lit(1)).alias("records"))
    bad = rejects.groupBy("toll_date").agg(F.count(F.lit(1)).alias("rejected"))
    report = good.join(bad, "toll_date", "full_outer").select(
        "toll_date", F.coalesce("records", F.lit(0)).alias("records"),
        F.coalesce("rejected", F.lit(0)).alias("rejected"),
        (F.coalesce("rejected", F.lit(0)) == 0).alias("loaded"))
    skipped = [r[0] for r in bad.where(F.col("toll_date").isNotNull()).select("toll_date").collect()]
    return records.where(~F.coalesce(day.isin(skipped), F.lit(False))), report


def land_pages(raw: DataFrame, path: str, page_rows: int = 1000) -> None:
    """Write records as page envelopes of at most ``page_rows`` rows each.

    Pages are cut within each input partition, from its Arrow batches: no
    shuffle, whatever the skew.  Each page links to the next one of its
    partition, the last has no link.
    """
    def cut(batches):
        part, number, waiting = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            for at in range(0, batch.num_rows, page_rows):
                if waiting is not None:
                    number += 1
                    yield page(waiting, f"page?part={part}&page={number}")
                waiting = batch.slice(at, page_rows)
        if waiting is not None:
            yield page(waiting, None)

    def page(batch, link):
        records = pa.StructArray.from_arrays(batch.columns, fields=list(batch.schema))
        value = pa.ListArray.from_arrays(pa.array([0, len(records)], pa.int32()), records)
        return pa.RecordBatch.from_arrays([value, pa.array([link], pa.string())],
                                          ["value", "@odata.nextLink"])

    raw.select(*RAW_FIELDS).mapInArrow(cut, PAGE_SCHEMA).write.mode("overwrite").json(path)


def deal_pages(raw: DataFrame, name: Column, page_records: int = PAGE_FILE_RECORDS) -> DataFrame:
    """``raw`` with page_name and page_part: a page's records in parts of about ``page_records``.

    A page grows with the records of its time, a part does not, and each part is a page
    file.  The first record of a page opens part 0, the others are dealt by a hash of
    their place in the input.  One row a page is broadcast, so few as there are names.
    """
    rows = raw.withColumn("page_name", name).withColumn("_id", F.monotonically_increasing_id())
    sizes = rows.groupBy(F.col("page_name").alias("_name")).agg(
        F.ceil(F.count(F.lit(1)) / page_records).alias("_parts"), F.min("_id").alias("_first"))
    part = F.when(F.col("_id") == F.col("_first"), F.lit(0).cast("long")) \
        .otherwise(F.pmod(F.xxhash64("_id"), "_parts"))
    return rows.join(F.broadcast(sizes), F.col("page_name").eqNullSafe(F.col("_name"))) \
        .select(*raw.columns, "page_name", part.alias("page_part"))


def land_page_files(pages: DataFrame, path: str) -> None:
    """Write page texts (columns page_name, text) as one file per page, as a source serves them."""
    pages.select("page_name", F.col("text").alias("value")).repartition("page_name") \
        .write.partitionBy("page_name").option("lineSep", "\n").text(path)


def select_fields(raw: DataFrame, fields: list[str] = RAW_FIELDS) -> DataFrame:
    """Source projection ($select) (S2); Parquet prunes the other columns."""
    return raw.select(*fields)


def _as_date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, (dt.date, dt.datetime)):
        d = d.isoformat()[:10]
    return F.lit(d).cast("date")


def _prune(raw: DataFrame, low=None, high=None) -> DataFrame:
    """Folder filter on the raw table's partition column, where the frame carries it."""
    if RAW_PART in raw.columns:
        for bound, keep in ((low, lambda b: F.col(RAW_PART) >= b), (high, lambda b: F.col(RAW_PART) <= b)):
            if bound is not None:
                raw = raw.where(keep(_as_date(bound).cast("string")))
        raw = raw.drop(RAW_PART)
    return raw


def range_filter(raw: DataFrame, start=HISTORY_START, end=HISTORY_END,
                 col: str = "toll_date") -> DataFrame:
    """toll_date > start (strict, Q9) and its date part <= end (S3).  On a frame from
    ``read_raw(keep_day=True)`` only the folders of those dates are read."""
    c = F.col(col)
    return _prune(raw, start, end).where(
        (c > _as_date(start).cast("timestamp_ntz")) & (F.to_date(c) <= _as_date(end)))


def day_filter(raw: DataFrame, day, col: str = "toll_date") -> DataFrame:
    """Rows of one calendar day (S4).  Written as a half-open timestamp range
    so that it reaches the Parquet scan as a pushed filter; on a frame from
    ``read_raw(keep_day=True)`` only that day's folder is read."""
    start = _as_date(day).cast("timestamp_ntz")
    end = F.date_add(_as_date(day), 1).cast("timestamp_ntz")
    c = F.col(col)
    return _prune(raw, day, day).where((c >= start) & (c < end))


def ordered(raw: DataFrame, keys=("toll_date", "toll_hour")) -> DataFrame:
    """Source order by (toll_date, toll_hour) (S5): a range-partitioned sort.

    Rows tied on the keys may come in any order, so the other columns are
    appended as tie-breakers: range partitioning cannot split equal keys, and
    without them one busy hour would land in a single partition.
    """
    return raw.orderBy(*_total_order(raw, keys))


def _total_order(df: DataFrame, keys) -> list[Column]:
    cols = list(keys) + [c for c in df.columns if c not in keys]
    return [F.col(c).asc_nulls_first() for c in cols]


def page_window(raw: DataFrame, skip: int, top: int,
                keys=("toll_date", "toll_hour")) -> DataFrame:
    """Rows skip .. skip+top-1 of the source order ($skip/$top, S6).

    The order is made total by appending every other column (Q10), so a page
    is well defined; fully equal rows are interchangeable.  One plan for all
    sizes: count the rows per key, add the counts up, keep only the groups that
    cover the window, and do the same within them for the next columns; only
    the rows of the few groups left are sorted.  Positions depend on counts
    alone, so lost tasks and any partitioning give the same rows.
    """
    rest = [c for c in raw.columns if c not in keys]
    cut = max(len(rest) - 2, 0)          # the last two columns (the counts) only order ties
    levels = [list(keys), rest[:cut]] if cut else [list(keys)]
    rows, done = raw.withColumn("_base", F.lit(0).cast("long")), []
    for level in levels:
        # _base: rows of the order before the group that the previous levels chose
        sizes = rows.groupBy(*done, *level, "_base").agg(F.count(F.lit(1)).alias("_n"))
        before = Window.partitionBy(*done, "_base").orderBy(*_total_order(sizes.select(*level), level)) \
            .rowsBetween(Window.unboundedPreceding, -1)
        sizes = sizes.withColumn("_start", F.col("_base") + F.coalesce(F.sum("_n").over(before), F.lit(0)))
        done += level
        cover = sizes.where((F.col("_start") < skip + top) & (F.col("_start") + F.col("_n") > skip)) \
            .select(*[F.col(c).alias("_k_" + c) for c in done], "_start")
        on = functools.reduce(lambda a, b: a & b,
                              [F.col(c).eqNullSafe(F.col("_k_" + c)) for c in done])
        rows = rows.drop("_base").join(cover, on).select(*raw.columns, F.col("_start").alias("_base"))
    left = [c for c in raw.columns if c not in done]
    inside = Window.partitionBy(*done, "_base").orderBy(*(_total_order(raw.select(*left), left)
                                                          if left else [F.lit(0)]))
    rank = F.col("_base") + F.row_number().over(inside) - 1
    return rows.withColumn("_rank", rank).where(
        (F.col("_rank") >= skip) & (F.col("_rank") < skip + top)).orderBy("_rank").select(*raw.columns)


# ---- pages one after the other -----------------------------------------------------
def _from_key(cols: list[str], key: dict) -> Column:
    """Rows at or after ``key`` in the total order (nulls first).

    The leading column's bound stands alone in front, so that it reaches the scan.
    """
    def after(c):
        return F.col(c).isNotNull() if key[c] is None else F.coalesce(F.col(c) > F.lit(key[c]), F.lit(False))

    def same(c):
        return F.col(c).isNull() if key[c] is None else F.coalesce(F.col(c) == F.lit(key[c]), F.lit(False))

    later = functools.reduce(lambda rest, c: after(c) | (same(c) & rest), reversed(cols), F.lit(True))
    return later if key[cols[0]] is None else (F.col(cols[0]) >= F.lit(key[cols[0]])) & later


def next_page(raw: DataFrame, top: int, token: dict | None = None,
              keys=("toll_date", "toll_hour")) -> tuple[DataFrame, dict | None]:
    """(page, token): the ``top`` rows of the source order that follow a page, and where they end.

    A token holds the last row's values and how many rows equal to it have been
    given out, so a page starts from a filter on the key instead of counting
    rows from the start, and equal rows are neither lost nor given twice.  The
    page is written to the shared scratch folder; token None: nothing follows.
    """
    cols = list(keys) + [c for c in raw.columns if c not in keys]
    order = _total_order(raw, keys)
    rest = raw if token is None else raw.where(_from_key(cols, token["key"]))
    path = scratch_path(raw.sparkSession, "page")
    rest.orderBy(*order).offset(token["given"] if token else 0).limit(top).write.parquet(path)
    page = raw.sparkSession.read.schema(raw.schema).parquet(path)
    back = [F.col(c).desc_nulls_last() for c in cols]
    last = page.groupBy(*[F.col(f"`{c}`") for c in raw.columns]).agg(F.count("*").alias("_n")) \
        .orderBy(*back).limit(1).collect()
    if not last:
        return page, None
    key = {c: last[0][c] for c in cols}
    given = last[0]["_n"] + (token["given"] if token and token["key"] == key else 0)
    return page, {"key": key, "given": given}


def walk_pages(raw: DataFrame, top: int, keys=("toll_date", "toll_hour")):
    """All pages of ``top`` rows in source order, each found from the end of the one before."""
    token = None
    while True:
        page, token = next_page(raw, top, token, keys)
        if token is None:
            return
        yield page


def latest_available(raw: DataFrame, col: str = "toll_date") -> DataFrame:
    """Latest date at the source (S7): one MAX, map-side partial aggregate."""
    return raw.agg(F.max(F.to_date(F.col(col))).alias("latest_date"))


def iso_dates(raw: DataFrame, col: str = "toll_date") -> DataFrame:
    """Source ISO text of each date and its parsed DATE."""
    text = C.iso_datetime_text(col)
    return raw.groupBy(text.alias("toll_date_text")).agg(F.count(F.lit(1)).alias("records")) \
        .select("toll_date_text", C.iso_to_date("toll_date_text").alias("toll_date"), "records")
