"""Line deduplication over levelled sorted runs of line hashes (DataFrame operations only).

A run is a table of (h1, h2, first): the 128-bit hash of a line key and the
smallest document that holds it, bucketed and sorted by the hash.  Batches of
documents arrive in doc_id order.  A batch reduces its lines to one row per
key, merge-anti-joins the existing runs, and adds what is left as a new run of
level 0.  When a level holds ``fanout`` runs they are compacted into one run of
the next level, so there are only logarithmically many runs to join, and every
key stands in exactly one of them.  Batches after the first never reread the
lines of earlier ones.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollflow.llm.common import (SPACE_CHARS, ascii_lower, packed, read_table, sha256_hex,
                                 stored, text_or_empty)
from tollflow.session import scratch_path

MIN_KEY = 10
BATCHES = 4
FANOUT = 2
NO_ID = 9223372036854775807   # place of rows without doc_id: after all others


class LineRuns:
    """Levelled sorted runs.  ``add`` takes (h1, h2, first) lines of one batch.

    ``buckets``: by default the session's shuffle width, so that the rows of an
    aggregate or a merge are already in their buckets and every bucket is one file.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.width = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.buckets = buckets or self.width
        self.levels: list[list[tuple[str, str]]] = []

    def _write(self, rows: DataFrame, dealt: bool) -> tuple[str, str]:
        """``dealt``: the rows come from a shuffle on the hash."""
        name, path = f"line_run_{uuid.uuid4().hex}", scratch_path(self.spark, "line-run")
        if not dealt or self.buckets != self.width:
            rows = rows.repartition(self.buckets, "h1", "h2")
        (rows.write.format("parquet")
         .bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", path)
         .saveAsTable(name))
        return name, path

    def _place(self, run: tuple[str, str], level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            merged = self._write(self._read(old), dealt=False)
            self._drop(old)
            self._place(merged, level + 1)

    def _read(self, runs: list[tuple[str, str]]) -> DataFrame:
        return self.spark.read.schema("h1 long, h2 long, first long").parquet(
            *[path for _, path in runs])

    def _drop(self, runs: list[tuple[str, str]]) -> None:
        for name, _ in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def add(self, lines: DataFrame) -> None:
        new = lines.groupBy("h1", "h2").agg(F.min("first").alias("first"))
        for name, _ in [run for level in self.levels for run in level]:
            new = new.join(self.spark.table(name).hint("merge"), ["h1", "h2"], "left_anti")
        self._place(self._write(new, dealt=True), 0)

    def index(self) -> DataFrame:
        """All keys once, with the smallest document of each."""
        return self._read([run for level in self.levels for run in level])

    def close(self) -> None:
        """Forget the run tables; their files stay in the scratch folder."""
        self._drop([run for level in self.levels for run in level])
        self.levels = []


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE_CHARS)))


def _text_hash(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("t"), text).alias("t2")]


def dropped_lines(docs: DataFrame, min_key: int = MIN_KEY, batches: int = BATCHES,
                  fanout: int = FANOUT, buckets: int | None = None) -> DataFrame:
    """(doc_id, t1, t2, mask): ASCII '0'/'1' per line up to the last dropped one."""
    spark = docs.sparkSession
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    cuts = docs.agg(F.percentile_approx(
        "doc_id", [i / batches for i in range(1, batches)], 1000)).first()[0] or []
    key = line_key(F.col("line"))
    lines = by_batch(
        docs.select("doc_id", *_text_hash(F.col("text")),
                    F.posexplode(F.split(text_or_empty(), "\n", -1)).alias("pos", "line"))
        .withColumn("key", key).where(F.char_length("key") >= min_key)
        .select("doc_id", "t1", "t2", "pos", place.alias("first"),
                F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("k"), "key").alias("h2"),
                sum([(place >= c).cast("int") for c in sorted(set(cuts))],
                    F.lit(0)).alias("batch")))
    runs = LineRuns(spark, fanout, buckets)
    try:
        for b in range(len(set(cuts)) + 1):
            runs.add(lines.where(F.col("batch") == b).select("h1", "h2", "first"))
        return _masks(lines, runs.index().withColumnRenamed("first", "home"))
    finally:
        runs.close()


def by_batch(lines: DataFrame) -> DataFrame:
    """The lines written in one folder per batch, so that a batch reads its own lines only."""
    path = scratch_path(lines.sparkSession, "line-hashes")
    lines.write.partitionBy("batch").parquet(path)
    return lines.sparkSession.read.schema(lines.schema).parquet(path)


def _masks(lines: DataFrame, index: DataFrame) -> DataFrame:
    """(doc_id, t1, t2, mask) of the documents that lose lines to the home of their key."""
    at = F.col("at")
    masks = lines.join(index, ["h1", "h2"]).where("first <> home") \
        .groupBy("doc_id", "t1", "t2").agg(F.sort_array(F.collect_set("pos")).alias("at")) \
        .select("doc_id", "t1", "t2", F.array_join(F.transform(at, lambda p, i: F.concat(
            F.repeat(F.lit("0"), p - F.coalesce(F.get(at, i - 1) + 1, F.lit(0))), F.lit("1"))), "")
            .alias("mask"))
    return stored(masks, "line-masks")


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """doc (the input row as a struct), n_lines, n_dropped, kept (the remaining text).

    Keys of at least ``min_key`` code points held by two or more documents keep
    their lines in the smallest doc_id only.  Rows with one doc_id are one
    document; rows without doc_id are one document after all others.  NULL or
    empty text is one empty line.  A document that loses all its lines is left
    with an empty text.  An empty table gives an empty result.
    """
    masks = dropped_lines(docs.select("doc_id", "text"), **options)
    h1, h2 = _text_hash(F.col("doc.text"))
    # a mask belongs to a doc_id and the 128-bit hash of its text
    found = packed(docs).withColumn("h1", h1).withColumn("h2", h2).join(
        masks, F.col("doc.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("h1") == F.col("t1"))
        & (F.col("h2") == F.col("t2")), "left") \
        .withColumn("lines", F.split(text_or_empty("doc.text"), "\n", -1)) \
        .withColumn("bits", F.col("mask").cast("binary"))
    keep = F.when(F.col("mask").isNull(), F.col("lines")).otherwise(F.filter(
        "lines", lambda line, i: F.substring(F.col("bits"), i + 1, F.lit(1)) != F.lit(b"1")))
    n_dropped = F.coalesce(F.char_length(F.replace("mask", F.lit("0"), F.lit(""))), F.lit(0))
    return found.select("doc", F.size("lines").cast("long").alias("n_lines"),
                        n_dropped.cast("long").alias("n_dropped"),
                        F.array_join(keep, "\n").alias("kept"))


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Digest of ``dedup_lines`` over all documents."""
    return dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc.doc_id", "n_lines", "n_dropped", sha256_hex(F.col("kept")).alias("kept_sha256"))


OP3_SQL = r"""
WITH lines AS (
  SELECT doc_id, u.pos, u.line,
         translate(trim(u.line, E' \t\n\x0B\x0C\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) d,
       LATERAL (SELECT unnest(ls) AS line, generate_subscripts(ls, 1) AS pos) u),
shared AS (
  SELECT key, min(doc_id) AS home FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT l.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE s.home <> l.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos)
                       FILTER (WHERE s.home IS NULL OR s.home = l.doc_id), '')) AS kept_sha256
FROM lines l LEFT JOIN shared s USING (key)
GROUP BY l.doc_id
"""
