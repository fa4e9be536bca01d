"""Helpers shared by the training-data operators.

Words everywhere are runs of characters other than ``[\\x20\\x09-\\x0D]``.
All scratch tables go under the folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollflow.session import scratch_path

SPACE_CHARS = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a fresh shared scratch folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame) -> DataFrame:
    """One struct column ``doc`` holding the whole row, so no helper column can clash with it."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character unchanged.

    ``lower`` is the fast form and equal for pure ASCII; other strings go
    through ``translate``.
    """
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, LOWER))


def finite_vector(name: str = "embedding") -> Column:
    """The vector as doubles; NULL where it is NULL, empty or holds a NULL or non-finite component."""
    value = F.col(name).cast("array<double>")
    whole = (F.size(value) > 0) & F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(F.coalesce(whole, F.lit(False)), value)


def hash_share(*columns: str) -> Column:
    """A number in [0, 1) that depends on the columns only, for samples that reruns repeat."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 53)) / float(1 << 53)


def sha256_hex(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def any_of(conditions) -> Column:
    return functools.reduce(lambda a, b: a | b, conditions)
