"""Corpus pipeline: quality classifier, line dedup, SimHash near-dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollflow.llm import bpe, line_dedup, mixing, quality_rank, simhash
from tollflow.llm.common import packed, stored, text_or_empty


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the accept threshold.  NULL and empty texts are scored too."""
    model = quality_rank.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality_rank.score(text_or_empty(), model) >= quality_rank.ACCEPT)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without the lines that an earlier document holds; n_chars follows."""
    kept, changed = line_dedup.dedup_lines(docs), F.col("n_dropped") > 0
    new = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return kept.select(*[
        F.when(changed, new[c]).otherwise(F.col(f"doc.`{c}`")).alias(c) if c in new
        else F.col(f"doc.`{c}`") for c in docs.columns])


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """doc, row: written once with a row number, so decisions find their rows whatever the ids are."""
    return stored(packed(docs).withColumn("row", F.monotonically_increasing_id()), name)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest doc_id, NULL last."""
    rows = _numbered(docs, "simhash-input")
    found = simhash.near_duplicates(rows.select("doc.doc_id", "doc.text", "row"), carry=("row",))
    first = found.groupBy("group").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("m"))
    return rows.join(first.select("m.row"), "row", "left_semi").select("doc.*")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those it does not take go."""
    rows = _numbered(docs, "mix-input")
    mixed = mixing.mix(rows.select("doc.doc_id", "doc.source", "doc.text",
                                   F.col("row").alias("input_row")), carry=("input_row",))
    taken = mixed.where("times > 0").select(F.col("input_row").alias("row"), "times")
    return rows.join(taken, "row") \
        .select("doc", F.explode(F.sequence(F.lit(1), F.col("times")))).select("doc.*")


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token digests of every remaining document."""
    return bpe.digests(bpe.encode_documents(docs.select("doc_id", "text"), bpe.default_vocabulary()))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("simhash near-dedup", simhash_near_dedup),
    ("source mixing", source_mixing),
    ("bpe encoding", bpe_encoding),
]

# the quality classifier is fitted, so SQL cannot express run(); tested against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
