"""Load audits: history gate, completeness, per-date counts, row count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_HISTORY_ROWS = 100   # fixed value: the history gate's threshold


def history_gate(fact: DataFrame, min_rows: int = MIN_HISTORY_ROWS) -> DataFrame:
    """record_count, min_date, max_date and whether the count reaches min_rows."""
    return fact.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min("toll_date").alias("min_date"),
        F.max("toll_date").alias("max_date"),
    ).withColumn("passed", F.col("record_count") >= F.lit(min_rows))


def completeness(records: DataFrame, date_col: str = "toll_date") -> DataFrame:
    """total_records, unique_dates, min_date, max_date; empty input gives 0 and NULLs."""
    d = F.to_date(F.col(date_col))
    return records.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct(d).alias("unique_dates"),
        F.min(d).alias("min_date"),
        F.max(d).alias("max_date"),
    )


def loaded_dates(records: DataFrame, date_col: str = "toll_date") -> DataFrame:
    """(toll_date, records) per date."""
    return records.groupBy(F.to_date(F.col(date_col)).alias("toll_date")).agg(
        F.count(F.lit(1)).alias("records"))


def row_count(df: DataFrame, table: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(table).alias("table_name"), "row_count")


def completeness_of(counts: DataFrame) -> DataFrame:
    """``completeness`` from per-date counts (toll_date, records), such as ``files.raw_statistics``."""
    return counts.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"),
        F.count("toll_date").alias("unique_dates"),
        F.min("toll_date").alias("min_date"), F.max("toll_date").alias("max_date"))
