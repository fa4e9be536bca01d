"""Incremental control: watermark, backfill dates, new dates.

Only scalars (a watermark, a latest date) are involved, and they stay inside
the plan as scalar subqueries.  The load itself is ``plans.daily.run_daily``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollflow.operators import audits

DEFAULT_WATERMARK = "2025-01-01"   # fixed value: start when nothing is loaded yet


def max_date(df: DataFrame, col: str = "toll_date") -> Column:
    """Scalar subquery: latest date of ``df`` (NULL when empty)."""
    return df.agg(F.max(F.to_date(F.col(col)))).scalar()


def watermark(spark: SparkSession, raw: DataFrame, fact: DataFrame | None = None,
              default: str | None = DEFAULT_WATERMARK) -> DataFrame:
    """One row: greatest non-NULL of MAX(raw date) and MAX(fact date) (C1),
    with ``default`` when both are NULL (C2)."""
    parts = [max_date(raw)] + ([max_date(fact)] if fact is not None else [])
    wm = F.greatest(*parts) if len(parts) > 1 else parts[0]
    if default is not None:
        wm = F.coalesce(wm, F.lit(default).cast("date"))
    return spark.range(1).select(wm.alias("watermark"))


def backfill_dates(spark: SparkSession, processed: Column, available: Column) -> DataFrame:
    """Every date in (processed, available], none when processed >= available."""
    seq = F.when(processed < available,
                 F.sequence(F.date_add(processed, 1), available, F.expr("INTERVAL 1 DAY")))
    return spark.range(1).select(F.explode(seq).alias("toll_date"))


def nonempty_backfill(backfill: DataFrame, landing: DataFrame) -> DataFrame:
    """Backfill dates that have rows in the landing, with their row counts (C4)."""
    counts = audits.loaded_dates(landing)
    return backfill.join(counts, "toll_date", "inner")


def new_dates(landing: DataFrame, wm: Column) -> DataFrame:
    """Distinct landed dates after the watermark, ascending."""
    d = F.to_date("toll_date")
    keep = wm.isNull() | (d > wm)
    return landing.where(keep).select(d.alias("toll_date")).distinct().orderBy("toll_date")
