"""Dashboard reports over the fact (README's advertised views).

The reference computes these in an external BI tool, so the formulas here
are ours: plain sums, the exempt-ratio formula of the dashboard, and shares
of a grand total taken from a scalar subquery (no un-partitioned window and
no cross join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollflow.functions import columns as C


def total_entries_per_date(fact: DataFrame) -> DataFrame:
    return fact.groupBy("toll_date").agg(F.sum("entries").alias("total_entries"))


def vehicle_mix(fact: DataFrame) -> DataFrame:
    return fact.groupBy("vehicle_class").agg(
        F.sum("entries").alias("total_entries"),
        F.sum("excluded_entries").alias("total_excluded"))


def hour_profile(fact: DataFrame) -> DataFrame:
    """Entries per hour and a flag on the busiest hour(s)."""
    per_hour = fact.groupBy("hour").agg(F.sum("entries").alias("total_entries"))
    busiest = per_hour.agg(F.max("total_entries")).scalar()
    return per_hour.withColumn("is_busiest", F.col("total_entries") == busiest)


def entry_points(fact: DataFrame) -> DataFrame:
    """Entries per (group, region) and their percent of all entries."""
    per_point = fact.groupBy("detection_group", "detection_region").agg(
        F.sum("entries").alias("total_entries"))
    # Total of the per-point totals: the subquery reuses the same exchange,
    # so the fact is scanned once.
    grand = per_point.agg(F.sum("total_entries")).scalar()
    return per_point.withColumn("share_pct", C.percent_2dp("total_entries", grand))


def exempt_ratio_by_class(fact: DataFrame) -> DataFrame:
    sums = fact.groupBy("vehicle_class").agg(
        F.sum("entries").alias("total_entries"),
        F.sum("excluded_entries").alias("total_excluded"))
    return sums.withColumn("exempt_ratio", C.percent_2dp("total_excluded", "total_entries"))


def time_period_split(raw: DataFrame) -> DataFrame:
    """Peak vs off-peak from the raw time_period field."""
    return raw.groupBy("time_period").agg(
        F.sum("crz_entries").alias("total_entries"),
        F.sum("excluded_roadway_entries").alias("total_excluded"),
        F.count(F.lit(1)).alias("records"))
