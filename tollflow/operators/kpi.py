"""kpi_congestion: totals, entry ratio and severity per (date, region, borough)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollflow.functions import columns as C

KPI_KEYS = ["toll_date", "detection_region", "borough"]


def kpi_congestion(fact: DataFrame) -> DataFrame:
    """One shuffle on the three keys after map-side partial sums."""
    sums = fact.groupBy(*KPI_KEYS).agg(
        F.sum("entries").alias("total_entries"),
        F.sum("excluded_entries").alias("total_excluded"),
    )
    return sums.select(
        *KPI_KEYS,
        "total_entries",
        "total_excluded",
        C.ratio_2dp("total_entries", "total_excluded").alias("entry_ratio"),
        C.severity_level("total_entries").alias("severity_level"),
    )
