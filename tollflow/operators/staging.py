"""Staging: raw records -> cleaned rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollflow.functions import columns as C


def stg_entries(raw: DataFrame) -> DataFrame:
    """Date, hour, class without its code prefix, and the counts; one per raw row."""
    return raw.select(
        C.calendar_date("toll_date").alias("toll_date"),
        C.hour_of("toll_hour").alias("hour"),
        C.strip_class_code("vehicle_class").alias("vehicle_class"),
        "detection_group",
        "detection_region",
        "crz_entries",
        "excluded_roadway_entries",
    )


def stg_interval(raw: DataFrame) -> DataFrame:
    """Interval staging: raw class kept, hour taken from the *date* column (Q12)."""
    return raw.select(
        "toll_date",
        "vehicle_class",
        "detection_group",
        "detection_region",
        "crz_entries",
        "excluded_roadway_entries",
        C.hour_of("toll_date").alias("hour"),
    )


def distinct_vehicle_classes(stg: DataFrame) -> DataFrame:
    """SELECT DISTINCT vehicle_class (A9): partial + final hash aggregate."""
    return stg.select("vehicle_class").distinct()


def distinct_hours(stg: DataFrame) -> DataFrame:
    return stg.select("hour").distinct()


ROLLUP_KEYS = ["toll_date", "hour", "vehicle_class", "detection_region"]


def rollup(stg: DataFrame) -> DataFrame:
    """Staging summed to (date, hour, class, region), NULL keys kept.

    One pass and one shuffle of partial sums.  It holds all that the daily and
    hourly metrics, the dimensions and the staging checks need: ``records`` is
    the number of rows behind a group, and sums of NULLs only stay NULL.
    """
    return stg.groupBy(*ROLLUP_KEYS).agg(
        F.sum("crz_entries").alias("entries"),
        F.sum("excluded_roadway_entries").alias("excluded"),
        F.count(F.lit(1)).alias("records"))


def domain(rolled: DataFrame) -> DataFrame:
    """Distinct (region, class, hour) with their date range, from the rollup.

    The filter is always true.  It keeps the sums in use, so a plan that also
    reads them (the dashboard) has the very same rollup on both sides and
    Spark runs it once (ReusedExchange).
    """
    least = F.lit(-(1 << 63))
    same = (F.coalesce(F.col("entries") >= least, F.col("entries").isNull())
            & F.coalesce(F.col("excluded") >= least, F.col("excluded").isNull()))
    return rolled.where(same).groupBy("detection_region", "vehicle_class", "hour").agg(
        F.min("toll_date").alias("min_date"), F.max("toll_date").alias("max_date"))
