"""fact_traffic: staging joined to the calendar and location dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollflow.functions import columns as C


def join_time(stg: DataFrame, dim_t: DataFrame) -> DataFrame:
    """Inner equi join on toll_date; rows with a NULL date drop out."""
    return stg.join(dim_t, "toll_date", "inner")


def join_location(stg: DataFrame, dim_l: DataFrame) -> DataFrame:
    """Inner equi join on detection_region; NULL regions drop out."""
    return stg.join(dim_l, "detection_region", "inner")


def fact_traffic(stg: DataFrame, dim_t: DataFrame, dim_l: DataFrame) -> DataFrame:
    """One row per staging row that survives both joins.

    The declared key (date, hour, class, region) is *not* unique (Q3): every
    row is kept.  Adaptive execution broadcasts the dimensions when their real
    sizes allow it.
    """
    t = dim_t.select("toll_date", "day_of_week_name", "month")
    l = dim_l.select("detection_region", "borough", F.col("full_name").alias("congestion_zone"))
    joined = stg.join(t, "toll_date", "inner").join(l, "detection_region", "inner")
    return joined.select(
        "toll_date",
        "hour",
        "vehicle_class",
        "detection_group",
        "detection_region",
        F.col("crz_entries").alias("entries"),
        F.col("excluded_roadway_entries").alias("excluded_entries"),
        "day_of_week_name",
        "month",
        "borough",
        "congestion_zone",
    )


def fact_traffic_inline(stg: DataFrame) -> DataFrame:
    """fact_traffic without the dimension joins, for dimensions built from ``stg``.

    When dim_time is the calendar from MIN to MAX of these same staging dates
    and dim_locations holds every distinct region of these same rows, the two
    inner joins keep exactly the rows whose date and region are not NULL, and
    every attribute they add is a pure function of the join key (day name and
    month of the date; borough of the region; the region as full name).  So
    the joins reduce to a filter plus a projection: one map-only pass, with
    no dimension to build or broadcast first.  ``TrafficModels(join_dims=True)``
    keeps the join form; the tests check both are equal.
    """
    keyed = stg.where(F.col("toll_date").isNotNull() & F.col("detection_region").isNotNull())
    return keyed.select(
        "toll_date",
        "hour",
        "vehicle_class",
        "detection_group",
        "detection_region",
        F.col("crz_entries").alias("entries"),
        F.col("excluded_roadway_entries").alias("excluded_entries"),
        C.day_of_week_name("toll_date").alias("day_of_week_name"),
        F.month("toll_date").alias("month"),
        C.borough_of("detection_region").alias("borough"),
        F.col("detection_region").alias("congestion_zone"),
    )
