"""Dimensions: calendar (dim_time), locations (dim_locations), filters (dim_filters)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollflow.functions import columns as C


def date_bounds(frame: DataFrame, lo: str = "toll_date", hi: str = "toll_date") -> DataFrame:
    """One row (lo, hi): MIN and MAX of the date columns, NULLs skipped."""
    return frame.agg(F.min(lo).alias("lo"), F.max(hi).alias("hi"))


def dim_time(bounds: DataFrame) -> DataFrame:
    """Calendar: one row per day from lo to hi inclusive.

    ``bounds`` is the one-row (lo, hi) frame; an empty input yields NULL
    bounds and therefore zero days.
    """
    spine = bounds.select(C.date_spine("lo", "hi").alias("toll_date"))
    return spine.select(
        "toll_date",
        C.day_of_week_num("toll_date").alias("day_of_week_num"),
        C.day_of_week_name("toll_date").alias("day_of_week_name"),
        F.month("toll_date").alias("month"),
        F.quarter("toll_date").alias("quarter"),
        F.year("toll_date").alias("year"),
    )


def dim_locations(regions: DataFrame) -> DataFrame:
    """Distinct regions with borough, facility type and full name.

    A NULL region still yields one row (borough NULL, facility 'Other').
    """
    distinct = regions.select("detection_region").distinct()
    return distinct.select(
        "detection_region",
        C.borough_of("detection_region").alias("borough"),
        C.facility_type_of("detection_region").alias("facility_type"),
        F.col("detection_region").alias("full_name"),
    )


def time_periods(dim_t: DataFrame) -> DataFrame:
    """DISTINCT (month, day_of_week_name) of the calendar."""
    return dim_t.select("month", "day_of_week_name").distinct()


def staging_filter_rows(frame: DataFrame, *keep) -> DataFrame:
    """The ``keep`` columns with each of the four filter rows that a staging key offers.

    ``frame`` holds detection_region, vehicle_class and hour.  ``_key`` is the
    region for the borough and location rows, so a borough is kept once per
    region (the reference's bag, Q2), and NULL otherwise.
    """
    region = F.col("detection_region")
    borough = C.borough_of(region)

    def tag(kind, value, key):
        return F.struct(F.lit(kind).alias("filter_type"), value.alias("filter_value"),
                        value.alias("filter_display"), key.alias("_key"))

    none = F.lit(None).cast("string")
    keyed = frame.select(*keep, F.inline(F.array(
        tag("vehicle_class", F.col("vehicle_class"), none),
        tag("borough", borough, region),
        tag("location", region, region),
        tag("hour", C.to_text("hour"), none),
    )))
    return keyed.where((F.col("filter_type") != "borough") | F.col("filter_value").isNotNull())


def calendar_filter_rows(dim_t: DataFrame) -> DataFrame:
    """Month and weekday rows of each distinct (month, weekday) of the calendar."""
    return time_periods(dim_t).select(F.inline(F.array(
        F.struct(F.lit("month").alias("filter_type"), C.to_text("month").alias("filter_value"),
                 C.to_text("month").alias("filter_display")),
        F.struct(F.lit("day_of_week").alias("filter_type"),
                 F.col("day_of_week_name").alias("filter_value"),
                 F.col("day_of_week_name").alias("filter_display")),
    )))


def dim_filters(domain: DataFrame, dim_t: DataFrame, dedupe: bool = False) -> DataFrame:
    """Filter bridge rows (filter_type, filter_value, filter_display).

    Bag semantics as in the reference (Q2): a month appears once per weekday it
    has, a weekday once per month, a borough once per region; ``dedupe=True``
    gives a set instead.  Two aggregations instead of six DISTINCT branches: the
    four staging branches come from one explode of the ``domain`` rows and one
    DISTINCT, the two calendar branches from the distinct (month, weekday) pairs.
    """
    key_rows = staging_filter_rows(domain).distinct().drop("_key")
    out = key_rows.unionByName(calendar_filter_rows(dim_t))
    return out.distinct() if dedupe else out
