"""dashboard_traffic: daily metrics, peak hour and the filter bridge.

Plan shape (SURVEY §4.3):

* one scan of the raw records, rolled up once to hourly grain (map-side partial
  sums, one shuffle); daily metrics, peaks and the filter table all come from
  that rollup, whose exchange Spark reuses;
* the peak hour is a top-1 per date.  The production path marks the rn = 1
  hourly row with a window partitioned by date and folds it into the daily
  aggregate: the window's date partitioning already satisfies the daily
  grouping, so there is no self-join of the hourly rollup.  ``final_metrics``
  keeps the reference's explicit left join (J3) for the standalone operator;
  there Catalyst turns rn = 1 into WindowGroupLimit around the exchange;
* the reference's cross join with six OR'ed predicates is replaced by an
  explode of six (filter_type, filter_value) pairs per metric row and an
  equi join with the filter table.  Each OR branch fixes its own
  filter_type, so at most one branch holds per pair; duplicates in the
  filter table keep their multiplicity and NULL values never match, exactly
  as in the OR form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollflow.functions import columns as C

DAILY_KEYS = ["toll_date", "vehicle_class", "detection_region", "borough", "location_name"]
HOURLY_KEYS = ["toll_date", "hour", "vehicle_class", "detection_region", "borough",
               "location_name"]
PEAK_JOIN_KEYS = ["toll_date", "vehicle_class", "detection_region"]
# Deterministic tie-breakers after hourly_entries DESC (Q4).
PEAK_TIE_BREAK = ["hour", "vehicle_class", "detection_region"]


def hourly_all(rolled: DataFrame) -> DataFrame:
    """Hourly grain of the staging rollup with the attributes of the fact (A3).

    ``in_fact`` is false for rows that the fact drops (NULL date or region).
    NULL counts are 0, as in the dashboard.
    """
    return rolled.select(
        "toll_date", "hour", "vehicle_class", "detection_region",
        C.borough_of("detection_region").alias("borough"),
        F.col("detection_region").alias("location_name"),
        F.coalesce("entries", F.lit(0)).alias("hourly_entries"),
        F.coalesce("excluded", F.lit(0)).alias("hourly_excluded"),
        (F.col("toll_date").isNotNull() & F.col("detection_region").isNotNull()).alias("in_fact"))


def hourly_rollup(rolled: DataFrame) -> DataFrame:
    """Entries and exempt entries per hour-grain group of the fact."""
    return hourly_all(rolled).where("in_fact").drop("in_fact")


def hourly_metrics(hourly: DataFrame) -> DataFrame:
    return hourly.select(*HOURLY_KEYS, "hourly_entries")


def daily_metrics(hourly: DataFrame) -> DataFrame:
    """Daily totals rolled up from the hourly grain."""
    sums = hourly.groupBy(*DAILY_KEYS).agg(
        F.sum("hourly_entries").alias("total_entries"),
        F.sum("hourly_excluded").alias("total_excluded"),
    )
    return sums.select(
        *DAILY_KEYS, "total_entries", "total_excluded",
        C.percent_2dp("total_excluded", "total_entries").alias("exempt_ratio"),
    )


def _peak_window(scope: str, share_rollup: bool = False, last=None) -> Window:
    if scope == "date":
        parts = ["toll_date"]
    elif scope == "group":
        parts = PEAK_JOIN_KEYS
    else:
        raise ValueError(f"peak_scope must be 'date' or 'group', not {scope!r}")
    order = ([last.asc()] if last is not None else []) + [
        F.col("hourly_entries").desc_nulls_last()] + [
        F.col(c).asc_nulls_first() for c in PEAK_TIE_BREAK]
    if share_rollup:
        # Never reached: (date, hour, class, region) is unique in the hourly
        # grain.  It keeps the exempt sum referenced, so a plan that also uses
        # the daily totals reads the same hourly aggregate on both sides and
        # Spark reuses its exchange (one fact scan instead of two).
        order.append(F.col("hourly_excluded").asc_nulls_first())
    return Window.partitionBy(*parts).orderBy(*order)


def peak_hours_ranked(hourly: DataFrame, scope: str = "date",
                      share_rollup: bool = False) -> DataFrame:
    """ROW_NUMBER over the hourly grain.

    ``scope='date'`` ranks within each date only, as the reference does (Q1):
    one (hour, class, region) per date gets rn = 1.  ``scope='group'`` ranks
    within (date, class, region), giving every daily row its own peak.
    """
    return hourly.select(
        "toll_date", "vehicle_class", "detection_region", "borough", "location_name",
        "hour", "hourly_entries",
        F.row_number().over(_peak_window(scope, share_rollup)).alias("rn"),
    )


def peak_hours_top1(hourly: DataFrame, scope: str = "date",
                    share_rollup: bool = False) -> DataFrame:
    """rn = 1 rows (W2), filtered *before* any join."""
    return peak_hours_ranked(hourly, scope, share_rollup).where(F.col("rn") == 1).drop("rn")


def daily_with_peak(hourly: DataFrame, scope: str = "date") -> DataFrame:
    """Daily metrics with the peak hour attached, in one pass over ``hourly_all``.

    Same result as ``final_metrics(daily_metrics(h), peak_hours_top1(h))`` over
    the rows in the fact: the rn = 1 row of a date carries its hour and entries
    into the daily group it belongs to; every other daily group gets NULL.  A
    peak row with a NULL class would not match in the left join, so it is not
    carried either.  Rows outside the fact rank last and leave after the
    aggregate: dropped before it, they would make the rollup below differ from
    the one that the dimensions read.
    """
    is_peak = F.row_number().over(_peak_window(scope, last=~F.col("in_fact"))) == 1
    marked = hourly.withColumn("_peak", is_peak & F.col("in_fact")
                               & F.col("vehicle_class").isNotNull())
    sums = marked.groupBy(*DAILY_KEYS).agg(
        F.sum("hourly_entries").alias("total_entries"),
        F.sum("hourly_excluded").alias("total_excluded"),
        F.max(F.when(F.col("_peak"), F.col("hour"))).alias("peak_hour"),
        F.max(F.when(F.col("_peak"), F.col("hourly_entries"))).alias("peak_hour_entries"),
        F.max("in_fact").alias("in_fact"),
    ).where("in_fact")
    return sums.select(
        *DAILY_KEYS, "total_entries", "total_excluded",
        C.percent_2dp("total_excluded", "total_entries").alias("exempt_ratio"),
        "peak_hour", "peak_hour_entries")


def final_metrics(daily: DataFrame, peak_top1: DataFrame) -> DataFrame:
    """Daily rows with the peak hour attached by a 3-key left join.

    With the date scope the right side has one row per date.
    """
    ph = peak_top1.select(*PEAK_JOIN_KEYS, F.col("hour").alias("peak_hour"),
                          F.col("hourly_entries").alias("peak_hour_entries"))
    return daily.join(ph, PEAK_JOIN_KEYS, "left").select(
        *DAILY_KEYS, "total_entries", "total_excluded", "exempt_ratio",
        "peak_hour", "peak_hour_entries")


def filter_keys(final: DataFrame) -> DataFrame:
    """Each metric row with its six (filter_type, filter_value) candidates."""
    pairs = F.array(
        F.struct(F.lit("vehicle_class").alias("filter_type"),
                 F.col("vehicle_class").alias("filter_value")),
        F.struct(F.lit("borough").alias("filter_type"), F.col("borough").alias("filter_value")),
        F.struct(F.lit("location").alias("filter_type"),
                 F.col("detection_region").alias("filter_value")),
        F.struct(F.lit("month").alias("filter_type"),
                 C.to_text(F.month("toll_date")).alias("filter_value")),
        # EXISTS over dim_time on (date, day name): dim_time holds every date
        # of the fact exactly once, so it is the day name of toll_date.
        F.struct(F.lit("day_of_week").alias("filter_type"),
                 C.day_of_week_name("toll_date").alias("filter_value")),
        F.struct(F.lit("hour").alias("filter_type"),
                 C.to_text("peak_hour").alias("filter_value")),
    )
    return final.select("*", F.inline(pairs))


def dashboard_traffic(final: DataFrame, filters: DataFrame) -> DataFrame:
    """Metric rows times matching filter rows, by equi join."""
    keyed = filter_keys(final)
    return keyed.join(filters, ["filter_type", "filter_value"], "inner").select(
        *DAILY_KEYS, "total_entries", "total_excluded", "exempt_ratio",
        "peak_hour", "peak_hour_entries", "filter_type", "filter_value", "filter_display")


def day_of_week_matches(final: DataFrame, filters: DataFrame, dim_t: DataFrame) -> DataFrame:
    """The day_of_week branch alone, with the EXISTS kept as a join.

    EXISTS (SELECT 1 FROM dim_time t WHERE t.toll_date = f.toll_date AND
    t.day_of_week_name = df.filter_value) is rewritten as: filter rows joined
    to the calendar days carrying their name (one row per (filter row, day)
    since dim_time is unique on the date), then joined to the metric rows on
    the date.  No pair of metric row and filter row is ever enumerated.
    """
    dow = filters.where(F.col("filter_type") == "day_of_week")
    days = dim_t.select("toll_date", F.col("day_of_week_name").alias("filter_value"))
    dated = dow.join(days, "filter_value", "inner")
    return final.join(dated, "toll_date", "inner").select(
        *DAILY_KEYS, "total_entries", "total_excluded", "exempt_ratio",
        "peak_hour", "peak_hour_entries", "filter_type", "filter_value", "filter_display")
