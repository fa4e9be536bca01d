"""The model DAG as lazily built DataFrames.

``TrafficModels(raw)`` exposes every model of the reference as a property;
nothing runs until an action, and each property is built once per instance.

Two frames carry everything: staging, and its rollup to (date, hour, class,
region).  The fact and the KPI read staging; the dimensions, the daily and
hourly metrics and the dashboard read the rollup, whose exchange Spark reuses
within a plan, so a dashboard scans the raw records once.  Nothing is cached
and nothing is broadcast by hand: adaptive execution picks the joins from the
real sizes of the sides.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from tollflow.operators import dashboard as D
from tollflow.operators import dims, fact, kpi, staging


class TrafficModels:
    def __init__(self, raw: DataFrame | None, *, peak_scope: str = "date",
                 dedupe_filters: bool = False, join_dims: bool = False,
                 rollup: DataFrame | None = None):
        """``rollup``: a written staging rollup, used instead of a pass over ``raw``."""
        self.raw = raw
        self.spark = (raw if raw is not None else rollup).sparkSession
        self.peak_scope = peak_scope
        self.dedupe_filters = dedupe_filters
        self.join_dims = join_dims
        self._given_rollup = rollup

    # -- staging ------------------------------------------------------------
    @cached_property
    def stg_entries(self) -> DataFrame:
        return staging.stg_entries(self.raw)

    @cached_property
    def stg_interval(self) -> DataFrame:
        return staging.stg_interval(self.raw)

    @cached_property
    def rollup(self) -> DataFrame:
        if self._given_rollup is not None:
            return self._given_rollup
        return staging.rollup(self.stg_entries)

    @cached_property
    def domain(self) -> DataFrame:
        """(region, class, hour, min_date, max_date)."""
        return staging.domain(self.rollup)

    # -- dimensions ---------------------------------------------------------
    @cached_property
    def dim_time(self) -> DataFrame:
        return dims.dim_time(dims.date_bounds(self.domain, "min_date", "max_date"))

    @cached_property
    def dim_locations(self) -> DataFrame:
        return dims.dim_locations(self.domain)

    @cached_property
    def vehicle_classes(self) -> DataFrame:
        return staging.distinct_vehicle_classes(self.stg_entries)

    @cached_property
    def hours(self) -> DataFrame:
        return staging.distinct_hours(self.stg_entries)

    @cached_property
    def dim_filters(self) -> DataFrame:
        return dims.dim_filters(self.domain, self.dim_time, dedupe=self.dedupe_filters)

    # -- fact and marts -----------------------------------------------------
    @cached_property
    def fact_traffic(self) -> DataFrame:
        """Staging rows with calendar and location attributes.

        Default: the join-free form (``fact.fact_traffic_inline``), valid
        because both dimensions are built from this same staging frame.
        ``join_dims=True``: joins to the dimensions.
        """
        if self.join_dims:
            return fact.fact_traffic(self.stg_entries, self.dim_time, self.dim_locations)
        return fact.fact_traffic_inline(self.stg_entries)

    @cached_property
    def kpi_congestion(self) -> DataFrame:
        return kpi.kpi_congestion(self.fact_traffic)

    @cached_property
    def hourly_rollup(self) -> DataFrame:
        return D.hourly_rollup(self.rollup)

    @cached_property
    def hourly_metrics(self) -> DataFrame:
        return D.hourly_metrics(self.hourly_rollup)

    @cached_property
    def daily_metrics(self) -> DataFrame:
        return D.daily_metrics(self.hourly_rollup)

    @cached_property
    def peak_hours_ranked(self) -> DataFrame:
        return D.peak_hours_ranked(self.hourly_rollup, self.peak_scope)

    @cached_property
    def peak_hours_top1(self) -> DataFrame:
        return D.peak_hours_top1(self.hourly_rollup, self.peak_scope)

    @cached_property
    def final_metrics(self) -> DataFrame:
        peak = D.peak_hours_top1(self.hourly_rollup, self.peak_scope, share_rollup=True)
        return D.final_metrics(self.daily_metrics, peak)

    @cached_property
    def metrics_with_peak(self) -> DataFrame:
        """final_metrics computed in a single pass (production path)."""
        return D.daily_with_peak(D.hourly_all(self.rollup), self.peak_scope)

    @cached_property
    def dashboard_traffic(self) -> DataFrame:
        return D.dashboard_traffic(self.metrics_with_peak, self.dim_filters)

    @cached_property
    def day_of_week_matches(self) -> DataFrame:
        return D.day_of_week_matches(self.metrics_with_peak, self.dim_filters, self.dim_time)

    def tables(self) -> dict[str, DataFrame]:
        """Every materialized model of the reference, by name."""
        return {name: getattr(self, name) for name in (
            "stg_entries", "stg_interval", "dim_time", "dim_locations", "dim_filters",
            "fact_traffic", "kpi_congestion", "dashboard_traffic")}
