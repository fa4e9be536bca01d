"""Model semantics on hand-made rows: NULL paths, bags, ties, peak scope."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF_MID, SF_SMALL, bag, make_raw, raw_row
from tollflow.operators import dashboard as D
from tollflow.plans.models import TrafficModels
from tollflow.sources.fixture import load_raw


def test_fact_keeps_rows_with_equal_declared_key(spark):
    m = TrafficModels(make_raw(spark, [raw_row(), raw_row(), raw_row(group="G1")]))
    assert m.fact_traffic.count() == 3


def test_null_date_and_region_paths(spark):
    rows = [raw_row(), raw_row(day=None), raw_row(region=None), raw_row(vclass=None)]
    m = TrafficModels(make_raw(spark, rows))
    fact = m.fact_traffic
    assert fact.count() == 2                               # NULL date / region drop out
    assert fact.where(F.col("vehicle_class").isNull()).count() == 1
    locs = {r["detection_region"]: r for r in m.dim_locations.collect()}
    assert None in locs and locs[None]["facility_type"] == "Other" and locs[None]["borough"] is None
    filt = m.dim_filters.collect()
    loc_vals = [r["filter_value"] for r in filt if r["filter_type"] == "location"]
    assert None in loc_vals
    assert None not in [r["filter_value"] for r in filt if r["filter_type"] == "borough"]
    assert None in [r["filter_value"] for r in filt if r["filter_type"] == "vehicle_class"]


def test_dim_time_covers_gaps_and_is_unique(spark):
    rows = [raw_row(day="2025-01-30"), raw_row(day="2025-02-02")]
    t = TrafficModels(make_raw(spark, rows)).dim_time.orderBy("toll_date").collect()
    assert [r["toll_date"] for r in t] == [dt.date(2025, 1, 30), dt.date(2025, 1, 31),
                                           dt.date(2025, 2, 1), dt.date(2025, 2, 2)]
    assert [r["day_of_week_num"] for r in t] == [5, 6, 7, 1]
    assert t[-1]["day_of_week_name"] == "Sunday" and t[-1]["quarter"] == 1


def test_empty_input_gives_empty_models(spark):
    m = TrafficModels(make_raw(spark, []))
    for name in ("dim_time", "dim_locations", "fact_traffic", "kpi_congestion",
                 "dashboard_traffic"):
        assert getattr(m, name).count() == 0, name


def test_dim_filters_is_a_bag(spark):
    # Two months: January days 27..31 (Mon..Fri), February 1..2 (Sat, Sun).
    rows = [raw_row(day="2025-01-27"), raw_row(day="2025-02-02", region="Manhattan Bridge"),
            raw_row(day="2025-01-28", region="Manhattan CBD")]
    m = TrafficModels(make_raw(spark, rows))
    counts = {(r["filter_type"], r["filter_value"]): r["count"]
              for r in m.dim_filters.groupBy("filter_type", "filter_value").count().collect()}
    assert counts[("month", "1")] == 5 and counts[("month", "2")] == 2
    assert counts[("day_of_week", "Monday")] == 1
    assert counts[("borough", "Manhattan")] == 2           # one per region
    dedup = TrafficModels(make_raw(spark, rows), dedupe_filters=True).dim_filters
    assert dedup.count() == dedup.distinct().count() < m.dim_filters.count()


def test_peak_is_ranked_per_date_only(spark):
    rows = [raw_row(hour=8, entries=50), raw_row(hour=9, entries=70, region="Manhattan CBD"),
            raw_row(hour=10, entries=60)]
    final = TrafficModels(make_raw(spark, rows)).metrics_with_peak.collect()
    peaks = {r["detection_region"]: (r["peak_hour"], r["peak_hour_entries"]) for r in final}
    assert peaks == {"Manhattan CBD": (9, 70), "Brooklyn Bridge": (None, None)}
    grp = TrafficModels(make_raw(spark, rows), peak_scope="group").metrics_with_peak.collect()
    peaks = {r["detection_region"]: (r["peak_hour"], r["peak_hour_entries"]) for r in grp}
    assert peaks == {"Manhattan CBD": (9, 70), "Brooklyn Bridge": (10, 60)}


def test_peak_ties_break_on_hour_then_class_then_region(spark):
    rows = [raw_row(hour=11, entries=40), raw_row(hour=7, entries=40, region="Queens Gate"),
            raw_row(hour=7, entries=40, vclass="4 - Buses", region="Bronx Gate")]
    top = TrafficModels(make_raw(spark, rows)).peak_hours_top1.collect()
    assert [(r["hour"], r["vehicle_class"], r["detection_region"]) for r in top] == \
        [(7, "Buses", "Bronx Gate")]


def test_peak_with_null_class_is_not_attached(spark):
    rows = [raw_row(hour=8, entries=90, vclass=None), raw_row(hour=9, entries=10)]
    m = TrafficModels(make_raw(spark, rows))
    one_pass = bag(m.metrics_with_peak)
    joined = bag(D.final_metrics(m.daily_metrics, m.peak_hours_top1))
    assert one_pass == joined
    assert m.metrics_with_peak.where(F.col("peak_hour").isNotNull()).count() == 0


def test_single_pass_equals_left_join(spark):
    m = TrafficModels(load_raw(spark, SF_MID))
    assert bag(m.metrics_with_peak) == bag(D.final_metrics(m.daily_metrics, m.peak_hours_top1))
    g = TrafficModels(load_raw(spark, SF_MID), peak_scope="group")
    assert bag(g.metrics_with_peak) == bag(D.final_metrics(g.daily_metrics, g.peak_hours_top1))


def _theta_bruteforce(final_rows, filter_rows, day_name):
    """The reference's OR predicate evaluated pair by pair in Python."""
    out = []
    for f in final_rows:
        for d in filter_rows:
            t, v = d["filter_type"], d["filter_value"]
            hit = ((t == "vehicle_class" and v is not None and v == f["vehicle_class"])
                   or (t == "borough" and v is not None and v == f["borough"])
                   or (t == "location" and v is not None and v == f["detection_region"])
                   or (t == "month" and v is not None and v == str(f["toll_date"].month))
                   or (t == "day_of_week" and v is not None and day_name.get(f["toll_date"]) == v)
                   or (t == "hour" and v is not None and f["peak_hour"] is not None
                       and v == str(f["peak_hour"])))
            if hit:
                out.append({**f.asDict(), **d.asDict()})
    return out


def test_filter_bridge_equals_theta_form(spark):
    m = TrafficModels(load_raw(spark, SF_SMALL))
    final = m.metrics_with_peak.collect()
    filters = m.dim_filters.collect()
    names = {r["toll_date"]: r["day_of_week_name"] for r in m.dim_time.collect()}
    expect = _theta_bruteforce(final, filters, names)
    got = m.dashboard_traffic
    cols = sorted(got.columns)
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert sorted((tuple(r[c] for c in cols) for r in expect), key=key) == bag(got)
    assert len(expect) == 8385


def test_kpi_totals_equal_fact_totals(spark):
    m = TrafficModels(load_raw(spark, SF_MID))
    a = m.kpi_congestion.agg(F.sum("total_entries"), F.sum("total_excluded")).first()
    b = m.fact_traffic.agg(F.sum("entries"), F.sum("excluded_entries")).first()
    assert tuple(a) == tuple(b)


def test_fixture_counts(spark):
    m = TrafficModels(load_raw(spark, SF_SMALL))
    assert m.fact_traffic.count() == 1000
    assert m.dim_time.count() == 30 and m.dim_locations.count() == 8
    assert m.kpi_congestion.count() == 240 and m.dim_filters.count() == 60
    sev = {r["severity_level"]: r["count"] for r in
           m.kpi_congestion.groupBy("severity_level").count().collect()}
    assert sev == {"LOW": 108, "MODERATE": 85, "HIGH": 34, "SEVERE": 13}
    assert m.metrics_with_peak.count() == 742
    assert m.metrics_with_peak.where(F.col("peak_hour").isNotNull()).count() == 30


def test_join_free_fact_equals_joined_fact(spark):
    rows = [raw_row(), raw_row(day=None), raw_row(region=None), raw_row(vclass=None),
            raw_row(day="2025-03-01", region="Queens Midtown Tunnel"), raw_row(entries=None)]
    for raw in (make_raw(spark, rows), load_raw(spark, SF_MID)):
        inline = TrafficModels(raw).fact_traffic
        joined = TrafficModels(raw, join_dims=True).fact_traffic
        assert [(f.name, f.dataType) for f in inline.schema] == \
            [(f.name, f.dataType) for f in joined.schema]
        assert bag(inline) == bag(joined)


def test_filter_bag_by_hand(spark):
    """Two regions of one borough, a NULL region, two months: the bag counted by hand (Q2)."""
    rows = [raw_row(day="2025-01-30"), raw_row(day="2025-02-02", region="Brooklyn CBD", hour=23),
            raw_row(day=None, region=None, vclass=None)]
    want = sorted([("vehicle_class", "Cars, Pickups and Vans"), ("vehicle_class", None),
                   ("borough", "Brooklyn"), ("borough", "Brooklyn"), ("location", "Brooklyn Bridge"),
                   ("location", "Brooklyn CBD"), ("location", None), ("hour", "8"), ("hour", "23"),
                   ("hour", None), ("month", "1"), ("month", "1"), ("month", "2"), ("month", "2"),
                   ("day_of_week", "Thursday"), ("day_of_week", "Friday"),
                   ("day_of_week", "Saturday"), ("day_of_week", "Sunday")], key=str)
    got = TrafficModels(make_raw(spark, rows)).dim_filters.collect()
    assert sorted([(r["filter_type"], r["filter_value"]) for r in got], key=str) == want
    assert all(r["filter_display"] == r["filter_value"] for r in got)
    unique = TrafficModels(make_raw(spark, rows), dedupe_filters=True).dim_filters
    assert unique.count() == len(set(want))


def test_building_models_starts_no_job(spark):
    raw = load_raw(spark, SF_SMALL)
    spark.sparkContext.setJobGroup("build-only", "model building")
    try:
        m = TrafficModels(raw)
        frames = [*m.tables().values(), m.day_of_week_matches, m.final_metrics]
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("build-only") == []
        assert len(frames) == 10
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_a_region_landed_later_reaches_every_model(spark, tmp_path):
    """The same folder read again after another writer added to it: no model is stale."""
    from tollflow.sources import files
    path = str(tmp_path / "raw")
    files.write_raw(make_raw(spark, [raw_row(day="2025-02-01")]), path)
    TrafficModels(files.read_raw(spark, path)).dashboard_traffic.collect()
    files.write_raw(make_raw(spark, [raw_row(day="2025-02-02", region="Queens Gate")]), path)
    m = TrafficModels(files.read_raw(spark, path))
    assert {r[0] for r in m.dim_locations.select("detection_region").collect()} == {
        "Brooklyn Bridge", "Queens Gate"}
    kinds = {(r["filter_type"], r["filter_value"]) for r in m.dashboard_traffic.collect()}
    assert ("location", "Queens Gate") in kinds


def test_null_counts_and_zero_denominators(spark):
    rows = [raw_row(hour=8, entries=None, excluded=None),
            raw_row(hour=9, entries=None, excluded=None),
            raw_row(region="Manhattan CBD", entries=0, excluded=0),
            raw_row(region="Queens Gate", entries=23, excluded=40)]
    m = TrafficModels(make_raw(spark, rows))
    kpi = {r["detection_region"]: r for r in m.kpi_congestion.collect()}
    # KPI sums skip NULLs: all-NULL gives NULL, and severity falls back to LOW
    assert kpi["Brooklyn Bridge"]["total_entries"] is None
    assert kpi["Brooklyn Bridge"]["severity_level"] == "LOW"
    assert kpi["Manhattan CBD"]["entry_ratio"] is None          # 0 / NULLIF(0, 0)
    assert kpi["Queens Gate"]["entry_ratio"] == 0.58            # 23/40 = 0.575, half up
    daily = {r["detection_region"]: r for r in m.metrics_with_peak.collect()}
    # the dashboard coalesces NULL counts to 0 before summing
    assert daily["Brooklyn Bridge"]["total_entries"] == 0
    assert daily["Brooklyn Bridge"]["exempt_ratio"] is None     # 0 * 100 / NULLIF(0, 0)
    assert daily["Queens Gate"]["exempt_ratio"] == 173.91
    assert daily["Queens Gate"]["peak_hour"] == 8 and daily["Queens Gate"]["peak_hour_entries"] == 23
