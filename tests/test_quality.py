"""Data-quality checks find seeded violations and pass clean data."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import make_raw, raw_row
from tollflow.operators import audits, quality
from tollflow.plans.models import TrafficModels


def _fact(spark, rows):
    return TrafficModels(make_raw(spark, rows)).fact_traffic


def test_seeded_violations_are_found(spark):
    future = (dt.date.today() + dt.timedelta(days=3)).isoformat()
    rows = [raw_row(), raw_row(vclass="9 - Hovercraft"), raw_row(entries=-1),
            raw_row(excluded=-5), raw_row(day=future), raw_row(vclass=None)]
    fact = _fact(spark, rows)
    assert quality.bad_vehicle_classes(fact).collect()[0]["vehicle_class"] == "Hovercraft"
    assert quality.negative_counts(fact).count() == 2
    assert quality.future_dates(fact).count() == 1
    # hour is derived from a timestamp in staging, so 24 / -1 are seeded on the fact itself
    bad = fact.withColumn("hour", F.when(F.col("entries") < 0, F.lit(24))
                          .when(F.col("excluded_entries") < 0, F.lit(-1)).otherwise(F.col("hour")))
    assert quality.bad_hours(bad).count() == 2
    v = quality.violation_count("x", quality.bad_hours(bad)).first()
    assert (v["check_name"], v["violations"]) == ("x", 2)


def test_null_class_passes_not_in_check(spark):
    fact = _fact(spark, [raw_row(vclass=None), raw_row()])
    assert quality.bad_vehicle_classes(fact).count() == 0


def test_not_null_summary_counts_per_column(spark):
    m = TrafficModels(make_raw(spark, [raw_row(), raw_row(vclass=None), raw_row(day=None)]))
    got = {(r["table_name"], r["column_name"]): r["violations"]
           for r in quality.not_null_summary(m.tables()).collect()}
    assert len(got) == 17
    assert got[("stg_entries", "toll_date")] == 1
    assert got[("stg_entries", "vehicle_class")] == 1
    assert got[("fact_traffic", "vehicle_class")] == 1
    assert got[("fact_traffic", "toll_date")] == 0


def test_unique_summary_detects_duplicates(spark):
    dup = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "detection_region string")
    days = spark.createDataFrame([(dt.date(2025, 1, 1),)], "toll_date date")
    got = {r["table_name"]: r["violations"] for r in quality.unique_summary(
        {"dim_locations": dup, "dim_time": days}).collect()}
    assert got == {"dim_locations": 1, "dim_time": 0}


def test_audits(spark):
    rows = [raw_row(day="2025-02-01")] * 3 + [raw_row(day="2025-02-03")]
    raw = make_raw(spark, rows)
    c = audits.completeness(raw).first()
    assert (c["total_records"], c["unique_dates"]) == (4, 2)
    assert (c["min_date"], c["max_date"]) == (dt.date(2025, 2, 1), dt.date(2025, 2, 3))
    g = audits.history_gate(TrafficModels(raw).fact_traffic, min_rows=5).first()
    assert g["record_count"] == 4 and g["passed"] is False
    empty = audits.completeness(make_raw(spark, [])).first()
    assert empty["total_records"] == 0 and empty["min_date"] is None
    per = {r["toll_date"]: r["records"] for r in audits.loaded_dates(raw).collect()}
    assert per == {dt.date(2025, 2, 1): 3, dt.date(2025, 2, 3): 1}


def test_all_checks_reports_seeded_violations(spark):
    future = (dt.date.today() + dt.timedelta(days=3)).isoformat()
    rows = [raw_row(), raw_row(vclass="9 - Hovercraft"), raw_row(entries=-1),
            raw_row(day=future), raw_row(vclass=None)]
    m = TrafficModels(make_raw(spark, rows))
    got = {(r["check_name"], r["table_name"], r["column_name"]): r["violations"]
           for r in quality.all_checks(m.tables()).collect()}
    assert len(got) == 23
    assert got[("vehicle_classes", "fact_traffic", None)] == 1
    assert got[("non_negative", "fact_traffic", None)] == 1
    assert got[("valid_dates", "fact_traffic", None)] == 1
    assert got[("not_null", "fact_traffic", "vehicle_class")] == 1
    assert got[("unique", "dim_time", "toll_date")] == 0


def test_violating_rows_carry_their_checks(spark):
    from tests.conftest import make_raw, raw_row
    from tollflow.operators import quality
    from tollflow.plans.models import TrafficModels
    rows = [raw_row(), raw_row(entries=-1, vclass=None), raw_row(vclass="9 - Sleds", excluded=-2),
            raw_row(day="2999-01-01", entries=None)]
    fact = TrafficModels(make_raw(spark, rows)).fact_traffic
    sound, bad = quality.split(quality.tagged("fact_traffic", fact))
    assert sound.columns == fact.columns and sound.count() == 1
    assert sorted(tuple(sorted(r["broken"])) for r in bad.collect()) == [
        ("non_negative", "not_null:vehicle_class"), ("non_negative", "vehicle_classes"),
        ("not_null:entries", "valid_dates")]
    plan = bad._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Scan") == 1


def test_repeated_keys_are_tagged_on_every_row(spark):
    from tollflow.operators import quality
    dim = spark.createDataFrame([("a", "x"), ("a", None), ("b", "y"), (None, "z"), (None, "z")],
                                "detection_region string, full_name string")
    got = sorted((str(r[0]), str(r[1]), r["broken"]) for r in quality.tagged("dim_locations", dim).collect())
    assert got == [("None", "z", ["not_null:detection_region"])] * 2 + [
        ("a", "None", ["not_null:full_name", "unique:detection_region"]),
        ("a", "x", ["unique:detection_region"]), ("b", "y", [])]
