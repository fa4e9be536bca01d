"""Entry points A and B end to end on temporary folders: every run ends with complete marts."""

import datetime as dt
import json

import pytest

from tests.conftest import SF_SMALL, bag, make_raw, raw_row
from tollflow.plans import daily, marts
from tollflow.plans.models import TrafficModels
from tollflow.sources import files, pages
from tollflow.sources.fixture import load_raw
from tollflow.streaming.landing import run_landing_load


@pytest.fixture
def at(tmp_path):
    return {n: str(tmp_path / n) for n in ("landing", "raw", "marts", "full", "ckpt", "pages", "hist")}


@pytest.fixture(scope="module")
def everything(spark):
    return load_raw(spark, SF_SMALL)


def first_days(everything):
    return everything.where("toll_date <= timestamp_ntz'2024-01-20'")


def start(spark, at, everything):
    """A landing with every day, and marts over the days up to the 20th."""
    files.write_daily(everything, at["landing"])
    files.write_raw(first_days(everything), at["raw"])
    daily.build_marts(spark, at["raw"], at["marts"])


def complete(spark, at, want):
    """Every written mart equals the models over ``want``, and a further run changes nothing."""
    m = TrafficModels(want)
    for name in marts.TABLES:
        assert bag(marts.read_table(spark, at["marts"], name)) == bag(getattr(m, name)), name
    assert bag(files.read_raw(spark, at["raw"])) == bag(want)
    before = marts.build_record(spark, at["marts"]).agg({"built_at": "max"}).first()[0]
    assert daily.run_daily(spark, at["landing"], at["raw"], at["marts"], require_history=False).count() == 0
    assert marts.build_record(spark, at["marts"]).agg({"built_at": "max"}).first()[0] == before


def test_daily_run_catches_up_and_is_idempotent(spark, at, everything):
    start(spark, at, everything)
    report = daily.run_daily(spark, at["landing"], at["raw"], at["marts"])
    assert sorted(r["toll_date"] for r in report.collect()) == [dt.date(2024, 1, d) for d in range(21, 31)]
    complete(spark, at, everything)


def test_run_that_stops_after_the_raw_load_heals(spark, at, everything, monkeypatch):
    """No new day lands afterwards."""
    start(spark, at, everything)
    with monkeypatch.context() as p:
        p.setattr(marts, "update", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            daily.run_daily(spark, at["landing"], at["raw"], at["marts"])
    assert daily.run_daily(spark, at["landing"], at["raw"], at["marts"]).count() == 0
    complete(spark, at, everything)


@pytest.mark.parametrize("stop_at", ["kpi_congestion", "dashboard_traffic", "dim_filters"])
def test_run_that_stops_between_two_marts_heals(spark, at, everything, monkeypatch, stop_at):
    """More days land before the next run."""
    files.write_daily(everything.where("toll_date <= timestamp_ntz'2024-01-25'"), at["landing"])
    files.write_raw(first_days(everything), at["raw"])
    daily.build_marts(spark, at["raw"], at["marts"])
    write = marts.write_table

    def stopping(df, path, name, **k):
        if name == stop_at:
            raise RuntimeError("lost")
        write(df, path, name, **k)
    with monkeypatch.context() as p:
        p.setattr(marts, "write_table", stopping)
        with pytest.raises(RuntimeError, match="lost"):
            daily.run_daily(spark, at["landing"], at["raw"], at["marts"])
    files.write_daily(everything.where("toll_date > timestamp_ntz'2024-01-25'"), at["landing"])
    daily.run_daily(spark, at["landing"], at["raw"], at["marts"])
    complete(spark, at, everything)


def late_file(spark, at, day, rows):
    y, m, d = day.split("-")
    files.with_daily_parts(make_raw(spark, rows)).drop("year", "month", "day").write.mode("append") \
        .parquet(f"{at['landing']}/year={y}/month={m}/day={d}")


def test_late_file_reaches_every_mart(spark, at, everything):
    """X6, through the daily run and through the landing stream; with a new region."""
    start(spark, at, everything)
    daily.run_daily(spark, at["landing"], at["raw"], at["marts"])
    late = [raw_row(day="2024-01-22", entries=7, region="Queens Gate")]
    late_file(spark, at, "2024-01-22", late)
    report = daily.run_daily(spark, at["landing"], at["raw"], at["marts"])
    assert [r["toll_date"] for r in report.collect()] == [dt.date(2024, 1, 22)]
    complete(spark, at, everything.unionByName(make_raw(spark, late)))

    more = [raw_row(day="2024-01-03", entries=9)]
    late_file(spark, at, "2024-01-03", more)
    run_landing_load(spark, at["landing"], at["raw"], at["ckpt"])
    daily.run_daily(spark, at["landing"], at["raw"], at["marts"])
    want = everything.unionByName(make_raw(spark, late + more))
    for name in marts.TABLES:
        assert bag(marts.read_table(spark, at["marts"], name)) == bag(getattr(TrafficModels(want), name)), name


def test_rows_without_a_date_are_loaded_and_found_by_the_tests(spark, at):
    """Kept in raw, out of the fact, and reported by not_null on staging."""
    files.write_raw(make_raw(spark, [raw_row(day="2025-02-01")] * 3), at["raw"])
    daily.build_marts(spark, at["raw"], at["marts"])
    files.write_daily(make_raw(spark, [raw_row(day="2025-02-02"), raw_row(day=None)]), at["landing"])
    with pytest.raises(marts.QualityError, match="not_null stg_entries.toll_date: 1"):
        daily.run_daily(spark, at["landing"], at["raw"], at["marts"], require_history=False)
    assert files.read_raw(spark, at["raw"]).count() == 5
    assert marts.read_table(spark, at["marts"], "fact_traffic").count() == 4
    assert marts.pending_dates(spark, at["raw"], at["marts"]) == []


def test_date_that_leaves_raw_leaves_the_marts(spark, at):
    files.write_raw(make_raw(spark, [raw_row(day="2025-02-01"), raw_row(day="2025-02-02", hour=5)]), at["raw"])
    daily.build_marts(spark, at["raw"], at["marts"])
    files.replace_raw(make_raw(spark, [raw_row(day="2025-02-01")]), at["raw"])
    files.write_daily(make_raw(spark, [raw_row(day="2025-02-01")]), at["landing"])
    assert dt.date(2025, 2, 2) in marts.pending_dates(spark, at["raw"], at["marts"])
    daily.run_daily(spark, at["landing"], at["raw"], at["marts"], require_history=False)
    complete(spark, at, make_raw(spark, [raw_row(day="2025-02-01")]))


def test_rebuilt_date_without_fact_rows_leaves_no_stale_folder(spark, at):
    files.write_raw(make_raw(spark, [raw_row(day="2025-02-01"), raw_row(day="2025-02-02")]), at["raw"])
    daily.build_marts(spark, at["raw"], at["marts"])
    files.write_raw(make_raw(spark, [raw_row(day="2025-02-02", region=None)]), at["raw"])
    marts.update(spark, at["raw"], at["marts"], marts.pending_dates(spark, at["raw"], at["marts"]))
    for name in ("fact_traffic", "kpi_congestion", "dashboard_traffic"):
        days = {r["toll_date"] for r in marts.read_table(spark, at["marts"], name).collect()}
        assert days == {dt.date(2025, 2, 1)}, name


def test_other_options_are_refused(spark, at, everything):
    """Marts built with one peak scope cannot be extended with another."""
    files.write_daily(everything, at["landing"])
    files.write_raw(first_days(everything), at["raw"])
    daily.build_marts(spark, at["raw"], at["marts"], peak_scope="group")
    with pytest.raises(marts.MixedOptionsError):
        daily.run_daily(spark, at["landing"], at["raw"], at["marts"])
    daily.run_daily(spark, at["landing"], at["raw"], at["marts"], peak_scope="group")
    want = TrafficModels(everything, peak_scope="group").dashboard_traffic
    assert bag(marts.read_table(spark, at["marts"], "dashboard_traffic")) == bag(want)


def test_only_changed_dates_and_filter_types_are_rewritten(spark, at):
    def changed_at(name):
        return {r["day"]: r["modified"] for r in files.fingerprint(
            spark, f"{at['marts']}/{name}", r"_day=(\d{4}-\d{2}-\d{2})").collect()}
    days = ["2025-02-03", "2025-02-10"]        # the same weekday and month: no filter changes
    files.write_raw(make_raw(spark, [raw_row(day=d) for d in ("2025-02-01", *days)]), at["raw"])
    daily.build_marts(spark, at["raw"], at["marts"])
    before = {n: changed_at(n) for n in ("fact_traffic", "dashboard_traffic")}
    files.write_raw(make_raw(spark, [raw_row(day=days[1], entries=5)]), at["raw"])
    marts.update(spark, at["raw"], at["marts"], marts.pending_dates(spark, at["raw"], at["marts"]))
    for name, old in before.items():
        now = changed_at(name)
        assert {str(d) for d in now if now[d] != old[d]} == {days[1]}, name


def test_history_gate_blocks_a_thin_history(spark, at):
    files.write_daily(make_raw(spark, [raw_row(day="2025-02-02")]), at["landing"])
    files.write_raw(make_raw(spark, [raw_row(day="2025-02-01")]), at["raw"])
    daily.build_marts(spark, at["raw"], at["marts"])
    with pytest.raises(daily.HistoryGateError):
        daily.run_daily(spark, at["landing"], at["raw"], at["marts"])
    report = daily.run_daily(spark, at["landing"], at["raw"], at["marts"], require_history=False)
    assert [r["toll_date"] for r in report.collect()] == [dt.date(2025, 2, 2)]


def test_full_refresh_replaces_raw(spark, at):
    files.write_raw(make_raw(spark, [raw_row(day="2025-03-01")] * 5), at["raw"])
    files.write_full(make_raw(spark, [raw_row(day="2025-02-01")]), at["full"], run_id="20250101000000")
    files.write_full(make_raw(spark, [raw_row(day="2025-02-01"), raw_row(day="2025-02-02")]), at["full"],
                     run_id="20250102000000")
    assert daily.load_full(spark, at["full"], at["raw"]).first()["row_count"] == 2
    assert sorted(r["toll_date"].date() for r in files.read_raw(spark, at["raw"]).collect()) == \
        [dt.date(2025, 2, 1), dt.date(2025, 2, 2)]


def test_full_refresh_truncates_even_with_dynamic_session_default(spark, at):
    files.write_raw(make_raw(spark, [raw_row(day="2025-03-01")]), at["raw"])
    files.write_full(make_raw(spark, [raw_row(day="2025-02-01")]), at["full"], run_id="20250101000000")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        daily.load_full(spark, at["full"], at["raw"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r["toll_date"].date() for r in files.read_raw(spark, at["raw"]).collect()] == [dt.date(2025, 2, 1)]


def test_pages_to_marts_end_to_end(spark, at, everything, tmp_path):
    pages.land_pages(first_days(everything), at["hist"], 200)
    pages.land_pages(everything.where("toll_date > timestamp_ntz'2024-01-20'"), at["pages"], 200)
    # one extra page with a bad count for 2024-01-25: that day must not land
    bad = {"toll_date": "2024-01-25T00:00:00.000", "crz_entries": "lots"}
    (tmp_path / "pages" / "zz-bad.json").write_text(json.dumps({"value": [bad]}) + "\n")
    daily.land_history(spark, at["hist"], at["full"], start="2023-12-31", end="2024-01-20")
    daily.load_full(spark, at["full"], at["raw"])
    daily.build_marts(spark, at["raw"], at["marts"])
    report = {r["toll_date"]: (r["rejected"], r["loaded"])
              for r in daily.land_daily_pages(spark, at["pages"], at["landing"]).collect()}
    assert report[dt.date(2024, 1, 25)] == (1, False) and report[dt.date(2024, 1, 26)] == (0, True)
    loaded = daily.run_daily(spark, at["landing"], at["raw"], at["marts"])
    got = sorted(r["toll_date"] for r in loaded.collect())
    assert dt.date(2024, 1, 25) not in got and len(got) == 9
    complete(spark, at, everything.where("to_date(toll_date) <> date'2024-01-25'"))


def test_checks_run_over_the_written_tables_and_stop_the_run(spark, at, everything):
    files.write_raw(everything, at["raw"])
    daily.build_marts(spark, at["raw"], at["marts"])
    rows = daily.check_marts(spark, at["marts"]).collect()
    assert len(rows) == 17 + 2 + 4 and sum(r["violations"] for r in rows) == 0
    assert {r["check_name"] for r in rows} == {"not_null", "unique", "peak_hours",
                                               "vehicle_classes", "non_negative", "valid_dates"}
    dims = marts.read_table(spark, at["marts"], "dim_locations")
    dims.limit(1).write.mode("append").parquet(f"{at['marts']}/dim_locations")     # a seeded duplicate
    with pytest.raises(marts.QualityError, match="unique dim_locations.detection_region: 1"):
        marts.require_checks(spark, at["marts"])
    files.write_raw(make_raw(spark, [raw_row(day="2024-02-01", entries=-1)]), at["raw"])
    with pytest.raises(marts.QualityError, match="non_negative"):
        daily.build_marts(spark, at["raw"], at["marts"])
