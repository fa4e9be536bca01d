"""The load ledger: late days, late files, stopped loads, full loads, named files, the stream."""

import datetime as dt

import pytest

from tests.conftest import bag, make_raw, raw_row
from tollflow.plans import daily, ledger
from tollflow.sources import files
from tollflow.streaming.landing import run_landing_load


@pytest.fixture
def at(tmp_path):
    return {n: str(tmp_path / n) for n in ("landing", "raw", "full", "ckpt", "named")}


def days_of(report):
    return sorted(r["toll_date"] for r in report.collect())


def day(n):
    return dt.date(2025, 2, n)


def land(spark, at, *numbers, entries=10):
    files.write_daily(make_raw(spark, [raw_row(day=f"2025-02-{n:02}", entries=entries) for n in numbers]),
                      at["landing"])


def late(spark, at, n, entries):
    """One more file in a landed folder."""
    files.with_daily_parts(make_raw(spark, [raw_row(day=f"2025-02-{n:02}", entries=entries)])) \
        .write.mode("append").partitionBy("year", "month", "day").parquet(at["landing"])


def load(spark, at, **options):
    return days_of(daily.load_landed(spark, at["landing"], at["raw"], **options))


def entries(spark, at):
    return sorted((r["toll_date"].day, r["crz_entries"]) for r in files.read_raw(spark, at["raw"]).collect())


def test_days_and_files_below_the_watermark_are_loaded(spark, at):
    land(spark, at, 1, 2, 4)
    assert load(spark, at) == [day(1), day(2), day(4)]
    assert load(spark, at) == []
    land(spark, at, 3)                                     # skipped at first, landed after later days
    late(spark, at, 1, 77)
    assert load(spark, at) == [day(1), day(3)]
    assert load(spark, at) == []
    assert entries(spark, at) == [(1, 10), (1, 77), (2, 10), (3, 10), (4, 10)]
    land(spark, at, 2, entries=5)                          # landed anew: the day is replaced
    assert load(spark, at) == [day(2)]
    assert (2, 5) in entries(spark, at) and (2, 10) not in entries(spark, at)


def test_run_that_stops_before_its_record_loads_the_day_again(spark, at, monkeypatch):
    land(spark, at, 1)
    load(spark, at)
    land(spark, at, 2)
    with monkeypatch.context() as m:
        m.setattr(ledger, "append", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            load(spark, at)
    assert load(spark, at) == [day(2)] and load(spark, at) == []
    assert entries(spark, at) == [(1, 10), (2, 10)]


def test_nothing_loaded_yet_begins_after_the_default_watermark(spark, at):
    files.write_daily(make_raw(spark, [raw_row(day="2024-12-31"), raw_row(day="2025-01-02")]), at["landing"])
    assert load(spark, at) == [dt.date(2025, 1, 2)]
    assert load(spark, at) == []


@pytest.mark.parametrize("full_days", ["add", "replace"])
def test_folders_of_full_load_days(spark, at, full_days):
    land(spark, at, 1, 2)                                  # landed before the run: covered by it
    files.write_full(make_raw(spark, [raw_row(day=f"2025-02-{n:02}", entries=1) for n in (1, 2, 3)]),
                     at["full"], "20250301000000")
    daily.load_full(spark, at["full"], at["raw"])
    assert load(spark, at, full_days=full_days) == []
    late(spark, at, 1, 77)                                 # beside a covered file
    late(spark, at, 3, 88)                                 # alone
    assert load(spark, at, full_days=full_days) == [day(1), day(3)]
    assert load(spark, at, full_days=full_days) == []
    want = {"add": [(1, 1), (1, 77), (2, 1), (3, 1), (3, 88)], "replace": [(1, 10), (1, 77), (2, 1), (3, 88)]}
    assert entries(spark, at) == want[full_days]
    late(spark, at, 3, 89)                                 # the run's rows stay with a second late file
    assert load(spark, at, full_days=full_days) == [day(3)]
    assert entries(spark, at) == sorted(want[full_days] + [(3, 89)])
    with pytest.raises(ValueError, match="full_days"):
        late(spark, at, 3, 90)
        load(spark, at, full_days="maybe")


def test_unfinished_full_load_is_not_taken_for_a_table(spark, at, monkeypatch):
    files.write_full(make_raw(spark, [raw_row(day="2025-02-01")]), at["full"], "20250301000000")
    land(spark, at, 2)
    with monkeypatch.context() as m:
        m.setattr(files, "replace_raw", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            daily.load_full(spark, at["full"], at["raw"])
    with pytest.raises(ledger.UnfinishedLoadError):
        load(spark, at)
    daily.load_full(spark, at["full"], at["raw"])
    assert load(spark, at) == [day(2)]


def test_stream_and_daily_run_share_the_ledger(spark, at):
    land(spark, at, 1, 2)
    load(spark, at)
    before = files.fingerprint(spark, at["raw"], files.RAW_DAY_IN_PATH).select("day", "modified").collect()
    run_landing_load(spark, at["landing"], at["raw"], at["ckpt"])      # all there already
    assert files.fingerprint(spark, at["raw"], files.RAW_DAY_IN_PATH).select("day", "modified").collect() == before
    late(spark, at, 1, 77)
    land(spark, at, 3)
    run_landing_load(spark, at["landing"], at["raw"], at["ckpt"])
    assert load(spark, at) == []
    assert entries(spark, at) == [(1, 10), (1, 77), (2, 10), (3, 10)]


def test_stream_keeps_the_rows_of_a_full_load(spark, at):
    files.write_full(make_raw(spark, [raw_row(day="2025-02-01", entries=1)]), at["full"], "20250301000000")
    daily.load_full(spark, at["full"], at["raw"])
    land(spark, at, 1, 2, entries=7)
    run_landing_load(spark, at["landing"], at["raw"], at["ckpt"])
    assert entries(spark, at) == [(1, 1), (1, 7), (2, 7)]


def test_rows_without_a_date_are_in_the_ledger_too(spark, at):
    files.write_daily(make_raw(spark, [raw_row(day="2025-02-01"), raw_row(day=None)]), at["landing"])
    assert daily.load_landed(spark, at["landing"], at["raw"]).count() == 2
    assert daily.load_landed(spark, at["landing"], at["raw"]).count() == 0
    assert files.read_raw(spark, at["raw"]).count() == 2


# ---- files by the date in their name ------------------------------------------------------
def named(spark, at, n, rows, stem="x"):
    make_raw(spark, rows).coalesce(1).write.mode("append").parquet(
        f"{at['named']}/{stem}_day_{n:02}_toll_entries_202502{n:02}.parquet")


def test_named_files_are_picked_from_their_names(spark, at):
    for n in (1, 2, 3):
        named(spark, at, n, [raw_row(day=f"2025-02-{n:02}", entries=n)])
    make_raw(spark, [raw_row(day="2025-02-01", entries=99)]).write.parquet(f"{at['named']}/summary.parquet")
    make_raw(spark, [raw_row(entries=99)]).write.parquet(
        f"{at['named']}/x_day_45_toll_entries_20250245.parquet")         # no calendar date
    base = at["named"] + "/*"
    assert days_of(daily.load_named_files(spark, base, at["raw"])) == [day(1), day(2), day(3)]
    assert entries(spark, at) == [(1, 1), (2, 2), (3, 3)]
    assert daily.load_named_files(spark, base, at["raw"]).count() == 0
    named(spark, at, 2, [raw_row(day="2025-02-02", entries=7)], stem="more")  # a second file of a loaded date
    assert days_of(daily.load_named_files(spark, base, at["raw"])) == [day(2)]
    assert entries(spark, at) == [(1, 1), (2, 2), (2, 7), (3, 3)]


def test_only_the_files_of_the_wanted_days_are_opened(spark, at):
    for n in range(1, 6):
        named(spark, at, n, [raw_row(day=f"2025-02-{n:02}")])
    df = files.read_named_days(spark, at["named"] + "/*", [day(2), day(4)])
    assert len(df.collect()) == 2
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 2


def test_records_of_another_date_than_the_name_stop_the_load(spark, at):
    named(spark, at, 1, [raw_row(day="2025-02-01"), raw_row(day="2025-02-09")])
    with pytest.raises(daily.WrongDateError, match="2025, 2, 9"):
        daily.load_named_files(spark, at["named"] + "/*", at["raw"])
    assert not files.exists(spark, at["raw"])


def test_ledger_of_a_table_that_has_none(spark, at):
    """Rows written by hand count as loaded unless their folder changed afterwards."""
    land(spark, at, 1, 2)
    files.write_raw(make_raw(spark, [raw_row(day="2025-02-01")]), at["raw"])
    assert load(spark, at) == [day(2)]
    assert bag(files.read_raw(spark, at["raw"])) == bag(
        make_raw(spark, [raw_row(day="2025-02-01"), raw_row(day="2025-02-02")]))
