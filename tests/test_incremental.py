"""Idempotent loads, late files, watermark and backfill semantics."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, bag, make_raw, raw_row
from tollflow.plans import incremental as inc
from tollflow.plans import marts
from tollflow.plans.models import TrafficModels
from tollflow.sources import files
from tollflow.sources.fixture import load_raw


def _dates(df):
    return sorted(r[0] for r in df.collect())


def test_watermark_greatest_of_non_nulls_and_default(spark):
    a = make_raw(spark, [raw_row(day="2025-02-01")])
    b = TrafficModels(make_raw(spark, [raw_row(day="2025-02-05")])).fact_traffic
    empty = make_raw(spark, [])
    assert inc.watermark(spark, a, b).first()[0] == dt.date(2025, 2, 5)
    assert inc.watermark(spark, a, TrafficModels(empty).fact_traffic).first()[0] == \
        dt.date(2025, 2, 1)
    assert inc.watermark(spark, empty, TrafficModels(empty).fact_traffic).first()[0] == \
        dt.date(2025, 1, 1)
    assert inc.watermark(spark, empty, None, default=None).first()[0] is None


def test_backfill_dates(spark):
    d = lambda s: F.lit(s).cast("date")
    assert _dates(inc.backfill_dates(spark, d("2025-02-01"), d("2025-02-04"))) == \
        [dt.date(2025, 2, 2), dt.date(2025, 2, 3), dt.date(2025, 2, 4)]
    assert inc.backfill_dates(spark, d("2025-02-04"), d("2025-02-04")).count() == 0
    assert inc.backfill_dates(spark, d("2025-02-05"), d("2025-02-04")).count() == 0
    landing = make_raw(spark, [raw_row(day="2025-02-03")] * 2)
    got = inc.nonempty_backfill(inc.backfill_dates(spark, d("2025-02-01"), d("2025-02-04")),
                                landing).collect()
    assert [(r["toll_date"], r["records"]) for r in got] == [(dt.date(2025, 2, 3), 2)]


def test_new_dates_sorted_and_null_watermark(spark):
    landing = make_raw(spark, [raw_row(day=x) for x in ("2025-02-03", "2025-02-01", "2025-02-02")])
    got = [r[0] for r in inc.new_dates(landing, F.lit("2025-02-01").cast("date")).collect()]
    assert got == [dt.date(2025, 2, 2), dt.date(2025, 2, 3)]
    assert inc.new_dates(landing, F.lit(None).cast("date")).count() == 3


def test_daily_sink_replaces_only_its_dates(spark, tmp_path):
    landing = str(tmp_path / "landing")
    files.write_daily(make_raw(spark, [raw_row(day="2025-02-01"), raw_row(day="2025-02-02")]),
                      landing)
    files.write_daily(make_raw(spark, [raw_row(day="2025-02-02", entries=99)]), landing)
    got = {(r["toll_date"].date(), r["crz_entries"], r["month"], r["day"])
           for r in files.read_daily(spark, landing).collect()}
    assert got == {(dt.date(2025, 2, 1), 10, "02", "01"), (dt.date(2025, 2, 2), 99, "02", "02")}


def test_full_load_reads_newest_run_folder(spark, tmp_path):
    base = str(tmp_path / "full")
    files.write_full(make_raw(spark, [raw_row()]), base, run_id="20250101000000")
    files.write_full(make_raw(spark, [raw_row(), raw_row(entries=3)]), base, run_id="20250102000000")
    assert files.read_newest_run(spark, base).count() == 2


def test_run_folder_without_its_marker_is_passed_over(spark, tmp_path):
    """A run that stopped while it was written has the higher id."""
    base = str(tmp_path / "full")
    files.write_full(make_raw(spark, [raw_row()] * 4), base, run_id="20250101000000")
    files.write_full(make_raw(spark, [raw_row()]), base, run_id="20250102000000")
    (tmp_path / "full" / "run_id=20250102000000" / "_SUCCESS").unlink()
    assert files.read_newest_run(spark, base).count() == 4


def test_rows_without_a_date_are_kept_by_every_layout(spark, tmp_path):
    rows = make_raw(spark, [raw_row(day=None), raw_row(day="2025-02-01")])
    landing, raw_path = str(tmp_path / "landing"), str(tmp_path / "raw")
    files.write_daily(rows, landing)
    files.write_raw(files.read_daily(spark, landing).where(files.daily_folders([None, "2025-02-01"])), raw_path)
    assert files.read_raw(spark, raw_path).count() == 2
    assert files.read_raw(spark, raw_path, dates=[None]).count() == 1
    days = {r["day"] for r in files.fingerprint(spark, raw_path, files.RAW_DAY_IN_PATH).collect()}
    assert days == {None, dt.date(2025, 2, 1)}


def test_marts_round_trip_and_catalog(spark, tmp_path):
    raw_path, path = str(tmp_path / "raw"), str(tmp_path / "marts")
    raw = load_raw(spark, SF_SMALL)
    files.write_raw(raw, raw_path)
    marts.build(spark, raw_path, path)
    m = TrafficModels(raw)
    for name in marts.TABLES:
        assert bag(marts.read_table(spark, path, name)) == bag(getattr(m, name)), name
    assert spark.table("stg_entries").count() == 1000
    marts.register(spark, path, "toll_marts")
    assert spark.table("toll_marts.kpi_congestion").count() == 240
    assert spark.table("toll_marts.dim_time").count() == 30
    assert spark.table("toll_marts.dashboard_traffic").count() == 8385
