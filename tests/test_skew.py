"""A third of all rows on one date: results stay exact (checked against DuckDB)."""

import pytest

from tests.conftest import SF_MID
from tools.check_oracle import compare


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    """sf0.01 events with every third event moved to 2024-01-15, time of day kept."""
    out = tmp_path_factory.mktemp("skew")
    events = spark.read.parquet(f"{SF_MID}/events.parquet")
    moved = events.selectExpr(
        "event_id",
        "CASE WHEN event_id % 3 = 0 THEN "
        "CAST(timestamp_ntz'2024-01-15 00:00:00' + (ts - CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ)) "
        "AS TIMESTAMP_NTZ) ELSE ts END AS ts",
        "user_id", "event_type", "value", "props")
    moved.coalesce(1).write.parquet(str(out / "events.parquet"))
    return str(out)


@pytest.mark.parametrize("key", ["kpi_congestion", "dashboard_traffic", "peak_hours_top1",
                                 "dq_not_null", "report_entry_points", "audit_loaded_dates"])
def test_skewed_date_matches_oracle(spark, skewed_dir, key):
    [(k, ok, msg)] = list(compare(spark, skewed_dir, [key]))
    assert ok, msg


def test_one_date_holds_a_third(spark, skewed_dir):
    from tollflow.sources.fixture import load_raw
    raw = load_raw(spark, skewed_dir)
    top = raw.groupBy("toll_date").count().orderBy("count", ascending=False).first()
    assert top["count"] * 3 >= raw.count()
