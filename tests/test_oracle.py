"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tollflow.registry import QUERIES
from tools.check_oracle import compare


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(E.oracle_sql()) == set()
    assert set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, key):
    [(k, ok, msg)] = list(compare(spark, SF_SMALL, [key]))
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 8385
    assert df.columns == ["toll_date", "vehicle_class", "detection_region", "borough",
                          "location_name", "total_entries", "total_excluded", "exempt_ratio",
                          "peak_hour", "peak_hour_entries", "filter_type", "filter_value",
                          "filter_display"]


@pytest.mark.parametrize("key", ["stg_entries", "src_pages", "src_day_filter", "fn_iso_date",
                                 "fn_ten_minute_block", "dashboard_traffic"])
def test_results_do_not_depend_on_session_time_zone(spark, key):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        [(k, ok, msg)] = list(compare(spark, SF_SMALL, [key]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert ok, msg
