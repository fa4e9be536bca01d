"""Plan shape: broadcast dims, no nested-loop joins, pushdown and pruning."""

from tests.conftest import SF_SMALL
from tollflow.plans.models import TrafficModels
from tollflow.registry import QUERIES
from tollflow.sources import pages
from tollflow.sources.fixture import load_raw


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_dashboard_scans_once_and_has_no_nested_loop(spark):
    p = final_plan(QUERIES["dashboard_traffic"](spark, SF_SMALL))
    assert "NestedLoopJoin" not in p and "Cartesian" not in p
    assert p.count("FileScan") == 1 and "ReusedExchange" in p


def test_fact_joins_are_broadcast_and_scan_is_pruned(spark):
    p = final_plan(TrafficModels(load_raw(spark, SF_SMALL), join_dims=True).fact_traffic)
    assert p.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in p
    assert "event_type" not in p.split("FileScan")[1].split("\n")[0]


def test_broadcasts_off_gives_shuffle_joins_and_the_same_rows(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["dashboard_traffic"](spark, SF_SMALL)
        assert "Broadcast" not in final_plan(df) and df.count() == 8385
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_day_and_range_filters_prune_raw_folders(spark, tmp_path):
    from tollflow.sources import files
    raw, path = load_raw(spark, SF_SMALL), str(tmp_path / "raw")
    files.write_raw(raw, path)
    stored = files.read_raw(spark, path, keep_day=True)
    for df, same in ((pages.day_filter(stored, "2024-01-15"), pages.day_filter(raw, "2024-01-15")),
                     (pages.range_filter(stored, "2024-01-03", "2024-01-27"),
                      pages.range_filter(raw, "2024-01-03", "2024-01-27"))):
        assert "PartitionFilters: [isnotnull(toll_day" in plan(df)
        assert df.columns == raw.columns and df.count() == same.count()


def test_all_checks_read_the_fact_once(spark):
    m = TrafficModels(load_raw(spark, SF_SMALL))
    from tollflow.operators import quality
    p = plan(quality.table_checks("fact_traffic", m.fact_traffic,
                                  quality.NOT_NULL_COLUMNS["fact_traffic"], singular=True))
    assert p.split("== Initial Plan ==")[0].count("FileScan") == 1


def test_day_filter_reaches_the_scan(spark, tmp_path):
    raw = load_raw(spark, SF_SMALL)
    path = str(tmp_path / "raw")
    raw.write.parquet(path)
    df = pages.day_filter(spark.read.parquet(path), "2024-01-15")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(toll_date), GreaterThanOrEqual(toll_date" in p
    assert df.count() == raw.where("to_date(toll_date) = date'2024-01-15'").count()


def test_join_free_fact_is_one_map_only_pass(spark):
    p = plan(TrafficModels(load_raw(spark, SF_SMALL)).fact_traffic)
    assert "Exchange" not in p and "Join" not in p and p.count("FileScan") == 1


def test_cluster_conf_keeps_explicit_settings(spark):
    from tollflow.session import apply_cluster_conf
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
    old_parts = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        apply_cluster_conf(spark)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "64m"
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        assert spark.conf.get("spark.sql.shuffle.partitions") == old_parts  # set by the test session
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",
                  "spark.sql.autoBroadcastJoinThreshold",
                  "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor"):
            spark.conf.unset(k)


def test_left_join_peak_reads_the_fact_once(spark):
    df = QUERIES["join_left_peak"](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
