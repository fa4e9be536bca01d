"""The filter table by reference counts equals a full build after any change of dates."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import bag, make_raw, raw_row
from tollflow.operators import dims
from tollflow.plans import filter_counts as fc
from tollflow.plans import marts
from tollflow.plans.models import TrafficModels
from tollflow.sources import files

DAYS = ["2025-01-31", "2025-02-01", "2025-02-08", None]
REGIONS = ["Brooklyn Bridge", "Queens Gate", "East 60th St", None]
CLASSES = ["1 - Cars, Pickups and Vans", "4 - Buses", None]
ROWS = st.lists(st.tuples(st.sampled_from(DAYS), st.sampled_from(REGIONS), st.sampled_from(CLASSES),
                          st.integers(0, 3)), min_size=1, max_size=6)


def frame(spark, rows):
    return make_raw(spark, [raw_row(day=d, region=r, vclass=c, hour=h) for d, r, c, h in rows])


def as_date(d):
    return None if d is None else dt.date.fromisoformat(d)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(first=ROWS, second=ROWS, changed=st.sets(st.sampled_from(DAYS), min_size=1))
def test_counts_equal_a_full_build(spark, tmp_path_factory, first, second, changed):
    path = str(tmp_path_factory.mktemp("counts") / "c")
    fc.FilterCounts(spark, path).apply(TrafficModels(frame(spark, first)).rollup, None)
    now = [r for r in first if r[0] not in changed] + [r for r in second if r[0] in changed]
    part = [r for r in second if r[0] in changed]
    for _ in range(2):                                     # the second time changes nothing
        fc.FilterCounts(spark, path).apply(TrafficModels(frame(spark, part)).rollup, [as_date(d) for d in changed])
        m = TrafficModels(frame(spark, now))
        assert bag(fc.FilterCounts(spark, path).dim_filters()) == bag(m.dim_filters)
        assert bag(fc.FilterCounts(spark, path).dim_filters(dedupe=True)) == bag(m.dim_filters.distinct())
        assert bag(fc.FilterCounts(spark, path).dim_locations()) == bag(m.dim_locations)
        assert fc.FilterCounts(spark, path).bounds() == tuple(
            dims.date_bounds(m.domain, "min_date", "max_date").first())


def test_stopped_update_changes_nothing_that_is_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "c")
    one, two = frame(spark, [("2025-02-01", "Queens Gate", CLASSES[0], 1)]), frame(
        spark, [("2025-02-08", "East 60th St", CLASSES[1], 2)])
    fc.FilterCounts(spark, path).apply(TrafficModels(one).rollup, None)
    before = bag(fc.FilterCounts(spark, path).dim_filters())
    with monkeypatch.context() as m:
        create = spark.createDataFrame          # the log rows are made last

        def stopping(rows, schema):
            if schema == fc.LOG:
                raise RuntimeError("lost")
            return create(rows, schema)
        m.setattr(spark, "createDataFrame", stopping)
        with pytest.raises(RuntimeError, match="lost"):
            fc.FilterCounts(spark, path).apply(TrafficModels(two).rollup, [as_date("2025-02-08")])
    assert files.exists(spark, f"{path}/counts/version=2")
    assert bag(fc.FilterCounts(spark, path).dim_filters()) == before
    fc.FilterCounts(spark, path).apply(TrafficModels(two).rollup, [as_date("2025-02-08")])
    assert bag(fc.FilterCounts(spark, path).dim_filters()) == bag(TrafficModels(one.unionByName(two)).dim_filters)


def test_update_reads_only_changed_dates_and_counts(spark, tmp_path):
    """The rollup of other dates is not opened: its files may even be gone."""
    raw, out = str(tmp_path / "raw"), str(tmp_path / "marts")
    files.write_raw(frame(spark, [(d, r, CLASSES[0], 1) for d in DAYS[:3] for r in REGIONS[:2]]), raw)
    marts.build(spark, raw, out)
    want = frame(spark, [(d, r, CLASSES[0], 1) for d in DAYS[:2] for r in REGIONS[:2]]
                 + [(DAYS[2], REGIONS[2], CLASSES[1], 5)])
    files.delete(spark, f"{out}/_rollup/_day={DAYS[0]}")
    files.write_raw(frame(spark, [(DAYS[2], REGIONS[2], CLASSES[1], 5)]), raw)
    marts.update(spark, raw, out, [as_date(DAYS[2])])
    for name in ("dim_filters", "dim_locations", "dim_time", "dashboard_traffic"):
        assert bag(marts.read_table(spark, out, name)) == bag(getattr(TrafficModels(want), name)), name


def test_marts_without_counts_get_them_from_the_rollup(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "marts")
    files.write_raw(frame(spark, [(d, REGIONS[0], CLASSES[0], 1) for d in DAYS[:2]]), raw)
    marts.build(spark, raw, out)
    files.delete(spark, marts.path_of(out, marts.COUNTS))
    more = frame(spark, [(DAYS[2], REGIONS[1], CLASSES[0], 1)])
    files.write_raw(more, raw)
    marts.update(spark, raw, out, [as_date(DAYS[2])])
    want = TrafficModels(files.read_raw(spark, raw))
    assert bag(marts.read_table(spark, out, "dim_filters")) == bag(want.dim_filters)


# ---- publishing -----------------------------------------------------------------------------
def test_readers_see_old_or_new_marts_never_a_part(spark, tmp_path, monkeypatch):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "published")
    files.write_raw(frame(spark, [(DAYS[0], REGIONS[0], CLASSES[0], 1)]), raw)
    first = marts.publish(spark, raw, root, "shown")
    old = {n: bag(spark.table(f"shown.{n}")) for n in marts.TABLES}
    files.write_raw(frame(spark, [(DAYS[1], REGIONS[1], CLASSES[0], 1)]), raw)
    with monkeypatch.context() as m:                       # stops between the write and the switch
        m.setattr(marts, "switch", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            marts.publish(spark, raw, root, "shown")
    assert {n: bag(spark.table(f"shown.{n}")) for n in marts.TABLES} == old
    second = marts.publish(spark, raw, root, "shown")
    models = TrafficModels(files.read_raw(spark, raw))
    for n in marts.TABLES:
        assert bag(spark.table(f"shown.{n}")) == bag(getattr(models, n)), n
    assert len(files.folder_names(spark, root)) == 3
    marts.drop_unpublished(spark, root, [second])
    assert files.folder_names(spark, root) == [second.rsplit("/", 1)[1]] and first != second
    spark.sql("DROP DATABASE shown CASCADE")


def test_marts_that_fail_a_test_are_not_published(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "published")
    files.write_raw(frame(spark, [(DAYS[0], REGIONS[0], CLASSES[0], 1)]), raw)
    marts.publish(spark, raw, root, "sound")
    old = bag(spark.table("sound.fact_traffic"))
    files.write_raw(make_raw(spark, [raw_row(day=DAYS[1], entries=-5)]), raw)
    with pytest.raises(marts.QualityError, match="non_negative"):
        marts.publish(spark, raw, root, "sound")
    assert bag(spark.table("sound.fact_traffic")) == old
    failed = [n for n in files.folder_names(spark, root) if files.exists(spark, f"{root}/{n}/{marts.VIOLATIONS}")]
    [row] = spark.read.parquet(f"{root}/{failed[0]}/{marts.VIOLATIONS}/fact_traffic").collect()
    assert row["entries"] == -5 and row["broken"] == ["non_negative"]
    spark.sql("DROP DATABASE sound CASCADE")
