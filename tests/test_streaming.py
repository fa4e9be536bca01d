"""availableNow stream over a growing landing folder equals a batch load."""

from tests.conftest import SF_SMALL, bag, make_raw, raw_row
from tollflow.sources import files
from tollflow.sources.fixture import load_raw
from tollflow.streaming.landing import run_landing_load


def test_stream_twice_equals_batch(spark, tmp_path):
    landing, raw_path, ckpt = (str(tmp_path / n) for n in ("landing", "raw", "ckpt"))
    raw = load_raw(spark, SF_SMALL)
    first = raw.where("toll_date < timestamp_ntz'2024-01-15'")
    files.write_daily(first, landing)
    run_landing_load(spark, landing, raw_path, ckpt)
    assert files.read_raw(spark, raw_path).count() == first.count()
    # more days arrive, plus a late file for an already loaded day
    files.write_daily(raw.where("toll_date >= timestamp_ntz'2024-01-15'"), landing)
    late = files.with_daily_parts(make_raw(spark, [raw_row(day="2024-01-03", entries=7)]))
    late.drop("year", "month", "day").write.mode("append").parquet(
        f"{landing}/year=2024/month=01/day=03")
    run_landing_load(spark, landing, raw_path, ckpt)
    expect = raw.unionByName(make_raw(spark, [raw_row(day="2024-01-03", entries=7)]))
    assert bag(files.read_raw(spark, raw_path)) == bag(expect)
    # a third run finds nothing new and changes nothing
    run_landing_load(spark, landing, raw_path, ckpt)
    assert files.read_raw(spark, raw_path).count() == 1001


def test_page_stream_resumes_and_loads_each_record_once(spark, tmp_path):
    from tollflow.sources import pages
    from tollflow.streaming.landing import read_page_load, run_page_load
    raw = load_raw(spark, SF_SMALL)
    pages_dir, out, ckpt = (str(tmp_path / n) for n in ("pages", "out", "ckpt"))
    first = raw.where("toll_date < timestamp_ntz'2024-01-15'")
    second = raw.where("toll_date >= timestamp_ntz'2024-01-15'")
    pages.land_pages(first, f"{pages_dir}/part1", page_rows=100)
    run_page_load(spark, f"{pages_dir}/*", out, ckpt)
    assert bag(read_page_load(spark, out)) == bag(first)
    pages.land_pages(second, f"{pages_dir}/part2", page_rows=100)
    run_page_load(spark, f"{pages_dir}/*", out, ckpt)        # resumes: only the new pages
    run_page_load(spark, f"{pages_dir}/*", out, ckpt)        # nothing new
    assert bag(read_page_load(spark, out)) == bag(raw)


def test_bad_pages_and_values_are_rejected_beside_the_batch(spark, tmp_path):
    """A cut-off page and a bad count leave no NULLs and lose no record."""
    import json

    import pytest

    from tollflow.plans import daily
    from tollflow.sources import pages
    from tollflow.streaming.landing import read_page_load, read_page_rejects, run_page_load
    good = {"toll_date": "2025-01-05T00:00:00.000", "crz_entries": 7}
    lines = [json.dumps({"value": [good, {**good, "crz_entries": "lots"}, {**good, "toll_date": None}]}),
             json.dumps({"value": [good] * 50})[:500]]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "p.json").write_text("\n".join(lines) + "\n")
    out = str(tmp_path / "out")
    run_page_load(spark, str(tmp_path / "in"), out, str(tmp_path / "ckpt"))
    assert [r["crz_entries"] for r in read_page_load(spark, out).collect()] == [7]
    assert sorted(r["failed_fields"] for r in read_page_rejects(spark, out).collect()) == [
        "crz_entries", pages.BAD_PAGE, "toll_date"]
    with pytest.raises(daily.PageError):
        daily.finish_page_load(spark, out, str(tmp_path / "full"))


def test_stream_of_pages_becomes_a_run_folder(spark, tmp_path):
    from tollflow.plans import daily
    from tollflow.sources import pages
    from tollflow.streaming.landing import run_page_load
    raw = load_raw(spark, SF_SMALL)
    pages.land_pages(raw, str(tmp_path / "pages"), page_rows=100)
    run_page_load(spark, str(tmp_path / "pages"), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    daily.finish_page_load(spark, str(tmp_path / "out"), str(tmp_path / "full"), "2024-01-03", "2024-01-27")
    daily.load_full(spark, str(tmp_path / "full"), str(tmp_path / "raw"))
    assert bag(files.read_raw(spark, str(tmp_path / "raw"))) == bag(
        pages.range_filter(raw, "2024-01-03", "2024-01-27"))


def test_stream_keeps_rows_without_a_date(spark, tmp_path):
    """The batch and the stream treat NULL dates alike."""
    landing, raw_path, ckpt = (str(tmp_path / n) for n in ("landing", "raw", "ckpt"))
    files.write_daily(make_raw(spark, [raw_row(day=None), raw_row(day="2025-02-01")]), landing)
    run_landing_load(spark, landing, raw_path, ckpt)
    assert files.read_raw(spark, raw_path).count() == 2


def test_stopped_page_load_goes_on_and_adds_nothing_twice(spark, tmp_path):
    """The run ends between a batch's write and its commit; that batch is written again."""
    import pytest

    from tollflow.sources import pages
    from tollflow.streaming.landing import LoadStopped, read_page_load, run_page_load
    raw = load_raw(spark, SF_SMALL)
    pages_dir, out, ckpt = (str(tmp_path / n) for n in ("pages", "out", "ckpt"))
    pages.land_pages(raw.repartition(5), pages_dir, page_rows=50)
    with pytest.raises(LoadStopped):
        run_page_load(spark, pages_dir, out, ckpt, files_per_batch=2, stop_after=1)
    part = read_page_load(spark, out).count()
    assert 0 < part < raw.count()
    run_page_load(spark, pages_dir, out, ckpt, files_per_batch=2)
    assert bag(read_page_load(spark, out)) == bag(raw)
    run_page_load(spark, pages_dir, out, ckpt, files_per_batch=2)
    assert bag(read_page_load(spark, out)) == bag(raw)
