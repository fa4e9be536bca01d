"""Landed pages, source filters, page windows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, bag, make_raw, raw_row
from tollflow.operators import audits
from tollflow.plans import daily
from tollflow.schema import RAW_FIELDS
from tollflow.sources import files, pages
from tollflow.sources.fixture import load_raw


def test_pages_round_trip_and_empty_page(spark, tmp_path):
    raw = load_raw(spark, SF_SMALL)
    land = str(tmp_path / "pages")
    pages.land_pages(raw, land, page_rows=100)
    # an empty page (end of data) and a pretty-printed single page file
    (tmp_path / "pages" / "zz-empty.json").write_text(json.dumps({"value": []}) + "\n")
    back = pages.read_pages(spark, land)
    assert back.columns == RAW_FIELDS
    assert bag(back) == bag(raw)
    sizes = spark.read.json(land).select(F.size("value").alias("n")).collect()
    assert max(r["n"] for r in sizes) <= 100


def test_multiline_page_file(spark, tmp_path):
    page = {"value": [{"toll_date": "2025-01-05T00:00:00.000", "toll_hour": "2025-01-05T09:00:00.000",
                       "vehicle_class": "TLC Taxi/FHV", "detection_region": "Brooklyn Bridge",
                       "crz_entries": 7, "excluded_roadway_entries": 1}],
            "@odata.nextLink": "page?skip=1"}
    (tmp_path / "p1.json").write_text(json.dumps(page, indent=2))
    rows = pages.read_pages(spark, str(tmp_path), multi_line=True).collect()
    assert len(rows) == 1 and rows[0]["toll_hour"] == dt.datetime(2025, 1, 5, 9)
    assert rows[0]["minute_of_hour"] is None


def test_range_filter_strict_start_inclusive_end(spark):
    raw = make_raw(spark, [raw_row(day=d) for d in
                           ("2025-01-01", "2025-01-02", "2025-04-12", "2025-04-13")])
    got = sorted(r["toll_date"].date() for r in pages.range_filter(raw).collect())
    assert got == [dt.date(2025, 1, 2), dt.date(2025, 4, 12)]


def test_day_filter_and_latest(spark):
    raw = make_raw(spark, [raw_row(day="2025-02-01", hour=h) for h in (0, 23)]
                   + [raw_row(day="2025-02-02")])
    assert pages.day_filter(raw, "2025-02-01").count() == 2
    assert pages.latest_available(raw).first()["latest_date"] == dt.date(2025, 2, 2)


def _sorted_rows(raw):
    key = lambda t: tuple((x is not None, x) for x in t)  # noqa: E731  (NULLs first)
    return sorted((tuple(r) for r in raw.collect()), key=key)


@pytest.mark.parametrize("skip,top", [(0, 5), (150, 100), (990, 50), (2000, 10), (0, 1000)])
def test_page_window_equals_a_python_sort(spark, skip, top):
    raw = load_raw(spark, SF_SMALL).unionByName(make_raw(spark, [raw_row(day=None)] * 3))
    raw = raw.unionByName(make_raw(spark, [raw_row(day="2024-01-05")] * 40))   # full ties
    got = [tuple(r) for r in pages.page_window(raw, skip, top).collect()]
    assert got == _sorted_rows(raw)[skip:skip + top]


def test_page_window_without_exchange_reuse_over_a_shuffled_input(spark):
    raw = load_raw(spark, SF_SMALL).repartition(13)
    spark.conf.set("spark.sql.exchange.reuse", "false")
    spark.sparkContext.setJobGroup("window", "planning")
    try:
        df = pages.page_window(raw, 150, 100)
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("window") == []
        assert [tuple(r) for r in df.collect()] == _sorted_rows(raw)[150:250]
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
        spark.sparkContext._jsc.clearJobGroup()


def test_checked_pages_route_bad_records_and_skip_their_day(spark, tmp_path):
    good = {"toll_date": "2025-01-05T00:00:00.000", "toll_hour": "2025-01-05T09:00:00.000",
            "vehicle_class": "TLC Taxi/FHV", "detection_region": "Brooklyn Bridge",
            "crz_entries": 7, "excluded_roadway_entries": 1}
    bad_count = {**good, "toll_date": "2025-01-06T00:00:00.000", "crz_entries": "seven"}
    other_day = {**good, "toll_date": "2025-01-06T00:00:00.000"}
    no_date = {**good, "toll_date": None}
    page = {"value": [good, bad_count, other_day, no_date]}
    (tmp_path / "p.json").write_text(json.dumps(page) + "\n")
    records, rejects = pages.read_pages_checked(spark, str(tmp_path))
    assert records.count() == 2
    rej = {(r["toll_date"], r["failed_fields"]) for r in rejects.collect()}
    assert rej == {(dt.date(2025, 1, 6), "crz_entries"), (None, "toll_date")}
    healthy, report = pages.split_healthy_days(records, rejects)
    assert [r["toll_date"].date() for r in healthy.collect()] == [dt.date(2025, 1, 5)]
    got = {r["toll_date"]: (r["records"], r["rejected"], r["loaded"]) for r in report.collect()}
    assert got == {dt.date(2025, 1, 5): (1, 0, True), dt.date(2025, 1, 6): (1, 1, False),
                   None: (0, 1, False)}


def test_ordered_range_partitions_on_tie_breakers_too(spark):
    # range partitioning cannot split equal keys; with every column in the sort
    # key, rows of one busy (date, hour) can still spread over partitions
    df = pages.ordered(make_raw(spark, [raw_row(entries=i) for i in range(50)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    part = plan[plan.index("rangepartitioning("):].split("\n")[0]
    for c in ("toll_date", "toll_hour", "detection_region", "crz_entries"):
        assert c in part
    assert [r["crz_entries"] for r in df.collect()] == list(range(50))


GOOD = {"toll_date": "2025-01-05T00:00:00.000", "toll_hour": "2025-01-05T09:00:00.000",
        "vehicle_class": "TLC Taxi/FHV", "detection_region": "Brooklyn Bridge",
        "crz_entries": 7, "excluded_roadway_entries": 1}


def test_cut_off_page_is_a_reject_and_stops_the_landing(spark, tmp_path):
    """A page that does not parse, and one without ``value``, lose no record silently."""
    good, cut = json.dumps({"value": [GOOD]}), json.dumps({"value": [GOOD] * 50})[:900]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "p.json").write_text("\n".join([good, cut, '{"value": null}', '{"value": []}']) + "\n")
    records, rejects = pages.read_pages_checked(spark, str(tmp_path / "in"))
    assert records.count() == 1
    bad = rejects.collect()
    assert [(r["toll_date"], r["failed_fields"]) for r in bad] == [(None, pages.BAD_PAGE)] * 2
    assert all(r["file_path"].endswith("p.json") for r in bad) and cut in {r["source"] for r in bad}
    with pytest.raises(daily.PageError):
        daily.land_daily_pages(spark, str(tmp_path / "in"), str(tmp_path / "landing"))
    assert not (tmp_path / "landing").exists()
    for text in (cut, '{"value": null}'):
        (tmp_path / "in" / "p.json").write_text(good + "\n" + text + "\n")
        with pytest.raises(Exception):
            pages.read_pages(spark, str(tmp_path / "in")).collect()


def test_file_schema_is_checked(spark, tmp_path):
    """Parquet without a declared column fails instead of reading NULLs."""
    raw = make_raw(spark, [raw_row()])
    files.write_raw(raw, str(tmp_path / "ok"))
    assert files.read_raw(spark, str(tmp_path / "ok")).count() == 1
    raw.drop("crz_entries").withColumn("toll_day", F.lit("2025-02-03")).write.partitionBy("toll_day") \
        .parquet(str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="crz_entries"):
        files.read_raw(spark, str(tmp_path / "bad"))
    files.with_daily_parts(raw).drop("crz_entries").write.partitionBy("year", "month", "day") \
        .parquet(str(tmp_path / "landing"))
    with pytest.raises(ValueError, match="crz_entries"):
        files.read_daily(spark, str(tmp_path / "landing"))


def test_daily_files_are_found_by_the_date_in_their_name(spark, tmp_path):
    base = str(tmp_path / "named")
    for day in ("2025-02-01", "2025-02-02"):
        y, m, d = day.split("-")
        make_raw(spark, [raw_row(day=day)]).write.parquet(f"{base}/x_day_{d}_toll_entries_{y}{m}{d}.parquet")
    report = daily.load_named_day(spark, base + "/*", str(tmp_path / "raw"), "2025-02-02").collect()
    assert [tuple(r) for r in report] == [(dt.date(2025, 2, 2), 1)]
    rows = files.read_raw(spark, str(tmp_path / "raw")).collect()
    assert [r["toll_date"].date() for r in rows] == [dt.date(2025, 2, 2)]


# ---- pages found one from the other, one page a file, statistics from footers -------------
def test_walked_pages_hold_every_row_once_and_in_order(spark):
    rows = [raw_row(day=d, hour=h, entries=e) for d in ("2025-02-01", None, "2025-02-03")
            for h in (1, 5) for e in (3, 3, 3, 3, 3, 9)] + [raw_row(region=None), raw_row(region="A")]
    raw = make_raw(spark, rows)
    for top in (1, 4, 100):
        walked = [[tuple(r) for r in p.orderBy(*pages._total_order(p, ("toll_date", "toll_hour"))).collect()]
                  for p in pages.walk_pages(raw, top)]
        assert [len(p) for p in walked[:-1]] == [top] * (len(walked) - 1)
        assert [r for p in walked for r in p] == [tuple(r) for r in pages.ordered(raw).collect()]
    assert list(pages.walk_pages(raw.limit(0), 5)) == []


def test_next_page_pushes_its_key_to_the_scan(spark, tmp_path):
    files.write_raw(make_raw(spark, [raw_row(day=f"2025-02-{d:02}") for d in range(1, 9)]), str(tmp_path / "raw"))
    raw = files.read_raw(spark, str(tmp_path / "raw"))
    _, token = pages.next_page(raw, 4)
    rest = raw.where(pages._from_key(raw.columns, token["key"]))
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(toll_date,2025-02-04T00:00" in plan
    page, token = pages.next_page(raw, 4, token)
    assert sorted(r["toll_date"].day for r in page.collect()) == [5, 6, 7, 8]
    assert pages.next_page(raw, 4, token)[1] is None


def test_one_page_a_file(spark, tmp_path):
    """Pretty-printed pages, a cut one, an empty one and one that is no page."""
    import json
    good = json.dumps({"value": [{"toll_date": "2025-01-05T00:00:00.000", "crz_entries": "7"}] * 3}, indent=2)
    texts = {"a": good, "b": good[:60], "c": '{\n "value": []\n}', "d": "[1,\n2]", "e": '{"next": 1}'}
    pages.land_page_files(spark.createDataFrame(list(texts.items()), "page_name string, text string"),
                          str(tmp_path / "in"))
    assert len(list((tmp_path / "in").glob("page_name=*/*.txt"))) == 5
    records, rejects = pages.read_pages_checked(spark, str(tmp_path / "in"), multi_line=True)
    assert records.count() == 3
    bad = rejects.collect()
    assert {r["failed_fields"] for r in bad} == {pages.BAD_PAGE}
    assert {r["file_path"].split("page_name=")[1][0] for r in bad} == {"b", "d", "e"}


def _bytes_read(spark):
    stats = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(stats.get(i).getBytesRead() for i in range(stats.size()))


def test_a_page_file_is_read_once(spark, tmp_path):
    """The text of numbers is not fetched one by one from the file; a file over several splits is one page."""
    n = 2000
    record = {"toll_date": "2025-01-05T00:00:00.000", "minute_of_hour": 3, "hour_of_day": 9, "crz_entries": 1.50}
    good = json.dumps({"value": [{**record, "crz_entries": i} for i in range(n)] + [record]}, indent=2)
    pages.land_page_files(spark.createDataFrame([("a", good), ("b", good[:-20])], "page_name string, text string"),
                          str(tmp_path / "in"))
    for split in ("128m", "64k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            before = _bytes_read(spark)
            records, rejects = pages.read_pages_checked(spark, str(tmp_path / "in"), multi_line=True)
            read = _bytes_read(spark) - before
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert sorted(r["crz_entries"] for r in records.collect()) == list(range(n))
        bad = {r["failed_fields"]: r["source"] for r in rejects.collect()}
        assert rejects.count() == 2 and bad[pages.BAD_PAGE] == good[:-20] + "\n"
        assert json.loads(bad["crz_entries"])["crz_entries"] == "1.5"
        if split == "128m":
            assert read < 3 * 2 * len(good)


def test_odd_page_files_read_as_by_the_multiline_reader(spark, tmp_path):
    date = '"toll_date": "2025-01-05T00:00:00.000"'
    texts = {
        "numbers": '{\n "value": [\n {%s, "crz_entries": 7, "minute_of_hour": 1.50, "hour_of_day": 1e3,\n'
                   '"vehicle_class": {"a":  1,\n "b": [1, 2.0]}, "detection_region": "caf\u00e9 \\u00e9"}\n]}\n' % date,
        "void": "", "blank": " \n \n", "text": "hello\n", "null": "null", "number": "5", "object": "{}",
        "pages": '[{"value": [{%s, "crz_entries": 1}]},\n {"value": [{%s, "crz_entries": 2}]}]' % (date, date),
        "two": '{"value": [{%s, "crz_entries": 1}]}\n{"value": []}\n' % date,
        "trail": '{"value": [{%s, "crz_entries": 1}]}\n rest' % date, "mixed": '{"value": [{%s}, 5, null]}' % date,
        "control": '{"value": [{%s, "vehicle_class": "a\x1eb"}]}' % date, "nul": '{"value": [{%s}]}\0\0' % date,
        "crlf": '{\r\n"value": [\r\n{%s, "crz_entries": 1}\r\n]\r\n}\r\n' % date,
        "mark": '\ufeff{"value": [{%s, "crz_entries": 1}]}' % date}
    for name, text in texts.items():
        (tmp_path / "in" / f"page_name={name}").mkdir(parents=True)
        (tmp_path / "in" / f"page_name={name}" / "p.txt").write_bytes(text.encode())
    multi = pages.tagged_records(pages.text_envelopes(spark.read).json(str(tmp_path / "in"), multiLine=True)
                                 .withColumn("file_path", F.col("_metadata.file_path")))
    for got, want in zip(pages.read_pages_checked(spark, str(tmp_path / "in"), multi_line=True),
                         pages.split_tagged(multi)):
        assert want.count() > 0 and bag(got) == bag(want)


def test_a_page_of_many_records_is_dealt_over_parts(spark):
    rows = [raw_row(day="2025-02-01", hour=1, entries=5)] * 500 + [raw_row(day="2025-02-01", hour=9)] * 3 \
        + [raw_row(day=None)] * 40
    raw = make_raw(spark, rows)
    name = F.concat(F.date_format("toll_date", "yyyyMMdd"), F.lit("-"), F.col("hour_of_day").cast("string"))
    dealt = pages.deal_pages(raw, name, page_records=20)
    assert bag(dealt.select(*raw.columns)) == bag(raw)
    sizes = {(r["page_name"], r["page_part"]): r["count"]
             for r in dealt.groupBy("page_name", "page_part").count().collect()}
    parts = {n: sorted(p for m, p in sizes if m == n) for n, _ in sizes}
    assert parts["20250201-9"] == [0] and parts[None][0] == parts["20250201-1"][0] == 0
    assert len(parts["20250201-1"]) > 20 and max(sizes.values()) < 60


def test_multiline_query_with_pages_of_few_records(spark):
    from tollflow.registry import src_pages_multiline
    few, usual = src_pages_multiline(spark, SF_SMALL, page_records=10), src_pages_multiline(spark, SF_SMALL)
    assert bag(few) == bag(usual) and few.where("failed_fields = 'page'").first()["records"] == 1


def test_statistics_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = [raw_row(day="2025-02-01", entries=3), raw_row(day="2025-02-01", entries=None),
            raw_row(day="2025-02-02", entries=None), raw_row(day=None, entries=8)]
    files.write_raw(make_raw(spark, rows), path)
    stats = files.raw_statistics(spark, path)
    got = {r["toll_date"]: tuple(r)[1:] for r in stats.collect()}
    assert got == {dt.date(2025, 2, 1): (2, 1), dt.date(2025, 2, 2): (1, 0), None: (1, 1)}
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(crz_entries)]" in plan
    whole = audits.completeness(make_raw(spark, rows)).first()
    assert audits.completeness_of(stats).first() == whole
    assert audits.completeness_of(stats.limit(0)).first() == audits.completeness(make_raw(spark, [])).first()
