"""Entry points A and B as functions: full refresh and the daily run.

Daily run (T+1), one Spark application instead of three clock-coupled jobs:

1. gate: the fact must hold at least ``min_history_rows`` rows (C6);
2. dates to load: the landed ones that the load ledger does not hold in the
   version that has landed (C1-C4), wherever they lie in time;
3. load exactly those dates into raw by partition overwrite (S13, S17);
4. rebuild every mart for every raw date that is new or changed;
5. run the declared tests over the written marts and fail on violations.

All dates come from file listings and from the small records of earlier loads
and builds; no data and no footers of the history are read for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollflow.operators import audits
from tollflow.plans import ledger
from tollflow.plans import marts as M
from tollflow.schema import RAW_FIELDS
from tollflow.sources import files, pages


class HistoryGateError(RuntimeError):
    pass


class WrongDateError(RuntimeError):
    """Files hold records of another date than their name or folder says."""


class PageError(RuntimeError):
    """A landed page cannot be read; nothing is loaded, since its records have no known date."""


def land_history(spark: SparkSession, pages_path: str, full_base: str,
                 start=pages.HISTORY_START, end=pages.HISTORY_END,
                 run_id: str | None = None) -> str:
    """Entry point A, first half: landed history pages -> one full-load run
    folder, keeping toll_date > start and date <= end (S1, S3, S9).  A page that
    cannot be read stops the load.  Returns the run id."""
    records = pages.range_filter(pages.read_pages(spark, pages_path), start, end)
    return files.write_full(records, full_base, run_id)


def finish_page_load(spark: SparkSession, out_path: str, full_base: str,
                     start=pages.HISTORY_START, end=pages.HISTORY_END,
                     run_id: str | None = None) -> str:
    """The records landed by the resumable page stream -> a full-load run folder.
    Refused while any page or record was rejected."""
    from tollflow.streaming import landing
    rejected = landing.read_page_rejects(spark, out_path).count()
    if rejected:
        raise PageError(f"{rejected} rejected pages or records under {out_path}")
    records = pages.range_filter(landing.read_page_load(spark, out_path), start, end)
    return files.write_full(records, full_base, run_id)


def land_daily_pages(spark: SparkSession, pages_path: str, landing_path: str) -> DataFrame:
    """Daily pages -> daily landing folders, one folder per date.

    The pages are parsed once.  A day with a rejected record is not landed (the
    others are), as one failed day does not stop the rest.  A page that cannot
    be read fails the landing before anything is written: which days it holds
    is unknown.  Returns the per-day report (toll_date, records, rejected, loaded).
    """
    records, rejects = pages.read_pages_checked(spark, pages_path)
    broken = rejects.where(F.col("failed_fields") == pages.BAD_PAGE).select("file_path").take(5)
    if broken:
        raise PageError(f"pages that cannot be read in {sorted({r[0] for r in broken})}")
    healthy, report = pages.split_healthy_days(records, rejects)
    report = report.checkpoint(eager=True)
    files.write_daily(healthy, landing_path)
    return report


def load_full(spark: SparkSession, full_base: str, raw_path: str) -> DataFrame:
    """Entry point A: replace the raw table with the newest complete full-load run.

    The ledger says that a load is under way until it has ended, so a stopped
    one is not taken for a loaded table.
    """
    run = files.newest_run(spark, full_base)
    ledger.full_load_begins(spark, raw_path)
    files.replace_raw(files.read_run(spark, run), raw_path)
    ledger.full_load_ended(spark, raw_path, run)
    return audits.row_count(files.read_raw(spark, raw_path), "raw")


def load_landed(spark: SparkSession, landing_path: str, raw_path: str, full_days: str = "add") -> DataFrame:
    """Load every landed date that raw lacks or holds in another version; (toll_date, records) of each.

    The listing is taken before the files are read, so what changes meanwhile
    differs from its record and is loaded by the next run.  ``full_days``: what
    a folder of a date is that came with a full load, see ``ledger``.
    """
    rows = ledger.to_load(spark, files.fingerprint(spark, landing_path, files.LANDING_DAY_IN_PATH), raw_path)
    if not rows:
        return spark.createDataFrame([], "toll_date date, records bigint")
    batch = files.read_daily(spark, landing_path).where(files.daily_folders([r["day"] for r in rows]))
    return _load(spark, batch, rows, raw_path, ledger.LANDING, full_days)


def load_named_files(spark: SparkSession, base: str, raw_path: str, full_days: str = "add") -> DataFrame:
    """Load the daily files under ``base`` by the date in their name, all new dates in one write
    (S14, S15); (toll_date, records) of each.

    Which files are new is known from their names and the ledger before any is
    opened; files without a date in their name are never opened.  Records of
    other dates than the names say stop the load before anything is written.
    """
    rows = ledger.to_load(spark, files.named_fingerprint(spark, base), raw_path)
    return _load_named(spark, base, raw_path, rows, full_days)


def load_named_day(spark: SparkSession, base: str, raw_path: str, day) -> DataFrame:
    """Load one date again from the daily files whose name carries it, whatever the ledger holds."""
    listed = files.named_fingerprint(spark, base).where(F.col("day") == F.lit(str(day)[:10]).cast("date"))
    return _load_named(spark, base, raw_path, ledger.as_rows(listed), "replace")


def _load_named(spark: SparkSession, base: str, raw_path: str, rows: list, full_days: str) -> DataFrame:
    if not rows:
        return spark.createDataFrame([], "toll_date date, records bigint")
    days = [r["day"] for r in rows]
    return _load(spark, files.read_named_days(spark, base, days), rows, raw_path, ledger.NAMED,
                 full_days)


def _load(spark: SparkSession, batch: DataFrame, rows: list, raw_path: str, source: str,
          full_days: str) -> DataFrame:
    landed, kept = ledger.with_run_rows(spark, batch, rows, full_days)
    report = audits.loaded_dates(landed).checkpoint(eager=True)
    days = [r["day"] for r in rows]
    strange = [r[0] for r in report.collect() if r[0] not in days]       # one row per loaded day
    if strange:
        raise WrongDateError(f"files of {days} hold records of {strange}")
    landed = landed.select(*RAW_FIELDS)
    files.write_raw(landed if kept is None else landed.unionByName(kept), raw_path)
    ledger.append(spark, raw_path, rows, source)
    return report


def build_marts(spark: SparkSession, raw_path: str, marts: str, peak_scope: str = "date",
                dedupe_filters: bool = False, check: bool = True) -> None:
    """Full rebuild of every mart from the raw table, then the declared tests."""
    M.build(spark, raw_path, marts, peak_scope, dedupe_filters)
    if check:
        M.require_checks(spark, marts)


def check_marts(spark: SparkSession, marts: str) -> DataFrame:
    """Entry point C's test step over the written tables: one row per check."""
    return M.checks(spark, marts)


def run_daily(spark: SparkSession, landing_path: str, raw_path: str, marts: str,
              min_history_rows: int = audits.MIN_HISTORY_ROWS, require_history: bool = True,
              peak_scope: str = "date", dedupe_filters: bool = False,
              full_days: str = "add") -> DataFrame:
    """Entry point B.  Returns (toll_date, records) for every date loaded.

    Ends with complete marts or with an error: whatever date is in raw and not
    finished in the marts -- left by an earlier run that stopped, reloaded by a
    stream, or new -- is rebuilt, also when no new date has landed.
    """
    M.check_options(spark, marts, peak_scope, dedupe_filters)
    built = M.build_record(spark, marts).agg(F.sum("fact_rows")).first()[0] or 0
    if require_history and built < min_history_rows:
        raise HistoryGateError(f"the fact holds {built} rows, {min_history_rows} are needed")
    report = load_landed(spark, landing_path, raw_path, full_days)
    pending = M.pending_dates(spark, raw_path, marts)                # at most one per day
    if pending and files.exists(spark, M.path_of(marts, "dim_filters")):
        M.update(spark, raw_path, marts, pending, peak_scope, dedupe_filters)
    elif pending:
        M.build(spark, raw_path, marts, peak_scope, dedupe_filters)
    if pending:
        M.require_checks(spark, marts)
    return report
