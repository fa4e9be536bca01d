"""Resumable landing -> raw load as a file-source stream.

The reference keeps a hand-written skip offset so an interrupted history
load can resume.  Here the landing folder is a file-source stream run with
``trigger(availableNow=True)``: the checkpoint records which files were
processed, so a rerun picks up only new files, and a rerun after a failure
repeats the unfinished batch.

Each micro-batch only tells us *which dates* were touched.  The batch
callback re-reads those dates' whole landing folders and overwrites them
in the raw table (dynamic partition overwrite); otherwise a late file
would replace its date with itself alone.  Only the touched (year, month,
day) triples reach the driver, at most one per calendar day; they become a
static partition filter, so the scan lists only those folders.  The load ledger
gets a record per date, and dates that it holds already in the landed version
are passed over.  The rewritten raw files differ from the marts' build record, so the next daily run rebuilds
these dates in every mart.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tollflow.plans import ledger
from tollflow.schema import RAW_FIELDS, RAW_SCHEMA
from tollflow.sources import files, pages

DAILY_PARTS = files.DAILY_PARTS


def landing_stream(spark: SparkSession, landing_path: str) -> DataFrame:
    schema = files._with_fields(files.RAW_SCHEMA, DAILY_PARTS)
    return spark.readStream.schema(schema).parquet(landing_path)


def reload_touched(spark: SparkSession, batch: DataFrame, landing_path: str,
                   raw_path: str) -> None:
    keys = batch.select(*DAILY_PARTS).distinct().collect()      # one per calendar day at most
    if not keys:
        return
    folders = ["/".join(f"{p}={k[p] if k[p] is not None else '__HIVE_DEFAULT_PARTITION__'}"
                        for p in DAILY_PARTS) for k in keys]
    # the touched dates that the ledger holds as they are now need no second load
    listed = files.fingerprint(spark, landing_path, files.LANDING_DAY_IN_PATH, folders)
    rows = ledger.to_load(spark, listed, raw_path, from_start=False)
    if rows:
        # an expression over partition columns only: pruned at listing time
        batch = files.read_daily(spark, landing_path).where(files.daily_folders([r["day"] for r in rows]))
        landed, kept = ledger.with_run_rows(spark, batch, rows)
        landed = landed.select(*RAW_FIELDS)
        files.write_raw(landed if kept is None else landed.unionByName(kept), raw_path)
        ledger.append(spark, raw_path, rows, ledger.LANDING)


def start_landing_load(spark: SparkSession, landing_path: str, raw_path: str,
                       checkpoint_path: str) -> StreamingQuery:
    """Start (and return) the availableNow stream from landing to raw."""
    def apply(batch: DataFrame, epoch_id: int) -> None:
        reload_touched(batch.sparkSession, batch, landing_path, raw_path)

    return (landing_stream(spark, landing_path).writeStream
            .foreachBatch(apply)
            .option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True)
            .start())


def run_landing_load(spark: SparkSession, landing_path: str, raw_path: str,
                     checkpoint_path: str) -> None:
    """Process every landed file not yet processed, then return."""
    q = start_landing_load(spark, landing_path, raw_path, checkpoint_path)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


# ---- history pages: resumable load ---------------------------------------------

class LoadStopped(RuntimeError):
    """The load stopped on request; a further run with the same checkpoint goes on."""


def page_stream(spark: SparkSession, pages_path: str, files_per_batch: int | None = None) -> DataFrame:
    """Landed JSON page files as a stream of tagged records (S1 under C5)."""
    reader = pages.text_envelopes(spark.readStream)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return pages.tagged_records(reader.json(pages_path)
                                .withColumn("file_path", F.col("_metadata.file_path")))


def start_page_load(spark: SparkSession, pages_path: str, out_path: str, checkpoint_path: str,
                    files_per_batch: int | None = None, stop_after: int | None = None) -> StreamingQuery:
    """Each micro-batch's records go to ``out_path/batch_id=N``, in a folder of
    their own beside what cannot be loaded: pages that do not parse, values of a wrong type.

    A batch that is re-run after a failure has the same id and overwrites its
    own folders, and the checkpoint records which page files were taken, so
    every record lands exactly once, in one of the two, and a rerun resumes
    after the last committed batch.  ``files_per_batch`` bounds what an
    interruption can cost; ``stop_after`` ends the run in the batch after that
    many, between its write and its commit, as a lost driver would.
    """
    taken = []

    def apply(batch: DataFrame, epoch_id: int) -> None:
        batch.withColumn("_good", F.col("failed_fields") == "").write.mode("overwrite") \
            .partitionBy("_good").parquet(f"{out_path}/batch_id={epoch_id}")
        taken.append(epoch_id)
        if stop_after is not None and len(taken) > stop_after:
            raise LoadStopped(f"stopped in batch {epoch_id}")

    return (page_stream(spark, pages_path, files_per_batch).writeStream
            .foreachBatch(apply)
            .option("checkpointLocation", checkpoint_path)
            .trigger(availableNow=True)
            .start())


def run_page_load(spark: SparkSession, pages_path: str, out_path: str, checkpoint_path: str,
                  files_per_batch: int | None = None, stop_after: int | None = None) -> None:
    """Load every page file not yet loaded; LoadStopped if ``stop_after`` ended the run before that."""
    q = start_page_load(spark, pages_path, out_path, checkpoint_path, files_per_batch, stop_after)
    try:
        q.awaitTermination()
    except StreamingQueryException as e:
        if stop_after is not None and LoadStopped.__name__ in str(e):
            raise LoadStopped(f"stopped after {stop_after} batches") from e
        raise


def read_page_records(spark: SparkSession, out_path: str) -> DataFrame:
    """Everything that ``run_page_load`` has taken so far: the fields that could be read, and failed_fields."""
    return _page_load(spark, out_path).select(*RAW_FIELDS, "failed_fields")


def _page_load(spark: SparkSession, out_path: str) -> DataFrame:
    text = [T.StructField(n, T.StringType()) for n in ("file_path", "source", "failed_fields")]
    parts = [T.StructField("batch_id", T.LongType()), T.StructField("_good", T.BooleanType())]
    return spark.read.schema(T.StructType([*RAW_SCHEMA.fields, *text, *parts])).parquet(out_path)


def read_page_load(spark: SparkSession, out_path: str) -> DataFrame:
    """All records loaded so far by ``run_page_load``."""
    return _page_load(spark, out_path).where("_good").select(*RAW_FIELDS)


def read_page_rejects(spark: SparkSession, out_path: str) -> DataFrame:
    """What ``run_page_load`` could not load (toll_date, failed_fields, file_path, source)."""
    return pages.split_tagged(_page_load(spark, out_path).where("not _good"))[1]
