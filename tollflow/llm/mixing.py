"""Mixing sources to target weights by weighted fair queueing (DataFrame operations only).

Every source is a queue of its documents in a fixed shuffled order, and may be
run through at most ``max_epochs`` times.  A document's virtual finish time is
its source's words up to and including it, divided by the source's target.
All queue entries are put in the order of their finish time and served until
the total budget is spent.

Running sums never gather a source in one task: documents are dealt into fixed
ranges of the shuffle hash, range totals are summed, and a window only ever
holds one range of one source.  The global order works the same way over fixed
ranges of virtual time, so reruns and lost tasks cannot change the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollflow.llm.common import WORD, read_table, stored

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
RANGES = 1024       # shuffle-hash ranges per source
SLOTS = 4096        # slots per unit of virtual time
LAST_TIME = 4       # entries that finish later share the last slot
SEED = 20240607


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> source, source_size, target.

    Targets share ``share`` of all words by weight; a target stops at
    ``max_epochs`` times its source and the excess is shared anew.  That is
    least(cap, level * weight) for one common level: with sources in the order
    of cap / weight, it is the first level that leaves its own source uncapped.
    The table has one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])
    ranked = sizes.withColumn("weight", F.get(w, (F.row_number().over(by_name) - 1) % len(weights))) \
        .withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding,
                                                      Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * share
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    levels = ranked.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    first = F.first(fits, ignorenulls=True).over(
        by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return levels.withColumn("first", first).select(
        "source", "source_size",
        F.coalesce(F.least("cap", F.col("first") * F.col("weight")), F.col("cap")).alias("target"))


def mix(docs: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS,
        max_epochs: int = MAX_EPOCHS, ranges: int = RANGES, slots: int = SLOTS,
        seed: int = SEED, carry: tuple = ()) -> DataFrame:
    """One row per input row: doc_id, ``carry`` columns, source, size, source_size, target, times.

    ``times`` (0 to max_epochs) says how often the mix takes the row.  NULL
    sources form one source, last in order; NULL text has size 0; rows of size
    0 are never taken; repeated rows are queued once each; an empty table
    gives an empty result.  Columns other than doc_id, source and text are
    ignored.
    """
    counted = stored(docs.select("doc_id", *carry, "source", word_count(F.col("text")).alias("size"))
                     .withColumn("row", F.monotonically_increasing_id()), "mix-counted")
    # rows alike in source, doc_id and size are shuffled one by one, or all of them would share a place
    alike = counted.groupBy(F.col("source").alias("a_source"), F.col("doc_id").alias("a_id"),
                            F.col("size").alias("a_size")).agg(F.count("*").alias("alike")).where("alike > 1")
    sized = stored(counted.join(alike, F.col("source").eqNullSafe(F.col("a_source"))
                                & F.col("doc_id").eqNullSafe(F.col("a_id"))
                                & (F.col("size") == F.col("a_size")), "left")
                   .withColumn("u", F.when(F.col("alike").isNull(), F.xxhash64(F.lit(seed), "doc_id", "size"))
                               .otherwise(F.xxhash64(F.lit(seed), "doc_id", "size", "row")))
                   .withColumn("range", F.pmod(F.shiftright("u", 20), F.lit(ranges)).cast("int"))
                   .drop("a_source", "a_id", "a_size", "alike"), "mix-sizes")
    sums = sized.groupBy("source", "range").agg(F.sum("size").alias("words"))
    goals = stored(targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")),
                           share, weights, max_epochs), "mix-targets")

    # place in the source's queue: words of earlier ranges, plus the running sum in the range
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0))) \
        .select(F.col("source").alias("o_source"), F.col("range").alias("o_range"), "offset")
    goal = goals.withColumnRenamed("source", "g_source")
    offsets = offsets.join(goal, F.col("o_source").eqNullSafe(F.col("g_source"))).drop("g_source")
    inside = Window.partitionBy("source", "range").orderBy("u", "doc_id", "size", "row") \
        .rowsBetween(Window.unboundedPreceding, 0)
    queued = stored(
        sized.join(offsets, F.col("source").eqNullSafe(F.col("o_source"))
                   & (F.col("range") == F.col("o_range")))
        .withColumn("upto", F.col("offset") + F.sum("size").over(inside))
        .select("doc_id", *carry, "source", "size", "source_size", "target", "upto", "u", "row"),
        "mix-queues")

    # virtual finish times, dealt into fixed slots of virtual time; targets are reached at time 1
    passes = F.transform(F.sequence(F.lit(0), F.lit(max_epochs - 1)), lambda e: F.try_divide(
        (e * F.col("source_size") + F.col("upto")).cast("double"), F.col("target")))
    entries = queued.where("size > 0").withColumn("finish", F.explode(passes)).withColumn(
        "slot", F.least(F.floor(F.col("finish") * slots), F.lit(LAST_TIME * slots)).cast("long"))
    by_slot = entries.groupBy("slot").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0))
    budget = goals.agg(F.floor(F.sum("target") + 0.5).cast("long")).first()[0] or 0
    cut = by_slot.withColumn("upto", upto).where(F.col("upto") > budget).orderBy("slot").first()
    if cut is None:  # the budget covers every pass
        return queued.select("doc_id", *carry, "source", "size", "source_size", "target",
                             F.when(F.col("size") > 0, max_epochs).otherwise(0).alias("times"))
    # only the slot in which the budget ends needs its exact order
    in_order = Window.partitionBy("slot").orderBy("finish", "source", "u", "row").rowsBetween(
        Window.unboundedPreceding, 0)
    last = entries.where(F.col("slot") == cut["slot"]) \
        .withColumn("total", F.sum("size").over(in_order) + F.lit(cut["upto"] - cut["words"])) \
        .where(F.col("total") <= budget).groupBy("row").agg(F.count("*").alias("last_times"))
    full = F.size(F.filter(passes, lambda t: F.least(
        F.floor(t * slots), F.lit(LAST_TIME * slots)) < F.lit(cut["slot"])))
    return queued.join(last, "row", "left").select(
        "doc_id", *carry, "source", "size", "source_size", "target",
        F.when(F.col("size") > 0, full + F.coalesce("last_times", F.lit(0))).otherwise(0)
        .cast("int").alias("times"))


def op9_source_mixing(spark, sf_dir: str) -> DataFrame:
    """``mix`` over all documents with the production weights."""
    return mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("times")).cast("long").alias("taken"))
