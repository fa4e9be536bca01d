"""Hard-negative mining with spanning-tree bounds over the anchors.

A row's score for an anchor is their inner product in whole numbers.  An
anchor's positives are its best rows of the same label; a hard negative of a
positive is a row of another label whose score lies in a window below the
positive's score.

1. Anchors are dealt into groups; each group gets a minimum spanning tree.
   Rows are dealt by hash into blocks of equal size, kept as one packed row.
2. A task walks one group's tree over one block.  At a root all rows are
   scored.  Along an edge a score can change by at most the edge's length times
   the row's norm, so a child's scores are bounded by its parent's; only rows
   whose bounds meet the child's window are scored again.
3. Blocks are taken in waves, each eight times the one before.  What the
   earlier waves found is the lower end of the window in the next one, so an
   anchor gets a few rows back from a wave, however many blocks there are.

The first search finds the positives (one window without ends, same label), the
second the negatives (a window for each positive, other labels).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollflow.llm.common import finite_vector, read_table, stored

SCALE, POSITIVES, NEGATIVES = 256, 5, 10
LOW, HIGH = 30, 90            # window of a negative's score, in percent of the positive's
BLOCK, GROUP = 8192, 4096     # rows of a block, anchors of a tree
DEPTH = 64                    # edges after which all rows are scored again
WAVE = 8
END = (1 << 63) - 1           # of a window without ends


def spanning_tree(x: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge) of a minimum spanning tree: parents stand before their children.

    ``parent`` counts places of the order, -1 for roots: the first node, and
    every node that lies ``depth`` edges below a root.
    """
    n, near = len(x), np.full(len(x), np.inf)
    out, by = np.zeros(n, bool), np.full(n, -1)
    square, now = (x * x).sum(1), 0
    kids = [[] for _ in range(n)]
    for _ in range(n - 1):
        out[now] = True
        far = np.maximum(square + square[now] - 2 * (x @ x[now]), 0)
        closer = far < near
        near[closer], by[closer] = far[closer], now
        near[out] = np.inf
        following = int(np.argmin(near)) if np.isfinite(near).any() else int(np.flatnonzero(~out)[0])
        kids[by[following] if by[following] >= 0 else now].append(following)
        now = following
    order, parent, todo, place = [], [], [(0, -1, 0)], {}
    later = []
    while todo or later:
        node, above, deep = todo.pop() if todo else (later.pop(), -1, 0)
        if deep == depth:              # its own tree, walked once this one is done
            later.append(node)
            continue
        place[node] = len(order)
        order.append(node)
        parent.append(above)
        todo += [(k, place[node], deep + 1) for k in reversed(kids[node])]
    order, parent = np.array(order, int), np.array(parent, int)
    edge = np.linalg.norm(x[order] - x[order[np.maximum(parent, 0)]], axis=1)
    return order, parent, np.where(parent < 0, 0.0, edge)


def _trees(rows: pd.DataFrame) -> pd.DataFrame:
    order, parent, edge = spanning_tree(np.stack(list(rows["x"])).astype(float))
    return rows.iloc[order].assign(seq=np.arange(len(order)), parent=parent, edge=edge)


def _pack_block(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame([{"dim": rows["dim"].iloc[0], "block": rows["block"].iloc[0],
                          "rows": rows["row"].to_numpy(), "ids": rows["vec_id"].to_numpy(),
                          "labels": rows["label"].to_numpy(), "x": np.concatenate(list(rows["x"]))}])


def _pack_group(shares: tuple[int, int] | None):
    """One row per group: its tree, and the windows of its anchors as flat arrays."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("seq")
        flat = [(at, w["window"], w["centre"], w["least"], w["least_id"])
                for at, ws in enumerate(rows["windows"]) for w in (ws if ws is not None else ())]
        ends = [(-END, END) if shares is None else
                (-(-shares[0] * int(c) // 100), shares[1] * int(c) // 100) for _, _, c, _, _ in flat]
        return pd.DataFrame([{
            "dim": rows["dim"].iloc[0], "group": rows["group"].iloc[0], "anchors": rows["row"].to_numpy(),
            "labels": rows["label"].to_numpy(), "parent": rows["parent"].to_numpy(),
            "edge": rows["edge"].to_numpy(), "x": np.concatenate(list(rows["x"])),
            "at": [f[0] for f in flat], "window": [f[1] for f in flat],
            "low": [e[0] for e in ends], "high": [e[1] for e in ends],
            "least": [-END if f[3] is None else f[3] for f in flat],
            "least_id": [END if f[4] is None else f[4] for f in flat]}])
    return run


def walk(group, block, same: bool, k: int, counts: dict | None = None):
    """(anchor place, window place, block place, score) of the k best rows of every window.

    ``counts`` receives how many scores were asked for and how many were computed.
    """
    d = int(block["dim"])
    x, a = (np.asarray(s["x"], np.int64).reshape(-1, d) for s in (block, group))
    fx, fa = x.astype(float), a.astype(float)
    norms = np.sqrt((fx * fx).sum(1)) * (1 + 1e-9)
    small = norms.max() * np.sqrt((fa * fa).sum(1).max()) < 2.0 ** 52     # products exact as doubles
    rows, ids, labels, own = (np.asarray(c) for c in (
        block["rows"], block["ids"], block["labels"], group["labels"]))
    parent, edge, anchors = (np.asarray(group[c]) for c in ("parent", "edge", "anchors"))
    at, low, high, least, least_id = (np.asarray(group[c], np.int64) for c in (
        "at", "low", "high", "least", "least_id"))
    begin, end = np.searchsorted(at, np.arange(len(a))), np.searchsorted(at, np.arange(len(a)), "right")
    left = np.bincount(parent[parent >= 0], minlength=len(a))
    held, out = {}, []

    def score(place, c):
        return (fx[place] @ fa[c]).astype(np.int64) if small else x[place] @ a[c]

    for c, p in enumerate(parent.tolist()):
        span = slice(begin[c], end[c])
        fits = (labels == own[c]) if same else (labels != own[c])
        if p < 0:
            exact = score(slice(None), c)
            middle, room = exact.astype(float), np.abs(exact) * 2.0 ** -50
            place = np.flatnonzero(fits)
            exact = exact[place]
            scored = len(x)
        else:
            middle, room = held[p]
            left[p] -= 1
            if not left[p]:
                del held[p]
            room = room + edge[c] * norms + 1e-6
            place = exact = np.zeros(0, np.int64)
            if begin[c] < end[c]:
                floor = float(np.maximum(low[span], least[span]).min())
                place = np.flatnonzero(fits & (middle + room >= floor) & (middle - room <= float(high[span].max())))
                exact, middle = score(place, c), middle.copy()
                middle[place], room[place] = exact, np.abs(exact) * 2.0 ** -50
            scored = len(place)
        if counts is not None:
            counts["asked"] = counts.get("asked", 0) + len(x)
            counts["scored"] = counts.get("scored", 0) + scored
        if left[c]:
            held[c] = middle, room
        for w in range(begin[c], end[c]):
            good = (exact >= low[w]) & (exact <= high[w]) & (rows[place] != anchors[c]) & (
                (exact > least[w]) | (exact == least[w]) & (ids[place] < least_id[w]))
            some, s = place[good], exact[good]
            if len(s) > k:                               # drop what is below the k-th, ties stay
                over = s >= np.partition(s, len(s) - k)[len(s) - k]
                some, s = some[over], s[over]
            by = np.lexsort((rows[some], ids[some], -s))[:k]
            out.append((np.full(len(by), c), np.full(len(by), w), some[by], s[by]))
    return [np.concatenate(z) for z in zip(*out)] if out else [np.zeros(0, np.int64)] * 4


def _task(same: bool, k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame(columns=["anchor", "window", "score", "vec_id", "row"])
        block, group = left.iloc[0], right.iloc[0]
        c, w, place, s = walk(group, block, same, k)
        return pd.DataFrame({"anchor": np.asarray(group["anchors"])[c], "window": np.asarray(group["window"], int)[w],
                             "score": s, "vec_id": np.asarray(block["ids"])[place],
                             "row": np.asarray(block["rows"])[place]})
    return run


class _Search:
    """Packed blocks and anchor trees, searched wave by wave."""

    def __init__(self, rows: DataFrame, block: int, group: int):
        n, m = rows.agg(F.count("*"), F.count(F.when(F.col("is_anchor"), 1))).first()
        self.n_blocks, self.n_groups = max(1, -(-n // block)), max(1, -(-m // group))
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(self.n_blocks)).cast("int"))
        self.blocks = stored(dealt.groupBy("dim", "block").applyInPandas(
            _pack_block, "dim int, block int, rows array<long>, ids array<long>, labels array<long>, "
                         "x array<long>"), "negatives-blocks")
        grouped = rows.where("is_anchor").select(
            "dim", F.pmod(F.xxhash64("row"), F.lit(self.n_groups)).cast("int").alias("group"),
            "row", "label", "x")
        self.trees = stored(grouped.groupBy("dim", "group").applyInPandas(
            _trees, "dim int, group int, row long, label long, x array<long>, seq int, parent int, "
                    "edge double"), "negatives-trees")

    def best(self, windows: DataFrame, same: bool, k: int, shares=None) -> DataFrame:
        """(anchor, window, score, vec_id, row, n) of the k best of every window (anchor, window, centre)."""
        best, done, upto = None, 0, 1
        order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id", "row")
        while done < self.n_blocks:
            upto = min(upto, self.n_blocks)
            least = windows.select("*", F.lit(None).cast("long").alias("least"),
                                   F.lit(None).cast("long").alias("least_id")) if best is None else \
                windows.join(best.where(F.col("n") == k).select(
                    "anchor", "window", F.col("score").alias("least"), F.col("vec_id").alias("least_id")),
                    ["anchor", "window"], "left")
            lists = least.groupBy(F.col("anchor").alias("_a")).agg(F.sort_array(F.collect_list(
                F.struct("window", "centre", "least", "least_id"))).alias("windows"))     # a few each
            groups = self.trees.join(lists, F.col("row") == F.col("_a"), "left").drop("_a") \
                .groupBy("dim", "group").applyInPandas(
                    _pack_group(shares), "dim int, group int, anchors array<long>, labels array<long>, "
                    "parent array<int>, edge array<double>, x array<long>, at array<int>, "
                    "window array<int>, low array<long>, high array<long>, least array<long>, "
                    "least_id array<long>")
            left = self.blocks.where(F.col("block").between(done, upto - 1)).withColumn(
                "group", F.explode(F.sequence(F.lit(0), F.lit(self.n_groups - 1))))
            right = groups.withColumn("block", F.explode(F.sequence(F.lit(done), F.lit(upto - 1))))
            key = ["dim", "group", "block"]
            found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
                _task(same, k), "anchor long, window int, score long, vec_id long, row long")
            if best is not None:
                found = best.drop("n").unionByName(found)
            best = stored(found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k),
                          "negatives-best")
            done, upto = upto, upto * WAVE
        return best


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, scale: int = SCALE, block: int = BLOCK,
         group: int = GROUP) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Needs vec_id, embedding and an integral label; ``is_anchor`` is a condition
    on them.  Entries become floor(scale * x); a score is an inner product of
    those.  For every anchor row and each of its best ``positives`` other rows
    of its label, the best ``negatives`` rows of other labels whose score lies
    in [low, high] percent of the positive's.  Equal scores go by the smaller
    vec_id; fewer are returned where there are fewer.  Rows whose vec_id, label
    or vector is NULL, and vectors that are empty or hold a NULL or non-finite
    component, take no part, nor do vectors so large that a score would not fit
    a long.  Vectors of different lengths never meet.  Rows that repeat a
    vec_id are rows of their own.  An empty table gives no rows.
    """
    x = F.transform(finite_vector(), lambda c: F.floor(c * scale))
    square = F.aggregate(finite_vector(), F.lit(0.0), lambda s, c: s + F.floor(c * scale).cast("double")
                         * F.floor(c * scale).cast("double"))
    rows = stored(vectors.where("vec_id is not null and label is not null").where(
        F.coalesce(square < 2.0 ** 61, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        x.alias("x"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
        .withColumn("dim", F.size("x")).withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    search = _Search(rows, block, group)
    anchors = rows.where("is_anchor").select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    best = search.best(anchors.select("anchor", F.lit(0).alias("window"),
                                      F.lit(0).cast("long").alias("centre")), True, positives)
    pairs = best.select("anchor", F.col("n").alias("window"), F.col("score").alias("centre"),
                        F.col("vec_id").alias("positive_id"))
    found = search.best(pairs.drop("positive_id"), False, negatives, (low, high))
    return found.join(pairs, ["anchor", "window"]).join(anchors, "anchor").select(
        "anchor_id", "positive_id", F.col("n").alias("rank"), F.col("vec_id").alias("negative_id"),
        F.col("centre").alias("positive_score"), F.col("score").alias("negative_score"))


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """``mine`` of all embeddings for every 100th vec_id, with the label of every 7th moved on by one."""
    rows = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)
