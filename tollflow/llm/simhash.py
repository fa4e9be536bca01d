"""SimHash near-dedup with a Gray-order hierarchical index.

1. A document's fingerprint has the bits that are set in over half of its
   shingle hashes.  Equal fingerprints are reduced to one row first.
2. Two fingerprints within ``distance`` bits agree in at least ``BLOCKS -
   distance`` of the BLOCKS bit blocks, so each fingerprint is filed once per
   choice of that many blocks under its masked pattern; linked fingerprints
   meet under one pattern at least.  Nothing is missed.
3. A task holds the fingerprints of many patterns, sorted by the Gray ranks of
   pattern and fingerprint, and builds one index over that order: a node stores
   the bits that all fingerprints below it share and that its parent does not
   store, so the patterns' own bits stand in the upper nodes.  Every fingerprint
   is a query.  It adds up its differing bits from the root down and leaves a
   whole group as soon as they exceed the distance, or as soon as a bit of the
   pattern differs (those pairs meet under another pattern).
4. A pattern with more than ``split`` fingerprints is dealt into parts by hash,
   and every two parts form one task, so no task holds a whole hot pattern.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollflow.llm.common import read_table, stored
from tollflow.llm.graph import LocalSets, component_minimum

SHINGLE, DISTANCE, SEED = 4, 4, 42
BLOCKS = 6
SPLIT = 4096
LEAF, FANOUT, QUERIES = 16, 8, 512


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash; 0 for a text without words."""
    words = (text or "").encode().lower().split()     # bytes: only A-Z change, only ASCII space splits
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):                      # bounded memory for very long texts
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(
            starts[at:min(at + 65536, n)].tolist(),
            ends[at + k - 1:min(at + 65536, n) + k - 1].tolist())], dtype=np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(0, dtype=np.int64)
    return int((ones * 2 > n) @ (1 << np.arange(64, dtype=object)))


def fingerprint_column(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle, seed) for t in texts],
                                  dtype=np.uint64).view(np.int64))
    return hashed(text)


def _masks(blocks: int, distance: int) -> list[int]:
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    block = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(blocks)]
    masks = [sum(block[i] for i in pick) for pick in combinations(range(blocks), blocks - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _gray_rank(c: Column) -> Column:
    """Rank of a bit pattern in Gray-code order, as a signed long in unsigned order."""
    for step in (1, 2, 4, 8, 16, 32):
        c = c.bitwiseXOR(F.shiftrightunsigned(c, step))
    return c.bitwiseXOR(F.lit(-(1 << 63)))


class GrayIndex:
    """Index over fingerprints in Gray order; ``levels`` from the leaves up."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        starts = np.arange(0, len(rows), LEAF)
        first = rows[starts]
        varying = np.bitwise_or.reduceat(rows ^ np.repeat(first, LEAF)[:len(rows)], starts)
        self.levels = [(first, ~varying)]
        while len(first) > FANOUT:
            starts = np.arange(0, len(first), FANOUT)
            up = first[starts]
            varying = np.bitwise_or.reduceat(
                varying | (first ^ np.repeat(up, FANOUT)[:len(first)]), starts)
            first = up
            self.levels.append((first, ~varying))
        # a node keeps only the shared bits that its parent has not stored already
        self.own = [shared & ~np.repeat(self.levels[i + 1][1], FANOUT)[:len(shared)]
                    if i + 1 < len(self.levels) else shared
                    for i, (_, shared) in enumerate(self.levels)]

    def labels(self, root: np.ndarray) -> list[np.ndarray]:
        """Per level and node: the set all rows below belong to, or -1."""
        out, size, now = [], LEAF, root
        for _ in self.levels:
            starts = np.arange(0, len(now), size)
            low, high = np.minimum.reduceat(now, starts), np.maximum.reduceat(now, starts)
            now = np.where(low == high, low, -1)
            out.append(now)
            size = FANOUT
        return out

    def search(self, queries: np.ndarray, distance: int, pattern: int, sets: np.ndarray,
               labels: list[np.ndarray], counts: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) pairs within ``distance`` that agree in the bits of ``pattern``.

        Groups that already are in the query's set are left out.  ``counts``
        receives the nodes looked at, those left whole, and the rows compared.
        """
        top, fixed = len(self.levels) - 1, np.uint64(pattern)
        width = len(self.levels[top][0])
        q, node = np.repeat(np.arange(len(queries)), width), np.tile(np.arange(width), len(queries))
        gone = np.zeros(len(q), np.uint8)
        for level in range(top, -1, -1):
            first, _ = self.levels[level]
            differ = (queries[q] ^ first[node]) & self.own[level][node]
            gone = gone + np.bitwise_count(differ)
            live = (gone <= distance) & (differ & fixed == 0) & (labels[level][node] != sets[q])
            if counts is not None:
                counts["nodes"] = counts.get("nodes", 0) + len(live)
                counts["pruned"] = counts.get("pruned", 0) + int(len(live) - live.sum())
            q, node, gone = q[live], node[live], gone[live]
            fan = FANOUT if level else LEAF
            limit = len(self.levels[level - 1][0]) if level else len(self.rows)
            if not level:
                rest = ~self.levels[0][1][node]
                rest = np.repeat(rest, fan)
            q, gone = np.repeat(q, fan), np.repeat(gone, fan)
            node = (node[:, None] * fan + np.arange(fan)).ravel()
            inside = node < limit
            if not level:
                rest = rest[inside]
            q, node, gone = q[inside], node[inside], gone[inside]
        if counts is not None:
            counts["compared"] = counts.get("compared", 0) + len(q)
        differ = (queries[q] ^ self.rows[node]) & rest
        near = (gone + np.bitwise_count(differ) <= distance) & (differ & fixed == 0)
        return q[near], node[near]


def linked(rows: np.ndarray, side: np.ndarray, distance: int, pattern: int = 0,
           counts: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the rows as all links between rows with equal bits of ``pattern`` do.

    ``rows`` stand in Gray order.  ``side``: 0 or 1; if both occur, only rows of
    different sides are compared (the pairs within a side belong to another task).
    """
    n = len(rows)
    both = side.any() and not side.all()
    a_at = np.flatnonzero(side == 0) if both else np.arange(n)
    b_at = np.flatnonzero(side == 1) if both else a_at
    sets, index = LocalSets(n), GrayIndex(rows[b_at])
    # neighbours in Gray order first: what they connect need not be searched again
    for off in (1, 2, 3):
        close = (np.bitwise_count(rows[:-off] ^ rows[off:]) <= distance) & (
            (side[:-off] != side[off:]) if both else True)
        at = np.flatnonzero(close)
        sets.union(at, at + off)
    for lo in range(0, len(a_at), QUERIES):
        part = a_at[lo:lo + QUERIES]
        root = sets.roots()
        q, r = index.search(rows[part], distance, pattern, root[part], index.labels(root[b_at]), counts)
        sets.union(part[q], b_at[r])
    root = sets.roots()
    at = np.flatnonzero(root != np.arange(n))
    return at, root[at]


def runs(keys: np.ndarray) -> np.ndarray:
    """Where a new index begins, for rows of (t, key, i, j): at a new t, and around each group
    whose two sides are compared (i < j)."""
    t, i, j = keys[:, 0], keys[:, 2], keys[:, 3]
    other = (keys[1:] != keys[:-1]).any(1)
    new = (t[1:] != t[:-1]) | (other & ((i != j)[1:] | (i != j)[:-1]))
    return np.flatnonzero(np.concatenate(([True], new)))


def _tasks(distance: int, masks: list[int]):
    """mapInPandas function: partitions sorted by group and Gray rank -> edges (a, b)."""
    patterns = [m & ((1 << 64) - 1) for m in masks]

    def links(batches):
        names = ["t", "key", "i", "j"]
        held = None
        for batch in batches:
            if held is not None:
                batch = pd.concat([held, batch], ignore_index=True)
            if batch.empty:
                continue
            k = batch[names].to_numpy()
            last = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]).any(1))))[-1]
            held = batch.iloc[last:]                   # its group may go on in the next batch
            yield from found(batch.iloc[:last], k[:last])
        if held is not None:
            yield from found(held, held[names].to_numpy())

    def found(batch, k):
        if batch.empty:
            return
        fp, side = batch["fp"].to_numpy().view(np.uint64), batch["side"].to_numpy()
        starts = runs(k)
        for s, e in zip(starts, np.append(starts[1:], len(k))):
            a, b = linked(fp[s:e], side[s:e], distance, patterns[k[s, 0]])
            if len(a):
                signed = fp[s:e].view(np.int64)
                yield pd.DataFrame({"a": signed[a], "b": signed[b]})
    return links


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                    split: int = SPLIT, carry: tuple = ()) -> DataFrame:
    """doc_id, ``carry`` columns, fingerprint, component_id, group; one row per input row.

    ``fingerprint`` and ``group`` (the same for all of a component) are longs.

    Texts without words have fingerprint 0 and are linked like any other.
    Rows without doc_id take part in links; component_id is the smallest
    non-NULL doc_id reachable.  Other columns are ignored.
    """
    prints = stored(docs.select(
        "doc_id", *carry, fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash-prints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("value")), "simhash-nodes")
    masks = _masks(max(BLOCKS, distance + 1), distance)
    filed = nodes.select("fp", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("t", "key"))
    hot = stored(filed.groupBy("t", "key").count().where(F.col("count") > split).select(
        F.col("t").alias("_t"), F.col("key").alias("_key"),
        F.ceil(F.col("count") / split).cast("int").alias("parts")), "simhash-hot")
    parts = F.coalesce("parts", F.lit(1))
    dealt = filed.join(hot, (F.col("t") == F.col("_t")) & (F.col("key") == F.col("_key")), "left") \
        .withColumn("parts", parts) \
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .select("t", "key", F.least("part", "other").alias("i"),
                F.greatest("part", "other").alias("j"), "fp",
                (F.col("part") > F.col("other")).cast("int").alias("side"))
    ranked = dealt.repartition("t", "key", "i", "j").sortWithinPartitions(
        "t", _gray_rank(F.col("key")), "i", "j", _gray_rank(F.col("fp")))
    edges = stored(ranked.mapInPandas(_tasks(distance, masks), "a long, b long"), "simhash-edges")
    groups = component_minimum(nodes.withColumnRenamed("fp", "node"), edges, "simhash-groups")
    return prints.join(groups, F.col("fp") == F.col("node")).select(
        "doc_id", *carry, F.col("fp").alias("fingerprint"),
        F.col("component").alias("component_id"), F.col("root").alias("group"))


def op6_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """``near_duplicates`` of all documents, 4-word shingles, at most 4 differing bits."""
    return near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id")
