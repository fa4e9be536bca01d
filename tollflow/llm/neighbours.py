"""Approximate nearest neighbours by a forest of random-projection trees.

1. Equal vectors are reduced to one node that keeps its smallest vec_ids.
2. Trees are fitted on a bounded sample of unit vectors: a node's plane is
   normal to the difference of two random members and cuts at their median.
   Every node of the whole table is filed in one leaf of each tree.
3. A query walks all trees through one priority queue.  An entry is a subtree
   with the sum of squared distances to the planes that the way to it crosses;
   the least is taken next.  The first ``near`` leaves give the query a score
   of its k-th neighbour, and with it a radius; the queue then goes on to every
   leaf whose sum lies within ``slack`` times the squared radius.  Clustered
   vectors so end after a few leaves, shapeless ones look at most of them.
4. Leaves are compared with their queries in tiles of bounded size; candidates
   are reranked by the exact cosine of the original vectors.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollflow.llm.common import finite_vector, hash_share, read_table, stored

K, TREES = 5, 3
FIT_ROWS = 16_384          # vectors the planes are fitted on, chosen by hash
LEAF = 256                 # sampled vectors in a leaf
NEAR, SLACK = 3, 0.025     # leaves before the radius is known; share of its square searched then
ROW_TILE, QUERY_TILE = 8192, 8192
ALMOST = 1e-9              # products this close to the last place are scored exactly
LEAF_KEY = ["dim", "tree", "leaf"]


def matrix(vectors) -> np.ndarray:
    """Rows of doubles; rows of extreme size are scaled by a power of two, which changes no cosine."""
    x = np.stack(list(vectors)).astype(float)
    top = np.abs(x).max(1)
    odd = (top > 1e140) | (top < 1e-140)
    if odd.any():
        x[odd] = np.ldexp(x[odd], -np.frexp(top[odd])[1][:, None])
    return x


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


@dataclass
class Forest:
    """Complete trees of equal depth: planes and cuts by tree and node (1 is a root)."""
    planes: np.ndarray
    cuts: np.ndarray
    depth: int

    @classmethod
    def fit(cls, sample: np.ndarray, trees: int, leaf: int, seed: int = 7) -> Forest:
        rng, d = np.random.default_rng(seed), sample.shape[1]
        depth = max(0, int(np.ceil(np.log2(max(len(sample) / leaf, 1)))))
        planes, cuts = np.zeros((trees, 1 << depth, d)), np.zeros((trees, 1 << depth))
        for t in range(trees):
            members = {1: np.arange(len(sample))}
            for node in range(1, 1 << depth):
                at = members.pop(node)
                normal = np.zeros(d)
                if len(at) > 1:
                    a, b = rng.choice(at, 2, replace=False)
                    normal = sample[a] - sample[b]
                    normal /= np.linalg.norm(normal) or 1.0
                height = sample[at] @ normal
                planes[t, node], cuts[t, node] = normal, np.median(height) if len(at) else 0.0
                members[2 * node] = at[height < cuts[t, node]]
                members[2 * node + 1] = at[height >= cuts[t, node]]
        return cls(planes, cuts, depth)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row in every tree."""
        out = np.empty((len(x), len(self.planes)), np.int32)
        for t, (planes, cuts) in enumerate(zip(self.planes, self.cuts)):
            node = np.ones(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + (np.einsum("ij,ij->i", x, planes[node]) >= cuts[node])
            out[:, t] = node - (1 << self.depth)
        return out

    def search(self, query: np.ndarray, near: int, limit: float | None) -> list[tuple[int, int]]:
        """(tree, leaf) by rising sum: the first ``near``, or with a limit all others within it."""
        return self._walk((self.planes @ query - self.cuts).tolist(), near, limit)

    def _walk(self, heights, near, limit):
        first_leaf, found = 1 << self.depth, []
        queue = [(0.0, t, 1) for t in range(len(heights))]
        while queue and (limit is not None or len(found) < near):
            far, t, node = heapq.heappop(queue)
            if limit is not None and len(found) >= near and far > limit:
                break
            while node < first_leaf:
                h = heights[t][node]
                node = 2 * node + (h >= 0)
                heapq.heappush(queue, (far + h * h, t, node ^ 1))
            found.append((t, node - first_leaf))
        return found[near:] if limit is not None else found


def _fit(nodes: DataFrame, fit_rows: int, trees: int, leaf: int) -> dict[int, Forest]:
    n = nodes.count()
    rows = nodes.where(hash_share("node") < min(1.0, 1.1 * fit_rows / max(n, 1))) \
        .select("v").limit(2 * fit_rows).toPandas()
    return {int(d): Forest.fit(unit(matrix(part)), trees, leaf)
            for d, part in rows["v"].groupby(rows["v"].map(len))}


def _filed(nodes: DataFrame, forests: dict[int, Forest]) -> DataFrame:
    """Every node once per tree.  A length that the sample lacks has a single leaf."""
    def run(batches):
        for batch in batches:
            for d, part in batch.groupby(batch["v"].map(len)):
                forest, x = forests.get(int(d)), unit(matrix(part["v"]))
                leaf = forest.leaves(x) if forest else np.zeros((len(x), 1), np.int32)
                for t in range(leaf.shape[1]):
                    yield pd.DataFrame({"dim": np.int32(d), "tree": np.int32(t), "leaf": leaf[:, t],
                                        "node": part["node"], "least": part["least"], "v": part["v"]})
    return nodes.select("node", "least", "v").mapInPandas(
        run, f"dim int, tree int, leaf int, node long, least long, v {_type(nodes)}")


def _type(nodes: DataFrame) -> str:
    return nodes.schema["v"].dataType.simpleString()


def _asked(queries: DataFrame, forests: dict[int, Forest], near: int, slack: float | None) -> DataFrame:
    """Every query once per leaf that it visits (columns node, v, floor: the score it has already)."""
    def run(batches):
        for batch in batches:
            for d, part in batch.groupby(batch["v"].map(len)):
                forest, out = forests.get(int(d)), []
                for i, (x, floor) in enumerate(zip(unit(matrix(part["v"])), part["floor"])):
                    limit = None if slack is None else slack * (2 - 2 * floor) if floor > -1.5 else np.inf
                    visits = forest.search(x, near, limit) if forest else [(0, 0)] if slack is None else []
                    out += [(i, *v) for v in visits]
                at, tree, leaf = np.array(out, np.int32).reshape(-1, 3).T
                rows = part.iloc[at]
                yield pd.DataFrame({"dim": np.int32(d), "tree": tree, "leaf": leaf,
                                    "node": rows["node"].to_numpy(), "floor": rows["floor"].to_numpy(),
                                    "v": rows["v"].to_numpy()})
    return queries.select("node", "floor", "v").mapInPandas(
        run, f"dim int, tree int, leaf int, node long, floor double, v {_type(queries)}")


def _rerank(k: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The k best rows of ``left`` for every query of ``right``: exact cosine, then the least vec_id."""
        out = []
        if len(left) and len(right):
            x, y = matrix(left["v"]), matrix(right["v"])
            nx, ny = (np.sqrt(np.einsum("ij,ij->i", m, m)) for m in (x, y))
            ux, least, keep = x / nx[:, None], left["least"].to_numpy(), min(k, len(x))
            floor = right["floor"].to_numpy()
            for lo in range(0, len(y), 512):
                q = slice(lo, lo + 512)
                near = (y[q] / ny[q, None]) @ ux.T
                last = np.partition(near, len(x) - keep, axis=1)[:, len(x) - keep]
                i, j = np.nonzero(near >= np.maximum(last, floor[q])[:, None] - ALMOST)
                i = i + lo
                score = np.einsum("ij,ij->i", y[i], x[j]) / (ny[i] * nx[j])
                by = np.lexsort((least[j], -score, i))
                i, j, score = i[by], j[by], score[by]
                start = np.searchsorted(i, i)              # of each query's run
                top = np.arange(len(i)) - start < keep
                out.append((i[top], j[top], score[top]))
        i, j, score = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, int),) * 3
        return pd.DataFrame({"query": right["node"].to_numpy()[i], "node": left["node"].to_numpy()[j],
                             "least": left["least"].to_numpy()[j], "score": score.astype(float)})
    return run


def _visited(filed: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query, node, least, score): the k best of every visited leaf, compared in tiles of bounded size."""
    size = filed.groupBy(*LEAF_KEY).agg(F.ceil(F.count("*") / ROW_TILE).cast("int").alias("row_parts"))
    size = stored(size.join(asked.groupBy(*LEAF_KEY).agg(
        F.ceil(F.count("*") / QUERY_TILE).cast("int").alias("query_parts")), LEAF_KEY), "ann-tiles")

    def dealt(df, own, other, own_part, other_part):
        return df.join(size, LEAF_KEY) \
            .withColumn(own_part, F.pmod(F.xxhash64("node"), F.col(own)).cast("int")) \
            .withColumn(other_part, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop(own, other)
    rows = dealt(filed, "row_parts", "query_parts", "rp", "qp")
    queries = dealt(asked, "query_parts", "row_parts", "qp", "rp")
    key = [*LEAF_KEY, "rp", "qp"]
    return rows.groupBy(*key).cogroup(queries.groupBy(*key)).applyInPandas(
        _rerank(k), "query long, node long, least long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best nodes of every query; a node found in several trees counts once."""
    once = found.groupBy("query", "node", "least").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "least", "node")
    return once.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).drop("n")


def nearest(vectors: DataFrame, is_query: Column, k: int = K, trees: int = TREES, slack: float = SLACK,
            fit_rows: int = FIT_ROWS, leaf: int = LEAF, near: int = NEAR) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of every query row, all if fewer.

    Needs vec_id and embedding; ``is_query`` is a condition on them.  Rows with
    a NULL vec_id, and vectors that are NULL, empty, zero, or hold a NULL or
    non-finite component, take no part.  Vectors of different lengths are never
    compared.  Rows that repeat a vec_id or a vector are rows of their own; only
    the query's own row is left out.  Equal scores go by the smaller vec_id.
    An empty table gives no rows.
    """
    k1 = k + 1                                 # one more, as a query's own row is among the rows
    usable = F.exists(finite_vector(), lambda c: c != 0)
    rows = stored(vectors.where("vec_id is not null").where(F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.col("embedding").alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
        .withColumn("row", F.monotonically_increasing_id()), "ann-rows")
    # of equal vectors only the k + 1 smallest vec_ids can be among the k nearest
    order = Window.partitionBy("v").orderBy("vec_id", "row")
    few = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k1)
    nodes = stored(few.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("vec_id", "row"))).alias("members"))
                   .withColumn("least", F.col("members")[0]["vec_id"])
                   .withColumn("node", F.col("members")[0]["row"]), "ann-nodes")
    questions = stored(rows.where("asks").select("vec_id", "row", "v").join(
        nodes.select("v", "node"), "v"), "ann-questions")
    queries = stored(questions.groupBy("node").agg(F.first("v").alias("v")), "ann-queries")
    forests = _fit(nodes, fit_rows, trees, leaf)
    filed = stored(_filed(nodes, forests), "ann-filed")

    asked = stored(_asked(queries.withColumn("floor", F.lit(-2.0)), forests, near, None), "ann-asked")
    first = stored(_best(_visited(filed, asked, k1), k1), "ann-near")
    floors = first.groupBy(F.col("query").alias("_q")).agg(
        F.when(F.count("*") == k1, F.min("score")).alias("floor"))
    wider = queries.join(floors, F.col("node") == F.col("_q"), "left") \
        .select("node", "v", F.coalesce("floor", F.lit(-2.0)).alias("floor"))
    asked = stored(_asked(wider, forests, near, slack), "ann-asked-far")
    best = stored(_best(first.unionByName(_visited(filed, asked, k1)), k1), "ann-best")

    members = best.join(nodes.select(F.col("node").alias("_n"), "members"), F.col("node") == F.col("_n")) \
        .select("query", "score", F.explode("members").alias("m"))
    lists = members.groupBy("query").agg(F.slice(F.sort_array(F.collect_list(F.struct(   # (k + 1)^2 at most
        (-F.col("score")).alias("minus"), "m.vec_id", "m.row", "score"))), 1, k1).alias("found"))
    own = questions.select(F.col("vec_id").alias("query_id"), "row", F.col("node").alias("_n"))
    return own.join(lists, F.col("_n") == F.col("query")).select(
        "query_id", F.posexplode(F.slice(F.filter("found", lambda f: f["row"] != F.col("row")), 1, k))
        .alias("at", "f")).select("query_id", (F.col("at") + 1).alias("rank"),
                                  F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score"))


def op12_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """``nearest`` of all embeddings for every 50th vec_id, five neighbours each."""
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
