"""Embedding near-dedup by PCA-ordered tiled comparison.

1. Equal vectors of a label are reduced to one row with their count.
2. Unit vectors are rotated onto principal axes (from the sum of their outer
   products, the only thing the driver sees; a rotation changes no cosine), so
   leading dimensions carry most of a product.
3. Vectors are dealt into tiles of about ``tile`` rows within cells of the
   first axis.  Unit vectors that link differ by at most sqrt(2 - 2 t) on any
   axis, so only tiles whose bounding boxes come that close are compared.
4. Two tiles are compared in stages: products over the leading dimensions,
   plus the product of the suffix norms as a bound on the rest.  A pair is left
   as soon as it cannot reach the threshold.

A tile task returns, per vector, its number of links and one edge to its local
group, never the list of all links.  Only pairs within rounding of the
threshold are returned one by one; they are decided by the vectors as given.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollflow.llm.common import read_table, stored
from tollflow.llm.graph import LocalSets, component_minimum
from tollflow.llm.neighbours import matrix, unit
from tollflow.llm.whitening import matrix_sums

THRESHOLD = 0.93
TILE = 4096
BLOCK = 512                # rows of a tile whose products are held at a time
LONGEST_FIT = 2048         # longer vectors are compared on their own axes
STAGES = (8, 24)           # dimensions after which the bound is applied
NEAR = 1e-9                # products this close to the threshold are computed again, unrotated


def fit_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes (columns, by falling variance) for every vector length, over all vectors."""
    sums = matrix_sums(vectors.select(F.col("embedding").alias("x")), lambda d, x: unit(matrix(x)), float, LONGEST_FIT)
    return {d: np.linalg.eigh(found["square"])[1][:, ::-1] for d, found in sums.items()}


def _rotated(axes: dict[int, np.ndarray]):
    """mapInPandas: adds the rotated unit vector (float64 bytes) and its first coordinate."""
    def run(batches):
        for batch in batches:
            for d, part in batch.groupby(batch["embedding"].map(len)):
                x = unit(matrix(part["embedding"]))
                x = x @ axes[d] if d in axes else x
                yield pd.DataFrame({
                    "node": part["node"], "copies": part["copies"], "label": part["label"],
                    "dim": np.int32(d), "vec": [v.tobytes() for v in x], "first": x[:, 0]})
    return run


def tile_links(a: np.ndarray, b: np.ndarray, threshold: float, upper: bool):
    """(i, j, close) with a product >= threshold between the rows of two tiles; ``upper``: i < j only.

    ``close`` marks products so near to the threshold that rounding may decide.
    """
    found = [_block_links(a[lo:lo + BLOCK], b, threshold, lo if upper else None)
             for lo in range(0, len(a), BLOCK)]
    i, j, close = (np.concatenate(x) for x in zip(*found))
    return i + np.repeat(np.arange(0, len(a), BLOCK), [len(f[0]) for f in found]), j, close


def _block_links(a, b, threshold, diagonal):
    ends = [e for e in STAGES if e < a.shape[1]] + [a.shape[1]]
    product = a[:, :ends[0]] @ b[:, :ends[0]].T
    rest = np.linalg.norm(a[:, ends[0]:], axis=1)[:, None] * np.linalg.norm(b[:, ends[0]:], axis=1)
    live = product + rest >= threshold - NEAR
    i, j = np.nonzero(live if diagonal is None else np.triu(live, 1 + diagonal))
    total = product[i, j]
    for lo, hi in zip(ends, ends[1:]):
        if 4 * len(i) > live.size:        # most pairs are left: one matrix product is cheaper
            total = total + (a[:, lo:hi] @ b[:, lo:hi].T)[i, j]
        else:
            total = total + np.concatenate([
                np.einsum("ij,ij->i", a[i[s:s + 65536], lo:hi], b[j[s:s + 65536], lo:hi])
                for s in range(0, len(i), 65536)] or [np.zeros(0)])
        rest = np.linalg.norm(a[:, hi:], axis=1)[i] * np.linalg.norm(b[:, hi:], axis=1)[j]
        keep = total + rest >= threshold - NEAR
        i, j, total = i[keep], j[keep], total[keep]
    return i, j, np.abs(total - threshold) <= NEAR


def _compare(threshold: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Per vector its links and one edge to its group; ``other`` instead for a pair to be decided."""
        d = int(rows["dim"].iloc[0])
        left, right = rows[rows["side"] == 0], rows[rows["side"] == 1]
        same = right.empty
        if same:
            right = left

        def tile(part):
            return np.frombuffer(b"".join(part["vec"]), float).reshape(-1, d)
        i, j, close = tile_links(tile(left), tile(right), threshold, same)
        n, shift = len(left), 0 if same else len(left)
        nodes = np.concatenate([left["node"]] + ([] if same else [right["node"]]))
        copies = np.concatenate([left["copies"]] + ([] if same else [right["copies"]]))
        doubt = pd.DataFrame({"node": nodes[i[close]], "other": nodes[j[close] + shift]})
        i, j = i[~close], j[~close]
        sets = LocalSets(n + (0 if same else len(right)))
        sets.union(i, j + shift)
        links = np.zeros(len(nodes), np.int64)
        np.add.at(links, i, copies[j + shift])
        np.add.at(links, j + shift, copies[i])
        at = np.flatnonzero(links)
        sure = pd.DataFrame({"node": nodes[at], "links": links[at], "root": nodes[sets.roots()[at]]})
        return pd.concat([sure, doubt]).astype({c: "Int64" for c in ("node", "links", "root", "other")})
    return run


def _decided(pairs: DataFrame, distinct: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root) of the pairs (node, other) whose cosine reaches the threshold as given."""
    @F.pandas_udf("boolean")
    def reaches(a: pd.Series, b: pd.Series) -> pd.Series:
        def cosine(x, y):
            return (x @ y) / (np.sqrt(x @ x) * np.sqrt(y @ y))
        return pd.Series([bool(cosine(*matrix([x, y])) >= threshold) for x, y in zip(a, b)], dtype=bool)

    def side(name):
        return distinct.select(F.col("node").alias(f"{name}_node"), F.col("embedding").alias(f"{name}_vector"),
                               F.col("copies").alias(f"{name}_copies"))
    both = pairs.join(side("a"), F.col("node") == F.col("a_node")).join(side("b"), F.col("other") == F.col("b_node"))
    linked = both.where(reaches("a_vector", "b_vector"))
    return linked.select(F.col("node"), F.col("b_copies").alias("links"), F.col("other").alias("root")) \
        .unionByName(linked.select(F.col("other").alias("node"), F.col("a_copies").alias("links"),
                                   F.col("node").alias("root")))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept; one row per input row.

    Needs columns vec_id, embedding, label; others are ignored.  Rows whose
    vec_id, label or vector is NULL, and zero vectors or vectors with NULL or
    non-finite components, link with nothing.  Vectors of different lengths
    never link.  Rows that repeat a vec_id are vectors of their own.
    """
    value = F.col("embedding").cast("array<double>")
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(
        F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(value, lambda x: x != 0), F.lit(False))
    rows = vectors.select("vec_id", "label", F.when(usable, value).alias("embedding"))
    distinct = stored(
        rows.where("embedding is not null").groupBy("label", "embedding").agg(
            F.min("vec_id").alias("value"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()), "embed-distinct")
    placed = stored(distinct.mapInPandas(
        _rotated(fit_axes(distinct)), "node long, copies long, label " +
        distinct.schema["label"].dataType.simpleString() +
        ", dim int, vec binary, first double"), "embed-rotated")

    # tiles: cells of the first axis, cut by hash into parts of about ``tile`` rows
    width = (2 - 2 * threshold) ** 0.5
    cell = placed.withColumn("cell", F.floor(F.col("first") / width).cast("int"))
    key = ["label", "dim", "cell"]
    cells = cell.groupBy(*key).agg(F.count("*").alias("n"), F.min("first").alias("lo"),
                                   F.max("first").alias("hi")) \
        .withColumn("parts", F.ceil(F.col("n") / tile).cast("int"))
    cells = stored(cells, "embed-cells")
    tiled = cell.join(cells.select(*[F.col(k).alias("_" + k) for k in key], "parts"),
                      (F.col("label") == F.col("_label")) & (F.col("dim") == F.col("_dim"))
                      & (F.col("cell") == F.col("_cell"))) \
        .withColumn("tile", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")) \
        .select("node", "copies", *key, "tile", "vec")
    tiles = cells.select(*key, "lo", "hi", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
                         .alias("tile"))
    reach = tiles.withColumn("meets", F.explode(F.sequence(F.col("cell"), F.col("cell") + 2)))
    other = tiles.select(*[F.col(c).alias("_" + c) for c in tiles.columns])
    pairs = reach.join(other, (F.col("label") == F.col("_label")) & (F.col("dim") == F.col("_dim"))
                       & (F.col("meets") == F.col("_cell"))) \
        .where("_lo - hi <= {0} and lo - _hi <= {0}".format(width + 1e-9)) \
        .where("_cell > cell or _tile >= tile") \
        .select("label", "dim", "cell", "tile", "_cell", "_tile",
                F.xxhash64("label", "dim", "cell", "tile", "_cell", "_tile").alias("pair"))
    sides = F.array(F.struct(F.col("cell"), F.col("tile"), F.lit(0).alias("side")),
                    F.struct(F.col("_cell").alias("cell"), F.col("_tile").alias("tile"),
                             F.lit(1).alias("side")))
    wanted = pairs.select("label", "dim", "pair", F.explode(F.when(
        (F.col("cell") == F.col("_cell")) & (F.col("tile") == F.col("_tile")),
        F.slice(sides, 1, 1)).otherwise(sides)).alias("s")).select(
        F.col("label").alias("_label"), F.col("dim").alias("_dim"), "pair",
        F.col("s.cell").alias("_cell"), F.col("s.tile").alias("_tile"), F.col("s.side"))
    wanted = stored(wanted, "embed-pairs")
    work = tiled.join(wanted, (F.col("label") == F.col("_label")) & (F.col("dim") == F.col("_dim"))
                      & (F.col("cell") == F.col("_cell")) & (F.col("tile") == F.col("_tile")))
    told = stored(work.select("_label", "_dim", "pair", "side", "dim", "node", "copies", "vec")
                  .groupBy("_label", "_dim", "pair")
                  .applyInPandas(_compare(threshold), "node long, links long, root long, other long"),
                  "embed-links")
    found = stored(told.where("other is null").drop("other").unionByName(
        _decided(told.where("other is not null").select("node", "other"), distinct, threshold)),
        "embed-decided")
    links = found.groupBy(F.col("node").alias("_n")).agg(F.sum("links").alias("links"))
    groups = component_minimum(distinct.select("node", "value"),
                               found.select(F.col("node").alias("a"), F.col("root").alias("b")),
                               "embed-groups").withColumnRenamed("node", "_g").drop("root")
    known = stored(
        distinct.join(links, F.col("node") == F.col("_n"), "left")
        .join(groups, F.col("node") == F.col("_g"))
        .select(F.col("label").alias("_label"), F.col("embedding").alias("_embedding"), "component",
                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")),
        "embed-known")
    return rows.join(known, (F.col("label") == F.col("_label"))
                     & (F.col("embedding") == F.col("_embedding")), "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op5_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    """``near_duplicates`` of all embeddings at cosine 0.93."""
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))
