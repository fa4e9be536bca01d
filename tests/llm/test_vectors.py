"""Operators on embeddings: whitening, nearest neighbours, hard negatives, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tests.llm.conftest import CLASHES
from tollflow.llm import hard_negatives, neighbours, queries, whitening

NAN, INF = float("nan"), float("inf")
ODD = [(1, None, 0), (2, [], 0), (3, [1.0, None], 0), (4, [NAN, 1.0], 1), (5, [INF, 1.0], 1),
       (None, [1.0, 2.0], 1), (7, [0.0, 0.0], 1), (8, [3.0, 4.0], None), (100, [3.0, 4.0], 0),
       (100, [3.0, 4.0], 0), (100, [1.0, 2.0], 0), (9, [3.0, 4.0], 0), (10, [6.0, 8.0], 1),
       (11, [1.0, 2.0, 3.0], 1), (12, [1.0, 2.5, 3.0], 1), (200, [2.0, 2.0, 3.0], 0), (13, [-1.0, 5.0], 1)]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


@pytest.fixture(scope="module")
def odd(spark):
    return vectors(spark, ODD).withColumns(
        {c: F.lit(f"x{c}") for c in CLASHES + ["v", "dim", "x", "least", "found", "members", "block", "seq"]})


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SF_MID}/embeddings.parquet")


def plain(df):
    rows = df.select("vec_id", "embedding", "label").toPandas()
    return rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(float), rows["label"].to_numpy()


def clustered(spark, n=1500, seed=3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(12, 16))
    at = rng.integers(0, 12, n)
    x = middle[at] + 0.05 * rng.normal(size=(n, 16))
    x[rng.random(n) < 0.3] = x[0]                     # a third of all rows hold one vector
    return vectors(spark, [(i, v.tolist(), int(i % 4)) for i, v in enumerate(x)])


# ---- whitening ------------------------------------------------------------------------
def whitened_brute(x):
    """whole numbers, n, deviations, whitened (16), explained (16) by numpy's own eigenvectors."""
    whole = np.floor(64 * x).astype(int) + 1_000_000
    fit = np.unique(whole, axis=0)
    n, total = len(fit), fit.sum(0)
    centred = fit - fit.mean(0)
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    k = min(16, int((values > 1e-9 * max(values[0], 1e-300)).sum()))
    return (n, ((n * whole - total) ** 2).sum(1),
            (whole - fit.mean(0)) @ vecs[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum())


@pytest.mark.parametrize("make", ["table", "copies"])
def test_whitening_query_equals_numpy(spark, table, make, tmp_path):
    df = table if make == "table" else clustered(spark)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.QUERIES["op11_embedding_whitening"](spark, str(tmp_path)).toPandas()
    ids, x, _ = plain(df)
    n, deviation, want, explained = whitened_brute(x)
    assert set(got["n"]) == {n} and got["identity_error"].max() < 1e-9
    assert got["identity_error"].nunique() == 1
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    assert wide.shape == want.shape
    np.testing.assert_allclose(wide * np.sign((wide * want).sum(0)), want, atol=1e-7)
    np.testing.assert_allclose(got.groupby("component")["explained"].first(), explained, rtol=1e-9)
    first = got[got["component"] == 1].set_index("vec_id").loc[ids]
    assert first["deviation"].tolist() == deviation.tolist()


def test_whitening_of_odd_rows(spark, odd):
    rows = [r.asDict(recursive=True) for r in whitening.whiten(odd).collect()]
    assert sorted(str(r["doc"]["vec_id"]) for r in rows) == sorted(
        str(i) for i, v, _ in ODD if v and None not in v and all(np.isfinite(v)))
    assert {len(r["doc"]["embedding"]): r["n"] for r in rows} == {2: 5, 3: 3}
    assert all(len(r["whitened"]) == len(r["explained"]) == 2 for r in rows)
    assert whitening.whiten(odd.limit(0)).count() == 0
    alone = whitening.whiten(vectors(spark, [(1, [1.0, 2.0], 0)] * 3)).collect()
    assert [(r["n"], r["deviation"], r["whitened"]) for r in alone] == [(1, 0, [])] * 3
    far = whitening.whiten(vectors(spark, [(1, [1e13, 0.0], 0), (2, [0.0, 0.0], 0), (3, [1e300, 0.0], 0)]))
    assert sorted((r["doc"]["vec_id"], r["deviation"]) for r in far.collect()) == [(1, None), (2, None)]


@pytest.mark.parametrize("rank", [1, 4, 9])
def test_factorisation_of_a_scatter_of_any_rank(rank):
    rng = np.random.default_rng(rank)
    x = rng.normal(size=(50, rank)) @ rng.normal(size=(rank, 9)) * 10.0 ** rng.integers(-2, 3, 9)
    v = x.T @ x
    low, order = whitening.pivoted_cholesky(v)
    assert low.shape == (9, rank)
    np.testing.assert_allclose(low @ low.T, v[np.ix_(order, order)], rtol=1e-9, atol=1e-9 * np.trace(v))
    assert np.allclose(low[:rank], np.tril(low[:rank]))
    values, columns = whitening.jacobi(low)
    np.testing.assert_allclose(values, np.linalg.eigvalsh(v)[::-1][:rank], rtol=1e-6, atol=1e-12 * values[0])
    np.testing.assert_allclose(columns.T @ columns, np.eye(rank), atol=1e-12)


# ---- nearest neighbours -----------------------------------------------------------------
def nearest_brute(rows, asks, k=5):
    """{row place: [(score, vec_id)]} over usable rows of the same length."""
    use = [(p, i, np.array(v, float)) for p, (i, v, _) in enumerate(rows)
           if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for p, i, v in use:
        if asks(i):
            scores = sorted((-float(v @ w / np.sqrt(v @ v) / np.sqrt(w @ w)), j)
                            for q, j, w in use if q != p and len(w) == len(v))
            out[p] = [(-s, j) for s, j in scores[:k]]
    return out


def test_neighbours_query_recall_and_scores(spark, table, tmp_path):
    for name, df in (("plain", table), ("copies", clustered(spark))):
        df.write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
        got = queries.QUERIES["op12_nearest_neighbours"](spark, f"{tmp_path}/{name}").toPandas()
        ids, x, _ = plain(df)
        want = nearest_brute([(i, v.tolist(), 0) for i, v in zip(ids.tolist(), x)], lambda i: i % 50 == 0)
        assert set(got["query_id"]) == {int(ids[p]) for p in want}
        hits = 0
        for p, best in want.items():
            mine = got[got["query_id"] == ids[p]].sort_values("rank")
            assert mine["rank"].tolist() == [1, 2, 3, 4, 5]
            if len(set(mine["vec_id"]) & {j for _, j in best}) == 5:
                assert mine["vec_id"].tolist() == [j for _, j in best] or name == "plain"
                np.testing.assert_allclose(mine["score"], [s for s, _ in best], rtol=1e-12)
            hits += len(set(mine["vec_id"]) & {j for _, j in best})
        assert hits >= 0.9 * 5 * len(want), name


def test_neighbours_with_several_leaves_and_tiles(spark, monkeypatch):
    """Small leaves: planes, the shared queue and the radius decide; recall stays high."""
    df = clustered(spark, 2000)
    monkeypatch.setattr(neighbours, "ROW_TILE", 20)
    monkeypatch.setattr(neighbours, "QUERY_TILE", 3)
    got = neighbours.nearest(df, F.col("vec_id") % 50 == 0, leaf=32, fit_rows=512).toPandas()
    ids, x, _ = plain(df)
    want = nearest_brute([(i, v.tolist(), 0) for i, v in zip(ids.tolist(), x)], lambda i: i % 50 == 0)
    found = {q: set(part["vec_id"]) for q, part in got.groupby("query_id")}
    hits = sum(len(found[int(ids[p])] & {j for _, j in best}) for p, best in want.items())
    assert hits >= 0.9 * 5 * len(want)


def test_forest_visits_few_leaves_of_clustered_vectors():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 32))[rng.integers(0, 40, 8000)] + 0.1 * rng.normal(size=(8000, 32))
    x = neighbours.unit(x)
    forest = neighbours.Forest.fit(x, 3, 128)
    n_leaves = 3 << forest.depth
    visits = [len(forest.search(q, 3, 0.025 * 2 * 0.05)) for q in x[:50]]
    assert np.mean(visits) < 0.2 * n_leaves
    everything = forest.search(x[0], 3, np.inf) + forest.search(x[0], 3, None)
    assert sorted(everything) == sorted((t, leaf) for t in range(3) for leaf in range(1 << forest.depth))


def test_neighbours_of_odd_rows(spark, odd):
    got = neighbours.nearest(odd, F.col("vec_id") % 50 == 0).collect()
    want = nearest_brute(ODD, lambda i: i % 50 == 0)
    flat = sorted((ODD[p][0], rank + 1, j, round(s, 12)) for p, best in want.items()
                  for rank, (s, j) in enumerate(best))
    assert sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 12)) for r in got) == flat
    assert neighbours.nearest(odd.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# ---- hard negatives -----------------------------------------------------------------------
def mined_brute(rows, asks, k=5, m=10):
    use = [(p, i, [int(np.floor(256 * c)) for c in v], y) for p, (i, v, y) in enumerate(rows)
           if i is not None and y is not None and v and None not in v and np.isfinite(v).all()]
    out = []
    for p, i, v, y in use:
        if not asks(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, q, z) for q, j, w, z in use
                        if len(w) == len(v) and q != p)
        for s, j, _, _ in [r for r in scored if r[3] == y][:k]:
            fit = [(-t, n) for t, n, _, z in scored if z != y and 30 * -s <= 100 * -t <= 90 * -s][:m]
            out += [(i, j, rank + 1, n, -s, t) for rank, (t, n) in enumerate(fit)]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def mined(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_negatives_query_equals_brute_force(spark, table, tmp_path):
    for name, df in (("plain", table), ("copies", clustered(spark, 700))):
        df.write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
        ids, x, labels = plain(df)
        rows = [(i, v.tolist(), (y + 1) % 10 if i % 7 == 0 else y)
                for i, v, y in zip(ids.tolist(), x, labels.tolist())]
        want = mined_brute(rows, lambda i: i % 100 == 0)
        assert mined(queries.QUERIES["op13_hard_negatives"](spark, f"{tmp_path}/{name}")) == want and want


def test_negatives_over_many_blocks_and_trees(spark):
    """Waves of blocks, several groups of anchors, hot vectors with many equal scores."""
    df = clustered(spark, 900)
    ids, x, labels = plain(df)
    want = mined_brute([(i, v.tolist(), y) for i, v, y in zip(ids.tolist(), x, labels.tolist())],
                       lambda i: i % 30 == 0)
    assert mined(hard_negatives.mine(df, F.col("vec_id") % 30 == 0, block=50, group=8)) == want and want


def test_negatives_of_odd_rows(spark, odd):
    assert mined(hard_negatives.mine(odd, F.col("vec_id") % 100 == 0)) == mined_brute(
        ODD, lambda i: i % 100 == 0)
    assert hard_negatives.mine(odd.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    huge = vectors(spark, [(100, [3e6, 0.0], 0), (1, [3e6, 1.0], 0), (2, [2e6, 0.0], 1), (3, [1e30, 0.0], 1)])
    assert mined(hard_negatives.mine(huge, F.col("vec_id") == 100)) == mined_brute(
        [(i, list(r["embedding"]), r["label"]) for i, r in ((r["vec_id"], r) for r in huge.collect())
         if i != 3], lambda i: i == 100)


def test_bounds_leave_out_most_scores_of_clustered_vectors():
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(10, 32))
    x = np.floor(256 * (middle[rng.integers(0, 10, 3000)] + 0.02 * rng.normal(size=(3000, 32)))).astype(int)
    anchors = np.arange(0, 3000, 50)
    order, parent, edge = hard_negatives.spanning_tree(x[anchors].astype(float))
    assert sorted(order) == list(range(len(anchors))) and (parent < np.arange(len(anchors))).all()
    at = anchors[order]
    own = (x[at] * x[at]).sum(1)
    group = {"dim": 32, "x": x[at].ravel(), "anchors": at, "labels": np.zeros(len(at), int),
             "parent": parent, "edge": edge, "at": np.arange(len(at)), "window": np.zeros(len(at), int),
             "low": own * 3 // 10, "high": own * 9 // 10, "least": np.full(len(at), -hard_negatives.END),
             "least_id": np.full(len(at), hard_negatives.END)}
    block = {"dim": 32, "x": x.ravel(), "rows": np.arange(3000), "ids": np.arange(3000),
             "labels": np.ones(3000, int)}
    counts = {}
    c, _, place, s = hard_negatives.walk(group, block, False, 10, counts)
    assert counts["scored"] < 0.4 * counts["asked"]
    assert (s == (x[at[c]] * x[place]).sum(1)).all()
    deep = hard_negatives.spanning_tree(np.arange(300.0)[:, None], depth=20)
    assert (deep[1] < 0).sum() > 5 and sorted(deep[0]) == list(range(300))
