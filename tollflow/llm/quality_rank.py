"""Quality classifier by Bradley-Terry ranking of preference pairs.

Every labelled good document is preferred over every labelled bad one.  A
linear utility of text features is learned by logistic loss on the feature
differences of such pairs; it is a document's score.  The accept threshold is
the quantile of the labelled scores at the share of bad labels.  Utilities are
shown as a logistic function of their distance to that threshold, scaled so
that the threshold itself is ``ACCEPT``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollflow.llm.common import hash_share, read_table, text_or_empty

ACCEPT = 0.7
MAX_LABELLED = 20_000      # bound on the labelled documents used for fitting
PAIRS_PER_DOC = 8          # preference pairs drawn for each of them
RIDGE = 1e-3
FEATURES = ("length", "word_length", "distinct", "adjacent", "trigrams", "lines", "capitals",
            "digits", "symbols", "stops", "bangs", "bars", "lone_marks", "non_ascii")


def text_features(text: str | None) -> list[float]:
    """Lexical features of one text; empty or NULL text gives all zeros."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = float(count.sum() - count[9:14].sum() - count[32])
    share = lambda codes: math.sqrt(sum(int(count[c]) for c in codes) / size)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    grams = len(set(zip(words, words[1:], words[2:])))
    return [
        math.log1p(n), size / n, len(set(words)) / math.sqrt(n),
        sum(map(eq, words, words[1:])) / n, 1.0 - grams / max(n - 2, 1),
        1.0 - len(set(lines)) / len(lines), math.sqrt(count[65:91].sum() / size),
        math.sqrt(count[48:58].sum() / size), share(b"#*$%&<>~^_=@"), share(b".,;:?"),
        share(b"!"), share(b"|"), sum(len(w) == 1 and not w.isalnum() for w in words) / n,
        math.sqrt(count[128:].sum() / size)]


@dataclass(frozen=True)
class Ranking:
    """Utility = weights . (features - centre) / spread, clipped per feature; cut: its threshold."""
    centre: tuple
    spread: tuple
    weights: tuple
    cut: float

    def utility(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - np.array(self.centre)) / np.array(self.spread), -6, 6)
        return z @ np.array(self.weights)

    def score(self, rows: np.ndarray) -> np.ndarray:
        x = self.utility(rows) - self.cut + math.log(ACCEPT / (1 - ACCEPT))
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_pairs(rows: np.ndarray, good: np.ndarray, seed: int = 1) -> Ranking:
    """Newton's method for the mean logistic loss of w . (good - bad), with a small ridge."""
    centre, spread = rows.mean(0), rows.std(0)
    spread[spread == 0] = 1
    z = np.clip((rows - centre) / spread, -6, 6)
    w = np.zeros(z.shape[1])
    ups, downs = np.flatnonzero(good), np.flatnonzero(~good)
    if len(ups) and len(downs):
        rng = np.random.default_rng(seed)
        pairs = PAIRS_PER_DOC * len(rows)
        d = z[rng.choice(ups, pairs)] - z[rng.choice(downs, pairs)]
        for _ in range(25):
            p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))     # chance of the wrong order
            grad = -(d * p[:, None]).mean(0) + RIDGE * w
            hess = (d * (p * (1 - p))[:, None]).T @ d / len(d) + RIDGE * np.eye(len(w))
            step = np.linalg.solve(hess, grad)
            w -= step
            if np.abs(step).max() < 1e-8:
                break
    utility = z @ w
    cut = float(np.quantile(utility, (~good).mean(), method="midpoint")) if len(downs) else -1e9
    return Ranking(tuple(centre), tuple(spread), tuple(w), cut)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def features(text: Column) -> Column:
    """array<double> of ``text_features``."""
    @F.pandas_udf("array<double>")
    def counted(texts: pd.Series) -> pd.Series:
        return texts.map(text_features)
    return counted(text)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Ranking:
    """Fit on the labelled documents that are not held out.

    Labels with quality NULL are ignored and a document labelled both ways is
    bad.  Beyond ``max_labelled`` the documents with the smallest hashes of
    their id are used.  Rows that share a doc_id count as one document, the one
    with the smallest features.  Without both classes every document is accepted.
    """
    marks = labels.where("doc_id is not null and quality is not null") \
        .where(~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").alias("_id")) \
        .agg(F.min("quality").alias("_quality"))
    # few more than needed by their hash, so that no task takes the best of every partition
    share = 1.2 * max_labelled / max(marks.count(), 1)
    chosen = marks.where(hash_share("_id") < share).orderBy(hash_share("_id"), "_id").limit(max_labelled)
    # one row of a few numbers for each of at most max_labelled ids
    rows = docs.select("doc_id", text_or_empty().alias("_t")) \
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")) \
        .select("doc_id", "_quality", features(F.col("_t")).alias("f")) \
        .groupBy("doc_id").agg(F.min("_quality").alias("_quality"), F.min("f").alias("f")).toPandas() \
        .sort_values("doc_id", kind="stable")
    if rows.empty:
        return Ranking((0.0,) * len(FEATURES), (1.0,) * len(FEATURES), (0.0,) * len(FEATURES), -1e9)
    return fit_pairs(np.stack(rows["f"]), (rows["_quality"] == 1).to_numpy())


def score(text: Column, model: Ranking) -> Column:
    """Score of a text column, 0 to 1; any text, empty and NULL ones too."""
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype="float64")
        return pd.Series(model.score(np.array([text_features(t) for t in texts])))
    return scored(text)


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents; one row per input row."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       score(text_or_empty(), model).alias("score")) \
        .withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))

