"""URL filter: host and path rules, and gradient-boosted trees on lexical features.

The rules are authoritative where they fit.  The URLs they decide are the
labelled URLs from which the trees learn; all other URLs are judged by the
trees.  Features, statistics and scoring are DataFrame expressions and Spark
ML, with no Python on the executors.
"""

from __future__ import annotations

import functools

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollflow.llm.common import ascii_lower, hash_share, read_table, stored

# (verdict, host, path): a rule fits its host and all subdomains, and paths that start with its own
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
MAX_LABELLED = 20_000      # distinct labelled URLs used for fitting, chosen by hash
PRIOR = 5                  # labelled URLs that the rate of all URLs counts for in a suffix's block rate
FOLDS = 4                  # a URL used for fitting sees the block rates of the other folds
FEATURES = ("length", "host_length", "path_length", "depth", "labels", "digit_share", "hyphens",
            "entropy", "params", "query_length", "has_fragment", "secure", "suffix_share",
            "suffix_blocked", "ending_share", "ending_blocked")


def split_url(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path; both empty for a NULL url or one without ``://``."""
    part = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return pages.select(
        "page_id", "url",
        ascii_lower(F.regexp_extract(F.coalesce("url", F.lit("")), part, 1)).alias("host"),
        F.regexp_extract(F.coalesce("url", F.lit("")), part, 2).alias("path"))


def rule_of(rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits ``host`` and ``path``, else NULLs."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) \
            & F.startswith("path", F.lit(path))
        name = F.when(fits, host + path).otherwise(name)
        verdict = F.when(fits, what).otherwise(verdict)
    return name, verdict


def lexical(urls: DataFrame) -> DataFrame:
    """Adds the lexical features and the two suffixes of each URL."""
    u = F.coalesce("url", F.lit(""))
    n = F.greatest(F.char_length(u), F.lit(1))
    # entropy over characters: one native replace per distinct character
    shares = F.transform(F.array_distinct(F.split(u, "")), lambda c: (
        F.char_length(u) - F.char_length(F.replace(u, c, F.lit("")))) / n)
    entropy = F.aggregate(shares, F.lit(0.0), lambda s, p: s - F.when(
        p > 0, p * F.log2(p)).otherwise(0.0))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    counts = {
        "length": F.char_length(u), "host_length": F.char_length("host"),
        "path_length": F.char_length("path"), "depth": F.regexp_count("path", F.lit("/+[^/]")),
        "labels": F.regexp_count("host", F.lit(r"\.")),
        "digit_share": F.regexp_count(u, F.lit("[0-9]")) / n,
        "hyphens": F.regexp_count("host", F.lit("-")), "entropy": entropy,
        "params": F.regexp_count(query, F.lit("[^&]+")), "query_length": F.char_length(query),
        "has_fragment": F.contains(u, F.lit("#")), "secure": F.startswith(u, F.lit("https")),
    }
    return urls.select(
        "*", *[c.cast("double").alias(k) for k, c in counts.items()],
        F.regexp_extract("host", r"([^.]*)$", 1).alias("suffix"),
        F.regexp_extract("path", r"(/|\.[A-Za-z0-9]{1,8})$", 1).alias("ending"))


def _fold() -> Column:
    return F.pmod(F.xxhash64("url"), F.lit(FOLDS))


def _counts(urls: DataFrame) -> DataFrame:
    """kind (suffix, ending), value, n, and labelled_k and b_k of every fold k: whole counts of URLs,
    of labelled and of blocked ones."""
    kinds = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in ("suffix", "ending")])
    labelled, blocked = F.col("verdict").isNotNull(), F.col("verdict") == "block"
    return urls.select("verdict", _fold().alias("fold"), F.inline(kinds)).groupBy("kind", "value").agg(
        F.count("*").alias("n"), *[F.count(F.when(mark & (F.col("fold") == k), 1)).alias(f"{name}_{k}")
                                   for name, mark in (("labelled", labelled), ("b", blocked))
                                   for k in range(FOLDS)])


def _summed(name: str, but: Column | None = None) -> Column:
    """A count over all folds, or over all but one."""
    parts = [F.col(f"{name}_{k}") if but is None else F.when(but == k, 0).otherwise(F.col(f"{name}_{k}"))
             for k in range(FOLDS)]
    return functools.reduce(lambda a, b: a + b, parts)


def _with_statistics(urls: DataFrame, counts: DataFrame, total: int, rate: float,
                     fitting: bool = False) -> DataFrame:
    """Adds each suffix's share of all URLs and the share of its labelled URLs that rules block.

    The rate of all labelled URLs counts for PRIOR of a suffix's own, so one
    without labelled URLs has that rate.  ``fitting``: a URL's own fold is left
    out, so that no URL sees its own label.  The counts may be of any length;
    only a table whose files are small is broadcast.
    """
    but = _fold() if fitting else None
    for column in ("suffix", "ending"):
        table = counts.where(F.col("kind") == column).drop("kind").withColumnRenamed("value", "_value")
        known, blocked = (F.coalesce(_summed(c, but), F.lit(0)) for c in ("labelled", "b"))
        urls = urls.join(table, F.col(column) == F.col("_value"), "left").withColumns({
            f"{column}_share": F.coalesce(F.col("n") / max(total, 1), F.lit(0.0)),
            f"{column}_blocked": (blocked + rate * PRIOR) / (known + PRIOR)}).drop(*table.columns)
    return urls


def judge(pages: DataFrame, rules=RULES, max_labelled: int = MAX_LABELLED,
          hold_out: Column | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, score; one row per input row.

    ``score`` is the trees' probability of block.  Only page_id and url are
    read.  A NULL or empty url is judged by the trees like any other.  Without
    labelled URLs of both verdicts the trees' place is taken by the only label
    there is, or allow.  Suffixes and endings are counted over all URLs; only
    the trees are fitted on a sample.  ``hold_out`` keeps rows from both.
    """
    rule, verdict = rule_of(rules)
    known = split_url(pages).withColumns({"rule": rule, "verdict": verdict})
    urls = lexical(known)
    usable = F.lit(True) if hold_out is None else ~hold_out
    counts = stored(_counts(urls.where(usable)), "url-counts")
    whole = counts.where("kind = 'suffix'").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in (
        ("n", F.col("n")), ("labelled", _summed("labelled")), ("b", _summed("b")))]).first()
    rate = whole["b"] / max(whole["labelled"], 1)
    # a bounded sample for the fit, the same in every run: distinct labelled URLs with the smallest hashes
    labelled = known.where(usable & F.col("verdict").isNotNull()).select("url", "host", "path", "verdict")
    distinct = labelled.agg(F.approx_count_distinct("url", 0.01)).first()[0]
    sample = lexical(labelled.where(hash_share("url") < min(1.0, max_labelled / max(distinct, 1))).distinct())
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    train = stored(vectors.transform(_with_statistics(sample, counts, whole["n"], rate, fitting=True))
                   .select("_features", (F.col("verdict") == "block").cast("double").alias("_block")),
                   "url-train")
    marks = {r["_block"]: r["count"] for r in train.groupBy("_block").count().collect()}
    scored = _with_statistics(urls, counts, whole["n"], rate)
    if len(marks) == 2:
        trees = GBTClassifier(labelCol="_block", featuresCol="_features", predictionCol="_says",
                              maxIter=20, maxDepth=4, stepSize=0.2, seed=11) \
            .setProbabilityCol("_p").setRawPredictionCol("_raw").fit(train.coalesce(4))
        scored = trees.transform(vectors.transform(scored)).withColumn(
            "score", F.get(vector_to_array("_p"), F.lit(1)))
    else:
        scored = scored.withColumn("score", F.lit(float(next(iter(marks), 0.0))))
    by_trees = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("verdict", by_trees).alias("verdict"), "score")


def op2_url_filters(spark, sf_dir: str) -> DataFrame:
    """``judge`` over all pages with the production rules."""
    return judge(read_table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict", "score")
