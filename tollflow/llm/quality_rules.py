"""Quality rules with risk-controlled thresholds (DataFrame operations only).

Every rule is a statistic of the text where high values are bad.  Its cutoff in
a stratum (a word-count class) is chosen on labelled good documents: with n of
them, the largest k is taken for which an exact binomial bound says that a
cutoff exceeded by k of n good documents is exceeded by at most ``risk`` of all
good documents of the stratum.  Both the risk and the error probability are
split over all rules (and the error also over all strata) by Bonferroni, so
all rules of a stratum together reject at most ``max_risk`` of its good
documents, in all strata at once, with probability 1 - ``error``.
A stratum with too few good labels to certify anything keeps its documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollflow.llm.common import WORD, any_of, read_table, stored, text_or_empty

SYMBOLS = r"[#*$%&|<>]"
STRATA = (100, 300, 1000)          # word counts at which a new stratum begins
MAX_RISK, ERROR = 0.02, 0.05
RANGES = 1024                      # value ranges per unit of a statistic
LAST_VALUE = 64                    # values from here on share the last range
COUNTS = ("n_words", "word_chars", "n_symbols", "n_text_lines", "n_dup_lines", "n_capitals",
          "n_punctuation", "n_repeat_words")
RULES = {
    "symbol_share": "n_symbols / word_chars",
    "dup_line_share": "n_dup_lines / n_text_lines",
    "repeat_share": "n_repeat_words / n_words",
    "capital_share": "n_capitals / word_chars",
    "punctuation_share": "n_punctuation / word_chars",
    "word_length": "word_chars / n_words",
}


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts; one row per input row, one pass, no shuffle.

    NULL text counts as empty; texts may be of any length: 3-word windows are
    compared by 64-bit hash after a sort, never pair by pair.
    """
    words = docs.select("doc_id", text_or_empty().alias("_t")).select(
        "doc_id", "_t", F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)).alias("_words"),
        F.filter(F.split("_t", "\n", -1), lambda x: F.regexp_like(x, F.lit(WORD))).alias("_lines"))
    w = F.col("_words")
    grams = words.select(
        "doc_id", F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_text_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.regexp_count("_t", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.regexp_count("_t", F.lit(r"[!?.,;:]")).cast("long").alias("n_punctuation"),
        F.slice(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))),
                1, F.greatest(F.size(w) - 2, F.lit(0))).alias("_grams"))
    g = F.col("_grams")
    marked = grams.withColumn("_sorted", F.when(
        F.size(F.array_distinct(g)) < F.size(g),
        F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("_sorted")
    found = marked.withColumn("_at", F.sort_array(F.transform(
        F.filter(s, lambda x, i: F.coalesce(x["h"] == F.get(s, i - 1)["h"], F.lit(False))
                 | F.coalesce(x["h"] == F.get(s, i + 1)["h"], F.lit(False))),
        lambda x: x["i"])))
    at = F.col("_at")
    # windows at a and b cover 3 words each, less their overlap
    covered = F.aggregate(
        F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(p - F.get(at, i - 1), F.lit(3)))),
        F.lit(0), lambda a, x: a + x)
    return found.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")) \
        .drop("_grams", "_sorted", "_at")


def allowed_failures(n: int, risk: float, error: float) -> int:
    """Largest k with P(Binomial(n, risk) <= k) <= error; -1 if there is none."""
    k, total = -1, 0.0
    log_p, log_q = math.log(risk), math.log1p(-risk)
    while k < n:
        i = k + 1
        total += math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
                          + i * log_p + (n - i) * log_q)
        if total > error:
            return k
        k = i
    return k


def stratum(n_words: Column) -> Column:
    return sum([(n_words >= b).cast("int") for b in STRATA], F.lit(0))


def _rules() -> list[Column]:
    return [F.expr(f"coalesce(try_divide({e.split(' / ')[0]}, {e.split(' / ')[1]}), 0D)").alias(r)
            for r, e in RULES.items()]


def _exceeded_by(good: DataFrame, ks: dict[int, int], ranges: int = RANGES) -> dict[int, dict]:
    """{stratum: {rule: value}}: the value that exactly k good documents may exceed, the (k + 1)-th largest.

    Equal values are counted first.  Running sums over fixed value ranges find
    the range of the value, and only that range is summed value by value.
    """
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES])
    k = F.lit(None).cast("long")
    for s, allowed in ks.items():
        k = F.when(F.col("stratum") == s, F.lit(allowed).cast("long")).otherwise(k)
    counts = stored(good.where(F.col("stratum").isin(list(ks))).select("stratum", F.inline(rules))
                    .groupBy("stratum", "rule", "value").agg(F.count("*").alias("n"))
                    .withColumn("range", F.floor(F.least("value", F.lit(float(LAST_VALUE))) * ranges)),
                    "rule-values")
    by = ["stratum", "rule"]
    down = lambda c: Window.partitionBy(*by).orderBy(F.col(c).desc()).rowsBetween(
        Window.unboundedPreceding, 0)
    reached = counts.groupBy(*by, "range").agg(F.sum("n").alias("n")) \
        .withColumn("upto", F.sum("n").over(down("range"))).where(F.col("upto") > k) \
        .groupBy(*by).agg(F.max(F.struct("range", (F.col("upto") - F.col("n")).alias("above"))).alias("m")) \
        .select(*by, "m.range", "m.above")
    found = counts.join(reached, [*by, "range"]) \
        .withColumn("upto", F.col("above") + F.sum("n").over(down("value"))).where(F.col("upto") > k) \
        .groupBy(*by).agg(F.max("value").alias("value")).collect()
    return {s: {r["rule"]: r["value"] for r in found if r["stratum"] == s} for s in ks}


def certified_cutoffs(stats: DataFrame, labels: DataFrame, max_risk: float = MAX_RISK,
                      error: float = ERROR) -> list[dict]:
    """[{stratum, n, k, <rule>: cutoff}] for the strata where a cutoff is certified.

    Every labelled document is used.  Labels with quality NULL are ignored; a
    document labelled both ways counts as bad.  Rows that share a doc_id count
    as one document, the one with the smallest counts in the order of COUNTS.
    """
    marks = labels.where("quality is not null and doc_id is not null") \
        .groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("quality"))
    once = stats.where("doc_id is not null").groupBy("doc_id") \
        .agg(F.min(F.struct(*COUNTS)).alias("_least")).select("doc_id", "_least.*")
    held = stored(once.join(marks, F.col("doc_id") == F.col("_id")).select(
        stratum(F.col("n_words")).alias("stratum"), "quality", *_rules()), "rule-holdout")
    good = held.where("quality = 1")
    tests = len(RULES) * (len(STRATA) + 1)
    ks = {r["stratum"]: (r["count"], allowed_failures(r["count"], max_risk / len(RULES),
                                                      error / tests))
          for r in good.groupBy("stratum").count().collect()}
    ks = {s: nk for s, nk in sorted(ks.items()) if nk[1] >= 0}
    if not ks:
        return []
    values = _exceeded_by(good, {s: k for s, (_, k) in ks.items()})
    return [{"stratum": s, "n": n, "k": k, **values[s]} for s, (n, k) in ks.items()]


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per input row: doc_id, the counts, base_failed, kept.

    Only doc_id and text are read.  A document fails the base rule with under
    50 words or over half of its words in repeated 3-word windows; it is kept
    if it passes the base rule and exceeds no certified cutoff of its stratum.
    """
    stats = stored(text_statistics(docs), "rule-statistics")
    cutoffs = certified_cutoffs(stats, labels, **options)
    values = stats.select("*", stratum(F.col("n_words")).alias("_stratum"), *_rules())
    over = any_of([F.lit(False)] + [(F.col("_stratum") == c["stratum"]) & (F.col(r) > F.lit(c[r]))
                                    for c in cutoffs for r in RULES])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return values.withColumn("base_failed", failed).withColumn("kept", ~failed & ~over)


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """``judge`` over all documents with the labels table as the labelled holdout."""
    return judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")
