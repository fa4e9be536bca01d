"""Secret scan with multipart credential linking (DataFrame operations only).

Base kinds (assign, access, hex) are reported wherever they match.  Weak
parts -- user or client identifiers, opaque tokens, endpoints -- are common in
clean text, so they are reported only when the parts that complete a
credential lie within ``scope`` code points of them in the same document:

* identifier: a secret (base assign, base hex or opaque token) in scope;
* opaque token: an identifier, access id or endpoint in scope;
* endpoint: an identifier or access id in scope, and a secret in scope.

Every part is an interval.  Both sides of the interval join are keyed by
(row, cell) with cells as wide as the scope, and a part looks into its own
cell and its neighbours, so a join group never holds more parts than a few
scopes of text can hold, whatever the document's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollflow.llm.common import read_table, sha256_hex, stored, text_or_empty

# kind -> pattern; the order is the order within one start
ASSIGN = (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
BASE = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{12,}", "hex": r"[0-9a-f]{32,}"}
WEAK = {
    "ident": r"(?i:access_?key_?id|client_?id|user_?name|user|login|account)[\"']?\x20*[:=]"
             r"\x20*[\"']?[A-Za-z0-9@._-]{3,}",
    "opaque": r"[A-Za-z0-9+/_=-]{20,}",        # with a digit, a capital and a small letter
    "endpoint": r"(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9._~:/?#@%&=+-]{4,}",
}
ORDER = {k: i for i, k in enumerate([*BASE, *WEAK])}
IDENTIFIERS, SECRETS = ("ident", "access"), ("assign", "hex", "opaque")
SCOPE = 200


def _holds(kind: str, match: Column, value: Column) -> Column:
    """The rule on a whole match that its pattern does not state."""
    if kind == "assign":
        return F.char_length(value) >= 8
    if kind == "opaque":
        return F.regexp_like(match, F.lit("[0-9]")) & F.regexp_like(match, F.lit("[A-Z]")) \
            & F.regexp_like(match, F.lit("[a-z]"))
    return F.lit(True)


def _matches(kind: str, pattern: str) -> Column:
    """array<struct<kind, gap, len, ok>> of the leftmost non-overlapping matches.

    ``split`` gives the text between matches and ``regexp_extract_all`` the
    matches, so positions follow from lengths alone, in code points.
    """
    t, p = F.col("_text"), F.lit(pattern)
    found = F.regexp_extract_all(t, p, F.lit(0))
    value = F.regexp_extract_all(t, p, F.lit(1)) if kind == "assign" else found
    rows = F.zip_with(
        F.zip_with(F.split(t, pattern, -1), found,
                   lambda gap, m: F.struct(F.char_length(gap).alias("gap"), m.alias("m"))),
        value, lambda x, v: F.struct(
            F.lit(kind).alias("kind"), x["gap"].alias("gap"),
            F.char_length(x["m"]).alias("len"),
            _holds(kind, x["m"], v).alias("ok")))
    # split gives one segment more than there are matches; the last one has no match
    return F.when(F.regexp_like(t, p), F.filter(rows, lambda r: r["len"].isNotNull()))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per input row: doc_id, base (array of spans), spans (base and linked weak parts).

    A span is struct<start, ord, kind, end>: code points, end exclusive, sorted by
    start then kind.  NULL text is empty; NULL or repeated doc_ids keep one row
    each; columns other than doc_id and text are ignored.
    """
    kinds = {**BASE, **WEAK}
    texts = docs.select("doc_id", text_or_empty().alias("_text"))
    # one pass over the texts; the matches are written once and drive all that follows
    found = stored(
        texts.select("doc_id", F.monotonically_increasing_id().alias("row"),
                     *[_matches(k, p).alias(k) for k, p in kinds.items()]), "secrets")
    each = found.select("row", F.explode(F.filter(F.array(*kinds), lambda a: a.isNotNull()))
                        .alias("a")).select("row", F.posexplode("a").alias("pos", "m")) \
        .select("row", "pos", "m.*")
    upto = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(
        Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("len")).over(upto)
    order = F.create_map(*[F.lit(x) for kv in ORDER.items() for x in kv])
    parts = stored(each.withColumn("end", end).where("ok").select(
        "row", (F.col("end") - F.col("len")).alias("start"), order[F.col("kind")].alias("ord"),
        "kind", "end"), "secret-parts")
    weak = parts.where(F.col("kind").isin(*WEAK))

    def near(left: DataFrame, wanted: tuple) -> DataFrame:
        """Parts of ``left`` with a wanted part of another span within the scope."""
        cells = F.explode(F.sequence(F.floor(F.col("start") / scope),
                                     F.floor(F.col("end") / scope)))
        other = parts.where(F.col("kind").isin(*wanted)).select(
            F.col("row").alias("o_row"), F.col("start").alias("o_start"),
            F.col("end").alias("o_end"), cells.alias("o_cell"))
        mine = left.withColumn("cell", F.explode(F.sequence(
            F.floor(F.col("start") / scope) - 1, F.floor(F.col("end") / scope) + 1)))
        in_scope = ((F.col("row") == F.col("o_row")) & (F.col("cell") == F.col("o_cell"))
                    & (F.col("o_start") - F.col("end") <= scope)
                    & (F.col("start") - F.col("o_end") <= scope)
                    & ((F.col("o_start") >= F.col("end")) | (F.col("o_end") <= F.col("start"))))
        return mine.join(other, in_scope, "left_semi").drop("cell").distinct()

    linked = near(weak.where("kind = 'ident'"), SECRETS) \
        .unionByName(near(weak.where("kind = 'opaque'"), (*IDENTIFIERS, "endpoint"))) \
        .unionByName(near(near(weak.where("kind = 'endpoint'"), IDENTIFIERS), SECRETS))
    span = F.struct("start", "ord", "kind", "end")
    reported = parts.where(F.col("kind").isin(*BASE)).withColumn("base", F.lit(True)) \
        .unionByName(linked.withColumn("base", F.lit(False))) \
        .groupBy("row").agg(
            F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("base"),
            F.sort_array(F.collect_list(span)).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,ord:int,kind:string,end:bigint>>")
    return found.select("doc_id", "row").join(reported, "row", "left").select(
        "doc_id", F.coalesce("base", none).alias("base"),
        F.coalesce("spans", none).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order given."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op1_secret_scans(spark, sf_dir: str) -> DataFrame:
    """Digest of ``scan`` over all documents."""
    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return scan(read_table(spark, sf_dir, "documents")).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
        sha256_hex(joined(F.col("base"))).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))
