"""Quality ranking, near-dedup by embedding and SimHash, HTML text, BPE; the corpus pipeline."""

import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF_MID, SF_SMALL
from tests.llm import brute
from tollflow.llm import bpe, embed_dedup, graph, html_text, quality_rank, simhash
from tollflow.llm.common import text_or_empty


# ---- components ------------------------------------------------------------------
def test_components_equal_union_find(spark):
    rng = random.Random(1)
    ids = list(range(-50, 400))
    links = [(rng.choice(ids), rng.choice(ids)) for _ in range(220)]
    links += [(i, i + 1) for i in range(1000, 1100)] + [(5, 5)] + links[:20]     # a chain, a loop
    df = spark.createDataFrame(links + [(None, 3)], "a long, b long")
    want = brute.components({x for e in links for x in e}, links)
    got = {r["node"]: r["root"] for r in graph.components(df, "a", "b").collect()}
    assert got == {n: r for n, r in want.items() if n != r}
    assert graph.components(df.limit(0), "a", "b").count() == 0


# ---- quality classifier ----------------------------------------------------------
def test_ranking_separates_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    model = quality_rank.fit(docs, labels)
    held = docs.withColumn("s", quality_rank.score(text_or_empty(), model)).join(labels, "doc_id") \
        .where(quality_rank.held_out(F.col("doc_id"))).select("s", "quality").collect()
    good, bad = [r["s"] for r in held if r["quality"]], [r["s"] for r in held if not r["quality"]]
    order = np.mean([[g > b for b in bad] for g in good])
    assert order > 0.98
    assert np.mean(np.array(good) >= 0.7) > 0.97 and np.mean(np.array(bad) >= 0.7) < 0.1


def test_fit_uses_no_held_out_label(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(
        quality_rank.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality_rank.fit(docs, labels) == quality_rank.fit(docs, flipped)
    ids = [r["doc_id"] for r in labels.where(quality_rank.held_out(F.col("doc_id"))).collect()]
    assert ids and all(zlib.crc32(str(i).encode()) % 4 == 2 for i in ids)


def test_repeated_rows_of_a_document_weigh_once(spark):
    """The model is the same when the rows of one id come many times."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    often = labels.where("quality is not null").where(~quality_rank.held_out(F.col("doc_id"))) \
        .agg(F.min("doc_id")).first()[0]
    again = docs.where(F.col("doc_id") == often).withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("_")
    assert again.count() == 300
    assert quality_rank.fit(docs.unionAll(again), labels) == quality_rank.fit(docs, labels)


def test_scores_of_odd_and_empty_tables(spark, edge_docs, odd_docs, no_docs):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = quality_rank.fit(edge_docs, labels)
    for docs, n in ((edge_docs, None), (odd_docs, 7), (no_docs, 0)):
        got = docs.select(quality_rank.score(text_or_empty(), model).alias("s")).collect()
        assert n is None or len(got) == n
        assert all(0 <= r["s"] <= 1 for r in got)
    empty = quality_rank.fit(no_docs, labels.limit(0))               # no labels: all accepted
    assert all(r["s"] >= 0.7 for r in odd_docs.select(
        quality_rank.score(text_or_empty(), empty).alias("s")).collect())


# ---- embeddings --------------------------------------------------------------------
def _vectors(n=700, d=20, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if i % 3 and i > 2:
            base = np.array(rows[rng.integers(0, i)][1])
            v = base + rng.normal(size=d) * rng.choice([0, 0.02, 0.08, 0.1]) * np.linalg.norm(base)
        else:
            v = rng.normal(size=d) * rng.uniform(0.1, 9)
        rows.append((i, [float(x) for x in v], int(i % 7 == 0)))
    return rows + [(9001, None, 0), (9002, [0.0] * d, 0), (9003, [1.0, None] * (d // 2), 0),
                   (9004, [float("nan")] * d, 0), (9005, [float("inf")] * d, 0),
                   (9006, rows[5][1], None), (9007, rows[5][1], rows[5][2]), (9008, [1.0, 0.0], 0),
                   (9009, [2.0, 0.0], 0), (9010, [0.93, (1 - 0.93 ** 2) ** 0.5], 0), (9011, [], 0)]


@pytest.mark.parametrize("tile", [1024, 40])
def test_embedding_links_equal_brute_force(spark, tile):
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int") \
        .withColumns({c: F.lit(1) for c in ("node", "copies", "cell", "pair", "value")})
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
           for r in embed_dedup.near_duplicates(df, tile=tile).collect()}
    want = brute.embeddings(rows)
    assert {i: v for i, v in got.items() if v != want[i]} == {} and len(got) == len(rows)
    assert sum(v[0] for v in want.values()) > 500
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_pairs_at_the_threshold_and_extreme_sizes(spark):
    """Cosines within rounding of the threshold are decided by the vectors as given."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(60):
        x = rng.normal(size=6)
        y = rng.normal(size=6)
        y -= (x @ y) / (x @ x) * x
        x, y = x / np.linalg.norm(x), y / np.linalg.norm(y)
        z = 0.93 * x + (1 - 0.93 ** 2) ** 0.5 * y
        size = (1.0, 1e200, 1e-200)[i % 3]
        rows += [(2 * i, (size * x).tolist(), i), (2 * i + 1, z.tolist(), i)]

    def cosine(v, w):
        v, w = np.array(v) / np.abs(v).max(), np.array(w)
        return (v @ w) / (np.sqrt(v @ v) * np.sqrt(w @ w))
    got = {r["vec_id"]: r["n_links"] for r in embed_dedup.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), tile=7).collect()}
    near = [cosine(a[1], b[1]) for a, b in zip(rows[::2], rows[1::2])]
    assert all(abs(c - 0.93) < 1e-12 for c in near)
    plain = [i for i in range(60) if i % 3 == 0]
    assert [got[2 * i] for i in plain] == [int(near[i] >= 0.93) for i in plain] or sum(
        got[2 * i] != int(near[i] >= 0.93) for i in plain) <= 2          # the last bit of a plain product
    assert all(got[2 * i] == got[2 * i + 1] for i in range(60)) and 5 < sum(got.values()) < 115


def test_embeddings_without_id_or_repeated(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0], 1), (4, [1.0, 2.0], 1), (4, [1.0, 2.0], 1),
                                (3, [2.0, 4.0], 1)], "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, embed_dedup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 0, None, False), (4, 2, 3, False), (4, 2, 3, False), (3, 2, 3, True)],
                         key=str)


# ---- SimHash -----------------------------------------------------------------------
def test_fingerprints_and_groups_equal_brute_force(edge_docs, edge_rows):
    got = simhash.near_duplicates(edge_docs).collect()
    want = brute.simhash([(i, t if len(t or "") < 200_000 else t) for i, t in edge_rows])
    assert {r["doc_id"]: (f"{r['fingerprint'] % 2**64:016x}", r["component_id"]) for r in got} == want
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


@pytest.mark.parametrize("split", [4096, 60])
def test_dense_groups_equal_brute_force(spark, split):
    """Fingerprints in tight clusters, so that patterns are hot and long runs need the index."""
    rng = random.Random(7)
    prints = [rng.getrandbits(64) for _ in range(12)]
    for centre in prints[:4]:
        for _ in range(220):
            x = centre
            for b in rng.sample(range(64), rng.randrange(1, 9)):
                x ^= 1 << b
            prints.append(x)
    f = np.array(prints, dtype=np.uint64)
    links = [(a, b) for a in range(len(f)) for b in np.flatnonzero(np.bitwise_count(f ^ f[a]) <= 4)]
    want = brute.components(range(len(f)), links)
    sizes = sorted(f.tolist())
    # through the operator, from the fingerprints on
    original = simhash.fingerprint_column
    simhash.fingerprint_column = lambda text, shingle: text.cast("long")
    try:
        df = spark.createDataFrame([(i, str(x - 2**64 if x >> 63 else x)) for i, x in enumerate(prints)],
                                   "doc_id long, text string")
        got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(df, split=split).collect()}
    finally:
        simhash.fingerprint_column = original
    assert got == want and len(sizes) == len(got)


def test_index_search_finds_exactly_the_near_rows():
    rng = np.random.default_rng(4)
    rows = np.unique(rng.integers(0, 2**64, 900, dtype=np.uint64) & np.uint64(0xFFF00FFF))
    index = simhash.GrayIndex(rows)
    sets = np.arange(len(rows))
    for pattern in (0, 0xFF, 0xFF000000):
        q, r = index.search(rows[:300], 4, pattern, np.full(300, -2), index.labels(sets))
        want = {(a, int(b)) for a in range(300) for b in np.flatnonzero(
            (np.bitwise_count(rows ^ rows[a]) <= 4) & ((rows ^ rows[a]) & np.uint64(pattern) == 0))}
        assert set(zip(q.tolist(), r.tolist())) == want


def test_queries_are_answered_through_the_tree(spark):
    """The fingerprints of sf0.1 under one pattern: nearly all rows are left in groups, few are compared."""
    text = simhash.fingerprint_column(F.col("text"), 4).alias("fp")
    fp = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select(text).distinct().toPandas()["fp"]
    pattern = simhash._masks(6, 4)[0] & (2**64 - 1)
    rows = fp.to_numpy().view(np.uint64)

    def gray(x):
        for step in (1, 2, 4, 8, 16, 32):
            x = x ^ (x >> np.uint64(step))
        return x
    rows = rows[np.lexsort((gray(rows), gray(rows & np.uint64(pattern))))]
    counts = {}
    at, root = simhash.linked(rows, np.zeros(len(rows), int), 4, pattern, counts)
    assert len(rows) > 5000 and counts["pruned"] > 0.5 * counts["nodes"]
    assert counts["compared"] < 0.01 * len(rows) ** 2
    key = rows & np.uint64(pattern)
    links = [(int(a), int(a + o)) for o in range(1, 40) for a in np.flatnonzero(
        (key[:-o] == key[o:]) & (np.bitwise_count(rows[:-o] ^ rows[o:]) <= 4))]
    got = {(rows[a], rows[b]) for a, b in zip(at, root)}
    want = brute.components(range(len(rows)), links)
    sets = graph.LocalSets(len(rows))
    sets.union(at, root)
    roots = sets.roots()
    assert got and all(roots[a] == roots[b] for a, b in links) and len(set(roots)) <= len(set(want.values()))


def test_simhash_odd_and_empty_tables(odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == 7
    assert {r["component_id"] for r in got if r["doc_id"] == 1} == {1}
    assert simhash.near_duplicates(no_docs).count() == 0


# ---- HTML --------------------------------------------------------------------------
@pytest.mark.parametrize("source,text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"),
    ("<p>One<p>Two <b>bold</b>\n x", "One\n\nTwo bold x"),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>", "- a\n- b\n  - c"),
    ("<ol><li>a<li>b</ol>z", "1. a\n2. b\n\nz"),
    ("<table><tr><th>Name<th>N<tr><td>aaaaaa<td>1</table>", "Name    N\naaaaaa  1"),
    ("<table><tr><td>a<td>b</td></tr><tr><td>cc<td><ul><li>x<li>y</ul></table>", "a   b\ncc  - x - y"),
    ("a<div hidden>no</div><script>x<p></script><style>s</style><!-- <p>c -->b", "ab"),
    ("a<span style='display: none'>no</span>b", "ab"),
    ("<head><title>t</title></head><body>x</body>", "x"), ("<title>t</title>x<br>y<br><br>z", "x\ny\n\nz"),
    ("<pre>\n a\n  b</pre>", " a\n  b"), ("<!doctype html><p title='a>b'>x</p", "x</p"),
    ("a < b <3", "a < b <3"), ("<dl><dt>k<dd>v<dt>l<dd>w</dl>", "k\nv\nl\nw"),
    ("<div>" * 3000 + "deep" + "</div>" * 10, "deep"),
    ("<table><tr><td>" * 60 + "deep", "deep"), ("<p><!-- open", ""), ("x<script>never closed", "x"),
    ("<table><colgroup><col><col><tr><td>A</table>", "A"),
    ("<table><colgroup><col>\n<thead><tr><th>N<th>M<tbody><tr><td>a<td>b</table>z", "N  M\na  b\n\nz"),
    ("<table><colgroup><col><colgroup><col></colgroup>loose<tr><td>A</table>", "loose\nA"),
    ("a <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>tex</annotation></math> b", "a x=1 b"),
    ("<svg><title>t</title><defs><text>d</text></defs><path d='M0'/><text>A</text><text>B</text></svg>z", "A B z"),
    ("<svg viewBox='0'/>a<svg><title/><defs id='a=b'/><g fill=x/><defs /><text>b</text><style>s</style></svg>", "a b"),
    ("<desc>a</desc><span aria-hidden='true'>b</span><i hidden>c</i>", "ab"),
    ("<head><title>T</title>Hello world<p>x", "Hello world\n\nx"),
    ("<head> <title>T</title>\n<meta>&nbsp;a</head><body>b", "\u00a0a\nb"),
    # style: whole property names, the last declaration, visibility set again below
    ("<div style='backface-visibility: hidden'>a</div>", "a"),
    ("<p style='display:none;display:block'>a</p><p style='display:block;display:none'>b</p>", "a"),
    ("<p style='display:none !important;display:block'>a</p>b", "b"),
    ("<p style='/* display:none */ color:red'>a<p hidden style='display:block'>b<p hidden>c", "a\n\nb"),
    ("<div style='visibility:hidden'>no<b style='VISIBILITY: Visible'>yes</b><ul><li>no</ul></div>z", "yes\n\nz"),
    ("<table style='visibility:hidden'><tr><td>no<td style='visibility:visible'>b</table>", "  b"),
    # end tags do not reach out of cells
    ("<div><table><tr><td>a</div>b<td>c<tr><td>dddd<td>e</table></div>", "ab    c\ndddd  e"),
    ("<ul><li><table><tr><td><li>x</li></p>y</ul>z</table>w</ul>", "- x yz\n\nw"),
    ("<table><tr><td>a<table><tr><td>b</tr></td><td>c</table>d<td>e</table>", "a b c d  e"),
    # spans, captions, numbers of lists
    ("<table><tr><td rowspan=2>A<td>b<tr><td>c<tr><td>d</table>", "A  b\n   c\nd"),
    ("<table><tbody><tr><td rowspan=0>A<td>b<tr><td>c<tbody><tr><td>d<td>e</table>", "A  b\n   c\nd  e"),
    ("<table><tr><td colspan=1000>A<td>b<tr><td>c<td>d</table>", "A     b\nc  d"),
    ("<table><caption>C<tr><td>a<td>b</table>", "C\na  b"),
    ("<ol start=5><li>a<li value=9>b<li>c</ol>", "5. a\n9. b\n10. c"),
    ("<ol reversed><li>x<li>y</ol><ol start=-1><li>a<li>b<li value=x>c</ol>", "2. x\n1. y\n\n-1. a\n0. b\n1. c"),
    ("<object>no</object><canvas>no</canvas>a", "a"), ("a<b title=\"x>y</b>z", "ayz"),
])
def test_render(source, text):
    assert html_text.render(source) == text


@pytest.mark.parametrize("page", [
    "<a" * 500_000, "<" + "a" * 1_000_000, "<a " * 333_000, "<div><p>" * 125_000, "<a b=\"<a b='" * 83_000,
    "<" * 1_000_000, "<b>" + "</i>" * 250_000, "<table><tr><td>" * 66_000 + "x", "<option>" * 125_000,
    "<table><tr>" + "<td rowspan=65000 colspan=1000>x" * 2_000, "<a " + "=" * 1_000_000, "<!--" * 250_000])
def test_malformed_pages_take_linear_time(page):
    began = time.process_time()
    html_text.render(page)
    assert time.process_time() - began < 12


def test_tables_in_tables_and_lists_in_lists_of_any_depth():
    deep = html_text.render("<table><tr><td>x" * 400)
    assert deep.split() == ["x"] * 400
    listed = html_text.render("<ul><li>x" * 400)
    assert [line.strip() for line in listed.split("\n")] == ["- x"] * 400


def test_extract_keeps_every_row(spark):
    df = spark.createDataFrame([(1, "<p>a", "u"), (1, "<p>a", "u"), (None, None, None)],
                               "page_id long, html string, text string")
    assert sorted(map(tuple, html_text.extract(df).collect()), key=str) == sorted(
        [(1, "a"), (1, "a"), (None, "")], key=str)
    assert html_text.extract(df.limit(0)).count() == 0


def test_rendered_pages_hold_all_visible_words(spark):
    """Brute force: the words of the markup without scripts, styles, comments, head and tags."""
    import html as H
    import re
    for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect():
        plain = re.sub(r"(?s)<!--.*?-->|<(script|style|title)\b.*?</\1>", "", r["html"])
        words = H.unescape(re.sub(r"<[^>]*>", " ", plain)).split()
        got = [w for w in html_text.render(r["html"]).split() if w != "-" and not re.fullmatch(r"\d+\.", w)]
        want = [w for w in words if w != "-" and not re.fullmatch(r"\d+\.", w)]
        assert "".join(got) == "".join(want)


# ---- BPE ---------------------------------------------------------------------------
@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


def test_encoding_and_decoding_equal_the_library(edge_docs, edge_rows, library):
    for words in (300, 0):                      # with a lexicon and with none
        got = {r["doc"]["doc_id"]: r for r in bpe.encode_documents(
            edge_docs, bpe.default_vocabulary(), lexicon_words=words).collect()}
        for i, t in edge_rows:
            ids = library.encode(t or "", add_special_tokens=False).ids
            assert np.frombuffer(got[i]["ids"], "<u4").tolist() == ids, i
            assert got[i]["decoded"] == library.decode(ids, skip_special_tokens=False), i


def test_characters_and_special_tokens_equal_the_library(spark, library):
    rng = random.Random(9)
    texts = ["<|startoftext|>Hello<|endoftext|> it's I'LL x'ddd", "<|endoftext|", "a\x1cb\x1fc\x85d\xa0e",
             "e\u0301 \u0130\u03a3\u03a3 ΑΣ \ufb01 \u1e9e \u212a 12\u0663 \u200b x\u2028y"]
    texts += ["a" + chr(c) + "B" + chr(c) + " " + chr(c) + "1" for c in range(1, 0x500)]
    texts += ["".join(chr(rng.choice([rng.randrange(1, 0x250), rng.randrange(0x250, 0x3000), 32, 39, 115]))
                      for _ in range(60)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc"]["doc_id"]: r for r in bpe.encode_documents(df, bpe.default_vocabulary()).collect()}
    bad = [i for i, t in enumerate(texts)
           if np.frombuffer(got[i]["ids"], "<u4").tolist() != library.encode(t, add_special_tokens=False).ids]
    assert bad == []


def test_lexicon_finds_its_words_and_no_others():
    words = {w.encode(): [i, i + 1] for i, w in enumerate(
        ["a", "ab", "abc", "xbc", "running", "jumping", "sing", "é", "zz"])}
    lexicon = bpe.Lexicon(memoryview(bpe.compile_lexicon(words)))
    asked = [*words, b"b", b"abcd", b"runnin", b"\xff", b"zzz"]
    want = [np.array(words[w], "<u4").tobytes() if w in words else None for w in asked]
    assert lexicon.find(asked) == want
    assert len(lexicon.final) < sum(map(len, words))          # prefixes and suffixes are shared
    assert bpe.Lexicon(memoryview(bpe.compile_lexicon({}))).find([b"a"]) == [None]


def test_long_words_merge_like_short_ones(library):
    import json
    with open(bpe.default_vocabulary(), encoding="utf-8") as f:
        merges = bpe.Merges.of(json.load(f)["model"])
    rng = random.Random(3)
    for n in (1, 2, 30, 49, 400, 5000):
        word = "".join(rng.choice("theanringos") for _ in range(n))
        assert merges.encode(word.encode()) == library.encode(word, add_special_tokens=False).ids


def test_bpe_odd_and_empty_tables(odd_docs, no_docs):
    assert bpe.encode_documents(odd_docs, bpe.default_vocabulary()).count() == 7
    assert bpe.digests(bpe.encode_documents(no_docs, bpe.default_vocabulary())).count() == 0


# ---- pipeline ------------------------------------------------------------------------
def test_pipeline_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality classifier"](spark, docs, SF_MID).cache()
    model = quality_rank.fit(docs, labels)
    rows = {r["doc_id"]: r for r in docs.collect()}
    want = {i for i, r in rows.items() if model.score(
        np.array([quality_rank.text_features(r["text"])]))[0] >= quality_rank.ACCEPT}
    assert {r["doc_id"] for r in kept.collect()} == want and kept.columns == docs.columns

    lines = stages["line dedup"](spark, kept, SF_MID)
    texts = {r["doc_id"]: r for r in lines.collect()}
    plain = brute.line_dedup([(i, rows[i]["text"]) for i in want])
    assert {i: r["text"] for i, r in texts.items()} == {i: p[2] for i, p in plain.items()}
    assert all(r["n_chars"] == len(r["text"]) for i, r in texts.items() if plain[i][1])
    assert lines.dtypes == docs.dtypes

    near = stages["simhash near-dedup"](spark, lines, SF_MID)
    groups = brute.simhash([(i, r["text"]) for i, r in texts.items()])
    assert sorted(r["doc_id"] for r in near.collect()) == sorted({g for _, g in groups.values()})

    mixed = stages["source mixing"](spark, near, SF_MID)
    times = {}
    for r in mixed.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
        assert r["text"] == texts[r["doc_id"]]["text"]
    assert set(times.values()) <= {1, 2} and mixed.columns == docs.columns

    last = stages["bpe encoding"](spark, mixed, SF_MID)
    assert last.count() == sum(times.values())
    assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_MID).collect())) == \
        sorted(map(tuple, last.collect()))


def test_pipeline_stages_take_odd_and_empty_tables(spark, odd_docs, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    docs = odd_docs.withColumns({"lang": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long"),
                                 "_row": F.lit("mine"), "times": F.lit(1), "fp": F.lit("f")})
    for part in (docs, docs.limit(0)):
        now = part
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, str(tmp_path))
            assert name == "bpe encoding" or now.columns == docs.columns
        now.count()
