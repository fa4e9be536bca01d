"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

1. Words are counted over the whole corpus and the most frequent ones are
   encoded once.
2. They are compiled into a minimal acyclic automaton: words share prefixes
   and suffixes, every arc stores how many words come before it, and the sum
   along a word's path is the word's number, under which its ids are stored.
3. The automaton is one flat file.  Spark hands it to every executor, where the
   workers memory-map it.
4. Words that are not in the lexicon are merged exactly, pair by pair in rank
   order, so the result never depends on what the lexicon holds.

The vocabulary file is a parameter and is read where the job is started only.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
import struct
import uuid
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tollflow.llm.common import packed, read_table, sha256_hex, stored, text_or_empty
from tollflow.session import scratch_path

LEXICON_WORDS = 200_000    # bound on the frequent words that are compiled
MEMO = 120_000             # chunks of a generation that a worker remembers; it keeps two
COUNTED = 150_000          # distinct chunks that a worker counts before it passes them on
ROWS = 500                 # texts handled together in a worker
SIDE_BY_SIDE = 32          # bytes of a word up to which words are merged together
TAILS = ".,;:!?"           # signs that often follow a word
# plain: below U+0250, where lower() and the NFC form are the library's own, and without the
# controls that Python but not the library takes for white space
NOT_PLAIN = re.compile("[\x1c-\x1fɐ-\U0010ffff]")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte value (byte-level BPE's fixed convention)."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names, spare = {b: chr(b) for b in kept}, 0x100
    for b in range(256):
        if b not in names:
            names[b] = chr(spare)
            spare += 1
    return [names[b] for b in range(256)]


class Words:
    """Splits texts into the tokenizer's words, given its configuration without the vocabulary.

    White space never stands inside a word, so a plain text is cut at white
    space first and each distinct chunk is split by the word pattern once.
    Other texts go through the library's own normalizer and pre-tokenizer.
    """

    def __init__(self, config: str):
        spec = json.loads(config)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(
            self.special, key=len, reverse=True))) + ")") if self.special else None
        splits = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.pattern = regex.compile(splits[0]["pattern"]["Regex"])
        tool = Tokenizer.from_str(json.dumps(
            {**spec, "added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}}))
        self.normalizer, self.splitter = tool.normalizer, tool.pre_tokenizer
        self.to_byte = {ord(s): b for b, s in enumerate(byte_symbols())}

    def chunks(self, text: str) -> list[str]:
        """White-space separated pieces, special tokens on their own."""
        if any(s in text for s in self.special):
            out = []
            for i, part in enumerate(self.cut.split(text)):
                out += [part] if i % 2 else self.chunks_of(part)
            return out
        return self.chunks_of(text)

    def chunks_of(self, text: str) -> list[str]:
        if NOT_PLAIN.search(text) is None:
            return text.lower().split()
        words = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))
        # back from byte symbols to text; a marked piece is one whole word
        return ["\x1c" + bytes(self.to_byte[ord(c)] for c in w).decode() for w, _ in words]

    def words(self, chunk: str) -> list[bytes]:
        if chunk.startswith("\x1c"):
            return [chunk[1:].encode()]
        if chunk.isalpha():                            # the common cases, without the pattern
            return [chunk.encode()]
        if chunk[-1] in TAILS and chunk[:-1].isalpha():
            return [chunk[:-1].encode(), chunk[-1].encode()]
        return [w.encode() for w in self.pattern.findall(chunk)]


class Merges:
    """Exact BPE of single words from the vocabulary.

    ``ranks`` gives the rank of a pair of ids (packed into one number), ``merged``
    the id that the merge of that rank makes.
    """

    def __init__(self, first: list, last: list, ranks: dict, merged: list):
        self.first, self.last, self.ranks, self.merged = first, last, ranks, merged
        # the same as arrays, for words that are merged side by side
        self.complete = bool(merged) and None not in first and None not in last
        if self.complete:
            self.first_ids, self.last_ids, self.merged_ids = (
                np.array(a, np.int64) for a in (first, last, merged))
            keys = np.array(list(ranks), np.int64)
            order = np.argsort(keys)
            self.keys, self.key_ranks = keys[order], np.array(list(ranks.values()), np.int64)[order]

    @classmethod
    def of(cls, model: dict) -> Merges:
        vocab, end, symbols = model["vocab"], model["end_of_word_suffix"] or "", byte_symbols()
        ranks = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in enumerate(model["merges"])}
        return cls([vocab.get(s) for s in symbols], [vocab.get(s + end) for s in symbols], ranks,
                   [vocab[a + b] for a, b in model["merges"]])

    def encode(self, word: bytes) -> list[int]:
        first = self.first
        ids = [first[b] for b in word[:-1]]
        ids.append(self.last[word[-1]])
        if None in ids:                  # a byte that the vocabulary lacks has no id
            ids = [x for x in ids if x is not None]
        return self._short(ids) if len(ids) <= 48 else self._long(ids)

    def _short(self, ids: list[int]) -> list[int]:
        """Lowest rank first, leftmost among equals; only the pairs beside a merge change."""
        get, none = self.ranks.get, len(self.merged)
        ranks = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks:
            rank = min(ranks)
            if rank == none:
                break
            i = ranks.index(rank)
            ids[i:i + 2] = [self.merged[rank]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get(ids[i] << 32 | ids[i + 1], none)
            if i:
                ranks[i - 1] = get(ids[i - 1] << 32 | ids[i], none)
        return ids

    def encode_all(self, words: list[bytes]) -> list[bytes]:
        """Little-endian ids of each word; short words are merged side by side, in the same order."""
        out = [b""] * len(words)
        short = []
        for i, w in enumerate(words):
            if 1 < len(w) <= SIDE_BY_SIDE and self.complete:
                short.append(i)
            else:
                ids = self.encode(w) if w else []
                out[i] = struct.pack(f"<{len(ids)}I", *ids)
        for lo in range(0, len(short), 16384):
            part = short[lo:lo + 16384]
            for i, ids in zip(part, self._merged([words[i] for i in part])):
                out[i] = ids
        return out

    def _merged(self, words: list[bytes]) -> list[bytes]:
        n, length = len(words), np.array([len(w) for w in words])
        width = int(length.max())
        flat = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        ids = self.first_ids[flat]
        ids[np.arange(n), length - 1] = self.last_ids[flat[np.arange(n), length - 1]]
        none, columns = len(self.merged), np.arange(width)
        ids[columns >= length[:, None]] = -1
        ranks = np.full((n, width), none)
        ranks[:, :-1] = self._rank(ids[:, :-1], ids[:, 1:])
        done, at = [None] * n, np.arange(n)
        while True:
            place = ranks.argmin(1)
            least = ranks[np.arange(len(at)), place]
            ended = least == none
            if ended.any():
                for i, row in zip(at[ended].tolist(), ids[ended]):
                    done[i] = row[row >= 0].astype("<u4").tobytes()
                at, ids, ranks, place, least = (a[~ended] for a in (at, ids, ranks, place, least))
                if not len(at):
                    return done
            rows = np.arange(len(at))
            ids[rows, place] = self.merged_ids[least]
            after = columns[None, :-1] > place[:, None]      # what stands behind the merge moves up
            ids[:, :-1] = np.where(after, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            ranks[:, :-1] = np.where(after, ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = none
            ranks[rows, place] = self._rank(ids[rows, place], ids[rows, np.minimum(place + 1, width - 1)])
            before = rows[place > 0]
            left = place[before] - 1
            ranks[before, left] = self._rank(ids[before, left], ids[before, left + 1])

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; the number of merges where there is none (-1: no id)."""
        key = a << 32 | b
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[found] == key) & (b >= 0), self.key_ranks[found], len(self.merged))

    def _long(self, ids: list[int]) -> list[int]:
        """The same order of merges with a heap over (rank, place)."""
        n, ranks = len(ids), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def push(i: int) -> None:
            if i >= 0 and after[i] < n:
                key = ids[i] << 32 | ids[after[i]]
                if key in ranks:
                    heapq.heappush(heap, (ranks[key], i, key))
        for i in range(n - 1):
            push(i)
        while heap:
            rank, i, key = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or ids[i] << 32 | ids[j] != key:
                continue
            ids[i], ids[j] = self.merged[rank], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            push(before[i])
            push(i)
        return [x for x in ids if x >= 0]


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """Minimal acyclic automaton of the words with their ids, as one flat file."""
    # states are built bottom-up for sorted words; equal right languages share one state
    register: dict[tuple, int] = {}
    states: list[tuple] = []

    def frozen(node) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    path = [[False, []]]                 # of the last word: [final, [(byte, state)]]
    last = b""
    ordered = sorted(words)
    for word in ordered:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        for i in range(len(last), common, -1):
            child = frozen(path.pop())
            path[-1][1].append((last[i - 1], child))
        path += [[False, []] for _ in range(len(word) - common)]
        path[-1][0] = True
        last = word
    for i in range(len(last), 0, -1):
        child = frozen(path.pop())
        path[-1][1].append((last[i - 1], child))
    root = frozen(path[0])
    below = [0] * len(states)            # words accepted from a state; children come first
    keys, target, skip = [], [], []
    for s, (final, arcs) in enumerate(states):
        count = int(final)
        for byte, child in arcs:
            keys.append(s * 256 + byte)
            target.append(child)
            skip.append(count)
            count += below[child]
        below[s] = count
    ids = [words[w] for w in ordered]
    arrays = {
        "keys": np.array(keys, "<i8"), "target": np.array(target, "<i8"),
        "skip": np.array(skip, "<i8"), "final": np.array([s[0] for s in states], "u1"),
        "offset": np.cumsum([0, *map(len, ids)]).astype("<i8"),
        "ids": np.array([x for i in ids for x in i], "<u4")}
    head, at = {"root": root, "arrays": {}}, 0
    for name, a in arrays.items():
        head["arrays"][name] = [at, a.dtype.str, len(a)]
        at += -(-a.nbytes // 8) * 8
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    return b"".join([len(text).to_bytes(8, "little"), text,
                     *[a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays.values()]])


class Lexicon:
    """A compiled lexicon over any buffer, such as a memory map."""

    def __init__(self, buffer):
        size = int.from_bytes(buffer[:8], "little")
        head = json.loads(bytes(buffer[8:8 + size]))
        self.root = head["root"]
        for name, (at, kind, n) in head["arrays"].items():
            setattr(self, name, np.frombuffer(buffer, kind, n, 8 + size + at))

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def find(self, words: list[bytes]) -> list[bytes | None]:
        """Ids of each word as little-endian bytes, or None; all words walk together."""
        if not words or not len(self.keys):
            return [None] * len(words)
        length = np.array([len(w) for w in words])
        flat = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(length) - length
        state = np.full(len(words), self.root)
        number = np.zeros(len(words), np.int64)
        live = np.arange(len(words))
        for step in range(int(length.max())):
            walking = live[length[live] > step]
            if not len(walking):
                break
            key = state[walking] * 256 + flat[start[walking] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[arc] == key
            state[walking[~ok]] = -1
            walking, arc = walking[ok], arc[ok]
            number[walking] += self.skip[arc]
            state[walking] = self.target[arc]
            live = np.flatnonzero(state >= 0)
        found = (state >= 0) & (self.final[state] == 1)
        cut = self.offset
        return [self.ids[cut[k]:cut[k + 1]].tobytes() if f else None
                for f, k in zip(found.tolist(), number.tolist())]


def word_counts(docs: DataFrame, config: str) -> DataFrame:
    """(word, n) of the whole corpus.

    White-space separated chunks are counted first, in each worker and then by
    Spark; only the distinct ones are split into words.  Chunks outside the plain
    characters are split as they stand, which can only put a word into the
    lexicon that is never asked for.
    """
    def count(batches):
        seen = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update((text.as_py() or "").lower().split())
                if len(seen) > COUNTED:
                    yield counted(seen)
                    seen = Counter()
        yield counted(seen)

    def counted(seen):
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())],
                                          ["chunk", "n"])

    def split(batches):
        tool = Words(config)
        for batch in batches:
            words = Counter()
            for chunk, n in zip(batch["chunk"], batch["n"]):
                if chunk and chunk not in tool.special:
                    for w in tool.words(chunk):
                        words[w] += n
            yield pd.DataFrame({"word": list(words), "n": list(words.values())})

    chunks = docs.select(text_or_empty().alias("text")).mapInArrow(count, "chunk string, n long") \
        .groupBy("chunk").agg(F.sum("n").alias("n"))
    return chunks.mapInPandas(split, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(docs: DataFrame, config: str, most: int) -> list[bytes]:
    """At most ``most`` words: the longest run of the highest count classes that fits.

    Counts fall into classes of an eighth of a power of two.  Only the sizes of
    the classes and the chosen words leave the executors; no task gathers more.
    """
    rank = F.floor(F.log2("n") * 8).cast("int")
    counts = stored(word_counts(docs, config).select("word", rank.alias("rank")), "word-counts")
    room, least = most, None
    for r in sorted(counts.groupBy("rank").count().collect(), key=lambda r: -r["rank"]):
        room -= r["count"]
        if room < 0:
            break
        least = r["rank"]
    if least is None:
        return []
    chosen = counts.where(F.col("rank") >= least).select("word")
    return [bytes(r["word"]) for r in chosen.collect() if r["word"]]       # at most ``most`` rows


class Encoder:
    """Ids of texts, by the lexicon and by merging what it lacks.

    Chunks are remembered in two generations: when the younger is full the older
    one goes, and what is asked for again moves from the older to the younger.
    """

    def __init__(self, tool: Words, lexicon: Lexicon, merges: Merges, room: int = MEMO):
        self.tool, self.lexicon, self.merges, self.room = tool, lexicon, merges, room
        self.special = {s: i.to_bytes(4, "little") for s, i in tool.special.items()}
        self.young, self.old = dict(self.special), {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian ids of each text."""
        chunks = [self.tool.chunks(t or "") for t in texts]
        if len(self.young) > self.room:
            self.old, self.young = self.young, dict(self.special)
        young, old, new = self.young, self.old, []
        for c in set().union(*chunks) - young.keys():
            if c in old:
                young[c] = old[c]
            else:
                new.append(c)
        self._learn(new)
        known = young.__getitem__
        return [b"".join(map(known, c)) for c in chunks]

    def _learn(self, new: list[str]) -> None:
        """Whole words first; a word with one sign behind it is made of two of them."""
        young, plain, tailed, other = self.young, [], [], []
        for c in new:
            if c.isalpha():
                plain.append(c)
            elif c[-1] in TAILS and c[:-1].isalpha():
                tailed.append(c)
            else:
                other.append(c)
        bodies = {c[:-1] for c in tailed}.difference(plain) - young.keys()
        self._learn_words([*plain, *bodies], young)
        tails = {}
        self._learn_words(list({c[-1] for c in tailed}), tails)
        young.update([(c, young[c[:-1]] + tails[c[-1]]) for c in tailed])
        split = [self.tool.words(c) for c in other]
        ids = self._ids(list({w for ws in split for w in ws}))
        young.update((c, b"".join([ids[w] for w in ws])) for c, ws in zip(other, split))

    def _learn_words(self, words: list[str], into: dict) -> None:
        raw = [w.encode() for w in words]
        ids = self._ids(raw)
        into.update(zip(words, map(ids.__getitem__, raw)))

    def _ids(self, words: list[bytes]) -> dict[bytes, bytes]:
        ids = dict(zip(words, self.lexicon.find(words)))
        unseen = [w for w, found in ids.items() if found is None]
        ids.update(zip(unseen, self.merges.encode_all(unseen)))
        return ids


class Codec:
    """Encoder and decoder for one vocabulary and one corpus lexicon."""

    def __init__(self, spark: SparkSession, vocabulary: str, docs: DataFrame,
                 lexicon_words: int = LEXICON_WORDS):
        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        self.config = json.dumps({**spec, "model": None})
        self.merges = Merges.of(spec["model"])
        names = {i: t for t, i in spec["model"]["vocab"].items()}
        names.update({t["id"]: t["content"] for t in spec["added_tokens"]})
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        words = frequent_words(docs, self.config, lexicon_words)
        self.file = share_file(spark, compile_lexicon(
            {w: self.merges.encode(w) for w in words}))

    def apply(self, docs: DataFrame) -> DataFrame:
        """doc -> doc, ids, decoded, in one pass.

        The results leave the worker ROWS rows at a time, and the words of a
        worker's earlier batches stay remembered.
        """
        config, merges, names, file = self.config, self.merges, self.names, self.file

        def run(batches):
            encoder = Encoder(Words(config), Lexicon.mapped(SparkFiles.get(file)), merges)
            table = np.array(names, dtype=object)
            for batch in batches:
                for lo in range(0, batch.num_rows, ROWS):
                    doc = batch.slice(lo, ROWS).column(0)
                    ids = encoder.encode(pc.struct_field(doc, "text").to_pylist())
                    texts = [decode_ids(table, b) for b in ids]
                    yield pa.RecordBatch.from_arrays(
                        [doc, pa.array(ids, pa.binary()), pa.array(texts, pa.string())],
                        ["doc", "ids", "decoded"])

        return docs.mapInArrow(run, T.StructType([
            *docs.schema.fields, T.StructField("ids", T.BinaryType()),
            T.StructField("decoded", T.StringType())]))

    def decode(self, ids: Column) -> Column:
        """Text of a binary column of ids from anywhere."""
        names = self.names

        @F.pandas_udf("string")
        def decoded(batch: pd.Series) -> pd.Series:
            table = np.array(names, dtype=object)
            return pd.Series([decode_ids(table, b) for b in batch], dtype=object)
        return decoded(ids)


def decode_ids(table: np.ndarray, ids: bytes) -> str:
    """Names of the ids joined by spaces, as the vocabulary has no decoder."""
    return " ".join(table[np.frombuffer(ids, "<u4")])


def share_file(spark: SparkSession, data: bytes) -> str:
    """Write bytes to the shared folder and let Spark bring the file to every executor."""
    sc, name = spark.sparkContext, f"lexicon-{uuid.uuid4().hex}.bin"
    path = sc._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "lexicon") + "/" + name)
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    out.write(data)
    out.close()
    sc.addFile(path.toString())
    return name


def encode_documents(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """doc (the input row as a struct), ids (binary), decoded; one row per input row.

    NULL text is empty.  Special tokens written in a text get their ids, as in
    the library.  Texts and words may be of any length.
    """
    codec = Codec(docs.sparkSession, vocabulary, docs.select("text"), **options)
    return codec.apply(packed(docs))


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc.doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), sha256_hex(F.col("decoded")).alias("decoded_sha256"))


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op8_bpe_encoding(spark, sf_dir: str) -> DataFrame:
    """Digests of ``encode_documents`` over all documents with the 49k word vocabulary."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(encode_documents(docs, default_vocabulary()))
