"""Plain versions of the operators' contracts, for small fixtures."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

SP = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


KEYWORD = "password|passwd|secret|token|api_?key"
ASSIGN = re.compile("(" + re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", KEYWORD) + ")"
                    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def base_secrets(text):
    t = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t)
            if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out)


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    return host.translate(LOW), re.match("[^?#]*", rest[len(host):])[0]


def url_rule(host, path):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    fits = [(len(h + p), h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def line_dedup(docs):
    """docs: (doc_id, text), unique ids; {doc_id: (n_lines, n_dropped, kept)}."""
    holders = defaultdict(set)

    def key(line):
        return line.strip(SP).translate(LOW)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(i)
    out = {}
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 2 or min(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def components(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def fingerprint(text, k=4):
    words = WORD.findall((text or "").translate(LOW))
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(docs, distance=4):
    prints = {i: fingerprint(t) for i, t in docs}
    ids = sorted(prints)
    f = np.array([prints[i] for i in ids], dtype=np.uint64)
    links = [(ids[a], ids[b]) for a in range(len(ids))
             for b in np.flatnonzero(np.bitwise_count(f ^ f[a]) <= distance)]
    groups = components(ids, links)
    return {i: (f"{prints[i]:016x}", groups[i]) for i in ids}


def embeddings(rows, threshold=0.93):
    """rows: (vec_id, vector or None, label); {vec_id: (n_links, component, kept)}."""
    def good(v, label):
        return v is not None and label is not None and all(
            x is not None and math.isfinite(x) for x in v) and any(v)
    usable = [(i, np.array(v, float), g) for i, v, g in rows if good(v, g)]
    links, degree = [], Counter()
    by = defaultdict(list)
    for i, v, g in usable:
        by[g, len(v)].append((i, v))
    for part in by.values():
        x = np.stack([v for _, v in part])
        n = np.sqrt((x * x).sum(1))
        close = (x @ x.T) / n[:, None] / n >= threshold
        for a, b in zip(*np.nonzero(close)):
            if a != b:
                links.append((part[a][0], part[b][0]))
                degree[part[a][0]] += 1
    groups = components([i for i, _, _ in rows], links)
    return {i: (degree[i], groups[i], groups[i] == i) for i, _, _ in rows}


def text_counts(text):
    t = text or ""
    words = WORD.findall(t)
    seen, dups = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", t)), dups, len(hit))


def mix_targets(sizes, share=1.5):
    """sizes: {source: words}; targets by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not full:
            return {**out, **{s: left * weight[s] / total for s in open_}}
        for s in full:
            out[s] = 2.0 * sizes[s]
        left -= sum(out[s] for s in full)
        open_ -= full
    return out
