"""Plain versions of the contracts, and small tables with every awkward case."""

import hashlib
import re

import numpy as np
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Extra columns whose names operators use themselves.
    T.StructField("size", T.LongType()), T.StructField("bucket", T.StringType()), T.StructField("set_id", T.StringType()),
    T.StructField("row", T.StringType()), T.StructField("carry", T.StringType()), T.StructField("n_tokens", T.StringType()),
])


def frame(spark, rows, parts=3):
    """Documents out of (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), 1, "b", "s", "r", "c", "t") for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts)


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def near_copies(seed=3, n=60, words=80):
    """Documents in families: exact copies, copies with few changes, copies with many, unrelated ones."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(400)]
    base = [list(rng.choice(vocabulary, words)) for _ in range(5)]
    rows = []
    for i in range(n):
        own = list(base[i % 5]) if i % 6 else list(rng.choice(vocabulary, int(rng.integers(1, words))))
        for at in rng.integers(0, len(own), int(rng.integers(0, 5))):
            own[at] = str(rng.choice(vocabulary))
        rows.append((600 + i * 3, " ".join(own)))
    return rows


AWKWARD = [
    (-5, None), (0, ""), (2, "   \n\t "), (3, "one"), (4, "One"), (6, "a b c"), (7, "a b c"), (8, "A\tb\x0bc d"), (9, "…—!!"),
    (10, "日本語 テキスト 日本語"), (11, "x" * 300), (12, ("long text of many words " * 900)), (13, ("long text of many words " * 900)),
    (14, "éé " * 40 + "  \x85 \x1c end"), (None, "no id has this text at all"), (15, "tie"), (15, "tie"),
]


def components(rows, n, num, den):
    sets = {}
    for d, t in rows:
        w = spaced(t)
        sets[d] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def without_repeats(rows, length=50):
    first = {}
    for d, t in sorted(r for r in rows if r[0] is not None):
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            first.setdefault(b[i : i + length], d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        hit = np.zeros(len(b), bool)
        if d is not None:
            for i in range(len(b) - length + 1):
                if first[b[i : i + length]] < d:
                    hit[i : i + length] = True
        runs = int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum())
        kept = bytes(x for x, h in zip(b, hit) if not h)
        out.append((d, len(b), int(hit.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def contamination(rows, items):
    windows = {}
    for item, text in items:
        w = plain_words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add("null" if item is None else str(item))
    sizes = {len(x) for x in windows}
    out = []
    for d, text in rows:
        w = plain_words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    found |= windows[tuple(w[i : i + n])]
                    hit |= set(range(i, i + n))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)
