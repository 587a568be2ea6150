r"""Benchmark decontamination by winnowing.

Fingerprints: in every seven consecutive 7-word grams the least hash is kept, on both sides by the same rule, so two
texts that share 13 words in a row share a fingerprint inside them. Fingerprints of documents are joined with those of
the benchmark, every hit is extended word by word to both sides, and hits of at least 13 shared words count. Items of
fewer words are looked up as a whole.

The benchmark is a reference set that is small beside the corpus. It is taken in blocks of at most BLOCK_BYTES of text;
each block is indexed once and broadcast, and the documents are read once per block without a shuffle. The blocks'
hits are united by document.

Null texts have no words; an item or document without words never matches; a null item id is named ``null``; items
that repeat an id count once; repeated documents are judged one by one; an empty benchmark leaves every document
clean, an empty table of documents gives an empty result; other columns are ignored. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrow import chained, lists, text_buffer, text_chunks
from tidemark.llm.words import PLAIN, grams, within_text, word_hashes

WINDOW, GRAM = 13, 7
BLOCK_BYTES = 32 << 20
PAIRS = 1 << 20
NOTHING = hashlib.sha256(b"").hexdigest()


def fingerprints(words: np.ndarray, first: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the kept grams: the least of every window - gram + 1 neighbours, the first on ties."""
    h = grams(words, gram)
    reach = window - gram + 1
    if len(h) < reach:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    # Windows that cross texts only add fingerprints; grams that cross texts are left out below.
    least = np.lib.stride_tricks.sliding_window_view(h, reach).argmin(axis=1)
    chosen = np.zeros(len(h), bool)
    chosen[least + np.arange(len(least))] = True
    at = np.flatnonzero(chosen & within_text(first, gram, len(h)))
    return at, h[at]


class Index:
    """Fingerprints and whole short items of one block of the benchmark."""

    def __init__(self, names: list[str], data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM):
        self.window, self.gram, self.names = window, gram, names
        self.words, self.first = word_hashes(data, offsets, PLAIN)
        at, h = fingerprints(self.words, self.first, window, gram)
        order = np.argsort(h, kind="stable")
        self.at, self.hashes = at[order], h[order]
        counts = np.diff(self.first)
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in range(1, window):
            rows = np.flatnonzero(counts == n)
            if len(rows):
                own = grams(self.words, n)[self.first[rows]]
                order = np.argsort(own, kind="stable")
                self.short[n] = own[order], rows[order]
        self.item_of = np.repeat(np.arange(len(names)), counts)

    def pairs(self, h: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(index into h, index into hashes) of all equal values, in parts of bounded size."""
        low, high = np.searchsorted(hashes, h, side="left"), np.searchsorted(hashes, h, side="right")
        hit = np.flatnonzero(high > low)
        counts = (high - low)[hit]
        total = np.cumsum(counts)
        begin = 0
        while begin < len(hit):
            end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + PAIRS, side="right")))
            n = counts[begin:end]
            left = np.repeat(hit[begin:end], n)
            yield left, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[left]
            begin = end

    def hits(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end (in words of all texts) and item of every extended hit."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        counts = np.diff(first)
        text_low, text_high = np.repeat(first[:-1], counts), np.repeat(first[1:], counts)
        at, h = fingerprints(words, first, self.window, self.gram)
        more = self.window - self.gram
        for i, j in self.pairs(h, self.hashes):
            p, b = at[i], self.at[j]
            item = self.item_of[b]
            left, right = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
            going_left, going_right = np.ones(len(p), bool), np.ones(len(p), bool)
            for step in range(1, more + 1):
                going_left &= (p - step >= text_low[p]) & (b - step >= self.first[item])
                going_left &= words[np.maximum(p - step, 0)] == self.words[np.maximum(b - step, 0)]
                left += going_left
                to, bo = p + self.gram + step - 1, b + self.gram + step - 1
                going_right &= (to < text_high[p]) & (bo < self.first[item + 1])
                going_right &= words[np.minimum(to, len(words) - 1)] == self.words[np.minimum(bo, len(self.words) - 1)]
                right += going_right
            enough = left + self.gram + right >= self.window
            out.append(((p - left)[enough], (p + self.gram + right)[enough], item[enough]))
        for n, (own, rows) in self.short.items():
            h = grams(words, n)
            p = np.flatnonzero(within_text(first, n, len(h)))
            for i, j in self.pairs(h[p], own):
                out.append((p[i], p[i] + n, rows[j]))
        if not out:
            return tuple(np.zeros(0, np.int64) for _ in range(3))
        return tuple(np.concatenate(x).astype(np.int64) for x in zip(*out))


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the spans."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], s[1:] > e[:-1]])
    return s[new], e[np.concatenate([new[1:], [True]])]


def _row(n_words: int, starts: np.ndarray, ends: np.ndarray, items: list[str]) -> tuple:
    n_hit = int((ends - starts).sum())
    digest = hashlib.sha256(",".join(items).encode()).hexdigest() if items else NOTHING
    return n_hit, len(items), digest, n_hit > 0 and 20 * n_hit >= n_words


HITS = "doc_id long, text_key long, n_words long, starts array<long>, ends array<long>, items array<string>"
RESULT = "n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _scan(shared):
    names = [x.split()[0] for x in HITS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for rows, data, offsets in text_chunks(batches, "text"):
            words, first = word_hashes(data, offsets, PLAIN)
            starts, ends, items = index.hits(words, first)
            doc = np.searchsorted(first, starts, side="right") - 1
            s, e, named = [], [], [[] for _ in range(len(rows))]
            counts = np.zeros(len(rows), np.int64)
            order = np.argsort(doc, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1) if len(order) else []:
                d = doc[part[0]]
                a, b = _merged(starts[part] - first[d], ends[part] - first[d])
                s.append(a)
                e.append(b)
                counts[d] = len(a)
                named[d] = sorted({index.names[i] for i in items[part]})
            flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (s, e)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(np.diff(first), pa.int64()), lists(flat[0], counts, pa.int64()),
                 lists(flat[1], counts, pa.int64()), pa.array(named, pa.list_(pa.string()))], names)

    return run


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = list(zip(*(batch.column(n).to_pylist() for n in ("n_words", "starts", "ends", "items"))))
        out = []
        for n_words, starts, ends, items in columns:
            s, e = _merged(np.array(starts, np.int64), np.array(ends, np.int64))
            out.append(_row(n_words, s, e, sorted(set(items))) if len(s) else (0, 0, NOTHING, False))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_())
        more = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *(x.split()[0] for x in RESULT.split(", "))])


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[Index]:
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), F.col(text).cast("string").alias("text"))
    # The id's length counts as well, so that a block is bounded also for items without text.
    size = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.octet_length("item") + 16)).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i) if n > 1 else items
        table = part.toArrow()
        yield Index(table["item"].to_pylist(), *text_buffer(table["text"]))


def find_contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the hit spans in words."""
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text).cast("string")).alias("text_key"),
                       F.col(text).cast("string").alias("text"))
    context = docs.sparkSession.sparkContext
    scans = [_scan(context.broadcast(index)) for index in _blocks(benchmark, item_id, item_text, block_bytes)]
    if len(scans) == 1:
        # Scan and finish in one worker.
        done = read.mapInArrow(chained(scans[0], _finish), f"{HITS}, {RESULT}")
    else:
        passes = [read.mapInArrow(scan, HITS) for scan in scans]
        found = functools.reduce(DataFrame.unionByName, passes)
        # Equal rows have equal hits; as many come back as went in.
        found = found.groupBy("doc_id", "text_key").agg(
            F.max("n_words").alias("n_words"), F.flatten(F.collect_list("starts")).alias("starts"),
            F.flatten(F.collect_list("ends")).alias("ends"), F.flatten(F.collect_set("items")).alias("items"),
            (F.count(F.lit(1)) / len(passes)).cast("int").alias("copies"))
        found = found.select("doc_id", "text_key", "n_words", "starts", "ends", "items",
                             F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy")).drop("copy")
        done = found.mapInArrow(_finish, f"{HITS}, {RESULT}")
    return done.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "starts", "ends")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return find_contamination(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
found AS (SELECT DISTINCT doc_id, i, n, item_id FROM places JOIN windows USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
