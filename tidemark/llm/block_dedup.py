r"""Removal of repeated runs of words by fixed-block anchors.

A word goes if it lies in a run of LENGTH words that also starts in a document with a smaller id. Documents are compared
through anchors:

1. *Index and probe.* Every document is cut into blocks of BLOCK words that don't overlap; these are the index. Every rolling
   window of BLOCK words of every document probes it. As LENGTH = 2 * BLOCK - 1, any run of LENGTH words holds exactly one whole block of
   its own document, and a copy of that run in another document probes that block. So a block that no other document's
   window hits can't be part of a repeat. Hashes of blocks and windows meet by bucket, 4 bytes each (enough for a
   bucket: a wrong hit only costs work), and the blocks that were hit go into a Bloom filter of bounded size.
2. *Extend.* Around each block that was hit, the up to BLOCK runs of LENGTH words that contain it are formed and brought
   together by 64 bits of hash, in buckets chosen by a second, independent hash. Where the same run starts in a document
   with a smaller id, it is covered. Covered runs are united by document; these unions are the maximal repeats.
3. *Cut.* Only documents with a covered run are shuffled with their text.

Hot passages. Inside a chunk of the scan each run is sent for its smallest id only; the others are covered already. Runs
that were collapsed so are remembered by the task, in a table of bounded size, for its later chunks. Windows are sent once a chunk.
So a passage costs a few numbers a task, however many documents share it.

Size. The number of buckets grows with the text, chunks with the buckets. The filter has 2 bits a word up to ``filter_bits``;
beyond that more blocks pass it than were hit, in the end all, and step 2 then sends every run, about 20 bytes a word; the result is the same.

Null and empty texts have no words; a document with a null id neither loses words nor counts as smaller; rows with
equal ids do not affect each other; repeated rows are cut alike; an empty table gives an empty result; other columns are
ignored. A text is never split over chunks: a task holds about 25 times the longest text. Words are told apart by their
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrow import bitmap, chained, chunks, kept, lists, rows_in_bitmap, settle, settled, text_buffer, text_chunks
from tidemark.llm.hit_filter import SENT, bucket_of, by_bucket, codes, filters, sent, slice_bits
from tidemark.llm.spans import DOC_SPANS, from_planes, ids_conflict, pack_spans, planes, runs, unite
from tidemark.llm.words import SPACED, grams, within_text, word_hashes

LENGTH = 13
BUCKET_BYTES = 6 << 20
FILTER_BITS = 1 << 28
REMEMBERED = 1 << 17
OTHER = np.uint64(0xD6E8FEB86659FD93)


def _scan(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray):
    """Word hashes, first words, and the row and the place in its text of every word."""
    words, first = word_hashes(data, offsets, SPACED, fold=False)
    row = np.repeat(np.arange(len(rows)), np.diff(first))
    return words, first, row, np.arange(len(words)) - first[row]


def _probe(length: int, block: int, buckets: int, chunk: int):
    """All rolling windows of a chunk, once each: 30 bits of hash, whether one is a block (1) and whether two ids hold it (2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(batches, "text", chunk):
            words, first, row, place = _scan(rows, data, offsets)
            h = grams(words, block)
            # Texts with fewer than LENGTH words have no run.
            stay = within_text(first, block, len(h)) & (np.diff(first) >= length)[row[: len(h)]]
            at = np.flatnonzero(stay)
            if not len(at):
                continue
            code = codes(h[at], buckets)
            order = np.argsort(code)
            code, at = code[order], at[order]
            new = runs(code)
            doc = rows.column("doc_id").to_numpy()[row[at]]
            whole = np.maximum.reduceat((place[at] % block == 0).astype(np.uint64), new)
            several = np.minimum.reduceat(doc, new) != np.maximum.reduceat(doc, new)
            yield sent(code[new] | whole | (several.astype(np.uint64) << np.uint64(1)))

    return run


def _hit_blocks(flags: np.ndarray, new: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray]:
    """Hashes that are a block of one document and a window of another."""
    flags = np.bitwise_or.reduceat(flags, new)
    return (((counts > 1) | (flags >= 2)) & (flags & 1 == 1),)


class Remembered:
    """The least id seen for runs that several documents of a task share; starts anew when it is full."""

    def __init__(self, limit: int = REMEMBERED):
        self.limit, self.h, self.doc = limit, np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def least(self, h: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """For every run the smaller of ``doc`` and what is remembered."""
        if not len(self.h):
            return doc
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        return np.where(self.h[at] == h, np.minimum(self.doc[at], doc), doc)

    def add(self, h: np.ndarray, doc: np.ndarray) -> None:
        if len(self.h) + len(h) > self.limit:
            self.h, self.doc = self.h[:0], self.doc[:0]
        h, doc = np.concatenate([self.h, h[: self.limit]]), np.concatenate([self.doc, doc[: self.limit]])
        order = np.lexsort((doc, h))
        new = runs(h[order])
        self.h, self.doc = h[order][new], doc[order][new]


RUNS = "bucket long, docs int, rows int, packed binary, spans binary"
RUN_KINDS = [np.int64, np.int64, np.int32, np.int32, np.uint64]


def _extend(length: int, block: int, buckets: int, chunk: int, shared):
    """The runs around the blocks in the filter: the first ones packed by bucket, and the spans of those that repeat them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered()
        for rows, data, offsets in text_chunks(batches, "text", chunk):
            words, first, row, place = _scan(rows, data, offsets)
            at = np.flatnonzero((place % block == 0) & (place + block <= np.diff(first)[row]))
            at = at[shared.value.holds(grams(words, block)[at])]
            # The runs that contain a block start at it or at one of the words before it.
            start = (at[:, None] + np.arange(length - block + 1)[None, :] - (length - block)).reshape(-1)
            own = np.repeat(row[at], length - block + 1)
            fits = (start >= first[own]) & (start + length <= first[own + 1])
            start, own = start[fits], own[fits]
            if not len(start):
                continue
            h = grams(words, length)[start]
            doc = rows.column("doc_id").to_numpy()[own]
            key = rows.column("text_key").to_numpy()[own]
            start_in = start - first[own]
            order = np.lexsort((doc, h))
            new = runs(h[order])
            low = doc[order][new]
            least = known.least(h[order][new], low)
            counts = np.diff(np.append(new, len(order)))
            repeats = doc[order] > np.repeat(least, counts)
            high = doc[order][np.append(new[1:], len(order)) - 1]
            several = high != least
            known.add(h[order][new][several], least[several])
            covered, first_ones = order[repeats], order[~repeats]
            if len(covered):
                owners, spans = pack_spans(doc[covered], key[covered], start_in[covered], start_in[covered] + length, buckets)
                yield _rows(owners, [None] * len(owners), [None] * len(owners), [None] * len(owners), spans)
            bucket = bucket_of(grams(words, length, OTHER)[start[first_ones]], buckets)
            order = np.lexsort((start[first_ones], bucket))
            first_ones, out = first_ones[order], ([], [], [], [])
            for b, lo, hi in by_bucket(bucket[order]):
                part = first_ones[lo:hi]
                begins = runs(own[part])
                for values, value in zip(out, (b, len(begins), hi - lo, planes(
                        doc[part][begins], key[part][begins], np.diff(np.append(begins, hi - lo)).astype(np.int32), start_in[part].astype(np.int32), h[part]))):
                    values.append(value)
            yield _rows(*out, [None] * len(out[0]))

    return run


def _rows(bucket, docs, rows, packed, spans) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int64()), pa.array(docs, pa.int32()), pa.array(rows, pa.int32()), pa.array(packed, pa.binary()), pa.array(spans, pa.binary())],
        [x.split()[0] for x in RUNS.split(", ")])


def _covered(length: int, owners: int):
    """Of one bucket of runs: the spans of those that start in a smaller id too; spans found before pass through."""
    def run(table: pa.Table) -> pa.Table:
        passed = table.filter(pa.compute.is_valid(table["spans"]))
        table = table.filter(pa.compute.is_valid(table["packed"]))
        own, packed = [], []
        if len(table):
            parts = []
            for raw, docs, n in zip(table["packed"].to_pylist(), table["docs"].to_pylist(), table["rows"].to_pylist()):
                doc, key, counts, start, h = from_planes(raw, RUN_KINDS, [docs, docs, docs, n, n])
                parts.append((np.repeat(doc, counts), np.repeat(key, counts), start, h))
            doc, key, start, h = (np.concatenate(x) for x in zip(*parts))
            del parts
            order = np.lexsort((doc, h))
            new = runs(h[order])
            least = np.repeat(doc[order][new], np.diff(np.append(new, len(order))))
            found = order[doc[order] > least]
            own, packed = pack_spans(doc[found], key[found], start[found], start[found].astype(np.int64) + length, owners)
        return pa.table([pa.chunked_array([pa.array(own, pa.int64()), *passed["bucket"].chunks]),
                         pa.chunked_array([pa.array(packed, pa.binary()), *passed["spans"].chunks])], ["owner", "spans"])

    return run


def repeated_spans(texts: DataFrame, length: int = LENGTH, bucket_bytes: int = BUCKET_BYTES, filter_bits: int = FILTER_BITS) -> tuple[DataFrame, bool]:
    """doc_id, text_key and the sorted spans of words to remove of every document that has any, and whether text_key counts.

    ``texts`` has doc_id, text_key, text; ``length`` is odd.
    """
    if length < 3 or length % 2 == 0:
        raise ValueError("runs need an odd number of words, of three at least")
    spark, block = texts.sparkSession, (length + 1) // 2
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    keyed = ids_conflict(texts)
    if not keyed:
        texts = texts.withColumn("text_key", F.lit(0).cast("long"))
    texts = texts.where("doc_id IS NOT NULL")
    buckets = max(2, -(-size // bucket_bytes))
    chunk = max(2 << 20, min(32 << 20, buckets * 512))
    bits = slice_bits(size // 3, filter_bits, buckets)
    probes = texts.mapInArrow(_probe(length, block, buckets, chunk), SENT)
    shared = spark.sparkContext.broadcast(filters(probes, buckets, bits, _hit_blocks, ("hit",))[0])
    extended = texts.mapInArrow(_extend(length, block, buckets, chunk, shared), RUNS)
    spans = extended.groupBy("bucket").applyInArrow(settled(_covered(length, buckets)), "owner long, spans binary")
    return kept(spans.groupBy("owner").applyInArrow(settled(unite), DOC_SPANS), "word-spans"), keyed


RESULT = "doc_id long, n_words long, n_removed long, starts array<long>, stops array<long>, kept_text string"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        for low, high in chunks(offsets):
            raw, size = data[offsets[low] : offsets[high]].tobytes(), []
            at = (offsets[low : high + 1] - offsets[low]).tolist()
            starts, stops, counts, out = [], [], np.zeros(high - low, np.int64), []
            for i in range(high - low):
                # Without an argument, split parts bytes at exactly the blanks that part words here.
                words, gone = raw[at[i] : at[i + 1]].split(), 0
                size.append(len(words))
                if "starts" in batch.schema.names and batch.column("starts")[low + i].is_valid:
                    s, e = (batch.column(x)[low + i].values.to_numpy() for x in ("starts", "stops"))
                    starts.append(s)
                    stops.append(e)
                    counts[i], gone = len(s), int((e - s).sum())
                    edges = [0, *np.stack([s, e], axis=1).reshape(-1).tolist(), len(words)]
                    words = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
                out.append((gone, b" ".join(words)))
            flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, stops)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(low, high - low), pa.array(size, pa.int64()), pa.array([x[0] for x in out], pa.int64()),
                 lists(flat[0], counts, pa.int64()), lists(flat[1], counts, pa.int64()), pa.array([x[1] for x in out], pa.binary()).cast(pa.string())],
                [x.split()[0] for x in RESULT.split(", ")])
    settle()


def remove_repeated_runs(docs: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """doc_id, n_words, n_removed, the removed spans of words and the kept words, joined by blanks, of every row."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("text_key"), body.alias("text"))
    spans, keyed = repeated_spans(texts, length, **limits)
    if not keyed:
        texts = texts.withColumn("text_key", F.lit(0).cast("long"))
    shared = spark.sparkContext.broadcast(bitmap(spans.select("doc_id").distinct(), "doc_id"))
    whole = texts.mapInArrow(chained(rows_in_bitmap(shared, "doc_id", False), _cut), RESULT)
    cut = texts.mapInArrow(rows_in_bitmap(shared, "doc_id", True), texts.schema).join(spans, ["doc_id", "text_key"], "left")
    return whole.unionByName(cut.mapInArrow(_cut, RESULT))


def query(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeated_runs(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
runs AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) > 12)),
firsts AS (SELECT g, min(doc_id) AS first_id FROM runs GROUP BY 1),
hits AS (
  SELECT doc_id, list_distinct(flatten(list(range(i, i + 13)))) AS gone FROM runs JOIN firsts USING (g) WHERE first_id < doc_id GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: gone IS NULL OR NOT list_contains(gone, i)), lambda i: w[i]), ' '))
    AS kept_sha256
FROM d LEFT JOIN hits USING (doc_id)
"""
