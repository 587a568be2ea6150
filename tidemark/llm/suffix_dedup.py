r"""Removal of repeated byte strings with suffix arrays built block by block.

A byte goes if it lies in a LENGTH-byte string that also starts in a document with a smaller id. Strings are brought
together by content: every LENGTH-byte window belongs to its least GRAM-byte gram (by hash, the first on ties), and neighbouring windows
with the same gram form one *piece* of at most LENGTH + REACH - 1 bytes. Equal windows lie in pieces of equal grams.

1. *Which grams do several documents hold?* Each chunk of the scan sends every gram's hash once, in 4 bytes; the answer is
   a Bloom filter of bounded size. A second filter holds those among them that have very many different pieces.
2. *Collect.* The bytes of the pieces whose gram is in the filter are dealt to buckets by gram; pieces of the second filter as single
   windows, dealt by their own hash, so that no gram fills a task. Within a chunk rows of equal bytes are collapsed: only
   those of the smallest id go on, the others are covered. What was collapsed is remembered by the task, in a table of
   bounded size, for its later chunks, so a passage costs a few rows a task, however many documents share it.
3. *Sort.* In every bucket the bytes are taken part by part (parts divide grams, never the pieces of one). Rows of equal bytes are
   collapsed once more; the rest of a part gets a suffix array, built
   block by block: suffixes are sorted one bucket of leading bytes at a time, ties beyond them by the ranks of a
   difference-cover sample. Runs of suffixes that agree in LENGTH bytes give the smallest id of every string.
4. *Cut.* Covered spans are united by document and cut out. Only documents that may have any are shuffled with their text.

Hashes only choose what meets; whether strings are equal is decided by their bytes.

Null and empty texts have nothing to remove; a document with a null id neither loses bytes nor counts as smaller;
rows with equal ids do not affect each other; repeated rows are cut alike; an empty table gives an empty result; other columns
are ignored. A text is never split over chunks: a task holds about 60 times the longest text. Beyond ``filter_bits`` the filter lets
more pieces pass, in the end all; the result is the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.arrow import bitmap, chained, chunks, kept, lists, quoted, rows_in_bitmap, settle, settled, text_buffer, text_chunks
from tidemark.llm.hit_filter import SENT, bucket_of, by_bucket, codes, filters, sent, slice_bits
from tidemark.llm.spans import DOC_SPANS, from_planes, ids_conflict, pack_spans, planes, runs, unite
from tidemark.llm.suffix_sort import sorted_blocks, words_at
from tidemark.llm.words import ODD, mix, sliding_min

LENGTH, GRAM = 50, 20
CHUNK = 1 << 20
REACH = LENGTH - GRAM + 1
LONGEST = LENGTH + REACH - 1
BUCKET_BYTES = 6 << 20
PART_BYTES = 3 << 20
FILTER_BITS = 1 << 28
HOT_PIECES = 2_000
REMEMBERED = 1 << 15
# A chunk with more different pieces of one gram counts as many of them.
MANY, MANY_COUNT = 64, 1_000


def contents(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of the strings at the given places; ``words`` are the text's eight bytes from every place on."""
    content = mix(size.astype(np.uint64) + ODD)
    longest = int(size.max()) if len(size) else 0
    for step in range(0, longest, 8):
        # The last eight bytes of a string stand in for those that would lie beyond it.
        content = mix(content * ODD + words[start + np.minimum(step, size - 8)])
    return content


def equal_bytes(words: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the strings of the given sizes at the places a and b agree."""
    same = np.ones(len(a), bool)
    for step in range(0, int(size.max()) if len(size) else 0, 8):
        at = np.minimum(step, size - 8)
        same &= words[a + at] == words[b + at]
    return same


def pieces(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Text, start, length, gram hash and content hash of all pieces; starts count from the beginning of all texts."""
    reach = length - gram + 1
    n = len(data) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    words = words_at(data)
    grams = mix(words[: len(data) - gram + 1] * ODD + words[8 : len(data) - gram + 9])
    grams = mix(grams + words[gram - 8 : len(data) - 7] * ODD)
    # Order of grams: 32 bits of hash, then the place.
    keyed = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    least = (sliding_min(keyed, reach) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    change = np.zeros(len(data) + 1, np.int8)
    filled = np.flatnonzero(np.diff(offsets))
    np.add.at(change, np.maximum(offsets[filled], offsets[filled + 1] - length + 1), 1)
    np.add.at(change, offsets[filled + 1], -1)
    whole = np.cumsum(change[:n], dtype=np.int8) == 0
    new = whole.copy()
    # A text's first window begins a piece, also where the text before leaves no gap.
    begins = np.zeros(n, bool)
    begins[offsets[filled][offsets[filled] < n]] = True
    new[1:] &= (least[1:] != least[:-1]) | ~whole[:-1] | begins[1:]
    start = np.flatnonzero(new)
    if not len(start):
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    counts = np.add.reduceat(whole.astype(np.int64), start)
    size = counts + length - 1
    content = contents(words, start, size)
    text = np.searchsorted(offsets, start, side="right") - 1
    return text, start - offsets[text], size, grams[least[start]], content


def _probe(buckets: int, chunk: int):
    """The grams of a chunk, once each, with two flags: very many different pieces (1), two ids (2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(batches, "text", chunk):
            text, _, _, h, content = pieces(data, offsets)
            if not len(text):
                continue
            code = codes(h, buckets)
            order = np.lexsort((content, code))
            code, content = code[order], content[order]
            new = runs(code)
            doc = rows.column("doc_id").to_numpy()[text[order]]
            several = np.minimum.reduceat(doc, new) != np.maximum.reduceat(doc, new)
            first = np.concatenate([[True], (content[1:] != content[:-1]) | (code[1:] != code[:-1])])
            many = np.add.reduceat(first.astype(np.int64), new) > MANY
            yield sent(code[new] | many.astype(np.uint64) | (several.astype(np.uint64) << np.uint64(1)))

    return run


def _shared_grams(hot_pieces: int):
    def choose(flags: np.ndarray, new: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Grams of several documents, and those among them that may have more than about ``hot_pieces`` pieces."""
        shared = (counts > 1) | (np.maximum.reduceat(flags, new) >= 2)
        many = np.add.reduceat((flags & 1).astype(np.int64), new)
        return shared, shared & (counts + MANY_COUNT * many > hot_pieces)

    return choose


class Remembered:
    """Strings that several documents of a task share, with the least id of each; starts anew when it is full."""

    def __init__(self, limit: int = REMEMBERED):
        self.limit = limit
        self.content, self.doc = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.size, self.body = np.zeros(0, np.int64), np.zeros((0, LONGEST), np.uint8)

    @staticmethod
    def bodies(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        place = np.arange(LONGEST)
        body = data[np.minimum(start[:, None] + place, len(data) - 1)]
        body[place >= size[:, None]] = 0
        return body

    def least(self, content, doc, data, start, size) -> np.ndarray:
        """For every string the smaller of ``doc`` and the id remembered for the same bytes."""
        if not len(self.content) or not len(content):
            return doc
        at = np.minimum(np.searchsorted(self.content, content), len(self.content) - 1)
        met = np.flatnonzero((self.content[at] == content) & (self.size[at] == size) & (self.doc[at] < doc))
        met = met[(self.bodies(data, start[met], size[met]) == self.body[at[met]]).all(axis=1)]
        out = doc.copy()
        out[met] = self.doc[at[met]]
        return out

    def add(self, content, doc, data, start, size) -> None:
        """Strings with different hashes; those known under a larger id are replaced."""
        if len(self.content) + len(content) > self.limit:
            self.__init__(self.limit)
        n = self.limit
        content, doc = np.concatenate([self.content, content[:n]]), np.concatenate([self.doc, doc[:n]])
        body = np.concatenate([self.body, self.bodies(data, start[:n], size[:n])])
        size = np.concatenate([self.size, size[:n]])
        order = np.lexsort((doc, content))
        own = order[runs(content[order])]
        self.content, self.doc, self.size, self.body = content[own], doc[own], size[own], body[own]


STRINGS = "bucket long, docs int, rows int, packed binary, body binary, spans binary"
KINDS = [np.int64, np.int64, np.int32, np.int32, np.uint8, np.uint32]


def _string_rows(bucket, docs, rows, packed, body, spans) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip((bucket, docs, rows, packed, body, spans), kinds)],
                                      [x.split()[0] for x in STRINGS.split(", ")])


def _strings(data: np.ndarray, offsets: np.ndarray, shared, hot):
    """Text, start in the chunk, size, group and content of the strings to compare: shared pieces, and windows of hot ones."""
    text, start, size, h, _ = pieces(data, offsets)
    chosen = np.flatnonzero(shared.value.holds(h))
    text, start, size, h = text[chosen], start[chosen] + offsets[text[chosen]], size[chosen], h[chosen]
    warm = hot.value.holds(h)
    counts = (size - LENGTH + 1)[warm]
    shift = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    text = np.concatenate([text[~warm], np.repeat(text[warm], counts)])
    start = np.concatenate([start[~warm], np.repeat(start[warm], counts) + shift])
    size = np.concatenate([size[~warm], np.full(len(shift), LENGTH)])
    words = words_at(data)
    content = contents(words, start, size)
    return text, start, size, np.concatenate([h[~warm], content[int((~warm).sum()) :]]), content, words


def _collect(buckets: int, chunk: int, shared, hot):
    """The strings of a chunk: the first ones packed by bucket, and the spans of those that repeat them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered()
        for rows, data, offsets in text_chunks(batches, "text", chunk):
            text, start, size, group, content, words = _strings(data, offsets, shared, hot)
            if not len(text):
                continue
            doc, key = rows.column("doc_id").to_numpy()[text], rows.column("text_key").to_numpy()[text]
            order = np.lexsort((doc, content))
            new = runs(content[order])
            counts = np.diff(np.append(new, len(order)))
            one = order[new]
            low = known.least(content[one], doc[one], data, start[one], size[one])
            like = np.repeat(one, counts)
            same = (size[order] == size[like]) & equal_bytes(words, start[order], start[like], np.minimum(size[order], size[like]))
            repeats = same & (doc[order] > np.repeat(low, counts))
            several = np.maximum.reduceat(repeats, new)
            known.add(content[one][several], low[several], data, start[one][several], size[one][several])
            covered, first = order[repeats], order[~repeats]
            start_in = start - offsets[text]
            if len(covered):
                owners, spans = pack_spans(doc[covered], key[covered], start_in[covered], start_in[covered] + size[covered], buckets)
                none = [None] * len(owners)
                yield _string_rows(owners, none, none, none, none, spans)
            bucket = bucket_of(mix(group[first]), buckets)
            by = np.lexsort((start[first], bucket))
            first, out = first[by], ([], [], [], [], [])
            # All bytes to send, one string after the other.
            ends = np.cumsum(size[first])
            body = data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[first] - ends + size[first], size[first])].tobytes()
            ends = np.concatenate([[0], ends])
            for b, lo, hi in by_bucket(bucket[by]):
                own = first[lo:hi]
                begins = runs(text[own])
                packed = planes(doc[own][begins], key[own][begins], np.diff(np.append(begins, hi - lo)).astype(np.int32),
                                start_in[own].astype(np.int32), size[own].astype(np.uint8), group[own].astype(np.uint32))
                for values, value in zip(out, (b, len(begins), hi - lo, packed, body[ends[lo] : ends[hi]])):
                    values.append(value)
            yield _string_rows(*out, [None] * len(out[0]))

    return run


def repeated_windows(text: np.ndarray, places: np.ndarray, docs: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """The places whose first ``length`` bytes also begin at a place of a smaller doc; docs go by place."""
    out = []
    owner = np.zeros(len(text), np.int64)
    owner[places] = docs
    for own, equal in sorted_blocks(text, places, length):
        if len(own):
            new = np.flatnonzero(~equal)
            least = np.repeat(np.minimum.reduceat(owner[own], new), np.diff(np.append(new, len(own))))
            out.append(own[owner[own] > least])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _joined(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings of the given places and sizes, one after the other, and where each begins."""
    size = size.astype(np.int64)
    begin = np.cumsum(size) - size
    return data[np.arange(size.sum()) + np.repeat(at - begin, size)], begin


def _collapse(text: np.ndarray, begin: np.ndarray, size: np.ndarray, doc: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The strings that are byte for byte one of a smaller id, and those that still have to be compared in part.

    Of strings of equal bytes only the smallest id's can be the first place of what they hold; and a group whose remaining
    strings are all of one id has nothing more to find.
    """
    words = words_at(text)
    content = contents(words, begin, size)
    order = np.lexsort((doc, content))
    new = runs(content[order])
    like = np.repeat(order[new], np.diff(np.append(new, len(order))))
    same = (size[order] == size[like]) & equal_bytes(words, begin[order], begin[like], np.minimum(size[order], size[like]))
    repeats = same & (doc[order] > doc[like])
    left = order[~repeats]
    left = left[np.argsort(group[left], kind="stable")]
    new = runs(group[left])
    if len(left):
        several = np.minimum.reduceat(doc[left], new) != np.maximum.reduceat(doc[left], new)
        left = left[np.repeat(several, np.diff(np.append(new, len(left))))]
    return order[repeats], np.sort(left)


def _search(owners: int, part_bytes: int):
    """Of one bucket of strings: the spans that repeat a string of a smaller id, by suffix arrays; spans found before pass through."""
    def run(table: pa.Table) -> pa.Table:
        passed = table.filter(pa.compute.is_valid(table["spans"]))
        table = table.filter(pa.compute.is_valid(table["packed"]))
        out: list[tuple[np.ndarray, ...]] = []
        if len(table):
            columns = []
            for raw, docs, n in zip(table["packed"].to_pylist(), table["docs"].to_pylist(), table["rows"].to_pylist()):
                doc, key, counts, start, size, group = from_planes(raw, KINDS, [docs] * 3 + [n] * 3)
                columns.append((np.repeat(doc, counts), np.repeat(key, counts), start, size, group))
            doc, key, start, size, group = (np.concatenate(x) for x in zip(*columns))
            del columns
            data, _ = text_buffer(table["body"])
            at = np.cumsum(size, dtype=np.int64) - size
            parts = max(1, -(-len(data) // part_bytes))
            part = (mix(group.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            for _, lo, hi in by_bucket(part[order]):
                own = order[lo:hi]
                text, begin = _joined(data, at[own], size[own])
                repeats, left = _collapse(text, begin, size[own].astype(np.int64), doc[own], group[own])
                whole = own[repeats]
                out.append((doc[whole], key[whole], start[whole], start[whole] + size[whole]))
                own = own[left]
                text, begin = _joined(data, at[own], size[own])
                counts = size[own].astype(np.int64) - LENGTH + 1
                row = np.repeat(np.arange(len(own)), counts)
                places = np.arange(len(row)) + np.repeat(begin - np.cumsum(counts) + counts, counts)
                found = repeated_windows(text, places, doc[own][row])
                row = np.searchsorted(begin, found, side="right") - 1
                own = own[row]
                first = start[own] + found - begin[row]
                out.append((doc[own], key[own], first, first + LENGTH))
        owner, spans = pack_spans(*(np.concatenate(x) for x in zip(*out)), owners) if out else ([], [])
        return pa.table([pa.chunked_array([pa.array(owner, pa.int64()), *passed["bucket"].chunks]),
                         pa.chunked_array([pa.array(spans, pa.binary()), *passed["spans"].chunks])], ["owner", "spans"])

    return run


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, starts array<long>, stops array<long>, kept_text binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marked, carry = "starts" in batch.schema.names, [x for x in ("carry",) if x in batch.schema.names]
        data, offsets = text_buffer(batch.column("text"))
        for low, high in chunks(offsets):
            rows, raw = batch.slice(low, high - low), data[offsets[low] : offsets[high]].tobytes()
            at = (offsets[low : high + 1] - offsets[low]).tolist()
            out, starts, stops, counts = [], [], [], np.zeros(len(rows), np.int64)
            for i in range(len(rows)):
                body, removed = raw[at[i] : at[i + 1]], 0
                if marked and rows.column("starts")[i].is_valid:
                    s, e = (rows.column(x)[i].values.to_numpy() for x in ("starts", "stops"))
                    starts.append(s)
                    stops.append(e)
                    counts[i], removed = len(s), int((e - s).sum())
                    edges = [0, *np.stack([s, e], axis=1).reshape(-1).tolist(), len(body)]
                    body = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((at[i + 1] - at[i], removed, hashlib.sha256(body).hexdigest(), body))
            flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (starts, stops)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array(counts),
                 pa.array([r[2] for r in out], pa.string()), lists(flat[0], counts, pa.int64()), lists(flat[1], counts, pa.int64()),
                 pa.array([r[3] for r in out], pa.binary()), *(rows.column(x) for x in carry)],
                [*(x.split()[0] for x in RESULT.split(", ")), *carry])
    settle()


def whole_characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The kept bytes as text, in place of bytes and spans; bytes that form no whole character any more are left out."""
    for batch in batches:
        stay = [n for n in batch.schema.names if n not in ("starts", "stops", "kept_text")]
        texts = [x.as_py().decode("utf-8", "ignore") for x in batch.column("kept_text")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in stay), pa.array(texts, pa.string())], [*stay, "whole_text"])


def covered_spans(texts: DataFrame, bucket_bytes: int = BUCKET_BYTES, part_bytes: int = PART_BYTES, filter_bits: int = FILTER_BITS,
                  hot_pieces: int = HOT_PIECES, chunk: int = CHUNK) -> tuple[DataFrame, bool]:
    """doc_id, text_key and the sorted spans to remove of every document that has any, and whether text_key counts.

    ``texts`` has doc_id, text_key, text.
    """
    context = texts.sparkSession.sparkContext
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    keyed = ids_conflict(texts)
    if not keyed:
        texts = texts.withColumn("text_key", F.lit(0).cast("long"))
    texts = texts.where("doc_id IS NOT NULL")
    # A bucket gets the shared pieces of about bucket_bytes of text.
    buckets = max(2, -(-size // bucket_bytes))
    probes = texts.mapInArrow(_probe(buckets, chunk), SENT)
    bits = slice_bits(size // 4, filter_bits, buckets)
    shared, hot = (context.broadcast(x) for x in filters(probes, buckets, bits, _shared_grams(hot_pieces), ("shared", "hot")))
    strings = texts.mapInArrow(_collect(buckets, chunk, shared, hot), STRINGS)
    spans = strings.groupBy("bucket").applyInArrow(settled(_search(buckets, part_bytes)), "owner long, spans binary")
    return kept(spans.groupBy("owner").applyInArrow(settled(unite), DOC_SPANS), "byte-spans"), keyed


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None,
                   as_text: bool = False, **limits) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, the removed spans and the kept bytes of every row.

    Columns listed in ``carry`` come along in a struct of that name. ``as_text``: the kept bytes as text (``whole_text``)
    in place of spans and bytes.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("text_key"), body.alias("text"))
    spans, keyed = covered_spans(texts, **limits)
    body_key = F.xxhash64(body) if keyed else F.lit(0).cast("long")
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body_key.alias("text_key"), body.alias("text"),
                        *([F.struct(*map(quoted, carry)).alias("carry")] if carry else []))
    carried = [texts.schema["carry"]] if carry else []
    result = StructType([*StructType.fromDDL(RESULT).fields, *carried])
    if as_text:
        result = StructType([f for f in result.fields if f.name not in ("starts", "stops", "kept_text")]).add("whole_text", "string")
    last = (_cut, whole_characters) if as_text else (_cut,)
    shared = spark.sparkContext.broadcast(bitmap(spans.select("doc_id").distinct(), "doc_id"))
    whole = texts.mapInArrow(chained(rows_in_bitmap(shared, "doc_id", False), *last), result)
    cut = texts.mapInArrow(rows_in_bitmap(shared, "doc_id", True), texts.schema).join(spans, ["doc_id", "text_key"], "left")
    return whole.unionByName(cut.mapInArrow(chained(*last), result))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{folder}/documents.parquet")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
