r"""Language-model scores by a hierarchical Pitman-Yor model of word pairs.

Every word is a context with a restaurant of its own for the words that follow it; all these restaurants share one parent, whose
base is uniform over the V known words and one unknown word. Seating (the number of tables of each word in each
restaurant) is sampled by Gibbs sweeps; the tables of all contexts are the customers of the parent. Scores are sums of
log10 of predictive probabilities averaged over SAMPLES samples.

How it is distributed:

1. Documents are cut into chunks of CHUNK bytes along the scan. A chunk sends its distinct words, and its distinct
   word pairs, with their counts in training documents, packed by bucket of a hash. Counts are thus summed before any shuffle.
2. A bucket of contexts sums the counts of its restaurants and runs the sweeps, with its own running copy of the parent
   (approximate distributed Gibbs sampling). It answers every chunk with customers and tables of the pairs it asked about, and sends
   table counts on to the buckets of words. A context that many pairs share is dealt over all buckets by the next word,
   and its totals are summed.
3. A bucket of words sums counts and parent customers, seats the parent, and answers the chunks likewise.
4. Chunks meet their answers and score their documents.

Everything gathered is proportional to the corpus; only totals and the hot contexts (at most HOT_WORDS) are broadcast.
What is sent is compressed by the task that packs it: else the JVM's readers, sorters and writers hold it several times as large.

Tokens are lower-cased words between white space and one end token for each document. Null and empty texts have the end
token alone. A null id counts as a training row. Repeated rows count and are scored each; an empty table gives an empty result; other
columns are ignored. Words count by 64-bit hashes; in the model, words are 32-bit hashes (words that collide there share their seats).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrow import bucket_of, chunks, kept, settle, settled, text_buffer
from tidemark.llm.words import SPACED, mix, word_hashes

CHUNK = 6 << 20
SMALL_CHUNK = 1 << 20
BUCKET_BYTES = 8 << 20
HOT_WORDS = 256
BURN_IN, SAMPLES = 3, 2
DISCOUNT, STRENGTH = 0.8, 1.0
PARENT_DISCOUNT, PARENT_STRENGTH = 0.7, 1.0
BEGIN, END = np.uint64(0x1F83D9ABFB41BD6B), np.uint64(0x5BE0CD19137E2179)
HALF, LOW32 = np.uint64(32), np.uint64(0xFFFFFFFF)


# ---- tokens and packing ----------------------------------------------------------------------------


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each followed by its end token, and where texts begin (one more at the end)."""
    words, first = word_hashes(data, offsets, SPACED)
    out = np.insert(words, first[1:], END)
    return out, first + np.arange(len(first))


def pair_ids(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of every token the 32-bit hashes of the word before it and of itself."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[first[:-1]] = BEGIN
    return (before & ~LOW32) | (words >> HALF)


def planes(x: np.ndarray) -> bytes:
    """Numbers below 2**32 byte by byte: high bytes are mostly zeros and compress."""
    return np.minimum(x, LOW32).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1).astype(np.int64)


def columns_of(raw: bytes, n: int) -> np.ndarray:
    """n columns of numbers that were packed one after the other."""
    size = len(raw) // n
    return np.stack([from_planes(raw[i * size : (i + 1) * size]) for i in range(n)])


def squeezed(raw: bytes) -> bytes:
    """Compressed, behind the length of the original."""
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unsqueezed(raw: bytes) -> bytes:
    return pa.decompress(memoryview(raw)[8:], int.from_bytes(raw[:8], "little"), "zstd", asbytes=True)


def pack_counts(x: np.ndarray) -> bytes:
    return squeezed(planes(x))


def unpack_counts(raw: bytes) -> np.ndarray:
    return from_planes(unsqueezed(raw))


def pack_sorted(ids: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as differences, in four columns of 16 bits, compressed."""
    step = np.diff(ids, prepend=np.uint64(0))
    return squeezed(step.astype("<u8").view(np.uint16).reshape(-1, 4).T.tobytes())


def unpack_sorted(raw: bytes) -> np.ndarray:
    steps = np.frombuffer(unsqueezed(raw), np.uint16).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(steps.T).view("<u8").reshape(-1), dtype=np.uint64)


def route(ids: np.ndarray, buckets: int, hot: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order of sorted ids by bucket, and (bucket, from, to) of every part. Hot contexts are dealt by the word."""
    by = (ids >> HALF) * np.uint64(buckets) >> HALF
    if len(hot):
        warm = np.isin(ids >> HALF, hot)
        by[warm] = (ids[warm] & LOW32) * np.uint64(buckets) >> HALF
    order = np.argsort(by, kind="stable")
    cuts = np.flatnonzero(np.diff(by[order], prepend=np.uint64(buckets))).tolist()
    return order, [(int(by[order[a]]), a, b) for a, b in zip(cuts, [*cuts[1:], len(ids)])]


def chunked(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """(number of a chunk, its rows). A row's chunk depends only on the bytes before it in its scan partition."""
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    seen, number, rows = 0, 0, []
    for batch in batches:
        offsets = text_buffer(batch.column("text"))[1]
        own = (seen + offsets[:-1]) // size
        seen += int(offsets[-1])
        cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if own[a] != number and rows:
                yield (part << 24) + number, rows
                rows = []
            number = int(own[a])
            rows.append(batch.slice(a, b - a))
    if rows:
        yield (part << 24) + number, rows
    settle()


def chunk_tokens(rows: list[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in rows:
        data, offsets = text_buffer(batch.column("text"))
        for a, b in chunks(offsets, SMALL_CHUNK):
            yield batch.slice(a, b - a), *tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


REQUEST = "chunk long, bucket int, ids binary, counts binary"


def _ask(size: int, buckets: int, pairs: bool, hot: np.ndarray):
    """Requests of every chunk: distinct words or pairs, with their counts in training rows."""
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows in chunked(batches, size):
            every, learned = [], []
            for part, words, first in chunk_tokens(rows):
                ids = pair_ids(words, first) if pairs else words
                train = np.repeat(part.column("train").to_numpy(zero_copy_only=False).astype(bool), np.diff(first))
                every.append(ids)
                learned.append(ids[train])
            ids, learned = np.unique(np.concatenate(every)), np.sort(np.concatenate(learned))
            counts = np.searchsorted(learned, ids, side="right") - np.searchsorted(learned, ids)
            order, parts = route(ids, buckets, hot)
            out = [(chunk, bucket, pack_sorted(ids[order[a:b]]), pack_counts(counts[order[a:b]].astype(np.uint64))) for bucket, a, b in parts]
            if not pairs:
                top = np.sort(np.argsort(-counts, kind="stable")[:HOT_WORDS])
                out.append((chunk, -1, pack_sorted(ids[top]), pack_counts(counts[top].astype(np.uint64))))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [x.split()[0] for x in REQUEST.split(", ")])

    return run


# ---- seating ---------------------------------------------------------------------------------------


def seat(customers: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after seating the customers of each dish one by one.

    ``weight`` is the weight of a new table: (strength + discount * tables of the restaurant) * parent probability.
    From the 33rd customer on, customers come in groups that double, as the odds then hardly change within a group.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    at = np.flatnonzero(customers > 1)
    seated = 1
    while len(at):
        come = 1 if seated < 32 else seated
        group = np.minimum(customers[at] - seated, come)
        sitting = seated + (group - 1) / 2
        odds = weight[at] / (weight[at] + np.maximum(sitting - discount * tables[at], 1e-9))
        tables[at] += rng.random(len(at)) < odds if come == 1 else rng.binomial(group, np.clip(odds, 0, 1))
        seated += come
        at = at[customers[at] > seated]
    return tables


def restaurants(ids: np.ndarray, customers: np.ndarray, seed: int) -> Iterator[np.ndarray]:
    """Samples of the tables of every (context, word), under a parent estimated from the bucket's own tables."""
    rng = np.random.default_rng(seed)
    context = np.unique(ids >> HALF, return_inverse=True)[1]
    word = np.unique(ids & LOW32, return_inverse=True)[1]
    tables = np.minimum(customers, 1)
    again = np.flatnonzero(customers > 1)
    for sweep in range(BURN_IN + SAMPLES):
        parent = np.bincount(word, tables)
        parent = (parent + 0.5) / (parent.sum() + 0.5 * len(parent))
        weight = (STRENGTH + DISCOUNT * np.bincount(context, tables)[context[again]]) * parent[word[again]]
        tables = tables.copy()
        tables[again] = seat(customers[again], weight, DISCOUNT, rng)
        if sweep >= BURN_IN:
            yield tables


ANSWER = "chunk long, bucket int, kind int, numbers binary, context_id long, customers long, tables array<long>"


def _answers(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    columns = list(zip(*rows)) if rows else [[] for _ in kinds]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in ANSWER.split(", ")])


PAIRS, WORDS, PARENT, HOT, TOTAL = range(5)


def _summed(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    asked = [unpack_sorted(x) for x in table["ids"].to_pylist()]
    ids = np.unique(np.concatenate(asked))
    total = np.zeros(len(ids), np.int64)
    for own, counts in zip(asked, table["counts"].to_pylist()):
        total[np.searchsorted(ids, own)] += unpack_counts(counts)
    return ids, total, asked


def _contexts(buckets: int, hot: np.ndarray):
    def run(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        ids, customers, asked = _summed(table)
        samples = list(restaurants(ids, customers, bucket))
        names, context = np.unique(ids >> HALF, return_inverse=True)
        totals = [np.bincount(context, x, len(names)).astype(np.int64) for x in (customers, *samples)]
        out = []
        for chunk, own in zip(table["chunk"].to_pylist(), asked):
            at = np.searchsorted(ids, own)
            its = np.searchsorted(names, np.unique(own >> HALF))
            numbers = b"".join([planes(x[at]) for x in (customers, *samples)] + [planes(x[its]) for x in totals])
            out.append((chunk, bucket, PAIRS, squeezed(np.int64(len(own)).tobytes() + numbers), None, None, None))
        words, word = np.unique(ids & LOW32, return_inverse=True)
        parent = [np.bincount(word, x, len(words)).astype(np.int64) for x in samples]
        some = parent[0] > 0
        words, parent = words[some], [x[some] for x in parent]
        to = words * np.uint64(buckets) >> HALF
        cuts = np.flatnonzero(np.diff(to, prepend=np.uint64(buckets))).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(words)]):
            out.append((-1, int(to[a]), PARENT, squeezed(b"".join(planes(x[a:b]) for x in (words, *parent))), None, None, None))
        for i in np.flatnonzero(np.isin(names, hot)):
            out.append((-1, bucket, HOT, None, int(names[i]), int(totals[0][i]), [int(x[i]) for x in totals[1:]]))
        return _answers(out)

    return run


def _parent(table: pa.Table) -> pa.Table:
    """Of one bucket of words: training counts, and customers and tables of the parent, for the chunks that asked."""
    bucket = table["bucket"][0].as_py()
    requests = table.filter(pa.compute.is_valid(table["ids"]))
    sent = [columns_of(unsqueezed(x), 1 + SAMPLES) for x in table.filter(pa.compute.is_null(table["ids"]))["numbers"].to_pylist()]
    sent = np.concatenate(sent, axis=1) if sent else np.zeros((1 + SAMPLES, 0), np.int64)
    seats, which = np.unique(sent[0], return_inverse=True)
    customers = [np.bincount(which, x, len(seats)).astype(np.int64) for x in sent[1:]]
    # Nearly every known word has tables here, so tables times base probability is about one.
    tables = [seat(x, np.full(len(x), PARENT_DISCOUNT), PARENT_DISCOUNT, np.random.default_rng((bucket, i))) for i, x in enumerate(customers)]
    out = []
    known = learned = 0
    if len(requests):
        ids, counts, asked = _summed(requests)
        known, learned = int((counts > 0).sum()), int(counts.sum())
        padded = [np.append(x, 0) for x in (*customers, *tables)]
        for chunk, own in zip(requests["chunk"].to_pylist(), asked):
            at = np.searchsorted(seats, (own >> HALF).astype(np.int64))
            if len(seats):
                hit = seats[np.minimum(at, len(seats) - 1)] == (own >> HALF).astype(np.int64)
                at = np.where(hit, at, len(seats))
            numbers = b"".join(planes(x) for x in (counts[np.searchsorted(ids, own)], *(x[at] for x in padded)))
            out.append((chunk, bucket, WORDS, squeezed(np.int64(len(own)).tobytes() + numbers), None, None, None))
    out.append((-1, bucket, TOTAL, None, known, learned, [int(x.sum()) for x in (*customers, *tables)]))
    return _answers(out)


# ---- scores ----------------------------------------------------------------------------------------


class Totals:
    """Known words V, training tokens N, parent's customers and tables by sample, and totals of hot contexts."""

    def __init__(self, known: int, learned: int, customers: list[int], tables: list[int], hot: dict[int, tuple]):
        self.known, self.learned, self.customers, self.tables = known, learned, customers, tables
        self.hot_names = np.array(sorted(hot), np.uint64)
        self.hot_totals = np.array([hot[x] for x in sorted(hot)], np.float64).reshape(-1, 1 + SAMPLES)


def parent_probability(word: np.ndarray, totals: Totals) -> np.ndarray:
    """By sample the parent's predictive probability. Rows of ``word``: count, customers by sample, tables by sample."""
    out = np.empty((SAMPLES, word.shape[1]))
    for s in range(SAMPLES):
        room = PARENT_STRENGTH + totals.customers[s]
        spare = (PARENT_STRENGTH + PARENT_DISCOUNT * totals.tables[s]) / room
        out[s] = np.maximum(word[1 + s] - PARENT_DISCOUNT * word[1 + SAMPLES + s], 0) / room + spare / (totals.known + 1)
    return out


def probability(pair: np.ndarray, context: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Predictive probabilities, averaged over the samples.

    Rows of ``pair`` and ``context``: customers, tables by sample. ``above``: the parent's probability by sample.
    """
    room = STRENGTH + context[0]
    out = np.zeros(pair.shape[1])
    for s in range(SAMPLES):
        out += (np.maximum(pair[0] - DISCOUNT * pair[1 + s], 0) + (STRENGTH + DISCOUNT * context[1 + s]) * above[s]) / room
    return out / SAMPLES


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(size: int, buckets: int, hot: np.ndarray, shared):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        totals: Totals = shared.value
        rows = docs.combine_chunks().to_batches()
        parts = list(chunk_tokens(rows))
        words = np.concatenate([w for _, w, _ in parts]) if parts else np.zeros(0, np.uint64)
        by = {(k, b): n for k, b, n in zip(*(answers[x].to_pylist() for x in ("kind", "bucket", "numbers")))}

        def told(ids: np.ndarray, kind: int, width: int, special: np.ndarray):
            """Per bucket the places of its ids among the sorted distinct ones, its columns on them, and what follows."""
            order, asked = route(ids, buckets, special)
            for bucket, a, b in asked:
                raw = unsqueezed(by[kind, bucket])
                if int(np.frombuffer(raw[:8], np.int64)[0]) != b - a:
                    raise RuntimeError("a chunk changed between two scans; were the input files rewritten?")
                cut = 8 + 4 * width * (b - a)
                yield order[a:b], columns_of(raw[8:cut], width), raw[cut:]

        distinct, where = np.unique(words, return_inverse=True)
        word = np.zeros((1 + 2 * SAMPLES, len(distinct)))
        for place, columns, _ in told(distinct, WORDS, len(word), np.zeros(0, np.uint64)):
            word[:, place] = columns
        base = np.log10((word[0] + 1) / (totals.learned + totals.known + 1))[where]
        known = (word[0] > 0)[where]
        above, names = parent_probability(word, totals), distinct >> HALF
        del words, word

        distinct, where = np.unique(np.concatenate([pair_ids(w, f) for _, w, f in parts]) if parts else names, return_inverse=True)
        logs = np.zeros(len(distinct))
        for place, pair, rest in told(distinct, PAIRS, 1 + SAMPLES, hot):
            ids = distinct[place]
            before = ids >> HALF
            context = columns_of(rest, 1 + SAMPLES)[:, np.unique(before, return_inverse=True)[1]].astype(np.float64)
            if len(totals.hot_names):
                at = np.minimum(np.searchsorted(totals.hot_names, before), len(totals.hot_names) - 1)
                warm = totals.hot_names[at] == before
                context[:, warm] = totals.hot_totals[at[warm]].T
            logs[place] = np.log10(probability(pair, context, above[:, np.searchsorted(names, ids & LOW32)]))
        logs = logs[where]
        out, low = [], 0
        for part, own, first in parts:
            here = slice(low, low + len(own))
            low += len(own)
            begins, n = first[:-1], len(part)
            out.append(pa.table({
                "doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "n_tokens": np.diff(first),
                "n_known": np.add.reduceat(known[here], begins, dtype=np.int64), "train_tokens": np.full(n, totals.learned),
                "base_score": np.add.reduceat(base[here], begins), "score": np.add.reduceat(logs[here], begins)}))
        settle()
        if not out:
            kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            return pa.table([pa.array([], k) for k in kinds], [x.split()[0] for x in RESULT.split(", ")])
        return pa.concat_tables(out)

    return run


def _tag(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows in chunked(batches, size):
            for batch in rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(batch), chunk)), batch.column("doc_id"), batch.column("held_out"), batch.column("text")],
                                                 ["chunk", "doc_id", "held_out", "text"])

    return run


def score_documents(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text", chunk: int = CHUNK, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Scores of all rows by a model learned from the rows for which ``held_out`` does not hold."""
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out.alias("held_out"), (~held_out).alias("train"), F.col(text).cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(2, min(1 << 15, -(-size // bucket_bytes)))
    none = np.zeros(0, np.uint64)

    asked = kept(texts.mapInArrow(_ask(chunk, buckets, False, none), REQUEST), "words")
    hot = _hot_words(asked, buckets)
    asked_pairs = texts.mapInArrow(_ask(chunk, buckets, True, hot), REQUEST)
    seated = kept(asked_pairs.groupBy("bucket").applyInArrow(settled(_contexts(buckets, hot)), ANSWER), "contexts")
    to_words = asked.where("bucket >= 0").withColumn("numbers", F.lit(None).cast("binary")).unionByName(
        seated.where(F.col("kind") == PARENT).select("chunk", "bucket", F.lit(None).cast("binary").alias("ids"), F.lit(None).cast("binary").alias("counts"), "numbers"))
    words = kept(to_words.groupBy("bucket").applyInArrow(settled(_parent), ANSWER), "parents")

    named = {r[0]: (r[1], *r[2:]) for r in seated.where(F.col("kind") == HOT).groupBy("context_id").agg(
        F.sum("customers"), *(F.sum(F.col("tables")[s]) for s in range(SAMPLES))).collect()}
    t = words.where(F.col("kind") == TOTAL).agg(
        F.sum("context_id"), F.sum("customers"), *(F.sum(F.col("tables")[s]) for s in range(2 * SAMPLES))).first()
    totals = Totals(t[0] or 0, t[1] or 0, [x or 0 for x in t[2 : 2 + SAMPLES]], [x or 0 for x in t[2 + SAMPLES :]], named)
    shared = spark.sparkContext.broadcast(totals)
    columns = ("chunk", "kind", "bucket", "numbers")
    answers = seated.where(F.col("kind") == PAIRS).select(*columns).unionByName(words.where(F.col("kind") == WORDS).select(*columns))
    tagged = texts.mapInArrow(_tag(chunk), "chunk long, doc_id long, held_out boolean, text string")
    return tagged.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_score(chunk, buckets, hot, shared), RESULT)


def _hot_words(asked: DataFrame, buckets: int) -> np.ndarray:
    """32-bit hashes of words that hold more than a quarter of a bucket's share; HOT_WORDS of them at most.

    Taken from the most frequent words of every chunk. Which contexts are dealt out does not change what is counted.
    """
    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array((unpack_sorted(ids) >> HALF).astype(np.int64)), pa.array(unpack_counts(counts))], ["word", "n"])

    top = asked.where("bucket = -1").select("ids", "counts").mapInArrow(unfold, "word long, n long")
    rows = top.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(HOT_WORDS).collect()
    whole = sum(r[1] for r in rows)
    return np.array(sorted(r[0] for r in rows if r[1] * 4 * buckets > whole), np.uint64)


def query(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.coalesce(bucket_of("doc_id", 7) == 2, F.lit(False))
    return score_documents(spark.read.parquet(f"{folder}/documents.parquet"), held_out)
