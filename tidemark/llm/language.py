r"""Language identification: averaged hashed subword embeddings with a linear softmax, and calibrated rejection.

Features are the byte n-grams (2 to 4 bytes) of all words of the whole text, lower-cased in ASCII, with every byte
that is no letter turned into one word boundary; they are hashed into BUCKETS embeddings. A text is the mean of its
embeddings, and one linear softmax layer gives the languages. Training is stochastic gradient descent in numpy over a sample
of at most about SAMPLE_ROWS labelled rows (a documented bound: drawn by a hash of the id, equal shares per
language); only feature counts of whole sampled texts reach the driver. A fifth of the sample calibrates: one
temperature for the softmax, and the score below which a prediction is rejected.

For prediction the embeddings are multiplied by the output layer once, so a task only adds table rows over the bytes of
a text. The table is of fixed size (BUCKETS by languages) and is broadcast.

A null text, or one without any letter, is ``und`` with score 0 and rejected; so is everything if no labelled
row exists. Rows with null text, null language or null id are not learned from. Repeated rows are predicted one by one; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrow import bucket_of, lists, text_chunks

BUCKETS = 1 << 16
ORDERS = (2, 3, 4)
WIDTH = 12
SMALL_CHUNK = 1 << 20
SAMPLE_ROWS = 3_000
# At least so many passes over the sample, and so many steps (more passes where the sample is small).
EPOCHS, LEAST_STEPS = 6, 14_400
RATE = 0.5
# The mean spreads a gradient thinly over many buckets; this much goes to each of them.
SPREAD = 10.0
# Share of right predictions that rejection may cost, and the score that is always enough.
LOSS, ENOUGH = 0.001, 0.5

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the buckets of all n-grams and, per text, where its n-grams begin (one more at the end)."""
    folded = _FOLD[data]
    blank = folded == 0x20
    left = np.repeat(offsets[1:], np.diff(offsets))
    for n in ORDERS:
        size = max(0, len(data) - n + 1)
        h, empty = np.full(size, n, np.uint32), np.ones(size, bool)
        for i in range(n):
            h = (h ^ folded[i : i + size]) * np.uint32(0x01000193)
            # Grams of blanks alone and grams with a blank inside say nothing about a word.
            empty &= blank[i : i + size]
        for i in range(1, n - 1):
            empty |= blank[i : i + size]
        stay = ~empty & (np.arange(size) + n <= left[:size])
        h ^= h >> np.uint32(15)
        places = np.concatenate([[0], np.cumsum(stay)])
        yield (h & np.uint32(BUCKETS - 1))[stay], places[np.minimum(offsets, size)]


def counted(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per text the buckets that occur and how often."""
    found = list(features(data, offsets))
    buckets, counts = [], []
    for i in range(len(offsets) - 1):
        own = np.concatenate([b[at[i] : at[i + 1]] for b, at in found])
        b, c = np.unique(own, return_counts=True)
        buckets.append(b)
        counts.append(c)
    return buckets, counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_chunks(batches, "text", SMALL_CHUNK):
        buckets, counts = counted(data, offsets)
        sizes = np.array([len(b) for b in buckets])
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), lists(np.concatenate(buckets).astype(np.int32), sizes, pa.int32()),
             lists(np.concatenate(counts).astype(np.int32), sizes, pa.int32())], ["doc_id", "lang", "buckets", "counts"])


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float

    def scores(self, means: np.ndarray) -> np.ndarray:
        z = (means + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 1) -> Model:
    """Train on (language, buckets, counts); every fifth row is kept for calibration."""
    langs = sorted({r[0] for r in rows})
    n = len(langs)
    if not n:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, ENOUGH)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH))
    out, bias = np.zeros((n, WIDTH)), np.zeros(n)
    label = {x: i for i, x in enumerate(langs)}
    order = rng.permutation(len(rows))
    held = order[::5] if len(rows) >= 50 else order
    train = np.setdiff1d(order, held) if len(rows) >= 50 else order
    epochs = max(EPOCHS, -(-LEAST_STEPS // max(1, len(train))))
    steps, step = epochs * len(train), 0
    for _ in range(epochs):
        for r in rng.permutation(train):
            lang, buckets, counts = rows[r]
            rate = RATE * (1 - step / steps)
            step += 1
            if not len(buckets):
                continue
            share = counts / counts.sum()
            hidden = share @ vectors[buckets]
            z = out @ hidden + bias
            error = np.exp(z - z.max())
            error /= error.sum()
            error[label[lang]] -= 1
            back = out.T @ error
            out -= rate * np.outer(error, hidden)
            bias -= 0.1 * rate * error
            vectors[buckets] -= rate * SPREAD * np.outer(share, back)
    model = Model(langs, (vectors @ out.T).astype(np.float32), bias, 1.0, ENOUGH)
    usable = [rows[r] for r in held if len(rows[r][1])]
    if usable:
        means = np.array([(c / c.sum()) @ model.table[b] for _, b, c in usable])
        truth = np.array([label[x] for x, _, _ in usable])
        best = None
        for t in np.geomspace(0.25, 16, 25):
            model.temperature = float(t)
            loss = -np.log(np.maximum(model.scores(means)[np.arange(len(truth)), truth], 1e-12)).mean()
            if best is None or loss < best[0]:
                best = loss, float(t)
        model.temperature = best[1]
        scores = model.scores(means)
        right = scores.max(axis=1)[scores.argmax(axis=1) == truth]
        if len(right):
            model.least = float(min(ENOUGH, np.quantile(right, LOSS)))
    return model


def learn(docs: DataFrame, allowed: Column, sample_rows: int = SAMPLE_ROWS, doc_id: str = "doc_id", text: str = "text",
          lang: str = "lang") -> Model:
    """A model from the labelled rows for which ``allowed`` holds."""
    labelled = docs.where(allowed & F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    sizes = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return fit([])
    share = max(1, sample_rows // len(sizes))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30))
    limit = F.lit(0).cast("long")
    for name, rows in sizes.items():
        limit = F.when(F.col("lang") == name, F.lit(min(1 << 30, int((1 << 30) * share / rows)))).otherwise(limit)
    table = labelled.where(draw < limit).mapInArrow(
        _count, "doc_id long, lang string, buckets array<int>, counts array<int>").toArrow().sort_by([("doc_id", "ascending"), ("lang", "ascending")])
    return fit([(name, b.values.to_numpy(), c.values.to_numpy()) for name, b, c in zip(table["lang"].to_pylist(), table["buckets"], table["counts"])])


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        n = len(model.langs)
        for rows, data, offsets in text_chunks(batches, "text", SMALL_CHUNK):
            sums, total = np.zeros((len(rows), n)), np.zeros(len(rows))
            for buckets, at in features(data, offsets):
                filled = np.flatnonzero(np.diff(at))
                total += np.diff(at)
                if len(filled):
                    for lang in range(n):
                        column = np.ascontiguousarray(model.table[:, lang])
                        sums[filled, lang] += np.add.reduceat(column[buckets], at[filled], dtype=np.float64)
            letters = rows.column(1).to_numpy(zero_copy_only=False).astype(bool)
            if n:
                scores = model.scores(sums / np.maximum(total, 1)[:, None])
                top, score = scores.argmax(axis=1), scores.max(axis=1)
            else:
                top, score, letters = np.zeros(len(rows), int), np.zeros(len(rows)), np.zeros(len(rows), bool)
            named = [model.langs[i] if ok else "und" for i, ok in zip(top, letters)]
            score = np.where(letters, score, 0.0)
            rejected = ~letters | (score < model.least)
            yield pa.RecordBatch.from_arrays(
                [*(c for c, x in zip(rows.columns, rows.schema.names) if x != "text"), pa.array(named, pa.string()), pa.array(score, pa.float64()),
                 pa.array(rejected, pa.bool_())], [*(x for x in rows.schema.names if x != "text"), "lang_pred", "score", "rejected"])

    return run


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    body = F.col(text).cast("string")
    read = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(body.rlike(r"\p{L}"), F.lit(False)).alias("letters"), body.alias("text"))
    return read.mapInArrow(_predict(shared), "doc_id long, letters boolean, lang_pred string, score double, rejected boolean").drop("letters")


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held_out = F.coalesce(bucket_of("doc_id", 4) == 2, F.lit(False))
    model = learn(docs, ~held_out)
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
