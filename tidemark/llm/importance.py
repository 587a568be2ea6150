r"""Quality by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k.

Features of a text are its words, its runs of punctuation and its word pairs, hashed into BUCKETS. Two generative models
count them: the raw one over all documents, the target one over labelled good documents (quality 1, never toxic; at most about
TARGET_ROWS of them, drawn by a hash of the id: a documented bound on the labelled rows only). A document's importance weight is the
ratio of its probabilities under both. A sample without replacement, proportional to the weights, is the k documents of
greatest log weight plus Gumbel noise. k is the share of good documents among the labelled ones times all documents with features,
unless given. Noise is a hash of the row, so a repeated task draws the same sample.

The k-th greatest key is found by counting keys in ever finer bins; no sort of all documents. Counts of features are
arrays of fixed size, summed slice by slice.

Texts that are null, empty or without features have a null weight and are not kept. Rows of equal keys are kept together, so
repeated rows are kept alike. Labels of one document are united: one bad label outweighs good ones; null labels say
nothing. Without good labels the weights are 1 and all documents with features are kept. An empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrow import kept, text_chunks
from tidemark.llm.words import PLAIN, SPACED, grams, within_text, word_hashes

BUCKET_BITS = 18
SLICES = 16
TARGET_ROWS = 20_000
BINS = 2048
EXTRA = 5.0
PUNCTUATION = SPACED & ~PLAIN
PUNCTUATION[65:91] = False


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every feature."""
    rows = np.arange(len(offsets) - 1)
    words, first = word_hashes(data, offsets, PLAIN)
    text = np.repeat(rows, np.diff(first))
    pairs = grams(words, 2)
    inside = within_text(first, 2, len(pairs))
    marks, mark_first = word_hashes(data, offsets, PUNCTUATION)
    h = np.concatenate([words, pairs[inside], marks])
    where = np.concatenate([text, text[: len(pairs)][inside], np.repeat(rows, np.diff(mark_first))])
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), where


def _count(shared):
    """Per task the counts of all features and of those in target documents, slice by slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = (np.zeros(1 << BUCKET_BITS, np.int64) for _ in range(2))
        chosen = shared.value
        for rows, data, offsets in text_chunks(batches, "text"):
            bucket, where = features(data, offsets)
            raw += np.bincount(bucket, minlength=len(raw))
            target += np.bincount(bucket[_is_target(rows, chosen)[where]], minlength=len(raw))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLICES), pa.int32()), *(pa.array([x.tobytes() for x in np.split(c, SLICES)], pa.binary()) for c in (raw, target))],
            ["slice", "raw", "target"])

    return run


def _add(table: pa.Table) -> pa.Table:
    total = [sum((np.frombuffer(x, np.int64) for x in table[name].to_pylist()), np.zeros((1 << BUCKET_BITS) // SLICES, np.int64)) for name in ("raw", "target")]
    return pa.table({"slice": table["slice"][:1].cast(pa.int32()), "raw": pa.array([total[0].tobytes()], pa.binary()), "target": pa.array([total[1].tobytes()], pa.binary())})


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of target over raw probability of every bucket.

    Both sides get EXTRA pseudo-counts: where few occurrences are expected in the target, the ratio stays near one.
    """
    if not raw.sum() or not target.sum():
        return np.zeros(len(raw))
    expected = raw * (target.sum() / raw.sum())
    return np.log(target + EXTRA) - np.log(expected + EXTRA)


def _is_target(rows: pa.RecordBatch, chosen: np.ndarray) -> np.ndarray:
    ids = rows.column("doc_id")
    return np.isin(ids.fill_null(-1).to_numpy(), chosen) & ids.is_valid().to_numpy(zero_copy_only=False)


def _weigh(shared):
    """Log weights; a document that the target model counted is weighed by the models without it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target, chosen = shared.value
        ratios = log_ratios(raw, target)
        share = target.sum() / max(raw.sum(), 1)
        for rows, data, offsets in text_chunks(batches, "text"):
            bucket, where = features(data, offsets)
            n = np.bincount(where, minlength=len(rows))
            each = ratios[bucket]
            own = np.flatnonzero(_is_target(rows, chosen)[where])
            if len(own):
                _, back, times = np.unique((where[own] << BUCKET_BITS) | bucket[own], return_inverse=True, return_counts=True)
                times, b = times[back], bucket[own]
                each[own] = np.log(target[b] - times + EXTRA) - np.log((raw[b] - times) * share + EXTRA)
            weight = np.bincount(where, each, minlength=len(rows))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("row_key"), pa.array(n, pa.int64()), pa.array(weight, pa.float64(), mask=n == 0)],
                ["doc_id", "row_key", "n_features", "log_weight"])

    return run


def kth_greatest(frame: DataFrame, column: str, k: int) -> float:
    """The k-th greatest value of a double column, by counting in bins; at most BINS counts or 4 * BINS values come back."""
    low, high = frame.agg(F.min(column), F.max(column)).first()
    while True:
        width = (high - low) / BINS
        inside = frame.where((F.col(column) >= low) & (F.col(column) <= high))
        if width <= 0 or low + width <= low or inside.count() <= 4 * BINS:
            values = [r[0] for r in inside.groupBy(column).count().orderBy(F.desc(column)).limit(4 * BINS).select(F.struct(column, "count")).collect()]
            above = frame.where(F.col(column) > high).count()
            for value, rows in values:
                above += rows
                if above >= k:
                    return value
            return low
        above = frame.where(F.col(column) > high).count()
        number = F.least(F.lit(BINS - 1), F.floor((F.col(column) - low) / width)).cast("int")
        bins = inside.groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        for _, n, bin_low, bin_high in sorted(bins, reverse=True):
            above += n
            if above >= k:
                low, high = bin_low, bin_high
                break


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, target_rows: int = TARGET_ROWS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_features, log_weight, gumbel_key, kept: one row per row of ``docs``."""
    spark = docs.sparkSession
    body = F.col(text).cast("string")
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(doc_id).cast("long"), body).alias("row_key"), body.alias("text"))
    judged = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        ((F.min("quality") == 1) & (F.coalesce(F.max("toxic"), F.lit(0)) == 0)).alias("good"))
    total, good = judged.agg(F.count(F.lit(1)), F.sum(F.col("good").cast("int"))).first()
    good = good or 0
    draw = F.pmod(F.xxhash64("doc_id", F.lit("target")), F.lit(1 << 30))
    chosen = judged.where(F.col("good") & (draw < min(1 << 30, int((1 << 30) * target_rows / max(good, 1)))))
    ids = np.array(sorted(r[0] for r in chosen.select("doc_id").collect()), np.int64)

    rows = texts.mapInArrow(_count(spark.sparkContext.broadcast(ids)), "slice int, raw binary, target binary").groupBy("slice").applyInArrow(
        _add, "slice int, raw binary, target binary").collect()
    counts = [np.concatenate([np.frombuffer(r[i], np.int64) for r in sorted(rows, key=lambda r: r[0])]) if rows else np.zeros(1 << BUCKET_BITS, np.int64) for i in (1, 2)]
    models = spark.sparkContext.broadcast((*counts, ids))
    uniform = (F.pmod(F.xxhash64("row_key", F.lit("gumbel")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = kept(texts.mapInArrow(_weigh(models), "doc_id long, row_key long, n_features long, log_weight double").withColumn(
        "gumbel_key", F.col("log_weight") - F.log(-F.log(uniform))), "weights")
    usable = keyed.where("gumbel_key IS NOT NULL").select("gumbel_key")
    n = usable.count()
    if k is None:
        k = round(n * good / total) if total and good else n
    least = kth_greatest(usable, "gumbel_key", k) if n and k else float("inf")
    return keyed.select("doc_id", "n_features", "log_weight", "gumbel_key", F.coalesce(F.col("gumbel_key") >= least, F.lit(False)).alias("kept"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return resample(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
