"""Operators that learn: what can be counted is compared, what is learned is measured on held-out rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plain import AWKWARD, bag, frame, spaced
from tidemark.llm import importance, language, pitman_yor, queries

SF = "/root/testdata/sf0.01"


# ---- language


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = queries.QUERIES["op5_language_id"](spark, SF).join(docs, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 1000 and {r.doc_id for r in held} == {i for i in range(1000) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got) and sum(r.rejected for r in got) <= 20


def test_language_of_awkward_texts(spark):
    rows = [(i, t, "xx" if i and i % 2 else "yy") for i, t in AWKWARD] + [(30, "no label here", None)]
    docs = frame(spark, rows)
    model = language.learn(docs, F.lit(True))
    assert model.langs == ["xx", "yy"]
    got = {(r.doc_id, r.lang_pred) for r in language.identify(docs, model).collect()}
    for i in (-5, 0, 2, 9):
        assert (i, "und") in got
    assert all(p in ("xx", "yy") for i, p in got if i not in (-5, 0, 2, 9))
    assert language.identify(docs.where("false"), model).collect() == []
    nothing = language.learn(docs.where("false"), F.lit(True))
    assert {(r.lang_pred, r.score, r.rejected) for r in language.identify(docs, nothing).collect()} == {("und", 0.0, True)}


def test_sample_is_bounded(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert set(language.learn(docs, F.lit(True), sample_rows=80).langs) == {"de", "en", "es", "fr"}


def test_uncertain_predictions_are_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.learn(docs, F.lit(True), sample_rows=400)
    odd = frame(spark, [(1, "zq xw kjq wqz 9 qqx jxk"), (2, "x")])
    sure = language.identify(docs, model).agg(F.avg("score")).first()[0]
    assert all(r.score < sure for r in language.identify(odd, model).collect())


# ---- Pitman-Yor


@pytest.mark.parametrize("limits", [{}, {"chunk": 3000, "bucket_bytes": 2000}])
def test_counts_and_base_scores(spark, limits):
    rng = np.random.default_rng(2)
    rows = [r for r in AWKWARD if r[0] is not None] + [(50 + i, " ".join(f"w{int(x)}" for x in rng.zipf(1.5, 80) % 500)) for i in range(60)]
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    counts = Counter()
    for d, t in rows:
        if not held(d):
            counts.update([*spaced(t), None])
    n, v = sum(counts.values()), len(counts)
    got = pitman_yor.score_documents(frame(spark, rows), F.crc32(F.col("doc_id").cast("string")) % 7 == 2, **limits).collect()
    want = []
    for d, t in rows:
        tokens = [*spaced(t), None]
        want.append((d, held(d), len(tokens), sum(counts[x] > 0 for x in tokens), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in tokens), 6)))
    assert bag((*r[:5], round(r.base_score, 6)) for r in got) == bag(want)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_model_beats_base_on_held_out_text(spark):
    got = [r for r in queries.QUERIES["op10_pitman_yor"](spark, SF).collect() if r.held_out]
    assert sum(r.score for r in got) > 0.95 * sum(r.base_score for r in got)


def test_predictive_probabilities_add_up_to_one():
    rng = np.random.default_rng(3)
    words, contexts = 30, 6
    ids = np.unique((rng.integers(0, contexts, 300).astype(np.uint64) << np.uint64(32)) | rng.integers(0, words - 5, 300).astype(np.uint64))
    customers = rng.integers(1, 60, len(ids))
    samples = list(pitman_yor.restaurants(ids, customers, 1))
    word = (ids & np.uint64(0xFFFFFFFF)).astype(int)
    known = np.unique(word)
    parent = [np.bincount(word, t, words).astype(int) for t in samples]
    tables = [pitman_yor.seat(p, np.full(words, 0.7), 0.7, rng) for p in parent]
    totals = pitman_yor.Totals(len(known), 0, [int(p.sum()) for p in parent], [int(t.sum()) for t in tables], {})
    every = np.append(known, words - 1)  # the last one stands for the unknown word
    above = pitman_yor.parent_probability(np.stack([np.zeros(words), *parent, *tables])[:, every], totals)
    assert np.allclose(above.sum(axis=1), 1)
    for c in range(contexts):
        own = (ids >> np.uint64(32)) == c
        pair = np.zeros((1 + len(samples), words))
        for row, x in enumerate((customers, *samples)):
            pair[row, word[own]] = x[own]
        context = np.repeat(pair.sum(axis=1)[:, None], len(every), axis=1)
        assert np.isclose(pitman_yor.probability(pair[:, every], context, above).sum(), 1)
    assert all((t >= 1).all() and (t <= customers).all() for t in samples)


def test_more_discount_seats_more_tables():
    rng = np.random.default_rng(0)
    customers = np.full(4000, 50)
    few, many = (pitman_yor.seat(customers, np.full(4000, w), 0.5, rng).mean() for w in (0.1, 2.0))
    assert 1 < few < many < 50


def test_what_is_sent_is_compressed():
    rng = np.random.default_rng(4)
    none = np.zeros(0, np.uint64)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, 400) % 5000) for _ in range(200)]
    docs = pa.RecordBatch.from_pydict({"text": texts, "train": [i % 7 > 0 for i in range(200)]})
    asked = pa.Table.from_batches(pitman_yor._ask(20_000, 1, True, none)(iter([docs])))
    n = sum(len(pitman_yor.unpack_sorted(x)) for x in asked["ids"].to_pylist())
    # Twelve bytes a pair before, both ways.
    assert len(asked) > 10 and n > 20_000
    assert sum(map(len, asked["ids"].to_pylist() + asked["counts"].to_pylist())) < 8 * n
    answers = pitman_yor._contexts(1, none)(asked)
    assert sum(map(len, answers.filter(pa.compute.equal(answers["kind"], pitman_yor.PAIRS))["numbers"].to_pylist())) < 4 * n


def test_packed_numbers_come_back():
    rng = np.random.default_rng(5)
    for ids in (np.zeros(0, np.uint64), np.array([0, 1, 2**64 - 1], np.uint64), np.unique(rng.integers(0, 2**64, 5000, np.uint64))):
        assert np.array_equal(pitman_yor.unpack_sorted(pitman_yor.pack_sorted(ids)), ids)
    for counts in (np.zeros(0, np.uint64), np.array([0, 255, 256, 2**32 - 1], np.uint64), rng.integers(0, 70_000, 5000, np.uint64)):
        assert np.array_equal(pitman_yor.unpack_counts(pitman_yor.pack_counts(counts)), counts.astype(np.int64))


def test_scores_of_nothing(spark):
    assert pitman_yor.score_documents(frame(spark, []), F.lit(False)).collect() == []
    got = pitman_yor.score_documents(frame(spark, [(1, None), (2, "")]), F.col("doc_id") == 2).collect()
    assert bag((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in got) == [(1, False, 1, 1, 1), (2, True, 1, 1, 1)]


# ---- importance resampling


def test_kth_greatest(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(0, 1, 9000), np.full(3000, 0.25), rng.normal(0, 1e-9, 3000), [1e6]])
    frame_ = spark.createDataFrame([(float(x),) for x in values], "x double").cache()
    order = np.sort(values)[::-1]
    for k in (1, 2, 777, 5000, 9000, len(values)):
        assert importance.kth_greatest(frame_, "x", k) == order[k - 1]


def test_good_documents_are_sampled(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = queries.QUERIES["op1_importance"](spark, SF)
    assert got.count() == 1000
    rates = {r[0]: r[1] for r in got.join(labels, "doc_id").groupBy(((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good")).agg(F.avg(F.col("kept").cast("int"))).collect()}
    assert rates[True] > 0.9 and rates[False] < 0.5


def test_weights_are_the_ratio_of_two_models(spark):
    rows = [(1, "good words here"), (2, "bad !! words"), (3, "good day"), (4, None), (5, ""), (None, "good words")]
    labels = spark.createDataFrame([(1, 1, 0, "x"), (3, 1, None, "x"), (2, 0, 1, "x"), (3, None, 1, "x"), (9, 1, 0, "x")], "doc_id long, quality int, toxic int, kept string")
    got = {r.doc_id: r for r in importance.resample(frame(spark, rows), labels, k=2).collect()}
    assert len(got) == 6 and sum(r.kept for r in got.values()) == 2
    assert got[4].log_weight is None and not got[4].kept and not got[5].kept
    assert got[2].log_weight < got[None].log_weight
    assert got[1].n_features == 5 and got[2].n_features == 4


def test_without_labels_all_is_kept(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = importance.resample(frame(spark, AWKWARD), none).collect()
    assert len(got) == len(AWKWARD) and all(r.kept == (r.n_features > 0) for r in got)
    assert importance.resample(frame(spark, []), none).collect() == []
