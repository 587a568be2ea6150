"""Repeated runs of words by fixed-block anchors, against a plain version."""

import random
import re

import numpy as np
import pytest

from plain import AWKWARD, bag, frame, near_copies
from tidemark.llm import block_dedup, hit_filter, spans


def plain_runs(rows, length=13):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (d, _), w in zip(rows, words):
        if d is not None:
            for i in range(len(w) - length + 1):
                run = tuple(w[i : i + length])
                first[run] = min(d, first.get(run, d))
    out = []
    for (d, _), w in zip(rows, words):
        hit = np.zeros(len(w), bool)
        if d is not None:
            for i in range(len(w) - length + 1):
                if first[tuple(w[i : i + length])] < d:
                    hit[i : i + length] = True
        out.append((d, len(w), int(hit.sum()), " ".join(x for x, h in zip(w, hit) if not h)))
    return out


def shared_passages(seed=1, n=120):
    """Documents of random words that hold passages of 11 to 40 words of a few others, at any place, and periodic ones."""
    rng = random.Random(seed)
    passages = [[f"p{i}w{j}É" for j in range(rng.choice([11, 12, 13, 14, 19, 20, 40]))] for i in range(12)]
    rows = []
    for i in range(n):
        words = [f"r{rng.randrange(10**9)}" for _ in range(rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 4)):
            at, p = rng.randrange(0, len(words) + 1), rng.choice(passages)
            low = rng.randrange(0, 3)
            words[at:at] = p[low : len(p) - rng.randrange(0, 3)]
        rows.append((rng.randrange(-500, 5000), rng.choice([" ", "\n", "\t \x0b"]).join(words)))
    return rows + [(70, "a b c " * 30), (71, "b c a " * 12), (72, "c a " * 20)]


@pytest.mark.parametrize("limits", [{}, {"bucket_bytes": 700}, {"bucket_bytes": 3000, "filter_bits": 64}])
def test_removed_words_are_the_plain_ones(spark, limits):
    rows = AWKWARD + near_copies(n=30) + shared_passages()
    got = block_dedup.remove_repeated_runs(frame(spark, rows), **limits).collect()
    want = plain_runs(rows)
    assert sum(r[2] > 0 for r in want) > 50 and sum(0 < r[2] < r[1] for r in want) > 20
    assert bag((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == bag(want)
    for r in got:
        assert sum(b - a for a, b in zip(r.starts, r.stops)) == r.n_removed
        assert all(b < c for b, c in zip(r.stops, r.starts[1:]))


@pytest.mark.parametrize("length", [3, 5, 21])
def test_runs_of_other_lengths(spark, length):
    rows = shared_passages(2, 60)
    got = block_dedup.remove_repeated_runs(frame(spark, rows), length).collect()
    assert bag((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == bag(plain_runs(rows, length))


def test_passages_across_chunks_and_tasks(spark, monkeypatch):
    """Every document is a chunk of its own, and what a task remembers is thrown away again and again."""
    rows = shared_passages(4, 80)
    monkeypatch.setattr(block_dedup.Remembered.__init__, "__defaults__", (20,))
    texts = spark.createDataFrame([(d, 0, t) for d, t in rows], "doc_id long, text_key long, text string").repartition(2)
    import pyarrow as pa

    def batches():
        for d, t in rows:
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int64()), pa.array([0], pa.int64()), pa.array([t], pa.string())], texts.columns)

    class Every:
        value = hit_filter.Filter(4, 64)

    for bucket in range(4):
        Every.value.put(bucket, b"\xff" * 8)
    parts = [b for b in block_dedup._extend(13, 7, 4, 1 << 20, Every)(batches())]
    table = pa.Table.from_batches(parts)
    found = []
    for bucket in range(4):
        out = block_dedup._covered(13, 4)(table.filter(pa.compute.equal(table["bucket"], bucket)))
        found += out["spans"].to_pylist()
    doc, _, start, stop = spans.merged(*spans.unpack_spans(found))
    removed = {}
    for d, n in zip(doc.tolist(), (stop - start).tolist()):
        removed[d] = removed.get(d, 0) + n
    ids = [d for d, _ in rows]
    assert {d: n for d, n in removed.items() if ids.count(d) == 1} == {d: n for d, _, n, _ in plain_runs(rows) if n and ids.count(d) == 1}


def test_nothing_to_remove(spark):
    assert block_dedup.remove_repeated_runs(frame(spark, [])).collect() == []
    assert block_dedup.remove_repeated_runs(frame(spark, AWKWARD).where("false")).collect() == []
    assert [r.n_removed for r in block_dedup.remove_repeated_runs(frame(spark, [(1, None), (2, ""), (None, "a b")])).collect()] == [0, 0, 0]
    with pytest.raises(ValueError):
        block_dedup.remove_repeated_runs(frame(spark, AWKWARD), 12)


def test_packed_columns_come_back():
    a, b = np.array([3, -1, 2**40], np.int64), np.array([7, 8], np.int32)
    back = spans.from_planes(spans.planes(a, b), [np.int64, np.int32], [3, 2])
    assert back[0].tolist() == a.tolist() and back[1].tolist() == b.tolist()
