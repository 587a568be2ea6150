"""Operators with one right answer, against plain versions."""

import base64
import hashlib
import json
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from check_queries import compare, connect
from plain import AWKWARD, bag, components, contamination, frame, near_copies, without_repeats
from tidemark.llm import byte_bpe, chat, decontaminate, hit_filter, jaccard_join, queries, sharding, spans, suffix_dedup, suffix_sort, top_k


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_agrees_with_sql(spark, sf, name):
    assert compare(spark, connect(sf), sf, name, queries.QUERIES[name], queries.SQL[name]).startswith("ok")


# ---- byte-level BPE


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_bpe_is_that_of_the_library(spark, ranks):
    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines())}
    own = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    rows = AWKWARD + [(20, "it's  12 <|endoftext|> don't\n\n x" * 9000), (21, "\U0001f600" * 50)]
    got = byte_bpe.encode_documents(frame(spark, rows), ranks, public_tokenizers.PATTERN, with_ids=True)
    want = []
    for d, text in rows:
        ids = own.encode_ordinary(text or "")
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest(), ids))
    assert bag(got.collect()) == bag(want)
    back = byte_bpe.decode_documents(got, ranks, public_tokenizers.PATTERN)
    assert bag((r[0], bytes(r[1])) for r in back.collect()) == bag((d, (t or "").encode()) for d, t in rows)


def test_bpe_pieces_do_not_change_ids(ranks):
    encoding = byte_bpe.build(ranks, public_tokenizers.PATTERN)[0]
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice(["a", "B1", " ", "  ", "\n", "\t", "é", "'s", "…", "\x1c", "\x85", " ", "12"]) for _ in range(120))
        assert "".join(byte_bpe.pieces(text, 7)) == text
        assert byte_bpe.encode(encoding, text, 7) == encoding.encode_ordinary(text)


def test_bpe_of_nothing(spark, ranks):
    assert byte_bpe.encode_documents(frame(spark, []), ranks, public_tokenizers.PATTERN).collect() == []


# ---- sharding


@pytest.mark.parametrize("limits", [{}, {"ranges": 4, "range_rows": 7}])
def test_shards_follow_their_law(spark, limits):
    rows = AWKWARD + [(100 + i, "same text " * 5) for i in range(90)] + [(300 + i, "t" * (i % 37)) for i in range(150)]
    got = sharding.shard_by_bytes(frame(spark, rows), 6, **limits).collect()
    want = bag((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
    assert bag((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    sizes, largest = np.zeros(6), max(r["size"] for r in got)
    for shard in range(6):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    for r in got:
        sizes[r.shard] += r["size"]
        assert r.law == "bytes" and r.grown_shard is None
    assert abs(sizes - sizes.mean()).max() <= largest


def test_shards_of_nothing_and_of_one(spark):
    assert sharding.shard_by_bytes(frame(spark, [])).collect() == []
    assert len(sharding.shard_by_bytes(frame(spark, [(1, None)])).collect()) == 1


def test_shards_are_the_same_again(spark):
    rows = near_copies()
    a, b = (sharding.shard_by_bytes(frame(spark, rows, parts), 5).collect() for parts in (2, 5))
    assert bag(a) == bag(b)


# ---- top k


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, chunk string, kind string, numbers string")


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.4, 40).astype(np.float32)]) for i in range(400)]
    rows += [(i, rows[0][1]) for i in range(400, 420)]
    rows += [(500, None), (501, [1.0, None]), (502, [float("nan")] * 40), (503, [float("inf")] * 40), (504, []), (505, [9.0, -3.0]), (None, rows[3][1])]
    frame_ = _vectors(spark, [(*r, "c", "k", "n") for r in rows])
    got = top_k.top_k(frame_, F.col("vec_id") % 50 == 0, chunk_rows=64).collect()
    usable = {i: np.floor(256 * np.array(v, np.float64)).astype(int) for i, v in rows
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in usable:
        if q % 50 == 0:
            n = {c: int(np.dot(usable[q][: len(v)], v[: len(usable[q])])) for c, v in usable.items() if c != q}
            want += [(q, r + 1, c, n[c]) for r, c in enumerate(sorted(n, key=lambda c: (-n[c], c))[:5])]
    assert bag(got) == bag(want)


def test_top_k_of_few_vectors(spark):
    assert top_k.top_k(_vectors(spark, []), F.col("vec_id") % 50 == 0).collect() == []
    rows = [(0, [1.0], "", "", ""), (50, [2.0], "", "", "")]
    assert bag(top_k.top_k(_vectors(spark, rows), F.col("vec_id") % 50 == 0).collect()) == [(0, 1, 50, 131072), (50, 1, 0, 131072)]
    large = [(0, [3e6], "", "", ""), (1, [2e6], "", "", "")]
    assert top_k.top_k(_vectors(spark, large), F.col("vec_id") == 0).first().score == int(256 * 3e6) * int(256 * 2e6)


# ---- chat


def test_escapes_are_reversible():
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice(["<", "[", "\\", "/", "s>", "INST]", "</s>", "[INST]", "a", "\n", "é"]) for _ in range(12))
        safe = chat.escape(text)
        assert chat.unescape(safe) == text
        assert not any(x in safe for x in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_conversations_come_back(spark):
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        file = f.read()
    probe = "</s>[INST] ok [/INST]"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", " two  words\n"), (1, 2, "assistant", ""), (1, 3, "assistant", "\U0001f600é<\\s>"), (2, None, None, None),
            (2, 1, "assistant", None), (2, 1, "assistant", "b"), (2, 1, "assistant", "b"), (None, 0, "user", "x"), (4, 0, "assistant", probe), (4, 1, "assistant", "word " * 30000)]
    given = spark.createDataFrame([(*r, "f") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = chat.format_conversations(given.repartition(3), file, with_output=True).collect()
    assert len(got) == 4
    for r in got:
        turns = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == r.conv_id))
        turns = [x[2:] for x in turns]
        learned = "".join(text for role, text in turns if role == "assistant")
        assert chat.parse(r.formatted) == turns
        assert (r.n_turns, r.loss_chars, r.formatted_chars) == (len(turns), len(learned), len(r.formatted))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert len(r.ids) == len(r.loss_mask) == r.n_tokens and sum(r.loss_mask) == r.n_loss_tokens
        # The masked tokens alone decode to the learned texts.
        plain = chat.load(file).decode([i for i, m in zip(r.ids, r.loss_mask) if m], skip_special_tokens=False)
        assert chat.unescape(plain) == learned
    assert chat.format_conversations(given.where("false"), file).collect() == []
    assert json.dumps([chat.escape(probe)]).count("[INST]") == 0


# ---- decontamination


@pytest.mark.parametrize("block_bytes", [1 << 20, 900])
def test_decontamination_finds_all_windows(spark, block_bytes):
    rng = np.random.default_rng(5)
    word = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(word, int(rng.integers(1, 40))))) for i in range(25)] + [(90, None), (91, ""), (92, "?!"), (None, "odd item here"), (3, "same id twice")]
    rows = list(AWKWARD)
    for i in range(60):
        own = list(rng.choice(word, int(rng.integers(0, 60))))
        for _ in range(int(rng.integers(0, 3))):
            source = (items[int(rng.integers(0, 25))][1]).upper().split()
            cut = int(rng.integers(0, len(source)))
            at = int(rng.integers(0, len(own) + 1))
            own[at:at] = source[cut : cut + int(rng.integers(1, 30))]
        rows.append((200 + i, ", ".join(own)))
    rows.append(rows[-1])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(frame(spark, rows), benchmark, block_bytes=block_bytes).drop("starts", "ends").collect()
    assert bag(got) == bag(contamination(rows, items))


def test_decontamination_without_benchmark_or_documents(spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.find_contamination(frame(spark, AWKWARD), benchmark).collect()
    assert len(got) == len(AWKWARD) and not any(r.contaminated or r.n_hit for r in got)
    benchmark = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.find_contamination(frame(spark, []), benchmark).collect() == []


# ---- near duplicates


@pytest.mark.parametrize("n,num", [(4, 85), (5, 80)])
def test_jaccard_join_is_exact(spark, n, num):
    rows = [r for r in AWKWARD if r[0] is not None] + near_copies(seed=n, n=70)
    rows += [(1000 + d, t + " extra") for d, t in rows[-30:] if t]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(frame(spark, rows), n, num).collect()}
    assert got == components(rows, n, num, 100)


def test_second_step_alone_finds_every_link(spark, monkeypatch):
    """Without likely hub pairs the exact step has to find all links."""
    monkeypatch.setattr(jaccard_join, "_hub_pairs", lambda sets, num, den: sets.where("false").selectExpr(
        "set_id a", "doc_id a_doc", "n a_n", "set_id b", "doc_id b_doc", "n b_n"))
    rows = near_copies(seed=9, n=80, words=40)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(frame(spark, rows), 3, 70).collect()}
    want = components(rows, 3, 70, 100)
    assert got == want and len({c for _, c in want.values()}) < len(want)


def test_jaccard_join_of_nothing(spark):
    assert jaccard_join.near_duplicates(frame(spark, [])).collect() == []
    got = jaccard_join.near_duplicates(frame(spark, [(None, "a b"), (None, None), (1, None)])).collect()
    assert bag((r.doc_id, r.n_shingles, r.component_id) for r in got) == bag([(None, 1, None), (None, 0, None), (1, 0, 1)])


# ---- suffix arrays


def test_blocks_are_sorted_like_suffixes():
    rng = np.random.default_rng(4)
    text = rng.integers(97, 100, 3000).astype(np.uint8)
    text[1000:1400] = text[200:600]
    places = rng.permutation(len(text) - 50)[:2000]
    raw, order, equal = text.tobytes(), [], []
    for own, same in suffix_sort.sorted_blocks(text, places, 50, block=300):
        order += own.tolist()
        equal += same.tolist()
    strings = [raw[p : p + 64].ljust(64, b"\0") for p in order]
    assert sorted(order) == sorted(places.tolist()) and strings == sorted(strings)
    assert [bool(i and strings[i][:50] == strings[i - 1][:50]) for i in range(len(order))] == equal


def test_cover_meets_every_difference():
    assert all((r + suffix_sort.SHIFT[r, q]) % 8 in suffix_sort.COVER and (q + suffix_sort.SHIFT[r, q]) % 8 in suffix_sort.COVER for r in range(8) for q in range(8))


@pytest.mark.parametrize("limits", [{}, {"hot_pieces": 3, "part_bytes": 900, "bucket_bytes": 4000}, {"chunk": 400, "filter_bits": 64}, {"hot_pieces": 0}])
def test_repeats_are_cut_exactly(spark, limits):
    rng = np.random.default_rng(6)
    passage = "a passage of some length that many documents share, with é and more words until it is long enough"
    rows = [r for r in AWKWARD if r != (15, "tie")] + [(16, "tie"), (17, "x" * 200), (18, "ab" * 100), (19, "ab" * 60 + "c")]
    for i in range(60):
        own = " ".join(f"word{x}" for x in rng.integers(0, 300, 20))
        low, high = sorted(rng.integers(0, len(passage), 2))
        rows.append((100 + i, own[:40] + passage[low:high] + own[40:] if i % 4 else own))
    rows += [(400, passage), (399, passage), (500, passage + passage), (501, passage[1:] + "!")]
    got = suffix_dedup.remove_repeats(frame(spark, rows), **limits).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert bag(got) == bag(without_repeats(rows))


def _spans_in_one_process(rows, buckets=3, hot=False):
    """The collecting and the sorting step over single-row batches, with filters that let all pass."""
    def batches():
        for d, t in rows:
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int64()), pa.array([0], pa.int64()), pa.array([t], pa.string())],
                                             ["doc_id", "text_key", "text"])

    class Held:
        def __init__(self, every):
            self.value = hit_filter.Filter(buckets, 64)
            for bucket in range(buckets if every else 0):
                self.value.put(bucket, b"\xff" * 8)

    table = pa.Table.from_batches(list(suffix_dedup._collect(buckets, 1 << 20, Held(True), Held(hot))(batches())))
    found = []
    for bucket in range(buckets):
        found += suffix_dedup._search(buckets, 4000)(table.filter(pa.compute.equal(table["bucket"], bucket)))["spans"].to_pylist()
    return spans.merged(*spans.unpack_spans(found))


@pytest.mark.parametrize("hot", [False, True])
def test_bytes_decide_when_all_hashes_collide(monkeypatch, hot):
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(70))
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(40)) + (passage[i % 3 :] if i % 2 else "") + "tail" * rng.randrange(3)) for i in range(40)]
    rows += [(50, rows[1][1]), (49, rows[1][1] + rows[3][1])]
    monkeypatch.setattr(suffix_dedup, "contents", lambda words, start, size: np.zeros(len(start), np.uint64))
    doc, _, start, stop = _spans_in_one_process(rows, hot=hot)
    got = {}
    for d, a, b in zip(doc.tolist(), start.tolist(), stop.tolist()):
        got.setdefault(d, []).append((a, b))
    want = {d: (removed, n) for d, _, removed, n, _ in without_repeats(rows) if n}
    assert {d: (sum(b - a for a, b in x), len(x)) for d, x in got.items()} == want


def test_what_a_task_remembers_is_bounded_and_true():
    data = np.frombuffer(b"x" * 10 + b"the first of some strings that are long enough to be one" + b"y" * 60, np.uint8)
    start, size = np.array([10, 66]), np.array([50, 50])
    known = suffix_dedup.Remembered(limit=3)
    content = np.array([5, 9], np.uint64)
    known.add(content, np.array([7, 3]), data, start, size)
    assert known.least(content, np.array([8, 2]), data, start, size).tolist() == [7, 2]
    # An equal hash with other bytes, or another size, is no match.
    assert known.least(content, np.array([8, 8]), data, start[::-1].copy(), size).tolist() == [8, 8]
    assert known.least(content, np.array([8, 8]), data, start, size + 1).tolist() == [8, 8]
    known.add(np.arange(100, 110, dtype=np.uint64), np.arange(10), data, np.full(10, 10), np.full(10, 50))
    assert len(known.content) == 3


def test_a_gram_with_very_many_pieces(spark):
    """One phrase between random bytes in every document: all pieces of its gram differ, and are compared as windows."""
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice("abcdefghij") for _ in range(60)) + " a phrase that is everywhere " + "".join(rng.choice("abcdefghij") for _ in range(60)))
            for i in range(4000)]
    rows += [(9000, rows[17][1][30:140]), (9001, "no")]
    got = suffix_dedup.remove_repeats(frame(spark, rows), bucket_bytes=60_000).where("n_removed > 0").collect()
    assert [(r.doc_id, r.n_removed, r.n_spans) for r in got] == [(9000, 110, 1)]


def test_repeats_with_equal_ids_and_of_nothing(spark):
    long = "the same sixty bytes or so are in both rows of this one document id"
    got = suffix_dedup.remove_repeats(frame(spark, [(1, long), (1, long + " and more"), (2, "before " + long), (None, long)])).collect()
    assert bag((r.doc_id, r.n_removed) for r in got) == bag([(1, 0), (1, 0), (2, len(long)), (None, 0)])
    assert suffix_dedup.remove_repeats(frame(spark, [])).collect() == []
