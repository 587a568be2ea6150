"""Fill-in-the-middle and filter audit, against plain versions and awkward rows."""

import hashlib
import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from plain import AWKWARD, bag, frame, near_copies
from tidemark.llm import fill_middle, filter_audit

# ---- fill-in-the-middle


def plain_fill(doc_id, text, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 50:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


LINES = [(100 + i, "".join(random.Random(i).choice(["a", "\n", "é\n", "<", "<S", "日本", "<P", "M>", "\r\n", "\x85", "x y\n"]) for _ in range(60)))
         for i in range(80)] + [(7, "has <M> in it\n"), (9, "\n" * 5000), (11, "no line end " * 30000), (None, "a\nb\n"), (12, "tie\n\n"), (12, "tie\n\n")]


def test_fill_in_middle_is_the_plain_one_and_comes_back(spark):
    rows = AWKWARD + LINES
    made = fill_middle.fill_in_middle(frame(spark, rows)).withColumn("back", fill_middle.restored())
    got = made.collect()
    assert bag(tuple(r)[:-1] for r in got) == bag(plain_fill(d, t) for d, t in rows)
    assert bag((r.doc_id, r.back) for r in got) == bag((d, t or "") for d, t in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_takes_other_units_markers_and_rates(spark):
    rows = [(i, f"one two  three {i} four") for i in range(200)]
    made = fill_middle.fill_in_middle(frame(spark, rows), unit=r"\S+\s*|\s+", markers=("[p]", "[s]", "[m]"), rate=50, spm=0)
    got = made.withColumn("back", fill_middle.restored(markers=("[p]", "[s]", "[m]"))).collect()
    assert {r.n for r in got} == {5} and {r.form for r in got} == {"plain", "psm"}
    assert 60 < sum(r.form == "psm" for r in got) < 140 and {(r.doc_id, r.back) for r in got} == set(rows)


@pytest.mark.parametrize("markers", [("<P>", "<P>", "<M>"), ("<P>", "<P>x", "<M>"), ("ab", "bc", "x"), ("", "a", "b"), ("aa", "b", "c")])
def test_markers_that_could_be_mistaken_are_refused(markers):
    with pytest.raises(ValueError):
        fill_middle.check_markers(markers)


def test_fill_in_middle_of_nothing(spark):
    assert fill_middle.fill_in_middle(frame(spark, [])).collect() == []
    assert fill_middle.fill_in_middle(frame(spark, LINES).where("false")).collect() == []


# ---- filter audit


def plain_audit(rows, labels):
    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    docs = []
    for d, t, lang in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and first[t] < d}
        own = [x for x in labels if x[0] == d and d is not None]
        docs.append((lang or "", {x for x, f in fails.items() if f}, any(q == 1 for _, q, _ in own), any(x == 1 for _, _, x in own)))
    out = []
    for part in {p for p, *_ in docs}:
        own, total, made = [x for x in docs if x[0] == part], dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                stay = [x for x in left if f not in x[1]]
                total[f] += len(gone)
                made.append((part, "".join(order), step, len(stay), len(gone), sum(f in x[1] for x in own) - len(gone), sum(x[1] == {f} for x in own),
                             sum(x[2] for x in gone), sum(x[3] for x in gone)))
                left = stay
        out += [(*r, total[r[1][r[2] - 1]]) for r in made]
    return out


def audit_rows():
    rng = random.Random(5)
    rows = [(d, t, rng.choice(["en", "de", None, ""])) for d, t in AWKWARD + near_copies(n=30, words=260)]
    long = " ".join(f"w{i}" for i in range(300))
    rows += [(1000 + i, long if i % 3 else long + " #", "en") for i in range(40)]
    return rows + [(2000 + i, "AB " * rng.randint(150, 260), "fr") for i in range(10)] + [(None, long, "en"), (1000, long, "en"), (1000, "other", "de")]


@pytest.mark.parametrize("salt_rows", [4, 20_000])
def test_audit_is_the_plain_one(spark, salt_rows):
    rows = audit_rows()
    rng = random.Random(6)
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d, _, _ in rows if rng.random() < 0.7] + [(None, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(frame(spark, rows), table, salt_rows)
    want = plain_audit(rows, labels)
    assert any(r[5] for r in want) and any(r[7] for r in want) and any(r[8] for r in want)
    assert bag(got.collect()) == bag(want)


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, audit_rows())
    assert filter_audit.audit(docs.where("false"), labels).collect() == []
    assert filter_audit.audit(frame(spark, []), labels).collect() == []
    assert filter_audit.audit(docs, labels.where("false")).agg(F.sum("good_lost")).first()[0] == 0
