"""Every stage against a plain version of it, on its own input."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as pipeline  # noqa: E402
from plain import AWKWARD, bag, components, contamination, frame, near_copies, without_repeats  # noqa: E402

SF = "/root/testdata/sf0.001"


def _columns(frame_):
    return bag(frame_.select("doc_id", "text", "lang", "source").collect())


def test_stages_on_the_smallest_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns, rows = docs.columns, [tuple(r) for r in docs.select("doc_id", "text").collect()]

    known = pipeline.identify_language(spark, docs, SF)
    assert known.columns == columns and known.count() >= 0.98 * len(rows)

    single = pipeline.drop_near_duplicates(spark, docs, SF)
    groups = components(rows, 5, 80, 100)
    assert single.columns == columns and {r.doc_id for r in single.select("doc_id").collect()} == {d for d, (_, c) in groups.items() if c == d}

    cut = pipeline.cut_repeats(spark, docs, SF)
    want = {d: n - gone for d, n, gone, _, _ in without_repeats(rows)}
    got = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == columns and set(got) == {d for d, left in want.items() if left}
    assert all(len(r.text.encode()) <= want[d] and len(r.text.encode()) >= want[d] - 40 and r.n_chars == len(r.text) for d, r in got.items())

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = pipeline.drop_contaminated(spark, docs, SF)
    dirty = {r[0] for r in contamination(rows, items) if r[-1]}
    assert dirty and clean.columns == columns and {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - dirty


def test_stages_take_awkward_rows(spark):
    rows = AWKWARD + near_copies(n=12) + [(None, None), (None, "no id has this text at all")]
    docs = frame(spark, rows)
    for _, stage in pipeline.STAGES[1:4]:
        left = stage(spark, docs, SF)
        assert left.columns == docs.columns
        assert left.where("doc_id IS NULL").count() == 3
        assert left.schema["size"].dataType == docs.schema["size"].dataType
    assert pipeline.identify_language(spark, docs, SF).where("text IS NULL").count() == 0
    assert pipeline.drop_near_duplicates(spark, docs, SF).where("doc_id = 15").count() == 1
    assert pipeline.encode(spark, docs, SF).count() == len(rows)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.where("false"), SF).count() == 0


def test_the_whole_run(spark):
    got = pipeline.run(spark, SF)
    assert got.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 100 < got.count() <= 200
