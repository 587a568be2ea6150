r"""Near-duplicate documents: n-gram Jaccard join by vertical partitioning, and the components of its links.

Every document is the set of its distinct word n-grams (hashed to 64 bits). Equal sets are one class from the start, so
exact copies cost one row. Overlaps are counted vertically: the order of all n-grams is cut into FRAGMENTS ranges, each
set into one segment per range; segments of a candidate pair meet range by range, their partial overlaps are counted
separately and summed per pair. A pair links if the sum reaches the threshold, exactly.

Which pairs are counted:

1. *Hubs.* Sets with an equal min-hash meet in a group; each is paired with the group's first set only, and of
   these pairs a set keeps the HUBS likeliest. That is linear in the size of every group and joins nearly all copies to components.
2. *The rest, exactly.* Two linked sets share an n-gram among their first ones in the global order (rare n-grams
   first, by a counting sketch of fixed size; then by hash). One document stands for each set; which of these n-grams two sets
   share is told by a filter of bounded size, so that only those become rows. Only pairs of sets that step 1 left in different components
   are taken, with the usual bounds on sizes and positions. Inside a shared n-gram the sets of one component are first
   taken together, so that a large group of copies is no quadratic group. No link between components is lost.

Links inside a component found before need no counting, as only reachability is returned.

Null or empty texts, and texts without words, have the empty set and link with nothing. Texts of fewer words than n are one
n-gram. Rows with a null id have a null component unless a linked document has an id. Repeated rows and repeated
ids are kept row by row. An empty table gives an empty result; other columns are ignored. Different n-grams or sets share
a hash with probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrow import bitmap, consumed, kept, lists, rows_in_bitmap, text_chunks
from tidemark.llm.components import components
from tidemark.llm.hit_filter import SENT, codes, filters, sent, slice_bits
from tidemark.llm.spans import runs
from tidemark.llm.words import SPACED, grams, mix, word_hashes

FRAGMENT_BITS = 3
HUB_KEYS = 8
HUBS = 2
SKETCH_BITS = 21
SLICES = 32
BUCKET_BYTES = 6 << 20
FILTER_BITS = 1 << 26
# Bytes of text taken at once where the filter and the ranks are in memory as well.
SMALL_CHUNK = 1 << 20
KEY_SEEDS = mix(np.arange(1, HUB_KEYS + 1, dtype=np.uint64) << np.uint64(32))
SET_SEED = np.uint64(0x5851F42D4C957F2D)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of every text, one after the other, and the size of each set."""
    words, first = word_hashes(data, offsets, SPACED)
    runs = grams(words, n)
    sets, sizes = [], np.zeros(len(first) - 1, np.int64)
    for d, (low, high) in enumerate(zip(first[:-1], first[1:])):
        if high > low:
            own = np.unique(runs[low : high - n + 1]) if high - low >= n else grams(words[low:high], int(high - low))
            sets.append(own)
            sizes[d] = len(own)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), sizes


def _starts(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    filled = np.flatnonzero(sizes)
    return filled, (np.cumsum(sizes) - sizes)[filled]


def _per_set(function, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(sizes), np.uint64)
    filled, starts = _starts(sizes)
    if len(filled):
        out[filled] = function.reduceat(values, starts)
    return out


def set_ids(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return _per_set(np.add, mix(hashes ^ SET_SEED), sizes).view(np.int64)


SCAN = "doc_id long, set_id long, n long, keys array<long>, slice int, counts binary, wide int"


def _signatures(n: int):
    """Per document its set's id, size and min-hashes; per task the counts of n-grams by cell of the sketch."""
    names = [x.split()[0] for x in SCAN.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << SKETCH_BITS, np.uint32)
        for rows, data, offsets in text_chunks(batches, "text"):
            hashes, sizes = shingle_sets(data, offsets, n)
            cells += np.bincount((hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(cells)).astype(np.uint32)
            keys = np.stack([_per_set(np.minimum, mix(hashes ^ seed), sizes) for seed in KEY_SEEDS], axis=1)
            none = len(rows)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(set_ids(hashes, sizes)), pa.array(sizes),
                 lists(keys.reshape(-1).view(np.int64), np.full(none, HUB_KEYS), pa.int64()),
                 *(pa.nulls(none, kind) for kind in kinds[4:])], names)
        parts = [x.astype(np.uint8 if x.max() < 256 else np.uint32) for x in np.split(cells, SLICES)]
        yield pa.RecordBatch.from_arrays(
            [*(pa.nulls(SLICES, kind) for kind in kinds[:4]), pa.array(range(SLICES), pa.int32()),
             pa.array([x.tobytes() for x in parts], pa.binary()), pa.array([x.itemsize for x in parts], pa.int32())], names)

    return run


def _add_slices(table: pa.Table) -> pa.Table:
    total = np.zeros((1 << SKETCH_BITS) // SLICES, np.uint64)
    for counts, wide in zip(table["counts"].to_pylist(), table["wide"].to_pylist()):
        total += np.frombuffer(counts, np.uint8 if wide == 1 else np.uint32)
    # A sixteenth of a doubling is fine enough for an order, and fits in 16 bits at any size.
    rank = (16 * np.log2(1 + total.astype(np.float64))).astype(np.uint16)
    return pa.table({"slice": table["slice"][:1].cast(pa.int32()), "ranks": pa.array([rank.tobytes()], pa.binary())})


def _sketch(scanned: DataFrame) -> np.ndarray:
    """Rank of frequency for each cell: an array of fixed size, whatever the number of documents."""
    rows = scanned.where("slice IS NOT NULL").select("slice", "counts", "wide").groupBy("slice").applyInArrow(
        _add_slices, "slice int, ranks binary").collect()
    if not rows:
        # An input without partitions.
        return np.zeros(1 << SKETCH_BITS, np.uint16)
    return np.concatenate([np.frombuffer(r[1], np.uint16) for r in sorted(rows, key=lambda r: r[0])])


def _segments(n: int, shared):
    """The segments of the sets of all documents in the bitmap (few others may come along)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(rows_in_bitmap(shared, "doc_id", True)(batches), "text"):
            hashes, sizes = shingle_sets(data, offsets, n)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            cell = (doc << FRAGMENT_BITS) | (hashes >> np.uint64(64 - FRAGMENT_BITS)).astype(np.int64)
            new = np.flatnonzero(np.diff(cell, prepend=-1))
            own = set_ids(hashes, sizes)[doc[new]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own), pa.array((cell[new] & ((1 << FRAGMENT_BITS) - 1)).astype(np.int32)),
                 lists(hashes.view(np.int64), np.diff(np.append(new, len(cell))), pa.int64())], ["set_id", "fragment", "grams"])

    return run


def _prefixes(batches: Iterator[pa.RecordBatch], n: int, num: int, den: int, ranks: np.ndarray, chosen):
    """Of every set of the chosen documents the n-grams that one of any linked partner's must be among, in the global order.

    Yields a chunk's rows, the sets' ids and sizes, and set, place and rank within the set of all those n-grams.
    """
    for rows, data, offsets in text_chunks(rows_in_bitmap(chosen, "doc_id", True)(batches), "text", SMALL_CHUNK):
        hashes, sizes = shingle_sets(data, offsets, n)
        order = ranks[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
        # The place in the global order stands for the n-gram from here on.
        place = (order << np.uint64(48)) | (mix(hashes) >> np.uint64(16))
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = place[np.lexsort((place, row))]
        within = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        counts = sizes - -(-num * sizes // den) + 1
        stay = within < counts[row]
        yield rows, set_ids(hashes, sizes), sizes, row[stay], place[stay], within[stay]


def _prefix_codes(n: int, num: int, den: int, ranks, chosen, buckets: int):
    """Places of a chunk, once each, and whether two sets hold it (2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets, _, row, place, _ in _prefixes(batches, n, num, den, ranks.value, chosen):
            if not len(place):
                continue
            code = codes(mix(place), buckets)
            order = np.argsort(code)
            code, own = code[order], sets[row[order]]
            new = runs(code)
            several = np.minimum.reduceat(own, new) != np.maximum.reduceat(own, new)
            yield sent(code[new] | (several.astype(np.uint64) << np.uint64(1)))

    return run


def _held_twice(flags: np.ndarray, new: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray]:
    return ((counts > 1) | (np.maximum.reduceat(flags, new) >= 2),)


PLACES = "doc_id long, set_id long, n long, place long, at long"


def _shared_places(n: int, num: int, den: int, ranks, chosen, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sets, sizes, row, place, within in _prefixes(batches, n, num, den, ranks.value, chosen):
            stay = shared.value.holds(mix(place))
            row, ids = row[stay], rows.column("doc_id").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[row]), pa.array(sets[row]), pa.array(sizes[row]), pa.array(place[stay].view(np.int64)), pa.array(within[stay])],
                [x.split()[0] for x in PLACES.split(", ")])

    return run


def _links(texts: DataFrame, pairs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Those pairs (a, b) whose overlap, summed over the fragments, reaches the threshold.

    ``pairs`` has the sets a and b, a document of each, and their sizes.
    """
    spark = texts.sparkSession

    def segments(doc: str, set_id: str, grams: str) -> DataFrame:
        shared = spark.sparkContext.broadcast(bitmap(pairs.select(doc).distinct(), doc))
        return texts.mapInArrow(_segments(n, shared), "set_id long, fragment int, grams array<long>").toDF(set_id, "fragment", grams)

    left, right = segments("a_doc", "a", "left"), segments("b_doc", "b", "right")
    # A set may come from several documents: the partial overlap of a fragment counts once.
    partial = pairs.select("a", "b").join(left, "a").join(right, ["b", "fragment"]).groupBy("a", "b", "fragment").agg(
        F.max(F.size(F.array_intersect("left", "right"))).alias("common"))
    total = partial.groupBy("a", "b").agg(F.sum("common").alias("common"))
    return total.join(pairs.select("a", "b", "a_n", "b_n"), ["a", "b"]).where(
        F.col("common") * (num + den) >= (F.col("a_n") + F.col("b_n")) * num).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _hub_pairs(sets: DataFrame, num: int, den: int) -> DataFrame:
    member = sets.select("set_id", "doc_id", "n", F.posexplode("keys").alias("k", "key"))
    hubs = member.groupBy("k", "key").agg(
        F.min(F.struct("doc_id", "set_id", "n")).alias("hub"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    met = member.join(hubs.select("k", "key", "hub"), ["k", "key"]).where("set_id <> hub.set_id").where(
        (F.least("n", "hub.n") * den >= F.greatest("n", "hub.n") * num)).groupBy("set_id", "doc_id", "n", "hub").agg(F.count(F.lit(1)).alias("keys"))
    # At most HUB_KEYS hubs a set; those with the most keys in common are the likeliest links.
    likely = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("keys")).alias("keys"), "hub"))), 1, HUBS)
    return met.groupBy("set_id", "doc_id", "n").agg(likely.alias("hubs")).withColumn("h", F.explode("hubs")).select(
        F.col("set_id").alias("a"), F.col("doc_id").alias("a_doc"), F.col("n").alias("a_n"),
        F.col("h.hub.set_id").alias("b"), F.col("h.hub.doc_id").alias("b_doc"), F.col("h.hub.n").alias("b_n"))


def _place_rows(texts: DataFrame, sets: DataFrame, n: int, num: int, den: int, ranks, bucket_bytes: int, filter_bits: int) -> DataFrame:
    """doc_id, set_id, n, place, at, component of all first places that sets of several components share."""
    context = texts.sparkSession.sparkContext
    # One document stands for every set.
    chosen = context.broadcast(bitmap(sets.select("doc_id"), "doc_id"))
    grams_all = sets.agg(F.sum("n")).first()[0] or 0
    buckets = max(2, -(-4 * grams_all // bucket_bytes))
    probes = texts.mapInArrow(_prefix_codes(n, num, den, ranks, chosen, buckets), SENT)
    shared = context.broadcast(filters(probes, buckets, slice_bits(4 * grams_all, filter_bits, buckets), _held_twice, ("shared",))[0])
    rows = texts.mapInArrow(_shared_places(n, num, den, ranks, chosen, shared), PLACES)
    rows = kept(rows.join(sets.select("doc_id", "set_id", "component"), ["doc_id", "set_id"]), "place-rows")
    mixed = rows.groupBy("place").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("place")
    between = kept(rows.join(mixed, "place"), "mixed-places")
    consumed(rows)
    return between


def _pairs_between(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of sets in different components that could link, by a shared place among their first ones."""
    # The smaller set of a pair needs fewer places than the larger one.
    fewer = F.col("n") - F.ceil(F.col("n") * (2 * num) / F.lit(num + den)) + 1
    b = rows.where(F.col("at") < fewer).select(
        "place", F.col("component").alias("b_component"), F.col("set_id").alias("b"), F.col("doc_id").alias("b_doc"),
        F.col("n").alias("b_n"), F.col("at").alias("b_at"))
    groups = b.groupBy("place", "b_component").agg(
        F.min("b_n").alias("least"), F.max("b_n").alias("most"), F.max(F.col("b_n") - F.col("b_at")).alias("left"))
    a = rows.select("place", "component", F.col("set_id").alias("a"), F.col("doc_id").alias("a_doc"), F.col("n").alias("a_n"), F.col("at").alias("a_at"))
    wide = a.join(groups, "place").where(
        (F.col("component") != F.col("b_component")) & (F.col("least") <= F.col("a_n")) & (F.col("most") * den >= F.col("a_n") * num)
        & (F.least(F.col("a_n") - F.col("a_at"), F.col("left")) * (num + den) >= (F.col("a_n") + F.greatest("least", F.ceil(F.col("a_n") * num / F.lit(den)))) * num))
    return wide.select("place", "b_component", "a", "a_doc", "a_n", "a_at").join(b, ["place", "b_component"]).where(
        (F.struct("b_n", "b") < F.struct(F.col("a_n"), F.col("a"))) & (F.col("b_n") * den >= F.col("a_n") * num)
        & (F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at")) * (num + den) >= (F.col("a_n") + F.col("b_n")) * num)
    ).select("a", "a_doc", "a_n", "b", "b_doc", "b_n").distinct()


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, doc_id: str = "doc_id", text: str = "text",
                    bucket_bytes: int = BUCKET_BYTES, filter_bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; texts link when den * |common| >= num * |united|."""
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    scanned = kept(texts.mapInArrow(_signatures(n), SCAN), "signatures")
    ranks = spark.sparkContext.broadcast(_sketch(scanned))
    rows = scanned.where("slice IS NULL")
    sets = kept(rows.where("n > 0").groupBy("set_id", "n").agg(
        F.min("doc_id").alias("doc_id"), F.first("keys").alias("keys")).where("doc_id IS NOT NULL"), "sets")

    hubs = kept(_hub_pairs(sets, num, den), "hub-pairs")
    links = kept(_links(texts, hubs, n, num, den), "hub-links")
    grouped = components(links).select(F.col("node").alias("set_id"), "component")
    placed = kept(sets.join(grouped, "set_id", "left").select(
        "set_id", "doc_id", "n", F.coalesce("component", "set_id").alias("component")), "placed-sets")

    consumed(hubs, links, sets)
    places = _place_rows(texts, placed, n, num, den, ranks, bucket_bytes, filter_bits)
    pairs = kept(_pairs_between(places, num, den), "pairs")
    more = kept(_links(texts, pairs, n, num, den), "links")
    consumed(places, pairs)

    # Links of the second step join components of the first.
    between = more.join(placed.select(F.col("set_id").alias("u"), F.col("component").alias("a")), "u").join(
        placed.select(F.col("set_id").alias("v"), F.col("component").alias("b")), "v").select("a", "b")
    joined = components(between, "a", "b").select(F.col("node").alias("component"), F.col("component").alias("joined"))
    final = placed.join(joined, "component", "left").select("set_id", "doc_id", F.coalesce("joined", "component").alias("component"))
    least = final.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = final.join(least, "component").select("set_id", "component_id")
    return rows.select("doc_id", "n", F.when(F.col("n") > 0, F.col("set_id")).alias("set_id")).join(named, "set_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"), n=4, num=85)


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1) LEFT JOIN sizes USING (doc_id)
"""
