"""Shards of nearly equal bytes by sampled splitters; DataFrame functions only.

The order of records is (hash of the text, id), so equal texts lie side by side. A size-weighted sample of these
keys gives the quantile boundaries of ranges; a range that holds more rows than ``range_rows`` is subdivided by a hash
of the id, so that no task sorts an unbounded group, however many records share one key. Running sums of bytes
inside the parts, on top of the sums of the parts before, give every record its place in the whole order, and with it
its shard: every shard takes its share of the bytes up to half a record on either side.

Law ``bytes``. Null texts have no bytes and the checksum of the empty text; null ids sort first; repeated rows are
placed one by one; an empty table gives an empty result; other columns are ignored. Records of equal id and text
are interchangeable, so a repeated task gives the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.arrow import kept

RANGES_PER_SHARD = 8
SAMPLES_PER_RANGE = 8
RANGE_ROWS = 1_000_000


def _records(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        (F.octet_length(body) + F.lit(8)).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(body).alias("text_key"),
    )


def _splitters(records: DataFrame, total: int, ranges: int) -> list[tuple[int, int]]:
    """Quantiles of a size-weighted sample of the keys; the sample has about SAMPLES_PER_RANGE * ranges rows.

    A record is drawn with probability proportional to its size. The draw is a hash of the record, so it is
    the same at every attempt.
    """
    wanted = ranges * SAMPLES_PER_RANGE
    draw = F.pmod(F.xxhash64("doc_id", "text_key", F.lit("draw")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    id_or_first = F.coalesce("doc_id", F.lit(-(1 << 63)))
    drawn = sorted(
        (r[0], r[1])
        for r in records.where(draw < F.col("size") * F.lit(wanted / max(total, 1))).select("text_key", id_or_first).collect()
    )
    return sorted({drawn[len(drawn) * i // ranges] for i in range(1, ranges)}) if drawn else []


def _range_of(bounds: list[tuple[int, int]], low: int = 0) -> Column:
    """The number of boundaries at or below a record's key, as a balanced decision tree."""
    if not bounds:
        return F.lit(low)
    middle = len(bounds) // 2
    text_key, doc_id = bounds[middle]
    before = (F.col("text_key") < text_key) | (
        (F.col("text_key") == text_key) & (F.coalesce("doc_id", F.lit(-(1 << 63))) < doc_id))
    return F.when(before, _range_of(bounds[:middle], low)).otherwise(_range_of(bounds[middle + 1 :], low + middle + 1))


def shard_by_bytes(docs: DataFrame, shards: int = 24, id_column: str = "doc_id", text: str = "text",
                   ranges: int | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per row of ``docs``."""
    records = kept(_records(docs, id_column, text), "shard-records")
    total = records.agg(F.sum("size")).first()[0] or 0
    ranges = ranges or shards * RANGES_PER_SHARD
    records = records.withColumn("range", _range_of(_splitters(records, total, ranges)))

    # At most ``ranges`` rows, so safe to broadcast.
    parts = records.groupBy("range").agg(F.ceil(F.count(F.lit(1)) / range_rows).alias("parts"))
    records = records.join(F.broadcast(parts), "range").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.col("parts")))

    inside = Window.partitionBy("range", "part").orderBy("text_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = kept(
        records.select("doc_id", "size", "text_crc32", "range", "part",
                       F.sum("size").over(inside).alias("bytes"), F.count(F.lit(1)).over(inside).alias("rank")),
        "shard-places")

    # One row per part: ranges plus rows / range_rows of them, so safe to broadcast.
    earlier = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("range", "part").agg(F.max("bytes").alias("b"), F.max("rank").alias("r")).select(
        "range", "part", F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("r").over(earlier), F.lit(0)).alias("rank_before"))
    middle = 2 * (F.col("bytes_before") + F.col("bytes")) - F.col("size")
    ranked = placed.join(F.broadcast(before), ["range", "part"]).select(
        "doc_id", "size", "text_crc32", (F.col("rank_before") + F.col("rank") - 1).alias("rank"),
        F.least(F.lit(shards - 1), F.floor(middle * F.lit(shards) / F.lit(2 * max(total, 1)))).cast("int").alias("shard"))
    first = ranked.groupBy("shard").agg(F.min("rank").alias("first"))
    return ranked.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rank") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return shard_by_bytes(spark.read.parquet(f"{folder}/documents.parquet"))
