"""Helpers shared by the operators: Arrow columns as numpy arrays, bounded chunks, hand-over tables."""

from __future__ import annotations

import ctypes.util
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

CHUNK = 2 << 20


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes, of one row at least."""
    n, low = len(offsets) - 1, 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + size, side="right")) - 1
        high = min(n, max(high, low + 1))
        yield low, high
        low = high


def settle() -> None:
    """Hand memory that a finished task freed back to the system; idle workers would keep it otherwise."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.util.find_library("c")
    trim = getattr(ctypes.CDLL(libc), "malloc_trim", None) if libc else None
    if trim is not None:
        trim(0)


def settled(function):
    """A function of whole groups that settles after each."""
    def run(table: pa.Table) -> pa.Table:
        try:
            return function(table)
        finally:
            settle()

    return run


def text_chunks(batches: Iterator[pa.RecordBatch], text: str, size: int = CHUNK):
    """(batch rows as a slice, bytes, offsets) of every chunk of every batch."""
    for batch in batches:
        data, offsets = text_buffer(batch.column(text))
        for low, high in chunks(offsets, size):
            yield batch.slice(low, high - low), data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
    settle()


def binaries(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column out of flat values and the length of each row's list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def kept(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read back: lineage is cut and executors may be lost."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.kept_path = path
    return table


def consumed(*tables: DataFrame) -> None:
    """Give back the space of hand-over tables that nothing will read again."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.kept_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(column: str, divisor: int):
    """crc32 of the id as text, modulo the divisor; null ids have none."""
    return F.crc32(F.col(column).cast("string")) % divisor


FILTER_BITS = 27


def bitmap(values: DataFrame, column: str) -> np.ndarray:
    """A bitmap of whole numbers, 16 bits for each up to a fixed 2**FILTER_BITS bits: no number is ever missed."""
    bits = min(FILTER_BITS, max(15, (16 * values.count()).bit_length()))
    place = F.pmod(F.col(column), F.lit(1 << bits)) + 1
    found = values.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect()
    out = np.zeros((1 << bits) // 8, np.uint8)
    for bucket, piece in found:
        if bucket is not None:
            out[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(piece, np.uint8)
    return out


def in_bitmap(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    place = values & (len(bits) * 8 - 1)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def rows_in_bitmap(shared, column: str, inside: bool):
    """Keeps the rows whose number is (or is not) in a broadcast bitmap; nulls are not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(column)
            hit = in_bitmap(shared.value, own.fill_null(0).to_numpy()) & own.is_valid().to_numpy(zero_copy_only=False)
            chosen = batch.filter(pa.array(hit == inside))
            if len(chosen):
                yield chosen

    return run


def quoted(name: str) -> Column:
    """The column of that very name, also if it holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def chained(*steps):
    """Functions of batches, one after the other in one worker."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps:
            batches = step(batches)
        return batches

    return run


def without(rows: DataFrame, key: Column, removed: DataFrame, once: bool = False) -> DataFrame:
    """The rows whose key is not among the numbers in the one column of ``removed``; null keys stay.

    Only rows that a bitmap of fixed size can't rule out are shuffled. ``once``: of rows with an equal key among
    those, one stays.
    """
    columns = rows.columns
    removed = removed.toDF("removed_key").where("removed_key IS NOT NULL").distinct()
    shared = rows.sparkSession.sparkContext.broadcast(bitmap(removed, "removed_key"))
    keyed = rows.select(key.cast("long").alias("row_key"), F.struct(*map(quoted, columns)).alias("row"))
    rest = keyed.mapInArrow(rows_in_bitmap(shared, "row_key", False), keyed.schema)
    maybe = keyed.mapInArrow(rows_in_bitmap(shared, "row_key", True), keyed.schema)
    stay = maybe.join(removed, F.col("row_key") == F.col("removed_key"), "left_anti")
    if once:
        stay = stay.dropDuplicates(["row_key"])
    return rest.unionByName(stay).select("row.*")
