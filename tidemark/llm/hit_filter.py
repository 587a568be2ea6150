"""Which hashes do several documents hold? Hashes meet by bucket, 4 bytes each; the answer is a Bloom filter of bounded size.

A hash is sent once a chunk, as 30 bits with two flags. Thirty bits are enough within a bucket: a wrong hit only costs work. Every
bucket fills its own slice of the filter, so nothing but slices travels to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.arrow import settled
from tidemark.llm.spans import from_planes, planes, runs
from tidemark.llm.words import ODD, mix

LOW30 = np.uint64((1 << 30) - 1)
SENT = "bucket long, rows int, packed binary"


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """The top half of the hash, scaled to the number of buckets."""
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, low, high) of every run of a sorted column."""
    cuts = runs(bucket)
    yield from zip(bucket[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(bucket)])


def codes(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 30 bits of every hash; the lowest two bits are free for flags."""
    return (bucket_of(h, buckets) << np.uint64(32)) | ((h & LOW30) << np.uint64(2))


def sent(code: np.ndarray) -> pa.RecordBatch:
    """Sorted codes with their flags, packed by bucket."""
    own, counts, packed = [], [], []
    for bucket, low, high in by_bucket(code >> np.uint64(32)):
        own.append(bucket)
        counts.append(high - low)
        packed.append(planes(code[low:high].astype(np.uint32)))
    return pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(counts, pa.int32()), pa.array(packed, pa.binary())],
                                      ["bucket", "rows", "packed"])


def _places(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """Three places of a 30-bit hash in its bucket's slice."""
    x = mix(h * ODD + ODD)
    return [(((x >> np.uint64(21 * i)) & np.uint64((1 << 21) - 1)) * np.uint64(bits) >> np.uint64(21)).astype(np.int64) for i in range(3)]


def _slices(bits: int, choose: Callable, names: tuple[str, ...]):
    def run(table: pa.Table) -> pa.Table:
        own = np.concatenate([from_planes(p, [np.uint32], [n])[0] for p, n in zip(table["packed"].to_pylist(), table["rows"].to_pylist())])
        own = np.sort(own)
        h, flags = own >> np.uint32(2), own & np.uint32(3)
        new = runs(h)
        out = {"bucket": table["bucket"][:1].cast(pa.int64())}
        for name, chosen in zip(names, choose(flags, new, np.diff(np.append(new, len(h))))):
            filled = np.zeros(bits, bool)
            for place in _places(h[new][chosen].astype(np.uint64), bits):
                filled[place] = True
            out[name] = pa.array([np.packbits(filled, bitorder="little").tobytes() if chosen.any() else None], pa.binary())
        return pa.table(out)

    return run


class Filter:
    """Slices of the filter, one for each bucket."""

    def __init__(self, buckets: int, bits: int):
        self.buckets, self.bits = buckets, bits
        self.cells = np.zeros(0, np.uint8)

    def put(self, bucket: int, part: bytes) -> None:
        if not len(self.cells):
            self.cells = np.zeros(self.buckets * self.bits // 8, np.uint8)
        self.cells[bucket * self.bits // 8 : (bucket + 1) * self.bits // 8] = np.frombuffer(part, np.uint8)

    def holds(self, h: np.ndarray) -> np.ndarray:
        found = np.full(len(h), len(self.cells) > 0)
        if len(self.cells):
            base = bucket_of(h, self.buckets).astype(np.int64) * self.bits
            for place in _places(h & LOW30, self.bits):
                place += base
                found &= (self.cells[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        return found


def slice_bits(wanted: int, most: int, buckets: int) -> int:
    """Bits of a slice, so that all together are about ``wanted``, ``most`` at the most."""
    return max(64, min(wanted, most) // buckets // 8 * 8)


def filters(probes: DataFrame, buckets: int, bits: int, choose: Callable, names: tuple[str, ...]) -> list[Filter]:
    """One filter for each name. ``choose`` takes the flags of a bucket's sorted hashes, where each hash begins and how
    often it was sent, and returns for each name which hashes to put in."""
    found = probes.groupBy("bucket").applyInArrow(
        settled(_slices(bits, choose, names)), "bucket long, " + ", ".join(f"{x} binary" for x in names))
    out = [Filter(buckets, bits) for _ in names]
    for bucket, *parts in found.toLocalIterator():
        for one, part in zip(out, parts):
            if part is not None:
                one.put(bucket, part)
    return out
