"""Spans of documents, and packed numpy columns, as they travel between tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import lists
from tidemark.llm.words import mix


def planes(*columns: np.ndarray) -> bytes:
    """Columns one after the other, byte by byte of equal weight: high bytes that are all alike compress to nothing."""
    return b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns)


def from_planes(packed: bytes, kinds: list, counts: list[int]) -> list[np.ndarray]:
    """The columns of ``planes``, given the type and the length of each."""
    out, at = [], 0
    for kind, n in zip(kinds, counts):
        width = np.dtype(kind).itemsize
        flat = np.frombuffer(packed, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(flat.T).view(kind).reshape(n))
        at += n * width
    return out


def runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


def merged(doc: np.ndarray, key: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Maximal spans of every (doc, key)."""
    if not len(doc):
        return doc, key, start, stop
    order = np.lexsort((start, key, doc))
    doc, key, start, stop = doc[order], key[order], start[order], stop[order]
    other = np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])])
    # Ends so far within a document: documents are kept apart by a step larger than any text.
    step = np.cumsum(other) * np.int64(1 << 32)
    reach = np.maximum.accumulate(stop + step)
    new = other | np.concatenate([[True], (start + step)[1:] > reach[:-1]])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(doc) - 1)
    return doc[new], key[new], start[new], (reach - step)[last]


SPAN_KINDS = [np.int64, np.int64, np.int32, np.int32]


def pack_spans(doc, key, start, stop, owners: int) -> tuple[list[int], list[bytes]]:
    """Owners (buckets of documents) and the packed merged spans of each."""
    doc, key, start, stop = merged(*(np.asarray(x, np.int64) for x in (doc, key, start, stop)))
    owner = (mix(doc.view(np.uint64)) % np.uint64(owners)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    cuts = runs(owner[order]).tolist()
    packed = []
    for low, high in zip(cuts, [*cuts[1:], len(owner)]):
        own = order[low:high]
        packed.append(planes(doc[own], key[own], start[own].astype(np.int32), stop[own].astype(np.int32)))
    return owner[order][cuts].tolist(), packed


def unpack_spans(packed: list[bytes]) -> tuple[np.ndarray, ...]:
    parts = [from_planes(raw, SPAN_KINDS, [len(raw) // 24] * 4) for raw in packed]
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*parts)) if parts else tuple(np.zeros(0, np.int64) for _ in range(4))


DOC_SPANS = "doc_id long, text_key long, starts array<long>, stops array<long>"


def unite(table: pa.Table) -> pa.Table:
    """Of one owner's packed ``spans``: the maximal spans of each of its documents."""
    doc, key, start, stop = merged(*unpack_spans(table["spans"].to_pylist()))
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])])) if len(doc) else np.zeros(0, np.int64)
    counts = np.diff(np.append(new, len(doc)))
    return pa.table([pa.array(doc[new]), pa.array(key[new]), lists(start, counts, pa.int64()), lists(stop, counts, pa.int64())],
                    ["doc_id", "text_key", "starts", "stops"])


def ids_conflict(texts: DataFrame) -> bool:
    """Whether different texts share an id."""
    return bool(texts.groupBy("doc_id").agg(F.min("text_key").alias("a"), F.max("text_key").alias("b")).where("a <> b").limit(1).count())
