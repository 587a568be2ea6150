"""Byte-level BPE: encoding with the tiktoken library by a local rank file, and raw-byte decoding.

The rank file is read once on the driver (a fixed vocabulary of under a megabyte) and travels as a Spark
broadcast, so executors need no copy of it. Long texts are cut before the regular expression sees them,
only at *safe boundaries*: between a character that is no white space and a blank, tab or line break. No
match of the pattern spans such a place and no look-ahead reaches across it, so the ids are those of the
whole text.

Null texts count as empty; empty texts have no ids; repeated rows are encoded one by one; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.llm.arrow import lists, quoted, settle, text_chunks

# Characters at least between two cuts of a long text.
PIECE = 1 << 16
# Bytes of text, about, whose results are handed on at once.
OUTPUT = 1 << 20
SAFE = re.compile(r"(?<=[^\s\x1c-\x1f\x85])(?=[ \t\n\r])")

_BUILT: dict[str, tuple] = {}


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def build(ranks: bytes, pattern: str) -> tuple[tiktoken.Encoding, list[bytes], list[str]]:
    """The encoding, each id's bytes and each id as decimal text; made once per task."""
    key = hashlib.sha256(ranks + pattern.encode()).hexdigest()
    if key not in _BUILT:
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
        size = max(table.values(), default=-1) + 1
        raw = [b""] * size
        for token, i in table.items():
            raw[i] = token
        encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        _BUILT[key] = encoding, raw, [str(i) for i in range(size)]
    return _BUILT[key]


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """Parts of a long text whose ids are, one after the other, the ids of the whole text."""
    low = 0
    while len(text) - low > size:
        cut = SAFE.search(text, low + size)
        if cut is None:
            break
        yield text[low : cut.start()]
        low = cut.start()
    yield text[low:]


def encode(encoding: tiktoken.Encoding, text: str, size: int = PIECE) -> list[int]:
    if len(text) <= size:
        return encoding.encode_ordinary(text)
    return [i for part in pieces(text, size) for i in encoding.encode_ordinary(part)]


def _rows(shared, pattern: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, raw, decimal = build(shared.value, pattern)
        for rows, data, offsets in text_chunks(batches, "text", OUTPUT):
            body, at = data.tobytes(), offsets.tolist()
            flat, counts, id_sums, text_sums = array("i"), [], [], []
            for low, high in zip(at, at[1:]):
                encoded = encode(encoding, body[low:high].decode())
                counts.append(len(encoded))
                id_sums.append(hashlib.sha256(" ".join([decimal[i] for i in encoded]).encode()).hexdigest())
                text_sums.append(hashlib.sha256(b"".join([raw[i] for i in encoded])).hexdigest())
                if with_ids:
                    flat.extend(encoded)
            columns = [rows.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_sums, pa.string()), pa.array(text_sums, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(lists(np.frombuffer(flat, np.int32), np.array(counts, np.int64), pa.int32()))
                names.append("ids")
            for name in rows.schema.names[2:]:
                columns.append(rows.column(name))
                names.append(name)
            yield pa.RecordBatch.from_arrays(columns, names)
        # A worker that goes on to other work needs no vocabulary.
        del encoding, raw, decimal
        _BUILT.clear()
        settle()

    return run


def encode_documents(docs: DataFrame, ranks: bytes, pattern: str, id_column: str = "doc_id", text: str = "text",
                     with_ids: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids of every text; then the columns in ``carry``.

    One pass, no shuffle: rows stay in the partitions of the scan. A task holds one batch of texts and the ids of about
    OUTPUT bytes of them, or of one longer text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    read = docs.select(quoted(id_column).cast("long").alias("doc_id"), quoted(text).cast("string").alias("text"), *map(quoted, carry))
    schema = StructType.fromDDL("doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
    return read.mapInArrow(_rows(shared, pattern, with_ids), StructType([*schema.fields, *read.schema.fields[2:]]))


def decode_documents(encoded: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """doc_id and the bytes of column ``ids``."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, raw, _ = build(shared.value, pattern)
        for batch in batches:
            for low in range(0, len(batch), 256):
                rows = batch.slice(low, 256)
                texts = [b"".join([raw[i] for i in row.as_py() or []]) for row in rows.column(1)]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(texts, pa.binary())], ["doc_id", "bytes"])
        settle()

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def query(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return encode_documents(spark.read.parquet(f"{folder}/documents.parquet"), ranks, public_tokenizers.PATTERN)
