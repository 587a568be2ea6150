r"""Fill-in-the-middle transformation by repeated-capture matching.

A text is a sequence of units (lines, by default). One ``fullmatch`` of ``(unit)*`` with the regex library keeps
every repetition of the group, so ``ends(1)`` holds the end of each unit: its length is the number n of units, and the two cuts
that part prefix, middle and suffix are looked up in it. The repetition is possessive: a unit once matched is never given back,
so the match is linear in the text.

Where to cut, and in which order the parts are written, is drawn from a hash of the seed and the document's id, so the
result doesn't depend on partitions, order or repeated runs.

Null texts count as empty; empty texts, and texts that hold a marker, stay as they are (form ``plain``). A null id is hashed as
no digits. Repeated rows and repeated ids are transformed row by row, rows of one id with the same draws; an empty table gives an empty
result; other columns are ignored. Whole texts are matched, however long: a task holds one batch's texts, their outputs and
16 bytes for every unit of one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrow import text_chunks

LINE = r"[^\n]*\n|[^\n]+"
MARKERS = ("<P>", "<S>", "<M>")
SEED = 7
PLAIN, PSM, SPM = "plain", "psm", "spm"
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def check_markers(markers: tuple[str, str, str]) -> None:
    """Markers must be told apart wherever they meet text or each other: none may begin inside another."""
    if len(set(markers)) != 3 or not all(markers):
        raise ValueError("three different markers are needed")
    for one in markers:
        for other in markers:
            tails = (one[i:] for i in range(0 if one != other else 1, len(one)))
            if any(other.startswith(tail) or tail.startswith(other) for tail in tails):
                raise ValueError(f"{other!r} can begin inside {one!r}")


def draws(seed: int, doc_id: int | None) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(text: str, units, drawn: list[int], markers: tuple[str, str, str] = MARKERS, rate: int = 100, spm: int = 50):
    """(n, form, prefix length, middle length, output) of one text; lengths are None where the form is plain.

    ``units`` is a compiled pattern whose first group is one unit, repeated over the whole text.
    """
    ends = units.fullmatch(text).ends(1)
    n = len(ends)
    if not text or any(m in text for m in markers) or drawn[2] % 100 >= rate:
        return n, PLAIN, None, None, text
    low, high = sorted((drawn[0] % (n + 1), drawn[1] % (n + 1)))
    a, b = (ends[low - 1] if low else 0), (ends[high - 1] if high else 0)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = markers
    if drawn[3] % 100 < spm:
        return n, SPM, a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, PSM, a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"


def compiled(unit: str):
    return regex.compile(f"(?:({unit}))*+")


def _rows(unit: str, seed: int, markers: tuple[str, str, str], rate: int, spm: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = compiled(unit)
        for rows, data, offsets in text_chunks(batches, "text"):
            raw = data.tobytes()
            out = [transform(raw[low:high].decode(), units, draws(seed, i), markers, rate, spm)
                   for i, low, high in zip(rows.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist())]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), *(pa.array(column, kind) for column, kind in zip(zip(*out), kinds))],
                [x.split()[0] for x in SCHEMA.split(", ")])

    return run


def fill_in_middle(docs: DataFrame, unit: str = LINE, seed: int = SEED, markers: tuple[str, str, str] = MARKERS, rate: int = 100,
                   spm: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the rearranged text of every row; one pass, no shuffle.

    ``rate`` percent of the texts are rearranged, ``spm`` percent of those with the suffix first. ``unit`` must cover
    every text and have no group of its own.
    """
    check_markers(markers)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        _rows(unit, seed, markers, rate, spm), SCHEMA)


def restored(output: str = "output", form: str = "form", markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that was rearranged, out of output and form alone."""
    p, s, m = (F.lit(x) for x in markers)
    whole = F.col(output)

    def after(marker: Column) -> Column:
        return F.instr(whole, marker) + F.length(marker)

    def part(begin: Column, end: Column) -> Column:
        return F.substr(whole, after(begin), F.instr(whole, end) - after(begin))

    middle = F.substr(whole, after(m))
    return F.when(F.col(form) == PSM, F.concat(part(p, s), middle, part(s, m))).when(
        F.col(form) == SPM, F.concat(part(p, m), middle, part(s, p))).otherwise(whole)


def query(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_in_middle(spark.read.parquet(f"{folder}/documents.parquet"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(), 256).alias("restored_sha256"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS c2,
    CAST('0x' || h[17:24] AS BIGINT) % 100 AS r, CAST('0x' || h[25:32] AS BIGINT) % 100 AS o FROM d),
parts AS (
  SELECT *, array_to_string(u[1 : least(c1, c2)], '') AS p, array_to_string(u[least(c1, c2) + 1 : greatest(c1, c2)], '') AS m,
    array_to_string(u[greatest(c1, c2) + 1 :], '') AS s,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r >= 100 THEN 'plain'
      WHEN o < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END)
    AS output_sha256, sha256(t) AS restored_sha256
FROM parts
"""
