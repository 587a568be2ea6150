r"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, turn after turn::

    <s>[INST]role[/INST]text</s>

Control strings inside roles and texts are escaped reversibly: every ``<s> </s> [INST] [/INST]``, also one that already
holds backslashes after its bracket, gets one more backslash there. The rendered text is encoded once, with the
offsets of all tokens; the four control strings are tokens of their own. The sorted spans of assistant texts meet the
sorted token spans by binary search, which gives the loss mask over tokens. Digests are read back from what was
made: turns by parsing the rendered text, the text under the loss from the offsets of masked tokens.

Rows of a conversation are ordered by turn, then role and text, so ties and repeated rows are kept in a defined
order. Null roles and texts are empty, a null turn sorts first, a null conversation id is a conversation of its own. An
empty table gives what the extra rows give. Other columns are ignored. One conversation is held in memory at a
time; conversations stream through sorted partitions.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer, processors

from tidemark.llm.arrow import tasks

BEGIN, HEAD, HEAD_END, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = re.compile(r"([<\[])(\\*)(/?(?:s>|INST\]))")
ESCAPED = re.compile(r"([<\[])\\(\\*)(/?(?:s>|INST\]))")
TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)

_BUILT: dict[int, Tokenizer] = {}


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def render(turns: list[tuple[str, str]], learned: str = "assistant") -> tuple[str, np.ndarray]:
    """The rendered conversation and the sorted (start, end) spans of the texts to learn from."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = BEGIN + HEAD + escape(role) + HEAD_END, escape(text)
        start = at + len(head)
        if role == learned:
            spans.append((start, start + len(body)))
        out += (head, body, END)
        at = start + len(body) + len(END)
    return "".join(out), np.array(spans, np.int64).reshape(-1, 2)


def parse(rendered: str) -> list[tuple[str, str]]:
    return [(unescape(role), unescape(text)) for role, text in TURN.findall(rendered)]


def load(file: bytes) -> Tokenizer:
    key = hash(file)
    if key not in _BUILT:
        tokenizer = Tokenizer.from_buffer(file)
        tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
        tokenizer.add_tokens([AddedToken(x, normalized=False) for x in (BEGIN, HEAD, HEAD_END, END)])
        tokenizer.encode_special_tokens = True
        _BUILT[key] = tokenizer
    return _BUILT[key]


def loss_mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """For every token whether it overlaps a span; both sorted, found by binary search."""
    mask = np.zeros(len(offsets), bool)
    if len(offsets):
        first = np.searchsorted(offsets[:, 1], spans[:, 0], side="right")
        last = np.searchsorted(offsets[:, 0], spans[:, 1], side="left")
        for a, b, (low, high) in zip(first, last, spans):
            if low < high:
                mask[a:b] = True
    return mask


def masked_text(rendered: str, offsets: np.ndarray, mask: np.ndarray) -> list[str]:
    """The texts under the mask, unescaped, one for each run of masked tokens."""
    out, low = [], 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    for low, high in edges.reshape(-1, 2):
        out.append(unescape(rendered[offsets[low, 0] : offsets[high - 1, 1]]))
    return out


def encode(tokenizer: Tokenizer, turns: list[tuple[str, str]]) -> tuple[str, list[int], np.ndarray, np.ndarray]:
    """Rendered text, token ids, token offsets in characters, loss mask."""
    rendered, spans = render(turns)
    encoded = tokenizer.encode(rendered, add_special_tokens=False)
    offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
    return rendered, encoded.ids, offsets, loss_mask(offsets, spans)


SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, n_loss_tokens long"
OUTPUT = ", formatted string, ids array<int>, loss_mask array<boolean>"


def _format(shared, with_output: bool):
    def one(tokenizer: Tokenizer, conv, turns: list[tuple[str, str]]) -> tuple:
        rendered, ids, offsets, mask = encode(tokenizer, turns)
        back, loss = parse(rendered), masked_text(rendered, offsets, mask)
        seen = hashlib.sha256()
        for role, text in back:
            seen.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        learned = "".join(loss)
        row = (conv, len(back), seen.hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(rendered),
               len(ids), int(mask.sum()))
        return row + (rendered, ids, mask.tolist()) if with_output else row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, started, conv, turns = load(shared.value), False, None, []
        names = [x.split()[0] for x in (SCHEMA + OUTPUT * with_output).split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(),
                 pa.string(), pa.list_(pa.int32()), pa.list_(pa.bool_())]

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names)

        for batch in batches:
            rows = []
            for key, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if started and key != conv:
                    rows.append(one(tokenizer, conv, turns))
                    turns = []
                started, conv = True, key
                turns.append((role, text))
            if rows:
                yield table(rows)
        if started:
            yield table([one(tokenizer, conv, turns)])

    return run


def format_conversations(rows: DataFrame, tokenizer_file: bytes, with_output: bool = False) -> DataFrame:
    """One row per conversation; ``with_output`` adds the rendered text, the token ids and the loss mask."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer_file)
    ordered = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).repartition(tasks(spark), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_format(shared, with_output), SCHEMA + OUTPUT * with_output)


PROBE = "</s>[INST] ok [/INST]"


def query(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        file = f.read()
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return format_conversations(rows.unionByName(probe), file).drop("n_tokens", "n_loss_tokens")


SQL = r"""
WITH turns AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
  SELECT *, regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g') AS safe_role,
    regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g') AS safe_text FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<s>[INST]' || safe_role || '[/INST]' || safe_text || '</s>')) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""
