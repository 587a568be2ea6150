"""The operators as queries, and their SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    block_dedup,
    byte_bpe,
    chat,
    decontaminate,
    fill_middle,
    filter_audit,
    importance,
    jaccard_join,
    language,
    pitman_yor,
    sharding,
    suffix_dedup,
    top_k,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_importance": importance.query,
    "op2_jaccard_join": jaccard_join.query,
    "op3_decontaminate": decontaminate.query,
    "op4_exact_top_k": top_k.query,
    "op5_language_id": language.query,
    "op6_sharding": sharding.query,
    "op7_byte_bpe": byte_bpe.query,
    "op8_suffix_dedup": suffix_dedup.query,
    "op9_chat_format": chat.query,
    "op10_pitman_yor": pitman_yor.query,
    "op11_fill_middle": fill_middle.query,
    "op12_filter_audit": filter_audit.query,
    "op13_block_dedup": block_dedup.query,
}

SQL: dict[str, str] = {
    "op2_jaccard_join": jaccard_join.SQL,
    "op3_decontaminate": decontaminate.SQL,
    "op4_exact_top_k": top_k.SQL,
    "op9_chat_format": chat.SQL,
    "op11_fill_middle": fill_middle.SQL,
    "op12_filter_audit": filter_audit.SQL,
    "op13_block_dedup": block_dedup.SQL,
}
