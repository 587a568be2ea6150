"""The corpus pipeline: from documents to token ids, in five stages.

Each stage is written as Parquet and read again by the next, which works on all rows that are left. What goes:

1. documents whose language is rejected;
2. near duplicates (word 5-grams, similarity of 0.8 or more): of every group the document with the smallest id stays;
3. bytes that repeat a string of 50 bytes of a document with a smaller id. Bytes that no longer form a whole character go too,
   and documents of which nothing is left;
4. documents contaminated by the benchmark;
5. nothing: texts become token ids; language and source come along.

A stage that removes documents decides by text (1, 4) or by id (2); documents with a null id are never near duplicates. Each stage
takes an empty table, columns of any name, null and empty texts, repeated rows and texts of any length (never cut; a task holds a
multiple of the longest one, as its operator says), and all but the last return the columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, decontaminate, jaccard_join, language, suffix_dedup
from tidemark.llm.arrow import bucket_of, kept, without
from tidemark.session import ship_package


def text_key() -> Column:
    return F.xxhash64("text")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go, and with them null and empty texts; equal texts share their fate."""
    ship_package(spark)
    model = language.learn(docs, F.coalesce(bucket_of("doc_id", 4) != 2, F.lit(True)))
    known = language.identify(docs.select(text_key().alias("text_key"), "text"), model, doc_id="text_key")
    return without(docs, text_key(), known.where("rejected").select("doc_id"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the smallest id stays, of rows that share an id one; rows without an id stay."""
    ship_package(spark)
    groups = kept(jaccard_join.near_duplicates(docs.select("doc_id", "text"), n=5, num=80), "groups")
    gone = groups.where("component_id <> doc_id").select("doc_id")
    repeated = groups.groupBy("doc_id").count().where("count > 1")
    if repeated.limit(1).count():
        # Rows that share an id are one document: one of them stays.
        docs = without(docs.where("doc_id IS NOT NULL"), F.col("doc_id"), repeated.select("doc_id")).unionByName(
            docs.join(repeated.select("doc_id"), "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])).unionByName(
            docs.where("doc_id IS NULL"))
    return without(docs, F.col("doc_id"), gone)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated bytes go, and documents of which nothing is left; texts that repeat nothing stay as they are, empty ones too."""
    ship_package(spark)
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    cut = suffix_dedup.remove_repeats(docs, carry=others, as_text=True)
    made = {"text": F.col("whole_text"), "n_chars": F.length("whole_text").cast("long")}
    return cut.where("n_removed = 0 OR whole_text <> ''").select(*(
        made[c].cast(docs.schema[c].dataType).alias(c) if c in made else F.col("carry")[c].alias(c) for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go; equal texts share their fate, null and empty texts stay."""
    ship_package(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_contamination(docs.select(text_key().alias("text_key"), "text"), benchmark, doc_id="text_key")
    return without(docs, text_key(), found.where("contaminated").select("doc_id"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row becomes its token ids, null texts none; repeated rows are encoded each."""
    ship_package(spark)
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN, with_ids=True, carry=("lang", "source"))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("contamination", drop_contaminated),
    ("tokens", encode),
]

# Learned language models, hashes and token ids are beyond SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
