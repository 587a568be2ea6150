r"""How filters interact: for every order of five filters, what each step removes, and what it costs.

Each document gets the set of its failures as bits. Four failures are expressions over the text. The fifth, *identical to a
document of a smaller id*, is found by an existential self-join: the left-semi join of the documents with themselves on hash, exact
text and smaller id marks those that have such a copy. The ids so marked are united with the ids of the other failures, and
the bits of every document are aggregated into one combination. All figures follow from the number of documents per part
and combination, at most 32 * 4 rows a part; no order of filters is run.

The join and skew. Only texts whose hash occurs under two ids take part (their hashes are found by an aggregation of two numbers
a row; a bitmap of bounded size keeps most other texts out of the shuffle). Of the right side only the least id of every distinct text
matters, so it is aggregated to that before the join, one row a task and text at first. Copies of a text that has more than SALT_ROWS
of them are salted: the one row on the right is repeated for every salt.

Null texts count as empty, and empty texts as identical to each other; a null language is the part of the empty string. A
document with a null id is never a copy and makes no other one a copy; it counts in all other figures. Each of repeated rows counts; rows
that share an id are not copies of each other. A document is good or toxic if any row of ``labels`` with its id says so; without
one it is neither. An empty table gives an empty result; other columns are ignored. Texts of any length are handled whole; a
task holds one text and its words at a time. Two texts that share one id also share their combination if their 64-bit hashes are equal.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrow import bitmap, kept, rows_in_bitmap

LETTERS = "ABCDE"
COPY = 1 << LETTERS.index("E")
SALT_ROWS = 20_000


def text_failures(text: Column) -> Column:
    """The bits of filters A to D for one text."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, points = F.size(words), F.length(text)
    capitals = points - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = [n < 200, 100 * F.size(F.array_distinct(words)) < 50 * n, 100 * capitals > 3 * points, text.rlike(r"[#$%&*|]")]
    out = F.lit(0)
    for i, failed in enumerate(fails):
        out = out + F.when(failed, 1 << i).otherwise(0)
    return out


def copies(texts: DataFrame, salt_rows: int = SALT_ROWS) -> DataFrame:
    """doc_id, text_key, part of every row whose text also stands under a smaller id.

    ``texts`` has doc_id, text_key (a hash of the text), part and text.
    """
    spark = texts.sparkSession
    own = texts.where("doc_id IS NOT NULL")
    keys = kept(own.groupBy("text_key").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
                .where("low < high").select("text_key", F.ceil(F.col("rows") / salt_rows).cast("int").alias("salts")), "repeated-texts")
    shared = spark.sparkContext.broadcast(bitmap(keys.select("text_key"), "text_key"))
    maybe = own.mapInArrow(rows_in_bitmap(shared, "text_key", True), own.schema)
    first = maybe.groupBy("text_key", "text").agg(F.min("doc_id").alias("first_id")).join(keys, "text_key").select(
        "text_key", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("text").alias("first_text"), "first_id")
    left = maybe.join(keys, "text_key").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int"))
    first = first.withColumnRenamed("text_key", "first_key").withColumnRenamed("salt", "first_salt")
    smaller = (F.col("text_key") == F.col("first_key")) & (F.col("salt") == F.col("first_salt")) & (
        F.col("text") == F.col("first_text")) & (F.col("first_id") < F.col("doc_id"))
    return left.join(first, smaller, "left_semi").select("doc_id", "text_key", "part")


def combinations(docs: DataFrame, labels: DataFrame, salt_rows: int = SALT_ROWS) -> DataFrame:
    """part, bits, good, toxic and the number of documents of every combination that occurs."""
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(body).alias("text_key"),
                        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), body.alias("text"))
    failing = texts.select("doc_id", "text_key", "part", text_failures(F.col("text")).alias("bits"), F.lit(1).alias("documents"))
    copied = copies(texts, salt_rows).select("doc_id", "text_key", "part", F.lit(COPY).alias("bits"), F.lit(0).alias("documents"))
    each = failing.unionByName(copied).groupBy("doc_id", "text_key", "part").agg(
        F.bit_or("bits").alias("bits"), F.sum("documents").alias("documents"))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    marks = marks.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.bool_or("good").alias("good"), F.bool_or("toxic").alias("toxic"))
    return each.join(marks, "doc_id", "left").groupBy(
        "part", "bits", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")).agg(
        F.sum("documents").alias("documents"))


def audit(docs: DataFrame, labels: DataFrame, salt_rows: int = SALT_ROWS) -> DataFrame:
    """One row per part, order of filters and step."""
    combos = combinations(docs, labels, salt_rows)
    # What a step does depends on the set of filters before it and on its own filter, not on their order.
    places = [(before, f) for before in range(1 << len(LETTERS)) for f in range(len(LETTERS)) if not before >> f & 1]
    place = F.explode(F.array(*(F.struct(F.lit(b).alias("before"), F.lit(f).alias("f"), F.lit(1 << f).alias("own")) for b, f in places))).alias("place")
    fails = F.col("bits").bitwiseAND(F.col("own")) > 0
    earlier = F.col("bits").bitwiseAND(F.col("before")) > 0

    def count(chosen: Column) -> Column:
        return F.sum(F.when(chosen, F.col("documents")).otherwise(0)).cast("long")

    steps = combos.select("*", place).select("*", "place.*").groupBy("part", "before", "f").agg(
        count(~fails & ~earlier).alias("kept"), count(fails & ~earlier).alias("removed"), count(fails & earlier).alias("redundant"),
        count(F.col("bits") == F.col("own")).alias("unique_fails"), count(fails & ~earlier & F.col("good")).alias("good_lost"),
        count(fails & ~earlier & F.col("toxic")).alias("toxic_lost"))
    # Each set of earlier filters is passed by as many orders as it and the later filters can be arranged in.
    ways = F.element_at(F.array(*(F.lit(factorial(i) * factorial(len(LETTERS) - 1 - i)) for i in range(len(LETTERS)))), F.bit_count("before") + 1)
    shapley = steps.groupBy("part", F.col("f").alias("of")).agg(F.sum(F.col("removed") * ways).cast("long").alias("shapley"))
    orders = [("".join(order), i + 1, sum(1 << LETTERS.index(x) for x in order[:i]), LETTERS.index(order[i]))
              for order in permutations(LETTERS) for i in range(len(LETTERS))]
    grid = docs.sparkSession.createDataFrame(orders, "filter_order string, step int, before int, f int")
    return steps.join(grid, ["before", "f"]).join(shapley.withColumnRenamed("part", "of_part"), (F.col("part") == F.col("of_part")) & (F.col("f") == F.col("of"))).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return audit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (
  SELECT *, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'),
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1) AS good,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1) AS toxic FROM d),
c AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
orders(o) AS (
  SELECT '' UNION ALL SELECT o || x FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE length(o) < 5 AND NOT contains(o, x)),
steps AS (
  SELECT o, step, instr('ABCDE', o[step]) AS own, list_transform(range(1, step), lambda i: instr('ABCDE', o[i])) AS before
  FROM (SELECT o, unnest(range(1, 6)) AS step FROM orders WHERE length(o) = 5)),
marked AS (
  SELECT part, o, step, own, n, good, toxic, fails, fails[own] AS hit, coalesce(list_bool_or(list_transform(before, lambda i: fails[i])), false) AS gone
  FROM steps, c),
out AS (
  SELECT part, o AS filter_order, CAST(step AS INT) AS step, own, CAST(coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (hit AND NOT gone), 0) AS BIGINT) AS removed, CAST(coalesce(sum(n) FILTER (hit AND gone), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (hit AND len(list_filter(fails, lambda x: x)) = 1), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(n) FILTER (hit AND NOT gone AND good), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(n) FILTER (hit AND NOT gone AND toxic), 0) AS BIGINT) AS toxic_lost
  FROM marked GROUP BY ALL)
SELECT * EXCLUDE own, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM out
"""
