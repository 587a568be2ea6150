"""Exact top-k inner products by branch and bound over a columnar layout.

Candidates are dealt into chunks by a hash of the id; every query meets every chunk, a block of queries at a
time. Inside a chunk the vectors lie column by column. Scores grow dimension block by dimension block; what a candidate
can still gain is at most |rest of the query| * |rest of the candidate|, so candidates that cannot reach the k-th best
score any more are dropped and the survivors compacted before the next block. Chunk winners meet in one
last ranking of k rows per query and chunk.

Components x become floor(256 * x). Vectors that are null or hold a null or non-finite component, and rows without
id, take no part; shorter vectors count as padded with zeros; equal scores rank by smaller id; rows other than the
query's own id are candidates, repeated rows each for itself; an empty table gives an empty result; other columns are
ignored. Scores are exact integers as long as |256 * x| stays below 2**24; larger components go through 64-bit
integers without bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.arrow import kept, tasks

CHUNK_ROWS = 65_536
DIMENSIONS = 16
CELLS = 2 << 20


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.concatenate([np.arange(n) for n in lengths] or [np.zeros(0, int)])] = flat
    return out


def best(queries: np.ndarray, own: np.ndarray, columns: np.ndarray, ids: np.ndarray, k: int, block: int = DIMENSIONS):
    """For each query the positions and scores of its k best candidates by (score, smaller id).

    ``columns`` is the chunk in vertical layout, dimension by candidate. ``own`` are the queries' ids.
    """
    width, n = columns.shape
    exact = max(np.abs(queries).max(initial=0), np.abs(columns).max(initial=0)) < 1 << 24
    edges = [*range(0, width, block), width]
    if exact:
        columns, queries = columns.astype(np.float64), queries.astype(np.float64)
        squares = np.array([(columns[a:] ** 2).sum(axis=0) for a in edges])
        rest_of = np.sqrt(squares)
        rest_of_query = np.sqrt(np.array([(queries[:, a:] ** 2).sum(axis=1) for a in edges]))
    first = queries[:, : edges[1]] @ columns[: edges[1]] if width else np.zeros((len(queries), n))
    for i, q in enumerate(queries):
        alive = np.flatnonzero(ids != own[i])
        score = first[i, alive]
        for step in range(1, len(edges) - 1):
            if exact and len(alive) > k:
                # The best so far, scored to the end, give the score to reach.
                ahead = np.argpartition(score, len(score) - k)[-k:]
                reach = (q @ columns[:, alive[ahead]]).min()
                hope = score + rest_of_query[step, i] * rest_of[step, alive]
                stay = hope * (1 + 1e-9) + 1e-6 >= reach
                alive, score = alive[stay], score[stay]
            low, high = edges[step], edges[step + 1]
            score = score + q[low:high] @ columns[low:high, alive]
        order = np.lexsort((ids[alive], -score))[:k]
        yield i, alive[order], score[order].astype(np.int64)


def _search(width: int, k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, parts, columns, ids = None, [], None, None
        for batch in batches:
            keys, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]) | (kinds[1:] != kinds[:-1])) + 1), len(keys)]
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                part = batch.slice(low, high - low)
                if keys[low] != chunk:
                    chunk, parts, columns = keys[low], [], None
                vec, numbers = part.column(2).to_numpy(), _matrix(part.column(3), width)
                if kinds[low] == 0:
                    parts.append((vec, numbers))
                    continue
                if not parts:
                    continue
                if columns is None:
                    ids = np.concatenate([p[0] for p in parts])
                    columns = np.ascontiguousarray(np.concatenate([p[1] for p in parts]).T)
                rows = max(1, CELLS // columns.shape[1])
                for a in range(0, len(vec), rows):
                    found = [(np.full(len(at), vec[a + i]), ids[at], score)
                             for i, at, score in best(numbers[a : a + rows], vec[a : a + rows], columns, ids, k)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*found)], schema=schema)

    return run


def top_k(vectors: DataFrame, query_rows, k: int = 5, id_column: str = "vec_id", vector: str = "embedding",
          chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of every row for which ``query_rows`` holds.

    ``query_rows`` is a condition over column ``vec_id``.
    """
    spark = vectors.sparkSession
    x = F.col(vector)
    usable = x.isNotNull() & F.col(id_column).isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    numbers = kept(
        vectors.where(F.coalesce(usable, F.lit(False))).select(
            F.col(id_column).cast("long").alias("vec_id"),
            F.transform(x, lambda v: F.floor(F.lit(256.0) * v.cast("double")).cast("long")).alias("numbers")), "vectors")
    rows, width = numbers.agg(F.count(F.lit(1)), F.max(F.size("numbers"))).first()
    chunks = max(-(-rows // chunk_rows), min(tasks(spark), -(-rows // 1024)), 1)
    candidates = numbers.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk"), F.lit(0).alias("kind"), "vec_id", "numbers")
    queries = numbers.where(query_rows).select(
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), F.lit(1).alias("kind"), "vec_id", "numbers")
    met = candidates.union(queries).repartition(chunks, "chunk").sortWithinPartitions("chunk", "kind", "vec_id")
    found = met.mapInArrow(_search(width or 0, k), "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{folder}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS numbers
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS (SELECT vec_id, unnest(numbers) AS n, unnest(range(len(numbers))) AS d FROM v),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.n * c.n) AS BIGINT) AS score
  FROM cells q JOIN cells c ON q.d = c.d AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY 1, 2)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
WHERE rank <= 5
"""
