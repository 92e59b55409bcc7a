"""Exact top-k inner-product search by tiled matrix products.

Queries come in blocks of bounded size, which each task multiplies with tiles of its shard of vectors;
of each tile only ``k`` results for a query are selected, merged into the task's list, and the lists of
all tasks are merged in a tree.  Scores are integers and exact; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 4096
TILE = 2048
GROUPS = 16
LIMIT = 2.0**52


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, width)


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Products of integer-valued vectors: by floats while no sum can leave their exact range, else by integers."""
    most = np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * q.shape[1]
    if most < LIMIT:
        return q @ v.T
    return np.array([[int(x) for x in row] for row in q], dtype=object) @ np.array([[int(x) for x in row] for row in v], dtype=object).T


def _select(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest of a row, ties to smaller ids."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k])
    if len(ids) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, at = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        need = k - len(above)
        if len(at) > need:
            at = at[np.argpartition(ids[at], need - 1)[:need]]
        return np.concatenate([above, at])
    return np.arange(len(ids))


def search(block, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, queries = block.value
        width = queries.shape[1]
        best: list[tuple] = [(np.empty(0, np.int64), None)] * len(qids)
        for batch in batches:
            all_ids = batch.column("id").to_numpy()
            vectors = _matrix(batch.column("v"), width) if batch.num_rows else np.empty((0, width))
            for lo in range(0, len(all_ids), TILE):
                ids = all_ids[lo: lo + TILE]
                scores = _scores(queries, vectors[lo: lo + TILE])
                for n, qid in enumerate(qids):
                    row, own = scores[n], ids
                    other = ids != qid
                    if not other.all():
                        row, own = row[other], ids[other]
                    at = _select(own, row, k)
                    if best[n][1] is not None:
                        own, row = np.concatenate([best[n][0], own[at]]), np.concatenate([best[n][1], row[at]])
                        at = _select(own, row, k)
                    best[n] = own[at], row[at]
        low, high = -(2**63), 2**63 - 1
        rows = [(int(q), int(i), min(max(int(s), low), high)) for q, (ids, row) in zip(qids, best) if row is not None
                for i, s in zip(ids, row)]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    return run


def _best(rows: DataFrame, by: list[Column | str], k: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return rows.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for ``vectors(id long, v array<double>)`` of whole numbers.

    Every row whose ``is_query`` is true is compared with all rows of another id.  Null ids and vectors that
    are null, empty or hold null, infinite or NaN components take no part.  Every row counts, repeated ones too;
    of several query rows of one id the smallest vector asks, and rows of its id are no candidates.  Vectors whose length is not
    that of the query score nothing against it.  Scores beyond a long are set to its ends.
    """
    spark = vectors.sparkSession
    fine = vectors.where(F.col("id").isNotNull() & (F.size("v") > 0) & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))))
    schema = "query_id long, vec_id long, score long"
    asks = fine.where(is_query).groupBy("id").agg(F.min("v").alias("v")).withColumn("width", F.size("v"))
    parts = []
    for width, count in sorted((r["width"], r["count"]) for r in asks.groupBy("width").count().collect()):
        blocks = -(-count // block)
        shard = fine.where(F.size("v") == width).select("id", "v")
        for b in range(blocks):
            # a stated query set against all rows, in blocks of bounded size
            own = asks.where((F.col("width") == width) & (F.pmod(F.xxhash64("id"), F.lit(blocks)) == b)).orderBy("id").collect()
            if own:
                shared = spark.sparkContext.broadcast((np.array([r["id"] for r in own]), np.array([r["v"] for r in own], dtype=np.float64)))
                parts.append(shard.mapInArrow(search(shared, k), schema))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = reduce(DataFrame.union, parts).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(GROUPS)))
    level = _best(rows, ["query_id", "part"], k, "local").drop("local", "part")
    return _best(level, ["query_id"], k, "rank").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
