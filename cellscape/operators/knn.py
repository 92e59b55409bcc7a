"""Exact k nearest neighbours for classification.

Training rows are grouped by the nearest of a fixed number of pivots.  For each query the triangle
inequality bounds the distance to every group from both sides; groups that cannot hold one of the k
nearest are skipped (after Lu et al., "Efficient Processing of k Nearest Neighbor Joins using
MapReduce", 2012).  Large groups are cut into chunks; a task compares one chunk of queries with one
chunk of training rows and emits the k best of each query, which are merged by an aggregate.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscape.session import materialize

PIVOTS = 32
CHUNK = 16_384  # rows of a block; every row is copied once for each block of the other side
ROWS = 128  # queries compared at once
PAIRS = 65_536  # differences held at once, where many rows are equally near


def _to_pivots(df: DataFrame, pivots: np.ndarray, columns: str) -> DataFrame:
    """Distances of each row to all pivots, as an array column ``to``."""
    shared = df.sparkSession.sparkContext.broadcast(pivots)

    def work(batches):
        p = shared.value
        for batch in batches:
            x = np.stack(batch.column("x").to_numpy(zero_copy_only=False)) if batch.num_rows else np.zeros((0, p.shape[1]))
            d = np.sqrt(((x[:, None, :] - p[None, :, :]) ** 2).sum(axis=2))
            yield batch.append_column("to", pa.array(list(d), pa.list_(pa.float64())))

    return df.mapInArrow(work, f"{columns}, to array<double>")


def _lengths(x: np.ndarray) -> np.ndarray:
    """Squared lengths of the rows."""
    with np.errstate(over="ignore"):
        return (x * x).sum(axis=1)


def _within_reach(dots: np.ndarray, q2: np.ndarray, t2: np.ndarray, width: int, k: int, banned: np.ndarray | None):
    """Places (query, row) that can be among the ``k`` nearest, from scalar products and squared lengths.

    ``q2 + t2 - 2 dots`` misses the squared distance by rounding alone, no more than ``slack``, so all rows
    within twice that of the k-th smallest are kept.
    """
    with np.errstate(invalid="ignore", over="ignore"):
        d2 = q2[:, None] + t2[None, :] - 2 * dots
        slack = 8 * (width + 4) * np.finfo(float).eps * (q2 + np.max(t2, initial=0.0, where=np.isfinite(t2)))
        d2[~np.isfinite(d2)] = np.inf
        if banned is not None:
            d2[banned] = np.inf
        limit = np.partition(d2, k - 1, axis=1)[:, k - 1] if d2.shape[1] > k else np.full(len(d2), np.inf)
        near = d2 <= (limit + 2 * np.where(np.isfinite(slack), slack, np.inf))[:, None]
    if banned is not None:
        near &= ~banned
    return np.nonzero(near)


def nearest_neighbours(queries: DataFrame, training: DataFrame, k: int, leave_out_self: bool = False) -> DataFrame:
    """``(query_id, neighbours ARRAY<STRUCT<d2, id, label>>)``, nearest first, ties by id.

    Both inputs are ``(id BIGINT, x ARRAY<DOUBLE>)``, training also ``label``.  With
    ``leave_out_self`` a query is never its own neighbour.
    """
    # a fixed number of pivots, whatever the size of the data
    chosen = training.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).select("x").collect()
    pivots = np.array([r["x"] for r in chosen])
    near = F.array_position("to", F.array_min("to")) - 1
    train = materialize(
        _to_pivots(training.select("id", "x", "label"), pivots, "id long, x array<double>, label int")
        .select("id", "x", "label", near.cast("int").alias("group"), F.array_min("to").alias("r")), "knn-training")
    groups = train.groupBy("group").agg(F.count("*").alias("n"), F.min("r").alias("low"), F.max("r").alias("high")).collect()
    stats = {r["group"]: (r["n"], r["low"], r["high"]) for r in groups}
    chunks = {g: max(1, -(-n // CHUNK)) for g, (n, _, _) in stats.items()}
    need = k + (1 if leave_out_self else 0)
    names = sorted(stats)
    sizes, lows, highs = (np.array([stats[g][i] for g in names], dtype=float) for i in range(3))

    def bounds(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            d = np.stack(batch.column("to").to_numpy(zero_copy_only=False))[:, names]
            farthest = d + highs
            order = np.argsort(farthest, axis=1)
            reached = np.cumsum(sizes[order], axis=1)
            enough = np.minimum((reached < need).sum(axis=1), len(names) - 1)
            limit = np.take_along_axis(farthest, order, axis=1)[np.arange(len(d)), enough]
            nearest = np.maximum(0, np.maximum(d - highs, lows - d))
            row, group = np.nonzero(nearest <= limit[:, None] * (1 + 1e-9) + 1e-12)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(row)), batch.column("x").take(pa.array(row)),
                 pa.array(np.array(names)[group], pa.int32())], names=["id", "x", "group"])

    probes = _to_pivots(queries.select("id", "x"), pivots, "id long, x array<double>").mapInArrow(
        bounds, "id long, x array<double>, group int")
    n_queries = max(1, -(-queries.count() // CHUNK))
    chunk_map = F.create_map(*[F.lit(int(v)) for g, c in chunks.items() for v in (g, c)])
    probes = probes.withColumn("qc", F.pmod(F.xxhash64("id"), F.lit(n_queries))).withColumn(
        "tc", F.explode(F.sequence(F.lit(0).cast("long"), chunk_map[F.col("group")] - 1)))
    blocks = train.withColumn("tc", F.pmod(F.xxhash64("id"), chunk_map[F.col("group")].cast("long"))).withColumn(
        "qc", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_queries - 1).cast("long"))))

    def compare(q: pa.Table, t: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "d2": pa.array([], pa.float64()),
                          "id": pa.array([], pa.int64()), "label": pa.array([], pa.int32())})
        if not q.num_rows or not t.num_rows:
            return empty
        qid, tid = q.column("id").to_numpy(), t.column("id").to_numpy()
        order = np.argsort(tid, kind="stable")
        tx = np.stack(t.column("x").to_numpy())[order]
        tid, label = tid[order], t.column("label").to_numpy()[order]
        qx = np.stack(q.column("x").to_numpy())
        out = []
        t2 = _lengths(tx)
        for start in range(0, len(qid), ROWS):
            own, x = qid[start: start + ROWS], qx[start: start + ROWS]
            q2 = _lengths(x)
            row, col = _within_reach(x @ tx.T, q2, t2, x.shape[1], k, own[:, None] == tid[None, :] if leave_out_self else None)
            # distances by differences, as exact as they can be, of the rows that are left
            value = np.concatenate([_lengths(x[row[i: i + PAIRS]] - tx[col[i: i + PAIRS]]) for i in range(0, max(len(row), 1), PAIRS)])
            keep = np.flatnonzero(np.isfinite(value))
            keep = keep[np.lexsort((col[keep], value[keep], row[keep]))]
            first = np.searchsorted(row[keep], row[keep], side="left")
            keep = keep[np.arange(len(keep)) - first < k]
            out.append((own[row[keep]], value[keep], tid[col[keep]], label[col[keep]]))
        parts = [np.concatenate(p) for p in zip(*out)]
        return pa.table(dict(zip(["query_id", "d2", "id", "label"], parts))).cast(empty.schema)

    partial = probes.groupBy("group", "qc", "tc").cogroup(blocks.groupBy("group", "qc", "tc")).applyInArrow(
        compare, "query_id long, d2 double, id long, label int")
    # merged in two steps, so that no list grows with the number of blocks
    def merge(df: DataFrame, *by) -> DataFrame:
        best = F.slice(F.array_sort(F.collect_list(F.struct("d2", "id", "label"))), 1, k)
        return df.groupBy("query_id", *by).agg(best.alias("neighbours"))

    step = merge(partial, F.pmod(F.xxhash64("id"), F.lit(256)).alias("part")).select(
        "query_id", F.explode("neighbours").alias("n")).select("query_id", "n.*")
    return merge(step)


def class_share(neighbours: Column, weights: str = "uniform") -> Column:
    """Share of class 1 among the neighbours; with ``distance`` each counts 1/d, exact hits alone."""
    one = lambda n: (n["label"] == 1).cast("double")
    if weights == "uniform":
        return F.aggregate(neighbours, F.lit(0.0), lambda acc, n: acc + one(n)) / F.greatest(F.size(neighbours), F.lit(1))
    hits = F.filter(neighbours, lambda n: n["d2"] == 0)
    weigh = lambda n: F.try_divide(F.lit(1.0), F.sqrt(n["d2"]))
    total = F.aggregate(neighbours, F.lit(0.0), lambda acc, n: acc + weigh(n))
    ones = F.aggregate(neighbours, F.lit(0.0), lambda acc, n: acc + weigh(n) * one(n))
    exact = F.try_divide(F.aggregate(hits, F.lit(0.0), lambda acc, n: acc + one(n)), F.size(hits))
    return F.when(F.size(hits) > 0, exact).otherwise(F.try_divide(ones, total))
