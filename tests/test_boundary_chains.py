"""Boundary edges of many blocks are followed in one pass of a task."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from cellscape.operators import dissolve
from cellscape.session import materialize


def test_runs_of_many_blocks_against_a_plain_walk(spark):
    draw = random.Random(3)
    cells = {(g, draw.randrange(55, 75), draw.randrange(55, 75)) for g in range(30) for _ in range(120)}
    df = spark.createDataFrame([(None if g == 29 else g, r, c) for g, r, c in cells], "city long, row long, col long")
    edges = dissolve.boundary_edges(df, ["city"])
    chains = dissolve.boundary_chains(edges, ["city"])
    assert "FlatMapGroups" not in chains._jdf.queryExecution().executedPlan().toString()
    rows = chains.collect()
    assert len(rows) == edges.count() > 1000
    block = lambda r: (r.city, r.uy // (3 * dissolve.TILE), r.ux // (2 * dissolve.TILE))
    at = {(*block(r), r.node): r for r in rows}
    led = {(*block(r), r.to) for r in rows}
    for r in rows:
        first = at[(*block(r), r.chain)]
        # a run starts where no edge of the block leads, a ring at its smallest corner
        walk, n = first, 0
        while walk.node != r.node:
            walk, n = at[(*block(r), walk.to)], n + 1
            assert walk.chain == r.chain
        assert n == r.place
    for (*b, node), r in at.items():
        if (*b, node) not in led:
            assert r.chain == node and r.place == 0
    heads = {(*block(r), r.chain) for r in rows}
    for h in heads & led:
        assert at[h].node == min(r.node for r in rows if (*block(r), r.chain) == h)


def test_a_small_file_of_many_rows_is_not_broadcast(spark):
    """A million ids take some megabytes of Parquet and tens of megabytes as rows."""
    ids = materialize(spark.range(1_000_000).select("id", F.lit(1.5).alias("x"), F.lit(2.5).alias("y")), "test-ids")
    assert int(str(ids._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > 10 << 20
