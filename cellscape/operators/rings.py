"""Rings from directed links that each have one follower: order and name of every member.

Members are ranked by pointer jumping, so a ring of any length takes logarithmically many rounds and no
task holds it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscape.operators.skew import join_counted
from cellscape.session import materialize


def rank_rings(nodes: DataFrame, by: list[str], hot_rows: int = 1_000_000) -> DataFrame:
    """``(by, node, ring, shift, before, total)`` of ``nodes (by, node, follower, n, low, low_at)``.

    ``node`` and ``low`` are not negative and unique in their group; every node is the follower of exactly one
    node.  ``ring`` is the smallest ``low`` on the ring, ``shift`` its ``low_at``, ``before`` the sum of ``n``
    from the node with that ``low`` up to this one, ``total`` the sum over the ring.
    """
    alone = nodes.where("follower = node").select(
        *by, "node", F.col("low").alias("ring"), F.col("low_at").alias("shift"), F.lit(0).cast("long").alias("before"),
        F.col("n").cast("long").alias("total"))
    linked = nodes.where("follower <> node")
    if linked.isEmpty():
        return alone
    named = _ring_names(linked, by)
    ahead = _sums_to_end(named, by)
    ranked = named.drop("follower").join(ahead, [*by, "node"])
    totals = ranked.groupBy(*by, "ring").agg(F.sum("n").alias("total"), F.count("*").alias("members"))
    placed = join_counted(ranked, totals, [*by, "ring"], "members", hot_rows)
    return placed.select(
        *by, "node", "ring", "shift", (F.col("total") - F.col("ahead")).alias("before"), "total").unionByName(alone)


def _ring_names(linked: DataFrame, by: list[str]) -> DataFrame:
    """Add ``ring`` and ``shift``: each round doubles the stretch whose smallest ``low`` a node knows.

    A round that changes nothing is the last: then all nodes on the ring know the same value.
    """
    state = linked.select(*by, "node", F.col("follower").alias("to"), F.struct("low", "low_at").alias("best"))
    changed = True
    while changed:
        there = state.select(*by, F.col("node").alias("to"), F.col("to").alias("further"), F.col("best").alias("other"))
        state = materialize(
            state.join(there, [*by, "to"]).select(
                *by, "node", F.col("further").alias("to"), F.least("best", "other").alias("best"),
                (F.col("other") < F.col("best")).alias("changed")),
            "ring-names")
        changed = not state.where("changed").isEmpty()
        state = state.drop("changed")
    names = state.select(*by, "node", F.col("best.low").alias("ring"), F.col("best.low_at").alias("shift"))
    return materialize(linked.join(names, [*by, "node"]), "ring-members")


def _sums_to_end(named: DataFrame, by: list[str]) -> DataFrame:
    """``(by, node, ahead)``: the sum of ``n`` from a node to the last before the first of its ring.

    A node that has arrived joins with a key of its own that nothing has, so arrived nodes stay spread.
    """
    firsts = named.where("low = ring").select(*by, F.col("node").alias("follower"), F.lit(True).alias("arrived"))
    state = named.join(firsts, [*by, "follower"], "left").select(
        *by, "node", F.when(F.col("arrived"), -1 - F.col("node")).otherwise(F.col("follower")).alias("to"),
        F.col("n").cast("long").alias("ahead"))
    running = True
    while running:
        there = state.select(*by, F.col("node").alias("to"), F.col("to").alias("further"), F.col("ahead").alias("more"))
        state = materialize(
            state.join(there, [*by, "to"], "left").select(
                *by, "node",
                F.when(F.col("further") >= 0, F.col("further")).otherwise(-1 - F.col("node")).alias("to"),
                (F.col("ahead") + F.coalesce("more", F.lit(0))).alias("ahead")),
            "ring-sums")
        running = not state.where("to >= 0").isEmpty()
    return state.drop("to")
