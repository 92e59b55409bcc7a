"""Dissolve cells into areas: boundary edges, area, and polygons for export."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscape.functions import geometry as g
from cellscape.operators.components import TILE, connected_components, row_changes, whole_groups
from cellscape.operators.rings import rank_rings
from cellscape.session import materialize

# Corners on the integer lattice with steps (apothem, side/2), counter-clockwise from the bottom.
CORNERS = [(0, -2), (1, -1), (1, 1), (0, 2), (-1, 1), (-1, -1)]


def boundary_edges(cells: DataFrame, by: list[str], carry: tuple[str, ...] = ()) -> DataFrame:
    """Edges owned by one cell of the group only: ``(by, ux, uy, vx, vy)`` in lattice units.

    The direction keeps the area on the left.  An edge is shared by two cells at most; repeated cells own none alone.
    ``carry`` names further columns to keep.  Cells are shuffled once, to blocks of 64 x 64 cells, not their edges.
    """
    tile = lambda c, d: F.floor((F.col(c) + d) / TILE)
    # a cell goes to its block and to those that its neighbours may lie in; its edges are found in its own
    key = [*by, "block_row", "block_col"]
    blocks = (
        cells.select(*by, *carry, F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"))
        .withColumn("block_row", F.explode(F.sequence(tile("row", -1), tile("row", 1))))
        .withColumn("block_col", F.explode(F.sequence(tile("col", -1), tile("col", 1)))))

    def run(batches):
        for table in whole_groups(batches, key):
            block = np.cumsum(row_changes(table, key)) - 1
            row, col, block_row, block_col = (table.column(c).to_numpy() for c in ("row", "col", "block_row", "block_col"))
            # a block and its margin, two units of the lattice a column
            x = 2 * col + np.mod(row, 2)
            place = (block * (TILE + 4) + row - TILE * block_row + 2) * (2 * TILE + 8) + x - 2 * TILE * block_col + 4
            known, number = np.unique(place, return_counts=True)
            at = np.searchsorted(known, place)
            alone = np.flatnonzero((number[at] == 1) & (row // TILE == block_row) & (col // TILE == block_col))
            for (ax, ay), (bx, by_) in zip(CORNERS, CORNERS[1:] + CORNERS[:1]):
                # beyond the side from one corner to the next: the neighbour's centre is their sum away
                wanted = place[alone] + (ay + by_) // 3 * (2 * TILE + 8) + ax + bx
                free = alone[known[np.minimum(np.searchsorted(known, wanted), len(known) - 1)] != wanted]
                ends = [x[free] + ax, 3 * row[free] + 2 + ay, x[free] + bx, 3 * row[free] + 2 + by_]
                own = table.select([*by, *carry]).take(pa.array(free))
                yield from pa.table([*[own.column(c) for c in by], *[pa.array(e) for e in ends], *[own.column(c) for c in carry]],
                                    names=[*by, "ux", "uy", "vx", "vy", *carry]).to_batches()

    kind = {f.name: f.dataType.simpleString() for f in blocks.schema.fields}
    fields = ", ".join([f"`{c}` {kind[c]}" for c in by] + [f"{c} long" for c in ("ux", "uy", "vx", "vy")] + [f"`{c}` {kind[c]}" for c in carry])
    return blocks.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, fields)


def dissolved_area(cells: DataFrame, by: list[str], side: float) -> DataFrame:
    return cells.groupBy(*by).agg(
        F.count("*").alias("n_cells"), (F.count("*") * g.hexagon_area(side)).alias("area_m2"))


def boundary_chains(edges: DataFrame, by: list[str]) -> DataFrame:
    """Add ``node``, ``chain`` and ``place``: the runs of ``edges`` that start in one block of 64 x 64 cells.

    A corner of the lattice touches three cells, so one edge of a group leaves it at most, and the next edge
    follows from its end.  ``node`` is the id of the first corner of an edge, ``to`` of its second one.
    """
    def corner(x, y):
        return F.shiftleft(F.col(y), 32) + F.col(x) + 1

    blocks = edges.withColumns({
        "node": corner("ux", "uy"), "to": corner("vx", "vy"),
        "block_row": F.floor(F.col("uy") / (3 * TILE)), "block_col": F.floor(F.col("ux") / (2 * TILE))})

    key = [*by, "block_row", "block_col"]

    def run(batches):
        # most blocks have few edges, so all that an Arrow batch completes are followed in one go
        for table in whole_groups(batches, key):
            starts = np.flatnonzero(row_changes(table, key)).tolist()
            node, to = table.column("node").to_pylist(), table.column("to").to_pylist()
            chain, place = [], []
            for a, b in zip(starts, starts[1:] + [table.num_rows]):
                for column, own in zip((chain, place), _follow(node[a:b], to[a:b])):
                    column += own
            yield from table.append_column("chain", pa.array(chain, pa.int64())).append_column("place", pa.array(place, pa.int64())).to_batches()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.schema.fields)
    return blocks.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, f"{fields}, chain long, place long").drop(
        "block_row", "block_col")


def _follow(node: list[int], to: list[int]) -> tuple[list[int], list[int]]:
    """Of each edge of a block: the first corner of its run, and the number of edges before it."""
    at = {v: i for i, v in enumerate(node)}
    inner = set(to)
    chain, place = [None] * len(node), [0] * len(node)
    # runs that come from another block first; what is left are whole rings, from their smallest corner
    for first in [v for v in node if v not in inner] + sorted(v for v in node if v in inner):
        i, n = at[first], 0
        while i is not None and chain[i] is None:
            chain[i], place[i] = first, n
            i, n = at.get(to[i]), n + 1
    return chain, place


def boundary_rings(cells: DataFrame, by: list[str], side: float) -> DataFrame:
    """Corners of the dissolved areas: ``(by, area, ring, place, total, x, y, twice)``.

    ``cells`` is ``(by, row, col, cx, cy)``, one row per cell of a group.  ``area`` is the smallest cell of a connected
    area, ``ring`` the lowest corner of one of its rings, ``place`` counts from there, with the area on the left,
    ``total`` is the number of corners of the ring.  ``twice`` is what the edge from the corner adds to twice the
    signed area of its ring, in lattice units (12 for a cell): an area has one ring with a positive sum, its outer
    one; rings with a negative sum are holes.  No task holds an area or a ring: runs inside a block are followed
    in one task, and the runs of a ring are ranked by pointer jumping.
    """
    b = g.apothem(side)
    labelled = connected_components(
        cells.select(*by, "row", "col", (F.col("cx") - b * (2 * F.col("col") + F.pmod("row", F.lit(2)))).alias("xmin"),
                     (F.col("cy") - side / 2 * (3 * F.col("row") + 2)).alias("ymin")), by, "hexagon", "area")
    links = materialize(boundary_chains(boundary_edges(labelled, by, ("area", "xmin", "ymin")), by), "boundary-chains")
    chains = materialize(
        links.groupBy(*by, F.col("chain").alias("node")).agg(
            F.max_by("to", "place").alias("follower"), F.count("*").alias("n"),
            F.min("node").alias("low"), F.min_by("place", "node").alias("low_at")),
        "boundary-nodes")
    ranked = rank_rings(chains, by).withColumnRenamed("node", "chain")
    return links.join(ranked, [*by, "chain"]).select(
        *by, "area", "ring", F.pmod(F.col("before") + F.col("place") - F.col("shift"), F.col("total")).alias("place"), "total",
        (F.col("xmin") + F.col("ux") * b).alias("x"), (F.col("ymin") + F.col("uy") * (side / 2)).alias("y"),
        (F.col("ux") * F.col("vy") - F.col("vx") * F.col("uy")).alias("twice"))


def dissolved_polygons(cells: DataFrame, by: list[str], side: float) -> DataFrame:
    """One WKT polygon per connected area, ``(by, area, wkt)``: the outer ring, then the holes by lowest corner.

    A WKT text is one value, so an area's outline is put together in one row here, and only here; where
    outlines are longer than a value may be, store ``boundary_rings`` instead.
    """
    corner = F.format_string("%.3f %.3f", "x", "y")
    rings = boundary_rings(cells, by, side).groupBy(*by, "area", "ring").agg(
        F.sum("twice").alias("twice"), F.sort_array(F.collect_list(F.struct("place", corner.alias("at")))).alias("corners"))
    texts = F.transform("corners", lambda c: c["at"])
    ring_text = F.concat(F.lit("("), F.array_join(F.concat(texts, F.slice(texts, 1, 1)), ", "), F.lit(")"))
    ordered = rings.select(*by, "area", F.struct((F.col("twice") < 0).alias("hole"), "ring", ring_text.alias("text")).alias("r"))
    return ordered.groupBy(*by, "area").agg(F.sort_array(F.collect_list("r")).alias("rings")).select(
        *by, "area", F.concat(F.lit("POLYGON("), F.array_join(F.transform("rings", lambda r: r["text"]), ", "), F.lit(")")).alias("wkt"))
