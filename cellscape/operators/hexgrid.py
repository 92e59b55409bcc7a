"""Hexagon grids: generation, clipping, adjacency.

``cell_id = row * 2**20 + col``, so row, column and neighbours follow from the id alone and need no
join.  Cell tables are ``(city, cell_id, row, col, cx, cy)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscape.functions import geometry as g
from cellscape.operators.skew import BAND_ROWS
from cellscape.operators.sweep import inside, ring_segments
from cellscape.session import materialize

COLUMN_BITS = 20


def cell_id(row: Column, col: Column) -> Column:
    return F.shiftleft(row.cast("long"), COLUMN_BITS) + col


def cell_row(cell: Column) -> Column:
    return F.shiftright(cell, COLUMN_BITS)


def cell_col(cell: Column) -> Column:
    return cell.bitwiseAND(F.lit((1 << COLUMN_BITS) - 1))


def hex_grid(boxes: DataFrame, side: float) -> DataFrame:
    """Hexagons covering each ``(city, xmin, ymin, xmax, ymax)`` box.

    Rows are generated and spread over the cluster before columns, so one large city is never built
    by one task.
    """
    b = g.apothem(side)
    ncol = F.ceil(F.abs(F.col("xmax") - F.col("xmin")) / (2 * b))
    nrow = F.ceil(F.abs(F.col("ymax") - F.col("ymin")) / (2 * side))
    rows = boxes.select(
        "city", "xmin", "ymin", ncol.alias("ncol"),
        F.explode(F.sequence(F.lit(0).cast("long"), 2 * nrow + 1)).alias("row"),
    ).repartition("city", "row")
    cells = rows.select(
        "city", "xmin", "ymin", "row",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("ncol"))).alias("col"),
    )
    return cells.select(
        "city",
        cell_id(F.col("row"), F.col("col")).alias("cell_id"),
        "row", "col",
        (F.col("xmin") + 2 * b * F.col("col") + b * (F.col("row") % 2)).alias("cx"),
        (F.col("ymin") + 1.5 * side * F.col("row") + side).alias("cy"),
    )


def clip_to_areas(cells: DataFrame, areas: DataFrame, side: float) -> DataFrame:
    """Cells that share a point with their city's area ``(city, ring)``.

    A cell meets a polygon when its centre is inside or the boundary passes through it.
    """
    tile = 16 * side
    b = g.apothem(side)
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    segments = ring_segments(areas, ["city"])
    tx, ty = F.col("tx"), F.col("ty")
    in_tiles = (
        segments.withColumn("tx", F.explode(F.sequence(
            F.floor((F.least(x1, x2) - b) / tile), F.floor((F.greatest(x1, x2) + b) / tile))))
        .withColumn("ty", F.explode(F.sequence(
            F.floor((F.least(y1, y2) - side) / tile), F.floor((F.greatest(y1, y2) + side) / tile))))
        .where(g.rectangle_meets_segment(
            tx * tile - b, ty * tile - side, (tx + 1) * tile + b, (ty + 1) * tile + side, x1, y1, x2, y2))
    )
    placed = cells.withColumn("tx", F.floor(F.col("cx") / tile)).withColumn("ty", F.floor(F.col("cy") / tile))
    touched = (
        placed.join(in_tiles, ["city", "tx", "ty"])
        .where(g.hexagon_meets_segment(F.col("cx"), F.col("cy"), x1, y1, x2, y2, side))
        .select("city", "cell_id")
        .distinct()
        .withColumn("touched", F.lit(True))
    )
    return (
        inside(cells, areas, ["city"], "cx", "cy", tile)
        .join(touched, ["city", "cell_id"], "left")
        .where((F.col("winding") != 0) | F.col("touched"))
        .select(*cells.columns)
    )


def neighbour_offsets(row: Column, col: Column) -> Column:
    """The six adjacent (row, col) pairs."""
    shift = row % 2
    pairs = [
        (row, col - 1), (row, col + 1),
        (row - 1, col + shift - 1), (row - 1, col + shift),
        (row + 1, col + shift - 1), (row + 1, col + shift),
    ]
    return F.array(*[F.struct(r.alias("nrow"), c.alias("ncol")) for r, c in pairs])


def adjacency(cells: DataFrame) -> DataFrame:
    """``(city, cell_id, neighbour_id)`` for every pair of touching cells, both directions."""
    wanted = (
        cells.select("city", "cell_id", F.explode(neighbour_offsets(F.col("row"), F.col("col"))).alias("n"))
        .where((F.col("n.nrow") >= 0) & (F.col("n.ncol") >= 0))
        .select("city", "cell_id", cell_id(F.col("n.nrow"), F.col("n.ncol")).alias("neighbour_id"))
    )
    present = cells.select("city", F.col("cell_id").alias("neighbour_id"))
    return wanted.join(present, ["city", "neighbour_id"]).select("city", "cell_id", "neighbour_id")


def with_wkt(cells: DataFrame, side: float) -> DataFrame:
    return cells.withColumn("wkt", g.ring_wkt(g.hexagon_ring(F.col("cx"), F.col("cy"), side)))


def layer_bounds(points: DataFrame, by: list[str]) -> DataFrame:
    """Bounding box per group of (x, y) rows."""
    return points.groupBy(*by).agg(
        F.min("x").alias("xmin"), F.min("y").alias("ymin"),
        F.max("x").alias("xmax"), F.max("y").alias("ymax"),
    )


def centre_distance(cells: DataFrame, centres: DataFrame) -> DataFrame:
    """Distance in km from each cell to its city's centre polygon ``(city, ring)``, 0 inside.

    Each cell meets the edges of its city in generated code; the edges reach it by band of grid rows, and the
    minimum over them uses the same partitioning or a partial aggregate of one row a cell.
    """
    # stored, or what holds for a ring that follows from its city would be worked out again for each cell
    edges = materialize(ring_segments(centres, ["city"]).groupBy("city").agg(
        F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges")), "centre-edges")  # the corners of one ring
    band = F.floor(F.shiftright("cell_id", 20) / BAND_ROWS).alias("band")
    placed = cells.select("city", band, "cell_id", "cx", "cy")
    bands = placed.select("city", "band").distinct().join(edges, "city")
    pairs = placed.join(bands, ["city", "band"]).select("city", "band", "cell_id", "cx", "cy", F.inline("edges"))
    x1, y1, x2, y2, cx, cy = (F.col(c) for c in ("x1", "y1", "x2", "y2", "cx", "cy"))
    crosses = ((y1 <= cy) != (y2 <= cy)) & (x1 + (cy - y1) * F.coalesce(F.try_divide(x2 - x1, y2 - y1), F.lit(0.0)) > cx)
    return pairs.groupBy("city", "band", "cell_id").agg(
        F.min(g.segment_distance(cx, cy, x1, y1, x2, y2)).alias("metres"), F.sum(crosses.cast("int")).alias("crossings")
    ).select("city", "cell_id", F.when(F.col("crossings") % 2 == 1, 0.0).otherwise(F.col("metres") / 1000).alias("city_center_distance_km"))
