"""Point-in-polygon for whole tables by a sweep along each row of points.

All edges that cross a row become events with the sign of their direction; sorting events and points
by x and adding the signs gives the number of polygons over each point.  The work is a sort of points
plus crossings: no point-polygon pair is ever formed, however large or many the polygons are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellscape.functions import geometry as g


def ring_segments(rings: DataFrame, by: list[str]) -> DataFrame:
    """One row per edge ``(by, x1, y1, x2, y2)``, directed counter-clockwise around the ring.

    Rings whose column ``hole`` (if there is one) is true are directed clockwise, so that windings inside them
    add up to 0.  The array steps are separate columns, so that each is computed once per ring.
    """
    hole = F.coalesce(F.col("hole"), F.lit(False)) if "hole" in rings.columns else F.lit(False)
    edges = (
        rings.where(g.is_valid_ring(F.col("ring")))
        .select(*by, hole.alias("_hole"), g.closed(F.col("ring")).alias("ring"))
        .select(*by, "_hole", g.closed_ring_edges(F.col("ring")).alias("edges"))
        .select(*by, ((g.edges_signed_area(F.col("edges")) < 0) != F.col("_hole")).alias("turned"), "edges")
        # a valid ring has edges; the outer form keeps the optimizer from working out all edges of a ring just to count them
        .select(*by, "turned", F.inline_outer("edges"))
    )

    def end(normal: str, reverse: str):
        return F.when(F.col("turned"), F.col(reverse)).otherwise(F.col(normal)).alias(normal)

    return edges.select(*by, end("x1", "x2"), end("y1", "y2"), end("x2", "x1"), end("y2", "y1"))


def inside(points: DataFrame, rings: DataFrame, by: list[str], x: str, y: str, strip: float) -> DataFrame:
    """Add ``winding``: how many rings of the same group cover each point (0 = outside all).

    ``strip`` is the height of the bands used to bring rows and edges together.
    """
    return inside_edges(points, ring_segments(rings, by), by, x, y, strip)


def inside_edges(points: DataFrame, segments: DataFrame, by: list[str], x: str, y: str, strip: float) -> DataFrame:
    """``inside`` for the edges of rings, as ``ring_segments`` makes them."""
    edges = segments.where("y1 <> y2")
    lines = points.select(*by, F.col(y).alias("y")).distinct().withColumn("strip", F.floor(F.col("y") / strip))
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    in_strips = edges.withColumn("strip", F.explode(F.sequence(F.floor(low / strip), F.floor(high / strip))))
    crossings = (
        in_strips.join(lines, [*by, "strip"])
        .where((F.col("y") >= low) & (F.col("y") < high))
        .select(
            *by, "y",
            (F.col("x1") + (F.col("y") - F.col("y1")) * (F.col("x2") - F.col("x1"))
             / (F.col("y2") - F.col("y1"))).alias("x"),
            F.when(F.col("y2") > F.col("y1"), -1).otherwise(1).alias("turn"),
        )
        # edges crossing a row at one x count together: bounds the events by distinct crossings
        .groupBy(*by, "y", "x").agg(F.sum("turn").alias("turn"))
    )
    events = points.select(
        *by, F.col(y).alias("y"), F.col(x).alias("x"), F.lit(0).cast("long").alias("turn"),
        F.struct(*[F.col(c) for c in points.columns]).alias("point"),
    ).unionByName(crossings, allowMissingColumns=True)
    # left to right: crossings at the same x as a point come first, an upward edge leaves the polygon
    row = Window.partitionBy(*by, "y").orderBy("x", F.col("point").isNotNull())
    return (
        events.withColumn("winding", F.sum("turn").over(row.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("point").isNotNull())
        .select("point.*", "winding")
    )
