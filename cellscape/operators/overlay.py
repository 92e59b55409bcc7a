"""Polygons of any shape cut to boxes, in parts.

Inside its box a ring falls into runs of edges that enter and leave over the border.  A run that leaves is
continued along the border, with the box on the left, to the next place where a run enters; these links close
the parts, also where holes reach over the border.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscape.functions import geometry as g
from cellscape.operators.rings import rank_rings
from cellscape.session import materialize

BOX = ["xmin", "ymin", "xmax", "ymax"]


def _span(start: Column, step: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """Stretch of the parameter where ``start + t * step`` lies between ``low`` and ``high``, both left out."""
    a, b = F.try_divide(low - start, step), F.try_divide(high - start, step)
    never = (step == 0) & ((start <= low) | (start >= high))
    return (F.when(never, 1.0).otherwise(F.coalesce(F.least(a, b), F.lit(0.0))),
            F.when(never, 0.0).otherwise(F.coalesce(F.greatest(a, b), F.lit(1.0))))


def _on_border(x: Column, y: Column) -> Column:
    """``(at, x, y)``: the nearest place on the border, ``at`` its way from the lower left corner, counter-clockwise."""
    x0, y0, x1, y1 = (F.col(c) for c in BOX)
    w, h = x1 - x0, y1 - y0
    x, y = F.greatest(x0, F.least(x1, x)), F.greatest(y0, F.least(y1, y))
    gap = F.least(y - y0, x1 - x, y1 - y, x - x0)

    def place(at, px, py):
        return F.struct(at.alias("at"), px.alias("x"), py.alias("y"))

    return (
        F.when(gap == y - y0, place(x - x0, x, y0)).when(gap == x1 - x, place(w + y - y0, x1, y))
        .when(gap == y1 - y, place(w + h + x1 - x, x, y1)).otherwise(place(2 * w + h + y1 - y, x0, y)))


def clip_to_boxes(shapes: DataFrame, by: list[str]) -> DataFrame:
    """``(by, piece, ring, area)``: the rings of each polygon's part in its box, ``area`` positive for outer rings
    and negative for holes.

    ``shapes`` has a row per ring: ``by`` names the polygon (of one or several parts), ``ring`` is the array of
    corners, ``hole`` (optional) marks holes, and ``xmin, ymin, xmax, ymax`` is the polygon's box.  Rings are simple
    and do not cross each other; their direction does not matter.  What only touches the border is left out.
    Columns other than these are not kept.  Null rings and rings of fewer than three corners give nothing.
    """
    hole = F.coalesce(F.col("hole"), F.lit(False)) if "hole" in shapes.columns else F.lit(False)
    numbered = materialize(
        shapes.where(g.is_valid_ring(F.col("ring"))).select(*by, *BOX, g.oriented(F.col("ring"), ~hole).alias("ring"))
        .withColumn("no", F.monotonically_increasing_id()), "clip-rings")
    edges = numbered.select(*by, *BOX, "no", F.posexplode(g.ring_edges(F.col("ring"))).alias("pos", "e")).select(
        *by, *BOX, "no", "pos", "e.*")
    x1, y1, x2, y2, xmin, ymin, xmax, ymax = (F.col(c) for c in ("x1", "y1", "x2", "y2", *BOX))

    def within(x, y):
        return (x > xmin) & (x < xmax) & (y > ymin) & (y < ymax)

    (left, right), (low, high) = _span(x1, x2 - x1, xmin, xmax), _span(y1, y2 - y1, ymin, ymax)
    cut = edges.select("*", F.greatest(F.lit(0.0), left, low).alias("t0"), F.least(F.lit(1.0), right, high).alias("t1")).where("t0 < t1")
    first = _on_border(x1 + F.col("t0") * (x2 - x1), y1 + F.col("t0") * (y2 - y1))
    last = _on_border(x1 + F.col("t1") * (x2 - x1), y1 + F.col("t1") * (y2 - y1))
    pieces = cut.select(
        *by, *BOX, "no", "pos", g.point(x1, y1).alias("p"),
        F.when(~within(x1, y1), first).alias("enter"), F.when(~within(x2, y2), last).alias("leave"))

    # runs of a ring: those before the first entry belong to the last run
    ring = Window.partitionBy("no")
    runs = pieces.withColumns({
        "run": F.count("enter").over(ring.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)),
        "runs": F.count("enter").over(ring), "end": F.max("pos").over(ring)})
    corner = F.when(F.col("enter").isNotNull(), F.struct("enter.x", "enter.y")).otherwise(F.col("p"))
    order = F.when(F.col("run") == 0, F.col("pos") + F.col("end") + 1).otherwise(F.col("pos"))
    chains = materialize(
        runs.groupBy(*by, *BOX, "no", F.when(F.col("run") == 0, F.col("runs")).otherwise(F.col("run")).alias("run")).agg(
            F.sort_array(F.collect_list(F.struct(order.alias("o"), corner.alias("p")))).alias("points"),
            F.max("enter").alias("enter"), F.max("leave").alias("leave"), F.min("runs").alias("runs"))
        .withColumns({"points": F.transform("points", lambda q: q["p"]), "node": F.monotonically_increasing_id()}),
        "clip-chains")

    crossing = chains.where("runs > 0")
    ends = crossing.select(*by, "node", F.lit(0).alias("kind"), F.col("leave.at").alias("at")).unionByName(
        crossing.select(*by, "node", F.lit(1).alias("kind"), F.col("enter.at").alias("at")))
    border = Window.partitionBy(*by).orderBy("at", "kind", "node")
    entry = F.when(F.col("kind") == 1, F.col("node"))
    follow = ends.select(
        *by, "node", "kind",
        F.coalesce(
            F.first(entry, True).over(border.rowsBetween(0, Window.unboundedFollowing)),
            F.first(entry, True).over(border.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("follower")
    ).where("kind = 0").drop("kind")
    nodes = materialize(follow.select("*", F.lit(1).alias("n"), F.col("node").alias("low"), F.lit(0).alias("low_at")), "clip-nodes")
    ranked = rank_rings(nodes, by)
    target = crossing.select(*by, F.col("node").alias("follower"), F.col("enter.at").alias("to"))
    linked = crossing.join(nodes.select(*by, "node", "follower"), [*by, "node"]).join(target, [*by, "follower"]).join(
        ranked.select(*by, "node", F.col("ring").alias("piece"), "before"), [*by, "node"])
    closed = linked.select(*by, "piece", F.struct(
        "before", F.concat("points", F.array(F.struct("leave.x", "leave.y")), _corners_between(F.col("leave.at"), F.col("to"))).alias("ring")).alias("r"))
    joined = closed.groupBy(*by, "piece").agg(F.sort_array(F.collect_list("r")).alias("r")).select(
        *by, "piece", F.flatten(F.transform("r", lambda q: q["ring"])).alias("ring"))
    whole = chains.where("runs = 0").select(*by, F.col("node").alias("piece"), F.col("points").alias("ring"))

    # no edge in the box: all of the box is inside or outside
    cx, cy = (xmin + xmax) / 2, (ymin + ymax) / 2
    right_of = x1 + F.coalesce(F.try_divide(cy - y1, y2 - y1), F.lit(0.0)) * (x2 - x1) > cx
    turn = F.when((y1 <= cy) & (y2 > cy) & right_of, 1).when((y1 > cy) & (y2 <= cy) & right_of, -1).otherwise(0)
    # (rings wholly inside have parts of their own and do not count)
    inner = chains.where("runs = 0").select("no").distinct()
    outer = edges.join(inner, "no", "left_anti").groupBy(*by, *BOX).agg(F.sum(turn).alias("winding"))
    full = outer.where("winding <> 0").join(crossing.select(*by).distinct(), by, "left_anti").select(
        *by, F.lit(-1).cast("long").alias("piece"), g.box_ring(xmin, ymin, xmax, ymax).alias("ring"))
    parts = joined.unionByName(whole).unionByName(full)
    return parts.select("*", g.ring_signed_area(F.col("ring")).alias("area")).where("area <> 0")


def _corners_between(start: Column, stop: Column) -> Column:
    """Corners of the box on the way along the border from ``start`` to ``stop``, counter-clockwise."""
    x0, y0, x1, y1 = (F.col(c) for c in BOX)
    w, h = x1 - x0, y1 - y0
    around = 2 * (w + h)
    corners = [(F.lit(0.0), x0, y0), (w, x1, y0), (w + h, x1, y1), (2 * w + h, x0, y1)]
    laps = F.array(*[F.struct((at + lap * around).alias("at"), g.point(x, y).alias("p")) for lap in (0, 1) for at, x, y in corners])
    end = F.when(stop >= start, stop).otherwise(stop + around)
    return F.transform(F.filter(laps, lambda c: (c["at"] > start) & (c["at"] < end)), lambda c: c["p"])
