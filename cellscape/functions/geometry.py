"""Planar geometry as Column expressions (no Python runs per row).

Hexagons are pointy-top: side ``s``, apothem ``b = s*sqrt(3)/2``, corners at ``(0, +-s)`` and
``(+-b, +-s/2)`` from the centre.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SQRT3 = math.sqrt(3.0)


def apothem(side: float) -> float:
    return side * SQRT3 / 2


def hexagon_area(side: float) -> float:
    return 1.5 * SQRT3 * side * side


def point_distance(x1, y1, x2, y2) -> Column:
    return F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))


def segment_parameter(px, py, x1, y1, x2, y2) -> Column:
    """Position in [0, 1] of the point of the segment nearest to (px, py); 0 for a zero-length one."""
    dx, dy = x2 - x1, y2 - y1
    t = F.try_divide((px - x1) * dx + (py - y1) * dy, dx * dx + dy * dy)
    return F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), t)), F.lit(0.0))


def closest_point(px, py, x1, y1, x2, y2) -> tuple[Column, Column]:
    t = segment_parameter(px, py, x1, y1, x2, y2)
    return x1 + t * (x2 - x1), y1 + t * (y2 - y1)


def segment_distance(px, py, x1, y1, x2, y2) -> Column:
    qx, qy = closest_point(px, py, x1, y1, x2, y2)
    return point_distance(px, py, qx, qy)


def hexagon_distance(px, py, cx, cy, side: float) -> Column:
    """Distance from a point to a filled hexagon, 0 inside; folded to one quadrant."""
    b = apothem(side)
    x, y = F.abs(px - cx), F.abs(py - cy)
    zero, half, full = F.lit(0.0), F.lit(side / 2), F.lit(float(side))
    slanted = segment_distance(x, y, zero, full, F.lit(b), half)
    upright = segment_distance(x, y, F.lit(b), half, F.lit(b), -half)
    outside = F.greatest(x - b, x / 2 + y * (SQRT3 / 2) - b)
    return F.when(outside <= 0, 0.0).otherwise(F.least(slanted, upright))


def hexagon_meets_rectangle(dx, dy, half_width, half_height, side: float) -> Column:
    """Do a hexagon and an axis-parallel rectangle, centres (dx, dy) apart, share a point?"""
    b, h = apothem(side), SQRT3 / 2
    slant = b + half_width / 2 + half_height * h
    return (
        (F.abs(dx) <= b + half_width)
        & (F.abs(dy) <= side + half_height)
        & (F.abs(dx / 2 + dy * h) <= slant)
        & (F.abs(dx / 2 - dy * h) <= slant)
    )


def hexagon_meets_segment(cx, cy, x1, y1, x2, y2, side: float) -> Column:
    """Do a hexagon and a segment share a point?  Separating-axis test on five axes."""
    b, h = apothem(side), SQRT3 / 2
    ax, ay, bx, by = x1 - cx, y1 - cy, x2 - cx, y2 - cy

    def apart(pa, pb, reach):
        return (F.least(pa, pb) > reach) | (F.greatest(pa, pb) < -reach)

    ux, uy = x2 - x1, y2 - y1
    # reach of the hexagon along any direction (p, q): largest corner projection
    along = F.greatest(F.abs(uy) * side, F.abs(ux) * b + F.abs(uy) * (side / 2))
    across = F.greatest(F.abs(ux) * side, F.abs(uy) * b + F.abs(ux) * (side / 2))
    normal = ax * uy - ay * ux
    separated = (
        apart(ax, bx, F.lit(b))
        | apart(ax / 2 + ay * h, bx / 2 + by * h, F.lit(b))
        | apart(ax / 2 - ay * h, bx / 2 - by * h, F.lit(b))
        | (F.abs(normal) > across)
        | apart(ax * ux + ay * uy, bx * ux + by * uy, along)
    )
    return ~separated


def rectangle_meets_segment(x0, y0, x1r, y1r, x1, y1, x2, y2) -> Column:
    """Do rectangle [x0, x1r] x [y0, y1r] and a segment share a point?"""
    mx, my, hx, hy = (x0 + x1r) / 2, (y0 + y1r) / 2, (x1r - x0) / 2, (y1r - y0) / 2
    ux, uy = x2 - x1, y2 - y1
    return (
        (F.least(x1, x2) <= x1r)
        & (F.greatest(x1, x2) >= x0)
        & (F.least(y1, y2) <= y1r)
        & (F.greatest(y1, y2) >= y0)
        & (F.abs((x1 - mx) * uy - (y1 - my) * ux) <= hx * F.abs(uy) + hy * F.abs(ux))
    )


def box_gap(ax0, ay0, ax1, ay1, bx0, by0, bx1, by1) -> Column:
    """Smallest distance between two boxes, 0 when they overlap."""
    gx = F.greatest(F.lit(0.0), ax0 - bx1, bx0 - ax1)
    gy = F.greatest(F.lit(0.0), ay0 - by1, by0 - ay1)
    return F.sqrt(gx * gx + gy * gy)


def box_reach(ax0, ay0, ax1, ay1, px, py) -> Column:
    """Largest distance from a point to anywhere in a box."""
    gx = F.greatest(F.abs(px - ax0), F.abs(px - ax1))
    gy = F.greatest(F.abs(py - ay0), F.abs(py - ay1))
    return F.sqrt(gx * gx + gy * gy)


# ----- rings: ARRAY<STRUCT<x DOUBLE, y DOUBLE>>, closing point optional ------------------------


def point(x, y) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def closed(ring: Column) -> Column:
    first, last = F.element_at(ring, 1), F.element_at(ring, -1)
    is_closed = (first["x"] == last["x"]) & (first["y"] == last["y"])
    return F.when(is_closed, ring).otherwise(F.concat(ring, F.slice(ring, 1, 1)))


def ring_edges(ring: Column) -> Column:
    """ARRAY<STRUCT<x1, y1, x2, y2>> of the closed ring."""
    return closed_ring_edges(closed(ring))


def closed_ring_edges(c: Column) -> Column:
    """The same for a ring that ends where it starts."""
    starts, ends = F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1)
    return F.zip_with(
        starts,
        ends,
        lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
        ),
    )


def edges_signed_area(edges: Column) -> Column:
    return F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + (e["x1"] * e["y2"] - e["x2"] * e["y1"]) / 2)


def ring_signed_area(ring: Column) -> Column:
    return edges_signed_area(ring_edges(ring))


def is_valid_ring(ring: Column) -> Column:
    return F.size(ring) >= 3


def box_ring(xmin, ymin, xmax, ymax) -> Column:
    return F.array(point(xmin, ymin), point(xmax, ymin), point(xmax, ymax), point(xmin, ymax))


def circle_ring(x, y, radius, corners: int = 32) -> Column:
    """Polygon standing in for the disc around (x, y)."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(corners - 1)),
        lambda i: point(
            x + radius * F.cos(i * (2 * math.pi / corners)),
            y + radius * F.sin(i * (2 * math.pi / corners)),
        ),
    )


def hexagon_ring(cx, cy, side: float) -> Column:
    b = apothem(side)
    corners = [(0.0, -side), (b, -side / 2), (b, side / 2), (0.0, side), (-b, side / 2), (-b, -side / 2)]
    return F.array(*[point(cx + dx, cy + dy) for dx, dy in corners])


def ring_wkt(ring: Column, places: int = 3) -> Column:
    pairs = F.transform(
        closed(ring),
        lambda p: F.format_string(f"%.{places}f %.{places}f", p["x"], p["y"]),
    )
    return F.concat(F.lit("POLYGON(("), F.concat_ws(", ", pairs), F.lit("))"))


def wkt_points(text: Column) -> Column:
    """Coordinates of the first part of a WKT text, as a ring/line array."""
    body = F.regexp_extract(text, r"\(+([^()]*)\)", 1)
    return F.transform(
        F.split(F.trim(body), r"\s*,\s*"),
        lambda p: F.struct(
            F.element_at(F.split(p, r"\s+"), 1).cast("double").alias("x"),
            F.element_at(F.split(p, r"\s+"), 2).cast("double").alias("y"),
        ),
    )


def wkt_kind(text: Column) -> Column:
    """Upper-case geometry name of a WKT text, without a leading SRID."""
    return F.upper(F.regexp_extract(text, r"^\s*(?:SRID\s*=\s*\d+\s*;)?\s*([A-Za-z]+)", 1))


def wkt_parts(text: Column) -> Column:
    """All coordinates of a WKT text: ARRAY of parts, a part an ARRAY of rings or lines, these ARRAYs of points.

    POLYGON and MULTIPOLYGON: a part is its outer ring, then its holes.  Other MULTI kinds: one list a part, for
    MULTIPOINT one point.  Values beyond the second of a point (z, m) are left out.  EMPTY gives no part; NULL,
    collections and texts that are no WKT give NULL.
    """
    kind = wkt_kind(text)

    def points(body):
        return F.transform(F.split(F.trim(body), r"\s*,\s*"), lambda p: F.struct(
            F.get(F.split(F.trim(p), r"\s+"), F.lit(0)).try_cast("double").alias("x"),
            F.get(F.split(F.trim(p), r"\s+"), F.lit(1)).try_cast("double").alias("y")))

    def lists(body):  # coordinate lists stand between an opening and a closing parenthesis
        bodies = F.transform(F.split(body, r"\)"), lambda t: F.substring_index(t, "(", -1))
        return F.transform(F.filter(bodies, lambda t: t.rlike("[0-9]")), points)

    areas = F.transform(F.filter(F.split(text, r"\)\s*\)"), lambda t: F.contains(t, F.lit("(")) & t.rlike(r"\(\s*[-+.0-9]")), lists)
    every = lists(text)
    return (
        F.when(text.rlike(r"(?i)\bEMPTY\s*$"), F.slice(areas, 1, 0))
        .when(kind.isin("POLYGON", "MULTIPOLYGON"), areas)
        .when(kind == "MULTILINESTRING", F.transform(every, lambda line: F.array(line)))
        .when(kind == "MULTIPOINT", F.transform(F.flatten(every), lambda p: F.array(F.array(p))))
        .when(kind.isin("POINT", "LINESTRING"), F.array(every)))


def oriented(ring: Column, outer) -> Column:
    """The ring with its area on the left (outer rings) or on the right (holes), so that windings add up."""
    return F.when((ring_signed_area(ring) > 0) == outer, ring).otherwise(F.reverse(ring))


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def is_convex(ring: Column) -> Column:
    """Does a simple ring turn to one side only?"""
    def turns(c):  # c ends where it starts: the edge after the last one is the first
        def turn(p, i):
            q, r = F.get(c, i + 1), F.get(c, F.pmod(i + 1, F.size(c) - 1) + 1)
            return (q["x"] - p["x"]) * (r["y"] - q["y"]) - (q["y"] - p["y"]) * (r["x"] - q["x"])

        return F.transform(F.slice(c, F.lit(1), F.size(c) - 1), turn)

    def one_side(t):
        return ~(F.exists(t, lambda v: v > 0) & F.exists(t, lambda v: v < 0))

    return _once(ring, lambda r: _once(closed(r), lambda c: _once(turns(c), one_side)))


def clip_ring_to_box(ring: Column, xmin, ymin, xmax, ymax) -> Column:
    """Intersection of a ring with a box by four half-plane clips (exact for convex rings).

    Each half-plane is ``nx * x + ny * y <= limit``; the ring is folded over the four.
    """
    def half_plane(nx, ny, limit):
        return F.struct(F.lit(float(nx)).alias("nx"), F.lit(float(ny)).alias("ny"), limit.cast("double").alias("limit"))

    def clip(r: Column, side: Column) -> Column:
        def step(e):
            da = side["nx"] * e["x1"] + side["ny"] * e["y1"] - side["limit"]
            db = side["nx"] * e["x2"] + side["ny"] * e["y2"] - side["limit"]
            t = F.coalesce(F.try_divide(da, da - db), F.lit(0.0))
            start = point(e["x1"], e["y1"])
            cut = point(e["x1"] + t * (e["x2"] - e["x1"]), e["y1"] + t * (e["y2"] - e["y1"]))
            return (
                F.when((da <= 0) & (db <= 0), F.array(start))
                .when(da <= 0, F.array(start, cut))
                .when(db <= 0, F.array(cut))
                .otherwise(F.slice(F.array(start), 1, 0))
            )

        return F.when(F.size(r) >= 3, F.flatten(F.transform(ring_edges(r), step))).otherwise(F.slice(r, 1, 0))

    sides = F.array(
        half_plane(-1, 0, -xmin), half_plane(1, 0, xmax), half_plane(0, -1, -ymin), half_plane(0, 1, ymax))
    return F.aggregate(sides, ring.cast("array<struct<x:double,y:double>>"),
                       lambda r, side: clip(r, side).cast("array<struct<x:double,y:double>>"))
