"""Hand-made geometry cases with known answers, and brute force on random input."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellscape.functions import geometry as g
from cellscape.functions import projection as p
from cellscape.operators import hexgrid, nearest, sweep

SIDE = 10.0
B = g.apothem(SIDE)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def lit(*values):
    return [F.lit(float(v)) for v in values]


@pytest.mark.parametrize("x, y, want", [
    (0, 0, 0.0), (0, SIDE, 0.0), (B, 0, 0.0), (B + 1, 0, 1.0), (B + 1, 4, 1.0), (0, SIDE + 2, 2.0), (-B - 1, -3, 1.0)])
def test_point_to_hexagon(spark, x, y, want):
    assert one(spark, g.hexagon_distance(*lit(x, y, 0, 0), SIDE)) == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("segment, want", [((0, 0, 10, 0), 5.0), ((20, 5, 30, 5), math.sqrt(25 + 0)), ((3, 4, 3, 4), 5.0)])
def test_point_to_segment(spark, segment, want):
    px, py = (5, 5) if segment[0] == 0 else (15, 5) if segment[0] == 20 else (0, 0)
    assert one(spark, g.segment_distance(*lit(px, py, *segment))) == pytest.approx(want)


def test_rectangle_touching_a_corner_meets(spark):
    half = F.lit(1.0)
    assert one(spark, g.hexagon_meets_rectangle(*lit(0, SIDE + 1), half, half, SIDE))
    assert not one(spark, g.hexagon_meets_rectangle(*lit(0, SIDE + 1.001), half, half, SIDE))
    assert not one(spark, g.hexagon_meets_rectangle(*lit(B + 0.9, SIDE * 0.9), half, half, SIDE))


def test_segment_meets_hexagon_against_sampling(spark):
    rng = random.Random(1)
    cases = [tuple(rng.uniform(-25, 25) for _ in range(4)) for _ in range(400)]
    df = spark.createDataFrame(cases, "x1 double, y1 double, x2 double, y2 double")
    cols = [F.col(c) for c in df.columns]
    got = [r.v for r in df.select(g.hexagon_meets_segment(*lit(0, 0), *cols, SIDE).alias("v")).collect()]
    t = np.linspace(0, 1, 4001)
    for (x1, y1, x2, y2), v in zip(cases, got):
        x, y = np.abs(x1 + t * (x2 - x1)), np.abs(y1 + t * (y2 - y1))
        depth = np.maximum(x - B, x / 2 + y * g.SQRT3 / 2 - B).min()
        if abs(depth) > 0.02:
            assert v == (depth < 0)


def test_ring_helpers(spark):
    square = F.array(*[g.point(F.lit(a), F.lit(b)) for a, b in [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0)]])
    assert one(spark, g.ring_signed_area(square)) == -16.0
    cut = g.clip_ring_to_box(square, *lit(1, -1, 3, 2))
    assert abs(one(spark, g.ring_signed_area(cut))) == pytest.approx(4.0)
    assert one(spark, F.size(g.clip_ring_to_box(square, *lit(10, 10, 12, 12)))) == 0
    text = g.ring_wkt(square)
    assert one(spark, F.size(g.wkt_points(text))) == 5
    hexagon = g.hexagon_ring(*lit(3, 4), SIDE)
    assert one(spark, g.ring_signed_area(hexagon)) == pytest.approx(g.hexagon_area(SIDE))


def test_transverse_mercator_worked_example(spark):
    clarke = p.TransverseMercator(6378206.4, 1 - math.sqrt(1 - 0.00676866), -75.0, false_easting=0.0)
    x, y = p.to_transverse_mercator(clarke, F.lit(-73.5), F.lit(40.5))
    row = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert (row.x, row.y) == (pytest.approx(127106.5, abs=0.1), pytest.approx(4484124.4, abs=0.1))
    there = spark.range(1).select(x.alias("x"), y.alias("y"))
    back = p.with_geographic(there, clarke, "x", "y", "lon", "lat").first()
    assert (back.lon, back.lat) == (pytest.approx(-73.5, abs=1e-8), pytest.approx(40.5, abs=1e-8))


def test_mollweide_there_and_back(spark):
    x, y = p.to_mollweide(F.lit(36.2), F.lit(32.3))
    lon, lat = p.from_mollweide(x, y)
    row = spark.range(1).select(lon.alias("lon"), lat.alias("lat")).first()
    assert (row.lon, row.lat) == (pytest.approx(36.2, abs=1e-9), pytest.approx(32.3, abs=1e-9))


def test_grid_covers_box_and_inner_cells_have_six_neighbours(spark):
    box = spark.createDataFrame([(1, 0.0, 0.0, 300.0, 300.0)], "city long, xmin double, ymin double, xmax double, ymax double")
    cells = hexgrid.hex_grid(box, SIDE).cache()
    rows = cells.collect()
    assert len({r.cell_id for r in rows}) == len(rows)
    assert all(r.cell_id == (r.row << 20) + r.col for r in rows)
    counts = {r.cell_id: r.n for r in hexgrid.adjacency(cells).groupBy("cell_id").agg(F.count("*").alias("n")).collect()}
    top, right = max(r.row for r in rows), max(r.col for r in rows)
    assert all(counts[r.cell_id] == 6 for r in rows if 0 < r.row < top and 0 < r.col < right)
    # two rows up in the same column is not adjacent
    assert hexgrid.adjacency(cells).where(f"cell_id = {(2 << 20) + 3} and neighbour_id = {(4 << 20) + 3}").count() == 0


def _star(cx, cy, r, n, rng):
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    reach = [rng.uniform(0.3, 1) * r for _ in angles]
    return [(cx + k * math.cos(a), cy + k * math.sin(a)) for k, a in zip(reach, angles)]


def _inside(x, y, ring):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 <= y) != (y2 <= y) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) > x:
            odd = not odd
    return odd


def test_sweep_against_brute_force_and_clip_of_concave_area(spark):
    rng = random.Random(7)
    rings = [_star(rng.uniform(50, 250), rng.uniform(50, 250), 90, 12, rng) for _ in range(6)]
    rings[1].reverse()
    polygons = spark.createDataFrame(
        [(1, [{"x": a, "y": b} for a, b in r]) for r in rings], "city long, ring array<struct<x:double,y:double>>")
    box = spark.createDataFrame([(1, 0.0, 0.0, 300.0, 300.0)], "city long, xmin double, ymin double, xmax double, ymax double")
    cells = hexgrid.hex_grid(box, SIDE)
    got = {r.cell_id: (r.cx, r.cy, r.winding) for r in sweep.inside(cells, polygons, ["city"], "cx", "cy", 40.0).collect()}
    for cx, cy, winding in got.values():
        assert winding == sum(_inside(cx, cy, r) for r in rings)
    # clip to one concave area: kept exactly when the centre is in or an edge comes through
    area = polygons.limit(1)
    ring = [(q.x, q.y) for q in area.first().ring]
    kept = {r.cell_id for r in hexgrid.clip_to_areas(cells, area, SIDE).collect()}
    t = np.linspace(0, 1, 2001)
    for cell, (cx, cy, _) in got.items():
        depth = np.inf
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            x, y = np.abs(x1 + t * (x2 - x1) - cx), np.abs(y1 + t * (y2 - y1) - cy)
            depth = min(depth, np.maximum(x - B, x / 2 + y * g.SQRT3 / 2 - B).min())
        if abs(depth) > 0.02:
            assert (cell in kept) == (depth < 0 or _inside(cx, cy, ring))


@pytest.mark.parametrize("tile", [15.0, 60.0, 1000.0])
def test_nearest_against_brute_force(spark, tile):
    rng = random.Random(3)
    box = spark.createDataFrame(
        [(c, 0.0, 0.0, 200.0, 200.0) for c in (1, 2, 3)], "city long, xmin double, ymin double, xmax double, ymax double")
    cells = hexgrid.hex_grid(box, SIDE)
    # city 1: a third of all points on one spot, and a few far away; city 3 has none
    spots = [(1, 5.0, 5.0)] * 30 + [(1, rng.uniform(-500, 900), rng.uniform(-500, 900)) for _ in range(20)]
    spots += [(2, rng.uniform(0, 200), rng.uniform(0, 200)) for _ in range(40)]
    points = spark.createDataFrame(spots, "city long, x double, y double")
    found = {(r.city, r.cell_id): r.distance for r in nearest.nearest_point(cells, points, tile).collect()}
    rows = cells.collect()
    assert {c for c, _ in found} == {1, 2}
    for r in rows:
        if r.city < 3:
            want = min(math.hypot(r.cx - x, r.cy - y) for c, x, y in spots if c == r.city)
            assert found[r.city, r.cell_id] == pytest.approx(want)
    lines = [(c, x, y, x + rng.uniform(-300, 300), y + rng.uniform(-300, 300)) for c, x, y in spots[30:]]
    segments = spark.createDataFrame(lines, "city long, x1 double, y1 double, x2 double, y2 double")
    found = {(r.city, r.cell_id): r.distance for r in nearest.nearest_segment(cells, segments, tile).collect()}

    def to_segment(px, py, x1, y1, x2, y2):
        t = max(0, min(1, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2)))
        return math.hypot(px - x1 - t * (x2 - x1), py - y1 - t * (y2 - y1))

    for r in rows:
        if r.city < 3:
            want = min(to_segment(r.cx, r.cy, *s[1:]) for s in lines if s[0] == r.city)
            assert found[r.city, r.cell_id] == pytest.approx(want)
