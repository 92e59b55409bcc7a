"""Dissolved areas as whole polygons, WKT with parts and holes, overlay of rings of any shape."""

import random

import pytest
from pyspark.sql import functions as F

from cellscape.functions import geometry as g
from cellscape.operators import dissolve, osm, overlay, rings, sweep
from cellscape.sources import readers

SIDE = 10.0


def cells_of(spark, positions, city=1):
    b = g.apothem(SIDE)
    rows = [(city, r, c, 2 * b * c + b * (r % 2), 1.5 * SIDE * r + SIDE) for r, c in positions]
    return spark.createDataFrame(rows, "city long, row long, col long, cx double, cy double")


def shapes(cells):
    text = dissolve.dissolved_polygons(cells, ["city"], SIDE)
    got = readers.wkt_rings(text).select("city", "area", "part", "ring", F.size("coords").alias("n"), g.ring_signed_area(F.col("coords")).alias("a"))
    out = {}
    for r in got.orderBy("city", "area", "ring").collect():
        assert r.part == 0
        out.setdefault((r.city, r.area), []).append((r.n - 1, r.a))
    return out


def test_a_strip_over_many_blocks_is_one_polygon(spark):
    strip = [(r, c) for r in range(4) for c in range(300)]
    got = shapes(cells_of(spark, strip))
    assert list(got) == [(1, 0)] and len(got[(1, 0)]) == 1
    assert got[(1, 0)][0][1] == pytest.approx(len(strip) * g.hexagon_area(SIDE), rel=1e-5)


def test_a_frame_over_many_blocks_has_one_hole(spark):
    frame = [(r, c) for r in range(150) for c in range(150) if not (5 <= r < 140 and 5 <= c < 140)]
    island = [(70, 70)]
    got = shapes(cells_of(spark, frame + island))
    assert sorted(got) == [(1, 0), (1, (70 << 20) + 70)]
    assert [a > 0 for _, a in got[(1, 0)]] == [True, False]
    assert sum(a for _, a in got[(1, 0)]) == pytest.approx(len(frame) * g.hexagon_area(SIDE), rel=1e-5)
    assert got[(1, (70 << 20) + 70)][0][0] == 6


def test_random_cells_against_brute_force(spark):
    rng = random.Random(5)
    positions = [(r, c) for r in range(100) for c in range(100) if rng.random() < 0.6]
    got = shapes(cells_of(spark, positions))
    left, areas = set(positions), {}
    while left:
        start = min(left)
        left.discard(start)
        todo, found = [start], []
        while todo:
            r, c = todo.pop()
            found.append((r, c))
            s = r % 2
            for n in [(r, c - 1), (r, c + 1), (r - 1, c + s - 1), (r - 1, c + s), (r + 1, c + s - 1), (r + 1, c + s)]:
                if n in left:
                    left.discard(n)
                    todo.append(n)
        sides, corners = {}, set()
        for r, c in found:
            x, y = 2 * c + r % 2, 3 * r + 2
            ring = [(x + dx, y + dy) for dx, dy in dissolve.CORNERS]
            corners.update(ring)
            for e in zip(ring, ring[1:] + ring[:1]):
                sides[frozenset(e)] = sides.get(frozenset(e), 0) + 1
        holes = 1 - (len(corners) - len(sides) + len(found))
        areas[(1, (start[0] << 20) + start[1])] = (1 + holes, sum(v == 1 for v in sides.values()), len(found))
    assert {k: (len(v), sum(n for n, _ in v)) for k, v in got.items()} == {k: v[:2] for k, v in areas.items()}
    for k, v in got.items():
        assert sum(a for _, a in v) == pytest.approx(areas[k][2] * g.hexagon_area(SIDE), rel=1e-4)
        assert v[0][1] > 0 and all(a < 0 for _, a in v[1:])


def test_no_cells_give_no_polygon(spark):
    assert shapes(cells_of(spark, [(0, 0)]).limit(0)) == {}


def test_rank_rings_of_all_lengths(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for city, lengths in ((1, [1, 2, 3, 5]), (2, [64, 100, 1, 7])):
        names = list(range(sum(lengths)))
        rng.shuffle(names)
        for size in lengths:
            ring, names = names[:size], names[size:]
            ns = [rng.randint(1, 4) for _ in ring]
            first = ring.index(min(ring))
            for i, v in enumerate(ring):
                rows.append((city, v, ring[(i + 1) % size], ns[i], v, 0))
                way = [ns[(first + j) % size] for j in range((i - first) % size)]
                want[city, v] = (min(ring), sum(way), sum(ns))
    nodes = spark.createDataFrame(rows, "city long, node long, follower long, n int, low long, low_at int")
    got = {(r.city, r.node): (r.ring, r.before, r.total) for r in rings.rank_rings(nodes, ["city"], hot_rows=10).collect()}
    assert got == want


@pytest.mark.parametrize("text, parts", [
    ("POLYGON((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 1))", [[5, 4]]),
    ("MULTIPOLYGON(((0 0,4 0,4 4,0 0)),((9 9,10 9,10 10,9 9),(9.5 9.2, 9.7 9.2, 9.7 9.4, 9.5 9.2)))", [[4], [4, 4]]),
    ("SRID=4326; multipolygon ( ( ( 0 0 , 4 0 , 4 4 , 0 0 ) ) , ( (9 9, 10 9, 10 10, 9 9) ) )", [[4], [4]]),
    ("POLYGON Z ((0 0 7, 4 0 7, 4 4 7, 0 0 7))", [[4]]),
    ("LINESTRING(0 0, 1.5e1 -2)", [[2]]),
    ("MULTILINESTRING((0 0, 1 1),(2 2, 3 3, 4 4))", [[2], [3]]),
    ("POINT(1 2)", [[1]]),
    ("MULTIPOINT(1 2, 3 4)", [[1], [1]]),
    ("MULTIPOINT((1 2), (3 4))", [[1], [1]]),
    ("POLYGON EMPTY", []),
    ("GEOMETRYCOLLECTION(POINT(1 2))", None),
    ("nothing", None), ("", None), (None, None)])
def test_wkt_grammar(spark, text, parts):
    got = spark.createDataFrame([(text,)], "wkt string").select(g.wkt_parts(F.col("wkt")).alias("p")).first().p
    assert (None if got is None else [[len(r) for r in p] for p in got]) == parts


def test_wkt_values_and_holes_in_the_sweep(spark, tmp_path):
    text = "MULTIPOLYGON(((0 0, 0 10, 10 10, 10 0, 0 0), (2 2, 8 2, 8 8, 2 8, 2 2)), ((20 0, 30 0, 30 10, 20 0)))"
    spark.createDataFrame([(1, text), (2, None)], "fid long, wkt string").write.csv(f"{tmp_path}/w", sep="\t")
    got = readers.wkt_file(spark, f"{tmp_path}/w", "fid long")
    areas = {(r.fid, r.part, r.ring): r.a for r in got.select("fid", "part", "ring", g.ring_signed_area(F.col("coords")).alias("a")).collect()}
    assert areas == {(1, 0, 0): 100.0, (1, 0, 1): -36.0, (1, 1, 0): 50.0}
    points = spark.createDataFrame([(1, 1.0, 5.0), (1, 5.0, 5.0), (1, 28.0, 3.0), (1, 40.0, 5.0)], "fid long, x double, y double")
    found = sweep.inside(points, got.select("fid", F.col("coords").alias("ring"), (F.col("ring") > 0).alias("hole")), ["fid"], "x", "y", 4.0)
    assert {r.x: r.winding for r in found.collect()} == {1.0: 1, 5.0: 0, 28.0: 1, 40.0: 0}


U = [(0, 0), (10, 0), (10, 10), (7, 10), (7, 3), (3, 3), (3, 10), (0, 10)]
COMB = [(0, 0), (90, 0)] + [p for i in reversed(range(9)) for p in ((10 * i + 6, 0.5 + i % 2), (10 * i + 6, 10), (10 * i + 1, 10), (10 * i + 1, 0.5 + i % 2))] + [(0, 1)]


def clip(spark, polygon_rings, box, back=False):
    rows = [(1, list(reversed(r)) if back else r, hole, *map(float, box)) for r, hole in polygon_rings]
    df = spark.createDataFrame(
        [(f, [(float(x), float(y)) for x, y in r], *o) for f, r, *o in rows],
        "fid long, ring array<struct<x:double,y:double>>, hole boolean, xmin double, ymin double, xmax double, ymax double")
    return sorted(round(r.area, 6) for r in overlay.clip_to_boxes(df, ["fid"]).collect())


@pytest.mark.parametrize("back", [False, True])
def test_overlay_of_concave_rings(spark, back):
    assert clip(spark, [(U, False)], (-1, 5, 11, 20), back) == [15.0, 15.0]          # two prongs
    assert clip(spark, [(U, False)], (-1, -1, 11, 5), back) == [42.0]
    assert clip(spark, [(U, False)], (3.5, 4, 6, 9), back) == []                      # in the gap
    assert clip(spark, [(U, False)], (1, 1, 2, 2), back) == [1.0]                     # the box is inside
    assert clip(spark, [(U, False)], (0, 3, 10, 10), back) == [21.0, 21.0]            # edges on the border
    assert clip(spark, [(U, False)], (-5, -5, 50, 50), back) == [72.0]
    assert clip(spark, [(U, False)], (10, 0, 20, 10), back) == []                     # touches only
    assert clip(spark, [(COMB, False)], (0, 5, 90, 8), back) == [15.0] * 9
    assert clip(spark, [([(0, 0), (10, 0), (10, 10), (0, 10)], False)], (0, 0, 10, 10), back) == [100.0]


def test_water_in_box_keeps_or_drops_several_parts(spark):
    square = [(20, 5), (30, 5), (30, 15), (20, 15)]
    rows = [(f, [(float(x), float(y)) for x, y in r], -1.0, low, 25.0, 20.0) for f, r, low in
            [(1, U, 5.0), (2, U, -1.0), (3, square, 0.0), (4, U[:2], 0.0)]] + [(5, None, 0.0, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "fid long, ring array<struct<x:double,y:double>>, xmin double, ymin double, xmax double, ymax double")
    for parts, want in (("keep", [(1, 15.0), (1, 15.0), (2, 72.0), (3, 50.0)]), ("drop", [(2, 72.0), (3, 50.0)])):
        got = osm.water_in_box(df, parts).select("fid", F.abs(g.ring_signed_area(F.col("ring"))).alias("a")).collect()
        assert sorted((r.fid, round(r.a, 6)) for r in got) == want
    with pytest.raises(ValueError):
        osm.water_in_box(df, "some")


def test_overlay_with_holes_and_parts(spark):
    frame = [([(0, 0), (10, 0), (10, 10), (0, 10)], False), ([(2, 2), (8, 2), (8, 8), (2, 8)], True)]
    assert clip(spark, frame, (-1, -1, 11, 11)) == [-36.0, 100.0]
    assert clip(spark, frame, (-1, 4, 11, 6)) == [4.0, 4.0]
    assert clip(spark, frame, (3, 3, 7, 7)) == []
    assert clip(spark, frame, (-1, -1, 5, 11)) == [32.0]
    assert clip(spark, frame, (1, 1, 9, 9)) == [-36.0, 64.0]


def test_overlay_against_a_raster(spark):
    rng = random.Random(8)
    # a comb whose teeth have random heights, cut by random boxes: every column of unit width is a rectangle
    rows, want = [], {}
    for fid in range(40):
        heights = [rng.randint(1, 9) for _ in range(12)]
        ring = [(0, 0), (12, 0)]
        for i in reversed(range(12)):
            ring += [(i + 1, heights[i]), (i, heights[i])]
        corners = [ring[0]]
        for p in ring[1:]:
            if p != corners[-1]:
                corners.append(p)
        x0, x1 = sorted(rng.sample(range(-1, 14), 2))
        y0, y1 = sorted(rng.sample(range(-1, 11), 2))
        rows.append((fid, [(float(x), float(y)) for x, y in corners], float(x0), float(y0), float(x1), float(y1)))
        tops = [max(0, min(y1, heights[i]) - max(0, y0)) if x0 <= i < x1 else 0 for i in range(12)]
        runs = sum(t > 0 and (i == 0 or tops[i - 1] == 0) for i, t in enumerate(tops))
        want[fid] = (runs, sum(tops))
    df = spark.createDataFrame(rows, "fid long, ring array<struct<x:double,y:double>>, xmin double, ymin double, xmax double, ymax double")
    got = {f: (0, 0.0) for f in want}
    for r in overlay.clip_to_boxes(df, ["fid"]).collect():
        assert r.area > 0
        got[r.fid] = (got[r.fid][0] + 1, got[r.fid][1] + r.area)
    assert {f: (n, round(a, 6)) for f, (n, a) in got.items()} == want
