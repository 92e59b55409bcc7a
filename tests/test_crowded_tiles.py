"""Nearest search with crowded tiles, and distances to clusters by their perimeter, against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellscape.operators import clusters as cl
from cellscape.operators import hexgrid, nearest

BOX = "city long, xmin double, ymin double, xmax double, ymax double"


@pytest.fixture(scope="module")
def cells(spark):
    return hexgrid.hex_grid(spark.createDataFrame([(1, 0.0, 0.0, 900.0, 900.0), (2, 0.0, 0.0, 300.0, 300.0)], BOX), 15.0)


def test_most_targets_in_one_tile(spark, cells):
    """200,000 distinct points in one tile, some far away; every 50th cell by brute force."""
    n = 200_000
    crowd = spark.range(n).select(
        F.lit(1).cast("long").alias("city"),
        (100 + F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003 * 60).alias("x"),
        (200 + F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1_000_003)) / 1_000_003 * 60).alias("y"))
    far = spark.createDataFrame([(1, 850.0, 880.0), (2, 5.0, 9.0)], "city long, x double, y double")
    points = crowd.unionByName(far)
    found = {(r.city, r.cell_id): r.distance for r in nearest.nearest_point(cells, points, 1000.0).collect()}
    rows = cells.collect()
    assert len(found) == len(rows)
    held = points.toPandas()
    for r in rows[::50]:
        p = held[held.city == r.city]
        assert found[r.city, r.cell_id] == pytest.approx(np.hypot(p.x - r.cx, p.y - r.cy).min(), abs=1e-9)


def test_targets_with_one_middle_and_several_kinds(spark, cells, monkeypatch):
    """Lines through one place share a tile at every depth; a sparse kind beside them keeps its own search."""
    monkeypatch.setattr(nearest, "LEAF", 20)
    rng = random.Random(8)
    turns = [rng.uniform(0, math.pi) for _ in range(150)]
    lines = [(1, "star", 400 - 80 * math.cos(a), 400 - 80 * math.sin(a), 400 + 80 * math.cos(a), 400 + 80 * math.sin(a))
             for a in turns]
    for _ in range(300):
        x, y = rng.uniform(0, 900), rng.uniform(0, 900)
        lines.append((1, "star", x, y, x + rng.uniform(-90, 90), y + rng.uniform(-90, 90)))
    lines += [(1, "thin", 10.0, 20.0, 300.0, 40.0), (2, "thin", 500.0, 20.0, 500.0, 20.5)]
    lines += [(2, "star", 7.0, 7.0, 8.0, 9.0)] * 60  # repeated rows
    segments = spark.createDataFrame(lines, "city long, kind string, x1 double, y1 double, x2 double, y2 double")
    found = {(r.city, r.kind, r.cell_id): r.distance
             for r in nearest.nearest_segment(cells, segments, 400.0, ["kind"]).collect()}
    rows = cells.collect()
    assert len(found) == 2 * len(rows)
    held = np.array([s[2:] for s in lines])
    for r in rows[::25]:
        d = held[:, 2:] - held[:, :2]
        t = np.clip(((r.cx - held[:, 0]) * d[:, 0] + (r.cy - held[:, 1]) * d[:, 1]) / (d**2).sum(1), 0, 1)
        gap = np.hypot(r.cx - held[:, 0] - t * d[:, 0], r.cy - held[:, 1] - t * d[:, 1])
        for kind in ("star", "thin"):
            mask = np.array([s[0] == r.city and s[1] == kind for s in lines])
            assert found[r.city, kind, r.cell_id] == pytest.approx(gap[mask].min(), abs=1e-6)


def test_no_targets_at_all(spark, cells):
    none = spark.createDataFrame([], "city long, x double, y double")
    assert nearest.nearest_point(cells, none, 100.0).count() == 0


def members(cells, condition):
    return cells.where(condition).withColumns({
        "year_model": F.lit(1990), "built_threshold": F.lit(40.0), "population_threshold": F.lit(75.0),
        "cluster_threshold": F.lit(50.0)})


def test_perimeter_grows_as_the_edge(cells):
    """A filled block: inner members are no targets, repeated members count once."""
    block = members(cells, "city = 1 AND row BETWEEN 3 AND 22 AND col BETWEEN 4 AND 23")
    edge = cl.perimeter(block.unionByName(block))
    assert edge.count() == 4 * 19
    inner = cl.perimeter(members(cells, "city = 1")).count()
    assert inner < cells.where("city = 1").count() / 5


def test_distance_by_perimeter_equals_distance_to_all_members(cells):
    chosen = members(cells, "city = 1 AND ((row BETWEEN 3 AND 22 AND col BETWEEN 4 AND 23 AND NOT "
                            "(row BETWEEN 8 AND 15 AND col BETWEEN 9 AND 14)) OR (row = 0 AND col = 0))")
    by_edge = {r.cell_id: r for r in cl.urban_distance(cells, chosen, 15.0, 200.0).collect()}
    by_all = {r.cell_id: r.distance for r in nearest.nearest_hexagon(cells, chosen, 15.0, 200.0, cl.URBAN_KEY).collect()}
    assert by_edge.keys() == by_all.keys()
    for k, d in by_all.items():
        assert by_edge[k].urban_distance_km * 1000 == pytest.approx(d, abs=1e-6)
        assert by_edge[k].urban_flag == (0 if d > 1e-9 else 1)
