"""Steps that shuffle cells once, or store what is read several times: same results, and plans without the old work."""

from __future__ import annotations

import random

import pytest
from cellscape.operators import clusters, dissolve, hexgrid, nearest
from cellscape.operators.skew import rank_within
from pyspark.sql import functions as F

SETS = [{"built": 40, "population": 75, "cluster": 5000}, {"built": 50, "population": 120, "cluster": 12000}]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def around(row, col):
    s = row % 2
    return [(row, col - 1), (row, col + 1), (row - 1, col + s - 1), (row - 1, col + s), (row + 1, col + s - 1), (row + 1, col + s)]


def test_neighbour_counts_with_repeated_and_missing_rows(spark):
    rng = random.Random(3)
    spots = [(1, r, c) for r in range(60, 70) for c in range(58, 70) if rng.random() < 0.7] + [(1, 5, 5), (2, 0, 0), (2, 0, 1), (3, 4, 4), (3, 4, 5)]
    rows = spots + rng.sample(spots, 12)
    cells = spark.createDataFrame([(c, (r << 20) + k, r, k) for c, r, k in rows] + [(1, None, None, None), (None, 7, 0, 7)],
                                  "city long, cell_id long, row long, col long")
    chosen = [(c, (r << 20) + k, y, 40.0, 75.0, 5000.0) for c, r, k in spots for y in (1990, 2014) if c != 3 and rng.random() < 0.5]
    chosen += chosen[:9] + [(1, (60 << 20) + 60, 1990, 45.0, 75.0, 5000.0), (None, 7, 1990, 40.0, 75.0, 5000.0)]
    kind = "city long, cell_id long, year_model int, built_threshold double, population_threshold double, cluster_threshold double"
    found = clusters.urban_neighbours(cells, spark.createDataFrame(chosen, kind), SETS, [1990, 2014])
    assert plan(found).count("Join") <= 2  # cells are not joined with their neighbours

    active = {(m[0], *m[2:]) for m in chosen if m[0] is not None}
    known = {m[0] for m in active}
    want = []
    for c, r, k in sorted(set(rows)):
        own = rows.count((c, r, k))
        near = [(c, *p) for p in around(r, k) if min(p) >= 0]
        links = sum(rows.count(p) for p in near)
        for y in (1990, 2014):
            for t in SETS:
                key = (y, float(t["built"]), float(t["population"]), float(t["cluster"]))
                n = sum(rows.count(p) * chosen.count((c, (p[1] << 20) + p[2], *key)) for p in near)
                value = own * n if links and (c, *key) in active else None
                want += [(c, (r << 20) + k, *key, value)] * (own * own if c in known else own)
    for cell in ((1, None), (None, 7)):
        want += [(*cell, y, float(t["built"]), float(t["population"]), float(t["cluster"]), None) for y in (1990, 2014) for t in SETS]
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, want))


def test_boundary_edges_across_blocks(spark):
    rng = random.Random(8)
    spots = [(g, r, c) for g in ("a", None) for r in range(58, 72) for c in range(60, 70) if rng.random() < 0.6]
    spots += [("a", 0, 0), ("a", 1, 0)] + spots[:7]
    cells = spark.createDataFrame([(*s, float(i)) for i, s in enumerate(spots)] + [("a", None, 3, 0.0)], "g string, row long, col long, tag double")
    found = dissolve.boundary_edges(cells, ["g"], ("tag",))
    assert "Generate explode(array(struct(" not in plan(found).replace("inline", "explode") and "MapInArrow" in plan(found)
    edges: dict = {}
    for i, (g, r, c) in enumerate(spots):
        x, y = 2 * c + r % 2, 3 * r + 2
        for (ax, ay), (bx, by) in zip(dissolve.CORNERS, dissolve.CORNERS[1:] + dissolve.CORNERS[:1]):
            e = (x + ax, y + ay, x + bx, y + by)
            edges.setdefault((g, *sorted((e[:2], e[2:]))), []).append((g, *e, float(i)))
    want = [v[0] for v in edges.values() if len(v) == 1]
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("by", [["g"], ["g", "h"]])
def test_small_groups_are_ranked_by_one_sort(spark, by):
    rng = random.Random(1)
    rows = [(rng.choice([1, 2, None]), rng.choice(["a", "b"]), None if i % 50 == 0 else rng.randrange(10**6)) for i in range(400)]
    df = spark.createDataFrame(rows, "g long, h string, v long")
    order = ([F.floor(F.col("v") / 1000)], [F.col("v")], "n")
    whole, parts = rank_within(df, by, *order), rank_within(df, by, *order, whole_rows=0)
    assert plan(whole).count("Window") == 1 and whole.schema == parts.schema
    key = lambda t: sorted(map(str, t.select("g", "h", "v", "n").collect()))
    assert key(whole) == key(parts)


def test_few_target_tiles_are_not_sorted(spark):
    boxes = spark.createDataFrame([(1, 0.0, 0.0, 3000.0, 2500.0), (2, 0.0, 0.0, 900.0, 500.0)], "city long, xmin double, ymin double, xmax double, ymax double")
    cells, rng = hexgrid.hex_grid(boxes, 125.0), random.Random(2)
    points = [(c, k, rng.uniform(-500, 3500), rng.uniform(-500, 3000)) for c in (1, 2) for k in ("p", "q") for _ in range(15)]
    found = nearest.nearest_point(cells, spark.createDataFrame(points, "city long, kind string, x double, y double"), 1000.0, ["kind"])
    assert "Window" not in plan(found)
    assert "MapInArrow" in plan(found)  # cells meet targets by block, in batches
    want = {(r["city"], k, r["cell_id"]): min(((r["cx"] - x) ** 2 + (r["cy"] - y) ** 2) ** 0.5 for c, q, x, y in points if (c, q) == (r["city"], k))
            for r in cells.collect() for k in ("p", "q")}
    got = {(r["city"], r["kind"], r["cell_id"]): r["distance"] for r in found.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)
