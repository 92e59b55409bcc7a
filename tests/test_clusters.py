"""Components, clusters, labels, dissolve, skew helpers."""

import random

import pytest
from pyspark.sql import functions as F

from cellscape.functions import geometry as g
from cellscape.operators import clusters as cl
from cellscape.operators import components, dissolve, features, raster, skew

SIDE = 10.0


def cells_of(spark, positions, city=1):
    b = g.apothem(SIDE)
    rows = [(city, (r << 20) + c, r, c, 2 * b * c + b * (r % 2), 1.5 * SIDE * r + SIDE) for r, c in positions]
    return spark.createDataFrame(rows, "city long, cell_id long, row long, col long, cx double, cy double")


def hex_links(r, c):
    s = r % 2
    return [(r, c - 1), (r, c + 1), (r - 1, c + s - 1), (r - 1, c + s), (r + 1, c + s - 1), (r + 1, c + s)]


def square_links(r, c):
    return [(r, c - 1), (r, c + 1), (r - 1, c), (r + 1, c)]


def brute_components(nodes, links, value=None):
    label = {}
    for start in sorted(nodes):
        if start in label:
            continue
        stack = [start]
        label[start] = start
        while stack:
            at = stack.pop()
            for n in links(*at):
                if n in nodes and n not in label and (value is None or value[n] == value[at]):
                    label[n] = start
                    stack.append(n)
    return label


@pytest.mark.parametrize("shape, links", [("hexagon", hex_links), ("square", square_links)])
def test_components_across_blocks(spark, shape, links):
    rng = random.Random(5)
    positions = {(r, c) for r in range(150) for c in range(140) if rng.random() < 0.62}
    value = {q: rng.random() < 0.8 for q in positions} if shape == "square" else None
    rows = [(k, r, c, int(value[r, c]) if value else 0) for k in (1, 2) for r, c in positions]
    nodes = spark.createDataFrame(rows, "k long, row long, col long, v long")
    found = components.connected_components(nodes, ["k"], shape, "label", same="v" if value else None).collect()
    want = brute_components(positions, links, value)
    assert len(found) == 2 * len(positions)
    assert all(f.label == (want[f.row, f.col][0] << 20) + want[f.row, f.col][1] for f in found)


def test_contraction_with_hot_nodes(spark):
    edges = [(1, i, 0) for i in range(1, 300)] + [(1, 1000 + i, 999 + i) for i in range(1, 60)] + [(1, 1000, 299)]
    df = spark.createDataFrame(edges, "k long, u long, v long")
    roots = {r.u: r.v for r in components.contract(df, ["k"], hot_rows=20).collect()}
    assert set(roots.values()) == {0} and len(roots) == 299 + 60


def test_counted_join_keeps_hot_rows(spark):
    big = spark.range(5000).select(F.when(F.col("id") < 2000, 7).otherwise(F.col("id") % 40).alias("k"), "id")
    small = big.groupBy("k").agg(F.count("*").alias("n")).withColumn("tag", F.col("k") * 2)
    got = skew.join_counted(big, small, ["k"], "n", hot_rows=100)
    assert got.count() == 5000 and got.where("tag <> k * 2").count() == 0 and got.select("id").distinct().count() == 5000


def test_rank_is_that_of_one_sorted_window(spark):
    rng = random.Random(2)
    keys = rng.sample(range(100000), 900)
    df = spark.createDataFrame([(k % 2, k) for k in keys], "g long, k long")
    got = skew.rank_within(df, ["g"], [F.floor(F.col("k") / 10000), F.floor(F.col("k") / 500)], [F.col("k")], "n").collect()
    for group in (0, 1):
        ordered = sorted((r.k, r.n) for r in got if r.g == group)
        assert [n for _, n in ordered] == list(range(1, len(ordered) + 1))


def test_ring_of_cells_is_one_cluster_with_a_hole(spark):
    ring = hex_links(4, 4)
    cells = cells_of(spark, ring + [(4, 4)])
    urban = cells.where(f"cell_id <> {(4 << 20) + 4}").withColumns(
        {"year_model": F.lit(1990), "built_threshold": F.lit(40.0), "population_threshold": F.lit(75.0)})
    members = cl.membership(urban)
    assert members.select("root").distinct().count() == 1 and members.count() == 6
    people = cells.select("city", "cell_id", F.lit(1990).alias("year_model"), F.lit(10.0).alias("mean_population")).unionByName(
        cells.select("city", "cell_id", F.lit(2000).alias("year_model"), F.lit(1.0).alias("mean_population")))
    summary = cl.cluster_summary(members, people).first()
    assert (summary.population, summary.n_cells, summary.cluster_id) == (66.0, 6, 1)
    assert cl.cluster_summary(members, people, all_years=False).first().population == 60.0
    chosen = cl.qualifying_members(members, cl.qualifying(cl.cluster_summary(members, people), [{"built": 40, "population": 75, "cluster": 50}]))
    far = {r.cell_id: r for r in cl.urban_distance(cells, chosen, SIDE, 50.0).collect()}
    middle = far[(4 << 20) + 4]
    assert middle.urban_flag == 0 and middle.urban_distance_km == pytest.approx(g.apothem(SIDE) / 1000)
    assert all(r.urban_flag == 1 and r.urban_distance_km == 0 for k, r in far.items() if k != (4 << 20) + 4)
    near = {r.cell_id: r.urban_neighbours for r in cl.urban_neighbours(
        cells, chosen, [{"built": 40, "population": 75, "cluster": 50}], [1990]).collect()}
    assert near[(4 << 20) + 4] == 6
    # the hole stays open: boundary has an outer and an inner ring, and the polygons keep the area
    edges = dissolve.boundary_edges(cells.where(f"cell_id <> {(4 << 20) + 4}"), ["city"])
    assert edges.count() == 18 + 6
    wkt = dissolve.dissolved_polygons(cells.where(f"cell_id <> {(4 << 20) + 4}"), ["city"], SIDE).first().wkt
    assert wkt.count("(") == 3


def test_two_blocks_one_cell_apart(spark):
    urban = cells_of(spark, [(0, 0), (0, 1), (0, 3), (0, 4)]).withColumns(
        {"year_model": F.lit(1990), "built_threshold": F.lit(40.0), "population_threshold": F.lit(75.0)})
    assert cl.membership(urban).select("root").distinct().count() == 2


def test_no_qualifying_cluster_gives_no_rows(spark):
    cells = cells_of(spark, [(0, 0), (0, 1)])
    urban = cells.withColumns(
        {"year_model": F.lit(2000), "built_threshold": F.lit(40.0), "population_threshold": F.lit(75.0)})
    people = cells.select("city", "cell_id", F.lit(2000).alias("year_model"), F.lit(1.0).alias("mean_population"))
    none = cl.qualifying(cl.cluster_summary(cl.membership(urban), people), [{"built": 40, "population": 75, "cluster": 1e12}])
    chosen = cl.qualifying_members(cl.membership(urban), none)
    assert cl.urban_distance(cells, chosen, SIDE, 50.0).count() == 0
    assert cl.next_period_labels(cells, chosen, [1990, 2000, 2014]).count() == 0
    one = [{"built": 40, "population": 75, "cluster": 0}]
    chosen = cl.qualifying_members(cl.membership(urban), cl.qualifying(cl.cluster_summary(cl.membership(urban), people), one))
    got = {(r.cell_id, r.year_model): r.label for r in cl.next_period_labels(cells, chosen, [1990, 2000, 2014]).collect()}
    assert got == {(0, 1990): 1, (1, 1990): 1}
    near = cl.urban_neighbours(cells_of(spark, [(0, 0), (0, 1), (9, 9)]), chosen, one, [1990, 2000]).collect()
    assert {(r.cell_id, r.year_model): r.urban_neighbours for r in near} == {
        (0, 1990): None, (1, 1990): None, ((9 << 20) + 9, 1990): None, (0, 2000): 1, (1, 2000): 1, ((9 << 20) + 9, 2000): None}


def pixels(spark, values, width=10.0):
    rows = [(1, width * (i + 0.5), width * (j + 0.5), float(v)) for (i, j), v in values.items()]
    return spark.createDataFrame(rows, "city long, x double, y double, val double")


def test_regions_join_along_edges_only(spark):
    got = raster.raster_regions(pixels(spark, {(0, 0): 1, (1, 0): 1, (0, 1): 1, (1, 1): 1, (2, 2): 1}), 10.0, 10.0)
    assert got.select("region_id").distinct().count() == 2


def test_slope_of_a_plane(spark):
    plane = {(i, j): 0.1 * 10 * (i + 0.5) for i in range(5) for j in range(5)}
    mid = raster.slope(pixels(spark, plane), 10.0, 10.0).where("x = 25 and y = 25").first()
    assert mid.slope_pct == pytest.approx(10.0) and mid.slope_degrees == pytest.approx(5.710593, abs=1e-6)


def test_zonal_modes_and_cells_without_pixels(spark):
    cells = cells_of(spark, [(0, 1), (0, 2), (40, 40)])
    values = {(i, j): 2.0 if i < 3 else 5.0 for i in range(6) for j in range(3)}
    args = (cells, pixels(spark, values), SIDE, 10.0, 10.0, {"val": "v"}, ["min", "max", "mean", "stddev", "sum"])
    by_pixel = {r.cell_id: r for r in raster.zonal_statistics(*args).collect()}
    by_region = {r.cell_id: r for r in raster.zonal_statistics(*args, mode="region").collect()}
    empty = by_pixel[(40 << 20) + 40]
    assert (empty.min_v, empty.mean_v, empty.stddev_v, empty.sum_v) == (None, None, None, None)
    assert by_region[(40 << 20) + 40].sum_v is None
    assert by_pixel[1].sum_v > by_region[1].sum_v
    assert by_region[1].sum_v in (2.0, 7.0) and by_region[2].sum_v == 7.0 or by_region[2].sum_v == 5.0
    for r in by_pixel.values():
        assert r.mean_v is None or r.min_v <= r.mean_v <= r.max_v


def test_feature_names_without_a_layer_are_rejected(spark):
    with pytest.raises(ValueError, match="built_flag"):
        features.features_wide({}, None, ["built_flag"], {}, {})


def test_result_does_not_depend_on_partitions(spark, sf):
    from catalog.queries import make_cells

    a = sorted(map(tuple, make_cells(spark, sf).select("city", "cell_id").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    b = sorted(map(tuple, make_cells(spark, sf).select("city", "cell_id").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert a == b
