"""Registered queries: each is a function ``(spark, sf) -> DataFrame`` with the SQL it must match.

Stages that the design stores (clipped grid, clusters, features, labels) are written once per session
and read by the queries after them; the queries named after those stages compute them afresh.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import expected as x
from catalog.derive import DEM_PIXEL, PIXEL, SIDE, TILE, YEARS, layer, number, table
from catalog.derive import LAYERS as LAYER_SQL
from cellscape import config
from cellscape.functions import geometry as g
from cellscape.functions import projection
from cellscape.functions.keys import canonical_json, canonical_list, fingerprint
from cellscape.operators import clusters as cl
from cellscape.operators import distances, dissolve, evaluate, features, hexgrid, knn, models, osm, raster
from cellscape.operators.bayes import GaussianNB
from cellscape.operators.forest import Rules, grow
from cellscape.operators.skew import join_dimension, rank_within
from cellscape.plans import experiment, runs
from cellscape.session import configure, materialize, materialize_once, shared_folder
from cellscape.sources import readers, schemas, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

THRESHOLDS = [
    {"built": 40, "population": 75, "cluster": 5000},
    {"built": 50, "population": 120, "cluster": 12000},
]
YEARLY = {
    "built": ("pixels", "built", "built_lds", ["min", "max", "mean", "stddev", "sum"], config.YEAR_MAP["built_lds"]),
    "population": ("population_pixels", "population", "population", ["min", "max", "mean", "stddev", "sum"],
                   config.YEAR_MAP["population"]),
    "settlements": ("settlement_pixels", "settlements", "settlements", ["min", "max", "mean", "sum"],
                    config.YEAR_MAP["settlements"]),
    "lights": ("light_pixels", "lights", "city_lights", ["min", "max", "mean", "stddev", "sum"],
               config.YEAR_MAP["city_lights"]),
}


def query(name: str, sql: str | None = None):
    """Register a query; ``{block}`` in the SQL names a building block."""

    def register(function):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return function(configure(spark), sf)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = x.build(sql)
        return function

    return register


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to ``places`` digits, sums to 4: engines add up in different orders."""
    return df.select(*[
        F.round(c, 4 if c.startswith("sum_") else places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def round_all(columns: list[str], places: int = 6) -> str:
    return ", ".join(f"round({c}, {places}) AS {c}" for c in columns)


def dealt(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt out by a key: a table of short rows is read by one task, which should not make all their rings."""
    return df.repartition(key)


# ----- shared stages --------------------------------------------------------------------------

def area_rings(spark, sf):
    h, c = F.col("half"), 0.45 * F.col("half")
    corners = [(h, -c), (h, c), (c, h), (-c, h), (-h, c), (-h, -c), (-c, -h), (c, -h)]
    return dealt(layer(spark, sf, "city"), "city").select(
        "city", F.array(*[g.point(5000 + dx, 5000 + dy) for dx, dy in corners]).alias("ring"))


def make_cells(spark, sf):
    return hexgrid.clip_to_areas(hexgrid.hex_grid(layer(spark, sf, "boxes"), SIDE), area_rings(spark, sf), SIDE)


def cells(spark, sf):
    return materialize_once(spark, f"{sf}/cells", lambda: make_cells(spark, sf))


def pixel_layer(spark, sf, source):
    """A yearly pixel layer over the stored pixels, so that the line items are averaged once for all layers."""
    pixels = materialize_once(spark, f"{sf}/pixels", lambda: layer(spark, sf, "pixels"))
    return pixels if source == "pixels" else spark.sql(LAYER_SQL[source], pixels=pixels)


def zonal(spark, sf, name, mode="pixel"):
    source, column, suffix, stats, years = YEARLY[name]
    return raster.zonal_statistics(
        cells(spark, sf), pixel_layer(spark, sf, source), SIDE, PIXEL, PIXEL, {column: suffix}, stats, years, mode)


def stored_zonal(spark, sf, name):
    return materialize_once(spark, f"{sf}/zonal-{name}", lambda: zonal(spark, sf, name))


def make_members(spark, sf):
    return cl.membership(cl.urban_cells(
        cells(spark, sf), stored_zonal(spark, sf, "built"), stored_zonal(spark, sf, "population"), THRESHOLDS))


def members(spark, sf):
    return materialize_once(spark, f"{sf}/members", lambda: make_members(spark, sf))


def clusters(spark, sf):
    return cl.cluster_summary(members(spark, sf), stored_zonal(spark, sf, "population"))


def chosen(spark, sf):
    return materialize_once(spark, f"{sf}/chosen", lambda: cl.qualifying_members(
        members(spark, sf), cl.qualifying(clusters(spark, sf), THRESHOLDS)))


def way_nodes(spark, sf):
    """Way positions; a real extract has them in its node lists."""
    return materialize_once(spark, f"{sf}/way-nodes", lambda: rank_within(
        layer(spark, sf, "way_rows"), ["osmid"], [F.floor(F.col("l_orderkey") / 4096)],
        [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")], "pos").select("osmid", "city", "pos", "node"))


def road_segments(spark, sf):
    tags = layer(spark, sf, "way_tags").where(osm.is_road(F.col("highway"), F.col("area")))
    kept = materialize(osm.keep_ways(way_nodes(spark, sf), tags), "kept-ways")  # read for references and places
    return osm.way_segments(kept.drop("city"), layer(spark, sf, "nodes").select("node", "city", "x", "y"))


def water_rings(spark, sf):
    w, k, y0, r = dealt(layer(spark, sf, "water"), "fid"), F.col("wx"), F.col("wy"), F.col("half")
    box = g.box_ring(k - r, y0 - r, k + r, y0 + r)
    diamond = F.array(g.point(k + r, y0), g.point(k, y0 + r), g.point(k - r, y0), g.point(k, y0 - r))
    return w.select("city", "fid", F.when(F.col("shape") == "box", box).otherwise(diamond).alias("ring"))


def centres(spark, sf):
    return dealt(layer(spark, sf, "city"), "city").select(
        "city", g.circle_ring(5000.0 + F.col("city") % 7 * 40, F.lit(5000.0), F.lit(300.0)).alias("ring"))


def slope_pixels(spark, sf):
    return raster.slope(layer(spark, sf, "dem"), DEM_PIXEL, DEM_PIXEL)


def cell_slope(spark, sf):
    return raster.zonal_statistics(
        cells(spark, sf), slope_pixels(spark, sf), SIDE, DEM_PIXEL, DEM_PIXEL,
        {"slope_pct": "slope_pct", "slope_degrees": "slope_degrees"}, ["min", "max", "mean", "stddev"])


LAYERS = {
    "highways": lambda spark, sf: distances.highways(cells(spark, sf), road_segments(spark, sf), TILE),
    "slope": cell_slope,
    "geopins": lambda spark, sf: distances.geopins(cells(spark, sf), layer(spark, sf, "points"), TILE),
    "water_bodies": lambda spark, sf: distances.water_bodies(cells(spark, sf), water_rings(spark, sf), TILE),
    "city_center": lambda spark, sf: hexgrid.centre_distance(cells(spark, sf), centres(spark, sf)),
    "urban_distance": lambda spark, sf: cl.urban_distance(cells(spark, sf), chosen(spark, sf), SIDE, TILE),
}

LAYERS_AT_ONCE = 3  # jobs of so many layers share the cluster


def stored_layer(spark, sf, name):
    return materialize_once(spark, f"{sf}/layer-{name}", lambda: LAYERS[name](spark, sf))


def make_features(spark, sf, **replaced):
    """The feature join over the stored layer tables.

    Layers do not need each other, so some are built at once, the longest way (clusters, then distances to them) first.
    """
    yearly = {"population": "population", "built_lds": "built", "city_lights": "lights"}
    names = [name for name in [*reversed(LAYERS), *yearly] if name not in replaced]

    def stored(name):
        return stored_zonal(spark, sf, yearly[name]) if name in yearly else stored_layer(spark, sf, name)

    with ThreadPoolExecutor(LAYERS_AT_ONCE) as pool:
        layers = dict(zip(names, pool.map(stored, names))) | replaced
    urban = layers.pop("urban_distance")
    return features.features_wide(layers, urban, config.DEFAULT_FEATURES, *THRESHOLDS)


def stored_features(spark, sf):
    return materialize_once(spark, f"{sf}/features", lambda: make_features(spark, sf))


def labels(spark, sf):
    urban = chosen(spark, sf).where(F.col("built_threshold") == 40.0)
    return cl.next_period_labels(cells(spark, sf), urban, YEARS)


def stored_labels(spark, sf):
    return materialize_once(spark, f"{sf}/labels", lambda: labels(spark, sf))


def training(spark, sf, years=None):
    """The stored frame: a fit reads its rows many times, and should not join features and labels each time."""
    years = years or config.YEARS_TRAIN
    return materialize_once(spark, f"{sf}/training-{'-'.join(map(str, years))}", lambda: models.assemble(
        features.training_frame(stored_features(spark, sf), stored_labels(spark, sf), years, config.DEFAULT_FEATURES),
        config.DEFAULT_FEATURES))


def cell_scores(spark, sf):
    c = cells(spark, sf).select("city", "cell_id", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(5).cast("long"))).alias("model_id"))
    mixed = ((F.col("cell_id") % 100003) * 37 + F.col("model_id") * 11 + F.col("city") * 13) % 1000
    return c.withColumn("score", F.round(mixed / 1000, 5))


def city_evaluations(spark, sf):
    counted = evaluate.confusion_by_cutoff(layer(spark, sf, "scored"), ["city", "model_id"])
    long = evaluate.long_metrics(evaluate.with_metrics(counted), ["city", "model_id"])
    kind = F.when(F.col("model_id") <= 2, "RandomForest").when(F.col("model_id") <= 4, "ExtraTrees").otherwise(
        "LogisticRegression")
    return long.withColumn("model_type", kind)


def best_models(spark, sf):
    return evaluate.best_per_group(city_evaluations(spark, sf), ["city", "model_type"])


# ----- grid -----------------------------------------------------------------------------------

@query("hex_grid", 'SELECT city, cell_id, "row", "col", round(cx, 6) AS cx, round(cy, 6) AS cy FROM {grid_all}')
def _(spark, sf):
    return rounded(hexgrid.hex_grid(layer(spark, sf, "boxes"), SIDE))


@query("grid_clip", 'SELECT city, cell_id, "row", "col", round(cx, 6) AS cx, round(cy, 6) AS cy FROM {grid}')
def _(spark, sf):
    return rounded(make_cells(spark, sf))


@query("hex_adjacency", "SELECT city, cell_id, neighbour_id FROM {adjacent}")
def _(spark, sf):
    return hexgrid.adjacency(cells(spark, sf))


_CORNER_TEXT = ", ', ', ".join(
    f"format('{{:.3f}} {{:.3f}}', cx + {number(dx)}, cy + {number(dy)})" for dx, dy in [*x._CORNERS, x._CORNERS[0]])


@query("hex_wkt", f"SELECT city, cell_id, concat('POLYGON((', {_CORNER_TEXT}, '))') AS wkt FROM " + "{grid}")
def _(spark, sf):
    return hexgrid.with_wkt(cells(spark, sf), SIDE).select("city", "cell_id", "wkt")


@query("layer_bbox", "SELECT city, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM {points} GROUP BY city")
def _(spark, sf):
    return hexgrid.layer_bounds(layer(spark, sf, "points"), ["city"])


@query("buffer_ring", """
    SELECT city, i AS corner, round(lon + 0.01e0 * cos(i * 2 * pi() / 32), 6) AS x, round(lat + 0.01e0 * sin(i * 2 * pi() / 32), 6) AS y
    FROM (SELECT s_suppkey AS city, 36e0 + (s_suppkey * 7919) % 10007 / 100000e0 AS lon,
                 32e0 + (s_suppkey * 104729) % 10007 / 100000e0 AS lat, CAST(unnest(range(0, 32)) AS INT) AS i FROM supplier) c""")
def _(spark, sf):
    k = F.col("s_suppkey")
    lon, lat = 36 + k * 7919 % 10007 / 100000, 32 + k * 104729 % 10007 / 100000
    ring = table(spark, sf, "supplier").select(k.alias("city"), F.posexplode(g.circle_ring(lon, lat, F.lit(0.01))).alias("corner", "p"))
    return rounded(ring.select("city", "corner", "p.x", "p.y"))


# ----- sources --------------------------------------------------------------------------------

def long_pixels(spark, sf):
    """All yearly layers as one long table ``(city, layer, year, x, y, val)``."""
    wide = layer(spark, sf, "pixels")
    stack = F.array(*[F.struct(F.lit(n).alias("layer"), F.col(c).alias("val")) for n, c in
                      [("built_lds", "built"), ("population", "population"), ("settlements", "settlements"), ("city_lights", "lights")]])
    return wide.select("city", "year", "x", "y", F.explode(stack).alias("l")).select("city", "l.layer", "year", "x", "y", "l.val")


@query("scan_pixels", """
    SELECT city, 'population' AS layer, year, x, y, round(population, 6) AS val FROM {pixels} WHERE year IN (1990, 2000)""")
def _(spark, sf):
    path = experiment.stored_path(spark, f"{sf}/long-pixels", lambda: long_pixels(spark, sf), ["layer", "year"])
    return rounded(readers.pixels(spark, path, "population", [1990, 2000]).select("city", "layer", "year", "x", "y", "val"))


@query("scan_dem", "SELECT city, x, y, round(val, 6) AS val FROM {dem}")
def _(spark, sf):
    return rounded(layer(spark, sf, "dem"))


@query("scan_points", "SELECT fid, city, amenity, aeroway, x, y FROM {points}")
def _(spark, sf):
    return layer(spark, sf, "points")


@query("scan_wkt", """
    SELECT city, fid, i AS corner, CASE WHEN shape = 'box' THEN wx + half * CASE WHEN i IN (1, 2) THEN 1 ELSE -1 END
                                         ELSE wx + half * CASE i WHEN 0 THEN 1 WHEN 2 THEN -1 WHEN 4 THEN 1 ELSE 0 END END AS x,
           CASE WHEN shape = 'box' THEN wy + half * CASE WHEN i IN (2, 3) THEN 1 ELSE -1 END
                ELSE wy + half * CASE i WHEN 1 THEN 1 WHEN 3 THEN -1 ELSE 0 END END AS y
    FROM (SELECT city, fid, shape, wx, wy, half, CAST(unnest(range(0, 5)) AS INT) AS i FROM {water}) w""")
def _(spark, sf):
    text = water_rings(spark, sf).select("city", "fid", g.ring_wkt(F.col("ring")).alias("wkt"))
    return readers.wkt_layer(text).select("city", "fid", F.posexplode("coords").alias("corner", "p")).select(
        "city", "fid", "corner", "p.x", "p.y")


# an outer box, a hole of half its size, and for every third shape a second part
@query("scan_wkt_parts", """
    SELECT city, fid, part, ring, i AS corner,
           wx + dx + size * CASE WHEN (ring = 0 AND i IN (1, 2)) OR (ring = 1 AND i IN (2, 3)) THEN 1 ELSE -1 END AS x,
           wy + size * CASE WHEN (ring = 0 AND i IN (2, 3)) OR (ring = 1 AND i IN (1, 2)) THEN 1 ELSE -1 END AS y
    FROM (SELECT city, fid, wx, wy, CAST(part AS INT) AS part, CAST(ring AS INT) AS ring, part * 10 * half AS dx, half / (1 + ring) AS size,
                 CAST(unnest(range(0, 5)) AS INT) AS i
          FROM {water} CROSS JOIN (VALUES (0, 0), (0, 1), (1, 0)) t(part, ring) WHERE part = 0 OR fid % 3 = 0) w""")
def _(spark, sf):
    x0, y0, r = F.col("wx"), F.col("wy"), F.col("half")

    def body(x, size):
        return F.regexp_extract(g.ring_wkt(g.box_ring(x - size, y0 - size, x + size, y0 + size)), r"\((\(.*\))\)", 1)

    second = F.when(F.col("fid") % 3 == 0, F.concat(F.lit(", ("), body(x0 + 10 * r, r), F.lit(")"))).otherwise("")
    text = F.concat(F.lit("MULTIPOLYGON(("), body(x0, r), F.lit(", "), body(x0, r / 2), F.lit(")"), second, F.lit(")"))
    path = f"{shared_folder(spark)}/wkt-{uuid.uuid4().hex}"
    layer(spark, sf, "water").select("city", "fid", text).write.csv(path, sep="\t")
    return readers.wkt_file(spark, path, "city long, fid long").select(
        "city", "fid", "part", "ring", F.posexplode("coords").alias("corner", "p")).select(
        "city", "fid", "part", "ring", "corner", "p.x", "p.y")


@query("first_link_per_year", "SELECT year, arg_min(link, line_no) AS link FROM {links} GROUP BY year")
def _(spark, sf):
    return readers.first_link_per_year(layer(spark, sf, "links"))


@query("bbox_from_json", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS bbox_west, CAST(json_extract(props, '$.k') AS DOUBLE) + 1 AS bbox_east,
           CAST(event_id % 90 AS DOUBLE) AS bbox_south, CAST(event_id % 90 AS DOUBLE) + 1 AS bbox_north FROM events""")
def _(spark, sf):
    k = F.get_json_object("props", "$.k").cast("double")
    lat = (F.col("event_id") % 90).cast("double")
    text = F.to_json(F.struct(k.alias("bbox_west"), lat.alias("bbox_south"), (k + 1).alias("bbox_east"), (lat + 1).alias("bbox_north")))
    boxes = table(spark, sf, "events").select("event_id", text.alias("box"))
    return readers.bounding_boxes(boxes, "box").drop("box")


_CITY_ROWS = ", ".join(
    f"({i}, '{n}', {number(c['longitude'])}, {number(c['latitude'])}, {c['srid']}, {number(float(c['buffer_dist']))})"
    for i, (n, c) in enumerate(config.CITIES.items()))


@query("dim_city", f"""
    SELECT k.s_suppkey AS city, p.name AS settings, p.lon, p.lat, p.srid, p.buffer_m
    FROM supplier k JOIN (VALUES {_CITY_ROWS}) p(i, name, lon, lat, srid, buffer_m) ON p.i = k.s_nationkey % 6""")
def _(spark, sf):
    return experiment.with_city_settings(
        table(spark, sf, "supplier").select(F.col("s_suppkey").alias("city"), (F.col("s_nationkey") % 6).alias("i")))


@query("year_map", """
    SELECT m.layer, l.year AS year_data, m.year_model, count(*) AS n_rows
    FROM (SELECT CAST(CASE WHEN year(l_shipdate) <= 1993 THEN 1990 WHEN year(l_shipdate) <= 1995 THEN 1995
                      WHEN year(l_shipdate) <= 1998 THEN 2000 WHEN year(l_shipdate) <= 2000 THEN 2013 WHEN l_linenumber > 3 THEN 2014
                      ELSE 2015 END AS INT) AS year FROM lineitem) l
    JOIN (VALUES ('built_lds', 1990, 1990), ('built_lds', 2000, 2000), ('built_lds', 2014, 2014),
                 ('city_lights', 1995, 1990), ('city_lights', 2000, 2000), ('city_lights', 2013, 2014),
                 ('population', 1990, 1990), ('population', 2000, 2000), ('population', 2015, 2014),
                 ('settlements', 1990, 1990), ('settlements', 2000, 2000), ('settlements', 2015, 2014)) m(layer, year_data, year_model)
      ON m.year_data = l.year GROUP BY ALL""")
def _(spark, sf):
    y = F.year("l_shipdate")
    year = (F.when(y <= 1993, 1990).when(y <= 1995, 1995).when(y <= 1998, 2000).when(y <= 2000, 2013)
            .when(F.col("l_linenumber") > 3, 2014).otherwise(2015))
    rows = table(spark, sf, "lineitem").groupBy(year.alias("year_data")).agg(F.count("*").alias("n"))
    return experiment.with_model_year(rows).groupBy("layer", "year_data", "year_model").agg(F.sum("n").alias("n_rows"))


# ----- raster ---------------------------------------------------------------------------------

@query("cell_pixel_intersects", f"""
    SELECT g.city, g.cell_id, p.year, p.x, p.y FROM {{grid}} g JOIN {{pixels}} p ON p.city = g.city AND {x.meets(125)}""")
def _(spark, sf):
    return raster.intersecting_pixels(
        cells(spark, sf), layer(spark, sf, "pixels").select("city", "year", "x", "y"), SIDE, PIXEL, PIXEL, YEARS
    ).select("city", "cell_id", "year", "x", "y")


def _register_zonal(name: str, block: str) -> None:
    @query(f"zonal_{name}", f"SELECT * FROM {{{block}}}")
    def _(spark, sf):
        return rounded(zonal(spark, sf, name))


for _name, _block in [("built", "built"), ("population", "people"), ("settlements", "settled"), ("lights", "lit")]:
    _register_zonal(_name, _block)


@query("zonal_dem", "SELECT * FROM {height}")
def _(spark, sf):
    return rounded(raster.zonal_statistics(
        cells(spark, sf), layer(spark, sf, "dem"), SIDE, DEM_PIXEL, DEM_PIXEL, {"val": "dem"}, ["min", "max", "mean", "stddev"]))


@query("slope_raster", f"SELECT city, x, y, {round_all(['slope_pct', 'slope_degrees'])} FROM {{steepness}}")
def _(spark, sf):
    return rounded(slope_pixels(spark, sf))


@query("zonal_slope", "SELECT * FROM {cell_slope}")
def _(spark, sf):
    return rounded(cell_slope(spark, sf))


@query("raster_regions", "SELECT city, year, x, y, val, region_id FROM {regions_settlements}")
def _(spark, sf):
    return raster.raster_regions(
        layer(spark, sf, "pixels").select("city", "year", "x", "y", F.col("settlements").alias("val")), PIXEL, PIXEL)


_SAME_YEARS = {y: y for y in YEARS}


@query("zonal_built_region", x.region_zonal("built_step", "built_lds", ["min", "max", "mean", "stddev", "sum"]))
def _(spark, sf):
    return rounded(raster.zonal_statistics(
        cells(spark, sf), layer(spark, sf, "pixels"), SIDE, PIXEL, PIXEL, {"built_step": "built_lds"},
        ["min", "max", "mean", "stddev", "sum"], _SAME_YEARS, "region"))


@query("zonal_settlements_region", x.region_zonal("settlements", "settlements", ["min", "max", "mean", "sum"]))
def _(spark, sf):
    return rounded(raster.zonal_statistics(
        cells(spark, sf), layer(spark, sf, "pixels"), SIDE, PIXEL, PIXEL, {"settlements": "settlements"},
        ["min", "max", "mean", "sum"], _SAME_YEARS, "region"))


@query("raster_clip", """
    SELECT p.city, p.year, p.x, p.y, round(p.built, 6) AS built FROM {pixels} p JOIN {city} c ON c.city = p.city
    WHERE abs(x - 5000) <= half AND abs(y - 5000) <= half AND abs(x - 5000) + abs(y - 5000) <= 1.45e0 * half""")
def _(spark, sf):
    p = layer(spark, sf, "pixels").select("city", "year", "x", "y", "built")
    return rounded(raster.clip_raster(p, area_rings(spark, sf), TILE))


_Z = projection.ZONES[32237]
_E2 = _Z.e2
_EP2 = _E2 / (1 - _E2)
_E1 = (1 - (1 - _E2) ** 0.5) / (1 + (1 - _E2) ** 0.5)
_n = number
INVERSE_BLOCKS = {
    "targets": "SELECT city, year, x, y, 235000e0 + x + city % 50 * 20 AS u, 3574000e0 + y + city * 7 AS v FROM {pixels}",
    "inverse1": f"""
        SELECT *, mu + {_n(3 * _E1 / 2 - 27 * _E1**3 / 32)} * sin(2 * mu) + {_n(21 * _E1**2 / 16 - 55 * _E1**4 / 32)} * sin(4 * mu)
               + {_n(151 * _E1**3 / 96)} * sin(6 * mu) + {_n(1097 * _E1**4 / 512)} * sin(8 * mu) AS f1
        FROM (SELECT *, v / {_n(_Z.scale)} / {_n(_Z.a * (1 - _E2 / 4 - 3 * _E2**2 / 64 - 5 * _E2**3 / 256))} AS mu FROM {{targets}}) m""",
    "inverse2": f"""
        SELECT *, {_n(_Z.a)} / sqrt(w) AS n1, {_n(_Z.a * (1 - _E2))} / (w * sqrt(w)) AS r1,
               tan(f1) * tan(f1) AS t1, {_n(_EP2)} * cos(f1) * cos(f1) AS c1,
               (u - 500000) / ({_n(_Z.a)} / sqrt(w) * {_n(_Z.scale)}) AS d
        FROM (SELECT *, 1 - {_n(_E2)} * sin(f1) * sin(f1) AS w FROM {{inverse1}}) m""",
    "inverse": f"""
        SELECT city, year, x, y,
               39 + degrees((d - (1 + 2 * t1 + c1) * d ** 3 / 6
                 + (5 - 2 * c1 + 28 * t1 - 3 * c1 * c1 + 8 * {_n(_EP2)} + 24 * t1 * t1) * d ** 5 / 120) / cos(f1)) AS lon,
               degrees(f1 - n1 * tan(f1) / r1 * (d * d / 2 - (5 + 3 * t1 + 10 * c1 - 4 * c1 * c1 - 9 * {_n(_EP2)}) * d ** 4 / 24
                 + (61 + 90 * t1 + 298 * c1 + 45 * t1 * t1 - 252 * {_n(_EP2)} - 3 * c1 * c1) * d ** 6 / 720)) AS lat
        FROM {{inverse2}}""",
    # source raster in degrees: 200 x 200 pixels of 0.0005 degrees, values from order prices
    "degree_pixels": """
        SELECT CAST(o_orderkey % 200 AS BIGINT) AS sx, CAST(floor(o_orderkey / 200) % 200 AS BIGINT) AS sy,
               round(avg(o_totalprice), 2) AS val FROM {orders} GROUP BY 1, 2""",
}
x.EXPECTED.update(INVERSE_BLOCKS)


@query("raster_reproject", """
    SELECT i.city, i.year, i.x, i.y, i.sx, i.sy, s.val
    FROM (SELECT *, CAST(floor((lon - 36.2e0) / 0.0005e0) AS BIGINT) AS sx, CAST(floor((lat - 32.3e0) / 0.0005e0) AS BIGINT) AS sy
          FROM {inverse}) i JOIN {degree_pixels} s ON s.sx = i.sx AND s.sy = i.sy""")
def _(spark, sf):
    source = spark.sql(INVERSE_BLOCKS["degree_pixels"], orders=table(spark, sf, "orders"))
    targets = spark.sql(INVERSE_BLOCKS["targets"], pixels=layer(spark, sf, "pixels"))
    found = raster.resample_nearest(
        projection.with_geographic(targets, _Z, "u", "v", "lon", "lat"), source, 36.2, 32.3, 0.0005)
    return found.select("city", "year", "x", "y", "sx", "sy", "val")


# ----- distances ------------------------------------------------------------------------------

@query("water_distance", "SELECT city, cell_id, round(water_bodies_distance_km, 6) AS water_bodies_distance_km, water_bodies_flag FROM {water_distance}")
def _(spark, sf):
    return rounded(distances.water_bodies(cells(spark, sf), water_rings(spark, sf), TILE))


@query("highway_distance", "SELECT city, cell_id, round(distance_highways_km, 6) AS distance_highways_km FROM {road_distance}")
def _(spark, sf):
    return rounded(distances.highways(cells(spark, sf), road_segments(spark, sf), TILE))


@query("geopin_distances", f"SELECT city, cell_id, {round_all(list(distances.PIN_COLUMNS.values()))} FROM {{pin_distance}}")
def _(spark, sf):
    return rounded(distances.geopins(cells(spark, sf), layer(spark, sf, "points"), TILE))


@query("center_distance", "SELECT city, cell_id, round(city_center_distance_km, 6) AS city_center_distance_km FROM {centre}")
def _(spark, sf):
    return rounded(hexgrid.centre_distance(cells(spark, sf), centres(spark, sf)))


_PAIR = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_partkey AS DOUBLE) AS px, l_quantity * 10 AS py,
    CAST(l_suppkey AS DOUBLE) AS x1, l_discount * 1000 AS y1, CAST(l_linenumber * 100 AS DOUBLE) AS x2, l_tax * 1000 AS y2 FROM {lineitem}"""
x.EXPECTED["segment_pairs"] = _PAIR
_IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_T = ("greatest(0e0, least(1e0, coalesce(((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / "
      "nullif((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1), 0), 0e0)))")


@query("distance_functions", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           round(sqrt((px - x1) * (px - x1) + (py - y1) * (py - y1)), 6) AS to_point,
           round({x.segment_distance('px', 'py')}, 6) AS to_segment,
           round({x.hexagon_distance().replace('u.cx', 'px').replace('u.cy', 'py').replace('m.cx', 'x1').replace('m.cy', 'y1')}, 6) AS to_hexagon
    FROM {{segment_pairs}}""")
def _(spark, sf):
    d = spark.sql(_PAIR, lineitem=table(spark, sf, "lineitem"))
    c = {n: F.col(n) for n in ("px", "py", "x1", "y1", "x2", "y2")}
    return rounded(d.select(
        *_IDS, g.point_distance(c["px"], c["py"], c["x1"], c["y1"]).alias("to_point"),
        g.segment_distance(*c.values()).alias("to_segment"),
        g.hexagon_distance(c["px"], c["py"], c["x1"], c["y1"], SIDE).alias("to_hexagon")))


@query("closest_point", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(x1 + {_T} * (x2 - x1), 6) AS qx, round(y1 + {_T} * (y2 - y1), 6) AS qy
    FROM {{segment_pairs}}""")
def _(spark, sf):
    d = spark.sql(_PAIR, lineitem=table(spark, sf, "lineitem"))
    qx, qy = g.closest_point(*[F.col(n) for n in ("px", "py", "x1", "y1", "x2", "y2")])
    return rounded(d.select(*_IDS, qx.alias("qx"), qy.alias("qy")))


# ----- projections ----------------------------------------------------------------------------

_LONLAT = """SELECT c_custkey, lon0 + (c_custkey * 7919 % 10007) / 5000e0 - 1 AS lon, -10e0 + (c_custkey * 104729 % 10007) / 200e0 AS lat, srid
    FROM (SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN -9 WHEN 1 THEN 33 WHEN 2 THEN 39 ELSE 117 END AS lon0,
                 CASE c_nationkey % 4 WHEN 0 THEN 32229 WHEN 1 THEN 32236 WHEN 2 THEN 32237 ELSE 23890 END AS srid FROM {customer}) c"""


def _forward_sql(code: int) -> str:
    z = projection.ZONES[code]
    e2, ep2 = z.e2, z.e2 / (1 - z.e2)
    m0, m2, m4, m6 = (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256, 3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024,
                      15 * e2**2 / 256 + 45 * e2**3 / 1024, 35 * e2**3 / 3072)
    return f"""
        SELECT c_custkey, srid, lon, lat,
               500000 + {_n(z.scale)} * n * (a + (1 - t + c) * a ** 3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * {_n(ep2)}) * a ** 5 / 120) AS x,
               {_n(z.false_northing)} + {_n(z.scale)} * ({_n(z.a)} * ({_n(m0)} * f - {_n(m2)} * sin(2 * f) + {_n(m4)} * sin(4 * f) - {_n(m6)} * sin(6 * f))
                 + n * tan(f) * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * a ** 4 / 24
                                 + (61 - 58 * t + t * t + 600 * c - 330 * {_n(ep2)}) * a ** 6 / 720)) AS y
        FROM (SELECT *, radians(lat) AS f, {_n(z.a)} / sqrt(1 - {_n(e2)} * sin(radians(lat)) ** 2) AS n, tan(radians(lat)) ** 2 AS t,
                     {_n(ep2)} * cos(radians(lat)) ** 2 AS c, radians(lon - {_n(z.meridian)}) * cos(radians(lat)) AS a
              FROM {{lonlat}} WHERE srid = {code}) p"""


x.EXPECTED["lonlat"] = _LONLAT
x.EXPECTED["utm"] = " UNION ALL ".join(_forward_sql(c) for c in projection.ZONES)


@query("project_utm", "SELECT c_custkey, srid, round(x, 4) AS x, round(y, 4) AS y FROM {utm}")
def _(spark, sf):
    d = spark.sql(_LONLAT, customer=table(spark, sf, "customer"))
    px, py = projection.project_by_zone(F.col("srid"), F.col("lon"), F.col("lat"))
    return rounded(d.select("c_custkey", "srid", px.alias("x"), py.alias("y")), 4)


_R = number(projection.MOLLWEIDE_RADIUS)


@query("project_mollweide", f"""
    SELECT c_custkey, round(2 * sqrt(2e0) / pi() * {_R} * radians(lon) * cos(theta), 4) AS x, round(sqrt(2e0) * {_R} * sin(theta), 4) AS y,
           round(lon, 6) AS lon, round(lat, 6) AS lat
    FROM (SELECT *, list_reduce(list_concat([radians(lat)], list_transform(range(0, 12), lambda i: radians(lat))),
                  lambda t, f: t - (2 * t + sin(2 * t) - pi() * sin(f)) / (2 + 2 * cos(2 * t))) AS theta FROM {{lonlat}}) m""")
def _(spark, sf):
    d = spark.sql(_LONLAT, customer=table(spark, sf, "customer"))
    mx, my = projection.to_mollweide(F.col("lon"), F.col("lat"))
    there = d.select("c_custkey", mx.alias("mx"), my.alias("my"))
    lon, lat = projection.from_mollweide(F.col("mx"), F.col("my"))
    return there.select("c_custkey", F.round("mx", 4).alias("x"), F.round("my", 4).alias("y"),
                        F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


# ----- clusters -------------------------------------------------------------------------------

@query("urban_cells", "SELECT city, year_model, built_threshold, population_threshold, cell_id FROM {urban}")
def _(spark, sf):
    return cl.urban_cells(
        cells(spark, sf), zonal(spark, sf, "built"), zonal(spark, sf, "population"), THRESHOLDS
    ).select(*cl.CLUSTER_KEY, "cell_id")


@query("urban_clusters", "SELECT city, year_model, built_threshold, population_threshold, cell_id, root FROM {members}")
def _(spark, sf):
    return make_members(spark, sf).select(*cl.CLUSTER_KEY, "cell_id", "root")


@query("cluster_population", """
    SELECT city, year_model, built_threshold, population_threshold, cluster_id, root, n_cells, round(population, 4) AS population FROM {clusters}""")
def _(spark, sf):
    return rounded(clusters(spark, sf), 4)


@query("cluster_population_year", """
    SELECT m.city, m.year_model, m.built_threshold, m.population_threshold, m.root, count(*) AS n_cells,
           round(sum(p.mean_population), 4) AS population
    FROM {members} m JOIN {people_exact} p ON p.city = m.city AND p.cell_id = m.cell_id AND p.year_model = m.year_model GROUP BY ALL""")
def _(spark, sf):
    return rounded(cl.cluster_summary(
        members(spark, sf), stored_zonal(spark, sf, "population"), all_years=False).drop("cluster_id"), 4)


@query("qualifying_clusters", """
    SELECT city, year_model, built_threshold, population_threshold, cluster_threshold, cluster_id, n_cells, round(population, 4) AS population FROM {qualified}""")
def _(spark, sf):
    return rounded(cl.qualifying(clusters(spark, sf), THRESHOLDS).drop("root"), 4)


_URBAN_OUT = """SELECT city, cell_id, year_model, built_threshold, population_threshold, cluster_threshold, urban_flag,
    round(urban_distance_km, 6) AS urban_distance_km FROM {urban_dist} WHERE built_threshold = """


@query("urban_distance", _URBAN_OUT + "40")
def _(spark, sf):
    return rounded(cl.urban_distance(cells(spark, sf), chosen(spark, sf).where("built_threshold = 40"), SIDE, TILE))


@query("urban_distance_dense", _URBAN_OUT + "50")
def _(spark, sf):
    return rounded(cl.urban_distance(cells(spark, sf), chosen(spark, sf).where("built_threshold = 50"), SIDE, TILE))


@query("urban_neighbours", """
    SELECT g.city, g.cell_id, t.year_model, t.built_threshold, t.population_threshold, t.cluster_threshold,
           CASE WHEN bool_or(k.city IS NOT NULL) AND count(d.neighbour_id) > 0 THEN count(c.cell_id) END AS urban_neighbours
    FROM {grid} g
    CROSS JOIN (SELECT y AS year_model, bt AS built_threshold, pt AS population_threshold, ct AS cluster_threshold
                FROM (VALUES (1990), (2000), (2014)) a(y), (VALUES (40e0, 75e0, 5000e0), (50e0, 120e0, 12000e0)) b(bt, pt, ct)) t
    LEFT JOIN (SELECT DISTINCT city, year_model, built_threshold FROM {chosen}) k
      ON k.city = g.city AND k.year_model = t.year_model AND k.built_threshold = t.built_threshold
    LEFT JOIN {adjacent} d ON d.city = g.city AND d.cell_id = g.cell_id
    LEFT JOIN {chosen} c ON c.city = g.city AND c.cell_id = d.neighbour_id AND c.year_model = t.year_model AND c.built_threshold = t.built_threshold
    GROUP BY ALL""")
def _(spark, sf):
    return cl.urban_neighbours(cells(spark, sf), chosen(spark, sf), THRESHOLDS, YEARS)


@query("labels_next_period", "SELECT city, cell_id, year_model, label FROM {labels_next}")
def _(spark, sf):
    return labels(spark, sf)


_WIDE = f"SELECT city, cell_id, year_model, {round_all(config.DEFAULT_FEATURES)} FROM {{wide}}"


@query("features_wide", _WIDE)
def _(spark, sf):
    return rounded(make_features(spark, sf))


@query("empty_layer_features", f"""
    SELECT city, cell_id, year_model, {", ".join(
        f"0e0 AS {c}" if c.startswith("water") else f"round({c}, 6) AS {c}" for c in config.DEFAULT_FEATURES)} FROM {{wide}}""")
def _(spark, sf):
    none = spark.createDataFrame([], "city long, fid long, ring array<struct<x:double,y:double>>")
    return rounded(make_features(spark, sf, water_bodies=distances.water_bodies(cells(spark, sf), none, TILE)))


@query("training_frame", f"""
    SELECT f.city, f.cell_id, f.year_model, {", ".join(f"round(f.{c}, 6) AS {c}" for c in config.DEFAULT_FEATURES)}, l.label
    FROM {{wide}} f LEFT JOIN {{labels_next}} l ON l.city = f.city AND l.cell_id = f.cell_id AND l.year_model = f.year_model
    WHERE f.year_model IN (1990, 2000)""")
def _(spark, sf):
    return rounded(features.training_frame(
        stored_features(spark, sf), stored_labels(spark, sf), config.YEARS_TRAIN, config.DEFAULT_FEATURES))


# ----- dissolve and export --------------------------------------------------------------------

@query("best_model", "SELECT city, model_type, model_id, cutoff, round(value, 6) AS value FROM {best}")
def _(spark, sf):
    return rounded(best_models(spark, sf))


@query("best_prediction_cells", "SELECT city, model_type, model_id, cell_id FROM {best_cells}")
def _(spark, sf):
    return evaluate.predicted_cells(cell_scores(spark, sf), best_models(spark, sf)).select("city", "model_type", "model_id", "cell_id")


def predicted_positions(spark, sf):
    picked = evaluate.predicted_cells(cell_scores(spark, sf), best_models(spark, sf))
    return picked.select("city", "model_type", "model_id", "cell_id").join(cells(spark, sf), ["city", "cell_id"])


@query("dissolve_boundary", "SELECT city, model_type, mx, my FROM {cell_sides} GROUP BY ALL HAVING count(*) = 1")
def _(spark, sf):
    edges = dissolve.boundary_edges(predicted_positions(spark, sf), ["city", "model_type"])
    # middle of each side in the units of the check: lattice x doubled sums, y as sums shifted by 2
    return edges.select("city", "model_type", (F.col("ux") + F.col("vx")).alias("mx"), (F.col("uy") + F.col("vy") - 4).alias("my"))


@query("dissolve_area", f"""
    SELECT city, model_type, count(*) AS n_cells, round(count(*) * {number(g.hexagon_area(SIDE))}, 4) AS area_m2 FROM {{best_cells}} GROUP BY ALL""")
def _(spark, sf):
    return rounded(dissolve.dissolved_area(predicted_positions(spark, sf), ["city", "model_type"], SIDE), 4)


def prediction_text(spark, sf):
    return materialize_once(spark, f"{sf}/prediction-text", lambda: dissolve.dissolved_polygons(
        predicted_positions(spark, sf), ["city", "model_type"], SIDE))


@query("export_prediction_text")
def _(spark, sf):
    return prediction_text(spark, sf)


# the exported texts, read back: rings, corners, and the area as a number of cells
@query("export_prediction_wkt", """
    SELECT city, model_type, area, 2 - (n_corners - n_sides + n_cells) AS n_rings, n_outer AS n_vertices, n_cells
    FROM (SELECT city, model_type, area, count(*) AS n_cells FROM {best_areas} GROUP BY ALL) a
    JOIN {area_corners} c USING (city, model_type, area) JOIN {area_sides} s USING (city, model_type, area)""")
def _(spark, sf):
    rings = readers.wkt_rings(prediction_text(spark, sf)).select(
        "city", "model_type", "area", F.size("coords").alias("n"), g.ring_signed_area(F.col("coords")).alias("signed"))
    return rings.groupBy("city", "model_type", "area").agg(
        F.count("*").alias("n_rings"), F.sum(F.col("n") - 1).alias("n_vertices"),
        F.round(F.sum("signed") / g.hexagon_area(SIDE)).cast("long").alias("n_cells"))


@query("export_clusters", """
    SELECT city, cluster_id, CAST(2014 AS INT) AS year_model, n_cells, round(population, 4) AS population FROM {clusters}
    WHERE year_model = 2014 AND built_threshold = 40 AND population_threshold = 75 AND population >= 5000""")
def _(spark, sf):
    return rounded(cl.qualifying(clusters(spark, sf).where("year_model = 2014"), [config.URBAN]).select(
        "city", "cluster_id", "year_model", "n_cells", "population"), 4)


# ----- evaluation -----------------------------------------------------------------------------

@query("confusion_by_cutoff", "SELECT model_id, cutoff, tp, tn, fp, fn FROM {confusion}")
def _(spark, sf):
    return evaluate.confusion_by_cutoff(layer(spark, sf, "scored"), ["model_id"])


_METRICS = """round(tp / nullif(tp + fp, 0), 6) AS "precision", round(tp / nullif(tp + fn, 0), 6) AS recall,
    round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1, round((tp + tn) / nullif(tp + tn + fp + fn, 0), 6) AS accuracy"""


@query("metrics_by_cutoff", f"SELECT model_id, cutoff, tp, tn, fp, fn, {_METRICS} FROM {{confusion}}")
def _(spark, sf):
    return rounded(evaluate.with_metrics(evaluate.confusion_by_cutoff(layer(spark, sf, "scored"), ["model_id"])))


def folds(spark, sf):
    return evaluate.assign_folds(
        layer(spark, sf, "scored"), ["model_id"], [F.floor(F.col("row_id") / 1024)], ["row_id"], config.N_FOLDS)


@query("kfold_assign", "SELECT model_id, row_id, CAST(fold AS INT) AS fold FROM {folds}")
def _(spark, sf):
    return folds(spark, sf).select("model_id", "row_id", "fold")


_LONG = " UNION ALL ".join(
    f"SELECT model_id, cutoff, '{name}' AS metric, {expr} AS value FROM {{fold_confusion}}" for name, expr in [
        ("true positives@", "CAST(tp AS DOUBLE)"), ("true negatives@", "CAST(tn AS DOUBLE)"),
        ("false positives@", "CAST(fp AS DOUBLE)"), ("false negatives@", "CAST(fn AS DOUBLE)"),
        ("precision@", "tp / nullif(tp + fp, 0)"), ("recall@", "tp / nullif(tp + fn, 0)"),
        ("f1@", "2 * tp / nullif(2 * tp + fp + fn, 0)"), ("auc@", "(tp + tn) / nullif(tp + tn + fp + fn, 0)")])


@query("cv_metrics", f"SELECT model_id, metric, cutoff, round(avg(value), 6) AS value FROM ({_LONG}) m GROUP BY ALL")
def _(spark, sf):
    per_fold = evaluate.with_metrics(evaluate.confusion_by_cutoff(folds(spark, sf), ["model_id", "fold"]))
    return rounded(evaluate.mean_over_folds(evaluate.long_metrics(per_fold, ["model_id", "fold"]), ["model_id"]))


@query("importance_rank", """
    SELECT model_id, feature, feature_importance, CAST(dense_rank() OVER (PARTITION BY model_id ORDER BY feature_importance DESC) AS INT) AS rank_abs
    FROM {importances}""")
def _(spark, sf):
    return evaluate.ranked_importances(layer(spark, sf, "importances"))


@query("prediction_rows", """
    SELECT model_id, city, CAST(2014 AS INT) AS year_features, row_id AS cell_id, score, CAST(label AS BOOLEAN) AS label FROM {scored}""")
def _(spark, sf):
    return writers.prediction_rows(layer(spark, sf, "scored").withColumns({"year_features": F.lit(2014), "cell_id": F.col("row_id")}))


@query("evaluation_rows", """
    SELECT event_id, event_type || '@' AS metric, CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 10 AS STRING) END AS cutoff, value FROM events""")
def _(spark, sf):
    e = F.col("event_id")
    key = F.concat("event_type", F.lit("@"), F.when(e % 3 == 0, F.concat(F.lit("|"), (e % 10).cast("string"))).when(e % 3 == 1, "|").otherwise(""))
    return evaluate.split_metric_keys(table(spark, sf, "events").select("event_id", key.alias("key"), "value")).select(
        "event_id", "metric", "cutoff", "value")


# ----- configuration and checks ---------------------------------------------------------------

@query("feature_switches", "SELECT p_partkey, p_name || '_' || p_brand AS feature FROM part WHERE p_size % 3 = 1")
def _(spark, sf):
    switches = table(spark, sf, "part").select("p_partkey", F.concat_ws("_", "p_name", "p_brand").alias("feature"),
                                               (F.col("p_size") % 3 == 1).alias("switched_on"))
    return experiment.switched_on(switches).select("p_partkey", "feature")


# a city's rows are its supplier's line items; those without a label are the period to be predicted
_CITY_ROWS = """SELECT l_suppkey AS city, l_orderkey, l_linenumber, l_partkey, l_quantity::DOUBLE AS a, l_discount::DOUBLE AS b, l_tax::DOUBLE AS c,
    CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS label FROM lineitem"""
_CITY_MODELS = f"""rows AS ({_CITY_ROWS}),
    t AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY l_orderkey, l_linenumber, l_partkey, a, b, c, label) - 1 AS i,
                 count(*) OVER (PARTITION BY city) AS n FROM rows WHERE label IS NOT NULL),
    f AS (SELECT *, 1 + CASE WHEN i < (n % 3) * (n // 3 + 1) THEN i // (n // 3 + 1) ELSE n % 3 + (i - (n % 3) * (n // 3 + 1)) // nullif(n // 3, 0) END AS fold FROM t),
    u AS (SELECT f.*, unit FROM f, (SELECT unnest([0, 1, 2, 3]) AS unit) WHERE unit <> fold),
    e AS (SELECT city, unit, count(*) AS total, 1e-9 * greatest(var_pop(a), var_pop(b), var_pop(c)) AS eps FROM u GROUP BY city, unit),
    m AS (SELECT u.city, u.unit, label, ln(count(*) / any_value(total)) AS prior, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc,
                 var_pop(a) + any_value(eps) AS va, var_pop(b) + any_value(eps) AS vb, var_pop(c) + any_value(eps) AS vc
          FROM u JOIN e ON u.city = e.city AND u.unit = e.unit GROUP BY u.city, u.unit, label)"""


def _city_scores(rows: str) -> str:
    """Scores of ``rows`` (with ``unit``) by the model of their city and unit."""
    joint = lambda k: (f"({k}.prior - 0.5 * (ln(2 * pi() * {k}.va) + (r.a - {k}.ma) ** 2 / {k}.va + ln(2 * pi() * {k}.vb) + (r.b - {k}.mb) ** 2 / {k}.vb "  # noqa: E731
                       f"+ ln(2 * pi() * {k}.vc) + (r.c - {k}.mc) ** 2 / {k}.vc))")
    return f"""SELECT r.*, CASE WHEN y.label IS NULL THEN 0 WHEN z.label IS NULL THEN 1 ELSE 1 / (1 + exp({joint('z')} - {joint('y')})) END AS score
        FROM ({rows}) r LEFT JOIN m y ON y.city = r.city AND y.unit = r.unit AND y.label = 1
        LEFT JOIN m z ON z.city = r.city AND z.unit = r.unit AND z.label = 0 WHERE y.label IS NOT NULL OR z.label IS NOT NULL"""


_CITY_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "a", "b", "c", "label"]


def city_run(spark, sf):
    t = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("city"), "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("double").alias("a"),
        F.col("l_discount").cast("double").alias("b"), F.col("l_tax").cast("double").alias("c"),
        F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 0).alias("label"))
    rows = models.assemble(t, ["a", "b", "c"])
    return runs.run_cities("GaussianNB", {}, rows, rows.where("label is null").select("city", *_CITY_KEY[:3], "features"),
                           [F.floor(F.col("l_orderkey") / 4096)], _CITY_KEY, 3)


@query("run_predictions", f"""WITH {_CITY_MODELS}
    SELECT city, l_orderkey, l_linenumber, l_partkey, round(score, 6) AS score
    FROM ({_city_scores("SELECT *, 0 AS unit FROM rows WHERE label IS NULL")})""")
def _(spark, sf):
    """Scores of the last period by the model of each city."""
    return rounded(city_run(spark, sf).predictions)


@query("run_evaluations", f"""WITH {_CITY_MODELS},
    s AS ({_city_scores("SELECT city, fold AS unit, a, b, c, label FROM f")}),
    k AS (SELECT city, unit, cutoff, count(*) FILTER (score >= cutoff AND label = 1) AS tp, count(*) FILTER (score < cutoff AND label = 0) AS tn,
                 count(*) FILTER (score >= cutoff AND label = 0) AS fp, count(*) FILTER (score < cutoff AND label = 1) AS fn
          FROM s, (SELECT unnest([{', '.join(map(str, config.CUTOFFS))}]) AS cutoff) GROUP BY city, unit, cutoff),
    l AS ({' UNION ALL '.join(f"SELECT city, unit, cutoff, '{name}' AS metric, {value} AS value FROM k" for name, value in (
        ("true positives@", "tp::DOUBLE"), ("true negatives@", "tn::DOUBLE"), ("false positives@", "fp::DOUBLE"), ("false negatives@", "fn::DOUBLE"),
        ("precision@", "tp / nullif(tp + fp, 0)"), ("recall@", "tp / nullif(tp + fn, 0)"), ("f1@", "2 * tp / nullif(2 * tp + fp + fn, 0)"),
        ("auc@", "(tp + tn) / nullif(tp + tn + fp + fn, 0)")))})
    SELECT city, metric, cutoff, round(avg(value), 6) AS value FROM l GROUP BY city, metric, cutoff""")
def _(spark, sf):
    """Metrics of each city, averaged over its folds."""
    return rounded(city_run(spark, sf).evaluations)


_GRID_VALUES = ", ".join(
    f"('{m}', '{experiment.json_map(p)}')" for m, p in models.parameter_grid(config.PARAMETER_GRIDS))


@query("param_grid", f"SELECT s_suppkey AS city, m AS model_type, p AS model_parameters FROM supplier CROSS JOIN (VALUES {_GRID_VALUES}) t(m, p)")
def _(spark, sf):
    runs = experiment.parameter_runs(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("city")))
    return runs.select("city", "model_type", canonical_json(F.col("model_parameters")).alias("model_parameters"))


@query("config_fingerprint", f"""SELECT s_suppkey AS city, m AS model_type, md5(p) AS parameters_id,
       md5('["city_' || s_suppkey || '", "max_dem", "urban_flag"]') AS features_id FROM supplier CROSS JOIN (VALUES {_GRID_VALUES}) t(m, p)""")
def _(spark, sf):
    runs = experiment.parameter_runs(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("city")))
    names = F.array(F.lit("urban_flag"), F.lit("max_dem"), F.concat(F.lit("city_"), F.col("city").cast("string")))
    return runs.select("city", "model_type", fingerprint(canonical_json(F.col("model_parameters"))).alias("parameters_id"),
                       fingerprint(canonical_list(names)).alias("features_id"))


@query("pending_runs", f"""SELECT s_suppkey AS city, m AS model_type, md5(p) AS parameters_id FROM supplier CROSS JOIN (VALUES {_GRID_VALUES}) t(m, p)
       WHERE NOT (m = 'RandomForest' AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = s_suppkey AND o_orderstatus = 'F'))""")
def _(spark, sf):
    runs = experiment.run_keys(experiment.parameter_runs(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("city"))))
    done = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("city")).distinct().withColumn(
        "model_type", F.lit("RandomForest"))
    return features.pending(runs, done, ["city", "model_type"]).select("city", "model_type", "parameters_id")


@query("pk_violations", "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(spark, sf):
    return features.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("fk_violations", """
    SELECT p.fid, p.city FROM {points} p WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = p.fid AND o.o_orderstatus = 'P')""")
def _(spark, sf):
    parents = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("fid"))
    return features.missing_keys(layer(spark, sf, "points").select("fid", "city"), parents, ["fid"])


@query("schema_conformance")
def _(spark, sf):
    stored = {"built_lds": stored_zonal(spark, sf, "built"), "population": stored_zonal(spark, sf, "population"),
              "urban_distance": stored_layer(spark, sf, "urban_distance")}
    rows = [schemas.conform(df, n).groupBy("year_model").agg(F.count("*").alias("n_rows")).withColumn("layer", F.lit(n))
            for n, df in stored.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("model_registry")
def _(spark, sf):
    runs = experiment.parameter_runs(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("city")))
    return schemas.conform(experiment.registry_rows(runs, config.DEFAULT_FEATURES), "models").drop("run_time")


@query("model_lookup", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS city, m AS model_type, md5('' || l_suppkey || '|' || m || '|' || p) AS model_id
       FROM lineitem JOIN (VALUES {", ".join(f"({i}, '{m}', '{experiment.json_map(p)}')" for i, (m, p) in enumerate(models.parameter_grid(config.PARAMETER_GRIDS)))}) t(i, m, p)
         ON t.i = l_partkey % 96""")
def _(spark, sf):
    grid = models.parameter_grid(config.PARAMETER_GRIDS)
    runs = F.array(*[F.struct(F.lit(m).alias("model_type"), F.lit(experiment.json_map(p)).alias("parameters")) for m, p in grid])
    asked = table(spark, sf, "lineitem").withColumn("r", F.get(runs, (F.col("l_partkey") % len(grid)).cast("int")))
    return asked.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("city"), "r.model_type",
                        experiment.model_id(F.col("l_suppkey"), F.col("r.model_type"), F.col("r.parameters")).alias("model_id"))


# ----- vector preparation ---------------------------------------------------------------------

def osm_documents(spark, sf):
    """Documents of up to 64 elements each, written as JSON and read back with the declared schema."""
    part = layer(spark, sf, "nodes")
    stamp = F.lit("2016-03-04T05:06:07Z")
    tags = F.create_map(F.lit("amenity"), F.when(F.col("node") % 3 == 0, "school").otherwise("bank"))
    return part.select(
        F.floor(F.col("node") / 64).alias("doc"),
        F.struct(F.lit("node").alias("type"), F.col("node").alias("id"), "lat", "lon", stamp.alias("timestamp"),
                 F.lit(None).cast("array<long>").alias("nodes"), F.when(F.col("node") % 2 == 0, tags).alias("tags")).alias("e"),
    ).unionByName(
        table(spark, sf, "orders").select(
            F.floor(F.col("o_orderkey") / 64).alias("doc"),
            F.struct(F.lit("way").alias("type"), F.col("o_orderkey").alias("id"), F.lit(None).cast("double").alias("lat"),
                     F.lit(None).cast("double").alias("lon"), stamp.alias("timestamp"),
                     F.array(F.col("o_custkey"), F.col("o_custkey"), F.col("o_orderkey"), F.col("o_custkey")).alias("nodes"),
                     F.create_map(F.lit("highway"), F.lit("primary")).alias("tags")).alias("e"))
    ).groupBy("doc").agg(F.collect_list("e").alias("elements"))


def read_osm(spark, sf):
    path = experiment.stored_json(spark, f"{sf}/osm", lambda: osm_documents(spark, sf).select("elements"))
    return osm.split_elements(readers.osm_documents(spark, path, multi_line=False))


@query("osm_elements_split", """
    SELECT 'node' AS kind, node AS osmid, round(lon, 6) AS lon, round(lat, 6) AS lat, CAST(NULL AS STRING) AS nodes,
           CASE WHEN node % 2 = 0 THEN CASE WHEN node % 3 = 0 THEN 'school' ELSE 'bank' END END AS tag FROM {nodes}
    UNION ALL
    SELECT 'way', o_orderkey, NULL, NULL,
           CASE WHEN o_orderkey = o_custkey THEN '' || o_custkey ELSE o_custkey || ',' || o_orderkey || ',' || o_custkey END, 'primary' FROM orders""")
def _(spark, sf):
    nodes, ways = read_osm(spark, sf)
    n = nodes.select(F.lit("node").alias("kind"), "osmid", "lon", "lat", F.lit(None).cast("string").alias("nodes"),
                     F.try_element_at("tags", F.lit("amenity")).alias("tag"))
    w = ways.select(F.lit("way").alias("kind"), "osmid", F.lit(None).cast("double").alias("lon"), F.lit(None).cast("double").alias("lat"),
                    F.concat_ws(",", F.transform("nodes", lambda v: v.cast("string"))).alias("nodes"),
                    F.try_element_at("tags", F.lit("highway")).alias("tag"))
    return rounded(n.unionByName(w))


@query("osm_points", """
    SELECT node AS osmid, CASE WHEN node % 3 = 0 THEN 'school' ELSE 'bank' END AS amenity, CAST(NULL AS STRING) AS aeroway,
           round(lon, 6) AS lon, round(lat, 6) AS lat FROM {nodes} WHERE node % 2 = 0""")
def _(spark, sf):
    nodes, _ways = read_osm(spark, sf)
    # answers of several tag queries overlap; duplicates go
    twice = nodes.unionByName(nodes.drop("tags").withColumn("tags", F.lit(None).cast("map<string,string>")), allowMissingColumns=True)
    return rounded(osm.points_of_interest(twice).select("osmid", "amenity", "aeroway", "lon", "lat"))


@query("osm_timestamps", """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso, date_trunc('second', ts) AS parsed,
           CAST(event_id // 3600 AS BIGINT) AS h, CAST(event_id % 3600 // 60 AS BIGINT) AS m, CAST(event_id % 60 AS BIGINT) AS s FROM events""")
def _(spark, sf):
    e = table(spark, sf, "events").withColumn("iso", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    i = F.col("event_id")
    return e.select("event_id", "iso", F.to_timestamp("iso").cast("timestamp_ntz").alias("parsed"),
                    F.floor(i / 3600).alias("h"), F.floor(i % 3600 / 60).alias("m"), (i % 60).alias("s"))


@query("valid_coordinates", """
    SELECT event_id, CAST(lat_text AS DOUBLE) AS lat FROM {coord_text} WHERE regexp_full_match(lat_text, '[-+]?[0-9]*\\.?[0-9]+')""")
def _(spark, sf):
    c = layer(spark, sf, "coord_text")
    return c.where(osm.is_coordinate(F.col("lat_text"))).select("event_id", osm.to_coordinate(F.col("lat_text")).alias("lat"))


@query("way_filter", "SELECT osmid FROM {roads}")
def _(spark, sf):
    return layer(spark, sf, "way_tags").where(osm.is_road(F.col("highway"), F.col("area"))).select("osmid")


@query("bbox_filter", """
    SELECT p.fid, p.city FROM {points} p JOIN {boxes} b ON b.city = p.city
    WHERE p.x BETWEEN b.xmin AND b.xmax AND p.y BETWEEN b.ymin AND b.ymax""")
def _(spark, sf):
    return join_dimension(layer(spark, sf, "points"), layer(spark, sf, "boxes"), ["city"]).where(
        osm.in_box(F.col("x"), F.col("y"), F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))).select("fid", "city")


@query("node_dropna", """
    SELECT event_id, CASE WHEN event_id % 3 > 0 THEN event_type END AS kind, CASE WHEN event_id % 5 > 0 THEN value END AS value
    FROM events WHERE event_id % 3 > 0 OR event_id % 5 > 0""")
def _(spark, sf):
    e = F.col("event_id")
    holes = table(spark, sf, "events").select("event_id", F.when(e % 3 > 0, F.col("event_type")).alias("kind"), F.when(e % 5 > 0, F.col("value")).alias("value"))
    return holes.dropna("all", subset=["kind", "value"])


@query("tag_keys_normalized", """
    SELECT p_partkey, 'street=' || p_name || ';undef_1=' || p_brand || ';denom=' || p_type || ';undef_2=' || p_size AS tags FROM part""")
def _(spark, sf):
    tags = F.create_map(F.lit("Addr:Street"), F.col("p_name"), F.lit("фу"), F.col("p_brand"), F.lit("denomination"), F.col("p_type"),
                        F.lit("中"), F.col("p_size").cast("string"), F.lit("addr:street"), F.lit("second"))
    clean = osm.normalize_tag_keys(tags)
    text = F.concat_ws(";", F.transform(F.map_entries(clean), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return table(spark, sf, "part").select("p_partkey", text.alias("tags"))


@query("stringify_attrs", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS status, CAST(o_custkey AS STRING) AS customer FROM orders""")
def _(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"), F.col("o_custkey").alias("customer"))
    return osm.stringify(o, ["status", "customer"])


@query("valid_rings", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 7 ELSE o_orderkey % 7 END AS corners FROM orders
    WHERE CASE WHEN o_orderkey % 7 = 0 THEN 7 ELSE o_orderkey % 7 END >= 3""")
def _(spark, sf):
    k = F.col("o_orderkey")
    n = F.when(k % 7 == 0, 7).otherwise(k % 7)
    ring = g.circle_ring(F.col("o_custkey").cast("double"), F.lit(0.0), F.lit(10.0), 7)
    cut = table(spark, sf, "orders").select("o_orderkey", F.slice(ring, F.lit(1), n.cast("int")).alias("ring"))
    return cut.where(g.is_valid_ring(F.col("ring"))).select("o_orderkey", F.size("ring").cast("long").alias("corners"))


@query("dedupe_consecutive", """
    SELECT a.osmid, a.pos, a.node FROM {way_nodes} a LEFT JOIN {way_nodes} p ON p.osmid = a.osmid AND p.pos = a.pos - 1
    WHERE p.node IS NULL OR p.node <> a.node""")
def _(spark, sf):
    return osm.drop_repeated_nodes(way_nodes(spark, sf).select("osmid", "pos", "node"))


@query("way_lines", "SELECT city, osmid, pos, x1, y1, x2, y2 FROM {road_segments}")
def _(spark, sf):
    return road_segments(spark, sf).select("city", "osmid", "pos", "x1", "y1", "x2", "y2")


# box with box: product of overlaps; diamond with box: 2 r^2 less the parts beyond each side (the box
# is wider than any diamond, so at most one side per axis cuts and a corner part is added back)
x.EXPECTED["water_sides"] = """
    SELECT *, least(dw, de) AS u, least(ds, dn) AS v FROM (
      SELECT w.city, w.fid, w.shape, w.half AS r, w.wx - b.xmin AS dw, b.xmax - w.wx AS de, w.wy - b.ymin AS ds, b.ymax - w.wy AS dn
      FROM {water} w JOIN {boxes} b ON b.city = w.city) c"""


@query("water_clip", """
    SELECT city, fid, round(area, 4) AS area FROM (
      SELECT city, fid, CASE WHEN shape = 'box'
        THEN greatest(0, least(r, dw) + least(r, de)) * greatest(0, least(r, ds) + least(r, dn))
        ELSE 2 * r * r
          - (CASE WHEN u >= r THEN 0 WHEN u >= 0 THEN (r - u) * (r - u) WHEN u > -r THEN 2 * r * r - (r + u) * (r + u) ELSE 2 * r * r END)
          - (CASE WHEN v >= r THEN 0 WHEN v >= 0 THEN (r - v) * (r - v) WHEN v > -r THEN 2 * r * r - (r + v) * (r + v) ELSE 2 * r * r END)
          + (CASE WHEN u >= r OR v >= r THEN 0
                  WHEN u >= 0 AND v >= 0 THEN CASE WHEN u + v >= r THEN 0 ELSE (r - u - v) * (r - u - v) / 2 END
                  WHEN u < 0 AND v >= 0 THEN CASE WHEN u <= -r THEN (r - v) * (r - v)
                       ELSE (r - v) * (r - v) - (CASE WHEN v - u >= r THEN 0 ELSE (r - v + u) * (r - v + u) / 2 END) END
                  WHEN u >= 0 AND v < 0 THEN CASE WHEN v <= -r THEN (r - u) * (r - u)
                       ELSE (r - u) * (r - u) - (CASE WHEN u - v >= r THEN 0 ELSE (r - u + v) * (r - u + v) / 2 END) END
                  ELSE 2 * r * r
                    - (CASE WHEN -u >= r THEN 0 ELSE (r + u) * (r + u) END) - (CASE WHEN -v >= r THEN 0 ELSE (r + v) * (r + v) END)
                    + (CASE WHEN -u - v >= r OR u <= -r OR v <= -r THEN 0 ELSE (r + u + v) * (r + u + v) / 2 END) END)
        END AS area FROM {water_sides}) e WHERE area > 1e-9""")
def _(spark, sf):
    w = join_dimension(water_rings(spark, sf), layer(spark, sf, "boxes"), ["city"])
    return rounded(osm.water_in_box(w).select("city", "fid", F.abs(g.ring_signed_area(F.col("ring"))).alias("area")), 4)


# a U of three bars, cut to a box that may hold both prongs without what links them
x.EXPECTED["bent_water"] = """
    SELECT city, fid, round((a + b + c) * half * half, 4) AS area, CAST(CASE WHEN c > 0 THEN 1 ELSE (a > 0)::INT + (b > 0)::INT END AS BIGINT) AS n_parts
    FROM (SELECT city, fid, half, 0.25 * (0.9 - greatest(y0, -0.5)) AS a, greatest(0, x1 - 0.5) * (0.9 - greatest(y0, -0.5)) AS b,
                 (x1 + 0.75) * greatest(0, -0.5 - y0) AS c
          FROM (SELECT *, -0.05 + 0.25e0 * (1 + fid % 4) AS x1, -0.8e0 + 0.4e0 * (fid % 3) AS y0 FROM {water}) w) o"""


def bent_water(spark, sf):
    r, x0, y0 = F.col("half"), F.col("wx"), F.col("wy")
    corners = [(-1, -1), (1, -1), (1, 1), (.5, 1), (.5, -.5), (-.5, -.5), (-.5, 1), (-1, 1)]
    return dealt(layer(spark, sf, "water"), "fid").select(
        "city", "fid", F.array(*[g.point(x0 + r * dx, y0 + r * dy) for dx, dy in corners]).alias("ring"),
        (x0 - 0.75 * r).alias("xmin"), (y0 + r * (-0.8 + 0.4 * (F.col("fid") % 3))).alias("ymin"),
        (x0 + r * (-0.05 + 0.25 * (1 + F.col("fid") % 4))).alias("xmax"), (y0 + 0.9 * r).alias("ymax"))


def area_and_parts(water):
    return rounded(water.groupBy("city", "fid").agg(
        F.sum(F.abs(g.ring_signed_area(F.col("ring")))).alias("area"), F.count("*").alias("n_parts")), 4)


@query("water_clip_parts", "SELECT city, fid, area, n_parts FROM {bent_water}")
def _(spark, sf):
    return area_and_parts(osm.water_in_box(bent_water(spark, sf), "keep"))


@query("water_clip_single", "SELECT city, fid, area, n_parts FROM {bent_water} WHERE n_parts = 1")
def _(spark, sf):
    return area_and_parts(osm.water_in_box(bent_water(spark, sf)))


# ----- classifiers ----------------------------------------------------------------------------

@query("gaussian_nb", """
    WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS a, l_discount AS b, l_tax AS c,
                      CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_returnflag = 'A' THEN 0 END AS label FROM lineitem),
    k AS (SELECT * FROM t WHERE label IS NOT NULL),
    e AS (SELECT 1e-9 * greatest(var_pop(a), var_pop(b), var_pop(c)) AS eps FROM k),
    m AS (SELECT label, count(*) / (SELECT count(*) FROM k) AS prior, avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, var_pop(a) + any_value(eps) AS va,
                 var_pop(b) + any_value(eps) AS vb, var_pop(c) + any_value(eps) AS vc FROM k, e GROUP BY label),
    j AS (SELECT t.l_orderkey, t.l_linenumber, t.l_partkey, t.l_suppkey, m.label AS cls,
                 ln(prior) - 0.5 * (ln(2 * pi() * va) + (a - ma) ** 2 / va + ln(2 * pi() * vb) + (b - mb) ** 2 / vb
                                    + ln(2 * pi() * vc) + (c - mc) ** 2 / vc) AS ll, a, b, c FROM t CROSS JOIN m)
    SELECT o.l_orderkey, o.l_linenumber, o.l_partkey, o.l_suppkey, round(o.score, 6) AS score FROM (
      SELECT z.l_orderkey, z.l_linenumber, z.l_partkey, z.l_suppkey, 1 / (1 + exp(z.ll - y.ll)) AS score
      FROM j z JOIN j y ON y.l_orderkey = z.l_orderkey AND y.l_linenumber = z.l_linenumber AND y.l_partkey = z.l_partkey
       AND y.l_suppkey = z.l_suppkey AND y.a = z.a AND y.b = z.b AND y.c = z.c AND y.cls = 1 AND z.cls = 0) o""")
def _(spark, sf):
    t = table(spark, sf, "lineitem").withColumn("label", F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 0))
    columns = [F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")]
    model = GaussianNB.fit_columns(t.where(F.col("label").isNotNull()), columns)
    return rounded(t.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", model.probability(columns).alias("score")))


@query("knn_classify", """
    WITH p AS (SELECT q.vec_id AS query_id, t.vec_id AS id, list_distance(q.embedding::DOUBLE[], t.embedding::DOUBLE[]) AS d, t.label % 2 AS label
               FROM embeddings q JOIN embeddings t ON t.vec_id <> q.vec_id)
    SELECT query_id, string_agg('' || id, ',' ORDER BY d, id) AS neighbours, round(avg(label), 6) AS score,
           round(sum(label / d) / sum(1 / d), 6) AS weighted
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, id) AS n FROM p) r WHERE n <= 5 GROUP BY query_id""")
def _(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"),
                                              (F.col("label") % 2).alias("label"))
    found = knn.nearest_neighbours(e, e, 5, leave_out_self=True)
    return rounded(found.select(
        "query_id", F.concat_ws(",", F.transform("neighbours", lambda n: n["id"].cast("string"))).alias("neighbours"),
        knn.class_share(F.col("neighbours")).alias("score"), knn.class_share(F.col("neighbours"), "distance").alias("weighted")))


def _tree_sql(levels: int) -> str:
    """A decision tree on three features of lineitem by trying every cut of every node, level by level."""
    gini = lambda ones, n: f"({n}) * (2.0 * (({ones}) / ({n})) * (1 - ({ones}) / ({n})))"
    parts = ["""r0 AS (SELECT 1 AS node, [l_quantity::DOUBLE, l_discount::DOUBLE, l_tax::DOUBLE] AS x,
                   CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem WHERE l_returnflag IN ('R', 'A'))"""]
    for k in range(levels):
        parts.append(f"""
    u{k} AS (SELECT node, feature, value, sum(m) OVER w AS l, sum(m1) OVER w AS l1, sum(m) OVER (PARTITION BY node, feature) AS n,
                    sum(m1) OVER (PARTITION BY node, feature) AS ones
             FROM (SELECT node, feature, x[feature + 1] AS value, count(*) AS m, sum(label) AS m1
                   FROM r{k}, (SELECT unnest([0, 1, 2]) AS feature) GROUP BY node, feature, x[feature + 1])
             WINDOW w AS (PARTITION BY node, feature ORDER BY value)),
    b{k} AS (SELECT node, n, ones, feature, value AS cut FROM (
               SELECT *, row_number() OVER (PARTITION BY node ORDER BY ({gini('l1', 'l')} + {gini('ones - l1', 'n - l')}) / n, feature, value) AS k
               FROM u{k} WHERE l < n AND ones > 0 AND ones < n) WHERE k = 1),
    r{k + 1} AS (SELECT 2 * r.node + (x[feature + 1] > cut)::INT AS node, x, label FROM r{k} r JOIN b{k} b ON r.node = b.node)""")
    inner = [f"SELECT {k} AS depth, feature, cut, n, ones FROM b{k}" for k in range(levels)]
    leaves = [f"SELECT {k} AS depth, -1 AS feature, NULL AS cut, count(*) AS n, sum(label) AS ones FROM r{k} WHERE {k} = {levels} OR node NOT IN (SELECT node FROM b{min(k, levels - 1)}) GROUP BY node"
              for k in range(levels + 1)]
    return f"WITH {', '.join(parts)} SELECT depth, feature, round(cut, 6) AS cut, n::BIGINT AS n, ones::BIGINT AS ones FROM ({' UNION ALL '.join(inner + leaves)})"


@query("tree_nodes", _tree_sql(3))
def _(spark, sf):
    t = table(spark, sf, "lineitem").where("l_returnflag in ('R', 'A')").select(
        *[F.col(c).cast("double").alias(c) for c in ("l_quantity", "l_discount", "l_tax")], (F.col("l_returnflag") == "R").cast("int").alias("label"))
    # nodes above 5,000 rows go the way of large ones
    tree = grow(models.assemble(t, ["l_quantity", "l_discount", "l_tax"]), Rules(max_depth=3, group_rows=5_000))
    return tree.nodes.select("depth", "feature", F.round("cut", 6).alias("cut"), "n", "ones")


# settings small enough for the test tables
TRAINED = {
    "random_forest": ("RandomForest", {"n_estimators": 20, "max_depth": 5, "max_features": "sqrt", "criterion": "gini", "min_samples_split": 2, "random_state": 2193}),
    "extra_trees": ("ExtraTrees", {"n_estimators": 20, "max_depth": 5, "max_features": "sqrt", "criterion": "gini", "min_samples_split": 2, "random_state": 2193}),
    "logistic": ("LogisticRegression", {"C_reg": 0.01, "penalty": "l2", "random_state": 2193}),
    "adaboost": ("AdaBoost", {"learning_rate": 1.0, "n_estimators": 8, "algorithm": "SAMME"}),
    "gbt": ("GradientBoostingClassifier", {"n_estimators": 8, "learning_rate": 0.1, "subsample": 0.8, "max_depth": 3}),
    "decision_tree": ("DecisionTreeClassifier", {"max_features": None, "criterion": "gini", "max_depth": 5, "min_samples_split": 2}),
    "random_forest_deep": ("RandomForest", {"n_estimators": 100, "max_depth": 50, "max_features": "sqrt", "criterion": "gini", "min_samples_split": 2, "random_state": 2193}),
    "extra_trees_deep": ("ExtraTrees", {"n_estimators": 100, "max_depth": 50, "max_features": "sqrt", "criterion": "gini", "min_samples_split": 5, "random_state": 2193}),
    "linear": ("SGDClassifier", {"loss": "log", "penalty": "l2"}),
    "linear_svc": ("SVM", {"C_reg": 1.0, "kernel": "linear"}),
}


def _register_model(key: str, name: str, parameters: dict) -> None:
    @query(f"train_{key}")
    def _(spark, sf):
        model = models.fit(name, parameters, training(spark, sf))
        scored = model.score(training(spark, sf, [config.YEAR_PREDICT]))
        return scored.select("city", "cell_id", "year_model", F.round("score", 5).alias("score"))


for _key, (_model, _parameters) in TRAINED.items():
    _register_model(_key, _model, _parameters)


@query("score_cells")
def _(spark, sf):
    model = models.fit("GaussianNB", {}, training(spark, sf))
    return model.score(training(spark, sf)).select("city", "cell_id", "year_model", F.round("score", 5).alias("score"), "label")


@query("cv_run")
def _(spark, sf):
    run = experiment.cross_validate(
        "LogisticRegression", TRAINED["logistic"][1], training(spark, sf), config.DEFAULT_FEATURES, config.N_FOLDS)
    return rounded(run.metrics)


@query("temporal_holdout")
def _(spark, sf):
    frame = training(spark, sf)
    return rounded(experiment.hold_out(
        "DecisionTreeClassifier", TRAINED["decision_tree"][1], frame.where("year_model = 1990"), frame.where("year_model = 2000")))
