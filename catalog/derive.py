"""Input layers derived from the test tables, as SQL that both engines run.

Every supplier is a city; its grid, pixels, points, roads and water come from its rows of the other
tables, so all work grows with the tables.  Metres are local: every city is centred on (5000, 5000).
"""

from __future__ import annotations

import re

SIDE = 125.0  # hexagon side
TILE = 1000.0  # tile of the nearest search
YEARS = [1990, 2000, 2014]
PIXEL, DEM_PIXEL = 250.0, 125.0

# name -> SQL; {x} stands for another entry or a table
LAYERS: dict[str, str] = {
    "city": """
        SELECT s_suppkey AS city, CAST(800 + 150 * (s_suppkey % 4) AS DOUBLE) AS half, s_name AS name,
               s_nationkey AS nation FROM {supplier}""",
    "boxes": """
        SELECT city, 5000 - half AS xmin, 5000 - half AS ymin, 5000 + half AS xmax, 5000 + half AS ymax FROM {city}""",
    "pixels_raw": """
        SELECT city, ym, pid, avg(q) AS aq
        FROM (SELECT l_suppkey AS city, (l_orderkey * 31 + l_linenumber * 7) % 100 AS pid, l_quantity AS q,
                     CASE WHEN year(l_shipdate) <= 1996 THEN 1990 WHEN year(l_shipdate) <= 1998 THEN 2000
                          ELSE 2014 END AS ym
              FROM {lineitem}) t
        GROUP BY city, ym, pid""",
    "pixels": """
        SELECT city, year, x, y, aq / 50 * w AS built, round(aq / 50 * w, 1) AS built_step, aq * 6 * w AS population,
               least(3e0, CAST(floor(aq / 50 * w * 8) AS DOUBLE)) AS settlements, round(63 * aq / 50 * w) AS lights
        FROM (SELECT city, year, x, y, aq,
                     greatest(0e0, 1 - sqrt((x - 5000) * (x - 5000) + (y - 5000) * (y - 5000)) / 2600) AS w
              FROM (SELECT city, ym AS year, CAST(3888 + 250 * (pid % 10) AS DOUBLE) AS x,
                           CAST(3888 + 250 * CAST(floor(pid / 10) AS BIGINT) AS DOUBLE) AS y, aq
                    FROM {pixels_raw}) a) b""",
    # data years of the layers that are not those of the model
    "population_pixels": """
        SELECT city, CASE WHEN year = 2014 THEN 2015 ELSE year END AS year, x, y, population FROM {pixels}""",
    "settlement_pixels": """
        SELECT city, CASE WHEN year = 2014 THEN 2015 ELSE year END AS year, x, y, settlements FROM {pixels}""",
    "light_pixels": """
        SELECT city, CASE WHEN year = 2014 THEN 2013 WHEN year = 1990 THEN 1995 ELSE year END AS year, x, y, lights
        FROM {pixels}""",
    "dem": """
        SELECT city, CAST(3825.5e0 + 125 * (pid % 20) AS DOUBLE) AS x,
               CAST(3825.5e0 + 125 * CAST(floor(pid / 20) AS BIGINT) AS DOUBLE) AS y, avg(p) / 141.42135623730951e0 AS val
        FROM (SELECT l_suppkey AS city, (l_orderkey * 17 + l_partkey * 3 + l_linenumber) % 400 AS pid,
                     l_extendedprice AS p FROM {lineitem}) t
        GROUP BY city, pid""",
    "points": """
        SELECT c_custkey AS fid, CAST(floor(c_custkey / 15) AS BIGINT) AS city,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'school' WHEN 'BUILDING' THEN 'place_of_worship'
                    WHEN 'FURNITURE' THEN 'university' WHEN 'HOUSEHOLD' THEN 'hospital' END AS amenity,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'aerodrome' END AS aeroway,
               CAST(3750 + (c_custkey * 7919) % 2503 AS DOUBLE) AS x,
               CAST(3750 + (c_custkey * 104729) % 2503 AS DOUBLE) AS y
        FROM {customer}""",
    "nodes": """
        SELECT p_partkey AS node, CAST(floor(p_partkey / 20) AS BIGINT) AS city,
               CAST(3750 + (p_partkey * 7919) % 2503 AS DOUBLE) AS x,
               CAST(3750 + (p_partkey * 104729) % 2503 AS DOUBLE) AS y,
               36.1e0 + ((p_partkey * 7919) % 10007) / 100000e0 AS lon,
               32.3e0 + ((p_partkey * 104729) % 10007) / 100000e0 AS lat
        FROM {part}""",
    "way_tags": """
        SELECT o_orderkey AS osmid,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'construction' WHEN '2-HIGH' THEN 'residential'
                    WHEN '3-MEDIUM' THEN 'primary' WHEN '4-NOT SPECIFIED' THEN 'proposed' END AS highway,
               CASE WHEN o_orderstatus = 'P' THEN 'yes' END AS area
        FROM {orders}""",
    "way_rows": """
        SELECT l_suppkey * 100 + l_orderkey % 60 AS osmid, l_suppkey AS city, l_orderkey, l_linenumber, l_partkey,
               l_suppkey * 20 + l_partkey % 20 AS node FROM {lineitem}""",
    "water": """
        SELECT p_partkey AS fid, CAST(floor(p_partkey / 20) AS BIGINT) AS city,
               CAST(3750 + (p_partkey * 6271) % 2503 AS DOUBLE) AS wx,
               CAST(3750 + (p_partkey * 15487) % 2503 AS DOUBLE) AS wy,
               CAST(15 + 25 * (p_partkey % 4) AS DOUBLE) AS half,
               CASE WHEN p_size % 2 = 0 THEN 'box' ELSE 'diamond' END AS shape
        FROM {part}""",
    "coord_text": """
        SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'abc' WHEN event_id % 13 = 0 THEN ''
                              WHEN event_id % 17 = 0 THEN '1.2.3'
                              WHEN event_id % 5 = 0 THEN concat('-', CAST(event_id % 90 AS STRING))
                              ELSE concat(CAST(event_id % 90 AS STRING), '.5') END AS lat_text
        FROM {events}""",
    "links": """
        SELECT event_id AS line_no, CAST(1995 + event_id % 19 AS INT) AS year,
               concat('https://example.org/', CAST(event_id AS STRING)) AS link FROM {events}""",
    "scored": """
        SELECT o_orderkey AS row_id, CAST(floor(o_custkey / 15) AS BIGINT) AS city,
               CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS model_id,
               round((o_custkey * 37 + o_orderkey * 11) % 1000 / 1000e0, 5) AS score,
               CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS label
        FROM {orders}""",
    "importances": """
        SELECT CAST(p_size % 5 + 1 AS BIGINT) AS model_id, p_brand AS feature,
               round(sum(p_retailprice) / 1000, 2) AS feature_importance
        FROM {part} GROUP BY p_size % 5 + 1, p_brand""",
}
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings"]


def table(spark, sf: str, name: str):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def layer(spark, sf: str, name: str):
    """A derived layer as a DataFrame."""
    if name not in LAYERS:
        return table(spark, sf, name)
    needed = set(re.findall(r"{(\w+)}", LAYERS[name]))
    return spark.sql(LAYERS[name], **{n: layer(spark, sf, n) for n in needed})


def number(value: float) -> str:
    """A literal that is a double in both engines."""
    text = repr(float(value))
    return text if "e" in text else f"{text}e0"
