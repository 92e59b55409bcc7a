"""SQL building blocks for the checks (DuckDB), by other ways than the library where there is one:
brute force for distances, closed forms for clipping, recursion for components."""

from __future__ import annotations

import re

from catalog.derive import LAYERS, SIDE, number
from cellscape.functions.geometry import SQRT3, apothem

B, H = apothem(SIDE), SQRT3 / 2
b, s, h, b2 = number(B), number(SIDE), number(H), number(2 * B)


def meets(half: float) -> str:
    """Hexagon at (cx, cy) shares a point with the pixel square of half size ``half`` at (x, y)."""
    slant = number(B + half / 2 + half * H)
    return f"""abs(g.cx - p.x) <= {number(B + half)} AND abs(g.cy - p.y) <= {number(SIDE + half)}
        AND abs((g.cx - p.x) / 2 + (g.cy - p.y) * {h}) <= {slant}
        AND abs((g.cx - p.x) / 2 - (g.cy - p.y) * {h}) <= {slant}"""


def segment_distance(px: str, py: str) -> str:
    t = (f"greatest(0e0, least(1e0, CASE WHEN x1 = x2 AND y1 = y2 THEN 0e0 ELSE (({px} - x1) * (x2 - x1) + ({py} - y1) * (y2 - y1))"
         f" / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) END))")
    return (f"sqrt(({px} - x1 - {t} * (x2 - x1)) * ({px} - x1 - {t} * (x2 - x1))"
            f" + ({py} - y1 - {t} * (y2 - y1)) * ({py} - y1 - {t} * (y2 - y1)))")


# distance from (u.cx, u.cy) to the hexagon at (m.cx, m.cy): 0 inside, else to the nearest of its six edges
_CORNERS = [(0.0, -SIDE), (B, -SIDE / 2), (B, SIDE / 2), (0.0, SIDE), (-B, SIDE / 2), (-B, -SIDE / 2)]


def hexagon_distance() -> str:
    dx, dy = "(u.cx - m.cx)", "(u.cy - m.cy)"
    parts = []
    for (ax, ay), (bx, by) in zip(_CORNERS, _CORNERS[1:] + _CORNERS[:1]):
        ex, ey = bx - ax, by - ay
        t = (f"greatest(0e0, least(1e0, (({dx} - {number(ax)}) * {number(ex)} + ({dy} - {number(ay)}) * {number(ey)})"
             f" / {number(ex * ex + ey * ey)}))")
        qx, qy = f"({dx} - {number(ax)} - {t} * {number(ex)})", f"({dy} - {number(ay)} - {t} * {number(ey)})"
        parts.append(f"{qx} * {qx} + {qy} * {qy}")
    inside = (f"abs({dx}) <= {b} AND abs({dx} / 2 + {dy} * {h}) <= {b} AND abs({dx} / 2 - {dy} * {h}) <= {b}")
    return f"CASE WHEN {inside} THEN 0e0 ELSE sqrt(least({', '.join(parts)})) END"


_STAT = {"min": "min", "max": "max", "mean": "avg", "stddev": "stddev_samp", "sum": "sum"}


def statistics(column: str, suffix: str, names: list[str]) -> str:
    places = {"sum": 4}
    return ", ".join(f"round({_STAT[n]}({column}), {places.get(n, 6)}) AS {n}_{suffix}" for n in names)


def yearly_zonal(layer: str, column: str, suffix: str, names: list[str], year_map: dict[int, int]) -> str:
    years = ", ".join(f"({d}, {m})" for d, m in year_map.items())
    return f"""
        SELECT g.city, g.cell_id, t.year, t.year_model, {statistics('p.' + column, suffix, names)}
        FROM {{grid}} g CROSS JOIN (VALUES {years}) t(year, year_model)
        LEFT JOIN {{{layer}}} p ON p.city = g.city AND p.year = t.year AND {meets(125)}
        GROUP BY ALL"""


def region_zonal(column: str, suffix: str, names: list[str]) -> str:
    return f"""
        SELECT city, cell_id, year, year_model, {statistics('val', suffix, names)}
        FROM (SELECT DISTINCT g.city, g.cell_id, t.year, t.year AS year_model, p.region_id, p.val
              FROM {{grid}} g CROSS JOIN (VALUES (1990), (2000), (2014)) t(year)
              LEFT JOIN {{regions_{column}}} p ON p.city = g.city AND p.year = t.year AND {meets(125)}) z
        GROUP BY ALL"""


def regions(column: str) -> dict[str, str]:
    """4-connected regions of equal value by repeated spreading of the smaller id."""
    n, r = f"region_nodes_{column}", f"region_reach_{column}"
    return {
        n: f"""
        SELECT city, year, x, y, CAST(floor(y / 250) AS BIGINT) * 1048576 + CAST(floor(x / 250) AS BIGINT) AS id,
               {column} AS val FROM {{pixels}}""",
        r: f"""
        SELECT city, year, id, id AS label, val FROM {{{n}}}
        UNION
        SELECT p.city, p.year, p.id, r.label, p.val FROM {{{r}}} r JOIN {{{n}}} p
          ON p.city = r.city AND p.year = r.year AND p.val = r.val AND r.label < p.id
         AND p.id IN (r.id + 1, r.id - 1, r.id + 1048576, r.id - 1048576)""",
        f"regions_{column}": f"""
        SELECT n.city, n.year, n.x, n.y, n.val, m.label AS region_id FROM {{{n}}} n
        JOIN (SELECT city, year, id, min(label) AS label FROM {{{r}}} GROUP BY ALL) m USING (city, year, id)""",
    }


_hd = hexagon_distance()
URBAN_SET = "(40e0, 75e0), (50e0, 120e0)"

EXPECTED: dict[str, str] = {
    "grid_all": f"""
        SELECT city, CAST("row" * 1048576 + "col" AS BIGINT) AS cell_id, "row", "col",
               xmin + {b2} * "col" + {b} * ("row" % 2) AS cx, ymin + {number(1.5 * SIDE)} * "row" + {s} AS cy, half
        FROM (SELECT city, xmin, ymin, half, "row", unnest(range(0, ncol + 1)) AS "col"
              FROM (SELECT city, xmin, ymin, (xmax - xmin) / 2 AS half, CAST(ceil(abs(xmax - xmin) / {b2}) AS BIGINT) AS ncol,
                           unnest(range(0, 2 * CAST(ceil(abs(ymax - ymin) / {number(2 * SIDE)}) AS BIGINT) + 2)) AS "row"
                    FROM {{boxes}}) r) c""",
    # octagon with corners (+-half, +-0.45 half) and (+-0.45 half, +-half): separating axes
    "grid": f"""
        SELECT city, cell_id, "row", "col", cx, cy FROM {{grid_all}}
        WHERE abs(cx - 5000) <= half + {b} AND abs(cy - 5000) <= half + {s}
          AND abs(cx - 5000) + abs(cy - 5000) <= 1.45e0 * half + {number(B + SIDE / 2)}
          AND abs((cx - 5000) / 2 + (cy - 5000) * {h}) <= {b} + half * {number(0.225 + H)}
          AND abs((cx - 5000) / 2 - (cy - 5000) * {h}) <= {b} + half * {number(0.225 + H)}""",
    "adjacent": f"""
        SELECT a.city, a.cell_id, n.cell_id AS neighbour_id FROM {{grid}} a JOIN {{grid}} n
          ON a.city = n.city AND a.cell_id <> n.cell_id
         AND (a.cx - n.cx) * (a.cx - n.cx) + (a.cy - n.cy) * (a.cy - n.cy) < {number((2.1 * B) ** 2)}""",
    "built": yearly_zonal("pixels", "built", "built_lds", ["min", "max", "mean", "stddev", "sum"],
                          {1990: 1990, 2000: 2000, 2014: 2014}),
    "people": yearly_zonal("population_pixels", "population", "population", ["min", "max", "mean", "stddev", "sum"],
                           {1990: 1990, 2000: 2000, 2015: 2014}),
    "settled": yearly_zonal("settlement_pixels", "settlements", "settlements", ["min", "max", "mean", "sum"],
                            {1990: 1990, 2000: 2000, 2015: 2014}),
    "lit": yearly_zonal("light_pixels", "lights", "city_lights", ["min", "max", "mean", "stddev", "sum"],
                        {1995: 1990, 2000: 2000, 2013: 2014}),
    "height": f"""
        SELECT g.city, g.cell_id, {statistics('p.val', 'dem', ['min', 'max', 'mean', 'stddev'])}
        FROM {{grid}} g LEFT JOIN {{dem}} p ON p.city = g.city AND {meets(62.5)} GROUP BY ALL""",
    "steepness": """
        SELECT city, x, y, 100 * sqrt(p * p + q * q) AS slope_pct, degrees(atan(sqrt(p * p + q * q))) AS slope_degrees
        FROM (SELECT c.city, c.x, c.y,
                (coalesce(se.val, c.val) + 2 * coalesce(e.val, c.val) + coalesce(ne.val, c.val)
                 - coalesce(sw.val, c.val) - 2 * coalesce(w.val, c.val) - coalesce(nw.val, c.val)) / 1000e0 AS p,
                (coalesce(nw.val, c.val) + 2 * coalesce(n.val, c.val) + coalesce(ne.val, c.val)
                 - coalesce(sw.val, c.val) - 2 * coalesce(s.val, c.val) - coalesce(se.val, c.val)) / 1000e0 AS q
              FROM {dem} c
              LEFT JOIN {dem} e ON e.city = c.city AND e.x = c.x + 125 AND e.y = c.y
              LEFT JOIN {dem} w ON w.city = c.city AND w.x = c.x - 125 AND w.y = c.y
              LEFT JOIN {dem} n ON n.city = c.city AND n.x = c.x AND n.y = c.y + 125
              LEFT JOIN {dem} s ON s.city = c.city AND s.x = c.x AND s.y = c.y - 125
              LEFT JOIN {dem} ne ON ne.city = c.city AND ne.x = c.x + 125 AND ne.y = c.y + 125
              LEFT JOIN {dem} nw ON nw.city = c.city AND nw.x = c.x - 125 AND nw.y = c.y + 125
              LEFT JOIN {dem} se ON se.city = c.city AND se.x = c.x + 125 AND se.y = c.y - 125
              LEFT JOIN {dem} sw ON sw.city = c.city AND sw.x = c.x - 125 AND sw.y = c.y - 125) d""",
    "cell_slope": f"""
        SELECT g.city, g.cell_id, {statistics('p.slope_pct', 'slope_pct', ['min', 'max', 'mean', 'stddev'])},
               {statistics('p.slope_degrees', 'slope_degrees', ['min', 'max', 'mean', 'stddev'])}
        FROM {{grid}} g LEFT JOIN {{steepness}} p ON p.city = g.city AND {meets(62.5)} GROUP BY ALL""",
    "way_nodes": """
        SELECT osmid, city, node, row_number() OVER (PARTITION BY osmid ORDER BY l_orderkey, l_linenumber, l_partkey) AS pos
        FROM {way_rows}""",
    "roads": """
        SELECT osmid FROM {way_tags}
        WHERE NOT coalesce(regexp_matches(area, 'yes'), false)
          AND NOT coalesce(regexp_matches(highway, 'proposed|construction|abandoned|platform|raceway'), false)""",
    "road_segments": """
        SELECT a.city, a.osmid, a.pos, n1.x AS x1, n1.y AS y1, n2.x AS x2, n2.y AS y2
        FROM {way_nodes} a JOIN {roads} k USING (osmid)
        JOIN {way_nodes} c ON c.osmid = a.osmid AND c.pos = a.pos + 1 AND c.node <> a.node
        JOIN {nodes} n1 ON n1.node = a.node JOIN {nodes} n2 ON n2.node = c.node""",
    "road_distance": f"""
        SELECT g.city, g.cell_id, min({segment_distance('g.cx', 'g.cy')}) / 1000 AS distance_highways_km
        FROM {{grid}} g JOIN {{road_segments}} r ON r.city = g.city GROUP BY ALL""",
    "pin_distance": """
        SELECT g.city, g.cell_id,
               min(CASE WHEN amenity = 'place_of_worship' THEN sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)) END) / 1000 AS worship_distance,
               min(CASE WHEN amenity = 'school' THEN sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)) END) / 1000 AS school_distance,
               min(CASE WHEN amenity = 'university' THEN sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)) END) / 1000 AS university_distance,
               min(CASE WHEN amenity = 'hospital' THEN sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)) END) / 1000 AS hospital_distance,
               min(CASE WHEN aeroway IS NOT NULL THEN sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)) END) / 1000 AS aeroway_distance
        FROM {grid} g JOIN {points} p ON p.city = g.city GROUP BY ALL""",
    # closed forms for an axis-parallel box and for a diamond, folded to one quadrant
    "water_distance": f"""
        SELECT city, cell_id, min(d) / 1000 AS water_bodies_distance_km, CASE WHEN min(d) > 0 THEN 0 ELSE 1 END AS water_bodies_flag
        FROM (SELECT g.city, g.cell_id, CASE
                WHEN shape = 'box' THEN sqrt(greatest(abs(cx - wx) - half, 0) * greatest(abs(cx - wx) - half, 0)
                                           + greatest(abs(cy - wy) - half, 0) * greatest(abs(cy - wy) - half, 0))
                WHEN abs(cx - wx) + abs(cy - wy) <= half THEN 0e0
                WHEN abs(abs(cx - wx) - abs(cy - wy)) <= half THEN (abs(cx - wx) + abs(cy - wy) - half) / sqrt(2e0)
                ELSE sqrt((greatest(abs(cx - wx), abs(cy - wy)) - half) * (greatest(abs(cx - wx), abs(cy - wy)) - half)
                        + least(abs(cx - wx), abs(cy - wy)) * least(abs(cx - wx), abs(cy - wy))) END AS d
              FROM {{grid}} g JOIN {{water}} w ON w.city = g.city) t GROUP BY ALL""",
    "centre_edges": """
        SELECT city, mx + 300 * cos(i * 2 * pi() / 32) AS x1, 5000 + 300 * sin(i * 2 * pi() / 32) AS y1,
               mx + 300 * cos((i + 1) * 2 * pi() / 32) AS x2, 5000 + 300 * sin((i + 1) * 2 * pi() / 32) AS y2
        FROM (SELECT city, 5000e0 + city % 7 * 40 AS mx, unnest(range(0, 32)) AS i FROM {city}) c""",
    "centre": f"""
        SELECT g.city, g.cell_id, CASE WHEN bool_and((x2 - x1) * (cy - y1) - (y2 - y1) * (cx - x1) >= 0) THEN 0e0
               ELSE min({segment_distance('cx', 'cy')}) / 1000 END AS city_center_distance_km
        FROM {{grid}} g JOIN {{centre_edges}} e ON e.city = g.city GROUP BY ALL""",
    **regions("built_step"),
    **regions("settlements"),
    "urban": f"""
        SELECT a.city, a.year_model, t.bt AS built_threshold, t.pt AS population_threshold, a.cell_id
        FROM {{built}} a JOIN {{people}} p ON p.city = a.city AND p.cell_id = a.cell_id AND p.year_model = a.year_model
        JOIN (VALUES {URBAN_SET}) t(bt, pt) ON a.max_built_lds > t.bt / 100 AND p.max_population >= t.pt""",
    "urban_links": """
        SELECT u.city, u.year_model, u.built_threshold, u.population_threshold, u.cell_id AS a, n.cell_id AS z
        FROM {urban} u JOIN {adjacent} d ON d.city = u.city AND d.cell_id = u.cell_id
        JOIN {urban} n ON n.city = u.city AND n.year_model = u.year_model AND n.built_threshold = u.built_threshold
                      AND n.population_threshold = u.population_threshold AND n.cell_id = d.neighbour_id""",
    "urban_reach": """
        SELECT city, year_model, built_threshold, population_threshold, cell_id, cell_id AS label FROM {urban}
        UNION
        SELECT l.city, l.year_model, l.built_threshold, l.population_threshold, l.z, r.label
        FROM {urban_reach} r JOIN {urban_links} l ON l.city = r.city AND l.year_model = r.year_model
         AND l.built_threshold = r.built_threshold AND l.population_threshold = r.population_threshold
         AND l.a = r.cell_id AND r.label < l.z""",
    "members": """
        SELECT city, year_model, built_threshold, population_threshold, cell_id, min(label) AS root
        FROM {urban_reach} GROUP BY ALL""",
    "clusters": """
        SELECT m.city, m.year_model, m.built_threshold, m.population_threshold, m.root, sum(p.people) AS population,
               count(*) AS n_cells,
               row_number() OVER (PARTITION BY m.city, m.year_model, m.built_threshold, m.population_threshold ORDER BY m.root) AS cluster_id
        FROM {members} m JOIN (SELECT city, cell_id, sum(mean_population) AS people FROM {people_exact} GROUP BY ALL) p
          ON p.city = m.city AND p.cell_id = m.cell_id
        GROUP BY m.city, m.year_model, m.built_threshold, m.population_threshold, m.root""",
    "people_exact": f"""
        SELECT g.city, g.cell_id, p.year, CASE WHEN p.year = 2015 THEN 2014 ELSE p.year END AS year_model, avg(p.population) AS mean_population
        FROM {{grid}} g JOIN {{population_pixels}} p ON p.city = g.city AND {meets(125)} GROUP BY ALL""",
    "qualified": """
        SELECT c.*, t.ct AS cluster_threshold FROM {clusters} c
        JOIN (VALUES (40e0, 75e0, 5000e0), (50e0, 120e0, 12000e0)) t(bt, pt, ct)
          ON c.built_threshold = t.bt AND c.population_threshold = t.pt AND c.population >= t.ct""",
    "chosen": """
        SELECT m.*, q.cluster_id, q.cluster_threshold, g.cx, g.cy FROM {members} m
        JOIN {qualified} q USING (city, year_model, built_threshold, population_threshold, root)
        JOIN {grid} g USING (city, cell_id)""",
    "urban_dist": f"""
        SELECT u.city, u.cell_id, m.year_model, m.built_threshold, m.population_threshold, m.cluster_threshold,
               CASE WHEN min({_hd}) > 0 THEN 0 ELSE 1 END AS urban_flag, min({_hd}) / 1000 AS urban_distance_km
        FROM {{grid}} u JOIN {{chosen}} m ON m.city = u.city GROUP BY ALL""",
    "labels_next": """
        SELECT g.city, g.cell_id, p.year_model,
               max(CASE WHEN c.cell_id IS NULL THEN 0 ELSE 1 END) AS label
        FROM {grid} g
        JOIN (SELECT DISTINCT city, CASE year_model WHEN 2014 THEN 2000 WHEN 2000 THEN 1990 END AS year_model
              FROM {chosen} WHERE built_threshold = 40 AND year_model > 1990) p ON p.city = g.city
        LEFT JOIN {chosen} c ON c.city = g.city AND c.cell_id = g.cell_id AND c.built_threshold = 40
              AND c.year_model = CASE p.year_model WHEN 2000 THEN 2014 WHEN 1990 THEN 2000 END
        GROUP BY ALL""",
    "wide": """
        SELECT r.city, r.cell_id, p.year_model,
               coalesce(s.max_slope_pct, 0) AS max_slope_pct, coalesce(l.mean_city_lights, 0) AS mean_city_lights,
               coalesce(a.max_built_lds, 0) AS max_built_lds,
               coalesce(t.university_distance, 0) AS university_distance, coalesce(t.school_distance, 0) AS school_distance,
               coalesce(t.hospital_distance, 0) AS hospital_distance, coalesce(t.worship_distance, 0) AS worship_distance,
               coalesce(t.aeroway_distance, 0) AS aeroway_distance, coalesce(r.distance_highways_km, 0) AS distance_highways_km,
               coalesce(p.mean_population, 0) AS mean_population,
               coalesce(w.water_bodies_distance_km, 0) AS water_bodies_distance_km,
               CAST(coalesce(w.water_bodies_flag, 0) AS DOUBLE) AS water_bodies_flag,
               coalesce(m.city_center_distance_km, 0) AS city_center_distance_km,
               CAST(coalesce(u1.urban_flag, 0) AS DOUBLE) AS urban_flag, coalesce(u1.urban_distance_km, 0) AS urban_distance_km,
               coalesce(u2.urban_distance_km, 0) AS high_density_distance_km
        FROM {road_distance} r
        LEFT JOIN {cell_slope} s USING (city, cell_id)
        LEFT JOIN {pin_distance} t USING (city, cell_id)
        LEFT JOIN {water_distance} w USING (city, cell_id)
        LEFT JOIN {centre} m USING (city, cell_id)
        LEFT JOIN {people} p USING (city, cell_id)
        LEFT JOIN {built} a USING (city, cell_id, year_model)
        LEFT JOIN {lit} l USING (city, cell_id, year_model)
        JOIN {urban_dist} u1 ON u1.city = r.city AND u1.cell_id = r.cell_id AND u1.year_model = p.year_model AND u1.built_threshold = 40
        JOIN {urban_dist} u2 ON u2.city = r.city AND u2.cell_id = r.cell_id AND u2.year_model = p.year_model AND u2.built_threshold = 50""",
    "confusion": """
        SELECT model_id, cutoff, count(*) FILTER (WHERE score >= cutoff AND label = 1) AS tp,
               count(*) FILTER (WHERE score < cutoff AND label = 0) AS tn,
               count(*) FILTER (WHERE score >= cutoff AND label = 0) AS fp,
               count(*) FILTER (WHERE score < cutoff AND label = 1) AS fn
        FROM {scored} CROSS JOIN (SELECT i / 100e0 AS cutoff FROM range(10, 91, 5) t(i)) c GROUP BY ALL""",
    "folds": """
        SELECT model_id, row_id, score, label, ntile(5) OVER (PARTITION BY model_id ORDER BY row_id) AS fold FROM {scored}""",
    "fold_confusion": """
        SELECT model_id, fold, cutoff, count(*) FILTER (WHERE score >= cutoff AND label = 1) AS tp,
               count(*) FILTER (WHERE score < cutoff AND label = 0) AS tn,
               count(*) FILTER (WHERE score >= cutoff AND label = 0) AS fp,
               count(*) FILTER (WHERE score < cutoff AND label = 1) AS fn
        FROM {folds} CROSS JOIN (SELECT i / 100e0 AS cutoff FROM range(10, 91, 5) t(i)) c GROUP BY ALL""",
    "city_confusion": """
        SELECT city, model_id, cutoff, count(*) FILTER (WHERE score >= cutoff AND label = 1) AS tp,
               count(*) FILTER (WHERE score >= cutoff AND label = 0) AS fp,
               count(*) FILTER (WHERE score < cutoff AND label = 1) AS fn
        FROM {scored} CROSS JOIN (SELECT i / 100e0 AS cutoff FROM range(10, 91, 5) t(i)) c GROUP BY ALL""",
    "best": """
        SELECT city, model_type, model_id, cutoff, f1 AS value FROM (
          SELECT *, row_number() OVER (PARTITION BY city, model_type ORDER BY f1 DESC NULLS LAST, model_id, cutoff) AS n
          FROM (SELECT city, model_id, cutoff, CASE WHEN model_id <= 2 THEN 'RandomForest' WHEN model_id <= 4 THEN 'ExtraTrees'
                       ELSE 'LogisticRegression' END AS model_type,
                       CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) END AS f1
                FROM {city_confusion}) e WHERE f1 IS NOT NULL) o WHERE n = 1""",
    "cell_scores": """
        SELECT m AS model_id, city, cell_id, round(((cell_id % 100003) * 37 + m * 11 + city * 13) % 1000 / 1000e0, 5) AS score
        FROM (SELECT city, cell_id, unnest(range(1, 6)) AS m FROM {grid}) t""",
    "best_cells": """
        SELECT p.city, x.model_type, p.model_id, p.cell_id FROM {cell_scores} p
        JOIN {best} x ON x.city = p.city AND x.model_id = p.model_id WHERE p.score >= x.cutoff""",
    "best_positions": """
        SELECT c.city, c.model_type, c.cell_id // 1048576 AS "row", c.cell_id % 1048576 AS "col" FROM {best_cells} c""",
    # each side of a cell by its middle point, in eighths of the lattice: shared sides meet there
    "cell_sides": """
        SELECT city, model_type, 4 * "col" + 2 * ("row" % 2) + mx AS mx, 6 * "row" + my AS my FROM {best_positions}
        CROSS JOIN (VALUES (1, -3), (2, 0), (1, 3), (-1, 3), (-2, 0), (-1, -3)) t(mx, my)""",
    "best_links": """
        SELECT b.city, b.model_type, b.cell_id AS a, n.cell_id AS z FROM {best_cells} b
        JOIN {adjacent} d ON d.city = b.city AND d.cell_id = b.cell_id
        JOIN {best_cells} n ON n.city = b.city AND n.model_type = b.model_type AND n.cell_id = d.neighbour_id""",
    "best_reach": """
        SELECT city, model_type, cell_id, cell_id AS label FROM {best_cells}
        UNION
        SELECT l.city, l.model_type, l.z, r.label FROM {best_reach} r
        JOIN {best_links} l ON l.city = r.city AND l.model_type = r.model_type AND l.a = r.cell_id AND r.label < l.z""",
    "best_areas": """
        SELECT city, model_type, cell_id // 1048576 AS "row", cell_id % 1048576 AS "col", min(label) AS area
        FROM {best_reach} GROUP BY ALL""",
    # rings by Euler's formula: corners - sides + cells of one area is 1 less its holes
    "area_corners": """
        SELECT city, model_type, area, count(DISTINCT (2 * "col" + "row" % 2 + dx, 3 * "row" + dy)) AS n_corners FROM {best_areas}
        CROSS JOIN (VALUES (0, -2), (1, -1), (1, 1), (0, 2), (-1, 1), (-1, -1)) t(dx, dy) GROUP BY ALL""",
    "area_sides": """
        SELECT city, model_type, area, count(*) AS n_sides, count(*) FILTER (n = 1) AS n_outer FROM (
          SELECT city, model_type, area, 4 * "col" + 2 * ("row" % 2) + mx AS mx, 6 * "row" + my AS my, count(*) AS n FROM {best_areas}
          CROSS JOIN (VALUES (1, -3), (2, 0), (1, 3), (-1, 3), (-2, 0), (-1, -3)) t(mx, my) GROUP BY ALL) s GROUP BY ALL""",
}


def build(final: str) -> str:
    """A statement with all the blocks ``final`` names, in order of need."""
    blocks: dict[str, str] = {}

    def need(text: str) -> str:
        for name in re.findall(r"{(\w+)}", text):
            body = EXPECTED.get(name) or LAYERS.get(name)
            if body is not None and name not in blocks and name not in pending:
                pending.add(name)
                made = need(body)
                recursive = f"{{{name}}}" in body
                blocks[name] = f"{name} AS {'' if recursive else 'MATERIALIZED '}({made})"
        # a layer may share its name with a table it is not
        return re.sub(r"{(\w+)}", r"\1", text)

    pending: set[str] = set()
    body = need(final)
    if not blocks:
        return body.strip()
    return "WITH RECURSIVE " + ",\n".join(blocks.values()) + "\n" + body.strip()
