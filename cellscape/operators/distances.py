"""Distance layers: water, roads, points of interest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscape.operators.nearest import nearest_point, nearest_segment
from cellscape.operators.skew import join_city_table
from cellscape.operators.sweep import inside_edges, ring_segments
from cellscape.session import materialize


def water_bodies(cells: DataFrame, water: DataFrame, tile: float) -> DataFrame:
    """Distance in km to the nearest polygon ``(city, ring)``; 0 with flag 1 inside one."""
    edges = materialize(ring_segments(water, ["city"]), "water-edges")  # made once for both searches
    to_edge = nearest_segment(cells, edges, tile)
    covered = inside_edges(cells, edges, ["city"], "cx", "cy", tile).select(
        "city", "cell_id", (F.col("winding") != 0).alias("wet"))
    metres = F.when(F.col("wet"), 0.0).otherwise(F.col("distance"))
    return to_edge.join(covered, ["city", "cell_id"]).select(
        "city", "cell_id",
        (metres / 1000).alias("water_bodies_distance_km"),
        F.when(metres > 0, 0).otherwise(1).alias("water_bodies_flag"),
    )


def highways(cells: DataFrame, segments: DataFrame, tile: float) -> DataFrame:
    """Distance in km to the nearest road segment."""
    return nearest_segment(cells, segments, tile).select(
        "city", "cell_id", (F.col("distance") / 1000).alias("distance_highways_km"))


# Amenity of each distance column; the last one is any point with an aeroway tag.
PIN_COLUMNS = {
    "place_of_worship": "worship_distance",
    "school": "school_distance",
    "university": "university_distance",
    "hospital": "hospital_distance",
    "aeroway": "aeroway_distance",
}


def geopins(cells: DataFrame, points: DataFrame, tile: float) -> DataFrame:
    """Distance in km to the nearest point of each kind; NULL for a kind the city lacks.

    All kinds are searched in one pass, with the kind as part of the key.
    """
    kinds = F.array_compact(F.array(
        F.when(F.col("amenity").isin(*[k for k in PIN_COLUMNS if k != "aeroway"]), F.col("amenity")),
        F.when(F.col("aeroway").isNotNull(), F.lit("aeroway")),
    ))
    pins = points.select("city", "x", "y", F.explode(kinds).alias("kind"))
    found = nearest_point(cells, pins, tile, ["kind"])
    columns = [
        (F.min(F.when(F.col("kind") == kind, F.col("distance"))) / 1000).alias(name)
        for kind, name in PIN_COLUMNS.items()
    ]
    per_cell = found.groupBy("city", "cell_id").agg(*columns)
    # a city whose points are all of other kinds still gets its rows
    every = join_city_table(cells.select("city", "cell_id"), points.select("city").distinct())
    return every.join(per_cell, ["city", "cell_id"], "left")
