"""OpenStreetMap preparation: elements, tags, road lines, points of interest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscape import config
from cellscape.functions import geometry as g
from cellscape.operators.overlay import clip_to_boxes
from cellscape.operators.skew import join_counted
from cellscape.session import materialize


def split_elements(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and ways of documents with an ``elements`` array."""
    e = documents.select(F.explode("elements").alias("e")).select("e.*")
    stamp = F.to_timestamp("timestamp").alias("timestamp")
    nodes = e.where("type = 'node'").select(F.col("id").alias("osmid"), "lon", "lat", stamp, "tags")
    ways = e.where("type = 'way'").select(
        F.col("id").alias("osmid"), without_repeats(F.col("nodes")).alias("nodes"), stamp, "tags")
    return nodes, ways


def without_repeats(items: Column) -> Column:
    """Drop elements equal to the one before them."""
    return F.filter(items, lambda x, i: (i == 0) | (x != F.get(items, i - 1)))


def drop_repeated_nodes(way_nodes: DataFrame) -> DataFrame:
    """The same on ``(osmid, pos, node)`` rows: a self join on position, so a long way is spread."""
    previous = way_nodes.select("osmid", (F.col("pos") + 1).alias("pos"), F.col("node").alias("previous"))
    return way_nodes.join(previous, ["osmid", "pos"], "left").where(
        F.col("previous").isNull() | (F.col("previous") != F.col("node"))).drop("previous")


def way_segments(way_nodes: DataFrame, nodes: DataFrame, hot_rows: int = 1_000_000) -> DataFrame:
    """Segments ``(osmid, pos, x1, y1, x2, y2)`` between consecutive different nodes of a way.

    ``way_nodes`` is ``(osmid, pos, node)``, ``nodes`` is ``(node, x, y)``; other node columns are
    kept from the first end.
    """
    # both are read more than once, so they are stored
    refs = materialize(way_nodes.groupBy("node").agg(F.count("*").alias("n_refs")).join(nodes, "node"), "node-references")
    placed = materialize(join_counted(way_nodes, refs, ["node"], "n_refs", hot_rows).drop("n_refs"), "placed-nodes")
    after = placed.select(
        "osmid", (F.col("pos") - 1).alias("pos"), F.col("node").alias("node2"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    return placed.join(after, ["osmid", "pos"]).where("node <> node2").drop("node", "node2").withColumnsRenamed(
        {"x": "x1", "y": "y1"})


def is_road(highway: Column, area: Column, require_tag: bool = False) -> Column:
    """The road filter.  A missing tag passes, so ways without a highway tag stay unless required."""
    passed = ~F.coalesce(area.rlike(config.EXCLUDED_AREA), F.lit(False)) & ~F.coalesce(
        highway.rlike(config.EXCLUDED_HIGHWAY), F.lit(False))
    return passed & highway.isNotNull() if require_tag else passed


def keep_ways(way_nodes: DataFrame, kept: DataFrame, hot_rows: int = 1_000_000) -> DataFrame:
    """Node rows of the ways in ``kept``; one way may hold most rows."""
    sizes = materialize(
        way_nodes.groupBy("osmid").agg(F.count("*").alias("n_nodes")).join(kept.select("osmid"), "osmid"), "way-sizes")
    return join_counted(way_nodes, sizes, ["osmid"], "n_nodes", hot_rows).drop("n_nodes")


def has_point_tag(tags: Column) -> Column:
    return F.exists(F.map_keys(tags), lambda k: k.isin(*config.POINT_TAGS))


def points_of_interest(nodes: DataFrame) -> DataFrame:
    """Tagged nodes with coordinates, once each, with the two tags the distances use.

    Of several versions of a node the newest stays, and of equally new ones that with the largest tags text.
    """
    newest = [F.desc_nulls_last("timestamp")] if "timestamp" in nodes.columns else []
    version = F.row_number().over(Window.partitionBy("osmid").orderBy(*newest, F.desc(F.to_json("tags"))))
    return (
        nodes.where(has_point_tag(F.col("tags")) & F.col("lon").isNotNull() & F.col("lat").isNotNull())
        .withColumn("version", version).where("version = 1").drop("version")
        .withColumns({"amenity": F.try_element_at("tags", F.lit("amenity")),
                      "aeroway": F.try_element_at("tags", F.lit("aeroway"))})
    )


def is_coordinate(text: Column) -> Column:
    return text.rlike(config.COORDINATE_PATTERN)


def to_coordinate(text: Column) -> Column:
    return F.when(is_coordinate(text), text.try_cast("double"))


def in_box(lon: Column, lat: Column, west, south, east, north) -> Column:
    return (lon >= west) & (lon <= east) & (lat >= south) & (lat <= north)


def normalize_tag_keys(tags: Column) -> Column:
    """Lower-case keys with ``_`` for ``:`` and the short names; keys outside latin-1 become ``undef_n``.

    When two keys end up equal, the first one wins.
    """
    renames = F.create_map(*[F.lit(v) for pair in config.TAG_RENAMES.items() for v in pair])
    keys = F.transform(F.map_keys(tags), lambda k: F.replace(F.lower(k), F.lit(":"), F.lit("_")))

    def is_latin1(k):
        return ~k.rlike(r"[^\x{00}-\x{ff}]")

    numbered = F.transform(keys, lambda k, i: F.when(is_latin1(k), F.coalesce(F.try_element_at(renames, k), k)).otherwise(
        F.concat(F.lit("undef_"), F.size(F.filter(F.slice(keys, F.lit(1), i + 1), lambda p: ~is_latin1(p))).cast("string"))))
    entries = F.zip_with(numbered, F.map_values(tags), lambda k, v: F.struct(k.alias("key"), v.alias("value")))
    first = F.filter(entries, lambda e, i: F.array_position(numbered, e["key"]) == i + 1)
    return F.map_from_entries(first)


def stringify(df: DataFrame, columns: list[str]) -> DataFrame:
    """Attributes as text, NULL as the empty text."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns})


def water_in_box(water: DataFrame, parts: str = "drop") -> DataFrame:
    """Water rings cut to the box of their row, one row per part; empty results are dropped.

    ``water`` is ``(city, fid, ring, xmin, ymin, xmax, ymax)``; its other columns name the ring and are not null.
    A ring that is not convex may fall into several parts: ``drop`` leaves such a ring out, as only single
    polygons are kept by default, ``keep`` returns all parts.
    """
    if parts not in ("drop", "keep"):
        raise ValueError(f"parts is drop or keep, not {parts}")
    cut = g.clip_ring_to_box(F.col("ring"), F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))
    kept = [c for c in water.columns if c not in ("ring", "xmin", "ymin", "xmax", "ymax")]
    valid = water.where(g.is_valid_ring(F.col("ring")))
    bent = valid.where(~g.is_convex(F.col("ring")))
    # the clip goes through a generator, which the filters below it cannot be pushed past: it runs once
    single = (
        valid.where(g.is_convex(F.col("ring")))
        .select(*kept, F.explode(F.array(cut)).alias("ring"))
        .where(g.is_valid_ring(F.col("ring")))
        .where(F.abs(g.ring_signed_area(F.col("ring"))) > 0)
    )
    if bent.isEmpty():
        return single
    several = clip_to_boxes(bent, kept)
    if parts == "drop":
        once = several.groupBy(*kept).agg(F.count("*").alias("n")).where("n = 1").drop("n")
        several = several.join(once, kept, "left_semi")
    return single.unionByName(several.select(*kept, "ring"))
