"""Readers for the input layers.  All schemas are explicit; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscape.functions import geometry as g

OSM_SCHEMA = (
    "elements array<struct<type:string,id:long,lat:double,lon:double,timestamp:string,"
    "nodes:array<long>,tags:map<string,string>>>"
)
BOX_SCHEMA = "bbox_west double, bbox_south double, bbox_east double, bbox_north double"


def pixels(spark: SparkSession, path: str, layer: str, years: list[int] | None = None) -> DataFrame:
    """Pixel rows of one layer; layer and year filters reach the scan."""
    df = spark.read.parquet(path).where(F.col("layer") == layer)
    return df.where(F.col("year").isin(years)) if years else df


def osm_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return spark.read.schema(OSM_SCHEMA).json(path, multiLine=multi_line)


def points_csv(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    schema = "fid long, amenity string, aeroway string, x double, y double"
    return spark.read.schema(schema).csv(path, header=True, encoding=encoding)


def wkt_layer(df: DataFrame, text: str = "wkt") -> DataFrame:
    """Add ``coords`` parsed from a WKT column."""
    return df.withColumn("coords", g.wkt_points(F.col(text)))


def wkt_rings(df: DataFrame, text: str = "wkt") -> DataFrame:
    """One row per ring or line of a WKT column: ``part`` and ``ring`` from 0, ``coords``.

    Rings of polygons have their area on the left, holes on the right; a closing point is kept as it is.
    Empty, missing and unreadable geometries give no row.
    """
    polygon = g.wkt_kind(F.col(text)).isin("POLYGON", "MULTIPOLYGON")
    parts = df.select(*[c for c in df.columns if c != text], polygon.alias("_polygon"), F.posexplode(g.wkt_parts(F.col(text))).alias("part", "_rings"))
    rings = parts.select("*", F.posexplode("_rings").alias("ring", "coords"))
    turned = F.when(F.col("_polygon"), g.oriented(F.col("coords"), F.col("ring") == 0)).otherwise(F.col("coords"))
    return rings.withColumn("coords", turned).drop("_polygon", "_rings")


def wkt_file(spark: SparkSession, path: str, fields: str, encoding: str = "UTF-8") -> DataFrame:
    """Rings of a delimited file with the columns ``fields`` and, last, a WKT text."""
    rows = spark.read.schema(f"{fields}, wkt string").csv(path, sep="\t", encoding=encoding)
    return wkt_rings(rows)


def links_csv(spark: SparkSession, path: str) -> DataFrame:
    """Year to link list; ``line_no`` keeps the order of the file."""
    df = spark.read.schema("year int, link string").csv(path, header=True)
    return df.withColumn("line_no", F.monotonically_increasing_id())


def first_link_per_year(links: DataFrame) -> DataFrame:
    """The first line of each year: an aggregate with partial minima."""
    return links.groupBy("year").agg(F.min_by("link", "line_no").alias("link"))


def bounding_boxes(df: DataFrame, text: str) -> DataFrame:
    """Add the four bounds read from a JSON column."""
    return df.withColumn("_box", F.from_json(text, BOX_SCHEMA)).select("*", "_box.*").drop("_box")
