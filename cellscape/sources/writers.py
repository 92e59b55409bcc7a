"""Writers: layer tables, result tables, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscape.sources.schemas import conform


def append_layer(df: DataFrame, path: str, layer: str, partition_by: list[str] | None = None) -> None:
    """Append layer rows after checking their columns against the declared schema."""
    writer = conform(df, layer).write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Overwrite only the partitions present in ``df``, so that a run can be repeated."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def save_bucketed(df: DataFrame, table: str, buckets: int) -> None:
    """Store a cell layer bucketed by cell, so that the feature join needs no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, "city", "cell_id").sortBy("city", "cell_id").saveAsTable(table)


def prediction_rows(scores: DataFrame) -> DataFrame:
    """Predictions as stored: score to five places, label as boolean."""
    return scores.select(
        "model_id", "city", "year_features", "cell_id",
        F.round("score", 5).alias("score"), F.col("label").cast("boolean").alias("label"))


def export_lines(df: DataFrame, path: str) -> None:
    """One JSON object per line, geometry as WKT text."""
    df.write.mode("overwrite").json(path)
