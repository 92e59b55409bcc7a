"""Wide feature table, training frame, and key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscape import config

CELL = ["city", "cell_id"]
CELL_YEAR = ["city", "cell_id", "year_model"]


def features_wide(
    layers: dict[str, DataFrame], urban: DataFrame, features: list[str],
    urban_thresholds: dict, dense_thresholds: dict,
) -> DataFrame:
    """Selected features per ``(city, cell_id, year_model)``, missing values 0.

    Rows are those of the roads layer and the periods of the population layer.  A row needs an urban
    distance for both threshold sets.  Static layers are joined first, on ``(city, cell_id)``; then
    all yearly ones on ``(city, cell_id, year_model)``: every layer is shuffled once, the rows twice.
    """
    provided = {c: layer for layer, cols in config.LAYER_COLUMNS.items() for c in cols}
    unknown = [f for f in features if f not in provided and f not in config.URBAN_COLUMNS]
    if unknown:
        raise ValueError(f"no layer provides {', '.join(unknown)}")
    wanted: dict[str, list[str]] = {}
    for f in features:
        if f in provided:
            wanted.setdefault(provided[f], []).append(f)

    joined = layers["highways"].select(*CELL, *wanted.get("highways", []))
    for layer in config.STATIC_LAYERS:
        if layer in wanted:
            joined = joined.join(layers[layer].select(*CELL, *wanted[layer]), CELL, "left")
    joined = joined.join(
        layers["population"].select(*CELL, "year_model", *wanted.get("population", [])), CELL, "left")
    for layer in config.YEARLY_LAYERS:
        if layer in wanted:
            joined = joined.join(layers[layer].select(*CELL_YEAR, *wanted[layer]), CELL_YEAR, "left")

    def at(t: dict, prefix: str) -> DataFrame:
        return urban.where(
            (F.col("built_threshold") == float(t["built"])) & (F.col("population_threshold") == float(t["population"]))
            & (F.col("cluster_threshold") == float(t["cluster"]))
        ).select(*CELL_YEAR, F.col("urban_flag").alias(f"{prefix}_flag"), F.col("urban_distance_km").alias(f"{prefix}_km"))

    joined = joined.join(at(urban_thresholds, "u1"), CELL_YEAR).join(at(dense_thresholds, "u2"), CELL_YEAR)
    if "urban_neighbours" in wanted:
        near = layers["urban_neighbours"].where(
            (F.col("built_threshold") == float(urban_thresholds["built"]))
            & (F.col("population_threshold") == float(urban_thresholds["population"]))
            & (F.col("cluster_threshold") == float(urban_thresholds["cluster"])))
        joined = joined.join(near.select(*CELL_YEAR, "urban_neighbours"), CELL_YEAR, "left")
    source = {"urban_flag": "u1_flag", "urban_distance_km": "u1_km", "high_density_distance_km": "u2_km"}
    return joined.select(*CELL_YEAR, *[
        F.coalesce(F.col(source.get(f, f)).cast("double"), F.lit(0.0)).alias(f) for f in features])


def training_frame(features: DataFrame, labels: DataFrame, years: list[int], columns: list[str]) -> DataFrame:
    """Features with the label where one is known."""
    return (
        features.where(F.col("year_model").isin(years))
        .join(labels.select(*CELL_YEAR, "label"), CELL_YEAR, "left")
        .select(*CELL_YEAR, *columns, F.col("label"))
    )


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that break a primary key, with how often they occur."""
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def missing_keys(df: DataFrame, parent: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is absent from the parent table."""
    return df.join(parent.select(*key), key, "left_anti")


def pending(configs: DataFrame, run_log: DataFrame, key: list[str]) -> DataFrame:
    """Configurations not in the run log."""
    return configs.join(run_log.select(*key), key, "left_anti")
