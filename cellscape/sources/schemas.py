"""Declared schemas of the layer and result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

from cellscape.config import LAYER_COLUMNS


_TYPES = {
    "long": LongType(), "int": IntegerType(), "double": DoubleType(), "string": StringType(), "boolean": BooleanType(),
    "timestamp": TimestampType(), "array<string>": ArrayType(StringType()), "array<int>": ArrayType(IntegerType()),
}


def _schema(text: str) -> StructType:
    schema = StructType()
    for column in text.split(", "):
        name, kind = column.split(" ")
        schema = schema.add(name, _TYPES[kind])
    return schema


def _layer(columns: list[str], *extra: str) -> str:
    typed = [f"{c} {'int' if c.endswith('_flag') else 'long' if c == 'urban_neighbours' else 'double'}" for c in columns]
    return ", ".join(["city long", "cell_id long", *extra, *typed])


_YEARLY = ("year int", "year_model int")
_URBAN = ("year_model int", "built_threshold double", "population_threshold double", "cluster_threshold double")

SCHEMAS: dict[str, StructType] = {
    name: _schema(_layer(columns, *(_YEARLY if name in ("built_lds", "city_lights", "settlements", "population")
                                               else _URBAN if name == "urban_neighbours" else ())))
    for name, columns in LAYER_COLUMNS.items()
}
SCHEMAS["urban_distance"] = _schema(_layer(["urban_flag", "urban_distance_km"], *_URBAN))
SCHEMAS["urban_clusters"] = _schema(
    "city long, cluster_id long, year_model int, population double, built_threshold double, population_threshold double")
SCHEMAS["models"] = _schema(
    "model_id string, city long, run_time timestamp, model_type string, model_parameters string, features array<string>, "
    "years_train array<int>, grid_size int, built_threshold double, population_threshold double, "
    "cluster_threshold double, label_range array<int>, model_comment string")
SCHEMAS["predictions"] = _schema(
    "model_id long, city long, year_features int, cell_id long, score double, label boolean")
SCHEMAS["feature_importances"] = _schema(
    "model_id long, city long, feature string, feature_importance double, rank_abs int")
SCHEMAS["evaluations"] = _schema(
    "model_id long, city long, years array<int>, type_validation string, metric string, cutoff string, value double")


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns in declared order and type; a missing or extra column is an error."""
    schema = SCHEMAS[table]
    missing, extra = set(schema.names) - set(df.columns), set(df.columns) - set(schema.names)
    if missing or extra:
        raise ValueError(f"{table}: missing {sorted(missing)}, not declared {sorted(extra)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
