"""The experiment: settings as tables, runs, cross-validation, hold-out, sweep, export."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscape import config
from cellscape.functions.keys import canonical_json, fingerprint
from cellscape.operators import evaluate, models
from cellscape.session import materialize, shared_folder


# ----- settings as tables ---------------------------------------------------------------------

def with_city_settings(cities: DataFrame) -> DataFrame:
    """Add the settings of city number ``i``.  The settings are a literal of fixed size."""
    rows = F.array(*[
        F.struct(F.lit(name).alias("settings"), F.lit(c["longitude"]).alias("lon"), F.lit(c["latitude"]).alias("lat"),
                 F.lit(c["srid"]).alias("srid"), F.lit(float(c["buffer_dist"])).alias("buffer_m"))
        for name, c in config.CITIES.items()])
    return cities.withColumn("s", F.get(rows, F.col("i").cast("int"))).select("city", "s.*")


def with_model_year(rows: DataFrame) -> DataFrame:
    """Add ``layer`` and ``year_model`` for every layer that has data of ``year_data``."""
    known = F.array(*[
        F.struct(F.lit(layer).alias("layer"), F.lit(data).alias("year"), F.lit(model).alias("year_model"))
        for layer, years in config.YEAR_MAP.items() for data, model in years.items()])
    return rows.withColumn("m", F.explode(F.filter(known, lambda k: k["year"] == F.col("year_data")))).select(
        *rows.columns, "m.layer", "m.year_model")


def switched_on(switches: DataFrame) -> DataFrame:
    return switches.where("switched_on")


def json_map(parameters: dict) -> str:
    return json.dumps(parameters, sort_keys=True)


def parameter_runs(cities: DataFrame) -> DataFrame:
    """Every model and parameter combination of the experiment for every city.

    Parameters are a map from name to JSON-encoded value.  The lists are exploded one after another.
    """
    runs = []
    for name, lists in config.PARAMETER_GRIDS.items():
        keys = sorted(lists)
        df = cities
        for k in keys:
            df = df.withColumn(k, F.explode(F.array(*[F.lit(json.dumps(v)) for v in lists[k]])))
        entries = [part for k in keys for part in (F.lit(k), F.col(k))]
        runs.append(df.select("city", F.lit(name).alias("model_type"), F.create_map(*entries).alias("model_parameters")))
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    return out


def run_keys(runs: DataFrame) -> DataFrame:
    return runs.withColumn("parameters_id", fingerprint(canonical_json(F.col("model_parameters"))))


def model_id(city: Column, model_type: Column, parameters: Column) -> Column:
    """Fingerprint of a run; stands in for a number given out by a database."""
    return F.md5(F.concat_ws("|", city.cast("string"), model_type, parameters))


def registry_rows(runs: DataFrame, features: list[str]) -> DataFrame:
    """One row per model run, as stored."""
    parameters = canonical_json(F.col("model_parameters"))
    return runs.select(
        model_id(F.col("city"), F.col("model_type"), parameters).alias("model_id"), "city",
        F.current_timestamp().alias("run_time"), "model_type", parameters.alias("model_parameters"),
        F.array(*[F.lit(f) for f in features]).alias("features"),
        F.array(*[F.lit(y) for y in config.YEARS_TRAIN]).alias("years_train"),
        F.lit(config.GRID_SIZE).alias("grid_size"), F.lit(float(config.URBAN["built"])).alias("built_threshold"),
        F.lit(float(config.URBAN["population"])).alias("population_threshold"),
        F.lit(float(config.URBAN["cluster"])).alias("cluster_threshold"),
        F.array(*[F.lit(v) for v in config.LABEL_RANGE]).alias("label_range"), F.lit("").alias("model_comment"))


# ----- stored inputs --------------------------------------------------------------------------

_paths: dict[tuple[str, str], str] = {}


def _stored(spark: SparkSession, key: str, write) -> str:
    slot = (spark.sparkContext.applicationId, key)
    if slot not in _paths:
        path = f"{shared_folder(spark)}/{key.strip('/').replace('/', '_')}-{spark.sparkContext.applicationId}"
        write(path)
        _paths[slot] = path
    return _paths[slot]


def stored_path(spark: SparkSession, key: str, build, partition_by: list[str]) -> str:
    """Write a layer table once per application and return its folder."""
    return _stored(spark, key, lambda p: build().repartition(*partition_by, "city").write.partitionBy(*partition_by).parquet(p))


def stored_json(spark: SparkSession, key: str, build) -> str:
    return _stored(spark, key, lambda p: build().write.json(p))


# ----- runs -----------------------------------------------------------------------------------

FITS_AT_ONCE = 2  # fits of a cross-validation that share the cluster; each keeps its rows in memory


@dataclass
class Run:
    model: object
    metrics: DataFrame
    importances: list[tuple[str, float]] | None


def cross_validate(name: str, parameters: dict, frame: DataFrame, columns: list[str], folds: int) -> Run:
    """Fit on all labelled rows, evaluate on contiguous folds, average the metrics.

    ``frame`` has the cell key, ``features`` and ``label``.  Rows are ordered by period and cell.
    """
    known = frame.where(F.col("label").isNotNull()).select("city", "cell_id", "year_model", "features", "label")
    coarse = [F.col("year_model"), F.col("city"), F.floor(F.shiftright("cell_id", 20) / 64)]
    folded = materialize(
        evaluate.assign_folds(known, [], coarse, ["year_model", "city", "cell_id"], folds), "folds")
    parts = [folded, *[folded.where(F.col("fold") != k) for k in range(1, folds + 1)]]
    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        full, *fitted = pool.map(lambda rows: models.fit(name, parameters, rows), parts)
    scored = None
    for k, part in enumerate(fitted, 1):
        held = part.score(folded.where(F.col("fold") == k)).select("fold", "score", "label")
        scored = held if scored is None else scored.unionByName(held)
    per_fold = evaluate.with_metrics(evaluate.confusion_by_cutoff(scored, ["fold"]))
    metrics = evaluate.mean_over_folds(evaluate.long_metrics(per_fold, ["fold"]), [])
    return Run(full, metrics, full.importances(columns))


def hold_out(name: str, parameters: dict, train: DataFrame, test: DataFrame) -> DataFrame:
    """Fit on earlier periods, evaluate on a later one."""
    scored = models.fit(name, parameters, train).score(test).select("year_model", "score", "label")
    counted = evaluate.confusion_by_cutoff(scored, ["year_model"])
    return evaluate.long_metrics(evaluate.with_metrics(counted), ["year_model"])


def sweep(frame: DataFrame, columns: list[str], grids: dict[str, dict[str, list]], folds: int, threads: int = 4) -> list[Run]:
    """Cross-validate every combination; fits of different combinations share the cluster."""
    runs = models.parameter_grid(grids)
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(lambda r: cross_validate(r[0], r[1], frame, columns, folds), runs))
