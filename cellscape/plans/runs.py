"""Experiment runs for each city: folds, scores of the last period, and stored tables linked by one id.

A setting is a model and its parameters.  All cities and folds of a setting are fitted at once.  Its results are
stored first, its row in ``settings`` last, so that an interrupted setting leaves nothing that is read and is
done again by the next sweep, while finished ones are not.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscape.operators import evaluate
from cellscape.operators.models import parameter_grid
from cellscape.operators.units import fit_units
from cellscape.session import materialize

SCHEMAS = {
    "settings": "setting_id string, run string, model_type string, model_parameters string, folds int",
    "models": "model_id string, city long, run string, model_type string, model_parameters string, n_rows long",
    "evaluations": "model_id string, city long, metric string, cutoff double, value double",
    "importances": "model_id string, city long, feature string, feature_importance double",
}


def model_id(setting: Column | str, city: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(setting) if isinstance(setting, str) else setting, city.cast("string")))


@dataclass
class RunStore:
    """Tables of runs in a folder that all executors reach."""

    spark: SparkSession
    folder: str

    def _path(self, table: str, setting: str = "") -> str:
        return f"{self.folder}/{table}/setting={setting}" if setting else f"{self.folder}/{table}"

    def write(self, table: str, setting: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(self._path(table, setting))

    def has(self, table: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(table))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def read(self, table: str) -> DataFrame:
        """Rows of finished settings only."""
        if not self.has(table):
            return self.spark.createDataFrame([], SCHEMAS.get(table, "setting string"))
        rows = self.spark.read.parquet(self._path(table))
        if table == "settings":
            return rows.drop("setting")
        done = self.read("settings").select(F.col("setting_id").alias("setting"))
        return rows.withColumn("setting", F.col("setting").cast("string")).join(done, "setting", "left_semi").drop("setting")

    def pending(self, settings: list[tuple[str, dict]], run: str) -> list[tuple[str, str, dict]]:
        """``(setting_id, name, parameters)`` of those that are not stored; the list of settings is bounded by the configuration."""
        if not settings:
            return []
        rows = self.spark.createDataFrame([(k, n, json.dumps(p, sort_keys=True)) for k, (n, p) in enumerate(settings)], "k int, name string, parameters string")
        ids = rows.withColumn("setting_id", F.md5(F.concat_ws("|", F.lit(run), "name", "parameters")))
        left = ids.join(self.read("settings").select("setting_id"), "setting_id", "left_anti").orderBy("k").collect()
        return [(r["setting_id"], r["name"], json.loads(r["parameters"])) for r in left]


@dataclass
class CityRun:
    evaluations: DataFrame  # (city, metric, cutoff, value), means over folds
    predictions: DataFrame  # rows of the last period with ``score``
    importances: DataFrame | None  # (city, feature, importance)
    sizes: DataFrame  # (city, n_rows)


def run_cities(name: str, parameters: dict, frame: DataFrame, last: DataFrame, coarse: list[Column], order: list[str], folds: int) -> CityRun:
    """Cross-validate and fit one model for each city, and score the last period with the model on all rows.

    ``frame`` has ``city, features, label`` and the columns of ``order``; rows without label are left out.  Folds
    are contiguous blocks of a city's rows in ``order``; ``coarse`` as in ``rank_within``.  A city with fewer rows
    than folds has empty folds, which count in no mean.
    """
    known = frame.where("label is not null").select("city", *[c for c in order if c not in ("city", "label")], "features", "label")
    folded = materialize(evaluate.assign_folds(known, ["city"], coarse, order, folds), "city-folds").select("city", "fold", "features", "label")
    # unit 0 is the model on all rows, unit k the one that has not seen fold k
    units = F.filter(F.sequence(F.lit(0), F.lit(folds)), lambda k: k != F.col("fold"))
    model = fit_units(name, parameters, folded.select("city", F.explode(units).alias("unit"), "features", "label"), ["city", "unit"])
    both = folded.select("city", F.col("fold").alias("unit"), "features", F.col("label").cast("int").alias("label"))
    scored = model.score(both).select("city", "unit", "score", "label")
    per_fold = evaluate.with_metrics(evaluate.confusion_by_cutoff(scored, ["city", "unit"]))
    means = evaluate.mean_over_folds(evaluate.long_metrics(per_fold, ["city", "unit"]), ["city"])
    predictions = model.score(last.withColumn("unit", F.lit(0))).drop("unit", "features")
    found = model.importance_rows()
    return CityRun(means, predictions, None if found is None else found.where("unit = 0").drop("unit"),
                   folded.groupBy("city").agg(F.count("*").alias("n_rows")))


def store_run(store: RunStore, setting: str, run: str, name: str, parameters: dict, made: CityRun, features: list[str], folds: int) -> None:
    """Store the tables of a setting, and the setting itself when all of them are there."""
    text = json.dumps(parameters, sort_keys=True)
    own = model_id(setting, F.col("city"))
    store.write("models", setting, made.sizes.select(
        own.alias("model_id"), F.col("city").cast("long").alias("city"), F.lit(run).alias("run"), F.lit(name).alias("model_type"),
        F.lit(text).alias("model_parameters"), "n_rows"))
    store.write("evaluations", setting, made.evaluations.select(own.alias("model_id"), F.col("city").cast("long").alias("city"), "metric", "cutoff", "value"))
    store.write("predictions", setting, made.predictions.withColumn("model_id", own))
    if made.importances is not None:
        names = F.array(*[F.lit(f) for f in features])
        store.write("importances", setting, made.importances.select(
            own.alias("model_id"), F.col("city").cast("long").alias("city"), F.get(names, F.col("feature")).alias("feature"),
            F.col("importance").alias("feature_importance")))
    done = [(setting, run, name, text, folds)]
    store.write("settings", setting, store.spark.createDataFrame(done, SCHEMAS["settings"]))


def sweep_cities(store: RunStore, run: str, frame: DataFrame, last: DataFrame, grids: dict[str, dict[str, list]], features: list[str],
                 coarse: list[Column], order: list[str], folds: int) -> int:
    """Run every setting of ``grids`` that ``run`` has not stored yet; returns how many."""
    todo = store.pending(parameter_grid(grids), run)
    for setting, name, parameters in todo:
        store_run(store, setting, run, name, parameters, run_cities(name, parameters, frame, last, coarse, order, folds), features, folds)
    return len(todo)
