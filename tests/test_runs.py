"""Runs for each city against one model a city, and the stored tables."""

import random
import uuid

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cellscape.operators import evaluate, models
from cellscape.operators.units import fit_units
from cellscape.plans import runs
from cellscape.session import shared_folder

def coarse():
    return [F.floor(F.col("cell_id") / 100)]


@pytest.fixture(scope="module")
def cities(spark):
    rng = random.Random(5)
    rows = []
    for i in range(420):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        city = 1 if i < 300 else 2
        rows.append((city, i, Vectors.dense(a, b), int(a * (1 if city == 1 else -1) + 0.4 * b > 0) if i % 10 else None))
    rows.append((3, 1, Vectors.dense(0.0, 1.0), 1))
    return spark.createDataFrame(rows, ["city", "cell_id", "features", "label"]).repartition(3).cache()


SETTINGS = {"GaussianNB": {}, "RandomForest": {"n_estimators": 4, "max_depth": 50, "max_features": "sqrt", "criterion": "gini", "min_samples_split": 2, "random_state": 3}}


@pytest.mark.parametrize("name", list(SETTINGS))
def test_units_equal_one_model_for_each(cities, name):
    together = fit_units(name, SETTINGS[name], cities, ["city"]).score(cities)
    got = {(r.city, r.cell_id): r.score for r in together.collect()}
    for city in (1, 2, 3):
        own = cities.where(F.col("city") == city)
        alone = {(r.city, r.cell_id): r.score for r in models.fit(name, SETTINGS[name], own).score(own).collect()}
        assert len(alone) == own.count() and all(abs(got[k] - v) < 1e-9 for k, v in alone.items())


def test_run_against_single_fits(cities):
    """Means over folds equal those of one fit for each city and fold."""
    made = runs.run_cities("GaussianNB", {}, cities, cities.where("label is null"), coarse(), ["cell_id"], 3)
    got = {(r.city, r.metric, r.cutoff): r.value for r in made.evaluations.collect()}
    known = cities.where("label is not null and city < 3")
    folded = evaluate.assign_folds(known, ["city"], coarse(), ["cell_id"], 3).cache()
    scored = None
    for city in (1, 2):
        for k in (1, 2, 3):
            own = folded.where(F.col("city") == city)
            part = models.fit("GaussianNB", {}, own.where(F.col("fold") != k)).score(own.where(F.col("fold") == k)).select("city", "fold", "score", "label")
            scored = part if scored is None else scored.unionByName(part)
    counted = evaluate.with_metrics(evaluate.confusion_by_cutoff(scored, ["city", "fold"]))
    want = evaluate.mean_over_folds(evaluate.long_metrics(counted, ["city", "fold"]), ["city"]).collect()
    for r in want:
        own = got[(r.city, r.metric, r.cutoff)]
        assert own == r.value or abs(own - r.value) < 1e-9
    assert made.predictions.count() == cities.where("label is null").count()


def test_sweep_is_stored_linked_and_restartable(spark, cities):
    store = runs.RunStore(spark, f"{shared_folder(spark)}/runs-{uuid.uuid4().hex}")
    assert store.read("models").count() == 0
    grids = {"GaussianNB": {}, "DecisionTreeClassifier": {"max_depth": [2], "max_features": [None], "criterion": ["gini"], "min_samples_split": [2, 20]}}
    args = (cities, cities.where("label is null"), grids, ["a", "b"], coarse(), ["cell_id"], 2)
    # a setting without its mark was interrupted: its rows are not read, and it is done again
    lost = store.pending(models.parameter_grid(grids), "first")[0][0]
    store.write("models", lost, spark.createDataFrame([("x", 9, "first", "GaussianNB", "{}", 1)], runs.SCHEMAS["models"]))
    assert store.read("models").count() == 0
    assert runs.sweep_cities(store, "first", *args) == 3
    assert runs.sweep_cities(store, "first", *args) == 0
    assert store.read("models").count() == 9 and store.read("settings").count() == 3
    assert runs.sweep_cities(store, "second", *args) == 3
    ids = store.read("models")
    assert ids.select("model_id").distinct().count() == ids.count() == 18
    for table in ("evaluations", "predictions", "importances"):
        rows = store.read(table)
        assert rows.count() > 0 and rows.join(ids, ["model_id", "city"], "left_anti").count() == 0


def test_models_without_a_fit_by_unit(cities):
    with pytest.raises(ValueError):
        fit_units("AdaBoost", {}, cities, ["city"])
