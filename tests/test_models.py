"""Folds, metrics, classifiers, neighbours, keys, tags, storage."""

import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cellscape import config
from cellscape.functions.keys import canonical_json, canonical_list, fingerprint
from cellscape.operators import evaluate, features, knn, models, osm
from cellscape.plans import experiment
from cellscape.sources import readers, schemas, writers


def test_fold_sizes(spark):
    got = evaluate.assign_folds(spark.range(12), [], [F.floor(F.col("id") / 5)], ["id"], 5).collect()
    assert [r.fold for r in sorted(got)] == [1, 1, 1, 2, 2, 2, 3, 3, 4, 4, 5, 5]


def test_metrics_without_positive_predictions_are_null_and_left_out(spark):
    rows = [(1, 0.05, 1), (1, 0.05, 0), (2, 0.95, 1), (2, 0.05, 0), (2, 0.5, None)]
    scored = spark.createDataFrame(rows, "fold long, score double, label int")
    m = evaluate.with_metrics(evaluate.confusion_by_cutoff(scored, ["fold"]))
    first = m.where("fold = 1 and cutoff = 0.5").first()
    assert (first.tp, first.tn, first.fp, first.fn, first.precision, first.recall) == (0, 1, 0, 1, None, 0.0)
    mean = evaluate.mean_over_folds(evaluate.long_metrics(m, ["fold"]), [])
    assert mean.count() == 17 * 8
    assert mean.where("metric = 'precision@' and cutoff = 0.5").first().value == 1.0
    assert mean.where("metric = 'auc@' and cutoff = 0.5").first().value == 0.75


def test_unknown_f1_is_never_best(spark):
    rows = [(1, 5, "f1@", 0.1, None), (1, 3, "f1@", 0.2, 0.4), (1, 2, "f1@", 0.3, 0.4), (1, 2, "f1@", 0.2, 0.4), (1, 1, "auc@", 0.1, 0.9)]
    best = evaluate.best_per_group(spark.createDataFrame(rows, "city long, model_id long, metric string, cutoff double, value double"), ["city"])
    assert tuple(best.first()) == (1, 2, 0.2, 0.4)


@pytest.fixture(scope="module")
def separable(spark):
    rng = random.Random(11)
    rows = []
    for i in range(600):
        a, b, c = (rng.gauss(0, 1) for _ in range(3))
        rows.append((i % 4, i, 1990, Vectors.dense(a, b, c), int(a + 0.3 * b > 0)))
    return spark.createDataFrame(rows, ["city", "cell_id", "year_model", "features", "label"]).coalesce(1).cache()


TREES = {"n_estimators": 10, "max_depth": 50, "max_features": "sqrt", "criterion": "gini", "min_samples_split": 2, "random_state": 3}


@pytest.mark.parametrize("name, parameters", [
    ("RandomForest", {**TREES, "max_depth": 6}), ("ExtraTrees", {**TREES, "max_depth": 6}),
    ("LogisticRegression", {"C_reg": 1, "penalty": "l1", "random_state": 1}),
    ("AdaBoost", {"learning_rate": 1.0, "n_estimators": 6, "algorithm": "SAMME.R"}),
    ("AdaBoost", {"learning_rate": 1.0, "n_estimators": 6, "algorithm": "SAMME"}),
    ("GradientBoostingClassifier", {"n_estimators": 5, "learning_rate": 0.3, "subsample": 1.0, "max_depth": 3}),
    ("GaussianNB", {}), ("DecisionTreeClassifier", {"max_features": None, "criterion": "entropy", "max_depth": 4, "min_samples_split": 2}),
    ("SGDClassifier", {"loss": "hinge", "penalty": "l2"}), ("SVM", {"C_reg": 1.0, "kernel": "linear"})])
def test_classifiers_separate(spark, separable, name, parameters):
    model = models.fit(name, parameters, separable)
    rows = model.score(separable).select("score", "label").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    # share of positive/negative pairs in the right order
    ones, zeros = ([r.score for r in rows if r.label == k] for k in (1, 0))
    order = np.mean(np.array(ones)[:, None] > np.array(zeros)[None, :])
    assert order > 0.85
    importances = model.importances(["a", "b", "c"])
    if importances is not None:
        assert max(importances, key=lambda p: abs(p[1]))[0] == "a"


def test_extra_trees_repeat_with_the_same_seed(spark, separable):
    one, two = (models.fit("ExtraTrees", {**TREES, "n_estimators": 3}, df) for df in (separable, separable.repartition(7)))
    rows = [sorted(map(str, m.nodes.collect())) for m in (one, two)]
    assert rows[0] == rows[1] and one.nodes.select("tree").distinct().count() == 3


def test_unsupported_requests(separable):
    with pytest.raises(ValueError):
        models.fit("Perceptron", {}, separable)
    with pytest.raises(ValueError):
        models.fit("SVM", {"C_reg": 1.0, "kernel": "rbf"}, separable)


def test_parameter_grid_size():
    assert len(models.parameter_grid(config.PARAMETER_GRIDS)) == 96


def test_cross_validation_and_sweep(spark, separable):
    runs = experiment.sweep(separable, ["a", "b", "c"], {"LogisticRegression": {"C_reg": [0.01, 1], "penalty": ["l2"]}}, 3, threads=2)
    assert len(runs) == 2 and all(r.metrics.count() == 136 for r in runs)


def test_neighbours_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(knn, "CHUNK", 37)
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(size=(120, 3)), np.ones((60, 3))])  # a third are copies of one point
    rows = [(i, [float(v) for v in p], int(p[0] > 0)) for i, p in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, x array<double>, label int")
    found = {r.query_id: [n.id for n in r.neighbours] for r in knn.nearest_neighbours(df, df, 4, leave_out_self=True).collect()}
    assert len(found) == 180
    for i in range(180):
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        assert found[i] == list(np.lexsort((np.arange(180), d))[:4])
    share = knn.nearest_neighbours(df, df, 4).select(knn.class_share(F.col("neighbours"), "distance").alias("s")).collect()
    assert all(0 <= r.s <= 1 for r in share)


def test_fingerprints_match_sorted_json(spark):
    p = {"n_estimators": 100, "criterion": "gini", "C_reg": 0.001}
    entries = [F.lit(v) for k, value in p.items() for v in (k, json.dumps(value))]
    got = spark.range(1).select(
        fingerprint(canonical_json(F.create_map(*entries))).alias("a"),
        fingerprint(canonical_list(F.array(F.lit("b"), F.lit("a")))).alias("b")).first()
    assert got.a == hashlib.md5(json.dumps(p, sort_keys=True).encode()).hexdigest()
    assert got.b == hashlib.md5(json.dumps(sorted(["b", "a"])).encode()).hexdigest()


def test_repeated_nodes_and_long_way(spark):
    assert spark.range(1).select(osm.without_repeats(F.array(*[F.lit(v) for v in (1, 1, 2, 2, 1)])).alias("v")).first().v == [1, 2, 1]
    way = spark.createDataFrame([(9, i, (1, 1, 2, 2, 1)[i]) for i in range(5)], "osmid long, pos long, node long")
    nodes = spark.createDataFrame([(1, 0.0, 0.0), (2, 3.0, 4.0)], "node long, x double, y double")
    assert sorted(tuple(r) for r in osm.drop_repeated_nodes(way).select("pos", "node").collect()) == [(0, 1), (2, 2), (4, 1)]
    lines = osm.way_segments(way, nodes, hot_rows=1).select("x1", "y1", "x2", "y2").collect()
    assert sorted(map(tuple, lines)) == [(0.0, 0.0, 3.0, 4.0), (3.0, 4.0, 0.0, 0.0)]


def test_road_filter(spark):
    rows = [(1, None, None), (2, "primary", None), (3, "proposed", None), (4, "primary", "yes"), (5, None, "no")]
    df = spark.createDataFrame(rows, "id int, highway string, area string")
    keep = df.where(osm.is_road(F.col("highway"), F.col("area"))).collect()
    assert {r.id for r in keep} == {1, 2, 5}
    assert {r.id for r in df.where(osm.is_road(F.col("highway"), F.col("area"), True)).collect()} == {2}


def test_coordinates_and_tags(spark):
    texts = ["12.5", "-3", "+.5", "1.2.3", "", "abc", "7."]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.v for r in df.select(osm.to_coordinate(F.col("t")).alias("v")).collect()] == [12.5, -3.0, 0.5, None, None, None, None]
    tags = F.create_map(*[F.lit(v) for v in ("Name:EN", "a", "жж", "b", "name_en", "c", "building:levels", "d")])
    got = spark.range(1).select(osm.normalize_tag_keys(tags).alias("v")).first().v
    assert got == {"name_en": "a", "undef_1": "b", "buildlevel": "d"}


def test_readers_and_writers(spark, tmp_path):
    layer = spark.createDataFrame([(1, 2, 0.5)], "city long, cell_id long, distance_highways_km double")
    path = str(tmp_path / "highways")
    writers.append_layer(layer, path, "highways")
    writers.append_layer(layer.withColumn("cell_id", F.lit(3).cast("long")), path, "highways")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError, match="missing"):
        schemas.conform(layer.drop("city"), "highways")
    part = str(tmp_path / "parts")
    for v in (1, 2):
        writers.replace_partitions(spark.createDataFrame([(1990, v), (2000 + v, v)], "year_model int, v int"), part, ["year_model"])
    assert sorted(tuple(r) for r in spark.read.parquet(part).select("year_model", "v").collect()) == [(1990, 2), (2001, 1), (2002, 2)]
    (tmp_path / "p.csv").write_bytes("fid,amenity,aeroway,x,y\n1,caf\xe9,,1.5,2.5\n".encode("latin-1"))
    assert readers.points_csv(spark, str(tmp_path / "p.csv")).first().amenity == "caf\xe9"
    (tmp_path / "l.csv").write_text("year,link\n1997,a\n1997,b\n1998,c\n")
    links = readers.first_link_per_year(readers.links_csv(spark, str(tmp_path / "l.csv"))).collect()
    assert {(r.year, r.link) for r in links} == {(1997, "a"), (1998, "c")}
    doc = {"elements": [
        {"type": "node", "id": 1, "lat": 1.0, "lon": 2.0, "timestamp": "2016-01-02T03:04:05Z", "tags": {"shop": "x"}},
        {"type": "way", "id": 2, "nodes": [1, 1, 3], "timestamp": "2016-01-02T03:04:05Z"}]}
    (tmp_path / "o.json").write_text(json.dumps(doc, indent=1))
    nodes, ways = osm.split_elements(readers.osm_documents(spark, str(tmp_path / "o.json")))
    assert osm.points_of_interest(nodes).count() == 1 and ways.first().nodes == [1, 3]


def test_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [tuple(r) for r in features.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    assert features.missing_keys(df, spark.createDataFrame([(1,)], "k int"), ["k"]).count() == 1
    assert config.selected_features({"a": True, "b": False, "c": True}) == ["a", "c"]
    assert config.split_layers(["dem", "urban_distance"]) == (["dem"], ["urban_distance"])
