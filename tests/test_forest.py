"""Tree models: the distributed and the local way, against a plain recursive tree."""

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cellscape.operators import forest, models
from cellscape.operators.forest import Rules, grow
from cellscape.operators.skew import running_sums

COLUMNS = ["city", "tree", "node", "depth", "feature", "cut", "left", "right", "n", "ones"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(900):
        x = [float(rng.integers(0, 12)), float(np.round(rng.normal(), 2)), float(rng.normal()), 1.0]
        rows.append((i % 2, Vectors.dense(x), int(x[0] / 6 + x[1] + rng.normal() > 1)))
    rows += rows[:40] * 6  # equal rows
    return spark.createDataFrame(rows, ["city", "features", "label"]).repartition(5).cache()


def nodes_of(model, by):
    names = [*by, *COLUMNS[1:]]
    return sorted((tuple(r[c] for c in names) for r in model.nodes.collect()), key=str)


def plain_nodes(rows, criterion, max_depth, min_split):
    """(depth, feature, cut, n, ones) of a tree on all features, by trying every cut."""
    def imp(n, k):
        p = k / n
        return 2 * p * (1 - p) if criterion == "gini" else -sum(q * math.log2(q) for q in (p, 1 - p) if q > 0)

    out, todo = [], [(rows, 0)]
    while todo:
        own, d = todo.pop()
        n, k = len(own), sum(y for _, y in own)
        best = None
        if 0 < k < n and n >= min_split and d < max_depth:
            for f in range(len(own[0][0])):
                for cut in sorted({x[f] for x, _ in own})[:-1]:
                    left = [y for x, y in own if x[f] <= cut]
                    a, a1 = len(left), sum(left)
                    found = ((a * imp(a, a1) + (n - a) * imp(n - a, k - a1)) / n, f, cut)
                    best = found if best is None or found < best else best
        if best is None:
            out.append((d, -1, None, n, k))
            continue
        _, f, cut = best
        out.append((d, f, cut, n, k))
        todo += [([r for r in own if r[0][f] <= cut], d + 1), ([r for r in own if r[0][f] > cut], d + 1)]
    return out


@pytest.mark.parametrize("criterion, min_split", [("gini", 2), ("entropy", 30)])
def test_decision_tree_against_every_cut(spark, table, criterion, min_split):
    rows = [(tuple(r.features), r.label) for r in table.where("city = 0").collect()][:150]
    some = spark.createDataFrame([(Vectors.dense(x), y) for x, y in rows], ["features", "label"])
    want = plain_nodes(rows, criterion, 6, min_split)
    got = grow(some, Rules(criterion=criterion, max_depth=6, min_split=min_split)).nodes.collect()
    count = lambda r: sorted((r[0], r[1], r[3], r[4]) for r in r)
    assert count([(r.depth, r.feature, r.cut, r.n, r.ones) for r in got])[:7] == count(want)[:7]
    assert sum(r.n for r in got if r.feature < 0) == len(rows)
    assert all(r.n >= min_split for r in got if r.feature >= 0)


@pytest.mark.parametrize("rules", [
    Rules(max_depth=9), Rules(n_trees=3, max_features="sqrt", seed=5, bootstrap=True, criterion="entropy", min_split=10),
    Rules(n_trees=3, max_features=1, seed=7, random_cuts=True, min_split=5), Rules(max_depth=2, min_split=400)])
def test_large_nodes_are_split_like_small_ones(table, rules):
    """Level by level on DataFrames, by units, on other partitions: the same trees and the same scores."""
    local = grow(table, rules, ["city"])
    spread = grow(table.repartition(2), replace(rules, group_rows=250), ["city"])
    assert spread.layered and not local.layered
    assert nodes_of(local, ["city"]) == nodes_of(spread, ["city"])
    ids = table.withColumn("k", F.monotonically_increasing_id())
    scores = [{r.k: r.score for r in m.score(ids).select("k", "score").collect()} for m in (local, spread)]
    assert len(scores[0]) == table.count() and scores[0].keys() == scores[1].keys()
    assert all(abs(scores[0][k] - scores[1][k]) < 1e-12 for k in scores[0])
    one = {r.city: r.importance for r in local.importance_rows().groupBy("city").agg(F.sum("importance").alias("importance")).collect()}
    assert all(abs(v - 1) < 1e-9 for v in one.values())


def test_few_values_of_large_nodes_are_sorted(spark, monkeypatch):
    """Only bins that may hold the best cut are opened; the tree is that of every cut."""
    sorted_rows = []

    def counted(df, by, order, columns, name):
        sorted_rows.append(df.count())
        return running_sums(df, by, order, columns, name)

    monkeypatch.setattr(forest, "running_sums", counted)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(4000, 3))
    y = (x[:, 1] + 0.3 * rng.normal(size=4000) > 0.4).astype(int)
    rows = spark.createDataFrame([(Vectors.dense(v), int(k)) for v, k in zip(x.tolist(), y)], ["features", "label"]).repartition(3)
    for dense in (0, forest.DENSE):
        monkeypatch.setattr(forest, "DENSE", dense)
        large = grow(rows, Rules(max_depth=2, group_rows=50))
        assert nodes_of(large, []) == nodes_of(grow(rows, Rules(max_depth=2)), [])
    assert max(sorted_rows) < 0.1 * 3 * 4000


def test_units_do_not_mix(table):
    """A unit's trees are those of its own rows alone."""
    rules = Rules(n_trees=2, max_features="sqrt", bootstrap=True, seed=1)
    both = nodes_of(grow(table, rules, ["city"]), ["city"])
    for city in (0, 1):
        assert [t[1:] for t in both if t[0] == city] == nodes_of(grow(table.where(F.col("city") == city), rules), [])


def test_depth_beyond_thirty(spark):
    """Alternating labels are peeled off one value at a time: a chain that needs nearly a level for each row."""
    chain = spark.createDataFrame([(Vectors.dense(float(k)), int(k % 2)) for k in range(48)], ["features", "label"])
    setting = {"max_features": None, "criterion": "gini", "min_samples_split": 2}
    model = models.fit("DecisionTreeClassifier", {**setting, "max_depth": 50}, chain)
    assert model.nodes.agg(F.max("depth")).first()[0] > 30
    assert model.score(chain).where("score <> label").count() == 0
    cut = models.fit("DecisionTreeClassifier", {**setting, "max_depth": 30}, chain)
    assert cut.nodes.agg(F.max("depth")).first()[0] == 30 and cut.score(chain).where("score <> label").count() > 0


def test_more_features_are_tried_if_the_drawn_ones_do_not_vary(spark):
    rows = spark.createDataFrame([(Vectors.dense(1.0, 1.0, 1.0, float(k)), int(k > 30)) for k in range(100)], ["features", "label"])
    for group in (200_000, 10):
        model = grow(rows, Rules(max_features=1, group_rows=group))
        assert model.nodes.where("depth = 0").first().feature == 3


def test_weights_and_small_cases(spark):
    u = np.linspace(0.001, 0.999, 999)
    for mean in (1.0, 3.0, 40.0, 900.0):
        w = forest.poisson(u, np.full(999, mean))
        assert abs(w.mean() - mean) < 0.02 * mean + 0.05 and (np.diff(w) >= 0).all()
    one = spark.createDataFrame([(Vectors.dense(1.0), 1)] * 3, ["features", "label"])
    assert [tuple(r)[-3:] for r in grow(one, Rules()).nodes.select("n", "ones", "feature").collect()] == [(3, 3, -1)]
    assert grow(one.where("false"), Rules()).nodes.count() == 0
    with pytest.raises(ValueError):
        forest.impurity(np.array([1]), np.array([2]), "mae")


def test_running_sums(spark):
    rng = np.random.default_rng(3)
    rows = [(str(k), i, float(v), int(w)) for i, (k, v, w) in enumerate(zip(rng.choice(["a", "a", "a", "b", "c"], 2000), rng.permutation(2000), rng.integers(0, 9, 2000)))]
    frame = spark.createDataFrame(rows, "k string, i int, v double, w long").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.i: r.w for r in running_sums(frame, ["k"], "v", ["w"], "test").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    total, want = {}, {}
    for k, i, v, w in sorted(rows, key=lambda r: r[2]):
        want[i] = total[k] = total.get(k, 0) + w
    assert got == want
