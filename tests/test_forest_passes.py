"""Upper nodes are found in passes over the rows: no table of rows times trees is stored, few nodes are sent to the rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cellscape import session
from cellscape.operators import forest
from cellscape.operators.forest import Rules, grow


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1500, 3))
    x[:, 0] = np.round(x[:, 0], 1)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=1500) > 0.5).astype(int)
    rows = [(i % 3 and 1, Vectors.dense(v), int(k)) for i, (v, k) in enumerate(zip(x.tolist(), y))]
    return spark.createDataFrame(rows, ["city", "features", "label"]).repartition(3).cache()


@pytest.mark.parametrize("rules", [
    Rules(n_trees=8, max_depth=3, max_features="sqrt", bootstrap=True, seed=3, group_rows=200),
    Rules(n_trees=8, max_depth=3, max_features="sqrt", random_cuts=True, seed=3, group_rows=200)])
def test_rows_are_not_stored_for_each_tree(spark, table, rules, monkeypatch):
    stored, sent = [], []
    write, send = session._store, forest._send

    def counted(df, name):
        out = write(df, name)
        stored.append((name, out[0].count()))
        return out

    monkeypatch.setattr(session, "_store", counted)
    monkeypatch.setattr(forest, "_send", lambda *a: sent.append(1) or send(*a))
    model = grow(table, rules)
    assert model.layered and not sent  # no node is left to be finished by a task of its own
    assert dict(stored)["forest-rows"] == 1500
    assert max(n for name, n in stored if name != "forest-bins") <= 1500  # bins: nodes x features x bins at most
    plan = model.score(table)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "ArrowEvalPython" in plan and plan.count("mean(") <= 2


@pytest.mark.parametrize("group_rows, by", [(500, []), (700, ["city"]), (200_000, ["city"])])
def test_scores_of_many_nodes_are_those_of_few(table, monkeypatch, group_rows, by):
    """Trees in chunks of pieces give the scores that all nodes at once give; some units have upper nodes, some have none."""
    rules = Rules(n_trees=3, max_features="sqrt", seed=2, bootstrap=True, min_split=8, group_rows=group_rows)
    ids = table.withColumn("k", F.monotonically_increasing_id()).select(*by, "k", "features")
    if by:  # a unit without rows in training, and one that is not known
        ids = ids.unionByName(ids.limit(2).withColumn("city", F.lit(7))).unionByName(ids.limit(2).withColumn("city", F.lit(None).cast("long")))
    model = grow(table, rules, by)
    few = {r.k: r.score for r in model.score(ids).collect()}
    monkeypatch.setattr(forest, "SENT_NODES", 10)
    monkeypatch.setattr(forest, "CHUNK_ROWS", 400)
    other = grow(table, rules, by)
    assert other._few is None
    scored = other.score(ids)
    many = {r.k: r.score for r in scored.collect()}
    assert scored.columns == [*ids.columns, "score"] and scored.count() == 1500
    assert len(few) == 1500 and few.keys() == many.keys() and max(abs(few[k] - many[k]) for k in few) < 1e-12


def test_weights_of_single_rows_are_those_of_the_general_way():
    u = np.concatenate([np.random.default_rng(1).random(20_000), [0.0, 1 - 2.0**-53]])
    assert (forest.poisson(u, np.ones(len(u))) == forest._poisson(u, np.ones(len(u)))).all()


def test_rows_travel_packed_to_small_nodes(monkeypatch):
    """What a task has of a node is one value, cut at a bound of bytes; it holds the drawn rows."""
    rng = np.random.default_rng(5)
    n, rules, by = 900, Rules(n_trees=4, bootstrap=True, seed=9), ["city"]
    x, y, row = rng.normal(size=(n, 3)), rng.integers(0, 2, n), rng.integers(0, 10**15, n)
    city = [None if i % 3 == 2 else i % 3 for i in range(n)]
    table = pa.table({"city": pa.array(city, pa.int32()), "x": pa.array(x.tolist()), "label": pa.array(y.astype(np.int32)),
                      "m": pa.array(np.ones(n, np.int64)), "row": pa.array(row)})
    top = forest._Top({}, np.zeros((0, 4), dtype=np.int64))
    weights = [forest._weights(rules, t, row, np.ones(n, np.int64)) for t in range(4)]
    for most in (1 << 20, 40 * 50):
        monkeypatch.setattr(forest, "PACKED_BYTES", most)
        sent = pa.Table.from_batches(forest._send(rules, by, top)(iter(table.to_batches(max_chunksize=200))))
        assert sent.num_rows == 12 if most > 10**5 else 12 < sent.num_rows < 100
        got = {}
        for r in sent.to_pylist():
            labels = np.frombuffer(r["label"], np.int64)
            values = np.frombuffer(r["x"]).reshape(3, len(labels)).T
            got.setdefault((r["city"], r["tree"]), []).extend(zip(map(tuple, values.tolist()), labels.tolist(), np.frombuffer(r["w"], np.int64).tolist()))
        for c in (0, 1, None):
            for t in range(4):
                want = [(tuple(x[i].tolist()), int(y[i]), int(weights[t][i])) for i in range(n) if city[i] == c and weights[t][i]]
                assert sorted(got[c, t]) == sorted(want)
