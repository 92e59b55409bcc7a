"""Drawn cuts need no sort."""

from __future__ import annotations

import random

from cellscape.operators import forest, models


def test_drawn_cuts_sort_nothing(spark, monkeypatch):
    draw = random.Random(7)
    rows = [(draw.random(), draw.random() * 5, float(draw.randrange(3)), int(draw.random() < 0.4)) for _ in range(900)]
    train = models.assemble(spark.createDataFrame(rows, "a double, b double, c double, label int"), ["a", "b", "c"])
    rules = dict(n_trees=2, max_depth=6, max_features="sqrt", seed=4, random_cuts=True)
    keep = ["tree", "node", "depth", "feature", "cut", "left", "right", "n", "ones"]
    want = sorted(map(str, forest.grow(train, forest.Rules(**rules)).nodes.select(keep).collect()))
    monkeypatch.setattr(forest, "running_sums", None)
    got = sorted(map(str, forest.grow(train, forest.Rules(**rules, group_rows=100)).nodes.select(keep).collect()))
    assert got == want
