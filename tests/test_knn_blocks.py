"""Neighbours by scalar products equal those by differences, ties and odd rows included."""

from __future__ import annotations

import numpy as np

from cellscape.operators import knn


def test_rows_far_from_the_origin_and_odd_rows(spark, monkeypatch):
    draw = np.random.default_rng(2)
    x = np.round(draw.normal(size=(260, 5)), 1) + 1e6  # many ties; scalar products lose the digits that matter
    x[11] = 1e200
    df = spark.createDataFrame([(i, [float(v) for v in r], i % 2) for i, r in enumerate(x)], "id long, x array<double>, label int")
    monkeypatch.setattr(knn, "CHUNK", 64)
    got = {r["query_id"]: [n["id"] for n in r["neighbours"]] for r in knn.nearest_neighbours(df, df, 4, True).collect()}
    for i in set(range(260)) - {11}:
        with np.errstate(over="ignore"):
            d2 = ((x[i] - x) ** 2).sum(axis=1)
        d2[i] = np.inf
        order = [j for j in np.lexsort((np.arange(260), d2)) if np.isfinite(d2[j])]
        assert got[i] == order[:4]


def test_one_product_stands_for_all_differences():
    draw = np.random.default_rng(1)
    q, t = draw.normal(size=(40, 64)), draw.normal(size=(3000, 64))
    row, _ = knn._within_reach(q @ t.T, (q * q).sum(axis=1), (t * t).sum(axis=1), 64, 5, None)
    assert (np.bincount(row) == 5).all()
