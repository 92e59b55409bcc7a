"""Boosted stumps with many rounds, and row weights carried from one stored state to the next."""

import math
import random

import pytest
from pyspark.ml.linalg import Vectors

from cellscape.operators import models


def frame(spark, n=120):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        x = [rng.uniform(-1, 1), rng.uniform(-1, 1), rng.choice([0.0, 1.0])]
        rows.append((i, float(x[0] + 0.6 * x[1] + 0.3 * rng.gauss(0, 1) > 0), Vectors.dense(x)))
    return spark.createDataFrame(rows, ["id", "label", "features"])


@pytest.mark.parametrize("real", [True, False])
def test_two_thousand_stumps_score(spark, real):
    rng = random.Random(9)
    stumps = [models.Stump(rng.randrange(3), rng.uniform(-1, 1), rng.uniform(0.01, 0.99), rng.uniform(0.01, 0.99),
                           rng.uniform(0.1, 2)) for _ in range(2000)]
    model = models.BoostedStumps(stumps=stumps, real=real)
    for r in model.score(frame(spark)).collect():
        p = [s.p_low if r.features[s.feature] <= s.threshold else s.p_high for s in stumps]
        if real:
            want = 1 / (1 + math.exp(-2 * sum(0.5 * math.log(q / (1 - q)) for q in p) / len(p)))
        else:
            share = sum(q * s.weight for q, s in zip(p, stumps)) / sum(s.weight for s in stumps)
            want = math.exp(share) / (math.exp(share) + math.exp(1 - share))
        assert r.score == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("algorithm", ["SAMME", "SAMME.R"])
def test_stored_weights_change_nothing(spark, monkeypatch, algorithm):
    p = {"learning_rate": 0.7, "n_estimators": 5, "algorithm": algorithm}
    plain = models.fit("AdaBoost", p, frame(spark)).stumps
    monkeypatch.setattr(models, "STORE_EVERY", 2)
    stored = models.fit("AdaBoost", p, frame(spark)).stumps
    assert len(plain) == len(stored) == 5
    for a, b in zip(plain, stored):
        assert (a.feature, a.threshold) == (b.feature, b.threshold)
        assert (a.p_low, a.p_high, a.weight) == pytest.approx((b.p_low, b.p_high, b.weight), rel=1e-9)
    # the weights that led to each stump, recomputed row by row
    rows = frame(spark).collect()
    w = [1.0] * len(rows)
    for s in stored:
        for low, got in ((True, s.p_low), (False, s.p_high)):
            side = [i for i, r in enumerate(rows) if (r.features[s.feature] <= s.threshold) == low]
            share = sum(w[i] for i in side if rows[i].label == 1) / sum(w[i] for i in side)
            assert got == pytest.approx(min(max(share, 1e-9), 1 - 1e-9), rel=1e-6)  # shares stay off 0 and 1
        for i, r in enumerate(rows):
            q = s.p_low if r.features[s.feature] <= s.threshold else s.p_high
            if algorithm == "SAMME.R":
                w[i] *= math.exp(-0.7 * (2 * r.label - 1) * 0.5 * math.log(q / (1 - q)))
            elif (q > 0.5) != (r.label == 1):
                w[i] *= math.exp(s.weight)
