"""Classifiers on ``(features VECTOR, label)`` frames; every fit is a distributed Spark job.

``fit(name, parameters, train)`` returns an object with ``score(df)``, which adds ``score`` (the
probability of class 1), and ``importances(columns)``.
"""

from __future__ import annotations

import itertools
import math
import re
from dataclasses import dataclass, field

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscape.operators.bayes import GaussianNB
from cellscape.operators.forest import Rules, grow
from cellscape.session import materialize

MAX_DEPTH = 30  # the library's limit for boosted trees; deeper requests are cut to it
MAX_BINS = 255


def assemble(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``features``; the label stays as it is (NULL where unknown)."""
    return VectorAssembler(inputCols=columns, outputCol="features").transform(df)


def labelled(df: DataFrame) -> DataFrame:
    return df.where(F.col("label").isNotNull()).withColumn("label", F.col("label").cast("double"))


@dataclass
class LibraryModel:
    model: object
    output: str = "probability"

    def score(self, df: DataFrame) -> DataFrame:
        made = self.model.transform(df)
        extra = [c for c in ("rawPrediction", "probability", "prediction") if c in made.columns]
        return made.withColumn("score", vector_to_array(self.output)[1]).drop(*extra)

    def importances(self, columns: list[str]) -> list[tuple[str, float]] | None:
        """Feature importances, else coefficients, else None."""
        for attribute in ("featureImportances", "coefficients"):
            if hasattr(self.model, attribute):
                return [(c, float(v)) for c, v in zip(columns, getattr(self.model, attribute).toArray())]
        return None


@dataclass
class CalibratedMargin(LibraryModel):
    """A linear margin turned into a probability by a one-feature logistic regression."""

    calibration: object = None

    def score(self, df: DataFrame) -> DataFrame:
        margin = self.model.transform(df).withColumn("margin", vector_to_array("rawPrediction")[1])
        w, b = float(self.calibration.coefficients[0]), float(self.calibration.intercept)
        return margin.withColumn("score", 1 / (1 + F.exp(-(w * F.col("margin") + b)))).drop(
            "rawPrediction", "prediction", "margin")


def tree_rules(name: str, p: dict) -> Rules:
    """How a tree model of the given name and parameters is grown."""
    return Rules(
        n_trees=int(p.get("n_estimators", 1)) if name != "DecisionTreeClassifier" else 1, criterion=p.get("criterion", "gini"),
        max_depth=p.get("max_depth"), min_split=int(p.get("min_samples_split", 2)), max_features=p.get("max_features"),
        seed=int(p.get("random_state", 0)), bootstrap=name == "RandomForest", random_cuts=name == "ExtraTrees")


def _trees(name: str):
    return lambda p, train: grow(train, tree_rules(name, p))


def _logistic(p: dict, train: DataFrame):
    n = train.count()
    return LibraryModel(LogisticRegression(
        regParam=1.0 / (float(p["C_reg"]) * n), elasticNetParam=1.0 if p["penalty"] == "l1" else 0.0,
        standardization=False, maxIter=100).fit(train))


def _gradient_boosting(p: dict, train: DataFrame):
    return LibraryModel(GBTClassifier(
        maxIter=int(p["n_estimators"]), stepSize=float(p["learning_rate"]), subsamplingRate=float(p["subsample"]),
        maxDepth=min(int(p["max_depth"]), MAX_DEPTH), maxBins=MAX_BINS, seed=int(p.get("random_state", 0))).fit(train))


def _margin(train: DataFrame, reg: float):
    svc = LinearSVC(regParam=reg, standardization=False, maxIter=50).fit(train)
    margins = svc.transform(train).select("label", vector_to_array("rawPrediction")[1].alias("margin"))
    return CalibratedMargin(svc, calibration=LogisticRegression().fit(assemble(margins, ["margin"])))


def _support_vectors(p: dict, train: DataFrame):
    if p.get("kernel", "linear") != "linear":
        raise ValueError("only the linear kernel is supported")
    return _margin(train, 1.0 / (float(p["C_reg"]) * train.count()))


def _linear(p: dict, train: DataFrame, alpha: float = 1e-4):
    if p["loss"] == "hinge":
        return _margin(train, alpha)
    if p["loss"] not in ("log", "log_loss"):
        raise ValueError(f"unsupported loss {p['loss']}")
    mix = {"l1": 1.0, "elasticnet": 0.15}.get(p["penalty"], 0.0)
    return LibraryModel(LogisticRegression(regParam=alpha, elasticNetParam=mix, standardization=False).fit(train))


# ----- boosting of stumps ---------------------------------------------------------------------

@dataclass
class Stump:
    feature: int
    threshold: float
    p_low: float  # weighted share of class 1 at or below the threshold
    p_high: float
    weight: float = 1.0

    def sides(self, kind: str) -> tuple[float, float]:
        """What the stump adds at or below the threshold and above it."""
        low, high = self.p_low, self.p_high
        if kind == "log_odds":
            return 0.5 * math.log(low / (1 - low)), 0.5 * math.log(high / (1 - high))
        if kind == "vote":
            return self.weight if low > 0.5 else -self.weight, self.weight if high > 0.5 else -self.weight
        return self.weight * low, self.weight * high


def fold(stumps: list[Stump], kind: str) -> Column:
    """Sum of what the stumps add to a row with ``features``.

    The stumps are one constant array that is folded, so the expression has the same depth for any number of
    them; the row's values travel with the sum and are unpacked once.
    """
    if not stumps:
        return F.lit(0.0)
    table = F.array(*[
        F.struct(F.lit(s.feature).alias("f"), F.lit(s.threshold).alias("t"), F.lit(low).alias("low"), F.lit(high).alias("high"))
        for s in stumps for low, high in [s.sides(kind)]])
    start = F.struct(F.lit(0.0).alias("sum"), vector_to_array("features").alias("x"))

    def step(state, s):
        gain = F.when(F.get(state["x"], s["f"]) <= s["t"], s["low"]).otherwise(s["high"])
        return F.struct((state["sum"] + gain).alias("sum"), state["x"].alias("x"))

    return F.aggregate(table, start, step, lambda state: state["sum"])


@dataclass
class BoostedStumps:
    stumps: list[Stump] = field(default_factory=list)
    real: bool = True
    n_features: int = 0

    def score(self, df: DataFrame) -> DataFrame:
        if self.real:
            level = fold(self.stumps, "log_odds") / max(1, len(self.stumps))
            return df.withColumn("score", 1 / (1 + F.exp(-2 * level)))
        total = sum(s.weight for s in self.stumps) or 1.0
        share = fold(self.stumps, "share") / total
        return df.withColumn("score", F.exp(share) / (F.exp(share) + F.exp(1 - share)))

    def importances(self, columns: list[str]):
        used = [0.0] * len(columns)
        total = sum(s.weight for s in self.stumps) or 1.0
        for s in self.stumps:
            used[s.feature] += s.weight / total
        return list(zip(columns, used))


_STUMP = re.compile(r"If \(feature (\d+) <= ([-+0-9.Ee]+)\)")


STORE_EVERY = 25  # rounds after which the row weights are stored anew


def _boosted_stumps(p: dict, train: DataFrame):
    """AdaBoost on depth-one trees.

    The logarithm of each row's weight is stored every ``STORE_EVERY`` rounds, and only the stumps found since
    are folded into it, so neither lineage nor expressions grow with the rounds.
    """
    real = p.get("algorithm", "SAMME.R") == "SAMME.R"
    rate, rounds, tiny = float(p["learning_rate"]), int(p["n_estimators"]), 1e-9
    model = BoostedStumps(real=real)
    x, sign = vector_to_array("features"), 2 * F.col("label") - 1
    kept, since = materialize(train.withColumn("log_weight", F.lit(0.0)), "boosting-weights"), []
    for _ in range(rounds):
        if real:
            grown = F.col("log_weight") - rate * sign * fold(since, "log_odds")
        else:  # a wrong vote adds the stump's weight, a right one nothing
            grown = F.col("log_weight") + (sum(s.weight for s in since) - sign * fold(since, "vote")) / 2
        if len(since) == STORE_EVERY:
            kept = materialize(kept.withColumn("log_weight", grown), "boosting-weights")
            since, grown = [], F.col("log_weight")
        weighted = kept.withColumn("w", F.exp(grown))
        tree = DecisionTreeClassifier(maxDepth=1, weightCol="w", maxBins=MAX_BINS).fit(weighted)
        found = _STUMP.search(tree.toDebugString)
        if not found:
            break
        f, threshold = int(found.group(1)), float(found.group(2))
        low = x[f] <= threshold
        one = F.col("label") == 1
        sums = weighted.agg(
            F.sum(F.when(low, F.col("w"))).alias("low"), F.sum(F.when(low & one, F.col("w"))).alias("low1"),
            F.sum(F.when(~low, F.col("w"))).alias("high"), F.sum(F.when(~low & one, F.col("w"))).alias("high1"),
        ).first()

        def share(ones, total):
            return min(max((ones or 0.0) / total if total else 0.5, tiny), 1 - tiny)

        stump = Stump(f, threshold, share(sums["low1"], sums["low"]), share(sums["high1"], sums["high"]))
        wrong = sum(
            (min(q, 1 - q)) * (t or 0.0)
            for q, t in ((stump.p_low, sums["low"]), (stump.p_high, sums["high"]))
        ) / ((sums["low"] or 0.0) + (sums["high"] or 0.0))
        if not real:
            if wrong >= 0.5:
                break
            stump.weight = rate * math.log((1 - wrong) / max(wrong, tiny))
        model.stumps.append(stump)
        since.append(stump)
        if wrong <= tiny:
            break
    return model


def _naive_bayes(p: dict, train: DataFrame):
    return GaussianNB.fit_vectors(train)


MODELS = {
    "RandomForest": _trees("RandomForest"),
    "SVM": _support_vectors,
    "LogisticRegression": _logistic,
    "AdaBoost": _boosted_stumps,
    "ExtraTrees": _trees("ExtraTrees"),
    "GradientBoostingClassifier": _gradient_boosting,
    "GaussianNB": _naive_bayes,
    "DecisionTreeClassifier": _trees("DecisionTreeClassifier"),
    "SGDClassifier": _linear,
}


def fit(name: str, parameters: dict, train: DataFrame):
    """Fit one model; nearest neighbours have no fit, see ``operators.knn``."""
    if name not in MODELS:
        raise ValueError(f"unsupported model {name}")
    return MODELS[name](parameters, labelled(train).select("features", "label"))


def parameter_grid(grids: dict[str, dict[str, list]]) -> list[tuple[str, dict]]:
    """Every combination of the parameter lists of every model, names in sorted order."""
    out = []
    for name, lists in grids.items():
        keys = sorted(lists)
        out += [(name, dict(zip(keys, values))) for values in itertools.product(*(lists[k] for k in keys))]
    return out
