"""Models of many units - a city, or a city and a fold - fitted at once: no loop over units, no unit in one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscape.operators.bayes import SMOOTHING
from cellscape.operators.forest import grow
from cellscape.operators.models import tree_rules
from cellscape.operators.skew import join_dimension


@dataclass
class UnitBayes:
    """Gaussian naive Bayes for each unit: one aggregate by unit and class, one row of parameters a unit."""

    parameters: DataFrame
    by: list[str]
    width: int

    @classmethod
    def fit(cls, train: DataFrame, by: list[str]) -> "UnitBayes":
        x = vector_to_array("features")
        rows = train.select(*by, F.col("label").cast("int").alias("label"), x.alias("x"))
        width = rows.agg(F.max(F.size("x"))).first()[0] or 0
        each = [F.col("x")[i] for i in range(width)]
        moments = rows.groupBy(*by, "label").agg(
            F.count("*").alias("n"), F.array(*[F.avg(c) for c in each]).alias("mean"), F.array(*[F.var_pop(c) for c in each]).alias("variance"))
        whole = rows.groupBy(*by).agg(F.count("*").alias("total"), (SMOOTHING * F.greatest(*[F.var_pop(c) for c in each], F.lit(0.0))).alias("extra"))
        pick = lambda c, k: F.max(F.when(F.col("label") == k, F.col(c)))
        names = [(c, k) for c in ("n", "mean", "variance") for k in (0, 1)]
        return cls(moments.groupBy(*by).agg(*[pick(c, k).alias(f"{c}{k}") for c, k in names]).join(whole, by), by, width)

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``score``, the probability of class 1; rows of units that had no training rows are left out."""
        joined = join_dimension(df.withColumn("_x", vector_to_array("features")), self.parameters, self.by)

        def joint(k: int) -> Column:
            out = F.log(F.col(f"n{k}") / F.col("total"))
            for i in range(self.width):
                v, gap = F.col(f"variance{k}")[i] + F.col("extra"), F.col("_x")[i] - F.col(f"mean{k}")[i]
                out = out - 0.5 * F.log(2 * F.pi() * v) - gap * gap / (2 * v)
            return out

        share = F.when(F.col("n1").isNull(), 0.0).when(F.col("n0").isNull(), 1.0).otherwise(1 / (1 + F.exp(joint(0) - joint(1))))
        return joined.withColumn("score", share).select(*df.columns, "score")

    def importance_rows(self) -> None:
        return None


TREES = ("RandomForest", "ExtraTrees", "DecisionTreeClassifier")


def fit_units(name: str, parameters: dict, train: DataFrame, by: list[str]):
    """Fit one model for each unit of ``train``, ``(by, features, label)``."""
    known = train.where("label is not null")
    if name == "GaussianNB":
        return UnitBayes.fit(known, by)
    if name in TREES:
        return grow(known, tree_rules(name, parameters), by)
    raise ValueError(f"{name} has no fit by unit")
