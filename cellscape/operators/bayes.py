"""Gaussian naive Bayes: one aggregate to fit, one expression to score."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMOOTHING = 1e-9  # fixed value: share of the largest variance added to all variances


@dataclass
class GaussianNB:
    prior: dict[int, float]
    mean: dict[int, list[float]]
    variance: dict[int, list[float]]

    @classmethod
    def fit_columns(cls, train: DataFrame, columns: list[Column]) -> "GaussianNB":
        """``train`` has ``label`` 0/1 without NULLs."""
        def moments(prefix):
            return [e for i, c in enumerate(columns)
                    for e in (F.avg(c).alias(f"m{i}"), F.var_pop(c).alias(f"v{i}"))] + [F.count("*").alias("n")]

        rows = train.groupBy(F.col("label").cast("int").alias("label")).agg(*moments("")).collect()
        overall = train.agg(*[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(columns)]).first()
        extra = SMOOTHING * max(overall)
        total = sum(r["n"] for r in rows)
        k = range(len(columns))
        return cls(
            {r["label"]: r["n"] / total for r in rows},
            {r["label"]: [r[f"m{i}"] for i in k] for r in rows},
            {r["label"]: [r[f"v{i}"] + extra for i in k] for r in rows},
        )

    @classmethod
    def fit_vectors(cls, train: DataFrame) -> "GaussianNB":
        size = len(train.select("features").first()[0])
        x = vector_to_array("features")
        return cls.fit_columns(train, [x[i] for i in range(size)])

    def probability(self, columns: list[Column]) -> Column:
        def joint(c: int) -> Column:
            total = F.lit(math.log(self.prior[c]))
            for x, m, v in zip(columns, self.mean[c], self.variance[c]):
                total = total - 0.5 * math.log(2 * math.pi * v) - (x - m) * (x - m) / (2 * v)
            return total

        if 1 not in self.prior:
            return F.lit(0.0)
        if 0 not in self.prior:
            return F.lit(1.0)
        return 1 / (1 + F.exp(joint(0) - joint(1)))

    def score(self, df: DataFrame) -> DataFrame:
        x = vector_to_array("features")
        size = len(next(iter(self.mean.values())))
        return df.withColumn("score", self.probability([x[i] for i in range(size)]))

    def importances(self, columns: list[str]):
        return None
