"""Evaluation of scores: folds, confusion counts, metrics, best models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscape.config import CUTOFFS
from cellscape.operators.skew import join_city_table, rank_within


def assign_folds(df: DataFrame, by: list[str], coarse: list[Column], order: list[str], folds: int) -> DataFrame:
    """Add ``fold`` 1..k: contiguous blocks in order, the first ``n mod k`` one row larger.

    ``coarse`` as in ``rank_within``.  The group size reaches the rows through a table of (group,
    coarse key), not by a join on a group key that may be hot.
    """
    ranked = rank_within(df, by, coarse, [F.col(c) for c in order], "_position")
    if by:
        keys = {f"_k{i}": c for i, c in enumerate(coarse)}
        sizes = df.groupBy(*by).agg(F.count("*").alias("_total"))
        spread = df.withColumns(keys).select(*by, *keys).distinct().join(sizes, by)
        sized = ranked.withColumns(keys).join(spread, [*by, *keys]).drop(*keys)
    else:
        sized = ranked.withColumn("_total", df.agg(F.count("*")).scalar())
    index, small = F.col("_position") - 1, F.floor(F.col("_total") / folds)
    larger = F.col("_total") % folds
    cut = larger * (small + 1)
    fold = F.when(index < cut, F.floor(index / (small + 1))).otherwise(
        larger + F.floor(F.try_divide(index - cut, small)))
    return sized.withColumn("fold", (fold + 1).cast("int")).drop("_position", "_total")


def confusion_by_cutoff(scored: DataFrame, by: list[str], cutoffs: list[float] | None = None) -> DataFrame:
    """True/false positives/negatives per cutoff; rows without a label count nowhere.

    Scores are first reduced to the number of cutoffs they reach, so one small aggregate replaces one
    pass over the scores per cutoff.
    """
    cutoffs = sorted(cutoffs or CUTOFFS)
    reached = sum(((F.col("score") >= c).cast("int") for c in cutoffs), F.lit(0))
    counts = (
        scored.groupBy(*by, reached.alias("reached"))
        .agg(F.sum((F.col("label") == 1).cast("long")).alias("ones"),
             F.sum((F.col("label") == 0).cast("long")).alias("zeros"))
        .select(*by, "reached", F.coalesce("ones", F.lit(0)).alias("ones"), F.coalesce("zeros", F.lit(0)).alias("zeros"))
    )
    steps = F.array(*[
        F.struct(F.lit(i + 1).alias("i"), F.lit(c).alias("cutoff")) for i, c in enumerate(cutoffs)])
    per_step = counts.withColumn("s", F.explode(steps))
    positive = F.col("reached") >= F.col("s.i")
    return per_step.groupBy(*by, F.col("s.cutoff").alias("cutoff")).agg(
        F.sum(F.when(positive, F.col("ones")).otherwise(0)).alias("tp"),
        F.sum(F.when(~positive, F.col("zeros")).otherwise(0)).alias("tn"),
        F.sum(F.when(positive, F.col("zeros")).otherwise(0)).alias("fp"),
        F.sum(F.when(~positive, F.col("ones")).otherwise(0)).alias("fn"),
    )


def with_metrics(confusion: DataFrame) -> DataFrame:
    """Add precision, recall, f1 and accuracy; NULL where the denominator is 0."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    return confusion.withColumns({
        "precision": F.try_divide(tp, tp + fp),
        "recall": F.try_divide(tp, tp + fn),
        "f1": F.try_divide(2 * tp, 2 * tp + fp + fn),
        "accuracy": F.try_divide(tp + tn, tp + tn + fp + fn),
    })


# Stored metric names; "auc@" is the accuracy.
METRIC_NAMES = {
    "tp": "true positives@", "tn": "true negatives@", "fp": "false positives@", "fn": "false negatives@",
    "precision": "precision@", "recall": "recall@", "f1": "f1@", "accuracy": "auc@",
}


def long_metrics(metrics: DataFrame, by: list[str]) -> DataFrame:
    """``(by, metric, cutoff, value)``, one row per metric."""
    rows = F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(c).cast("double").alias("value")) for c, name in METRIC_NAMES.items()])
    return metrics.select(*by, "cutoff", F.explode(rows).alias("m")).select(*by, "m.metric", "cutoff", "m.value")


def mean_over_folds(metrics: DataFrame, by: list[str]) -> DataFrame:
    """Average of each metric and cutoff over folds; undefined folds are left out."""
    return metrics.groupBy(*by, "metric", "cutoff").agg(F.avg("value").alias("value"))


def split_metric_keys(keyed: DataFrame) -> DataFrame:
    """``"metric|cutoff"`` keys to two columns; the cutoff is NULL when absent or empty."""
    parts = F.split(F.col("key"), r"\|")
    cutoff = F.try_element_at(parts, F.lit(2))
    return keyed.withColumns({
        "metric": F.element_at(parts, 1),
        "cutoff": F.when(cutoff != "", cutoff),
    }).drop("key")


def best_per_group(evaluations: DataFrame, by: list[str]) -> DataFrame:
    """Model and cutoff with the highest f1 per group; ties go to the lower model id, then cutoff.

    An aggregate, not a sorted window: partial maxima are taken before the shuffle.
    """
    known = evaluations.where((F.col("metric") == "f1@") & F.col("value").isNotNull())
    rank = F.struct(F.col("value").alias("v"), (-F.col("model_id")).alias("m"), (-F.col("cutoff").cast("double")).alias("c"))
    return known.groupBy(*by).agg(F.max(rank).alias("r")).select(
        *by, (-F.col("r.m")).alias("model_id"), (-F.col("r.c")).alias("cutoff"), F.col("r.v").alias("value"))


def predicted_cells(predictions: DataFrame, best: DataFrame) -> DataFrame:
    """Cells the chosen models of their city score at or above the cutoff."""
    chosen = best.select(*[c for c in best.columns if c != "value"])
    return join_city_table(predictions, chosen, ("city", "model_id")).where(F.col("score") >= F.col("cutoff"))


def ranked_importances(importances: DataFrame) -> DataFrame:
    """Dense rank of the importance within each model; a model has one row per feature."""
    order = Window.partitionBy("model_id").orderBy(F.desc("feature_importance"))
    return importances.withColumn("rank_abs", F.dense_rank().over(order))
