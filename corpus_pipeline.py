"""A training-data pipeline: each stage is one operator, applied to all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscape.llm import decontamination, jaccard_join, packing, secret_scan, toxicity
from cellscape.llm.catalog import BPE, table
from cellscape.llm.stage import Stages


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the model does not reject.  The model learns from the labelled ones among them.

    Each row is judged by its own text alone: null and repeated ids, repeated rows and extra columns do not
    matter.  Null and empty texts stay, very long ones are read whole.  Without labels all rows stay.
    """
    return toxicity.without_rejected(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, one row with the smallest id; one without an id only if none has an id.

    Rows of equal id are told apart.  Null and empty texts are near nothing and stay.  Extra columns are kept.
    """
    rows, key = _keyed(spark, docs, "ngram-jaccard-join")
    groups = jaccard_join.similar_components(_by_key(rows, key))[0].select(F.col("doc_id").alias(key), "component_id")
    groups = groups.join(rows.select(key, F.col("doc_id").cast("long").alias("id")), key)
    first = groups.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", key)).alias("first"))
    return rows.join(first.select(F.col(f"first.{key}").alias(key)), key, "left_semi").select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark, each judged by its own text.

    Null and empty texts stay; extra columns are kept.  An empty benchmark leaves all rows.
    """
    rows, key = _keyed(spark, docs, "decontamination")
    found = decontamination.contaminated(_by_key(rows, key), table(spark, sf_dir, "benchmark"))
    return rows.join(found.select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").select(docs.columns)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a mark; null and empty texts stay as they are.

    Every row stays; ``n_chars`` of a changed text is counted anew.  A column named ``found`` is kept.
    """
    spare = _spare(docs, "found")
    named = docs.withColumnRenamed("found", spare)
    return secret_scan.redact(secret_scan.scan(named)).withColumnRenamed(spare, "found").select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences and their places.

    Each row is a document of its own, whatever its id; null or empty text is the end id alone.
    """
    return packing.pack(packing.pieces_of(docs, public_tokenizers.path(BPE), Stages(spark, "packing"), checksums=True))


STAGES = [
    ("toxicity", toxicity_stage), ("ngram_jaccard_join", jaccard_stage), ("decontamination", decontamination_stage),
    ("secret_scan", secrets_stage), ("pattern_packing", packing_stage)]
ORACLE_SQL = None


def _spare(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    have = {c.lower() for c in docs.columns}
    while name in have:
        name += "_"
    return name


def _keyed(spark: SparkSession, docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` with a unique number for each row, stored so that it stays the same, and the number's name."""
    key = _spare(docs, "row_number")
    return Stages(spark, f"pipeline-{name}").store(docs.withColumn(key, F.monotonically_increasing_id()), "rows"), key


def _by_key(rows: DataFrame, key: str) -> DataFrame:
    """What an operator gets: its decisions are for single rows, whatever their ``doc_id``."""
    return rows.select(F.col(key).alias("doc_id"), "text")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    stages = Stages(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = stages.store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
