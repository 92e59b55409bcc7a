"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellscape.llm import (
    decontamination, divergence, exact_topk, fingerprints, html_text, jaccard_join, license_scan, packing, prefix_trie, secret_scan, substring_dedup, token_files, toxicity)
from cellscape.llm.stage import Stages

BPE = "byte_bpe_50k.json"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.grade_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op2_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.scan(table(spark, sf, "documents"))


def op3_exact_topk(spark: SparkSession, sf: str) -> DataFrame:
    whole = F.transform("embedding", lambda x: F.floor(F.lit(1024.0) * x.cast("double")).cast("double"))
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    vectors = table(spark, sf, "embeddings").where(usable).select(F.col("vec_id").cast("long").alias("id"), whole.alias("v"))
    return exact_topk.top_k(vectors, F.col("id") % 100 == 0)


def op4_token_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = f"{Stages(spark, 'token-files').root}/files"
    token_files.write_files(table(spark, sf, "documents"), public_tokenizers.path(BPE), folder)
    return token_files.read_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.similar_components(table(spark, sf, "documents"))[0]


def op6_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(table(spark, sf, "documents").select("doc_id", "text")))


def op7_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.main_text(table(spark, sf, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op8_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op9_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup.strip_repeats(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_pattern_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.pieces_of(table(spark, sf, "documents"), public_tokenizers.path(BPE), Stages(spark, "packing"))
    digest = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "part", "local")
    return packing.pack(digest)


def op11_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(table(spark, sf, "documents"))


def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf, "conversations")).drop("enter_at", "exit_at")


def op13_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, sf, "documents"))


QUERIES = {f.__name__: f for f in [
    op1_toxicity, op2_license_scan, op3_exact_topk, op4_token_files, op5_ngram_jaccard_join, op6_secret_scan, op7_html_text,
    op8_decontamination, op9_substring_dedup, op10_pattern_packing, op11_source_divergence, op12_prefix_trie,
    op13_fingerprints]}

SQL = {
    "op11_source_divergence": divergence.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_fingerprints": fingerprints.oracle(),
    "op2_license_scan": license_scan.oracle(),
    "op3_exact_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
}
