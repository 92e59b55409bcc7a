"""Stored stages in the shared folder, dropped by the operator that made them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cellscape.session import shared_folder

#: Rows of an Arrow batch: texts may be long, and a batch must fit a worker's memory.
BATCH_ROWS = 500
#: A side of a join is broadcast only up to this many rows of two longs; beyond, both sides are shuffled.
BROADCAST_ROWS = 1_000_000


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of Arrow batches that hold whole texts."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) != BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


class Stages:
    """Tables written once and read back: lineage ends there and any executor can be lost."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete stages that nothing reads any more."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
