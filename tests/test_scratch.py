"""What a stage stores on its way, and shuffle files of queries that have ended, do not stay on the disk."""

import os
import time

from cellscape.session import configure, materialize, materialize_once, scratch, shared_folder
from pyspark.sql import functions as F


def folders(spark):
    return {f for f in os.listdir(shared_folder(spark).removeprefix("file:")) if f.startswith("way-")}


def names(spark, before):
    return sorted(f.rpartition("-")[0] for f in folders(spark) - before)


def test_tables_on_the_way_to_a_stage_are_deleted(spark):
    before = folders(spark)
    kept = materialize(spark.range(3), "way-kept")

    def inner():
        return materialize(spark.range(10), "way-inner").where("id > 2")

    def outer():
        first = materialize(spark.range(20), "way-outer")
        return first.join(materialize_once(spark, "way-stage-inner", inner), "id")

    assert materialize_once(spark, "way-stage-outer", outer).count() == 7
    assert materialize_once(spark, "way-stage-inner", inner).count() == 7 and kept.count() == 3
    assert names(spark, before) == ["way-kept", "way-stage-inner", "way-stage-outer"]


def test_scopes_end_when_a_stage_fails(spark):
    before = folders(spark)
    try:
        with scratch(spark):
            materialize(spark.range(3), "way-failed")
            raise KeyError
    except KeyError:
        pass
    materialize(spark.range(3), "way-after")
    assert names(spark, before) == ["way-after"]


def test_shuffle_files_go_with_their_query(spark):
    configure(spark)
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return manager.getAllBlocks().mkString(" ").count("shuffle_")

    before = files()
    df = spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.count("*").alias("n"))
    stored = materialize(df, "way-shuffled")
    assert stored.agg(F.sum("n")).first()[0] == 100_000
    assert df.count() == 1000 and df.count() == 1000  # and it can be run again
    deadline = 50
    while files() > before and deadline:
        deadline -= 1
        time.sleep(0.1)
    assert files() <= before
