"""Stored stages asked for by several threads, and layers that are built at once."""

from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

from catalog import queries
from cellscape.session import materialize_once
from pyspark.sql import functions as F


def test_threads_that_ask_for_one_stage_build_it_once(spark):
    built, start = [], Barrier(4)

    def build():
        built.append(1)
        return spark.range(5)

    def ask(_):
        start.wait()
        return materialize_once(spark, "asked-by-threads", build).count()

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(ask, range(4))) == [5] * 4
    assert len(built) == 1


def test_layers_are_built_at_once(spark, monkeypatch):
    together = Barrier(3, timeout=20)
    names = [*queries.LAYERS, "population", "built", "lights"]

    def stored(spark, sf, name):
        together.wait()
        return spark.range(1).select(F.lit(name).alias("name"))

    monkeypatch.setattr(queries, "stored_layer", stored)
    monkeypatch.setattr(queries, "stored_zonal", stored)
    monkeypatch.setattr(queries.features, "features_wide", lambda layers, urban, *_: {**layers, "urban_distance": urban})
    found = queries.make_features(spark, "nowhere")
    assert sorted(df.first().name for df in found.values()) == sorted(names)
