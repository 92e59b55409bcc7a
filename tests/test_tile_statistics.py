"""Statistics worked out inside the tiles are those of the met pixels as rows."""

from __future__ import annotations

import random

import pytest
from cellscape.operators import hexgrid, raster
from pyspark.sql import functions as F

BANDS, STATISTICS = {"v": "v", "w": "w"}, ["min", "max", "mean", "stddev", "sum"]


@pytest.mark.parametrize("width,years", [(250.0, {1990: 1990, 2000: 2001, 2014: 2014}), (90.0, None)])
def test_same_as_rows_of_met_pixels(spark, width, years):
    rng = random.Random(5)
    boxes = spark.createDataFrame(
        [(1, 0.0, 0.0, 9000.0, 1500.0), (2, -700.0, 100.0, 900.0, 800.0), (None, 0.0, 0.0, 500.0, 500.0)],
        "city long, xmin double, ymin double, xmax double, ymax double")
    cells = hexgrid.hex_grid(boxes, 125.0)
    cells = cells.unionByName(cells.where("cell_id % 3 = 0"))  # repeated cells count their pixels again
    rows = []
    for city, span in ((1, 9300), (2, 1000), (None, 600), (3, 500)):
        for _ in range(1500):
            x, y = (rng.randrange(-3, int(span / width) + 2) * width + 40, rng.randrange(-3, int(1600 / width) + 2) * width + 7)
            rows.append((city, rng.choice([1990, 2000, 2003, None]), None if rng.random() < 0.02 else x, y,
                         None if rng.random() < 0.1 else rng.random(), rng.choice([None, 1.0, 2.5, float(rng.randrange(9))])))
    pixels = spark.createDataFrame(rows, "city long, year int, x double, y double, v double, w double")
    if years is None:
        pixels = pixels.drop("year")
    new = raster.zonal_statistics(cells, pixels, 125.0, width, width, BANDS, STATISTICS, years)
    assert "MapInArrow" in new._jdf.queryExecution().optimizedPlan().toString()
    key = ["city", "tx", "ty", "cell_id"] + ([] if years is None else ["year"])
    of_years = pixels if years is None else pixels.where(F.col("year").isin(list(years)))
    met = raster.intersecting_pixels(cells, of_years, 125.0, width, width, None if years is None else sorted(years), keep_empty=True)
    old = met.groupBy(*key).agg(*raster._aggregates(BANDS, STATISTICS)).drop("tx", "ty")

    def plain(df):
        names = [f"{s}_{b}" for b in BANDS for s in STATISTICS]
        return sorted((tuple(str(r[k]) for k in ("city", "cell_id", *(["year"] if years else []))),
                       tuple(None if r[n] is None else round(r[n], 8) for n in names)) for r in df.collect())

    assert plain(new) == plain(old)
