"""One window serves all years of a position."""

from __future__ import annotations

from cellscape.operators import raster


def test_years_share_one_window(spark):
    cells = spark.createDataFrame([(1, 0, 0, 0, 100.0, 100.0)], "city long, cell_id long, row long, col long, cx double, cy double")
    pixels = spark.createDataFrame(
        [(1, 1990, 125.0, 125.0, 3.0), (1, 2000, 125.0, 125.0, 5.0), (1, 2000, 375.0, 125.0, None), (1, None, 125.0, 125.0, 9.0)],
        "city long, year int, x double, y double, v double")
    met = raster.intersecting_pixels(cells, pixels, 125.0, 250.0, 250.0, [1990, 2000, 2014])
    assert {(r["year"], r["x"], r["v"]) for r in met.where("x is not null").collect()} == {(1990, 125.0, 3.0), (2000, 125.0, 5.0)}
    text = met._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Window") > text.index("Generate inline")  # cells are copied to the years after the window
    stats = raster.zonal_statistics(cells, pixels, 125.0, 250.0, 250.0, {"v": "v"}, ["mean"], {1990: 1990, 2000: 2000, 2014: 2014})
    assert {(r["year_model"], r["mean_v"]) for r in stats.collect()} == {(1990, 3.0), (2000, 5.0), (2014, None)}
