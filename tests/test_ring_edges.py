"""Edges of rings are made once, and not for each cell."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellscape.operators import sweep
from cellscape.operators.hexgrid import centre_distance


def test_edges_are_not_worked_out_to_be_counted(spark):
    ring = "array(named_struct('x', 0D, 'y', 0D), named_struct('x', id + 4D, 'y', 0D), named_struct('x', 0D, 'y', 4D))"
    edges = sweep.ring_segments(spark.range(3).selectExpr("id city", f"{ring} ring"), ["city"])
    assert edges.count() == 9
    assert "size(zip_with" not in edges._jdf.queryExecution().optimizedPlan().toString()
    cells = spark.createDataFrame([(c, 0, 9.0, 0.0) for c in range(3)], "city long, cell_id long, cx double, cy double")
    rings = cells.select("city", F.expr(ring.replace("id", "city")).alias("ring"))
    assert sorted(r[2] * 1000 for r in centre_distance(cells, rings).collect()) == [3.0, 4.0, 5.0]
