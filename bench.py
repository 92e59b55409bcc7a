"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores.  The stored stages (clipped grid, way
positions, yearly zonal tables, clusters) are timed on their own, then the queries that read them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from catalog import queries as q
from cellscape.session import local_session

STAGES = {
    "stage_cells": q.cells,
    "stage_way_nodes": q.way_nodes,
    "stage_zonal_built": lambda spark, sf: q.stored_zonal(spark, sf, "built"),
    "stage_zonal_population": lambda spark, sf: q.stored_zonal(spark, sf, "population"),
    "stage_zonal_lights": lambda spark, sf: q.stored_zonal(spark, sf, "lights"),
    "stage_members": q.members,
    "stage_chosen": q.chosen,
    **{f"stage_{n}": (lambda spark, sf, n=n: q.stored_layer(spark, sf, n)) for n in q.LAYERS},
    "stage_features": q.stored_features,
    "stage_labels": q.stored_labels,
}
QUERIES = [
    "hex_grid", "grid_clip", "cell_pixel_intersects", "zonal_built", "zonal_population", "zonal_settlements", "zonal_lights",
    "zonal_dem", "slope_raster", "zonal_slope", "raster_regions", "zonal_built_region", "raster_clip", "raster_reproject",
    "water_distance", "highway_distance", "geopin_distances", "center_distance", "urban_cells", "urban_clusters",
    "cluster_population", "urban_distance", "urban_neighbours", "labels_next_period", "training_frame", "way_lines",
    "dedupe_consecutive", "dissolve_boundary", "best_prediction_cells", "confusion_by_cutoff", "cv_metrics", "kfold_assign",
    "gaussian_nb", "knn_classify", "distance_functions", "train_logistic", "train_random_forest", "train_extra_trees",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session(cpus, partitions=int(cpus))
    names = sys.argv[1:] or QUERIES
    seconds: dict[str, float] = {}
    q.QUERIES["hex_grid"](spark, sf).count()  # start-up is not timed
    for name, build in STAGES.items():
        start = time.time()
        build(spark, sf)
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    for name in names:
        start = time.time()
        q.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf)}))


if __name__ == "__main__":
    main()
