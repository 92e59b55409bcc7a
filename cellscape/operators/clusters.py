"""Urban clusters, distances to them, neighbour counts and labels.

Membership is one row per ``(city, year_model, built_threshold, population_threshold, cell_id)``
with the cluster's root cell; no cluster polygon is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscape.operators.components import TILE, connected_components
from cellscape.operators.hexgrid import cell_col, cell_id, cell_row, neighbour_offsets
from cellscape.operators.nearest import nearest_hexagon
from cellscape.operators.skew import join_city_table, join_counted, rank_within
from cellscape.session import materialize

CLUSTER_KEY = ["city", "year_model", "built_threshold", "population_threshold"]


def urban_cells(cells: DataFrame, built: DataFrame, population: DataFrame, thresholds: list[dict]) -> DataFrame:
    """Cells above each threshold set: ``max_built_lds > built/100`` and ``max_population >= population``.

    The threshold sets are configuration, tested on each row; there is no join for them.
    """
    both = built.select("city", "cell_id", "year_model", "max_built_lds").join(
        population.select("city", "cell_id", "year_model", "max_population"), ["city", "cell_id", "year_model"])
    sets = F.array(*[
        F.struct(F.lit(float(t["built"])).alias("built_threshold"),
                 F.lit(float(t["population"])).alias("population_threshold"))
        for t in thresholds
    ])
    passed = both.select("city", "cell_id", "year_model", F.explode(F.filter(sets, lambda t: (
        F.col("max_built_lds") > t["built_threshold"] / 100)
        & (F.col("max_population") >= t["population_threshold"]))).alias("t"))
    return passed.select(
        "city", "cell_id", "year_model", "t.built_threshold", "t.population_threshold"
    ).join(cells, ["city", "cell_id"])


def membership(urban: DataFrame) -> DataFrame:
    """Add ``root``, the smallest cell id of the connected block of cells."""
    return connected_components(urban, CLUSTER_KEY, shape="hexagon", label="root")


def cluster_summary(members: DataFrame, population: DataFrame, all_years: bool = True) -> DataFrame:
    """One row per cluster: id, number of cells, population.

    With ``all_years`` a cell counts with its mean population of every period, else only with that of
    the cluster's own period.  Cell values are added up before the join, so its key is unique.
    """
    key = ["city", "cell_id"] if all_years else ["city", "cell_id", "year_model"]
    per_cell = population.groupBy(*key).agg(F.sum("mean_population").alias("people"))
    # stored: numbering the clusters and joining them to their members read the sums several times
    summed = materialize(
        members.select(*CLUSTER_KEY, "root", "cell_id").join(per_cell, key)
        .groupBy(*CLUSTER_KEY, "root")
        .agg(F.sum("people").alias("population"), F.count("*").alias("n_cells")), "cluster-sums")
    return rank_within(summed, CLUSTER_KEY, [F.floor(cell_row(F.col("root")) / 64)], [F.col("root")], "cluster_id")


def qualifying(clusters: DataFrame, thresholds: list[dict]) -> DataFrame:
    """Clusters of each threshold set with enough people; adds ``cluster_threshold``."""
    minimum = [
        F.when((F.col("built_threshold") == float(t["built"]))
               & (F.col("population_threshold") == float(t["population"]))
               & (F.col("population") >= float(t["cluster"])), F.lit(float(t["cluster"])))
        for t in thresholds
    ]
    return clusters.withColumn("cluster_threshold", F.explode(F.array_compact(F.array(*minimum))))


def qualifying_members(members: DataFrame, clusters: DataFrame, hot_rows: int = 1_000_000) -> DataFrame:
    """Cells of the qualifying clusters, with ``cluster_threshold``.  One cluster may hold most cells."""
    keep = [*CLUSTER_KEY, "root", "cluster_id", "cluster_threshold", "n_cells"]
    return join_counted(members, clusters.select(*keep), [*CLUSTER_KEY, "root"], "n_cells", hot_rows).drop("n_cells")


URBAN_KEY = ["year_model", "built_threshold", "population_threshold", "cluster_threshold"]


def perimeter(chosen: DataFrame) -> DataFrame:
    """Members with at least one of their six neighbours outside the qualifying clusters.

    Each member tells its neighbours, by direction, that it is there; one partial aggregate collects this, so
    repeated members count once and no member is joined with another.
    """
    row, col = cell_row(F.col("cell_id")), cell_col(F.col("cell_id"))
    itself = F.array(F.struct(row.alias("nrow"), col.alias("ncol")))
    told = chosen.select("city", *URBAN_KEY, "cx", "cy", F.posexplode(F.concat(neighbour_offsets(row, col), itself)))
    own, place = F.col("pos") == 6, F.col("col")
    return (
        told.where((place.nrow >= 0) & (place.ncol >= 0))
        .groupBy("city", *URBAN_KEY, cell_id(place.nrow, place.ncol).alias("cell_id"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("pos"))).alias("bits"),
             F.max(F.when(own, F.col("cx"))).alias("cx"), F.max(F.when(own, F.col("cy"))).alias("cy"))
        .where("bits >= 64 AND bits < 127").drop("bits")
    )


def urban_distance(cells: DataFrame, chosen: DataFrame, side: float, tile: float) -> DataFrame:
    """Flag and distance in km to the nearest qualifying cluster; no rows where none qualifies.

    ``chosen`` comes from ``qualifying_members``.  The way from outside to a member passes the edge of its
    cluster, so only the perimeter is searched; members themselves are at distance 0.
    """
    found = nearest_hexagon(cells, perimeter(chosen), side, tile, URBAN_KEY)
    inside = chosen.select("city", *URBAN_KEY, "cell_id", F.lit(0.0).alias("distance"))
    return found.unionByName(inside).groupBy("city", "cell_id", *URBAN_KEY).agg(F.min("distance").alias("distance")).select(
        "city", "cell_id", *URBAN_KEY,
        F.when(F.col("distance") > 0, 0).otherwise(1).alias("urban_flag"),
        (F.col("distance") / 1000).alias("urban_distance_km"),
    )


def urban_neighbours(cells: DataFrame, chosen: DataFrame, thresholds: list[dict], years: list[int]) -> DataFrame:
    """Number of neighbours inside a qualifying cluster, for each period and threshold set.

    NULL for a cell without neighbours, and for a period without qualifying clusters.  One shuffle brings cells and
    members to blocks of 64 x 64 cells, where each tells its neighbours; links are not formed as rows of their own.
    """
    periods = F.array(*[
        F.struct(F.lit(y).alias("year_model"), F.lit(float(t["built"])).alias("built_threshold"),
                 F.lit(float(t["population"])).alias("population_threshold"),
                 F.lit(float(t["cluster"])).alias("cluster_threshold"))
        for y in years for t in thresholds
    ])
    n = len(years) * len(thresholds)
    period = F.array_position(periods, F.struct(*URBAN_KEY)) - 1  # -1: of no configured period
    counts = [f"n{k}" for k in range(n)]
    row, col, tile = cell_row(F.col("cell_id")), cell_col(F.col("cell_id")), lambda v: F.floor(v / TILE)
    # cells and members go to the blocks they have neighbours in; a cell's row there counts its members by period
    rows = cells.select("city", "cell_id", F.lit(None).cast("long").alias("period")).unionByName(
        chosen.select("city", "cell_id", period.alias("period")))
    blocks = (
        rows.withColumn("trow", F.explode(F.sequence(tile(row - 1), tile(row + 1))))
        .withColumn("tcol", F.explode(F.sequence(tile(col - 1), tile(col + 1))))
        .repartition("city", "trow", "tcol")
        .groupBy("city", "trow", "tcol", "cell_id").agg(
            F.count_if(F.col("period").isNull()).alias("own"),
            *[F.count_if(F.col("period") == k).alias(c) for k, c in enumerate(counts)]))
    itself = F.array(F.struct(row.alias("nrow"), col.alias("ncol")))
    told = blocks.where("own > 0").select(
        "city", "trow", "tcol", "own", *counts, F.posexplode(F.concat(neighbour_offsets(row, col), itself)))
    place, at_home = F.col("col"), F.col("pos") == 6
    met = (
        told.where((tile(place.nrow) == F.col("trow")) & (tile(place.ncol) == F.col("tcol")))
        .groupBy("city", "trow", "tcol", cell_id(place.nrow, place.ncol).alias("cell_id"))
        .agg(F.sum(F.when(at_home, F.col("own"))).alias("own"), F.bool_or(~at_home).alias("linked"),
             *[F.sum(F.when(~at_home, F.col("own") * F.col(c))).alias(c) for c in counts])
        .where("own > 0").drop("tcol"))
    active = chosen.groupBy("city").agg(F.array(*[F.bool_or(period == k) for k in range(n)]).alias("active"))
    bands = met.select("city", "trow").distinct().join(active, "city")
    # a repeated cell has repeated rows and links
    times = F.when(F.col("active").isNull(), F.col("own")).otherwise(F.col("own") * F.col("own")).cast("int")
    inside = F.array(*[F.when(F.col("linked") & F.get("active", F.lit(k)), F.coalesce(F.col("own") * F.col(c), F.lit(0)))
                       for k, c in enumerate(counts)])
    found = met.join(bands, ["city", "trow"], "left").select(
        "city", "cell_id", inside.alias("inside"), F.explode(F.array_repeat(F.lit(0), times)).alias("copy"))
    lost = cells.where("cell_id IS NULL").select(
        "city", "cell_id", F.array_repeat(F.lit(None).cast("long"), n).alias("inside"), F.lit(0).alias("copy"))
    zipped = F.zip_with(periods, "inside", lambda p, v: F.struct(*[p[c].alias(c) for c in URBAN_KEY], v.alias("urban_neighbours")))
    return found.unionByName(lost).select("city", "cell_id", F.inline(zipped))


def next_period_labels(cells: DataFrame, chosen: DataFrame, years: list[int]) -> DataFrame:
    """Label each cell and period with its urban status in the next period.

    Periods whose next period has no qualifying cluster in the city get no rows; the last period of
    all has no label.
    """
    previous = F.create_map(*[F.lit(v) for pair in zip(years[1:], years) for v in pair])
    moved = chosen.select("city", "cell_id", F.try_element_at(previous, F.col("year_model")).alias("year_model")).where(
        F.col("year_model").isNotNull())
    periods = moved.select("city", "year_model").distinct()
    urban = moved.distinct().withColumn("label", F.lit(1))
    return (
        join_city_table(cells.select("city", "cell_id"), periods)
        .join(urban, ["city", "cell_id", "year_model"], "left")
        .select("city", "cell_id", "year_model", F.coalesce("label", F.lit(0)).alias("label"))
    )
