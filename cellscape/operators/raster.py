"""Raster operators over pixel tables ``(city, [year], x, y, <band columns>)``.

``x, y`` is the pixel centre in the metres of the grid.  Pixels of one raster are ``width`` x
``height`` apart, so ``floor(x / width)`` identifies a pixel column whatever the raster's origin is.
No data means no row.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscape.functions import geometry as g
from cellscape.operators.components import connected_components, row_changes, whole_groups
from cellscape.operators.sweep import inside

CELLS_PER_TILE = 64  # cells across one tile of the zonal join


def _index(value: Column, step: float) -> Column:
    return F.floor(value / step)


def _steps(low: Column, high: Column, step: float) -> Column:
    return F.sequence(_index(low, step), _index(high, step))


def _tile_size(side: float) -> float:
    return CELLS_PER_TILE * side


def intersecting_pixels(
    cells: DataFrame, pixels: DataFrame, side: float, width: float, height: float,
    years: list[int] | None = None, keep_empty: bool = False,
) -> DataFrame:
    """Cells with the pixels they share a point with: ``(city, tx, ty, cell_id, [year], <bands>)``.

    One shuffle brings compact cell rows and pixel rows to their tiles.  There each cell is expanded
    to the pixel positions it may meet, and a window over the position hands it the one pixel of each year stored
    there; the exact hexagon-rectangle test decides.  Partitioned by tile, so aggregates per cell
    follow without a shuffle.  With ``keep_empty`` positions without a pixel stay, as NULLs.
    """
    tile, b = CELLS_PER_TILE * side, g.apothem(side)
    reach_x, reach_y = width / 2 + b, height / 2 + side
    bands = [c for c in pixels.columns if c not in ("city", "year")]
    x, y, cx, cy = F.col("x"), F.col("y"), F.col("cx"), F.col("cy")
    # a pixel goes to every tile with a cell it may meet, nearly always one
    placed_pixels = (
        pixels.withColumn("tx", F.explode(_steps(x - reach_x, x + reach_x, tile)))
        .withColumn("ty", F.explode(_steps(y - reach_y, y + reach_y, tile)))
    )
    placed_cells = cells.select("city", "cell_id", "cx", "cy", _index(cx, tile).alias("tx"), _index(cy, tile).alias("ty"))
    rows = placed_cells.unionByName(placed_pixels, allowMissingColumns=True).repartition("city", "tx", "ty")
    is_cell = F.col("cell_id").isNotNull()
    def positions(centre: Column, reach: float, own: Column, step: float) -> Column:
        low = F.when(is_cell, _index(centre - reach, step)).otherwise(_index(own, step))
        high = F.when(is_cell, _index(centre + reach, step)).otherwise(_index(own, step))
        return F.explode(F.sequence(low, high))

    rows = rows.withColumn("ix", positions(cx, reach_x, x, width)).withColumn("iy", positions(cy, reach_y, y, height))
    spot, year = Window.partitionBy("city", "tx", "ty", "ix", "iy"), []
    if years is None:
        met = rows.select("city", "tx", "ty", "cell_id", "cx", "cy", *[F.max(c).over(spot).alias(c) for c in bands]).where(is_cell)
    else:
        # the rows of a position are sorted once for all years; cells are copied to the years after that
        year, kind = ["year"], "long" if pixels.schema["year"].dataType.simpleString() == "bigint" else "int"
        wide = rows.select("city", "tx", "ty", "cell_id", "cx", "cy", *[
            F.max(F.when(F.col("year") == v, F.col(c))).over(spot).alias(f"{c}_{v}") for v in years for c in bands]).where(is_cell)
        each = F.array(*[F.struct(F.lit(v).cast(kind).alias("year"), *[F.col(f"{c}_{v}").alias(c) for c in bands]) for v in years])
        met = wide.select("city", "tx", "ty", "cell_id", "cx", "cy", F.inline(each))
    meets = g.hexagon_meets_rectangle(cx - x, cy - y, F.lit(width / 2), F.lit(height / 2), side)
    key = ["city", "tx", "ty", "cell_id", *year]
    if keep_empty:
        return met.select(*key, *[F.when(meets, F.col(c)).alias(c) for c in bands])
    return met.where(meets).select(*key, *bands)


STATISTICS = {
    "min": F.min,
    "max": F.max,
    "mean": F.avg,
    "stddev": F.stddev_samp,
    "sum": F.sum,
}


def zonal_statistics(
    cells: DataFrame, pixels: DataFrame, side: float, width: float, height: float,
    bands: dict[str, str], statistics: list[str], year_map: dict[int, int] | None = None,
    mode: str = "pixel",
) -> DataFrame:
    """Statistics of every band per cell (and year); cells without pixels keep a row of NULLs.

    ``bands`` maps a band column to the suffix of its statistics; all bands are done in one pass.
    ``year_map`` maps data year to model year.  ``mode="region"`` counts each connected region of
    equal values once per cell, ``mode="pixel"`` counts pixels.
    """
    years = sorted(year_map) if year_map is not None else None
    year_key = ["year"] if years is not None else []
    keep = ["city", *year_key, "x", "y", *bands]
    if years is not None:
        pixels = pixels.where(F.col("year").isin(years))
    group = ["city", "tx", "ty", "cell_id", *year_key]
    if mode == "region":
        pieces = []
        for band in bands:  # regions differ by band
            regions = raster_regions(pixels.select("city", *year_key, "x", "y", F.col(band).alias("val")), width, height)
            met = intersecting_pixels(cells, regions, side, width, height, years, keep_empty=True)
            once = met.groupBy(*group, "region_id").agg(F.max("val").alias(band))
            pieces.append(once.groupBy(*group).agg(*_aggregates({band: bands[band]}, statistics)))
        result = reduce(lambda a, b: a.join(b, group), pieces)
    elif all(pixels.schema[b].dataType.simpleString() == "double" for b in bands):
        result = _tile_statistics(cells, pixels.select(*keep), side, width, height, bands, statistics, years)
    else:
        met = intersecting_pixels(cells, pixels.select(*keep), side, width, height, years, keep_empty=True)
        result = met.groupBy(*group).agg(*_aggregates(bands, statistics))
    result = result.drop("tx", "ty")
    if years is not None:
        model_year = F.create_map(*[F.lit(v) for pair in year_map.items() for v in pair])
        names = [c for c in result.columns if c not in ("city", "cell_id", "year")]
        result = result.select("city", "cell_id", "year", model_year[F.col("year")].alias("year_model"), *names)
    return result


def _aggregates(bands: dict[str, str], statistics: list[str]) -> list[Column]:
    return [STATISTICS[s](band).alias(f"{s}_{suffix}") for band, suffix in bands.items() for s in statistics]


def _tile_statistics(
    cells: DataFrame, pixels: DataFrame, side: float, width: float, height: float,
    bands: dict[str, str], statistics: list[str], years: list[int] | None,
) -> DataFrame:
    """Statistics of the pixels of each cell ``(city, cell_id, [year], <statistics>)``, worked out inside the tiles.

    Cells and pixels are sorted by tile; a task holds an Arrow batch and one tile.  There all cells look up one of
    the pixel positions they may meet at a time, so no cell is copied to its positions and nothing more is sorted.
    """
    tile, b = _tile_size(side), g.apothem(side)
    reach_x, reach_y = width / 2 + b, height / 2 + side
    x, y, cx, cy = F.col("x"), F.col("y"), F.col("cx"), F.col("cy")
    year_key = [] if years is None else ["year"]
    placed_pixels = (
        pixels.withColumn("tx", F.explode(_steps(x - reach_x, x + reach_x, tile)))
        .withColumn("ty", F.explode(_steps(y - reach_y, y + reach_y, tile))))
    placed_cells = cells.where("cell_id IS NOT NULL AND cx IS NOT NULL AND cy IS NOT NULL").select(
        "city", "cell_id", "cx", "cy", _index(cx, tile).alias("tx"), _index(cy, tile).alias("ty"))
    key = ["city", "tx", "ty"]
    # a pixel's place travels in the columns of a cell's centre
    rows = placed_cells.unionByName(
        placed_pixels.withColumnsRenamed({"x": "cx", "y": "cy"}), allowMissingColumns=True)
    names = [f"{s}_{suffix}" for suffix in bands.values() for s in statistics]

    def run(batches):
        for table in whole_groups(batches, key):
            block, is_cell = np.cumsum(row_changes(table, key)) - 1, pc.is_valid(table.column("cell_id")).to_numpy()
            at_x, at_y = table.column("cx").to_numpy(), table.column("cy").to_numpy()
            found, spots = np.flatnonzero(~is_cell), np.flatnonzero(is_cell)
            if not len(spots):
                continue
            ids = pc.fill_null(table.column("cell_id").cast(pa.int64()), 0).to_numpy()[spots]
            order = np.lexsort((ids, block[spots]))
            spots, ids = spots[order], ids[order]
            own = block[spots]
            first = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (ids[1:] != ids[:-1])))
            pixel = _Pixels(block[found], at_x[found], at_y[found], width, height)
            values = [(pc.fill_null(c, 0.0).to_numpy()[found], pc.is_valid(c).to_numpy()[found]) for c in (table.column(b) for b in bands)]
            year = None if years is None else table.column("year").to_numpy(zero_copy_only=False)[found]
            for v in years or [None]:
                pick = slice(None) if v is None else year == v
                layer = pixel.layer(pick, [(a[pick], ok[pick]) for a, ok in values])
                sums = _cell_sums(layer, pixel, own, at_x[spots], at_y[spots], reach_x, reach_y, side, first)
                columns = [table.column("city").take(pa.array(spots[first])), pa.array(ids[first])]
                if v is not None:
                    columns.append(pa.array(np.full(len(first), v), rows_year))
                columns += [a for one in sums for a in _finished(one, statistics)]
                yield from pa.table(columns, names=["city", "cell_id", *year_key, *names]).to_batches()

    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    rows_year = None if years is None else pa.int64() if kind["year"] == "bigint" else pa.int32()
    fields = ", ".join([f"{c} {kind[c]}" for c in ("city", "cell_id", *year_key)] + [f"`{n}` double" for n in names])
    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, fields)


class _Pixels:
    """Positions of pixels as one number for block, row and column, and the pixels of a year by position."""

    def __init__(self, block: np.ndarray, x: np.ndarray, y: np.ndarray, width: float, height: float):
        self.x, self.y, self.width, self.height = x, y, width, height
        col, row = np.floor(x / width).astype(np.int64), np.floor(y / height).astype(np.int64)
        self.col0, self.row0 = (int(a.min()) if len(a) else 0 for a in (col, row))
        self.n_col, self.n_row = (int(a.max()) - low + 1 if len(a) else 0 for a, low in ((col, self.col0), (row, self.row0)))
        self.code = self.number(block, col, row)

    def number(self, block, col, row):
        return (block * self.n_row + (row - self.row0)) * self.n_col + (col - self.col0)

    def layer(self, pick, values):
        """Sorted numbers with the place and the values there; of pixels at one position the largest ones count."""
        order = np.argsort(self.code[pick], kind="stable")
        code = self.code[pick][order]
        starts = np.flatnonzero(np.diff(code, prepend=-1))
        if not len(starts):
            return code, code, code, [(a[:0], ok[:0]) for a, ok in values]
        largest = lambda a: np.maximum.reduceat(a[order], starts)
        return code[starts], largest(self.x[pick]), largest(self.y[pick]), [
            (largest(np.where(ok, a, -np.inf)), np.logical_or.reduceat(ok[order], starts)) for a, ok in values]


def _cell_sums(layer, pixel: _Pixels, block, cx, cy, reach_x: float, reach_y: float, side: float, first):
    """Of each band: number, sum, least, greatest, mean and squared deviations of the pixels met by each cell.

    Rows of one cell stand together, ``first`` is where each cell starts; repeated cells count their pixels again.
    """
    code, px, py, values = layer
    b, h, w2, h2 = g.apothem(side), g.SQRT3 / 2, pixel.width / 2, pixel.height / 2
    slant = b + w2 / 2 + h2 * h
    low_x, high_x, low_y, high_y = (np.floor(v).astype(np.int64) for v in (
        (cx - reach_x) / pixel.width, (cx + reach_x) / pixel.width, (cy - reach_y) / pixel.height, (cy + reach_y) / pixel.height))
    n = len(cx)
    sums = [[np.zeros(n), np.zeros(n), np.full(n, np.nan), np.full(n, -np.inf), np.zeros(n), np.zeros(n)] for _ in values]
    for dx in range(int((high_x - low_x).max()) + 1 if len(code) else 0):
        for dy in range(int((high_y - low_y).max()) + 1):
            col, row = low_x + dx, low_y + dy
            inside = ((col <= high_x) & (row <= high_y) & (col >= pixel.col0) & (col < pixel.col0 + pixel.n_col)
                      & (row >= pixel.row0) & (row < pixel.row0 + pixel.n_row))
            c = np.flatnonzero(inside)
            wanted = pixel.number(block[c], col[c], row[c])
            at = np.minimum(np.searchsorted(code, wanted), len(code) - 1)
            c, at = c[code[at] == wanted], at[code[at] == wanted]
            ex, ey = cx[c] - px[at], cy[c] - py[at]
            meets = ((np.abs(ex) <= b + w2) & (np.abs(ey) <= side + h2) & (np.abs(ex / 2 + ey * h) <= slant)
                     & (np.abs(ex / 2 - ey * h) <= slant))
            c, at = c[meets], at[meets]
            for (a, ok), one in zip(values, sums):
                k, v = c[ok[at]], a[at[ok[at]]]
                count, total, least, most, mean, spread = one
                count[k] += 1
                total[k] += v
                least[k] = np.fmin(least[k], v)
                most[k] = np.maximum(most[k], v)
                step = v - mean[k]  # the steps of Spark's own aggregate, in its order
                part = step / count[k]
                mean[k] += part
                spread[k] += step * (step - part)
    if len(first) == n:
        return sums
    own = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
    merged = []
    for count, total, least, most, mean, spread in sums:
        every = np.add.reduceat(count, first)
        middle = np.add.reduceat(total, first) / np.maximum(every, 1)
        off = np.where(count > 0, mean - middle[own], 0.0)
        merged.append([every, np.add.reduceat(total, first), np.fmin.reduceat(least, first), np.maximum.reduceat(most, first),
                       middle, np.add.reduceat(spread + count * off * off, first)])
    return merged


def _finished(one, statistics: list[str]) -> list[pa.Array]:
    """The statistics of one band; NULL where no pixel, or for the deviation only one, was met."""
    count, total, least, most, _mean, spread = one
    some = np.maximum(count, 1)
    done = {"min": least, "max": most, "mean": total / some, "sum": total, "stddev": np.sqrt(spread / np.maximum(count - 1, 1))}
    return [pa.array(done[s], mask=count < (2 if s == "stddev" else 1)) for s in statistics]


def raster_regions(pixels: DataFrame, width: float, height: float) -> DataFrame:
    """Label 4-connected regions of equal ``val``; ``region_id`` is the smallest pixel id in them."""
    by = [c for c in pixels.columns if c not in ("x", "y", "val")]
    nodes = pixels.select(
        "*", _index(F.col("y"), height).alias("row"), _index(F.col("x"), width).alias("col")
    )
    return connected_components(nodes, by, shape="square", same="val", label="region_id").drop("row", "col")


def slope(pixels: DataFrame, width: float, height: float) -> DataFrame:
    """Terrain slope in percent and degrees from a 3x3 neighbourhood (Horn 1981).

    A missing neighbour takes the value of the centre pixel.  Border pixels are copied to the next
    tile, then every pixel offers its value to its neighbours inside the task.
    """
    tile_x, tile_y = 256, 256
    ix, iy = _index(F.col("x"), width), _index(F.col("y"), height)
    placed = pixels.select("city", "x", "y", "val", ix.alias("ix"), iy.alias("iy"))
    tiled = (
        placed.withColumn("tx", F.explode(F.sequence(F.floor((F.col("ix") - 1) / tile_x), F.floor((F.col("ix") + 1) / tile_x))))
        .withColumn("ty", F.explode(F.sequence(F.floor((F.col("iy") - 1) / tile_y), F.floor((F.col("iy") + 1) / tile_y))))
        .repartition("city", "tx", "ty")
    )
    offers = tiled.select(
        "city", "tx", "ty", "x", "y", "val", "ix", "iy",
        F.explode(F.array(*[
            F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)
        ])).alias("d"),
    ).select(
        "city", "tx", "ty", (F.col("ix") - F.col("d.dx")).alias("ix"), (F.col("iy") - F.col("d.dy")).alias("iy"),
        "d.dx", "d.dy", "x", "y", "val",
    ).where((F.floor(F.col("ix") / tile_x) == F.col("tx")) & (F.floor(F.col("iy") / tile_y) == F.col("ty")))

    def at(dx: int, dy: int, column: str = "val") -> Column:
        return F.max(F.when((F.col("dx") == dx) & (F.col("dy") == dy), F.col(column)))

    names = {(dx, dy): f"v{dx + 1}{dy + 1}" for dx in (-1, 0, 1) for dy in (-1, 0, 1)}
    around = (
        offers.groupBy("city", "tx", "ty", "ix", "iy")
        .agg(*[at(*k).alias(n) for k, n in names.items()], at(0, 0, "x").alias("x"), at(0, 0, "y").alias("y"))
        .where(F.col("v11").isNotNull())
    )

    def v(dx: int, dy: int) -> Column:
        return F.coalesce(F.col(names[dx, dy]), F.col("v11"))

    p = (v(1, -1) + 2 * v(1, 0) + v(1, 1) - v(-1, -1) - 2 * v(-1, 0) - v(-1, 1)) / (8 * width)
    q = (v(-1, 1) + 2 * v(0, 1) + v(1, 1) - v(-1, -1) - 2 * v(0, -1) - v(1, -1)) / (8 * height)
    rise = F.sqrt(p * p + q * q)
    return around.select("city", "x", "y", (100 * rise).alias("slope_pct"), F.degrees(F.atan(rise)).alias("slope_degrees"))


def clip_raster(pixels: DataFrame, areas: DataFrame, strip: float) -> DataFrame:
    """Pixels whose centre is inside the area ``(city, ring)``; pixels outside are absent."""
    return inside(pixels, areas, ["city"], "x", "y", strip).where("winding <> 0").drop("winding")


def resample_nearest(targets: DataFrame, source: DataFrame, lon0: float, lat0: float, step: float) -> DataFrame:
    """Value of the source pixel under each target pixel; no row if there is none.

    ``targets`` has the target centre in source coordinates, ``lon, lat``; source pixels are
    ``(sx, sy, val)`` counted from (lon0, lat0) in steps of ``step``.
    """
    nowhere = F.lit(-(1 << 60))  # keeps the key free of NULLs, so no NULL test repeats the projection
    looked_up = targets.withColumns({
        "sx": F.coalesce(F.floor((F.col("lon") - lon0) / step), nowhere),
        "sy": F.coalesce(F.floor((F.col("lat") - lat0) / step), nowhere)})
    keys = [c for c in ("city", "year", "sx", "sy") if c in source.columns and c in looked_up.columns]
    return looked_up.join(source, keys)
