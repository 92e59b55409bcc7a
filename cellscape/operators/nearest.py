"""Exact nearest distance from every cell centre to a set of targets, without a cross join.

Cells and targets are put into square tiles.  A descent over ever finer tiles keeps, for every cell
tile, only the target tiles that can hold its nearest target: those no farther than the closest
target known to exist.  Only the surviving tile pairs are expanded to cells and targets, in Arrow batches, and the
minimum is taken in the same tasks.  A target lies in one tile only; tile summaries carry the true
box around their targets, so long lines need no copies.

Tiles follow the targets: one with more than ``LEAF`` targets is cut into finer ones, and so are the
cell tiles that still need it, until no pair holds a crowded tile.  A city whose targets lie in one
tile is searched like any other.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscape.functions import geometry as g
from cellscape.operators.components import row_changes, whole_groups
from cellscape.operators.skew import join_counted
from cellscape.session import materialize

FAN = 4  # a coarse tile is 4 x 4 finer ones
LEAF = 1024  # a tile with more targets is cut
DEEPEST = 6  # times a tile is cut; what still lies together then is dealt into parts by hash
BLOCK = 8  # cell tiles across a block that is searched in one task
AT_ONCE = 1 << 20  # distances worked out at a time
NO_CELL = -(1 << 62)
BOX = ["x0", "y0", "x1b", "y1b"]
CELL_BOX = ["ax0", "ay0", "ax1", "ay1"]
TILE_ID = ["tx", "ty", "part"]


def _sample() -> list[Column]:
    """One point of some target: both parts are taken from the same row."""
    return [F.first("sx").alias("sx"), F.first("sy").alias("sy")]


def _combine(tiles: DataFrame, by: list[str]) -> DataFrame:
    coarse = [F.floor(F.col("tx") / FAN).alias("tx"), F.floor(F.col("ty") / FAN).alias("ty")]
    return tiles.groupBy(*by, *coarse).agg(
        F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1b").alias("x1b"), F.max("y1b").alias("y1b"),
        *_sample(),
    )


def _place(targets: DataFrame, tile: float) -> DataFrame:
    return targets.withColumns({
        "tx": F.floor((F.col("lx") + F.col("hx")) / 2 / tile), "ty": F.floor((F.col("ly") + F.col("hy")) / 2 / tile)})


def _summary(placed: DataFrame, key: list[str]) -> DataFrame:
    """One row per tile: the box around its targets, a point of one, and their number ``n``."""
    return placed.groupBy(*key, *TILE_ID).agg(
        F.min("lx").alias("x0"), F.min("ly").alias("y0"), F.max("hx").alias("x1b"), F.max("hy").alias("y1b"),
        *_sample(), F.count("*").alias("n"),
    )


def _cell_tiles(cells: DataFrame, tile: float) -> DataFrame:
    return (
        cells.groupBy("city", F.floor(F.col("cx") / tile).alias("ax"), F.floor(F.col("cy") / tile).alias("ay"))
        .agg(F.min("cx").alias("ax0"), F.min("cy").alias("ay0"), F.max("cx").alias("ax1"), F.max("cy").alias("ay1"))
    )


def _cut(placed: DataFrame, tiles: DataFrame, key: list[str], columns: list[str], tile: float) -> tuple[DataFrame, list[DataFrame]]:
    """Targets with the depth ``td`` and tile they end in, and the tiles of each depth.

    Each round moves the targets of crowded tiles one depth down; the rounds end with the last crowded tile.
    """
    ends, ladder, rest = [], [tiles], placed
    for depth in range(DEEPEST + 1):
        sized = materialize(
            join_counted(rest, tiles.select(*key, *TILE_ID, "n"), [*key, *TILE_ID], "n"), f"nearest-depth-{depth}")
        ends.append(sized.where(F.col("n") <= LEAF).drop("n").withColumn("td", F.lit(depth)))
        rest = sized.where(F.col("n") > LEAF)
        if depth == DEEPEST:
            # targets with one middle: any part may hold the nearest, and all are searched
            ends.append(rest.drop("n").withColumn("td", F.lit(depth)))
            break
        crowded = rest.drop("n")
        if crowded.isEmpty():
            break
        rest = _place(crowded, tile / FAN ** (depth + 1))
        if depth + 1 == DEEPEST:
            counts = rest.groupBy(*key, *TILE_ID).agg(F.count("*").alias("n"))
            dealt = F.pmod(F.xxhash64(*columns), F.ceil(F.col("n") / LEAF))
            rest = materialize(
                join_counted(rest, counts, [*key, *TILE_ID], "n").withColumn("part", dealt).drop("n"), "nearest-parts")
        tiles = materialize(_summary(rest, key), "nearest-tiles")
        ladder.append(tiles)
    out = ends[0]
    for e in ends[1:]:
        out = out.unionByName(e)
    return out, ladder


def nearest_distance(
    cells: DataFrame, targets: DataFrame, by: list[str], tile: float,
    distance: Callable[..., np.ndarray], columns: list[str],
    name: str = "distance",
) -> DataFrame:
    """``(city, *by, cell_id, name)`` with the smallest distance in metres.

    ``targets`` has ``city``, ``by`` columns, the ``columns`` that ``distance(cx, cy, *columns)`` gets as arrays, a box
    ``lx, ly, hx, hy`` and one point ``sx, sy`` of the target.  Groups without targets give no rows.
    """
    key = ["city", *by]
    placed = _place(targets.select(*key, *columns, "lx", "ly", "hx", "hy", "sx", "sy"), tile)
    placed = placed.dropDuplicates([*key, *columns]).withColumn("part", F.lit(0).cast("long"))
    placed = materialize(placed, "nearest-targets")

    finest = materialize(_summary(placed, key), "nearest-tiles")
    span = F.greatest(F.max("x1b") - F.min("x0"), F.max("y1b") - F.min("y0"))
    extent, most = finest.groupBy("city").agg(span.alias("s"), F.max("n").alias("n")).agg(F.max("s"), F.max("n")).first()
    # the coarsest tiles of a group are five by five at most; more levels would sort more pairs than they drop
    levels = max(0, math.ceil(math.log(max((extent or tile) / tile, 1.0), FAN)) - 1)
    pyramid = [finest]
    for _ in range(levels):
        pyramid.append(_combine(pyramid[-1], key))

    # the coarsest tiles of a city are copied to each band of its cell tiles, so a large city spreads
    cell_tiles = _cell_tiles(cells, tile)
    band = F.floor(F.col("ay") / 16).alias("band")
    bands = cell_tiles.select("city", band).distinct()
    # they are few, so a cell tile chooses among them in its own row; nothing is sorted for it
    entry = F.struct(*[c for c in pyramid[-1].columns if c not in key])
    tops = bands.join(pyramid[-1], "city").groupBy("city", "band", *by).agg(F.collect_list(entry).alias("tiles"))
    box = [F.col(c) for c in CELL_BOX]
    pairs = cell_tiles.withColumn("band", band).join(tops, ["city", "band"]).drop("band").withColumn(
        "bound", F.array_min(F.transform("tiles", lambda t: g.box_reach(*box, t["sx"], t["sy"]))))
    near = F.filter("tiles", lambda t: g.box_gap(*box, *[t[c] for c in BOX]) <= F.col("bound") + 1e-6)
    pairs = pairs.select(*key, "ax", "ay", *CELL_BOX, F.inline(near))
    for level in reversed(range(levels)):
        finer = pyramid[level].withColumns({"px": F.floor(F.col("tx") / FAN), "py": F.floor(F.col("ty") / FAN)})
        parents = pairs.select(*key, "ax", "ay", *CELL_BOX, F.col("tx").alias("px"), F.col("ty").alias("py"))
        pairs = _prune(parents.join(finer, [*key, "px", "py"]).drop("px", "py"), key)
    pairs = pairs.withColumn("td", F.lit(0))

    if (most or 0) > LEAF:
        placed, ladder = _cut(placed, finest, key, columns, tile)
        settled = _descend(pairs, ladder, cells, key, tile)
    else:
        placed, settled = placed.withColumn("td", F.lit(0)), [pairs]

    out = None
    for depth, kept in enumerate(settled):
        part = _search(cells, placed, kept, key, tile / FAN**depth, distance, columns, name)
        out = part if out is None else out.unionByName(part)
    return out


def _search(
    cells: DataFrame, placed: DataFrame, kept: DataFrame, key: list[str], size: float,
    distance: Callable[..., np.ndarray], columns: list[str], name: str,
) -> DataFrame:
    """Smallest distances over the kept pairs of a cell tile of ``size`` and a target tile.

    Cells, targets and pairs of 8 x 8 cell tiles meet in one task, so a target is copied once for each such block that
    needs it, not for each cell tile.  A task holds an Arrow batch, one block and at most ``AT_ONCE`` distances.
    """
    by, block = key[1:], [F.floor(F.col("ax") / BLOCK).alias("bx"), F.floor(F.col("ay") / BLOCK).alias("by_")]
    pairs = materialize(kept.select(*key, "ax", "ay", "td", *TILE_ID), "nearest-kept").select("*", *block)
    home, place = ["city", "bx", "by_"], [*by, "td", *TILE_ID]
    targets = pairs.select(*home, *place).distinct().join(placed.select(*key, "td", *TILE_ID, *columns), [*key, "td", *TILE_ID])
    centres = cells.select(
        "city", "cell_id", "cx", "cy", F.floor(F.col("cx") / size).alias("ax"), F.floor(F.col("cy") / size).alias("ay")).select("*", *block)
    rows = (
        centres.withColumn("_row", F.lit(0))
        .unionByName(targets.withColumn("_row", F.lit(1)), allowMissingColumns=True)
        .unionByName(pairs.withColumn("_row", F.lit(2)), allowMissingColumns=True))

    def run(batches):
        for table in whole_groups(batches, home):
            group = np.cumsum(row_changes(table, home)) - 1
            kind = table.column("_row").to_numpy()
            cell, target, pair = (np.flatnonzero(kind == k) for k in (0, 1, 2))
            if not len(cell) or not len(target) or not len(pair):
                continue
            among = np.concatenate([cell, pair])
            own = _numbered(table, among, group[among], ["ax", "ay"])
            own_cell, own_pair = own[:len(cell)], own[len(cell):]
            among = np.concatenate([target, pair])
            spot = _numbered(table, among, group[among], place)
            spot_target, spot_pair = spot[:len(target)], spot[len(target):]
            unit = _numbered(table, pair, own_pair, by)
            ids = pc.fill_null(table.column("cell_id"), NO_CELL).to_numpy()[cell]
            order = np.lexsort((ids, own_cell))
            cell, own_cell, ids = cell[order], own_cell[order], ids[order]
            order = np.argsort(spot_target, kind="stable")
            target, spot_target = target[order], spot_target[order]
            order = np.argsort(unit, kind="stable")
            pair, own_pair, spot_pair, unit = pair[order], own_pair[order], spot_pair[order], unit[order]
            c0, t0 = np.searchsorted(own_cell, own_pair), np.searchsorted(spot_target, spot_pair)
            n_cells = np.searchsorted(own_cell, own_pair, side="right") - c0
            n_targets = np.searchsorted(spot_target, spot_pair, side="right") - t0
            # the cells of a unit, that is of a cell tile and its target group, have one stretch of results
            first = np.flatnonzero(np.diff(unit, prepend=-1))
            ends = np.cumsum(n_cells[first])
            result, slot = np.full(ends[-1], np.nan), (ends - n_cells[first])[unit]
            cx, cy = (table.column(c).to_numpy()[cell] for c in ("cx", "cy"))
            shape = [table.column(c).to_numpy()[target] for c in columns]
            work = np.cumsum(n_cells * n_targets)
            for some in np.split(np.arange(len(pair)), np.flatnonzero(np.diff(work // AT_ONCE)) + 1):
                some = some[(n_cells[some] > 0) & (n_targets[some] > 0)]
                if not len(some):
                    continue
                times = np.repeat(n_targets[some], n_cells[some])  # a row for each pair and cell
                k = np.arange(len(times)) - np.repeat(np.cumsum(n_cells[some]) - n_cells[some], n_cells[some])
                starts = np.cumsum(times) - times
                c = np.repeat(np.repeat(c0[some], n_cells[some]) + k, times)
                t = np.repeat(np.repeat(t0[some], n_cells[some]) - starts, times) + np.arange(starts[-1] + times[-1])
                least = np.fmin.reduceat(distance(cx[c], cy[c], *[v[t] for v in shape]), starts)
                np.fmin.at(result, np.repeat(slot[some], n_cells[some]) + k, least)
            units = np.repeat(np.arange(len(first)), n_cells[first])
            at = np.arange(len(result)) - np.repeat(ends - n_cells[first], n_cells[first]) + np.repeat(c0[first], n_cells[first])
            if not len(at):
                continue
            # repeated cells are one
            new = np.flatnonzero(np.append(True, (units[1:] != units[:-1]) | (ids[at[1:]] != ids[at[:-1]])))
            least, at, of = np.fmin.reduceat(result, new), at[new], pair[first][units[new]]
            made = [table.column(c).take(pa.array(of)) for c in key]
            made += [table.column("cell_id").take(pa.array(cell[at])), pa.array(least, mask=np.isnan(least))]
            yield from pa.table(made, names=[*key, "cell_id", name]).to_batches()

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    fields = ", ".join([f"`{c}` {kinds[c]}" for c in (*key, "cell_id")] + [f"`{name}` double"])
    return rows.repartition(*home).sortWithinPartitions(*home).mapInArrow(run, fields)


def _numbered(table: pa.Table, rows: np.ndarray, group: np.ndarray, columns: list[str]) -> np.ndarray:
    """Equal numbers from 0 for ``rows`` that are equal in ``group`` and the columns, in the order of the group."""
    number = np.unique(group, return_inverse=True)[1]
    for c in columns:
        values = table.column(c).take(pa.array(rows)).combine_chunks()
        values = pc.fill_null(pc.dictionary_encode(values).indices, -1).to_numpy().astype(np.int64) + 1
        number = np.unique(number * (int(values.max(initial=0)) + 1) + values, return_inverse=True)[1]
    return number


def _descend(pairs: DataFrame, ladder: list[DataFrame], cells: DataFrame, key: list[str], tile: float) -> list[DataFrame]:
    """Pairs without a crowded tile, one table for each depth of the cell tile.

    A cell tile that still meets a crowded tile is cut together with it; its other target tiles stay with
    the smaller cell tiles, so that a bound is always taken over all that is left for them.
    """
    settled = []
    for depth, tiles in enumerate(ladder[1:]):
        crowded = (F.col("td") == depth) & (F.col("n") > LEAF)
        busy = F.max(crowded).over(Window.partitionBy(*key, "ax", "ay"))
        pairs = materialize(pairs.withColumns({"crowded": crowded, "busy": busy}), f"nearest-pairs-{depth}")
        settled.append(pairs.where(~F.col("busy")))
        smaller = _cell_tiles(cells, tile / FAN ** (depth + 1)).withColumns(
            {"px": F.floor(F.col("ax") / FAN), "py": F.floor(F.col("ay") / FAN)})
        open_ = pairs.where("busy").drop(*CELL_BOX, "busy").withColumnsRenamed({"ax": "px", "ay": "py"})
        met = open_.join(smaller, ["city", "px", "py"]).drop("px", "py")
        cut = met.where("crowded").select(
            *key, "ax", "ay", *CELL_BOX, F.col("tx").alias("px"), F.col("ty").alias("py"))
        inner = tiles.withColumns({"px": F.floor(F.col("tx") / FAN), "py": F.floor(F.col("ty") / FAN)})
        finer = cut.join(inner, [*key, "px", "py"]).drop("px", "py").withColumn("td", F.lit(depth + 1))
        pairs = _prune(finer.unionByName(met.where(~F.col("crowded")).drop("crowded")), key)
    return [*settled, pairs]


def _prune(pairs: DataFrame, key: list[str]) -> DataFrame:
    """Drop target tiles farther from a cell tile than some target is sure to be."""
    cell_box = [F.col(c) for c in CELL_BOX]
    bound = Window.partitionBy(*key, "ax", "ay")
    return (
        pairs.withColumn("near", g.box_gap(*cell_box, *[F.col(c) for c in BOX]))
        .withColumn("sure", g.box_reach(*cell_box, F.col("sx"), F.col("sy")))
        .withColumn("bound", F.min("sure").over(bound))
        .where(F.col("near") <= F.col("bound") + 1e-6)
        .drop("near", "sure", "bound")
    )


def point_targets(points: DataFrame, by: list[str]) -> DataFrame:
    x, y = F.col("x"), F.col("y")
    return points.select(
        "city", *by, "x", "y", x.alias("lx"), y.alias("ly"), x.alias("hx"), y.alias("hy"), x.alias("sx"), y.alias("sy")
    )


def segment_targets(segments: DataFrame, by: list[str]) -> DataFrame:
    return segments.select(
        "city", *by, "x1", "y1", "x2", "y2",
        F.least("x1", "x2").alias("lx"), F.least("y1", "y2").alias("ly"),
        F.greatest("x1", "x2").alias("hx"), F.greatest("y1", "y2").alias("hy"),
        F.col("x1").alias("sx"), F.col("y1").alias("sy"),
    )


def hexagon_targets(cells: DataFrame, by: list[str], side: float) -> DataFrame:
    b, x, y = g.apothem(side), F.col("cx"), F.col("cy")
    return cells.select(
        "city", *by, x.alias("hexx"), y.alias("hexy"),
        (x - b).alias("lx"), (y - side).alias("ly"), (x + b).alias("hx"), (y + side).alias("hy"),
        x.alias("sx"), y.alias("sy"),
    )


def _to_segment(px, py, x1, y1, x2, y2) -> np.ndarray:
    """``geometry.segment_distance`` of arrays."""
    dx, dy = x2 - x1, y2 - y1
    length = dx * dx + dy * dy
    t = np.clip(((px - x1) * dx + (py - y1) * dy) / np.where(length > 0, length, 1.0), 0.0, 1.0)
    qx, qy = x1 + t * dx, y1 + t * dy
    return np.sqrt((qx - px) * (qx - px) + (qy - py) * (qy - py))


def _to_hexagon(px, py, cx, cy, side: float) -> np.ndarray:
    """``geometry.hexagon_distance`` of arrays."""
    b = g.apothem(side)
    x, y = np.abs(px - cx), np.abs(py - cy)
    outside = np.maximum(x - b, x / 2 + y * (g.SQRT3 / 2) - b)
    least = np.minimum(_to_segment(x, y, 0.0, float(side), b, side / 2), _to_segment(x, y, b, side / 2, b, -side / 2))
    return np.where(outside <= 0, 0.0, least)


def nearest_segment(cells: DataFrame, segments: DataFrame, tile: float, by: list[str] | None = None) -> DataFrame:
    cols = ["x1", "y1", "x2", "y2"]
    return nearest_distance(
        cells, segment_targets(segments, by or []), by or [], tile,
        _to_segment, cols)


def nearest_point(cells: DataFrame, points: DataFrame, tile: float, by: list[str] | None = None) -> DataFrame:
    return nearest_distance(
        cells, point_targets(points, by or []), by or [], tile,
        lambda cx, cy, x, y: np.sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)), ["x", "y"])


def nearest_hexagon(cells: DataFrame, members: DataFrame, side: float, tile: float, by: list[str]) -> DataFrame:
    return nearest_distance(
        cells, hexagon_targets(members, by, side), by, tile,
        lambda cx, cy, x, y: _to_hexagon(cx, cy, x, y, side), ["hexx", "hexy"])
