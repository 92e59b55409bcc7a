"""Connected components on hexagon and square lattices.

1. Every tile of 64 x 64 lattice positions is labelled on its own, inside one task; the size of a
   group is bounded by the tile, not by the data.
2. Only links that leave a tile become edges.  They are contracted by alternating large-star and
   small-star rounds (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014).
3. Tile labels are mapped to component labels.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscape.operators.skew import join_counted
from cellscape.session import materialize

TILE = 64
ID_BITS = 20


def _forward(row: Column, col: Column, shape: str) -> Column:
    """Half of the neighbours; the other half are found from the other end."""
    if shape == "hexagon":
        pairs = [(row, col + 1), (row + 1, col + F.pmod(row, F.lit(2)) - 1), (row + 1, col + F.pmod(row, F.lit(2)))]
    else:
        pairs = [(row, col + 1), (row + 1, col)]
    return F.array(*[F.struct(r.alias("row"), c.alias("col")) for r, c in pairs])


def _block_links(block: np.ndarray, row: np.ndarray, col: np.ndarray, odd: np.ndarray, value: np.ndarray | None, shape: str):
    """Links between positions of the same block, as two index arrays.

    Positions are sorted by block, row and column, counted from 0 inside their block; of equal ones the last is met.
    """
    line = TILE + 2
    place = (block * line + row) * line + col + 1
    if shape == "hexagon":
        steps = [1, line + odd - 1, line + odd]
    else:
        steps = [1, line]
    a, b = [], []
    for step in steps:
        wanted = place + step
        found = np.searchsorted(place, wanted, side="right") - 1
        linked = np.flatnonzero(place[found] == wanted)
        a.append(linked)
        b.append(found[linked])
    a, b = np.concatenate(a), np.concatenate(b)
    if value is not None:
        equal = value[a] == value[b]
        a, b = a[equal], b[equal]
    return a, b


def _smallest_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if np.array_equal(label, before):
            return label


def row_changes(table: pa.Table, columns: list[str]) -> np.ndarray:
    """Where a row differs from the row before in some column; nulls are equal to each other."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[0] = True
    for c in columns:
        x = table.column(c).combine_chunks()
        differs = pc.fill_null(pc.not_equal(x[1:], x[:-1]), False).to_numpy(zero_copy_only=False)
        null = pc.is_null(x).to_numpy(zero_copy_only=False)
        new[1:] |= differs | (null[1:] != null[:-1])
    return new


def whole_groups(batches, key: list[str]):
    """Tables of whole groups from batches sorted by ``key``; no more is held than a batch and one group."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        last = int(np.flatnonzero(row_changes(table, key))[-1])
        if last:
            yield table.slice(0, last)
        held = table.slice(last)
    if held is not None:
        yield held


def _label_run(table: pa.Table, key: list[str], shape: str, label: str, same: str | None) -> pa.Table:
    """Label whole blocks; ``table`` is sorted by block."""
    nowhere = np.iinfo(np.int64).min  # the position of rows without one
    row, col = (pc.fill_null(table.column(c).cast(pa.int64()), nowhere).to_numpy() for c in ("row", "col"))
    new = row_changes(table, key)
    block, starts = np.cumsum(new) - 1, np.flatnonzero(new)
    r = row - np.minimum.reduceat(row, starts)[block]
    c = col - np.minimum.reduceat(col, starts)[block]
    order = np.lexsort((c, r, block))
    value = table.column(same).to_numpy()[order] if same else None
    a, b = _block_links(block[order], r[order], c[order], row[order] % 2, value, shape)
    smallest = _smallest_reachable(len(row), a, b)
    root = np.empty(len(row), dtype=np.int64)
    root[order] = ((row[order] << ID_BITS) + col[order])[smallest]
    return table.append_column(label, pa.array(root, pa.int64()))


def label_blocks(
    nodes: DataFrame, by: list[str], shape: str, label: str, same: str | None = None
) -> DataFrame:
    """Label the pieces that are connected inside each block of 64 x 64 positions.

    Sorted blocks pass through a task, which labels all that an Arrow batch completes at once; it holds no more
    than a batch and one block.
    """
    key = [*by, "block_row", "block_col"]
    blocks = nodes.withColumn("block_row", F.floor(F.col("row") / TILE)).withColumn(
        "block_col", F.floor(F.col("col") / TILE))

    def run(batches):
        for table in whole_groups(batches, key):
            yield from _label_run(table, key, shape, label, same).to_batches()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.schema.fields)
    return blocks.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, f"{fields}, `{label}` long")


def connected_components(
    nodes: DataFrame, by: list[str], shape: str, label: str, same: str | None = None
) -> DataFrame:
    """Add ``label``, the smallest position id ``row * 2**20 + col`` of the node's component.

    ``nodes`` has one row per ``(by, row, col)``.  With ``same``, neighbours link only when that
    column is equal.
    """
    labelled = materialize(
        label_blocks(nodes, by, shape, "tile_label", same)
        .withColumnsRenamed({"block_row": "trow", "block_col": "tcol"}),
        "tile-labels",
    )

    # links that leave a tile, seen only by nodes on a tile border
    edge = TILE - 1
    border = labelled.where(
        F.pmod("row", F.lit(TILE)).isin(0, edge) | F.pmod("col", F.lit(TILE)).isin(0, edge)
    )
    value = [F.col(same).alias("_same")] if same else []
    match = ["_same"] if same else []
    out = (
        border.select(*by, *value, "trow", "tcol", F.col("tile_label").alias("u"),
                      F.explode(_forward(F.col("row"), F.col("col"), shape)).alias("n"))
        .where((F.floor(F.col("n.row") / TILE) != F.col("trow")) | (F.floor(F.col("n.col") / TILE) != F.col("tcol")))
        .select(*by, *match, "u", F.col("n.row").alias("row"), F.col("n.col").alias("col"))
    )
    ends = border.select(*by, *value, "row", "col", F.col("tile_label").alias("v"))
    edges = materialize(
        out.join(ends, [*by, *match, "row", "col"])
        .select(*by, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "tile-edges",
    )
    plain = labelled.drop("trow", "tcol")
    if edges.isEmpty():
        return plain.withColumnRenamed("tile_label", label)
    roots = contract(edges, by).withColumnRenamed("u", "tile_label").withColumnRenamed("v", label)
    return (
        plain.join(roots, [*by, "tile_label"], "left")
        .withColumn(label, F.coalesce(F.col(label), F.col("tile_label")))
        .drop("tile_label")
        .select(*nodes.columns, label)
    )


def contract(edges: DataFrame, by: list[str], hot_rows: int = 100_000) -> DataFrame:
    """Turn edges ``(by, u, v)`` with u > v into stars ``(by, u, root)``, one row per non-root node."""

    def stars(pairs: DataFrame, keep_larger: bool) -> DataFrame:
        # pairs (u, v): v a neighbour of u.  Send neighbours of u to the smallest of them.
        lowest = materialize(
            pairs.groupBy(*by, "u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("degree")),
            "star-minima",
        )
        joined = join_counted(pairs, lowest, [*by, "u"], "degree", hot_rows)
        if keep_larger:
            moved = joined.where("v > u").select(*by, F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            moved = joined.where("v <> m").select(*by, F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                lowest.select(*by, "u", F.col("m").alias("v"))
            )
        return moved.where("u <> v").distinct()

    def signature(e: DataFrame):
        return e.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64(*by, "u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()

    current = signature(edges)
    while True:
        both = edges.unionByName(edges.select(*by, F.col("v").alias("u"), F.col("u").alias("v")))
        large = stars(both, keep_larger=True)
        edges = materialize(stars(large, keep_larger=False), "stars")
        latest = signature(edges)
        if latest == current:
            return edges
        current = latest
