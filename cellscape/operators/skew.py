"""Joins and numbering that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscape.session import materialize

HOT_KEYS = 10_000


def join_counted(big: DataFrame, small: DataFrame, on: list[str], count: str, hot_rows: int = 1_000_000) -> DataFrame:
    """Inner join of ``big`` with one row per key in ``small``, whose column ``count`` says how many
    rows of ``big`` have the key.

    A key above ``max(hot_rows, total / 10000)`` rows is hot: its rows get a salt and its ``small``
    row is copied once per salt, so no task receives more than the limit of one key.  The table of
    hot keys is broadcast; it has at most 10,000 rows, because their counts add up to no more than
    the total.
    """
    total = small.agg(F.sum(count)).scalar()
    limit = F.greatest(F.lit(float(hot_rows)), total / HOT_KEYS)
    sized = small.withColumn("_salts", F.ceil(F.col(count) / limit))
    hot = sized.where("_salts > 1").select(*on, "_salts")
    spread = F.pmod(F.xxhash64(*[c for c in big.columns if c not in on]), F.coalesce("_salts", F.lit(1)))
    salted = big.join(F.broadcast(hot), on, "left").withColumn("_salt", spread).drop("_salts")
    copies = sized.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest("_salts", F.lit(1)) - 1)))
    return salted.join(copies.drop("_salts"), [*on, "_salt"]).drop("_salt")


def join_dimension(big: DataFrame, dimension: DataFrame, on: list[str], hot_rows: int = 1_000_000) -> DataFrame:
    """Inner join with a table of one row per key, when ``big`` may have most rows on one key."""
    counts = big.groupBy(*on).agg(F.count("*").alias("_rows"))
    # the counts are read three times, so they are stored
    sized = materialize(counts.join(dimension, on), "dimension-counts")
    return join_counted(big, sized, on, "_rows", hot_rows).drop("_rows")


WHOLE_ROWS = 100_000


def rank_within(
    df: DataFrame, by: list[str], coarse: list[Column], order: list[Column], name: str, whole_rows: int = WHOLE_ROWS,
) -> DataFrame:
    """Add ``name``, the 1-based position of each row in its group, without sorting a large group in one task.

    ``coarse`` are one or more keys, from wide to narrow, that together do not decrease along
    ``order``.  Rows are numbered inside the narrowest key and shifted by the rows before it; the
    shifts are added up level by level from counts, so that each sort stays small.  Where no group has more
    than ``whole_rows`` rows, each is sorted once.  Rows without a group or a coarse key are left out.
    """
    if by:
        largest = df.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        if (largest or 0) <= whole_rows:
            known = [F.col(c) for c in by] + coarse
            whole = Window.partitionBy(*by).orderBy(*coarse, *order)
            ranked = df.withColumn(name, F.row_number().over(whole).cast("long"))
            return ranked.where(reduce(and_, [c.isNotNull() for c in known]))
    keys = [f"_c{i}" for i in range(len(coarse))]
    keyed = df.withColumns(dict(zip(keys, coarse)))
    counts = keyed.groupBy(*by, *keys).agg(F.count("*").alias("_n"))
    offsets = counts.withColumn("_offset", F.lit(0).cast("long"))
    for level in range(len(keys)):
        upper, key = [*by, *keys[:level]], keys[level]
        before = Window.partitionBy(*upper).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        shift = counts.groupBy(*upper, key).agg(F.sum("_n").alias("_m")).select(
            *upper, key, F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_shift"))
        offsets = offsets.join(shift, [*upper, key]).withColumn("_offset", F.col("_offset") + F.col("_shift")).drop("_shift")
    inner = Window.partitionBy(*by, *keys).orderBy(*order)
    return (
        keyed.withColumn("_inner", F.row_number().over(inner))
        .join(offsets.drop("_n"), [*by, *keys])
        .withColumn(name, F.col("_offset") + F.col("_inner"))
        .drop("_inner", "_offset", *keys)
    )


BAND_ROWS = 64


def join_city_table(cells: DataFrame, table: DataFrame, on: tuple[str, ...] = ("city",)) -> DataFrame:
    """Inner join of cells with a small table keyed by city, spread over bands of grid rows.

    The rows of ``table`` are copied once per band of 64 grid rows, so the number of copies follows
    the size of the city and no single task gets a whole city.
    """
    band = F.floor(F.shiftright("cell_id", 20) / BAND_ROWS)
    bands = cells.select(*on, band.alias("_band")).distinct().join(table, list(on))
    return cells.withColumn("_band", band).join(bands, [*on, "_band"]).drop("_band")


def running_sums(df: DataFrame, by: list[str], order: str, columns: list[str], name: str) -> DataFrame:
    """Replace integer ``columns`` by their running sums over rows of the same ``by``, along ``order``.

    Rows are sorted by ranges over all tasks, so a group may span many of them.  Each task adds up its own
    range; a group in several ranges takes over the sums of the ranges before.  A range has at most two such
    groups, its first and its last, so the table of what is taken over is broadcast.
    """
    def add_up(batches):
        part, last, carry = TaskContext.get().partitionId(), None, [0] * len(columns)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c) for c in by]
            new = np.zeros(batch.num_rows, dtype=bool)
            for k in keys:
                new[1:] |= pc.fill_null(pc.not_equal(k[1:], k[:-1]), True).to_numpy(zero_copy_only=False)
            new[0] = [k[0] for k in keys] != last
            starts, group = np.flatnonzero(new), np.cumsum(new)
            table = pa.Table.from_batches([batch])
            for j, c in enumerate(columns):
                x = batch.column(c).to_numpy()
                total = np.cumsum(x)
                total -= np.concatenate([[-carry[j]], total[starts] - x[starts]])[group]
                carry[j] = int(total[-1])
                table = table.append_column(f"_run_{c}", pa.array(total))
            last = [k[batch.num_rows - 1] for k in keys]
            yield from table.append_column("_part", pa.array(np.full(batch.num_rows, part, np.int32))).to_batches()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    runs = "".join(f", `_run_{c}` long" for c in columns)
    ranged = df.repartitionByRange(*by, order).sortWithinPartitions(*by, order)
    rows = materialize(ranged.mapInArrow(add_up, f"{fields}{runs}, _part int"), name)
    key = F.struct(*by)
    ends = rows.groupBy("_part").agg(F.array_distinct(F.array(F.min(key), F.max(key))).alias("ends"))
    wide = ends.select(F.explode("ends").alias("k")).groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k.*")
    sums = rows.join(F.broadcast(wide), by).groupBy(*by, "_part").agg(*[F.sum(c).alias(c) for c in columns])
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    taken = sums.select(*by, "_part", *[F.sum(c).over(before).alias(f"_carry_{c}") for c in columns])
    out = rows.join(F.broadcast(taken), [*by, "_part"], "left")
    return out.withColumns({c: F.col(f"_run_{c}") + F.coalesce(f"_carry_{c}", F.lit(0)) for c in columns}).select(df.columns)
