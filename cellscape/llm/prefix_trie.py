"""Trie of shared conversation beginnings, by the Euler-tour technique.

1. Turns are numbered, and prefixes of rebuilt conversations hashed, by scans: rows are sorted by ranges over all
   tasks, each task scans its own, and only a conversation that spans several ranges takes a value over from the
   ranges before (at most two rows for each range, so they are broadcast).  No conversation has to fit one task.
2. Equal prefixes are one node, named by its smallest member and depth.  A prefix hash is the exclusive or of two
   64-bit hashes of (position, MD5 of role and text) for each turn: 128 bits.
3. Each node has two arcs, enter and exit: enter goes to enter of the first child or else to the own exit, exit to
   enter of the next sibling or else to the parent's exit.
4. List ranking: nodes sorted by (conv_id, depth) keep a conversation's chain and its neighbours in one task, which
   ranks the pieces of the tour that it holds.  The pieces form a shorter list; while that is longer than
   ``SINGLE``, pieces are joined with their successors by random mates, a constant share each round, and the rest
   is ranked in one task.  Ranks go back the same way.  Positions, leaves and savings are summed in one go.
5. Leaves and savings of a subtree are the difference of the prefix sums at the exit and the enter arc.

Ids of members that end in a node are joined in chunks by the tasks of a sort; one task then digests a node's chunks as
they stream by (SHA-256 is sequential), in bounded memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscape.llm.stage import Stages
from cellscape.operators.skew import join_counted

GROUP = 100
HEADS = 6
#: Nodes that a task holds while it ranks its pieces of the tour.
TASK_NODES = 200_000
#: A list of at most so many pieces is ranked by one task.
SINGLE = 1_000_000
#: Ids joined to one chunk before digests are taken.
CHUNK_IDS = 1_000
LONG = np.int64


def _fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def scan(df: DataFrame, by: str, order: list[str], values: dict[str, str], stages: Stages, name: str) -> DataFrame:
    """Replace the columns of ``values`` by their running sum or xor over rows of the same ``by`` (long), in ``order``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, key, carry = TaskContext.get().partitionId(), None, dict.fromkeys(values, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(by).to_numpy()
            new = np.append(key is None or own[0] != key, own[1:] != own[:-1])
            starts, group = np.flatnonzero(new), np.cumsum(new)
            table = pa.Table.from_batches([batch])
            for c, op in values.items():
                x = batch.column(c).to_numpy()
                if op == "sum":
                    total = np.cumsum(x)
                    total -= np.concatenate([[-carry[c]], total[starts] - x[starts]])[group]
                else:
                    total = np.bitwise_xor.accumulate(x)
                    total ^= np.concatenate([np.array([carry[c]], dtype=LONG), total[starts] ^ x[starts]])[group]
                carry[c] = int(total[-1])
                table = table.append_column(f"run_{c}", pa.array(total))
            key = own[-1]
            yield from table.append_column("part", pa.array(np.full(batch.num_rows, part, dtype=np.int32))).to_batches()

    ranged = df.repartitionByRange(by, *order).sortWithinPartitions(by, *order)
    extra = "".join(f", `run_{c}` long" for c in values)
    rows = stages.store(ranged.mapInArrow(run, f"{_fields(df)}{extra}, part int"), name)
    ends = rows.groupBy("part").agg(F.array_distinct(F.array(F.min(by), F.max(by))).alias("ends"))
    spread = ends.select("part", F.explode("ends").alias(by)).groupBy(by).agg(F.count("*").alias("parts")).where("parts > 1").select(by)
    join = {"sum": F.sum, "xor": F.bit_xor}
    sums = rows.join(F.broadcast(spread), by).groupBy(by, "part").agg(*[join[op](c).alias(c) for c, op in values.items()])
    before = Window.partitionBy(by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(by, "part", *[join[op](c).over(before).alias(f"carry_{c}") for c, op in values.items()])
    out = rows.join(F.broadcast(carried), [by, "part"], "left")
    for c, op in values.items():
        carry = F.coalesce(f"carry_{c}", F.lit(0).cast("long"))
        out = out.withColumn(c, F.col(f"run_{c}") + carry if op == "sum" else F.col(f"run_{c}").bitwiseXOR(carry))
    return out.select(df.columns)


def rebuilt(conversations: DataFrame, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """Turns ``(conv_id, pos, digest, size, last)`` of all rebuilt conversations, and ``(conv_id, total)`` of each."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.md5(role), F.md5(text))).alias("digest"), F.length(text).cast("long").alias("size"),
        F.lit(1).cast("long").alias("pos"), F.monotonically_increasing_id().alias("row"))
    turns = scan(turns, "conv_id", ["turn", "digest", "row"], {"pos": "sum"}, stages, "turns").select("conv_id", "pos", "digest", "size")

    base = F.col("conv_id") - F.col("conv_id") % GROUP
    heads = F.when(base == F.col("conv_id"), 0).otherwise(F.crc32(F.col("conv_id").cast("string")) % HEADS)
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n")).withColumns({"base": base, "heads": heads})
    bases = sizes.where("conv_id = base").select("base", F.col("n").alias("base_n"))
    convs = stages.store(
        sizes.join(bases, "base", "left").withColumn("taken", F.least("heads", F.coalesce("base_n", F.lit(0))))
        .withColumn("total", F.col("taken") + F.greatest(F.col("n") - F.col("heads"), F.lit(0)))
        .select("conv_id", "base", "n", "heads", "taken", "total"), "conversations")
    first = turns.where((F.col("pos") < HEADS) & (base == F.col("conv_id"))).select(F.col("conv_id").alias("base"), "pos", "digest", "size")
    given = convs.join(first, "base").where("pos <= taken").select("conv_id", "pos", "digest", "size", "total")
    own = join_counted(turns, convs.select("conv_id", "n", "heads", "taken", "total"), ["conv_id"], "n").where("pos > heads").select(
        "conv_id", (F.col("pos") - F.col("heads") + F.col("taken")).alias("pos"), "digest", "size", "total")
    rows = given.unionByName(own).withColumn("last", F.col("pos") == F.col("total")).drop("total")
    return rows, convs.select("conv_id", "total")


def digests(ends: DataFrame, by: list[str]) -> DataFrame:
    """``(by, ends_sha256)``: SHA-256 of the ascending ``conv_id`` of each group, comma-joined."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def chunk():
            return pa.RecordBatch.from_arrays(
                [pa.array([v], pa.int64()) for v in key] + [pa.array([held[0]], pa.int64()), pa.array([",".join(map(str, held))])],
                [*by, "first", "chunk"])

        for batch in batches:
            for *k, conv in zip(*(batch.column(c).to_pylist() for c in [*by, "conv_id"])):
                if held and (k != key or len(held) == CHUNK_IDS):
                    yield chunk()
                    held = []
                key = k
                held.append(conv)
        if held:
            yield chunk()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for *k, chunk in zip(*(batch.column(c).to_pylist() for c in [*by, "chunk"])):
                if k == key:
                    state.update(b"," + chunk.encode())
                    continue
                if state is not None:
                    done.append((*key, state.hexdigest()))
                key, state = k, hashlib.sha256(chunk.encode())
            yield out(done)
        if state is not None:
            yield out([(*key, state.hexdigest())])

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * (len(by) + 1)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64()] * len(by) + [pa.string()])], [*by, "ends_sha256"])

    keys = ", ".join(f"{c} long" for c in by)
    ranged = ends.select(*by, "conv_id").repartitionByRange(*by, "conv_id").sortWithinPartitions(*by, "conv_id")
    chunks = ranged.mapInArrow(join, f"{keys}, first long, chunk string")
    return chunks.repartition(*by).sortWithinPartitions(*by, "first").mapInArrow(digest, f"{keys}, ends_sha256 string")


def nodes(rows: DataFrame, convs: DataFrame, stages: Stages) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, first_child, n_convs, n_children, size, ends_sha256)`` of each prefix."""
    salted = rows.withColumns({"k1": F.xxhash64("pos", "digest"), "k2": F.xxhash64("digest", "pos", F.lit(1)), "x1": F.xxhash64("pos", "digest"),
                               "x2": F.xxhash64("digest", "pos", F.lit(1))}).drop("digest")
    rows = scan(salted, "conv_id", ["pos"], {"k1": "xor", "k2": "xor"}, stages, "prefixes")
    key = ["depth", "k1", "k2"]
    rows = rows.withColumnRenamed("pos", "depth").withColumns({"p1": F.expr("k1 ^ x1"), "p2": F.expr("k2 ^ x2")})
    zero = F.lit(0).cast("long")
    root = {"depth": zero, "k1": zero, "k2": zero}
    made = rows.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("size").alias("size"),
                                  F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").withColumns(
        root | {"size": zero, "p1": zero, "p2": zero})
    every = stages.store(made.unionByName(top.select(made.columns)), "prefix-nodes")
    ends = rows.where("last").select(*key, "conv_id").unionByName(convs.where("total = 0").select("conv_id").withColumns(root))
    up = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    children = every.where("depth > 0").select(*up, "conv_id").groupBy(*key).agg(F.count("*").alias("n_children"), F.min("conv_id").alias("first_child"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    full = stages.store(
        every.join(children, key, "left").join(digests(ends, key), key, "left")
        .withColumns({"n_children": F.coalesce("n_children", zero), "ends_sha256": F.coalesce("ends_sha256", nothing)}), "trie-nodes")
    above = full.where("n_children > 0").select(
        F.col("depth").alias("up"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("rows"))
    below = join_counted(full.where("depth > 0").withColumn("up", F.col("depth") - 1), above, ["up", "p1", "p2"], "rows").drop("up", "rows")
    both = below.unionByName(full.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
    return both.drop(*key[1:], "p1", "p2")


def with_siblings(tree: DataFrame, stages: Stages) -> DataFrame:
    """Add ``next_sibling``: siblings are ordered by ``conv_id``."""
    order = ["parent_conv_id", "depth", "conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, first = TaskContext.get().partitionId(), None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            held = table.slice(table.num_rows - 1)
            yield from out(table, part, first, False)
            first &= table.num_rows == 1
        if held is not None:
            yield from out(held, part, first, True)

    def out(table: pa.Table, part: int, first: bool, ends: bool) -> list[pa.RecordBatch]:
        parent, depth, conv = (table.column(c).to_numpy() for c in order)
        same = (parent[1:] == parent[:-1]) & (depth[1:] == depth[:-1])
        n = len(conv) if ends else len(conv) - 1
        following = pa.array(np.append(conv[1:], 0)[:n], mask=~np.append(same, False)[:n])
        marks = [np.full(n, part, np.int32), np.arange(n) == (0 if first else -1), np.arange(n) == (n - 1 if ends else -1)]
        table = table.slice(0, n).append_column("next_sibling", following)
        for name, mark in zip(("part", "opens", "closes"), marks):
            table = table.append_column(name, pa.array(mark))
        return table.to_batches()

    inner = tree.where("depth > 0")
    rows = stages.store(inner.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        run, f"{_fields(inner)}, next_sibling long, part int, opens boolean, closes boolean"), "siblings")
    # one row for each range
    along = Window.orderBy("part")
    opening = rows.where("opens").select("part", *order)
    beyond = opening.select((F.lag("part").over(along)).alias("part"), F.col("parent_conv_id").alias("then_parent"), F.col("depth").alias("then_depth"),
                            F.col("conv_id").alias("then_conv")).where("part is not null")
    joined = rows.join(F.broadcast(beyond), "part", "left")
    there = F.expr("closes and then_parent = parent_conv_id and then_depth = depth")
    joined = joined.withColumn("next_sibling", F.when(there, F.col("then_conv")).otherwise(F.col("next_sibling"))).select(*inner.columns, "next_sibling")
    return joined.unionByName(tree.where("depth = 0").withColumn("next_sibling", F.lit(None).cast("long")))


def chain_sums(following: np.ndarray, weights: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """For lists given by each place's successor (-1: none): the head of each place, and the weights before it."""
    n = len(following)
    root, has = np.arange(n), following >= 0
    root[following[has]] = np.flatnonzero(has)
    sums = [np.where(root != np.arange(n), w[root], 0) for w in weights]
    while True:
        further = root[root]
        if np.array_equal(further, root):
            return root, sums
        sums = [s + s[root] for s in sums]
        root = further


WEIGHTS = ["steps", "leaves", "saved"]


def tour_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rank the pieces of the tour whose arcs this task holds; an arc is (conv_id, 2 * depth, + 1 for exit)."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held).combine_chunks()
    number = {c: table.column(c).to_numpy() for c in ("conv_id", "depth")}
    conv, depth = number["conv_id"], number["depth"]
    null = {c: np.asarray(table.column(c).is_null()) for c in ("parent_conv_id", "first_child", "next_sibling")}
    link = {c: table.column(c).fill_null(0).to_numpy() for c in null}
    n = len(conv)
    # enter: first child or own exit; exit: next sibling or the parent's exit
    to_conv, to_arc, none = np.empty(2 * n, LONG), np.empty(2 * n, LONG), np.zeros(2 * n, dtype=bool)
    leaf, last = null["first_child"], null["next_sibling"]
    to_conv[::2], to_arc[::2] = np.where(leaf, conv, link["first_child"]), np.where(leaf, 2 * depth + 1, 2 * depth + 2)
    to_conv[1::2], to_arc[1::2] = np.where(last, link["parent_conv_id"], link["next_sibling"]), np.where(last, 2 * depth - 1, 2 * depth)
    none[1::2] = last & null["parent_conv_id"]
    # rows are sorted, and the depths named by one conv_id are consecutive
    at = np.searchsorted(conv, to_conv)
    inside = (at < n) & ~none
    at[~inside] = 0
    row = at + (to_arc >> 1) - depth[at]
    inside &= (row >= 0) & (row < n)
    row[~inside] = 0
    inside &= (conv[row] == to_conv) & (depth[row] == to_arc >> 1)
    following = np.where(inside, 2 * row + (to_arc & 1), -1)
    weights = [np.ones(2 * n, LONG), np.zeros(2 * n, LONG), np.zeros(2 * n, LONG)]
    weights[1][::2] = leaf
    weights[2][::2] = (table.column("n_convs").to_numpy() - 1) * table.column("size").to_numpy()
    head, before = chain_sums(following, weights)
    part = TaskContext.get().partitionId()
    for side, name in enumerate(("enter", "exit")):
        own = slice(side, None, 2)
        table = table.append_column(f"{name}_piece", pa.array((part << 32) + head[own]))
        for c, b, w in zip(WEIGHTS, before, weights):
            table = table.append_column(f"{name}_{c}", pa.array(b[own]))
            if side == 0 or c == "steps":
                table = table.append_column(f"{name}_own_{c}", pa.array(w[own]))
        away = following[own] < 0
        table = table.append_column(f"{name}_tail", pa.array(away))
        table = table.append_column(f"{name}_to_conv", pa.array(to_conv[own], mask=none[own]))
        table = table.append_column(f"{name}_to_arc", pa.array(to_arc[own], mask=none[own]))
    yield from table.to_batches()


def _tour_schema(tree: DataFrame) -> str:
    out = _fields(tree)
    for side, name in enumerate(("enter", "exit")):
        out += f", {name}_piece long"
        for c in WEIGHTS:
            out += f", {name}_{c} long" + (f", {name}_own_{c} long" if side == 0 or c == "steps" else "")
        out += f", {name}_tail boolean, {name}_to_conv long, {name}_to_arc long"
    return out


def rank_list(pieces: DataFrame, stages: Stages, single: int = SINGLE) -> DataFrame:
    """``(piece, steps, leaves, saved)``: the weights before each piece of a list ``(piece, following, weights)``."""
    def alone(table: pa.Table) -> pa.Table:
        table = table.sort_by("piece")
        piece, end = table.column("piece").to_numpy(), np.asarray(table.column("following").is_null())
        following = np.where(end, -1, np.searchsorted(piece, table.column("following").fill_null(0).to_numpy()))
        _, before = chain_sums(following, [table.column(c).to_numpy() for c in WEIGHTS])
        return pa.table([pa.array(piece), *map(pa.array, before)], names=["piece", *WEIGHTS])

    joined: list[DataFrame] = []
    while pieces.count() > single:
        number = len(joined)
        coin = lambda c: F.expr(f"xxhash64({c}, {number}) & 1")
        right = pieces.select(F.col("piece").alias("following"), F.col("following").alias("then"), *[F.col(c).alias(f"more_{c}") for c in WEIGHTS])
        pairs = pieces.join(right, "following", "left").withColumn(
            "takes", F.col("following").isNotNull() & (coin("piece") == 1) & (coin("following") == 0))
        pairs = stages.store(pairs, f"mates-{number}")
        joined.append(pairs.where("takes").select(F.col("following").alias("piece"), F.col("piece").alias("into"), *WEIGHTS))
        pieces = stages.store(
            pairs.join(joined[-1].select("piece"), "piece", "left_anti").select(
                "piece", F.when(F.col("takes"), F.col("then")).otherwise(F.col("following")).alias("following"),
                *[(F.col(c) + F.when(F.col("takes"), F.col(f"more_{c}")).otherwise(0)).alias(c) for c in WEIGHTS]), f"list-{number}")
    ranks = stages.store(pieces.groupBy().applyInArrow(alone, "piece long, steps long, leaves long, saved long"), "ranks")
    for number in reversed(range(len(joined))):
        into = ranks.select(F.col("piece").alias("into"), *[F.col(c).alias(f"at_{c}") for c in WEIGHTS])
        below = joined[number].join(into, "into").select("piece", *[(F.col(f"at_{c}") + F.col(c)).alias(c) for c in WEIGHTS])
        ranks = stages.store(ranks.unionByName(below), f"ranks-{number}")
    return ranks


def prefix_trie(conversations: DataFrame, task_nodes: int = TASK_NODES, single: int = SINGLE) -> DataFrame:
    """One row for each node: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, enter_at, exit_at)``; the last two are the places of its arcs in the tour.

    ``conversations`` has ``conv_id, turn, role, text``; other columns are ignored.  Turns of a conversation are
    ordered by turn, null first; equal ones by the MD5 of the MD5s of role and text, so repeated rows are turns of
    their own.  Null role or text is empty.  Rows without ``conv_id`` belong to no conversation.  Empty table: no nodes.
    """
    stages = Stages(conversations.sparkSession, "prefix-trie")
    rows, convs = rebuilt(conversations, stages)
    tree = with_siblings(nodes(rows, convs, stages), stages)
    tree = stages.store(tree, "tree")
    parts = max(1, -(-tree.count() // task_nodes))
    ranged = tree.repartitionByRange(parts, "conv_id", "depth").sortWithinPartitions("conv_id", "depth")
    tour = stages.store(ranged.mapInArrow(tour_pieces, _tour_schema(tree)), "tour")

    def arcs(only: str, columns: Callable[[str], list[Column]]) -> DataFrame:
        made = [tour.where(F.expr(only.format(s=s))).select(*columns(s)) for s in ("enter", "exit")]
        return made[0].unionByName(made[1])

    heads = arcs("{s}_steps = 0", lambda s: [
        F.col("conv_id").alias("to_conv"), (2 * F.col("depth") + int(s == "exit")).alias("to_arc"), F.col(f"{s}_piece").alias("following")])
    tails = arcs("{s}_tail", lambda s: [
        F.col(f"{s}_piece").alias("piece"), F.col(f"{s}_to_conv").alias("to_conv"), F.col(f"{s}_to_arc").alias("to_arc"),
        *[(F.col(f"{s}_{c}") + (F.col(f"{s}_own_{c}") if s == "enter" or c == "steps" else 0)).alias(c) for c in WEIGHTS]])
    ranks = rank_list(stages.store(tails.join(heads, ["to_conv", "to_arc"], "left").select("piece", "following", *WEIGHTS), "pieces"), stages, single)
    out = tour
    for s in ("enter", "exit"):
        out = out.join(ranks.select(F.col("piece").alias(f"{s}_piece"), *[F.col(c).alias(f"{s}_base_{c}") for c in WEIGHTS]), f"{s}_piece")
    place = lambda s, c: F.col(f"{s}_base_{c}") + F.col(f"{s}_{c}")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (place("exit", "leaves") - place("enter", "leaves")).alias("n_leaves"),
        (place("exit", "saved") - place("enter", "saved")).alias("saved_tokens"), "ends_sha256",
        place("enter", "steps").alias("enter_at"), place("exit", "steps").alias("exit_at"))


_CRC = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(range(len(CAST(conv_id AS VARCHAR))), lambda i:
    [CAST(ascii(substring(CAST(conv_id AS VARCHAR), i + 1, 1)) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295)"""
ORACLE = f"""
WITH t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(md5(role) || md5(text))) AS pos
           FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, conv_id - conv_id % {GROUP} AS base, {_CRC} % {HEADS} AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS own, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
      UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
l AS (SELECT c.conv_id, coalesce(x.s, []) AS s FROM c LEFT JOIN (
        SELECT conv_id, list({{'r': role, 't': text}} ORDER BY own, pos) AS s FROM r GROUP BY conv_id) x USING (conv_id)),
p AS (SELECT conv_id, len(s) AS total, unnest(range(0, len(s) + 1)) AS d, s FROM l),
n AS (SELECT d, s[1:d] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
             (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE max(length(s[d].t)) END AS saved,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE total = d), '')) AS ends
      FROM p GROUP BY d, s[1:d]),
k AS (SELECT n.d, n.prefix, count(m.d) AS n_children FROM n LEFT JOIN n m ON m.d = n.d + 1 AND m.prefix[1:m.d - 1] = n.prefix GROUP BY n.d, n.prefix),
e AS (SELECT n.prefix, n.d, n.saved, k.n_children, unnest(range(0, n.d + 1)) AS up FROM n JOIN k USING (d, prefix)),
u AS (SELECT up, prefix[1:up] AS top, sum(saved) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves FROM e GROUP BY up, prefix[1:up])
SELECT n.conv_id, n.d AS depth, o.conv_id AS parent_conv_id, n.n_convs, k.n_children, u.leaves AS n_leaves,
       CAST(u.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM n JOIN k USING (d, prefix) JOIN u ON u.up = n.d AND u.top = n.prefix LEFT JOIN n o ON o.d = n.d - 1 AND o.prefix = n.prefix[1:n.d - 1]"""
