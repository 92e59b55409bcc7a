"""Decision trees, random forests and extremely randomised trees, grown level by level on DataFrames.

* Training rows are stored once.  A unit is a value of the ``by`` columns, such as a city and a fold; all units and trees
  grow at once.  What a row weighs in a tree and the node it stands in are worked out in each pass over the rows, from the
  seed and from the upper nodes, so that no table of rows times trees is stored or moved.
* Nodes of more than ``group_rows`` rows are split by aggregates.  Class counts for each (node, feature, bin) rate the
  places between bins and bound those inside one from below: the impurity after a cut is concave in the rows of either
  class on the left, so it is least where a bin's rows of one class are all on one side.  Only bins that may hold a cut
  as good as the best between bins are opened: their values are summed by ranges over all tasks and every place is rated.
  The best one of a node is a minimum.  These upper nodes are the driver's: their number follows rows / ``group_rows``.
* A smaller node is finished whole, in one Arrow group, which its rows are sent to.  Where few nodes are left above the
  largest depth, small ones are split by aggregates too, and no row is sent.

The result does not depend on the partitioning, nor on where nodes are finished: draws are hashes of the seed, the
tree, the node's path and the row's content.  The forest is a stored table of nodes.  It is cut into pieces - the upper
nodes, and the subtree of each small one.  A forest of few nodes is sent to the rows to be scored; of a larger one, several
pieces make a chunk, and a row is sent once to each chunk that holds a piece it stands in.

Rules: a node is split while it is not pure, has at least ``min_samples_split`` drawn rows and is above
``max_depth`` (None: no limit).  Each node draws ``max_features`` features; if none of them varies there, the others
are tried.  A cut is the largest value that goes left, or as drawn; equally good cuts go to the lower feature, then value.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace
from functools import cached_property
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellscape.operators.skew import join_counted, running_sums
from cellscape.session import materialize, scratch

#: Rows of a node that one task finishes, and rows that one task scores against a piece of a tree.
GROUP_ROWS = 200_000
#: Bins of a feature; their number bounds work and memory and changes no cut.
BINS = 256
#: Rows that a task takes in at once in a pass over the rows.
COUNTED_ROWS = 50_000
#: Bins of all nodes that a task counts in one pass; further nodes are left to further passes.
DENSE = 1 << 21
#: Nodes, with all that may be below them, up to which small ones are split by aggregates as well.
SHALLOW = 1024
#: Nodes of a forest that is sent to the rows, and rows of the pieces that are brought together for scoring.
SENT_NODES = 200_000
CHUNK_ROWS = 1_000_000
#: Bytes of rows that travel to a small node as one value.
PACKED_BYTES = 1 << 20
ROOT = 1
OPEN, LEAF, SMALL, SPLIT = range(4)
_NODE = ("piece long, node long, depth int, feature int, cut double, left long, right long, n long, ones long, decrease double")
_COLUMNS = [c.split()[0] for c in _NODE.split(", ")]
_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]


@dataclass(frozen=True)
class Rules:
    n_trees: int = 1
    criterion: str = "gini"
    max_depth: int | None = None
    min_split: int = 2
    max_features: str | int | None = None
    seed: int = 0
    bootstrap: bool = False
    random_cuts: bool = False
    group_rows: int = GROUP_ROWS

    def drawn(self, width: int) -> int:
        if self.max_features in (None, "all", "None"):
            return width
        if self.max_features in ("sqrt", "auto"):
            return max(1, int(math.sqrt(width)))
        if self.max_features == "log2":
            return max(1, int(math.log2(width)))
        share = float(self.max_features)
        return min(width, max(1, int(share * width if share < 1 or "." in str(self.max_features) else share)))

    def depth(self) -> int:
        return 2**31 - 1 if self.max_depth is None else int(self.max_depth)


# ----- draws and impurity: the same numbers wherever a node is split ---------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _hash(*parts) -> np.ndarray:
    """64-bit hash of arrays of integers that broadcast against each other."""
    out = np.zeros((), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for p in parts:
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + np.asarray(p, dtype=np.int64).astype(np.uint64) + np.uint64(1))
    return out


def _uniform(*parts) -> np.ndarray:
    return (_hash(*parts) >> np.uint64(11)).astype(np.float64) / 2.0**53


def _child(node, side) -> np.ndarray:
    return (_hash(node, side) >> np.uint64(1)).astype(np.int64)


def feature_order(rules: Rules, tree, node, width: int) -> np.ndarray:
    """Features of each node in the order of its draw."""
    return np.argsort(_hash(rules.seed, np.asarray(tree)[:, None], np.asarray(node)[:, None], np.arange(width)), axis=1, kind="stable")


def poisson(u: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Poisson numbers by inversion; large means by the normal law."""
    if len(mean) and (mean == 1).all():  # rows that do not repeat: the same sums, made once
        p = [np.exp(-mean[:1])[0]]
        for k in range(1, 24):
            p.append(p[-1] * 1.0 / k)
        steps = np.cumsum(p)
        out = np.searchsorted(steps, u, side="right")
        rest = np.flatnonzero(out == len(steps))
        out[rest] = _poisson(u[rest], mean[rest])
        return out
    return _poisson(u, mean)


def _poisson(u: np.ndarray, mean: np.ndarray) -> np.ndarray:
    out, small = np.zeros(len(u), dtype=np.int64), mean <= 500
    p = np.exp(-np.where(small, mean, 0.0))
    below, k = p.copy(), 0
    while (more := small & (u >= below)).any() and k < 2000:
        k += 1
        out[more] += 1
        p = p * mean / k
        below += np.where(small, p, 0)
    for i in np.flatnonzero(~small):
        out[i] = max(0, round(mean[i] + math.sqrt(mean[i]) * NormalDist().inv_cdf(min(max(u[i], 1e-15), 1 - 1e-15))))
    return out


def impurity(ones, n, criterion: str):
    p = np.asarray(ones) / np.maximum(n, 1)
    if criterion == "gini":
        return 2 * p * (1 - p)
    if criterion not in ("entropy", "log_loss"):
        raise ValueError(f"unsupported criterion {criterion}")
    q = 1 - p
    return -(p * np.log2(np.where(p > 0, p, 1)) + q * np.log2(np.where(q > 0, q, 1)))


def impurity_after(left, left_ones, n, ones, criterion: str):
    right, right_ones = n - left, ones - left_ones
    return (left * impurity(left_ones, left, criterion) + right * impurity(right_ones, right, criterion)) / n


# ----- a small node, in one task ------------------------------------------------------------------

def _rate_feature(v: np.ndarray, place: np.ndarray | None, f: np.ndarray, slot: np.ndarray, w: np.ndarray, wy: np.ndarray, nodes: "_Open", rules: Rules):
    """Of one drawn feature ``f`` of each node: (node, impurity after, cut) where it varies.  Rows are ordered by node.

    ``place`` orders the values ``v`` of a feature; it is not needed for drawn cuts."""
    n, ones = nodes.n, nodes.ones
    starts = np.flatnonzero(np.diff(slot, prepend=-1))
    if rules.random_cuts:
        low, high = np.minimum.reduceat(v, starts), np.maximum.reduceat(v, starts)
        cut = low + _uniform(rules.seed, nodes.tree, nodes.node, f, 7) * (high - low)
        cut = np.where(cut < high, cut, low)
        go = v <= cut[slot]
        k = np.flatnonzero(high > low)
        left, left_ones = (np.add.reduceat(np.where(go, c, 0), starts)[k] for c in (w, wy))
        return k, impurity_after(left, left_ones, n[k], ones[k], rules.criterion), cut[k]
    # node, place of the value and row in one number: plain numbers are sorted several times faster than pairs
    bits = max(len(v) - 1, int(place.max())).bit_length()
    order = np.sort(((slot << bits) | place) << bits | np.arange(len(v))) & ((1 << bits) - 1)
    v = v[order]
    at = np.flatnonzero((slot[1:] == slot[:-1]) & (v[:-1] < v[1:]))
    if not len(at):
        return at, np.zeros(0), np.zeros(0)
    left, left_ones = np.cumsum(w[order]), np.cumsum(wy[order])
    before = starts - 1
    own = slot[at]
    left, left_ones = (c[at] - np.where(before >= 0, c[before], 0)[own] for c in (left, left_ones))
    score = impurity_after(left, left_ones, n[own], ones[own], rules.criterion)
    first = np.flatnonzero(np.diff(own, prepend=-1))
    least = np.repeat(np.minimum.reduceat(score, first), np.diff(np.append(first, len(own))))
    # the first place with the least impurity has the smallest value
    hit = np.flatnonzero(score == least)
    hit = hit[np.diff(own[hit], prepend=-1) != 0]
    return own[hit], score[hit], v[at[hit]]


@dataclass
class _Open:
    """Nodes of one depth that may be split."""

    tree: np.ndarray
    node: np.ndarray
    n: np.ndarray
    ones: np.ndarray


def grow_small(x: np.ndarray, y: np.ndarray, w: np.ndarray, tree: int, node: int, depth: int, rules: Rules) -> list[np.ndarray]:
    """Columns of all nodes under one node, which names the piece; all nodes of a depth at once."""
    width, m, made = x.shape[1], rules.drawn(x.shape[1]), []
    slot, nodes, wy = np.zeros(len(y), dtype=np.int64), np.array([node], dtype=np.int64), w * y
    none = np.zeros(0, dtype=np.int64)
    ids, flat = np.arange(len(y)), np.ascontiguousarray(x).ravel()  # rows in the order of their nodes; the values stay in place
    places = None if rules.random_cuts or not width else np.stack([np.unique(c, return_inverse=True)[1] for c in x.T], axis=1).astype(np.int32).ravel()

    def add(which: np.ndarray, n, ones, feature=None, cut=None, left=None, right=None, decrease=None):
        k = len(which)
        made.append((np.full(k, node), which, np.full(k, depth, np.int32), np.full(k, -1, np.int32) if feature is None else feature.astype(np.int32),
                     np.full(k, np.nan) if cut is None else cut, np.zeros(k, np.int64) if left is None else left,
                     np.zeros(k, np.int64) if right is None else right, n, ones, np.zeros(k) if decrease is None else decrease))

    while len(nodes):
        starts = np.flatnonzero(np.diff(slot, prepend=-1))
        n, ones = np.add.reduceat(w, starts), np.add.reduceat(wy, starts)
        best_score, best_f, best_cut = np.full(len(nodes), np.inf), np.full(len(nodes), width), np.zeros(len(nodes))
        todo = np.flatnonzero((ones > 0) & (ones < n) & (n >= rules.min_split)) if depth < rules.depth() else none
        order = np.tile(np.arange(width), (len(nodes), 1)) if m == width else feature_order(rules, np.full(len(nodes), tree), nodes, width)
        for first, last in ((0, m), (m, width)):
            if not len(todo) or first == last:
                break
            number = np.full(len(nodes), -1)
            number[todo] = np.arange(len(todo))
            rows = np.flatnonzero(number[slot] >= 0)
            own, base, w_open, wy_open = number[slot[rows]], ids[rows] * width, w[rows], wy[rows]
            some = _Open(np.full(len(todo), tree), nodes[todo], n[todo], ones[todo])
            for j in range(first, last):
                f = order[todo, j]
                at = base + f[own]
                place = None if places is None else places[at].astype(np.int64)
                k, score, cut = _rate_feature(flat[at], place, f, own, w_open, wy_open, some, rules)
                at, fk = todo[k], f[k]
                better = (score < best_score[at]) | ((score == best_score[at]) & (fk < best_f[at]))
                at = at[better]
                best_score[at], best_f[at], best_cut[at] = score[better], fk[better], cut[better]
            todo = todo[best_f[todo] == width]
        split = best_f < width
        add(nodes[~split], n[~split], ones[~split])
        if not split.any():
            break
        children = [_child(nodes[split], side) for side in (0, 1)]
        drop = n[split] * (impurity(ones[split], n[split], rules.criterion) - best_score[split])
        add(nodes[split], n[split], ones[split], best_f[split], best_cut[split], *children, drop)
        number = np.cumsum(split) - 1
        rows = np.flatnonzero(split[slot])
        side = (flat[ids[rows] * width + best_f[slot[rows]]] > best_cut[slot[rows]]).astype(np.int64)
        new = 2 * number[slot[rows]] + side
        rank = np.argsort(new, kind="stable")
        rows, slot = rows[rank], new[rank]
        ids, w, wy = ids[rows], w[rows], wy[rows]
        nodes, depth = np.stack(children, axis=1).ravel(), depth + 1
    return [np.concatenate(c) for c in zip(*made)]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


# ----- upper nodes, and passes over the rows ----------------------------------------------------

@dataclass
class _Top:
    """Nodes as arrays.  ``left`` and ``right`` are places in them; ``root`` has those of (unit, tree), -1 where there is none."""

    units: dict[tuple, int]
    root: np.ndarray
    scoring: bool = False
    columns: dict[str, np.ndarray] = field(default_factory=lambda: {c: np.zeros(0, k) for c, k in _KEPT.items()})

    def __getattr__(self, name: str) -> np.ndarray:
        if name in _KEPT:
            return self.columns[name]
        raise AttributeError(name)

    def add(self, **values: np.ndarray) -> np.ndarray:
        """Append nodes; their places."""
        n = len(self.node)
        some = len(values["node"])
        for c, kind in _KEPT.items():
            self.columns[c] = np.append(self.columns[c], np.asarray(values[c]).astype(kind) if c in values else np.full(some, _UNSET[c], kind))
        return np.arange(n, n + some)

    def slots(self, unit: np.ndarray, tree: int, x: np.ndarray) -> np.ndarray:
        """The lowest of the nodes that each row stands in, -1 without a tree."""
        at = np.where(unit >= 0, self.root[unit, tree], -1) if self.root.size else np.full(len(unit), -1)
        moving = np.flatnonzero(at >= 0)
        flat, width = x.ravel(), x.shape[1]
        feature, cut, left, right = self.feature, self.cut, self.left, self.right
        while len(moving := moving[feature[at[moving]] >= 0]):
            own = at[moving]
            value = flat[moving * width + feature[own]]
            # what is no number goes left in growing, and right in scoring
            at[moving] = np.where(value <= cut[own] if self.scoring else ~(value > cut[own]), left[own], right[own])
        return at


_KEPT = {"unit": np.int64, "tree": np.int64, "node": np.int64, "depth": np.int64, "rows": np.int64, "n": np.int64, "ones": np.int64,
         "feature": np.int64, "cut": np.float64, "left": np.int64, "right": np.int64, "decrease": np.float64, "kind": np.int8, "chunk": np.int64}
_UNSET = {c: -1 if c in ("feature", "left", "right", "chunk") else np.nan if c == "cut" else 0 for c in _KEPT}


def _unit_numbers(table: pa.Table, by: list[str], units: dict[tuple, int]) -> np.ndarray:
    """The number of each row's unit, -1 for units without upper nodes."""
    if not by or not units:
        return np.full(table.num_rows, units.get((), -1))
    number, first = _numbered(table, by)
    return np.array([units.get(tuple(table.column(c)[int(i)].as_py() for c in by), -1) for i in first])[number]


def _blocks(batches, size: int = COUNTED_ROWS):
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= size:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _weights(rules: Rules, tree: int, row: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How often each row is drawn by a tree."""
    return poisson(_uniform(rules.seed, tree, row, 3), m.astype(float)) if rules.bootstrap else m


def _standing(batches, rules: Rules, by: list[str], top: _Top, trees):
    """For each block and tree: (tree, unit numbers, x, label, weight, places in ``top``)."""
    for table in _blocks(batches):
        unit, x = _unit_numbers(table, by, top.units), _matrix(table.column("x"))
        y, m, row = (table.column(c).to_numpy().astype(np.int64) for c in ("label", "m", "row"))
        for tree in trees:
            yield table, tree, unit, x, y, _weights(rules, tree, row, m), top.slots(unit, tree, x)


def _out(columns: dict[str, np.ndarray]):
    table = pa.table({c: pa.array(v) for c, v in columns.items()})
    yield from table.to_batches(max_chunksize=COUNTED_ROWS)


# ----- growing ----------------------------------------------------------------------------------

def grow(train: DataFrame, rules: Rules, by: list[str] | None = None) -> "Forest":
    """Grow the trees of every unit on ``(by, features, label)``, label 0 or 1 and not null.

    Equal rows are one row with a weight.  With ``bootstrap`` a row is drawn a Poisson number of times in
    each tree.  A unit whose rows are never drawn has no tree and gets no score.
    """
    by, spark = by or [], train.sparkSession
    with scratch(spark) as keep_stored:
        rows = materialize(
            train.select(*by, vector_to_array("features").alias("x"), F.col("label").cast("int").alias("label")).groupBy(*by, "x", "label")
            .agg(F.count("*").alias("m")).withColumn("row", F.xxhash64("x", "label")), "forest-rows")
        sizes = rows.groupBy(*by).agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width"))
        largest, width = sizes.agg(F.max("n"), F.max("width")).first() or (0, 0)
        top = _Top({}, np.zeros((0, rules.n_trees), dtype=np.int64))
        if (largest or 0) > rules.group_rows:
            # no more of them than rows / group_rows
            units = [tuple(r) for r in sizes.where(F.col("n") > rules.group_rows).select(*by).collect()] if by else [()]
            top = _grow_top(rows, rules, by, width, {u: k for k, u in enumerate(units)})
        keep = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in by]
        fields = ", ".join([*keep, "tree int, node long, depth int, x binary, label binary, w binary"])
        parts = []
        if by or not len(top.node) or (top.kind == SMALL).any():
            to_finish = rows.mapInArrow(_send(rules, by, top), fields)
            parts.append(to_finish.groupBy(*by, "tree", "node").applyInArrow(_finish(rules, by), ", ".join([*keep, "tree int", _NODE])))
        if len(top.node):
            parts.append(_top_nodes(spark, top, by, rows))
        nodes = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        nodes = keep_stored(nodes, "forest")
    return Forest(nodes, by, rules, top, min(largest or 0, rules.group_rows))


def _kinds(top: _Top, slots: np.ndarray, rules: Rules) -> None:
    """Mark new nodes as leaves, open ones that are split by aggregates, and small ones."""
    n, ones, depth = top.n[slots], top.ones[slots], top.depth[slots]
    final = (ones == 0) | (ones == n) | (n < rules.min_split) | (depth >= rules.depth())
    top.kind[slots] = np.where(final, LEAF, np.where(top.rows[slots] > rules.group_rows, OPEN, SMALL))
    rest = slots[~final]
    if len(rest) and (left := rules.depth() - int(top.depth[rest].min())) < 32 and len(rest) << (left - 1) <= SHALLOW:
        top.kind[rest] = OPEN


def _grow_top(rows: DataFrame, rules: Rules, by: list[str], width: int, units: dict[tuple, int]) -> _Top:
    """Split the nodes of large units level by level, until only leaves and small nodes are left."""
    top = _Top(units, np.full((len(units), rules.n_trees), -1))
    trees = range(rules.n_trees)

    def count_roots(batches):
        sums = np.zeros((3, len(units) * rules.n_trees), dtype=np.int64)
        for _, tree, unit, _, y, w, _ in _standing(batches, rules, by, top, trees):
            drawn = np.flatnonzero((w > 0) & (unit >= 0))
            at = unit[drawn] * rules.n_trees + tree
            for k, c in enumerate((None, w[drawn], (w * y)[drawn])):
                sums[k] += np.bincount(at, c, sums.shape[1]).astype(np.int64)
        at = np.flatnonzero(sums[0])
        yield from _out({"at": at, "rows": sums[0][at], "n": sums[1][at], "ones": sums[2][at]})

    counted = rows.mapInArrow(count_roots, "at long, rows long, n long, ones long").groupBy("at").agg(
        *[F.sum(c).alias(c) for c in ("rows", "n", "ones")]).orderBy("at").toArrow()
    at, *sums = (counted.column(c).to_numpy() for c in ("at", "rows", "n", "ones"))
    new = top.add(unit=at // rules.n_trees, tree=at % rules.n_trees, node=np.full(len(at), ROOT), **dict(zip(("rows", "n", "ones"), sums)))
    top.root.ravel()[at] = new
    edges = [] if rules.random_cuts else _edges(rows, width)
    m = rules.drawn(width)
    while True:
        _kinds(top, new, rules)
        slots = np.flatnonzero(top.kind == OPEN)
        slots = slots[np.argsort(top.tree[slots], kind="stable")]
        if not len(slots):
            return top
        found = {c: np.full(len(top.node), v) for c, v in (("after", np.inf), ("feature", -1), ("value", 0.0), ("rows", 0), ("l", 0), ("l1", 0))}
        for start, stop in ((0, m), (m, width)):
            todo = slots[found["feature"][slots] < 0]  # no drawn feature varies there: the others are tried
            each = max(1, DENSE // (max(1, stop - start) * BINS))
            for k in range(0, len(todo) if start < stop else 0, each):
                _best_cuts(rows, rules, by, top, todo[k:k + each], width, start, stop, edges, found)
        cut = slots[found["feature"][slots] >= 0]
        top.kind[slots] = LEAF
        top.kind[cut] = SPLIT
        n, ones = top.n[cut], top.ones[cut]
        children = []
        for side in (0, 1):
            sums = {c: found[k][cut] if side == 0 else getattr(top, c)[cut] - found[k][cut] for c, k in (("rows", "rows"), ("n", "l"), ("ones", "l1"))}
            children.append(top.add(unit=top.unit[cut], tree=top.tree[cut], node=_child(top.node[cut], side), depth=top.depth[cut] + 1, **sums))
        top.feature[cut], top.cut[cut] = found["feature"][cut], found["value"][cut]
        top.left[cut], top.right[cut] = children
        top.decrease[cut] = n * (impurity(ones, n, rules.criterion) - found["after"][cut])
        new = np.concatenate(children)


def _send(rules: Rules, by: list[str], top: _Top):
    """Rows of small nodes, to be grouped by node.  The rows that a task has of one node travel packed, not one by one."""
    def run(batches):
        node, depth, small = np.append(top.node, ROOT), np.append(top.depth, 0), np.append(top.kind == SMALL, True)
        groups = None
        for table, tree, unit, x, y, w, at in _standing(batches, rules, by, top, range(rules.n_trees)):
            if groups is None or groups[0] is not table:
                groups = (table, *_numbered(table, by))
            own = np.flatnonzero((w > 0) & small[at] & ((at >= 0) | (unit < 0)))
            if not len(own):
                continue
            # by unit, then by node: a node is in one unit
            order = np.lexsort((at[own], groups[1][own]))
            own = own[order]
            new = (np.diff(groups[1][own], prepend=-1) != 0) | (np.diff(at[own], prepend=-2) != 0)
            starts = np.flatnonzero(new)
            most = max(1, PACKED_BYTES // (8 * x.shape[1] + 16))
            starts = np.unique(np.concatenate([starts, np.concatenate([np.arange(a, b, most) for a, b in zip(starts, [*starts[1:], len(own)])])]))
            ends = [*starts[1:].tolist(), len(own)]
            lead = own[starts]
            some = table.select(by).take(pa.array(lead))
            pack = lambda v: pa.array([v[own[a:b]].T.tobytes() for a, b in zip(starts.tolist(), ends)], pa.binary())
            columns = [*[some.column(c) for c in by], pa.array(np.full(len(lead), tree, np.int32)), pa.array(node[at[lead]]), pa.array(depth[at[lead]].astype(np.int32)),
                       pack(x), pack(y), pack(w.astype(np.int64))]
            yield from pa.table(columns, names=[*by, "tree", "node", "depth", "x", "label", "w"]).to_batches(max_chunksize=64)

    return run


def _top_nodes(spark, top: _Top, by: list[str], rows: DataFrame) -> DataFrame:
    """The upper nodes as rows, without the small ones, which are roots of their own piece."""
    own = np.flatnonzero(top.kind != SMALL)
    leaf, units = top.kind[own] == LEAF, list(top.units)
    below = lambda c: pa.array(np.append(top.node, 0)[getattr(top, c)[own]], mask=leaf)
    columns = {c: pa.array([units[u][k] for u in top.unit[own]]) for k, c in enumerate(by)}
    columns |= {"tree": pa.array(top.tree[own].astype(np.int32)), "piece": pa.array(np.full(len(own), ROOT)), "node": pa.array(top.node[own]),
                "depth": pa.array(top.depth[own].astype(np.int32)), "feature": pa.array(top.feature[own].astype(np.int32)),
                "cut": pa.array(top.cut[own], mask=leaf), "left": below("left"), "right": below("right"), "n": pa.array(top.n[own]),
                "ones": pa.array(top.ones[own]), "decrease": pa.array(top.decrease[own])}
    made = spark.createDataFrame(pa.table(columns))
    return made.select(*[F.col(c).cast(rows.schema[c].dataType).alias(c) for c in by], "tree", *_COLUMNS)


def _finish(rules: Rules, by: list[str]):
    def run(table: pa.Table) -> pa.Table:
        one = lambda c: table.column(c)[0].as_py()
        y, w = (np.concatenate([np.frombuffer(v.as_buffer(), np.int64) for v in table.column(c)]) for c in ("label", "w"))
        sizes = [len(v.as_buffer()) // 8 for v in table.column("label")]
        x = np.concatenate([np.frombuffer(v.as_buffer(), np.float64).reshape(-1, n).T for v, n in zip(table.column("x"), sizes)])
        made = grow_small(x, y, w, one("tree"), one("node"), one("depth"), rules)
        unit = [pa.array([one(c)] * len(made[0]), table.schema.field(c).type) for c in [*by, "tree"]]
        leaf = made[_COLUMNS.index("feature")] < 0
        columns = [pa.array(c, k, mask=leaf if name in ("cut", "left", "right") else None) for name, c, k in zip(_COLUMNS, made, _KINDS)]
        return pa.table([*unit, *columns], names=[*by, "tree", *_COLUMNS])

    return run


def _edges(rows: DataFrame, width: int) -> list[np.ndarray]:
    """Ends of the bins of each feature, about equally filled; any ends give the same cuts."""
    if not width:
        return []
    shares = [(k + 1) / BINS for k in range(BINS - 1)]
    found = rows.agg(*[F.percentile_approx(F.col("x")[i], shares, 4 * BINS).alias(f"e{i}") for i in range(width)]).first()
    return [np.unique(np.array(found[f"e{i}"] or [], dtype=float)) for i in range(width)]


def _bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The bin of each value: the number of ends below it."""
    return np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)], axis=1) if len(edges) else np.zeros(x.shape, np.int64)


def _numbered(table: pa.Table, key: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each row that is equal for equal keys, counted from 0, and the first row of each number."""
    number = np.zeros(table.num_rows, dtype=np.int64)
    for c in key:
        column = pc.dictionary_encode(table.column(c).combine_chunks(), null_encoding="encode")
        codes = column.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        number = np.unique(number * (len(column.dictionary) + 1) + codes, return_inverse=True)[1].ravel()
    return number, np.unique(number, return_index=True)[1]


def _best_cuts(rows: DataFrame, rules: Rules, by: list[str], top: _Top, slots: np.ndarray, width: int, start: int, stop: int,
               edges: list[np.ndarray], found: dict[str, np.ndarray]) -> None:
    """Fill in the best cut of each of ``slots``, ordered by tree, among its features from ``start`` to ``stop`` of its draw."""
    each, n_of, ones_of = stop - start, top.n, top.ones
    drawn = feature_order(rules, top.tree[slots], top.node[slots], width)[:, start:stop] if rules.drawn(width) < width else np.tile(
        np.arange(width), (len(slots), 1))
    trees, first = np.unique(top.tree[slots], return_index=True)
    ranges = dict(zip(trees.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(slots)])))
    number = np.append(np.full(len(top.node), -1), -1)
    number[slots] = np.arange(len(slots))

    def open_rows(batches):
        """For each block and tree: numbers in ``slots``, features (one column for each drawn), values, bins, w, w * label."""
        last = bins = None
        for table, tree, _, x, y, w, at in _standing(batches, rules, by, top, trees.tolist()):
            if last is not table:
                last, bins = table, _bins(x, edges).astype(np.int16) if edges else None
            own = np.flatnonzero((number[at] >= 0) & (w > 0))
            if len(own):
                slot = number[at[own]]
                features = drawn[slot]
                at_x = own[:, None] * width + features
                yield tree, slot, features, x.ravel()[at_x], None if bins is None else bins.ravel()[at_x], w[own], (w * y)[own]

    def ends(bins_each: int):
        """Least and largest value and sums by (slot, drawn feature[, bin]) over a whole task."""
        def run(batches):
            size = len(slots) * each * bins_each
            low, high = np.full(size, np.inf), np.full(size, -np.inf)
            sums = np.zeros((3, size), dtype=np.int64)
            for tree, slot, _, value, at, w, wy in open_rows(batches):
                a, b = (e * each * bins_each for e in ranges[tree])
                place = (slot[:, None] * each + np.arange(each)) * bins_each - a
                place = (place if bins_each == 1 else place + at).ravel()
                value = value.ravel() + 0.0
                np.minimum.at(low[a:b], place, value)
                np.maximum.at(high[a:b], place, value)
                for k, c in enumerate((None, w, wy)):
                    sums[k, a:b] += np.bincount(place, None if c is None else np.repeat(c, each), b - a).astype(np.int64)
            at = np.flatnonzero(sums[0])
            own = at // bins_each
            yield from _out({"slot": slots[own // each], "feature": drawn.ravel()[own], "bin": at % bins_each, "low": low[at], "high": high[at],
                             "rows": sums[0][at], "l": sums[1][at], "l1": sums[2][at]})

        return run

    def below(cuts: np.ndarray):
        """Sums over the rows at or below the cut of each (slot, drawn feature)."""
        def run(batches):
            sums = np.zeros((3, len(slots) * each), dtype=np.int64)
            for tree, slot, _, value, _, w, wy in open_rows(batches):
                a, b = (e * each for e in ranges[tree])
                place = (slot[:, None] * each + np.arange(each)) - a
                go = value <= cuts[slot]
                for k, c in enumerate((None, w, wy)):
                    sums[k, a:b] += np.bincount(place[go], None if c is None else np.repeat(c, each)[go.ravel()], b - a).astype(np.int64)
            at = np.flatnonzero(sums[0])
            yield from _out({"at": at, "rows": sums[0][at], "l": sums[1][at], "l1": sums[2][at]})

        return run

    def bound(batches):
        for batch in batches:
            if batch.num_rows:
                slot, l, l1, before, before1 = (batch.column(c).to_numpy() for c in ("slot", "l", "l1", "before", "before1"))
                n, ones = n_of[slot], ones_of[slot]
                none, all_of = before - before1, l - l1  # rows of class 0 on the left
                after = impurity_after(l, l1, n, ones, rules.criterion)
                corners = [impurity_after(p + q, p, n, ones, rules.criterion) for p, q in ((before1, none), (l1, none), (before1, all_of))]
                batch = batch.append_column("after", pa.array(np.where(l < n, after, np.inf)))
                yield batch.append_column("least", pa.array(np.minimum.reduce([after, *corners])))

    def open_values(opened: np.ndarray):
        def run(batches):
            for _, slot, features, value, at, w, wy in open_rows(batches):
                row, j = np.nonzero(opened[slot[:, None], np.arange(each) * BINS + at])
                yield from _out({"slot": slots[slot[row]], "feature": features[row, j], "bin": at[row, j].astype(np.int64), "value": value[row, j],
                                 "rows": np.ones(len(row), np.int64), "l": w[row], "l1": wy[row]})

        return run

    def rate(batches):
        for batch in batches:
            if batch.num_rows:
                slot, l, l1 = (batch.column(c).to_numpy() for c in ("slot", "l", "l1"))
                yield batch.append_column("after", pa.array(np.where(l < n_of[slot], impurity_after(l, l1, n_of[slot], ones_of[slot], rules.criterion), np.inf)))

    schema = lambda df, extra: ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields] + [extra])
    sums = [F.sum(c).alias(c) for c in ("rows", "l", "l1")]
    counted = rows.mapInArrow(ends(1 if rules.random_cuts else BINS), "slot long, feature long, bin long, low double, high double, rows long, l long, l1 long").groupBy(
        "slot", "feature", "bin").agg(F.min("low").alias("low"), F.max("high").alias("high"), *sums)
    if rules.random_cuts:
        # one cut a feature needs the ends of its values and the rows below the cut, so that nothing is sorted
        got = counted.where("high > low").select("slot", "feature", "low", "high").toArrow()
        slot, f, low, high = (got.column(c).to_numpy() for c in ("slot", "feature", "low", "high"))
        drawn_cut = low + _uniform(rules.seed, top.tree[slot], top.node[slot], f, 7) * (high - low)
        place = np.full((len(slots), width), -1)
        np.put_along_axis(place, drawn, np.arange(drawn.size).reshape(drawn.shape), axis=1)
        at = place[number[slot], f]
        cuts = np.full(len(slots) * each, np.nan)  # no value is below it
        cuts[at] = np.where(drawn_cut < high, drawn_cut, low)
        got = rows.mapInArrow(below(cuts.reshape(len(slots), each)), "at long, rows long, l long, l1 long").groupBy("at").agg(*sums).toArrow()
        at, r, l, l1 = (got.column(c).to_numpy() for c in ("at", "rows", "l", "l1"))
        best = {"slot": slots[at // each], "feature": drawn.ravel()[at], "value": cuts[at], "rows": r, "l": l, "l1": l1}
        n, ones = n_of[best["slot"]], ones_of[best["slot"]]
        best["after"] = np.where(l < n, impurity_after(l, l1, n, ones, rules.criterion), np.inf)
        order = np.lexsort((best["value"], best["feature"], best["after"], best["slot"]))
        order = order[np.diff(best["slot"][order], prepend=-1) != 0]
        best = {c: v[order] for c, v in best.items()}
    else:
        # a feature of a node has a bounded number of bins
        along = Window.partitionBy("slot", "feature").orderBy("bin")
        summed = counted.select("slot", "feature", "bin", "low", "high", *[F.sum(c).over(along).alias(c) for c in ("rows", "l", "l1")], *[
            (F.sum(c).over(along) - F.col(c)).alias(b) for c, b in (("rows", "before_rows"), ("l", "before"), ("l1", "before1"))])
        bins = materialize(summed.mapInArrow(bound, schema(summed, "after double, least double")), "forest-bins")
        reach = bins.groupBy("slot").agg(F.min("after").alias("reach"))
        # what rounding may hide is opened too
        inside = materialize(bins.where("low < high").join(reach, "slot").where("least <= reach + 1e-9").select(
            "slot", "feature", "bin", "before_rows", "before", "before1"), "forest-open")
        got = inside.select("slot", "feature", "bin").toArrow()
        slot, f, b = (got.column(c).to_numpy() for c in ("slot", "feature", "bin"))
        rated = bins.select("slot", "feature", F.col("high").alias("value"), "rows", "l", "l1")
        if len(slot):
            place = np.full((len(slots), width), -1)
            np.put_along_axis(place, drawn, np.tile(np.arange(each), (len(slots), 1)), axis=1)
            opened = np.zeros((len(slots), each * BINS), dtype=bool)
            opened[number[slot], place[number[slot], f] * BINS + b] = True
            values = rows.mapInArrow(open_values(opened), "slot long, feature long, bin long, value double, rows long, l long, l1 long").groupBy(
                "slot", "feature", "bin", "value").agg(*sums)
            within = running_sums(values, ["slot", "feature", "bin"], "value", ["rows", "l", "l1"], "forest-values").join(inside, ["slot", "feature", "bin"])
            rated = rated.unionByName(within.select("slot", "feature", "value", *[
                (F.col(c) + F.col(before)).alias(c) for c, before in (("rows", "before_rows"), ("l", "before"), ("l1", "before1"))]))
        rated = rated.mapInArrow(rate, schema(rated, "after double"))
        got = rated.groupBy("slot").agg(F.min(F.struct("after", "feature", "value", "rows", "l", "l1")).alias("b")).select("slot", "b.*").toArrow()
        best = {c: got.column(c).to_numpy() for c in got.column_names}
    cut = np.isfinite(best["after"])
    for c in found:
        found[c][best["slot"][cut]] = best[c][cut]


# ----- scoring ----------------------------------------------------------------------------------

@dataclass
class Forest:
    nodes: DataFrame  # (by, tree, piece, node, depth, feature, cut, left, right, n, ones, decrease)
    by: list[str]
    rules: Rules
    top: _Top
    piece_rows: int  # most training rows of a piece

    @property
    def layered(self) -> bool:
        """Whether some trees have more than one piece."""
        return bool((self.top.kind == SPLIT).any())

    @cached_property
    def _few(self) -> _Top | None:
        """All nodes, if they are few enough to be sent to the rows."""
        if self.nodes.limit(SENT_NODES + 1).count() > SENT_NODES:
            return None
        got = self.nodes.select(*self.by, "tree", "node", "feature", "cut", "left", "right", "n", "ones").toArrow()
        units: dict[tuple, int] = {}
        of = [units.setdefault(u, len(units)) for u in zip(*[got.column(c).to_pylist() for c in self.by])] if self.by else [units.setdefault((), 0)] * len(got)
        tree, node = got.column("tree").to_pylist(), got.column("node").to_pylist()
        place = {key: k for k, key in enumerate(zip(of, tree, node))}
        child = lambda c: [place[u, t, v] if v is not None else -1 for u, t, v in zip(of, tree, got.column(c).to_pylist())]
        out = _Top(units, np.full((len(units), self.rules.n_trees), -1), True)
        out.add(node=np.array(node, dtype=np.int64), feature=got.column("feature").to_numpy(), cut=got.column("cut").fill_null(np.nan).to_numpy(),
                left=np.array(child("left"), dtype=np.int64), right=np.array(child("right"), dtype=np.int64), n=got.column("n").to_numpy(), ones=got.column("ones").to_numpy())
        for (u, t, v), k in place.items():
            if v == ROOT:
                out.root[u, t] = k
        return out

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``score``, the mean share of class 1 over the trees; rows of a unit without trees are left out."""
        for c in self.by:
            df = df.where(F.col(c).isNotNull())
        if self._few is None:
            rows = materialize(df.withColumn("_id", F.monotonically_increasing_id()), "forest-scored")
            return rows.join(self._means(rows.select(F.col("_id").alias("id"), *self.by, vector_to_array("features").alias("x"))), "_id").drop("_id")
        few, by, trees = self._few, self.by, self.rules.n_trees
        share = np.append(few.ones / np.maximum(few.n, 1), 0.0)

        def mean(*columns: pa.Array) -> pa.Array:
            table = pa.table([*columns], names=["x", *by])
            unit, x = _unit_numbers(table, by, few.units), _matrix(table.column("x"))
            total, count = np.zeros(len(unit)), np.zeros(len(unit))
            for tree in range(trees):
                at = few.slots(unit, tree, x)
                total += share[at]
                count += at >= 0
            return pa.array(total / np.maximum(count, 1), mask=count == 0)

        # said not to repeat, so that it runs once a row and not once for the filter too
        score = F.arrow_udf(mean, "double").asNondeterministic()
        return df.withColumn("score", score(vector_to_array("features"), *[F.col(c) for c in by])).where("score is not null")

    def _means(self, rows: DataFrame) -> DataFrame:
        """``(_id, score)`` for ``rows`` of ``(id, by, x)``, of a forest of many nodes."""
        by, rules, top = self.by, self.rules, replace(self.top, scoring=True)
        each = max(1, CHUNK_ROWS // max(1, self.piece_rows))  # whole trees of a small unit in a chunk
        small = np.flatnonzero(top.kind == SMALL)
        small = small[np.lexsort((top.tree[small], top.unit[small]))]
        top.chunk[small] = rules.n_trees + (np.cumsum(top.rows[small]) - top.rows[small]) // CHUNK_ROWS
        share = np.append(np.where(top.kind == LEAF, top.ones / np.maximum(top.n, 1), 0.0), 0.0)
        leaf, chunk, unknown = np.append(top.kind == LEAF, False), np.append(top.chunk, -1), -2  # a chunk that does not exist
        # a unit's chunks are its own: the first ones of a unit without upper nodes, or those of its small nodes
        keep = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in by]

        def visit(batches):
            for table in _blocks(batches, 10_000):
                unit, x = _unit_numbers(table, by, top.units), _matrix(table.column("x"))
                total, count = np.zeros(len(unit)), np.zeros(len(unit), dtype=np.int64)
                seen = np.empty((len(unit), rules.n_trees), dtype=np.int64)
                for tree in range(rules.n_trees):
                    at = top.slots(unit, tree, x)
                    total += share[at]
                    count += leaf[at]
                    seen[:, tree] = np.where(unit < 0, tree // each, chunk[at])
                seen.sort(axis=1)
                new = np.concatenate([np.ones((len(seen), 1), bool), seen[:, 1:] != seen[:, :-1]], axis=1)
                # a row without any chunk goes to one that does not exist; what it has from leaves above goes along once
                row, j = np.nonzero(new & ((seen >= 0) | ((seen < 0).all(axis=1)[:, None] & (np.arange(rules.n_trees) == 0))))
                lead = np.diff(row, prepend=-1) != 0
                some = table.take(pa.array(row))
                to = np.where(seen[row, j] < 0, unknown, seen[row, j])
                columns = [*[some.column(c) for c in by], some.column("id"), some.column("x"), pa.array(to), pa.array(np.where(lead, total[row], 0.0)),
                           pa.array(np.where(lead, count[row], 0))]
                yield from pa.table(columns, names=[*by, "id", "x", "chunk", "total", "count"]).to_batches(max_chunksize=10_000)

        places = {(int(top.unit[k]), int(top.tree[k]), int(top.node[k])): int(top.chunk[k]) for k in small}

        def place(batches):
            for batch in batches:
                if batch.num_rows:
                    unit = _unit_numbers(pa.Table.from_batches([batch]), by, top.units)
                    tree, piece = batch.column("tree").to_numpy(), batch.column("piece").to_numpy()
                    key = np.unique(np.stack([unit, tree, piece]), axis=1, return_inverse=True)
                    to = np.array([t // each if u < 0 else places.get((u, t, p), -1) for u, t, p in key[0].T.tolist()])[key[1].ravel()]
                    yield batch.append_column("chunk", pa.array(to))

        sent = rows.mapInArrow(visit, ", ".join([*keep, "id long, x array<double>, chunk long, total double, count long"]))
        key = [*by, "chunk"]
        counts = materialize(sent.groupBy(*key).agg(F.count("*").alias("rows")), "forest-chunks")
        salts = F.ceil(F.col("rows") / rules.group_rows).cast("long")
        salted = join_counted(sent, counts, key, "rows").withColumn("salt", F.pmod(F.xxhash64("id"), salts)).drop("rows")
        names = ["tree", "node", "feature", "cut", "left", "right", "n", "ones"]
        nodes = self.nodes.select(*by, "piece", *names)
        placed = nodes.mapInArrow(place, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields] + ["chunk long"])).where("chunk >= 0")
        copies = placed.join(counts, key).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).select(*key, "salt", *names)
        parts = salted.groupBy(*key, "salt").cogroup(copies.groupBy(*key, "salt")).applyInArrow(_descend(by, rules, top, chunk), "id long, total double, count long")
        return parts.groupBy(F.col("id").alias("_id")).agg((F.sum("total") / F.sum("count")).alias("score"), F.sum("count").alias("n")).where("n > 0").drop("n")

    def importance_rows(self) -> DataFrame:
        """``(by, feature, importance)``: the decrease of impurity, as a share of each tree's, averaged over trees."""
        used = self.nodes.where("feature >= 0").groupBy(*self.by, "tree", "feature").agg(F.sum("decrease").alias("d"))
        total = used.groupBy(*self.by, "tree").agg(F.sum("d").alias("all"))
        return used.join(total, [*self.by, "tree"]).groupBy(*self.by, "feature").agg(
            (F.sum(F.when(F.col("all") > 0, F.col("d") / F.col("all")).otherwise(0.0)) / self.rules.n_trees).alias("importance"))

    def importances(self, columns: list[str]) -> list[tuple[str, float]]:
        """One number for each feature, summed up for a forest of one unit."""
        found = {r["feature"]: r["importance"] for r in self.importance_rows().groupBy("feature").agg(F.avg("importance").alias("importance")).collect()}
        total = sum(found.values()) or 1.0
        return [(c, found.get(k, 0.0) / total) for k, c in enumerate(columns)]


def _descend(by: list[str], rules: Rules, top: _Top, chunk: np.ndarray):
    """Sum and number of the shares of class 1 of each row over the trees of one chunk, added to what the row brings along."""
    def run(rows: pa.Table, nodes: pa.Table) -> pa.Table:
        n = rows.num_rows
        total, count = (rows.column(c).to_numpy().copy() for c in ("total", "count"))
        if n and nodes.num_rows:
            x, own, unit = _matrix(rows.column("x")), rows.column("chunk")[0].as_py(), _unit_numbers(rows.slice(0, 1), by, top.units).repeat(n)
            flat, width = x.ravel(), x.shape[1]
            tree, node = nodes.column("tree").to_numpy(), nodes.column("node").to_numpy()
            order = np.lexsort((node, tree))
            tree, node = tree[order], node[order]
            feature, cut = nodes.column("feature").to_numpy()[order], nodes.column("cut").fill_null(0.0).to_numpy()[order]
            left, right = (nodes.column(c).fill_null(0).to_numpy()[order] for c in ("left", "right"))
            share = nodes.column("ones").to_numpy()[order] / np.maximum(nodes.column("n").to_numpy()[order], 1)
            starts = np.flatnonzero(np.diff(tree, prepend=-1))
            for a, b in zip(starts, [*starts[1:], len(tree)]):
                ids, some = node[a:b], np.arange(n)
                if unit[0] >= 0:
                    at = top.slots(unit, int(tree[a]), x)
                    some = np.flatnonzero(chunk[at] == own)
                    begin = top.node[at[some]]
                else:
                    begin = np.full(n, ROOT)
                f, c, s = feature[a:b], cut[a:b], share[a:b]
                below = [np.searchsorted(ids, v[a:b]) for v in (left, right)]
                at, moving = np.searchsorted(ids, begin), np.arange(len(some))
                while len(moving := moving[f[at[moving]] >= 0]):
                    k = at[moving]
                    at[moving] = np.where(flat[some[moving] * width + f[k]] <= c[k], below[0][k], below[1][k])
                total[some] += s[at]
                count[some] += 1
        return pa.table({"id": rows.column("id"), "total": pa.array(total), "count": pa.array(count)})

    return run
