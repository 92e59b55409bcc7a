"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document is the set of its word shingles.  Two sets with Jaccard similarity of at least ``percent`` / 100
share at least ``l`` of their first ``n - ceil(percent * n / 100) + l`` shingles, in any order of shingles
that is the same for all.  Each document picks its own ``l``: it lengthens its prefix while the estimated
cost of its candidates falls, and a pair needs the smaller ``l`` of its two ends (Wang, Li and Feng, "Can
we beat the prefix filtering?", 2012).

1. ``signatures``: set sizes and 128-bit set signatures; each task also reports the shingles that are
   frequent in it.  The most frequent ones (at most ``HOT_SHINGLES``) come last in the order.  That list
   is a heuristic of bounded size: a shingle missing from it costs time, no result.
2. Prefix shingles meet in one shuffle.  Rare ones give pairs at once.  Frequent ones are first compared
   with one leader of each length class, so that a large group of near copies becomes one component in
   one step; only pairs between components remain, made in blocks of bounded size.
3. Candidates are sifted by parity bitmaps (Sandes et al., "A bitmap filter for set similarity joins"),
   which never reject a pair that links, and verified on whole sets.  Equal sets are one node throughout.

Shingles are compared by 64-bit hashes, equal sets by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscape.llm import wordhash as wh
from cellscape.llm.encoder import forget
from cellscape.llm.stage import BROADCAST_ROWS, Stages, small_batches
from cellscape.operators.components import contract

HOT_SHINGLES = 1 << 19
HOT_ROWS = 64
LOCAL_HOT = 8
LOCAL_HASHES = 1 << 22
MAX_MATCHES = 8
VERIFY_COST = 20.0
BLOCK = 512
BITMAP_WORDS = 16
LONG = np.int64


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingles of each text of a batch."""
    for row, data, bounds in wh.chunks(batch.column("text")):
        marks, first = wh.shingles(wh.scan(data, bounds, wh.WHITE, lower=True), size)
        for t in range(len(bounds) - 1):
            yield row + t, np.unique(marks[first[t]: first[t + 1]])


def _sign(marks: np.ndarray) -> tuple[int, int]:
    a = int(np.add.reduce(wh.mix(marks ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64).astype(LONG))
    b = int(np.add.reduce(wh.mix(marks + np.uint64(0x14057B7EF767814F)), dtype=np.uint64).astype(LONG))
    return a, b


def signatures(size: int):
    """Rows (doc_id, n, s1, s2, bits), and (null, count, shingle, null, null) for frequent shingles of the task."""
    schema = "doc_id long, n int, s1 long, s2 long, bits binary"

    def hot(held: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        keep = counts >= LOCAL_HOT
        none = pa.nulls(int(keep.sum()), pa.int64())
        return pa.RecordBatch.from_arrays(
            [none, pa.array(counts[keep].astype(np.int32)), pa.array(values[keep].view(LONG)), none, pa.nulls(len(none), pa.binary())],
            ["doc_id", "n", "s1", "s2", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        held: list[np.ndarray] = []
        seen: set[int] = set()
        total = 0
        for batch in batches:
            n, s1, s2 = (np.zeros(batch.num_rows, LONG) for _ in range(3))
            bits: list[bytes] = [b""] * batch.num_rows
            for row, marks in _sets(batch, size):
                n[row] = len(marks)
                if len(marks):
                    s1[row], s2[row] = _sign(marks)
                    bits[row] = _bitmap(marks)
                    if s1[row] not in seen:
                        seen.add(s1[row])
                        held.append(marks)
                        total += len(marks)
                if total > LOCAL_HASHES:
                    yield hot(held)
                    held, total = [], 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n.astype(np.int32)), pa.array(s1), pa.array(s2), pa.array(bits, pa.binary())],
                ["doc_id", "n", "s1", "s2", "bits"])
        if held:
            yield hot(held)

    return run, schema


PREFIX = "token long, salt int, node long, n int, ell int, score float"


def prefixes(size: int, percent: int, hot_tokens, hot_counts):
    """Prefix shingles of each distinct set of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, weights = hot_tokens.value, hot_counts.value
        door = np.zeros(1 << 20, dtype=bool)
        door[(tokens >> np.uint64(44)).astype(LONG)] = True
        seen: set[int] = set()
        ells = np.arange(1, MAX_MATCHES + 1)
        for batch in batches:
            parts: list[tuple] = []
            for _, marks in _sets(batch, size):
                n = len(marks)
                if not n:
                    continue
                node = _sign(marks)[0]
                if node in seen:
                    continue
                seen.add(node)
                least = (percent * n + 99) // 100
                weight = np.zeros(n)
                maybe = np.flatnonzero(door[(marks >> np.uint64(44)).astype(LONG)])
                if len(maybe):
                    at = np.searchsorted(tokens, marks[maybe])
                    at[at == len(tokens)] = 0
                    weight[maybe] = np.where(tokens[at] == marks[maybe], weights[at], 0)
                order = np.argsort(weight, kind="stable")
                ell, length = 1, n - least + 1
                if weight[order[length - 1]] > 0:
                    ls = ells[ells <= least]
                    lengths = n - least + ls
                    scanned = np.cumsum(weight[order])[lengths - 1]
                    ell = int(ls[np.argmin(lengths + scanned + VERIFY_COST * scanned / ls)])
                    length = n - least + ell
                chosen = order[:length]
                heavy = weight[chosen] > 0
                parts.append((marks[chosen], heavy, node, n, ell, float(weight.mean())))
            if not parts:
                continue
            lengths = [len(p[0]) for p in parts]
            heavy = np.concatenate([p[1] for p in parts])
            spread = lambda k, kind: np.repeat(np.array([p[k] for p in parts], dtype=kind), lengths)
            node = spread(2, LONG)
            salt = np.where(heavy, 1 + (node & 63), 0).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([p[0] for p in parts]).view(LONG)), pa.array(salt), pa.array(node),
                 pa.array(spread(3, np.int32)), pa.array(spread(4, np.int32)), pa.array(spread(5, np.float32))],
                ["token", "salt", "node", "n", "ell", "score"])

    return run


def _bitmap(marks: np.ndarray) -> bytes:
    """Parity of the shingles in each bucket: two sets differ in at least as many elements as bits.

    There are at least as many buckets as shingles, so that long sets are told apart as well as short ones.
    """
    width = min(max(64 * BITMAP_WORDS, 1 << (len(marks) - 1).bit_length()), 1 << 20)
    spot = (wh.mix(marks + np.uint64(77)) & np.uint64(width - 1)).astype(LONG)
    return np.packbits((np.bincount(spot, minlength=width) & 1).astype(np.uint8)).tobytes()


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The parities for fewer buckets."""
    while len(bits) > words:
        half = len(bits) // 2
        bits = bits[:half] ^ bits[half:]
    return bits


def _table_runs(batches: Iterator[pa.RecordBatch], keys: list[str], limit: int = 1 << 17) -> Iterator[pa.Table]:
    """Tables of whole runs of equal keys, from a sorted partition."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= limit:
            table = pa.Table.from_batches(held).combine_chunks()
            new = _opens(table, keys)
            last = int(np.flatnonzero(new)[-1])
            if last:
                yield table.slice(0, last)
                held = table.slice(last).to_batches()
                rows = table.num_rows - last
            else:
                limit = max(limit, 2 * rows)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _opens(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, dtype=bool)
    new[0] = True
    for k in keys:
        v = table.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return new


PAIRS = "token long, a long, b long, n int, ell int, score float"


def _pair_rows(a, b, need) -> pa.RecordBatch:
    low, high = np.minimum(a, b), np.maximum(a, b)
    none = len(low)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(none, pa.int64()), pa.array(low), pa.array(high), pa.nulls(none, pa.int32()),
         pa.array(need.astype(np.int32)), pa.nulls(none, pa.float32())],
        ["token", "a", "b", "n", "ell", "score"])


def meet(percent: int):
    """Pairs of nodes that share a rare prefix shingle; rows of frequent ones pass through."""

    def fits(na, nb):
        return (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _table_runs(batches, ["token", "salt"]):
            salt = table.column("salt").to_numpy()
            hot = np.flatnonzero(salt > 0)
            if len(hot):
                part = table.take(pa.array(hot))
                yield from pa.table(
                    {"token": part["token"], "a": part["node"], "b": pa.nulls(len(hot), pa.int64()), "n": part["n"],
                     "ell": part["ell"], "score": part["score"]}).to_batches()
            cold = np.flatnonzero(salt == 0)
            token, node, n, ell = (table.column(c).to_numpy()[cold] for c in ("token", "node", "n", "ell"))
            if len(token) < 2:
                continue
            fresh = np.ones(len(token), dtype=bool)  # copies of a set in other tasks
            fresh[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
            token, node, n, ell = token[fresh], node[fresh], n[fresh], ell[fresh]
            starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            sizes = np.diff(np.append(starts, len(token)))
            for m in np.unique(sizes[sizes > 1]):
                at = starts[sizes == m]
                if m <= 64:
                    i, j = np.triu_indices(m, 1)
                    step = max(1, (1 << 19) // len(i))
                    for s in range(0, len(at), step):
                        x = (at[s: s + step, None] + i).ravel()
                        y = (at[s: s + step, None] + j).ravel()
                        ok = fits(n[x], n[y])
                        yield _pair_rows(node[x[ok]], node[y[ok]], np.minimum(ell[x[ok]], ell[y[ok]]))
                else:
                    for s in at:
                        for x in range(s, s + m):
                            y = np.arange(x + 1, s + m)
                            y = y[fits(n[x], n[y])]
                            if len(y):
                                yield _pair_rows(np.full(len(y), node[x]), node[y], np.minimum(ell[x], ell[y]))

    return run


def cross(percent: int, within: bool):
    """Pairs of two blocks of one frequent shingle that lie in different components and pass the bitmaps."""
    keys = ["token", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _table_runs(batches, keys):
            starts = np.append(np.flatnonzero(_opens(table, keys)), table.num_rows)
            node, n, ell, comp, blk, i, j = (table.column(c).to_numpy() for c in ("node", "n", "ell", "comp", "blk", "i", "j"))
            bits = _bit_rows(table.column("bits"))
            for lo, hi in zip(starts[:-1], starts[1:]):
                rows = np.arange(lo, hi)
                left, right = rows[blk[rows] == i[lo]], rows[blk[rows] == j[lo]]
                for x in left:
                    y = right if i[lo] != j[lo] else right[right > x]
                    y = y[node[y] != node[x]] if within else y[comp[y] != comp[x]]
                    y = y[100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])]
                    if not len(y):
                        continue
                    apart = np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1, dtype=LONG)
                    y = y[_may_link(apart, n[y].astype(LONG) + n[x], percent)]
                    if len(y):
                        yield _pair_rows(np.full(len(y), node[x]), node[y], np.minimum(ell[x], ell[y]))

    return run


def _bit_rows(column) -> np.ndarray:
    return np.stack([_folded(np.frombuffer(raw, dtype=np.uint64), BITMAP_WORDS) for raw in column.to_pylist()])


def _may_link(apart: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """False only for pairs below the similarity: of a link's elements, so many at most are in one set alone."""
    return (100 + percent) * apart <= (100 - percent) * total


def sift(percent: int):
    """The pairs that their bitmaps do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = np.zeros(batch.num_rows, dtype=LONG)
            for k, (x, y) in enumerate(zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist())):
                words = min(len(x), len(y)) // 8
                x, y = _folded(np.frombuffer(x, np.uint64), words), _folded(np.frombuffer(y, np.uint64), words)
                apart[k] = np.bitwise_count(x ^ y).sum(dtype=LONG)
            total = batch.column("na").to_numpy().astype(LONG) + batch.column("nb").to_numpy()
            yield batch.filter(pa.array(_may_link(apart, total, percent))).select(["a", "b", "shared", "need"])

    return run


def set_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets = [], []
            for _, marks in _sets(batch, size):
                if len(marks):
                    nodes.append(_sign(marks)[0])
                    sets.append(marks.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], ["node", "marks"])

    return run


def check_pairs(percent: int):
    """Verified pairs, from rows sorted so that the set of ``a`` comes before its partners' sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, mine = None, None
        for batch in batches:
            a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
            kind = batch.column("kind").to_numpy()
            out_a, out_b = [], []
            for k, raw in enumerate(batch.column("marks")):
                marks = np.frombuffer(raw.as_buffer(), dtype=np.uint64)
                if kind[k] == 0:
                    own, mine = a[k], marks
                elif own == a[k]:
                    at = np.searchsorted(mine, marks)
                    at[at == len(mine)] = 0
                    both = int((mine[at] == marks).sum())
                    if 100 * both >= percent * (len(mine) + len(marks) - both):
                        out_a.append(a[k])
                        out_b.append(b[k])
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    return run


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that link.  The set of a node with many partners is copied to 16 parts."""
    few = F.least(F.col("partners"), F.lit(16))
    number = pairs.groupBy("a").agg(F.count("*").alias("partners"))
    mine = (sets.join(number.withColumnRenamed("a", "node"), "node")
            .select(F.col("node").alias("a"), F.explode(F.sequence(F.lit(0), F.when(F.col("partners") < 64, 0)
                    .otherwise(few.cast("int") - 1))).alias("part"), F.col("node").alias("b"),
                    F.lit(0).alias("kind"), "marks"))
    theirs = (pairs.join(number, "a").join(sets.withColumnRenamed("node", "b"), "b")
              .select("a", F.when(F.col("partners") < 64, 0).otherwise(F.pmod(F.xxhash64("b"), F.lit(16)).cast("int"))
                      .alias("part"), "b", F.lit(1).alias("kind"), "marks"))
    return (mine.unionByName(theirs).repartition("a", "part").sortWithinPartitions("a", "part", "kind")
            .mapInArrow(check_pairs(percent), "a long, b long"))


def similar_components(docs: DataFrame, size: int = 5, percent: int = 80, all_links: bool = False) -> tuple[DataFrame, DataFrame]:
    """Components of documents under "shares at least ``percent`` % of its word shingles".

    ``docs`` needs ``doc_id long`` and ``text string``; other columns are ignored.  Returns
    ``(doc_id, n_shingles, component_id)``, one row for each input row, and the verified links
    ``(a, b)`` between smallest ids of equal sets.  By default, links are only searched between
    documents that are not connected yet; ``all_links`` finds every link.

    Null or empty text: no shingles, linked with nothing.  A null ``doc_id`` links and counts like any
    other, but is never a component's id unless all its members' ids are null.  Rows that share a
    ``doc_id`` are taken one by one; equal sets are always linked.  Empty table: empty results.
    """
    spark = docs.sparkSession
    small_batches(spark)
    stages = Stages(spark, "jaccard")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    run, schema = signatures(size)
    first = stages.store(plain.mapInArrow(run, schema), "signatures")
    base = first.where("s2 is not null")
    top = (first.where("s2 is null and n is not null").groupBy("s1").agg(F.sum("n").alias("c")).where(F.col("c") >= HOT_ROWS)
           .orderBy(F.desc("c"), "s1").limit(HOT_SHINGLES).toArrow())
    token = top["s1"].to_numpy().astype(LONG).view(np.uint64)
    order = np.argsort(token)
    context = spark.sparkContext
    hot_tokens = context.broadcast(np.append(token[order], np.uint64(2**64 - 1)))
    hot_counts = context.broadcast(np.append(top["c"].to_numpy().astype(float)[order], 0.0))

    met = stages.store(
        plain.mapInArrow(prefixes(size, percent, hot_tokens, hot_counts), PREFIX)
        .repartition("token", "salt").sortWithinPartitions("token", "salt", "node")
        .mapInArrow(meet(percent), PAIRS), "met")
    hot_tokens.destroy()
    hot_counts.destroy()
    reps = (base.where("n > 0").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"), F.first("bits").alias("bits")))
    reps = stages.store(reps, "reps")
    bits = reps.select(F.col("s1").alias("node"), "n", "bits")
    heavy = stages.store(met.where("token is not null").select("token", F.col("a").alias("node"), "n", "ell", "score")
                         .dropDuplicates(["token", "node"]), "heavy")

    # one leader for each frequent shingle and length class
    width = float(np.log(100 / percent))
    classed = heavy.select("token", "node", F.floor(F.log(F.col("n").cast("double")) / width).alias("cls"), "score")
    leaders = classed.groupBy("token", "cls").agg(F.max(F.struct("score", "node")).alias("top"))
    stars = (classed.join(leaders, ["token", "cls"]).where("node <> top.node")
             .select(F.least("node", "top.node").alias("a"), F.greatest("node", "top.node").alias("b"),
                     F.lit(1).cast("long").alias("shared"), F.lit(1).alias("need")).distinct())
    pairs = (met.where("token is null").groupBy("a", "b").agg(F.count("*").alias("shared"), F.max("ell").alias("need"))
             .unionByName(stars))
    pairs = stages.store(_sifted(pairs, bits, percent), "pairs")

    involved = stages.store(
        pairs.select(F.col("a").alias("s1")).union(pairs.select("b")).union(heavy.select("node")).distinct()
        .join(reps, "s1").select(F.col("s1").alias("node"), "rep"), "involved")
    ids = involved.select(F.col("rep").alias("doc_id")).where("doc_id is not null").distinct()
    few = ids.count() <= BROADCAST_ROWS
    wanted = plain.join(F.broadcast(ids) if few else ids.hint("shuffle_merge"), "doc_id", "left_semi")
    if not involved.where("rep is null").isEmpty():
        wanted = wanted.unionByName(plain.where("doc_id is null"))
    sets = stages.store(wanted.mapInArrow(set_rows(size), "node long, marks binary").dropDuplicates(["node"]), "sets")

    tried = stages.store(pairs.where("shared >= need").select("a", "b").distinct(), "tried")
    links = stages.store(verify(tried, sets, percent), "links1")
    found = links

    if not heavy.isEmpty():
        root = _roots(links)
        members = (heavy.drop("n", "score").join(bits.dropDuplicates(["node"]), "node").join(root, "node", "left")
                   .withColumn("comp", F.coalesce("root", "node")).drop("root"))
        members = stages.store(members, "members")
        mixed = (members.groupBy("token").agg(F.count("*").alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                 .where(F.lit(True) if all_links else F.col("lo") != F.col("hi"))
                 .select("token", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")))
        dealt = (members.join(mixed, "token").withColumn("blk", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .select("token", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"), "blk", "node", "n",
                         "ell", "comp", "bits"))
        between = (dealt.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
                   .mapInArrow(cross(percent, all_links), PAIRS).groupBy("a", "b")
                   .agg(F.count("*").alias("shared"), F.max("ell").alias("need")))
        more = (between.unionByName(pairs.where("shared < need")).groupBy("a", "b")
                .agg(F.sum("shared").alias("shared"), F.max("need").alias("need")).where("shared >= need")
                .join(tried, ["a", "b"], "left_anti"))
        more = stages.store(_sifted(more, bits, percent).select("a", "b"), "more")
        found = links.union(stages.store(verify(more, sets, percent), "links2"))

    root = _roots(found)
    named = reps.join(root.withColumnRenamed("node", "s1"), "s1", "left").withColumn("root", F.coalesce("root", "s1"))
    named = stages.store(named, "named")
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    labels = named.join(smallest, "root").select("s1", "s2", "n", "component_id")
    out = (base.join(labels, ["s1", "s2", "n"], "left")
           .select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))
    rep = reps.groupBy("s1").agg(F.min("rep").alias("rep"))
    named_links = (found.join(rep.toDF("a", "ra"), "a").join(rep.toDF("b", "rb"), "b")
                   .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")))
    result = stages.store(out, "result")
    stages.drop("met", "sets", "heavy", "members", "pairs", "tried", "more", "involved")
    return result, named_links


def _sifted(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    return (pairs.join(bits.toDF("a", "na", "bits_a"), "a").join(bits.toDF("b", "nb", "bits_b"), "b")
            .mapInArrow(sift(percent), "a long, b long, shared long, need int"))


def _roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link to a smaller one."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    if edges.isEmpty():
        return edges.toDF("node", "root")
    return contract(edges, []).select(F.col("u").alias("node"), F.col("v").alias("root"))
