"""Exact substring deduplication by prefix-partitioned suffix trees.

A window is ``window`` consecutive words.  Words covered by a window that also starts elsewhere go.

1. Of each window, the 8-word prefix with the smallest hash is its anchor (winnowing: equal windows have
   the same anchor at the same place).  Anchors are counted over all texts; suffixes at anchors that occur
   once hold no repeat and go no further.
2. The suffixes that are left are partitioned by prefix, of variable length: by the anchor's 8 words as
   long as its group fits in memory (``GROUP`` suffixes), else by as many words as a window has.
3. In a group, suffixes are sorted by the words that follow (the suffix tree's leaves; common prefixes of
   neighbours are its internal nodes) and by the words before.  A window of ``j`` words before and the rest
   after an anchor is repeated when two suffixes share a node of that depth on both sides.  A prefix as long
   as a window is itself a deep node, so counting is enough there; the windows of one such prefix are
   dealt over as many tasks as its count asks for.
4. Marks go back to the texts, and covered words are dropped.

Texts that a task has seen before count as repeated whole.  Windows are compared by 32 bits for each of
their words and 64 bits for the anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscape.llm import wordhash as wh
from cellscape.llm.jaccard_join import _opens, _table_runs
from cellscape.llm.stage import BROADCAST_ROWS, Stages, small_batches
from cellscape.operators.skew import join_counted

ANCHOR = 8
#: Suffixes of a group, at 248 bytes each: 8 MB.
GROUP = 1 << 15
LONG = np.int64
COUNTED = 1 << 21


def _anchors(grams: np.ndarray, span: int) -> np.ndarray:
    """Leftmost smallest value of each run of ``span``, once each; by doubling, without a loop over runs."""
    n = len(grams) - span + 1
    if n <= 0:
        return np.empty(0, LONG)
    best, have = np.arange(len(grams)), 1
    while have < span:
        step = min(have, span - have)
        a, b = best[: len(best) - step], best[step:]
        best = np.where(grams[b] < grams[a], b, a)
        have += step
    return np.unique(best[:n])


def _texts(batch: pa.RecordBatch, window: int):
    """Row, word hashes and anchors of each text that has a window."""
    span = window - ANCHOR + 1
    for row, data, bounds in wh.chunks(batch.column("text")):
        words = wh.scan(data, bounds)
        for t in np.flatnonzero(words.counts() >= window):
            h = words.hash[words.first[t]: words.first[t + 1]]
            grams = wh.fold(h, ANCHOR)
            at = _anchors(grams, span)
            yield row + int(t), h, at, grams[at]


def count_anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def out() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values.view(LONG)), pa.array(counts.astype(LONG))], ["anchor", "n"])

        for batch in batches:
            for _, _, _, marks in _texts(batch, window):
                held.append(marks)
                total += len(marks)
            if total >= COUNTED:
                yield out()
                held, total = [], 0
        if held:
            yield out()

    return run


SUFFIX = "key long, deep boolean, k1 long, k2 long, pos int, words int, around binary"


def suffixes(window: int, repeated):
    """Suffixes at repeated anchors, with the words around; whole copies in the task are reported once more."""
    before = window - ANCHOR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = repeated.value if repeated is not None else (None, None)
        seen: dict[tuple[int, int], bool] = {}
        for batch in batches:
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            rows: list[tuple] = []
            for row, h, at, marks in _texts(batch, window):
                key = (int(k1[row]), int(k2[row]))
                if key in seen:
                    if not seen[key]:
                        seen[key] = True
                        rows.append((0, True, *key, -1, len(h), None))
                    continue
                seen[key] = False
                if known is not None:
                    place = np.searchsorted(known, marks)
                    place[place == len(known)] = 0
                    live = known[place] == marks
                    at, marks, number = at[live], marks[live], counts[place[live]]
                else:
                    table = dict(zip(batch.column("anchors")[row].as_py() or [], batch.column("counts")[row].as_py() or []))
                    number = np.array([table.get(int(m), 0) for m in marks.view(LONG)], dtype=LONG)
                    at, marks, number = at[number > 1], marks[number > 1], number[number > 1]
                if not len(at):
                    continue
                small = (h >> np.uint64(32)).astype(np.uint32)
                wide = np.concatenate([np.zeros(before, np.uint32), small, np.zeros(window, np.uint32)])
                around = wide[at[:, None] + np.arange(before + window)]
                for a, m, c, w in zip(at, marks.view(LONG), number, around):
                    if c <= GROUP:
                        rows.append((int(m), False, *key, int(a), len(h), w.tobytes()))
                hot = at[number > GROUP]
                if len(hot):
                    full = wh.fold(h, window).view(LONG)
                    starts = np.unique((hot[:, None] - np.arange(before + 1)).ravel())
                    starts = starts[(starts >= 0) & (starts < len(full))]
                    rows.extend((int(full[s]), True, *key, int(s), len(h), None) for s in starts)
            kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["key", "deep", "k1", "k2", "pos", "words", "around"])

    return run


def _nodes(key: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of (key, words), and for each neighbour pair the depth of the node above both (-1: other key)."""
    order = np.lexsort([*words.T[::-1], key])
    k, w = key[order], words[order]
    same = w[1:] == w[:-1]
    depth = np.where(same.all(axis=1), words.shape[1], np.argmin(same, axis=1))
    depth[k[1:] != k[:-1]] = -1
    return order, depth


def _class(order: np.ndarray, depth: np.ndarray, at: int) -> np.ndarray:
    """Number of the tree node of depth ``at`` (or leaf) above each suffix."""
    out = np.empty(len(order), dtype=LONG)
    out[order] = np.concatenate([[0], np.cumsum(depth < at)])
    return out


def repeats(window: int):
    """Marks (k1, k2, pos, mask): bit j says that the window j words before ``pos`` starts elsewhere too."""
    before = window - ANCHOR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _table_runs(batches, ["key"], 1 << 15):
            key, pos, words = (table.column(c).to_numpy() for c in ("key", "pos", "words"))
            around = np.frombuffer(b"".join(table.column("around").to_pylist()), dtype=np.uint32).reshape(len(key), before + window)
            right = _nodes(key, around[:, before:])
            left = _nodes(key, around[:, :before][:, ::-1])
            mask = np.zeros(len(key), dtype=LONG)
            for j in range(before + 1):
                fits = np.flatnonzero((pos >= j) & (pos - j + window <= words))
                both = _class(*right, window - j)[fits] * (len(key) + 1) + _class(*left, j)[fits]
                _, which, number = np.unique(both, return_inverse=True, return_counts=True)
                mask[fits[number[which] > 1]] |= 1 << j
            hit = pa.array(mask > 0)
            yield pa.RecordBatch.from_arrays(
                [table.column(c).combine_chunks().filter(hit) for c in ("k1", "k2", "pos")] + [pa.array(mask[mask > 0])],
                ["k1", "k2", "pos", "mask"])

    return run


def strip(window: int):
    """Rows of texts and their marks to what is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            texts, marks = batch.column("text"), batch.column("marks")
            for doc, text, own in zip(batch.column("doc_id").to_pylist(), texts, marks):
                words = (text.as_py() or "").encode().split()
                n = len(words)
                own = own.as_py()
                if own and n >= window:
                    edge = np.zeros(n + 1, dtype=LONG)
                    for m in own:
                        if m["pos"] < 0:
                            edge[0] += 1
                            edge[n] -= 1
                            continue
                        j = np.flatnonzero((m["mask"] >> np.arange(window)) & 1)
                        np.add.at(edge, m["pos"] - j, 1)
                        np.add.at(edge, m["pos"] - j + window, -1)
                    keep = np.cumsum(edge[:n]) == 0
                    words = [words[k] for k in np.flatnonzero(keep)]
                out.append((doc, n, n - len(words), b" ".join(words).decode()))
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int64(), pa.int64(), pa.string()])],
                ["doc_id", "n_words", "n_removed", "kept"])

    return run


def strip_repeats(docs: DataFrame, window: int = 35, broadcast_rows: int = 2 * BROADCAST_ROWS) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``, one row for each row of ``docs(doc_id, text)``.

    Words are split at ASCII white space and compared unchanged; ``kept`` has the words that no repeated
    window covers, joined by one space.  Null or empty text: no words.  Null or repeated ``doc_id``: each
    row is a document of its own, so equal rows repeat each other.  Empty table: empty result.  Other
    columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    stages = Stages(spark, "substrings")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("k1"),
                        F.xxhash64("text", F.lit(7)).alias("k2"))
    counts = stages.store(plain.select("text").mapInArrow(count_anchors(window), "anchor long, n long")
                          .groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1"), "anchors")
    if counts.count() <= broadcast_rows:
        known = counts.toArrow()
        anchor = known["anchor"].to_numpy().astype(LONG).view(np.uint64)
        order = np.argsort(anchor)
        shared = spark.sparkContext.broadcast((np.append(anchor[order], np.uint64(2**64 - 1)),
                                               np.append(known["n"].to_numpy().astype(LONG)[order], 0)))
        del known, anchor, order
        found = plain.select("text", "k1", "k2").mapInArrow(suffixes(window, shared), SUFFIX)
    else:
        places = (plain.select("text", "k1", "k2").mapInArrow(_places(window), "k1 long, k2 long, anchor long")
                  .dropDuplicates().join(counts, "anchor").groupBy("k1", "k2")
                  .agg(F.collect_list("anchor").alias("anchors"), F.collect_list("n").alias("counts")))
        found = (plain.select("text", "k1", "k2").join(places, ["k1", "k2"]).select("text", "k1", "k2", "anchors", "counts")
                 .mapInArrow(suffixes(window, None), SUFFIX))
    found = stages.store(found, "suffixes")
    tree = (found.where("not deep").select("key", "k1", "k2", "pos", "words", "around").repartition("key").sortWithinPartitions("key")
            .mapInArrow(repeats(window), "k1 long, k2 long, pos int, mask long"))
    deep = found.where("deep and pos >= 0").select("key", "k1", "k2", "pos")
    often = stages.store(deep.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "often")
    shown = join_counted(deep, often, ["key"], "n", GROUP)
    whole = found.where("pos < 0").select("k1", "k2", F.lit(-1).alias("pos"), F.lit(0).cast("long").alias("mask"))
    marks = (tree.unionByName(shown.select("k1", "k2", "pos", F.lit(1).cast("long").alias("mask")))
             .unionByName(whole).dropDuplicates().groupBy("k1", "k2").agg(F.collect_list(F.struct("pos", "mask")).alias("marks")))
    marks = stages.store(marks, "marks")
    return plain.join(marks, ["k1", "k2"], "left").select("doc_id", "text", "marks").mapInArrow(
        strip(window), "doc_id long, n_words long, n_removed long, kept string")


def _places(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            for row, _, _, marks in _texts(batch, window):
                key = (int(k1[row]), int(k2[row]))
                if key not in seen:
                    seen.add(key)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(marks), key[0])), pa.array(np.full(len(marks), key[1])), pa.array(marks.view(LONG))],
                        ["k1", "k2", "anchor"])

    return run
