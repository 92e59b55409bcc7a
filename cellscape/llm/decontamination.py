"""Benchmark decontamination by the weighted Jaccard similarity of item-sized windows, exact.

1. One pass over the documents finds places of shingles that some item has (a window without any has
   similarity 0) and keeps the words around them; the same pass counts in how many documents each item
   shingle occurs.
2. A window at the threshold t shares at least t times the weight of the item with it.  Words around places
   that share less with every item go.
3. A second pass over the documents counts in how many of them each other shingle of the words left occurs.  A
   bitmap of those shingles keeps the rest of the documents out of the shuffle; the counts are joined back.
4. All windows as long as an item, over the words left, are compared with the items that step 2 left there,
   by running sums.  A shingle counts once in a window, at its first place, as in the item.

A shingle weighs log(1 + N / (1 + df)), df being the documents that have it.  Weights are whole multiples of
2**-36, so that running sums are exact.  Documents and items are lower-cased (A-Z) and split at ASCII white space.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscape.llm import wordhash as wh
from cellscape.llm.encoder import forget
from cellscape.llm.stage import Stages, small_batches
from cellscape.operators.skew import join_counted

SIZE = 5
#: Weights are multiples of 1 / SCALE.
SCALE = 1 << 36
#: Size of the bitmap of shingles to be counted.
FILTER_BITS = 26
#: More rows of one shingle than this are dealt over several tasks.
HOT_ROWS = 1_000
#: Items are taken in blocks of about so many characters, each broadcast in turn.
BLOCK_CHARS = 32_000_000
LONG = np.int64


class Items:
    """Shingles and words of a block of items."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.ids = [r[0] for r in rows]
        texts = pa.array([r[1] for r in rows], pa.string())
        self.length, self.shingles = [], []
        for _, data, bounds in wh.chunks(texts):
            words = wh.scan(data, bounds, wh.WHITE, lower=True)
            marks, first = wh.shingles(words, SIZE)
            self.length.extend(words.counts().tolist())
            self.shingles.extend(np.unique(marks[a:b]) for a, b in zip(first[:-1], first[1:]))
        self.known = np.unique(np.concatenate([*self.shingles, np.empty(0, np.uint64)]))
        self.door = np.zeros(1 << 20, dtype=bool)
        self.door[(self.known >> np.uint64(44)).astype(LONG)] = True
        self.places = [np.searchsorted(self.known, own) for own in self.shingles]
        #: The items that have shingle ``k`` are ``holders[holder[k]: holder[k + 1]]``.
        of = np.concatenate([*self.places, np.empty(0, LONG)]).astype(LONG)
        self.holders = np.repeat(np.arange(len(self.ids)), [len(x) for x in self.places])[np.argsort(of, kind="stable")]
        self.holder = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(self.known)))]).astype(LONG)
        self.short = sorted({n for n in self.length if 0 < n < SIZE})


def _found(items: Items, marks: np.ndarray) -> np.ndarray:
    """Places of ``marks`` among the items' shingles; -1 if absent."""
    out = np.full(len(marks), -1, dtype=LONG)
    maybe = np.flatnonzero(items.door[(marks >> np.uint64(44)).astype(LONG)])
    if len(maybe):
        at = np.searchsorted(items.known, marks[maybe])
        at[at == len(items.known)] = 0
        out[maybe] = np.where(items.known[at] == marks[maybe], at, -1)
    return out


def _marks_of(h: np.ndarray, n: int) -> np.ndarray:
    """Shingles at each start for windows of ``n`` words."""
    if n >= SIZE:
        return wh.fold(h, SIZE)
    return wh.mix(wh.fold(h, n) + np.uint64(n))


REGION = "doc_id long, doc_words int, start int, words binary, shingle int, n long"


def regions(items):
    """Words around shingles of items, for each document; and (shingle, n) document counts of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        own: Items = items.value
        reach = max(own.length, default=0)
        counts = np.zeros(len(own.known), dtype=LONG)
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            rows: list[tuple] = []
            for row, data, bounds in wh.chunks(batch.column("text")):
                words = wh.scan(data, bounds, wh.WHITE, lower=True)
                marks, first = wh.shingles(words, SIZE)
                place = _found(own, marks)
                some = np.add.reduceat(np.append(place >= 0, False), first[:-1]) > 0 if len(first) > 1 else np.empty(0, bool)
                some &= np.diff(first) > 0
                for t in range(len(bounds) - 1) if own.short else np.flatnonzero(some).tolist():
                    h = words.hash[words.first[t]: words.first[t + 1]]
                    hits, kinds = np.empty(0, LONG), np.empty(0, LONG)
                    if some[t]:
                        at = place[first[t]: first[t + 1]]
                        hits = np.flatnonzero(at >= 0)
                        kinds = at[hits]
                    for n in own.short:
                        if len(h) > n or (len(h) == n and n < SIZE and not some[t]):
                            at = _found(own, _marks_of(h, n))
                            hits = np.concatenate([hits, np.flatnonzero(at >= 0)])
                            kinds = np.concatenate([kinds, at[at >= 0]])
                    if not len(hits):
                        continue
                    counts[np.unique(kinds)] += 1
                    hits = np.unique(hits)
                    cut = np.flatnonzero(np.diff(hits) > 2 * reach)
                    for lo, hi in zip(hits[np.append(0, cut + 1)], hits[np.append(cut, len(hits) - 1)]):
                        a, b = max(0, int(lo) - reach), min(len(h), int(hi) + reach + SIZE)
                        rows.append((docs[row + t], len(h), a, h[a:b].tobytes(), None, None))
            yield _region_batch(rows)
        yield _region_batch([(None, None, None, None, int(k), int(counts[k])) for k in np.flatnonzero(counts)])

    return run


def _region_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.int64()]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      ["doc_id", "doc_words", "start", "words", "shingle", "n"])


def _weight(number: int, df: np.ndarray) -> np.ndarray:
    return np.rint(np.log1p(number / (1 + df)) * SCALE).astype(LONG)


def _previous(marks: np.ndarray) -> np.ndarray:
    """The place before each where the same shingle stands; -1 at its first."""
    order = np.argsort(marks, kind="stable")
    out = np.full(len(marks), -1, dtype=LONG)
    same = marks[order[1:]] == marks[order[:-1]]
    out[order[1:][same]] = order[:-1][same]
    return out


def _window_sums(values: np.ndarray, previous: np.ndarray, span: int) -> np.ndarray:
    """Sum of ``values`` over each ``span`` neighbours, a repeated shingle only at its first place in them."""
    sums = np.concatenate([[0], np.cumsum(values)])
    change = np.zeros(len(values) + 2, dtype=LONG)
    again = np.flatnonzero((previous >= 0) & (np.arange(len(values)) - previous < span))
    # the windows that hold both places start from again - span + 1 to previous
    np.subtract.at(change, np.maximum(again - span + 1, 0), values[again])
    np.add.at(change, previous[again] + 1, values[again])
    return sums[span:] - sums[:-span] + np.cumsum(change)[: len(values) - span + 1]


def _near(own: Items, weights: np.ndarray, totals: np.ndarray, h: np.ndarray, total: int, percent: int) -> Iterator[tuple]:
    """Items that share enough with words ``h`` of a document of ``total`` words.

    Yields (item, marks, places, words of a window, shingles of a window, first and last start of a window).
    """
    for m in sorted({*own.short, SIZE}):
        if len(h) < m:
            continue
        marks = _marks_of(h, m)
        places = _found(own, marks)
        at = np.flatnonzero(places >= 0)
        at = at[np.argsort(places[at], kind="stable")]
        kinds, first = np.unique(places[at], return_index=True)
        if not len(kinds):
            continue
        size = own.holder[kinds + 1] - own.holder[kinds]
        items = own.holders[np.arange(size.sum()) + np.repeat(own.holder[kinds] - np.cumsum(size) + size, size)]
        which = np.repeat(np.arange(len(kinds)), size)
        order = np.argsort(items, kind="stable")
        items, which = items[order], which[order]
        edges = np.concatenate([np.flatnonzero(np.diff(items, prepend=-1)), [len(items)]])
        shared = np.add.reduceat(weights[kinds[which]], edges[:-1])
        last = np.append(first[1:], len(at))
        least = totals * (percent / 100 * (1 - 1e-12))
        for e in np.flatnonzero(shared >= least[items[edges[:-1]]]):
            k = int(items[edges[e]])
            n = min(own.length[k], total)
            if len(h) < n or min(own.length[k], SIZE) != m or min(n, SIZE) != m:
                continue
            span = n - m + 1
            hits = np.sort(np.concatenate([at[first[w]: last[w]] for w in which[edges[e]: edges[e + 1]]]))
            cut = np.flatnonzero(np.diff(hits) >= span)
            for lo, hi in zip(np.append(0, cut + 1), np.append(cut, len(hits) - 1)):
                if weights[np.unique(places[hits[lo: hi + 1]])].sum() >= least[k]:
                    a, b = max(0, int(hits[lo]) - span + 1), min(int(hits[hi]), len(marks) - span)
                    if a <= b:
                        yield k, marks, places, n, span, a, b


REGION_COLUMNS = ("doc_id", "doc_words", "start", "words")
CANDIDATE = "doc_id long, doc_words int, start int, words binary, marks array<long>"


def _totals(own: Items, weights: np.ndarray) -> np.ndarray:
    return np.array([weights[p].sum() for p in own.places], dtype=LONG)


def candidates(items, weights, percent: int):
    """The regions that share enough with an item, and the shingles of their windows that no item has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = items.value, weights.value
        totals = _totals(own, known)
        for batch in batches:
            rows: list[tuple] = []
            for row in zip(*(batch.column(c).to_pylist() for c in REGION_COLUMNS)):
                asked = None
                for _, marks, places, _, span, a, b in _near(own, known, totals, np.frombuffer(row[3], dtype=np.uint64), row[1], percent):
                    if asked is None:
                        asked = {}
                    # all spans but those of short items are over the same marks; one shingle has no other
                    if span > 1:
                        asked.setdefault(0, (marks, np.zeros(len(marks) + 1, dtype=LONG), places))[1][[a, b + span]] += (1, -1)
                if asked is not None:
                    others = [np.unique(m[(np.cumsum(c)[:-1] > 0) & (p < 0)]) for m, c, p in asked.values()]
                    rows.append((*row, np.concatenate([*others, np.empty(0, np.uint64)]).view(LONG)))
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*REGION_COLUMNS, "marks"])

    return run


def frequencies(bitmap):
    """``(mark, n)``: in how many documents of a piece of the task each shingle of the bitmap stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: np.ndarray = bitmap.value
        for batch in batches:
            for _, data, bounds in wh.chunks(batch.column("text")):
                marks, first = wh.shingles(wh.scan(data, bounds, wh.WHITE, lower=True), SIZE)
                slot = marks & np.uint64((1 << FILTER_BITS) - 1)
                at = np.flatnonzero((bits[(slot >> np.uint64(6)).astype(LONG)] >> (slot & np.uint64(63))) & np.uint64(1))
                text = np.searchsorted(first, at, side="right")
                marks = marks[at]
                order = np.lexsort((text, marks))
                marks, text = marks[order], text[order]
                new = np.ones(len(marks), dtype=bool)
                new[1:] = (marks[1:] != marks[:-1]) | (text[1:] != text[:-1])
                value, n = np.unique(marks[new], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(LONG)), pa.array(n, pa.int64())], ["mark", "n"])

    return run


def _counted(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(block, region, others, dfs)``: the shingles of ``wanted(block, region, mark)`` that more than one document has."""
    spark = docs.sparkSession
    slot = F.col("mark").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    bit = F.expr("shiftleft(1L, cast(slot & 63 AS int))")
    words = (wanted.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("at")).agg(F.bit_or(bit).alias("bits"))).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    bits[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    df = (docs.mapInArrow(frequencies(spark.sparkContext.broadcast(bits)), "mark long, n long")
          .groupBy("mark").agg(F.sum("n").alias("df")).where("df > 1"))
    rows = wanted.groupBy("mark").agg(F.count("*").alias("rows"))
    return (join_counted(wanted, rows.join(df, "mark"), ["mark"], "rows", HOT_ROWS)
            .groupBy("block", "region").agg(F.collect_list(F.struct("mark", "df")).alias("m"))
            .select("block", "region", F.col("m.mark").alias("others"), F.col("m.df").alias("dfs")))


MATCH = "doc_id long, item_id long, start int, n_words int, similarity double"


def match(items, weights, number: int, percent: int):
    """The best window of each region for each item, from the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = items.value, weights.value
        totals = _totals(own, known)
        for batch in batches:
            out: list[tuple] = []
            for doc, total, start, raw, others, dfs in zip(*(batch.column(c).to_pylist() for c in (*REGION_COLUMNS, "others", "dfs"))):
                best: dict[int, tuple] = {}
                held = None
                for k, marks, places, n, span, a, b in _near(own, known, totals, np.frombuffer(raw, dtype=np.uint64), total, percent):
                    if held is None or held[0] is not marks:
                        value = np.full(len(marks), _weight(number, np.ones(1))[0])
                        value[places >= 0] = known[places[places >= 0]]
                        if others:
                            mark = np.array(others, dtype=LONG).view(np.uint64)
                            order = np.argsort(mark)
                            mark, df = mark[order], np.array(dfs)[order]
                            at = np.minimum(np.searchsorted(mark, marks), len(mark) - 1)
                            some = (places < 0) & (mark[at] == marks)
                            value[some] = _weight(number, df[at[some]])
                        held = marks, value, _previous(marks)
                    part = slice(a, b + span)
                    value, previous = held[1][part], held[2][part] - a
                    mine = _window_sums(value, previous, span)
                    both = _window_sums(np.where(np.isin(places[part], own.places[k]), value, 0), previous, span)
                    similarity = np.round(both / (mine + totals[k] - both), 9)
                    w = int(np.argmax(similarity))
                    if both[w] / (mine[w] + totals[k] - both[w]) * 100 >= percent - 1e-9:
                        row = (float(similarity[w]), -(start + a + w), n)
                        best[k] = max(best.get(k, row), row)
                out.extend((doc, own.ids[k], -at, size, s) for k, (s, at, size) in best.items())
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["doc_id", "item_id", "start", "n_words", "similarity"])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = 80, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(doc_id, item_id, start, n_words, similarity)``: the best window of each document for each item.

    A window has as many words as the item; a document shorter than the item is one window.  Items without
    words match nothing; null or empty texts have no match.  A null ``doc_id`` or ``item_id`` is kept as null.
    Rows that share a ``doc_id`` or ``item_id`` give one row, of the best window.  Empty tables: empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    stages = Stages(spark, "decontamination")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    number = docs.count()
    asked = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = max(1, -(-int(asked.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars))
    found = []
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        items = Items([(r["item_id"], r["text"]) for r in rows])
        shared = spark.sparkContext.broadcast(items)
        near = stages.store(plain.mapInArrow(regions(shared), REGION), f"regions{b}")
        df = np.zeros(len(items.known))
        for r in near.where("shingle is not null").groupBy("shingle").agg(F.sum("n").alias("n")).collect():
            df[r["shingle"]] = r["n"]
        weights = spark.sparkContext.broadcast(_weight(number, df))
        left = near.where("words is not null").mapInArrow(candidates(shared, weights, percent), CANDIDATE)
        left = stages.store(left.withColumns({"block": F.lit(b), "region": F.monotonically_increasing_id()}), f"candidates{b}")
        found.append((shared, weights, left))
    wanted = reduce(DataFrame.union, [left.select("block", "region", F.explode("marks").alias("mark")) for _, _, left in found])
    counts = stages.store(_counted(plain, wanted), "counts")
    parts = [left.drop("marks").join(counts, ["block", "region"], "left").select(*REGION_COLUMNS, "others", "dfs")
             .mapInArrow(match(shared, weights, number, percent), MATCH) for shared, weights, left in found]
    best = reduce(DataFrame.union, parts).groupBy("doc_id", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("at"), "n_words")).alias("m"))
    return best.select("doc_id", "item_id", (-F.col("m.at")).alias("start"), F.col("m.n_words").alias("n_words"),
                       F.col("m.similarity").alias("similarity"))
