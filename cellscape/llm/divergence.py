"""Audit of how sources of a language differ in their words, by in-mapper stripes.

1. Each task folds whole documents into hash stripes, term -> (document frequency, occurrences by source), for
   each language.  It emits them as rows when it ends or holds more than ``ENTRIES`` entries, and starts anew.
   A key so gets at most one row for each spill of a task, however common the term is.
2. Stripes are dealt by (lang, term), sorted, and merged while they stream by.  Terms in too few documents go;
   the empty term is no term and carries the documents of each source.
3. Merged stripes directly emit the divergences, in groups of about ``GROUP_ENTRIES`` entries: for each source
   its 50 greatest excesses over the language, and for each two sources the sum of |p - q|, as the sum for terms
   that neither has, a closed form, corrected by the terms that one of them has.  Sums and ranks follow.

All arithmetic is on whole numbers: p = 1 + floor(10**9 * (count + 5) / (N + 5 * V)), N the occurrences of kept
terms in the group and V the kept terms of the language.  Memory of a task is bounded by ``ENTRIES``, by a batch
of stripes (a stripe has one entry for each source of the term), or by a group.  The result has a row for each two
sources of a language; groups are also split by blocks of sources, so that no task holds all pairs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscape.llm.stage import Stages

LEAST_DOCS = 30
ADDED = 5
UNIT = 10**9
TOP_TERMS = 50
#: Entries (term, source) that a task holds before it emits its stripes.
ENTRIES = 400_000
#: Entries of one group of merged stripes, and pairs of sources in it.
GROUP_ENTRIES = 100_000
GROUP_PAIRS = 1_000_000
#: Terms times sources that are looked at together.
SLAB = 2_000_000
#: A long text is read in parts of about so many bytes.
PART_BYTES = 1 << 20
#: Space for what is no letter (ASCII), A-Z lower-cased, all other bytes as they are.
_LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_LETTER = np.frombuffer(_LETTERS, dtype=np.uint8) != 32
STRIPE = "lang string, term binary, df long, sources array<string>, counts array<long>"
_KINDS = [pa.string(), pa.binary(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
_NAMES = ["lang", "term", "df", "sources", "counts"]


def _parts(data: bytes) -> Iterator[bytes]:
    """A text in parts that end between terms; a single longer term is not cut."""
    at = 0
    while at < len(data):
        stop = at + PART_BYTES
        while stop < len(data):
            gaps = np.flatnonzero(~_LETTER[np.frombuffer(data, np.uint8, count=min(PART_BYTES, len(data) - stop), offset=stop)])
            if len(gaps):
                stop += int(gaps[0])
                break
            stop += PART_BYTES
        yield data[at:stop]
        at = stop


class Stripes:
    """Stripes of some documents: occurrences by lang and source, documents by lang, both by term."""

    def __init__(self):
        self.counts: dict[str, dict[str, Counter]] = {}
        self.docs: dict[str, Counter] = {}
        self.entries = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        counts, docs = self.counts.setdefault(lang, {}).setdefault(source, Counter()), self.docs.setdefault(lang, Counter())
        before = len(counts)
        counts[b""] += 1
        seen: set[bytes] = set()
        for part in _parts(text):
            terms = part.translate(_LETTERS).split()
            counts.update(terms)
            seen.update(terms)
        docs.update(seen)
        docs[b""] += 1
        self.entries += len(counts) - before

    def emit(self) -> Iterator[pa.RecordBatch]:
        for lang, groups in self.counts.items():
            stripes: dict[bytes, tuple[list[str], list[int]]] = {}
            for source, counts in groups.items():
                for term, n in counts.items():
                    stripe = stripes.setdefault(term, ([], []))
                    stripe[0].append(source)
                    stripe[1].append(n)
            docs, terms = self.docs[lang], list(stripes)
            for a in range(0, len(terms), 20_000):
                some = terms[a: a + 20_000]
                columns = [[lang] * len(some), some, [docs[t] for t in some], [stripes[t][0] for t in some], [stripes[t][1] for t in some]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], _NAMES)
        self.__init__()


def fold(limit: int):
    """Documents ``(lang, source, text)`` to stripes, emitted before they have many more than ``limit`` entries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Stripes()
        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text")):
                data = text.as_buffer()
                own.add(lang, source, data.to_pybytes() if data is not None else b"")
                if own.entries > limit:
                    yield from own.emit()
        yield from own.emit()

    return run


def _merge(table: pa.Table) -> pa.Table:
    """One stripe for each (lang, term) of a table of stripes."""
    table = table.combine_chunks()
    documents = table.group_by(["lang", "term"]).aggregate([("df", "sum")])
    sources = table.column("sources").combine_chunks()
    row = pc.list_parent_indices(sources)
    flat = pa.table({
        "lang": table.column("lang").take(row), "term": table.column("term").take(row), "source": pc.list_flatten(sources),
        "count": pc.list_flatten(table.column("counts").combine_chunks())})
    entries = flat.group_by(["lang", "term", "source"]).aggregate([("count", "sum")]).sort_by(
        [("lang", "ascending"), ("term", "ascending"), ("source", "ascending")])
    documents = documents.sort_by([("lang", "ascending"), ("term", "ascending")])
    # both are in the order of (lang, term): entries of a stripe stand together
    lang, term = (pc.dictionary_encode(entries.column(c).combine_chunks()).indices.to_numpy() for c in ("lang", "term"))
    new = np.ones(len(lang), dtype=bool)
    new[1:] = (lang[1:] != lang[:-1]) | (term[1:] != term[:-1])
    offsets = pa.array(np.append(np.flatnonzero(new), len(lang)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, entries.column(c).combine_chunks()) for c in ("source", "count_sum")]
    return pa.table([documents.column("lang"), documents.column("term"), documents.column("df_sum"), *lists], names=_NAMES).cast(
        pa.schema(list(zip(_NAMES, _KINDS))))


def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes sorted by (lang, term) to one stripe for each; the last key of a batch waits for the next batch."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = _merge(table if held is None else pa.concat_tables([held, table.cast(held.schema)]))
        held = table.slice(table.num_rows - 1)
        yield from table.slice(0, table.num_rows - 1).to_batches()
    if held is not None:
        yield from held.to_batches()


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10**9 * count / total), exact for any count up to total."""
    count, total = np.asarray(count), np.asarray(total)
    if total.size and int(total.max()) > (2**63 - 1) // 1000:
        count, total = count.astype(object), total.astype(object)
    out, rest = count // total, count % total
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // total, rest % total
    return np.asarray(out + 1, dtype=np.int64)


EMITTED = "lang string, source string, part string, item string, value long"


def emit(keys: tuple, stripes: pa.Table, axis: pa.Table) -> pa.Table:
    """Divergences of a group of stripes of one language; ``axis`` has its sources and their totals, in order.

    The group holds some terms, and the sources ``low`` to ``high`` of the axis as the first of each pair.
    """
    lang = axis.column("lang")[0].as_py()
    names, total = axis.column("source").to_pylist(), axis.column("total").to_numpy()
    low, high = axis.column("low")[0].as_py(), axis.column("high")[0].as_py()
    n_terms, all_total = axis.column("n_terms")[0].as_py(), axis.column("all_total")[0].as_py()
    size = total + ADDED * n_terms
    blank = share(np.full(len(names), ADDED), size)
    place = {s: k for k, s in enumerate(names)}
    out: list[tuple] = []
    pairs = np.zeros((high - low, len(names)), dtype=np.int64)
    best: dict[int, list[tuple[int, bytes]]] = {}
    slab = max(1, SLAB // len(names))
    for a in range(0, stripes.num_rows, slab):
        some = stripes.slice(a, slab)
        lists = some.column("sources").combine_chunks()
        term = pc.list_parent_indices(lists).to_numpy()
        source = np.array([place[s] for s in pc.list_flatten(lists).to_pylist()], dtype=np.int64)
        count = pc.list_flatten(some.column("counts").combine_chunks()).to_numpy()
        p = share(count + ADDED, size[source])
        dense = np.tile(blank, (some.num_rows, 1))
        dense[term, source] = p
        own = np.zeros(dense.shape, dtype=bool)
        own[term, source] = True
        mine = (source >= low) & (source < high)
        t, g, v = term[mine], source[mine], p[mine]
        for q in range(len(names)):
            # a term that both sources have is seen from either side: counted where the first one is smaller
            more = np.abs(v - dense[t, q]) - np.abs(blank[g] - blank[q])
            more[own[t, q] & (g > q)] = 0
            pairs[:, q] += np.bincount(g - low, more, minlength=high - low).astype(np.int64)  # exact below 2**53
        in_all = np.add.reduceat(count, np.flatnonzero(np.diff(term, prepend=-1)))
        every = share(in_all + ADDED, np.full(some.num_rows, all_total + ADDED * n_terms))
        excess = v - every[t]
        terms = some.column("term").to_pylist()
        for s in np.unique(g):
            at = np.flatnonzero((g == s) & (excess > 0))
            if len(at) > TOP_TERMS:  # ties at the last place stay for the exact order below
                at = at[excess[at] >= np.partition(excess[at], -TOP_TERMS)[-TOP_TERMS]]
            kept = sorted([(-int(excess[k]), terms[t[k]]) for k in at] + best.get(int(s), []))
            best[int(s)] = kept[:TOP_TERMS]
    out += [(lang, names[s], "term", x.decode(), -v) for s, kept in best.items() for v, x in kept]
    g, q = np.nonzero(pairs)
    for i, j in zip(g.tolist(), q.tolist()):
        if i + low != j:
            out += [(lang, names[i + low], "pair", names[j], int(pairs[i, j])), (lang, names[j], "pair", names[i + low], int(pairs[i, j]))]
    columns = list(zip(*out)) or [()] * 5
    kinds = [pa.string()] * 4 + [pa.int64()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "source", "part", "item", "value"])


def stripes_of(docs: DataFrame, limit: int = ENTRIES) -> DataFrame:
    """Merged stripes ``(lang, term, df, sources, counts)`` of all documents; the empty term counts documents."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    parts = docs.select(*text, "text").mapInArrow(fold(limit), STRIPE)
    return parts.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(merge, STRIPE)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, limit: int = ENTRIES, group_entries: int = GROUP_ENTRIES,
          group_pairs: int = GROUP_PAIRS) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for all pairs of sources of a language and the top terms of each.

    Null lang, source and text are ''.  A language of one source has no pairs; one without kept terms has pairs
    of value 0 and no terms.  Repeated rows count as documents of their own; very long texts are read in parts.
    Ties go to the item first in byte order.  Empty table: no rows.  Other columns, ``doc_id`` too, are ignored.
    """
    stages = Stages(docs.sparkSession, "divergence")
    kept = stages.store(stripes_of(docs, limit).where((F.col("df") >= least_docs) | (F.length("term") == 0)), "stripes")
    word = F.length("term") > 0
    entries = kept.select("lang", word.alias("word"), F.explode(F.arrays_zip("sources", "counts")).alias("e"))
    axis = stages.store(
        entries.groupBy("lang", F.col("e.sources").alias("source")).agg(F.sum(F.when(F.col("word"), F.col("e.counts")).otherwise(0)).alias("total")), "sources")
    langs = (kept.groupBy("lang").agg(F.sum(word.cast("long")).alias("n_terms"), F.sum(F.when(word, F.size("sources")).otherwise(0)).alias("n_entries"))
             .join(axis.groupBy("lang").agg(F.sum("total").alias("all_total"), F.count("*").alias("n_sources")), "lang")
             .withColumn("groups", F.greatest(F.lit(1), F.ceil(F.col("n_entries") / group_entries)))
             .withColumn("width", F.greatest(F.lit(1), F.floor(group_pairs / F.col("n_sources")))))
    blocks = F.explode(F.expr("sequence(0L, (n_sources - 1) div width)")).alias("block")
    dealt = kept.where(word).join(langs.select("lang", "groups", "n_sources", "width"), "lang").select(
        "lang", "term", "sources", "counts", F.pmod(F.xxhash64("term"), "groups").alias("group"), blocks)
    spread = axis.join(langs, "lang").select(
        "lang", "source", "total", "all_total", "n_terms", "n_sources", "width", F.explode(F.expr("sequence(0L, groups - 1)")).alias("group"), blocks)
    spread = spread.select(
        "lang", "source", "total", "all_total", "n_terms", "group", "block", (F.col("block") * F.col("width")).alias("low"),
        F.least("n_sources", (F.col("block") + 1) * F.col("width")).alias("high"))
    by = ["lang", "group", "block"]
    ordered = lambda keys, left, right: emit(keys, left, right.sort_by("source"))
    emitted = stages.store(dealt.groupBy(*by).cogroup(spread.groupBy(*by)).applyInArrow(ordered, EMITTED), "emitted")

    # what terms that neither source has would give to a pair, for all terms
    def blank(total: str) -> Column:
        return F.expr(f"cast(1 + cast({UNIT * ADDED} as decimal(38,0)) div greatest({total} + {ADDED} * n_terms, 1) as long)")

    left = axis.join(langs.select("lang", "n_terms"), "lang").select("lang", "source", "n_terms", blank("total").alias("p"))
    right = axis.join(langs.select("lang", "n_terms"), "lang").select("lang", F.col("source").alias("item"), blank("total").alias("q"))
    base = left.join(right, "lang").where("source <> item").select(
        "lang", "source", F.lit("pair").alias("part"), "item", (F.abs(F.col("p") - F.col("q")) * F.col("n_terms")).alias("value"))
    pairs = base.unionByName(emitted.where("part = 'pair'")).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    terms = emitted.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP_TERMS)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms)


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= {LEAST_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT g.lang, count(kept.term) AS v FROM (SELECT DISTINCT lang FROM g) g LEFT JOIN kept ON g.lang = kept.lang GROUP BY g.lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY w.lang, w.source, w.term),
total AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
             1 + (CAST({UNIT} AS HUGEINT) * (coalesce(c.n, 0) + {ADDED})) // CAST(coalesce(total.total, 0) + {ADDED} * v.v AS HUGEINT) AS p
      FROM g JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN total ON total.lang = g.lang AND total.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
q AS (SELECT lang, term, 1 + (CAST({UNIT} AS HUGEINT) * (sum(n) + {ADDED})) // CAST(sum(sum(n)) OVER (PARTITION BY lang) + {ADDED} * max(v.v) AS HUGEINT) AS q
      FROM p JOIN v USING (lang) GROUP BY lang, term),
r AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
      FROM g JOIN g AS h ON g.lang = h.lang AND g.source <> h.source LEFT JOIN (
        SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term GROUP BY ALL) x
        ON x.lang = g.lang AND x.source = g.source AND x.item = h.source
      UNION ALL
      SELECT p.lang, p.source, 'term', p.term, CAST(p.p - q.q AS BIGINT) FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM r QUALIFY part = 'pair' OR rank <= {TOP_TERMS}"""
