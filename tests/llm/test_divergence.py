"""Source divergence against a plain count of everything."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from cellscape.llm import divergence

SCHEMA = "doc_id long, lang string, source string, text string, term string, counts int, value string, part int"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least, top=50):
    rows = [(lang or "", source or "", TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for lang, source, text in rows]
    out = Counter()
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        df = Counter(t for _, _, w in own for t in set(w))
        kept = {t for t, n in df.items() if n >= least}
        counts = defaultdict(Counter)
        for _, source, words in own:
            counts[source].update(w for w in words if w in kept)
        every = sum(counts.values(), Counter())
        p = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        q, shares = p(every), {s: p(c) for s, c in counts.items()}
        for s, mine in shares.items():
            parts = {"pair": [(-sum(abs(mine[t] - other[t]) for t in kept), k.encode(), k) for k, other in shares.items() if k != s],
                     "term": [(q[t] - mine[t], t.encode(), t) for t in kept if counts[s][t] and mine[t] > q[t]]}
            for part, found in parts.items():
                for rank, (v, _, item) in enumerate(sorted(found)[: top if part == "term" else None], 1):
                    out[(lang, s, part, item, -v, rank)] += 1
    return out


def made(spark, rows):
    return spark.createDataFrame([(k, *r, "t", 1, "v", 2) for k, r in enumerate(rows)], SCHEMA).repartition(5)


def check(spark, rows, least, **sizes):
    got = divergence.audit(made(spark, rows), least, **sizes)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert Counter(map(tuple, got.collect())) == plain(rows, least)


def odd_rows():
    rng = np.random.default_rng(3)
    words = ["a", "B", "Éa", "é", "ß", "日本", "x1y", "don't", "Z", "zz", "🤦🏼"] + [f"w{chr(97 + i)}" for i in range(26)]
    rows = [(str(rng.choice(["en", "de", "x"])), str(rng.choice(["s1", "s2", "ſ", "S1", "s1 "])), " ".join(rng.choice(words, rng.integers(1, 30)))) for _ in range(300)]
    rows += [(None, None, None), (None, "", "a b"), ("", None, ""), ("none", "s", None), ("none", "t", "1 2 3"), ("lone", "s", "a a a")] * 2
    return rows + [("hot", "h", "same same text")] * 200 + [("hot", f"h{k}", "other same") for k in range(40)]


@pytest.mark.parametrize("least", [1, 5])
def test_odd_rows(spark, least):
    check(spark, odd_rows(), least)


def test_spills_groups_and_blocks(spark):
    """Many spills, groups of terms and blocks of sources give the same result."""
    check(spark, odd_rows(), 3, limit=40, group_entries=7, group_pairs=100)


def test_empty_and_single(spark):
    check(spark, [], 1)
    check(spark, [("en", "only", "a few words")], 1)
    check(spark, [("en", "a", None), ("en", "b", "")], 1)


def test_long_text(spark):
    text = ("word " * 7 + "longterm" * 9 + "\n") * 60_000 + "x" * 2_500_000 + " end"
    assert len(text) > 5_000_000
    check(spark, [("en", "a", text), ("en", "b", text[::-1]), ("en", "c", "word x")], 1)


def test_parts_end_between_terms():
    rng = np.random.default_rng(1)
    for size in (0, 5, 1 << 20, (1 << 20) + 7, 5 << 20):
        data = bytes(rng.choice(np.frombuffer(b"abc\xc3\xa9 .", np.uint8), size))
        assert b"".join(divergence._parts(data)) == data
        whole = data.translate(divergence._LETTERS).split()
        assert [t for p in divergence._parts(data) for t in p.translate(divergence._LETTERS).split()] == whole


def test_large_counts_are_exact():
    counts, totals = [10**12 + 7, 3, 2**52], [10**13 + 1, 7, 2**53 + 11]
    assert divergence.share(np.array(counts), np.array(totals)).tolist() == [1 + 10**9 * c // t for c, t in zip(counts, totals)]
    assert divergence.share(np.array([2**61]), np.array([2**62 + 1])).tolist() == [1 + 10**9 * 2**61 // (2**62 + 1)]


def test_slabs(monkeypatch):
    stripes = pa.table({"term": [bytes([97 + k]) for k in range(20)], "sources": [["s", "t"][: 1 + k % 2] for k in range(20)],
                        "counts": [[k + 1, 2 * k + 1][: 1 + k % 2] for k in range(20)]})
    axis = pa.table({"lang": ["en"] * 2, "source": ["s", "t"], "total": [210, 200], "all_total": [410] * 2, "n_terms": [20] * 2, "low": [0] * 2, "high": [2] * 2})
    whole = Counter(map(str, divergence.emit((), stripes, axis).to_pylist()))
    monkeypatch.setattr(divergence, "SLAB", 6)
    parts = divergence.emit((), stripes, axis).to_pylist()
    assert Counter(map(str, parts)) == whole and len(parts) > 4


def test_tables(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = Counter(map(tuple, divergence.audit(docs).collect()))
    assert got == Counter(con.execute(divergence.ORACLE).fetchall())
    assert got == plain([(r["lang"], r["source"], r["text"]) for r in docs.collect()], 30)
