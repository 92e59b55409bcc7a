"""Threshold-scaled sketches against a plain version of them."""

import hashlib
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from cellscape.llm import fingerprints

SCHEMA = "doc_id long, text string, key string, own string, copies int, next int"


def sketch_of(text, scale=8):
    words = re.findall("[^\x20\x09-\x0D]+", text)
    if not words:
        return []
    full = {hashlib.md5(" ".join(words[i: i + 5]).encode()).hexdigest()[:15] for i in range(max(1, len(words) - 4))}
    low = {h for h in full if int(h, 16) < 16**15 // scale}
    return sorted(low or {min(full)})


def near(a, b):
    if not a or not b:
        return 1.0 if not a and not b else 0.0
    return len(set(a) & set(b)) / min(len(a), len(b))


def plain(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).hexdigest()))
    out = Counter()
    for k, (d, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = sketch_of(t), sketch_of(after), sketch_of(edited)
        out[(d, len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(c), near(a, c), near(a, b))] += 1
    return out


def odd_rows():
    base = " ".join(f"w{i}" for i in range(60))
    texts = [None, "", " \n\t ", "one", " one", "a b c d", "a b c d e", "a\x0bb\x0cc  d\r\ne", base, base + " tail", "日本 語 x ü ß 🤦🏼 " * 30,
             "q " * 500, "\x1f x y"]
    rows = [(3 * i - 9, t) for i, t in enumerate(texts)]
    return rows + [(None, base), (None, base), (None, "other"), (6, "same id"), (6, base), (15, base), (15, base), (15, base)]


@pytest.mark.parametrize("rows", [odd_rows(), [], [(1, "only one text of some words")], [(5, "copy of copies here now")] * 40])
def test_odd_rows(spark, rows):
    docs = spark.createDataFrame([(d, t, "k", "o", 1, 2) for d, t in rows], SCHEMA).repartition(5)
    got = fingerprints.compare_edited(docs)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert Counter(map(tuple, got.collect())) == plain(rows)


def test_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = Counter(map(tuple, fingerprints.compare_edited(docs).collect()))
    assert got == plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert got == Counter(con.execute(fingerprints.oracle()).fetchall())


def test_long_text(spark):
    text = " ".join(f"word{i % 50021}" for i in range(500_000))
    assert len(text) > 4_500_000
    rows = [(1, text), (2, text[: 1 << 20]), (3, "short")]
    docs = spark.createDataFrame([(d, t, "k", "o", 1, 2) for d, t in rows], SCHEMA)
    assert Counter(map(tuple, fingerprints.compare_edited(docs).collect())) == plain(rows)


@pytest.mark.parametrize("scale", [1, 4, 16])
def test_sketches_merge(spark, scale):
    """The sketch of a whole follows from the sketches of its parts, short and empty ones included."""
    parts = [("a b c d e f g h i", "x1 x2 x3 x4 x5 x6"), ("", "one two"), ("", ""), (" ".join(map(str, range(900))), "one two")]
    rows = spark.createDataFrame(parts, "a string, b string")
    got = rows.select("a", "b", fingerprints.merge(fingerprints.sketch(F.col("a"), scale), fingerprints.sketch(F.col("b"), scale), scale).alias("m"))
    for r in got.collect():
        words = [t.split() for t in (r["a"], r["b"]) if t]
        full = {hashlib.md5(" ".join(w[i: i + 5]).encode()).hexdigest()[:15] for w in words for i in range(max(1, len(w) - 4))}
        low = {h for h in full if int(h, 16) < 16**15 // scale}
        assert r["m"] == sorted(int(h, 16) for h in low or ({min(full)} if full else set()))


def test_containment_of_unequal_texts(spark):
    """The estimate is close to the true share of the short text's shingles in the long one."""
    long = [f"t{i}" for i in range(20_000)]
    rows = [(share, " ".join(long), " ".join(long[: int(2000 * share)] + [f"n{i}" for i in range(int(2000 * (1 - share)))])) for share in (0.0, 0.3, 0.8, 1.0)]
    sketches = spark.createDataFrame(rows, "share double, a string, b string").select(
        "share", fingerprints.containment(fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b"))).alias("found"))
    assert all(abs(r["found"] - r["share"]) < 0.08 for r in sketches.collect())
