"""Document fingerprints by a threshold-scaled sketch, with DataFrame functions only.

The sketch of a text has every five-word shingle hash below a fixed fraction of the hash range, so its size
follows the text's.  Sketches of parts merge into the sketch of the whole, and the share of the smaller
sketch found in the larger one estimates containment, however unequal the two documents are.  A text whose
shingles all lie above the fraction keeps its smallest hash, so that a short text is not blind; merging
stays exact, since the smallest hash of a union is the smaller of both.

A hash is the first 60 bits of the MD5 of the shingle's words, joined by one space.  Words are
``[^\\x20\\x09-\\x0D]+``, unchanged; a text of one to four words is one shingle, a text without words has an
empty sketch.  The work of a text grows with its length; nothing is cut or sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscape.llm.stage import Stages

SIZE = 5
#: One shingle in so many is kept: a power of two up to 16, told by the first hexadecimal digit.
SCALE = 8
DIGITS = 15


def sketch(text: Column, scale: int = SCALE) -> Column:
    """Sorted distinct hashes of a text (array of long); empty for a null text or one without words."""
    if scale not in (1, 2, 4, 8, 16):
        raise ValueError("scale must be 1, 2, 4, 8 or 16")
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    bound = F.lit("g" if scale == 1 else f"{16 // scale:x}")

    def hashes(w: Column) -> Column:
        def shingle(i: Column) -> Column:
            return F.md5(F.concat(F.get(w, i), *[x for k in range(1, SIZE) for x in (F.lit(" "), F.get(w, i + k))]))

        full = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - SIZE, F.lit(0))), shingle)
        return F.when(F.size(w) >= SIZE, full).otherwise(F.array(F.md5(F.array_join(w, " "))))

    def least_if_none(every: Column) -> Column:
        return _bind(F.filter(every, lambda h: h < bound), lambda low: F.when(F.size(low) > 0, low).otherwise(F.array(F.array_min(every))))

    # each step is bound to a lambda variable, so that it is evaluated once
    kept = _bind(_bind(F.split(bare, "[ \\t-\\r]+"), hashes), least_if_none)
    some = F.array_sort(F.array_distinct(F.transform(kept, lambda h: F.conv(F.substring(h, 1, DIGITS), 16, 10).cast("long"))))
    return F.when(bare == "", F.array().cast("array<bigint>")).otherwise(some)


def _bind(value: Column, use) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def limit(scale: int = SCALE) -> int:
    return 16 ** DIGITS // scale


def merge(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Sketch of two texts' shingles together, from their sketches."""
    both = F.array_union(a, b)
    low = F.filter(both, lambda h: h < limit(scale))
    return F.array_sort(F.when((F.size(low) > 0) | (F.size(both) == 0), low).otherwise(F.array(F.array_min(both))))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the smaller text's shingles that the larger one has; 1 for two texts without words."""
    least = F.least(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b)).cast("double")
    return F.when(least > 0, shared / least).otherwise(F.when(F.size(a) == F.size(b), 1.0).otherwise(0.0))


def printed(hashes: Column) -> Column:
    """A sketch as text: hashes in hexadecimal digits of equal length, ascending."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), DIGITS, "0")), "")


def next_rows(docs: DataFrame, stages: Stages) -> DataFrame:
    """``(key, next_key, take, copies)``: the row after each row by descending ``doc_id``, and half its length.

    Rows of the same id are ordered by the MD5 of their text, nulls of the id come last; after the last row
    comes the first.  Equal rows are one key: of n copies, n - 1 have their own text next.  Only keys are
    sorted, by ranges over all tasks; what lies across two ranges is read from one row for each range.
    """
    rows = docs.select("doc_id", "key", F.length("text").cast("long").alias("n"), F.md5("text").alias("digest"))
    classes = rows.groupBy("key").agg(
        F.first("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("digest").alias("digest"), F.count("*").alias("m"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("digest").asc()]
    ranged = stages.store(
        classes.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("key", "n", "m", F.monotonically_increasing_id().alias("at")), "order")
    ranges = ranged.groupBy(F.shiftright("at", 33).alias("range")).agg(F.min(F.struct("at", "key")).alias("first"))
    along = Window.orderBy("range")
    after = ranges.select("range", F.coalesce(F.lead("first.key").over(along), F.first("first.key").over(along)).alias("beyond"))
    inside = Window.partitionBy("range").orderBy("at")
    linked = (ranged.withColumn("range", F.shiftright("at", 33)).withColumn("following", F.lead("key").over(inside))
              .join(after, "range"))
    own = F.when(F.col("m") > 1, F.array(F.struct(F.col("key").alias("to"), (F.col("m") - 1).alias("copies"))))
    out = F.array(F.struct(F.coalesce("following", "beyond").alias("to"), F.lit(1).cast("long").alias("copies")))
    return (linked.select("key", F.expr("n div 2").alias("take"), F.explode(F.concat(out, F.coalesce(own, F.filter(out, lambda x: F.lit(False))))).alias("x"))
            .select("key", F.col("x.to").alias("next_key"), "take", F.col("x.copies").alias("copies")))


def compare_edited(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """Fingerprints of all rows, of their edited texts, and the likeness of both and of the next document.

    ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` for each row.
    In the edited text the last half is replaced by as much of the next document's beginning.  Null text:
    empty.  Empty texts have an empty fingerprint and are alike to each other alone.  Null and repeated ids
    and repeated rows: see ``next_rows``; every row is returned.  A single row is its own next one.  Empty
    table: no rows.  Other columns are ignored.
    """
    stages = Stages(docs.sparkSession, "fingerprints")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("key", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5("text")))
    links = next_rows(rows, stages)
    # one row for each key; both joins below read the same exchange
    texts = rows.withColumn("own", sketch(F.col("text"), scale)).groupBy("key").agg(
        F.first(F.struct("doc_id", "text", "own")).alias("doc")).select("key", "doc.doc_id", "doc.text", "doc.own")
    heads = texts.withColumnRenamed("key", "next_key").join(links, "next_key").select(
        "key", F.expr("left(text, cast(take AS int))").alias("head"), F.col("own").alias("next"), "copies")
    edited = texts.join(heads, "key").select(
        "doc_id", "copies", F.length("text").cast("long").alias("n_chars"), "own", "next",
        F.concat(F.expr("left(text, cast(char_length(text) - char_length(text) div 2 AS int))"), "head").alias("edited"))
    out = edited.select("doc_id", "copies", "n_chars", "own", "next", F.sha2("edited", 256).alias("edited_sha256"),
                        sketch(F.col("edited"), scale).alias("other"))
    return out.select(
        "doc_id", "n_chars", "edited_sha256", printed(F.col("own")).alias("fingerprint"),
        printed(F.col("other")).alias("edited_fingerprint"), containment(F.col("own"), F.col("other")).alias("near_edited"),
        containment(F.col("own"), F.col("next")).alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).drop("copy")


def oracle(scale: int = SCALE) -> str:
    """The same result in DuckDB: a window over all rows instead of ranges and joins."""
    def sketch_of(text: str, words: str) -> str:
        every = (f"list_distinct(list_transform(range(greatest(len({words}) - {SIZE - 1}, least(len({words}), 1))), "
                 f"lambda i: substring(md5(array_to_string({words}[i + 1 : i + {SIZE}], ' ')), 1, {DIGITS})))")
        low = f"list_filter({every}, lambda h: h < '{'g' if scale == 1 else f'{16 // scale:x}'}')"
        return f"list_sort(CASE WHEN len({low}) > 0 OR len({words}) = 0 THEN {low} ELSE [list_min({every})] END)"

    def near(a: str, b: str) -> str:
        return (f"CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN CAST(len(list_intersect({a}, {b})) AS DOUBLE) / least(len({a}), len({b})) "
                f"WHEN len({a}) = len({b}) THEN 1.0 ELSE 0.0 END")

    split = "list_filter(string_split_regex({}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, coalesce(lead(text) OVER o, first_value(text) OVER o) AS next FROM d
      WINDOW o AS (ORDER BY doc_id DESC NULLS LAST, md5(text))),
e AS (SELECT *, CAST(length(text) AS BIGINT) AS n_chars,
             left(text, length(text) - length(text) // 2) || left(next, length(text) // 2) AS edited FROM n),
w AS (SELECT *, {split.format('text')} AS a, {split.format('next')} AS b, {split.format('edited')} AS c FROM e),
s AS (SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, {sketch_of('text', 'a')} AS a, {sketch_of('next', 'b')} AS b,
             {sketch_of('edited', 'c')} AS c FROM w)
SELECT doc_id, n_chars, edited_sha256, array_to_string(a, '') AS fingerprint, array_to_string(c, '') AS edited_fingerprint,
       {near('a', 'c')} AS near_edited, {near('a', 'b')} AS near_next
FROM s"""
