"""License scans by a positional rare-token index, with DataFrame functions only.

Each template has words and a mandatory key phrase.  Its entry in the index is the word of the key phrase
with the highest IDF over all documents, and that word's place.  A document looks up only its index words;
each gives a place where the template would start; the key phrase is verified there, and all other words of
the template are intersected by relative position: the score is the best share of words in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Label, template, key phrase (part of the template), whether it is a base phrase.
TEMPLATES = [
    ("mit", "under the mit license", "under the mit license", True),
    ("apache-2", "apache license version 2", "apache license version 2", True),
    ("cc-by-nc", "cc by nc", "cc by nc", True),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "granted free of charge to any person obtaining a copy", False),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "you may not use this file except in compliance with the license", False),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3", False),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", "gnu general public license version 2", False),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license", False),
    ("agpl", "licensed under the gnu affero general public license", "gnu affero general public license", False),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms", False),
    ("mpl-2", "subject to the terms of the mozilla public license version 2 0", "mozilla public license version 2", False),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute this software", False),
    ("cc0", "creative commons cc0 1 0 universal public domain dedication", "cc0 1 0 universal", False),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa", False),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software released into the public domain", False),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _split(text: Column) -> Column:
    return F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS)


def _strings(words: list[str]) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def rarest_words(docs: DataFrame) -> dict[str, int]:
    """Documents that have each word of a key phrase: a list as long as the templates, whatever the input."""
    vocabulary = sorted({w for t in TEMPLATES for w in t[2].split()})
    counts = (docs.select(F.explode(F.array_intersect(_split(F.col("text")), F.array(*map(F.lit, vocabulary)))).alias("word"))
              .groupBy("word").count().collect())
    return dict.fromkeys(vocabulary, 0) | {r["word"]: r["count"] for r in counts}


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` for each row.

    ``n_base`` counts all places of base phrases; ``labels`` has the base ones and those of other templates
    whose key phrase stands in the text; ``score`` is the best share of a found template's words in place, 0
    without any.  Null or empty text: no words.  A null or repeated ``doc_id`` is kept as it is.  Other
    columns are ignored.
    """
    frequency = rarest_words(docs)
    index = []
    for label, template, key, base in TEMPLATES:
        words, phrase = template.split(), key.split()
        at = next(i for i in range(len(words)) if words[i: i + len(phrase)] == phrase)
        rare = min(range(len(phrase)), key=lambda i: (frequency[phrase[i]], i))
        index.append((label, words, phrase, at, rare, base))
    anchors = sorted({phrase[rare] for _, _, phrase, _, rare, _ in index})
    split = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _split(F.col("text")).alias("w"))
    hits = split.select(
        "doc_id", "w", F.expr("if(w[0] = '', 1, 0)").alias("lead"),
        F.expr(f"""CASE WHEN arrays_overlap(w, {_strings(anchors)}) THEN
            filter(transform(w, (x, i) -> named_struct('x', x, 'i', i)), z -> array_contains({_strings(anchors)}, z.x))
            ELSE cast(array() AS array<struct<x: string, i: int>>) END""").alias("p"))
    found = [F.expr(f"""filter(transform(filter(p, z -> z.x = '{phrase[rare]}'), z -> z.i - {rare}),
            s -> s >= 0 AND slice(w, s + 1, {len(phrase)}) = {_strings(phrase)})""").alias(f"s{k}")
             for k, (_, _, phrase, _, rare, _) in enumerate(index)]
    size = F.expr("size(w) - lead - if(size(w) > 1 AND element_at(w, -1) = '', 1, 0)").cast("long").alias("n_words")
    placed = hits.select("doc_id", "lead", size, F.expr("if(size(p) > 0, w, cast(array() AS array<string>))").alias("w"), *found)
    base = [k for k, t in enumerate(index) if t[5]]
    every = f"concat({', '.join(f's{k}' for k in base)})"

    def labels(which: list[int]) -> Column:
        return F.expr("array_join(array_sort(array_distinct(filter(array("
                      + ", ".join(f"if(size(s{k}) > 0, '{index[k][0]}', '')" for k in which) + "), x -> x <> ''))), ',')")

    shares = ", ".join(
        f"array_max(transform(s{k}, s -> aggregate(sequence(0, {len(words) - 1}), 0, (n, q) -> "
        f"n + if(get(w, s - {at} + q) = {_strings(words)}[q], 1, 0)) / {float(len(words))}))"
        for k, (_, words, _, at, _, _) in enumerate(index))
    return placed.select(
        "doc_id", "n_words", F.expr(f"size({every})").cast("long").alias("n_base"),
        F.expr(f"array_min({every}) - lead").cast("long").alias("first_word"),
        F.expr(f"array_max({every}) - lead").cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(list(range(len(index)))).alias("labels"),
        F.expr(f"coalesce(round(array_max(array({shares})), 6), 0.0)").cast("double").alias("score"))


def oracle() -> str:
    """The same result in DuckDB, without the index: every place of every text is tried."""
    lists = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    columns, shares = [], []
    for k, (_, template, key, _) in enumerate(TEMPLATES):
        words, phrase = template.split(), key.split()
        at = next(i for i in range(len(words)) if words[i: i + len(phrase)] == phrase)
        columns.append(f"CASE WHEN contains(t, '{phrase[0]}') THEN list_filter(range(len(w)), lambda s: w[s + 1] = '{phrase[0]}' AND "
                       f"w[s + 1 : s + {len(phrase)}] = {lists(phrase)}) ELSE [] END AS s{k}")
        shares.append(f"list_max(list_transform(s{k}, lambda s: list_sum([{', '.join(f'CASE WHEN s - {at} + {q} >= 0 AND w[s - {at} + {q} + 1] = {chr(39)}{x}{chr(39)} THEN 1 ELSE 0 END' for q, x in enumerate(words))}]) / {float(len(words))}))")
    base = [k for k, t in enumerate(TEMPLATES) if t[3]]
    every = " || ".join(f"s{k}" for k in base)
    pick = lambda which: "array_to_string(list_sort(list_distinct(list_filter([" + ", ".join(
        f"CASE WHEN len(s{k}) > 0 THEN '{TEMPLATES[k][0]}' END" for k in which) + "], lambda x: x IS NOT NULL))), ',')"
    return f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '{SEPARATORS}'), lambda x: x <> '') AS w FROM t),
s AS (SELECT doc_id, w, {', '.join(columns)} FROM w)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len({every}) AS BIGINT) AS n_base,
       CAST(list_min({every}) AS BIGINT) AS first_word, CAST(list_max({every}) AS BIGINT) AS last_word,
       {pick(base)} AS base_labels, {pick(range(len(TEMPLATES)))} AS labels,
       CAST(coalesce(round(list_max([{', '.join(shares)}]), 6), 0.0) AS DOUBLE) AS score
FROM s"""
