"""Fingerprints of configurations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(parameters: Column) -> Column:
    """JSON of a map from name to JSON-encoded value, keys sorted."""
    entries = F.array_sort(F.map_entries(parameters))
    pairs = F.transform(entries, lambda e: F.concat(
        F.lit('"'), e["key"], F.lit('": '), e["value"]))
    return F.concat(F.lit("{"), F.concat_ws(", ", pairs), F.lit("}"))


def canonical_list(names: Column) -> Column:
    quoted = F.transform(F.array_sort(names), lambda n: F.concat(F.lit('"'), n, F.lit('"')))
    return F.concat(F.lit("["), F.concat_ws(", ", quoted), F.lit("]"))


def fingerprint(text: Column) -> Column:
    return F.md5(text)
