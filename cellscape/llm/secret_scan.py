"""Secret scans: Aho-Corasick keywords, anchored expressions at their hits, and checksum validation.

One automaton finds all keywords in a text; an expression is tried only where its keyword stands.  Hex runs
have no keyword; they are runs of one byte class.  Tokens that carry a checksum count only if it is right:
the last 6 of 36 characters of ``gh?_`` and ``npm_`` tokens are the CRC-32 of the first 30 in base 62; the
header of a web token has to decode to a JSON object with an algorithm.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscape.llm import wordhash as wh
from cellscape.llm.stage import small_batches

# Kinds in their order, keywords and expressions.
KINDS = ["assign", "access", "hex", "github", "npm", "jwt", "private_key"]
BASE = KINDS[:3]
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
CHECKED = re.compile(r"(?:gh[opusr]_|npm_)[A-Za-z0-9]{36}(?![A-Za-z0-9])")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
RUN = re.compile(r"[A-Za-z0-9_-]+")
PRIVATE = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----")
KEYWORDS = {
    **dict.fromkeys(["password", "passwd", "secret", "token", "apikey", "api_key"], "assign"),
    "akia": "access", "eyj": "jwt", "-----begin ": "private_key", "npm_": "npm",
    **dict.fromkeys(["gho_", "ghp_", "ghu_", "ghs_", "ghr_"], "github"),
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_HEX = np.zeros(256, dtype=bool)
_HEX[list(b"0123456789abcdef")] = True


def checksum_holds(token: str) -> bool:
    """The last six characters are the CRC-32 of the thirty before, in base 62."""
    body, want, value = token[-36:-6], token[-6:], 0
    for c in want:
        value = value * 62 + BASE62.index(c)
    return value == zlib.crc32(body.encode())


def _is_jwt(head: str) -> bool:
    try:
        found = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, RecursionError):
        return False
    return isinstance(found, dict) and "alg" in found


def automaton() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        out.add_word(word, (len(word), kind))
    out.make_automaton()
    return out


def find(text: str, keywords: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all but hex spans, in code points."""
    # A-Z only: other letters may change their length
    lower = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    done = dict.fromkeys(KINDS, 0)
    out = []
    hits = sorted((end - n + 1, kind) for end, (n, kind) in keywords.iter(lower))
    for start, kind in hits:
        if start < done[kind]:
            continue
        if kind == "assign":
            m = ASSIGN.match(text, start)
            good = m and len(m[2]) >= 12
        elif kind == "access":
            m = ACCESS.match(text, start)
            good = m and len(m[0]) >= 18
        elif kind == "jwt":
            m = JWT.match(text, start)
            good = m and _is_jwt(m[1])
            if not m and text.startswith("eyJ", start):  # no later start in the same run has the dot that is missing here
                done[kind] = RUN.match(text, start).end()
        elif kind == "private_key":
            m = PRIVATE.match(text, start)
            good = m
        else:
            m = CHECKED.match(text, start)
            good = m and checksum_holds(m[0])
        if m:
            done[kind] = m.end()
            if good:
                out.append((start, KINDS.index(kind), m.end()))
    return out


def hex_runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of runs of 16 or more hex digits inside the texts."""
    inside = _HEX[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    before = np.concatenate([[False], inside[:-1]]) & ~edge[:-1]
    after = np.concatenate([inside[1:], [False]]) & ~edge[1:]
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    long = end - start >= 16
    return start[long], end[long]


def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keywords, access = automaton(), KINDS.index("hex")
    for batch in batches:
        texts = batch.column("text")
        found: list[list] = []
        for row, data, bounds in wh.chunks(texts):
            start, end = hex_runs(data, bounds)
            runs = np.searchsorted(bounds, start, side="right") - 1
            edges = np.searchsorted(runs, np.arange(len(bounds)))
            # code points before each byte: all but continuation bytes
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)]) if len(start) else start
            for t in range(len(bounds) - 1):
                own = find(texts[row + t].as_py() or "", keywords)
                for k in range(edges[t], edges[t + 1]):
                    a = int(points[start[k]] - points[bounds[t]])
                    own.append((a, access, a + int(end[k] - start[k])))
                found.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in sorted(own)])
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], [*batch.schema.names, "found"])


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``found``: its spans ``(kind, start, end)`` by start, then kind as in ``KINDS``.

    Positions are code points, the end is exclusive; spans of different kinds may overlap.  Null or empty
    text: no spans.  All columns and rows of ``docs`` are kept; it needs ``text`` and must not have ``found``.
    """
    small_batches(docs.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(spans, f"{fields}, found array<struct<kind string, start long, end long>>")


def digests(found: DataFrame) -> DataFrame:
    """Counts of the base kinds and the spans as text."""
    joined = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), *[count(k) for k in BASE],
        F.sha2(joined(F.filter("found", lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def redact(found: DataFrame, mark: str = "[secret]") -> DataFrame:
    """Replace every span in ``text`` and drop ``found``; overlapping spans become one mark.

    ``n_chars``, if there, becomes the new number of code points of a text that changed.
    """
    merged = F.aggregate(
        "found", F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda a, s: F.when(s["end"] <= a["at"], a).otherwise(F.struct(
            F.concat(a["out"], F.when(s["start"] >= a["at"], F.concat(F.substring("text", a["at"] + 1, s["start"] - a["at"]), F.lit(mark)))
                     .otherwise(F.lit(""))).alias("out"), s["end"].alias("at"))),
        lambda a: F.concat(a["out"], F.substring("text", a["at"] + 1, F.length("text"))))
    has = F.size("found") > 0
    out = found.withColumn("text", F.when(has, merged).otherwise(F.col("text")))
    if "n_chars" in found.columns:
        out = out.withColumn("n_chars", F.when(has, F.length("text")).otherwise(F.col("n_chars")).cast(found.schema["n_chars"].dataType))
    return out.drop("found")
