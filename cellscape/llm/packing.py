"""Best-fit packing of token sequences: patterns of few documents, fitted to the histogram of lengths.

1. Each document is encoded and cut into pieces of at most ``size`` ids.  Each task numbers its pieces of
   a length; sums over tasks make that a rank among all pieces of the length.
2. The histogram has ``size`` entries at most, whatever the input, so it is packed on the driver:
   patterns of two to four lengths that fill a sequence, repeat counts by non-negative least squares
   (cyclic coordinate descent), rounded down, and the rest by best-fit decreasing on counts.
3. A piece finds its sequence from its length and rank, by a look-up in the bounded list of patterns.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellscape.llm.encoder import encoder
from cellscape.llm.stage import Stages, small_batches

SWEEPS = 30
SPLITS = (0.5, 0.35, 0.65, 0.2, 0.8)


def _pieces(path: str, end_id: int, size: int, checksums: bool):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, seen = encoder(path), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = own.encode(text.as_py() or "") + end
                n = len(ids) // 4
                head = n % size or size
                edges = [0, *range(head, n + 1, size)]
                for piece, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                    rows.append((doc, piece, a, b - a, part, seen[b - a],
                                 zlib.crc32(ids[4 * a: 4 * b]) if checksums else ids[4 * a: 4 * b]))
                    seen[b - a] += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64() if checksums else pa.binary()]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["doc_id", "piece", "start", "length", "part", "local", "ids_crc32" if checksums else "ids"])

    return run


def patterns(counts: dict[int, int], size: int) -> list[tuple[int, ...]]:
    """Patterns of two to four present lengths that leave little or no room."""
    present = sorted(counts)
    found: dict[tuple[int, ...], None] = {}

    def best(room: int) -> int | None:
        k = bisect_right(present, room)
        return present[k - 1] if k else None

    for a in present:
        room = size - a
        if (b := best(room)) is None:
            found[(a,)] = None
            continue
        found[tuple(sorted((a, b), reverse=True))] = None
        for share in SPLITS:
            if (b := best(int(room * share))) is not None and (c := best(room - b)) is not None:
                found[tuple(sorted((a, b, c), reverse=True))] = None
        if (b := best(room // 3)) is not None and (c := best((room - b) // 2)) and (d := best(room - b - c)):
            found[tuple(sorted((a, b, c, d), reverse=True))] = None
    return sorted(found, key=lambda p: (-sum(p), len(p), p))


def pack_histogram(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) that use every counted length exactly as often as it occurs."""
    left = Counter({k: v for k, v in counts.items() if v})
    out: list[tuple[tuple[int, ...], int]] = []
    if left[size]:
        out.append(((size,), left.pop(size)))
    columns = [(p, list(Counter(p).items())) for p in patterns(left, size) if len(p) > 1]
    rest = np.zeros(size + 1)
    for k, v in left.items():
        rest[k] = v
    repeats = [0.0] * len(columns)
    for _ in range(SWEEPS):
        for j, (_, uses) in enumerate(columns):
            step = sum(m * rest[k] for k, m in uses) / sum(m * m for _, m in uses)
            step = max(step, -repeats[j])
            if step:
                repeats[j] += step
                for k, m in uses:
                    rest[k] -= m * step
    for (pattern, uses), x in zip(columns, repeats):
        n = min([int(x)] + [left[k] // m for k, m in uses])
        if n > 0:
            out.append((pattern, n))
            for k, m in uses:
                left[k] -= m * n
    present = sorted(k for k, v in left.items() if v > 0)
    while present:
        pattern, room, used = [], size, Counter()
        while True:
            k = bisect_right(present, room)
            while k and left[present[k - 1]] <= used[present[k - 1]]:
                k -= 1
            if not k:
                break
            pattern.append(present[k - 1])
            used[present[k - 1]] += 1
            room -= present[k - 1]
        n = min(left[k] // m for k, m in used.items())
        out.append((tuple(pattern), n))
        for k, m in used.items():
            left[k] -= m * n
        present = [k for k in present if left[k] > 0]
    return out


def _slots(plan: list[tuple[tuple[int, ...], int]], size: int) -> np.ndarray:
    """Rows (length * big + first rank, first sequence, places in a sequence, first offset), sorted."""
    taken, rows, sequence = Counter(), [], 0
    for pattern, repeats in plan:
        offset = 0
        for length, m in Counter(pattern).items():
            rows.append(((length << 48) + taken[length], sequence, m, offset))
            taken[length] += m * repeats
            offset += m * length
        sequence += repeats
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def _place(slots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            key = (length << 48) + rank
            at = np.searchsorted(slots[:, 0], key, side="right") - 1
            first, sequence, places, offset = slots[at].T if len(key) else np.zeros((4, 0), np.int64)
            k = key - first
            table = pa.Table.from_batches([batch.drop_columns(["rank"])])
            table = table.append_column("sequence_id", pa.array(sequence + k // np.maximum(places, 1)))
            table = table.append_column("offset", pa.array(offset + (k % np.maximum(places, 1)) * length))
            yield from table.to_batches()

    return run


def pieces_of(docs: DataFrame, tokenizer: str, stages: Stages, size: int = 2048, end_id: int = 0, checksums: bool = False) -> DataFrame:
    """Stored pieces ``(doc_id, piece, start, length, part, local, ids)``; ids are little-endian 32-bit.

    With ``checksums`` there is ``ids_crc32``, their unsigned CRC-32, in place of the ids.
    """
    small_batches(docs.sparkSession)
    last = "ids_crc32 long" if checksums else "ids binary"
    return stages.store(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            _pieces(tokenizer, end_id, size, checksums),
            f"doc_id long, piece int, start long, length long, part int, local long, {last}"), "pieces")


def pack(pieces: DataFrame, size: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with ``length, part, local``, and drop these last two.

    Null or empty text is a document of the end id alone.  Null or repeated ``doc_id``: each row is a
    document of its own.  Empty table: empty result.
    """
    each = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in each.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = _slots(pack_histogram(histogram, size), size)
    before = each.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    ranked = pieces.join(before, ["length", "part"]).withColumn("rank", F.col("local") + F.col("before")).drop("local", "part", "before")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.drop("rank").schema.fields)
    return ranked.mapInArrow(_place(slots), f"{fields}, sequence_id long, offset long")


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences: ``(sequence_id, ids)``, at most ``size`` ids each."""
    rows = pieces.select("doc_id", "piece", "ids").join(placed.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])
    return (rows.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids")))
