"""Token-id files of patched frame-of-reference blocks.

A file is Parquet, so that any store and Spark's commit protocol serve it; each record is a segment of
whole documents in ascending ``doc_id`` order:

* ``shard``, ``segment``: order of the segments; ``doc_ids``, ``lengths``: its documents;
* ``body``: ``PFR1``, number of blocks and of values, start of each block, then the blocks.

A block of 1,024 values holds its minimum, the bit width that fits ``PERCENTILE`` % of the differences to it,
the differences packed at that width, and the exceptions as lists of places and whole differences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellscape.llm.encoder import encoder
from cellscape.llm.stage import BROADCAST_ROWS, small_batches

BLOCK = 1024
PERCENTILE = 95
SEGMENT = 1 << 18
MAGIC = b"PFR1"


def _pack(values: np.ndarray, w: int) -> np.ndarray:
    """Rows of ``BLOCK`` values as bytes, ``w`` bits a value from the lowest bit on; 64 values fill ``w`` words."""
    columns = np.ascontiguousarray(values.reshape(len(values) * (BLOCK // 64), 64).T).astype(np.uint64)
    if w < 32:
        columns &= np.uint64((1 << w) - 1)
    words = np.zeros((w, columns.shape[1]), dtype=np.uint64)
    for i in range(64):
        word, shift = divmod(i * w, 64)
        words[word] |= columns[i] << np.uint64(shift)
        if shift + w > 64:
            words[word + 1] |= columns[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8").view(np.uint8).reshape(len(values), BLOCK * w // 8)


def _unpack(lines: np.ndarray, w: int) -> np.ndarray:
    """The rows of values that ``_pack`` made bytes of."""
    words = np.ascontiguousarray(lines.view("<u8").reshape(-1, w).T)
    out = np.empty((64, words.shape[1]), dtype=np.uint32)
    mask = np.uint64((1 << w) - 1)
    for i in range(64):
        word, shift = divmod(i * w, 64)
        value = words[word] >> np.uint64(shift)
        if shift + w > 64:
            value |= words[word + 1] << np.uint64(64 - shift)
        out[i] = value & mask
    return np.ascontiguousarray(out.T).reshape(len(lines), BLOCK)


def pack_body(values: np.ndarray) -> bytes:
    """The blocks of some 32-bit values."""
    n = len(values)
    blocks = -(-n // BLOCK)
    padded = np.empty(blocks * BLOCK, dtype=np.uint32)
    padded[:n] = values
    if n:
        padded[n:] = values[-1]
    padded = padded.reshape(blocks, BLOCK)
    low = padded.min(axis=1, initial=2**32 - 1)
    above = padded - low[:, None]
    cut = np.partition(above, BLOCK * PERCENTILE // 100, axis=1)[:, BLOCK * PERCENTILE // 100] if blocks else low
    width = np.ceil(np.log2(cut.astype(np.float64) + 1)).astype(np.int64)
    packed: list[bytes] = [b""] * blocks
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w:
            for r, line in zip(rows, _pack(above[rows], int(w))):
                packed[r] = line.tobytes()
    odd_row, odd_place = np.nonzero(above >= (np.uint64(1) << width.astype(np.uint64))[:, None])
    edges = np.searchsorted(odd_row, np.arange(blocks + 1))
    parts, starts, at = [], [], 0
    for b in range(blocks):
        odd = odd_place[edges[b]: edges[b + 1]]
        part = (int(low[b]).to_bytes(4, "little") + int(width[b]).to_bytes(1, "little") + len(odd).to_bytes(2, "little")
                + packed[b] + odd.astype("<u2").tobytes() + above[b, odd].astype("<u4").tobytes())
        parts.append(part)
        starts.append(at)
        at += len(part)
    head = MAGIC + blocks.to_bytes(4, "little") + n.to_bytes(8, "little") + np.array(starts, dtype="<u4").tobytes()
    return head + b"".join(parts)


def unpack_body(body: bytes) -> np.ndarray:
    """All values of a body."""
    if body[:4] != MAGIC:
        raise ValueError("not a token segment")
    blocks, n = int.from_bytes(body[4:8], "little"), int.from_bytes(body[8:16], "little")
    starts = np.frombuffer(body, dtype="<u4", count=blocks, offset=16).astype(np.int64) + 16 + 4 * blocks
    out = np.zeros((blocks, BLOCK), dtype=np.uint32)
    raw = np.frombuffer(body, dtype=np.uint8)
    widths = raw[starts + 4].astype(np.int64)
    for w in np.unique(widths):
        rows = np.flatnonzero(widths == w)
        if w:
            size = BLOCK * int(w) // 8
            lines = np.stack([raw[at: at + size] for at in starts[rows] + 7])
            out[rows] = _unpack(lines, int(w))
    for b in range(blocks):
        at = int(starts[b])
        odd = int.from_bytes(body[at + 5: at + 7], "little")
        if odd:
            at += 7 + BLOCK * int(widths[b]) // 8
            place = np.frombuffer(body, dtype="<u2", count=odd, offset=at)
            out[b, place] = np.frombuffer(body, dtype="<u4", count=odd, offset=at + 2 * odd)
        out[b] += np.uint32(int.from_bytes(body[starts[b]: starts[b] + 4], "little"))
    return out.reshape(-1)[:n]


SEGMENTS = "shard int, segment int, doc_ids array<long>, lengths array<long>, n_values long, body binary"


def _write(path: str, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def segment(number: int, docs: list, texts: list[bytes]) -> pa.RecordBatch:
        body = pack_body(np.frombuffer(b"".join(texts), dtype="<u4"))
        lengths = [len(t) // 4 for t in texts]
        return pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([number], pa.int32()),
             pa.array([docs], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
             pa.array([sum(lengths)], pa.int64()), pa.array([body], pa.binary())],
            ["shard", "segment", "doc_ids", "lengths", "n_values", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        number, docs, texts, held = 0, [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = own.encode(text.as_py() or "") + end
                docs.append(doc)
                texts.append(ids)
                held += len(ids) // 4
                if held >= SEGMENT:
                    yield segment(number, docs, texts)
                    number, docs, texts, held = number + 1, [], [], 0
        if docs:
            yield segment(number, docs, texts)

    return run


def write_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2) -> None:
    """Encode ``docs(doc_id, text)`` and write segments in ascending ``doc_id`` order, one range per task.

    Null or empty text: the end id alone.  Null ``doc_id``: first.  Rows that share a ``doc_id``: one after
    another, by text.  Empty table: no segment.  Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(parts, "doc_id")
     .sortWithinPartitions("doc_id", "text").mapInArrow(_write(tokenizer, end_id), SEGMENTS).write.parquet(folder))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            values = unpack_body(batch.column("body")[row].as_py())
            docs, lengths = batch.column("doc_ids")[row].as_py(), batch.column("lengths")[row].as_py()
            ends = np.cumsum(lengths)
            begins = ends - lengths
            step = 1000
            for lo in range(0, len(docs), step):
                hi = min(len(docs), lo + step)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs[lo:hi], pa.int64()), pa.array(begins[lo:hi] + batch.column("before")[row].as_py(), pa.int64()),
                     pa.array(lengths[lo:hi], pa.int64()),
                     pa.array([values[a:b].astype("<u4").tobytes() for a, b in zip(begins[lo:hi], ends[lo:hi])], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])


def read_files(spark: SparkSession, folder: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` from the files; ``ids`` are little-endian unsigned 32-bit integers."""
    segments = spark.read.schema(SEGMENTS).parquet(folder)
    # one row for each shard, that is for each task that wrote; then a sum inside each shard
    totals = segments.groupBy("shard").agg(F.sum("n_values").alias("n"))
    before = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_before"))
    inside = segments.select("shard", "segment", (F.sum("n_values").over(
        Window.partitionBy("shard").orderBy("segment")) - F.col("n_values")).alias("inside"))
    starts = inside.join(before, "shard").select("shard", "segment", (F.col("inside") + F.col("shard_before")).alias("before"))
    # the bodies stay where they are while the table of starts, three numbers a segment, is small
    if segments.count() <= broadcast_rows:
        starts = F.broadcast(starts)
    return (segments.join(starts, ["shard", "segment"]).select("doc_ids", "lengths", "body", "before")
            .mapInArrow(_read, "doc_id long, start long, n_tokens long, ids binary"))
