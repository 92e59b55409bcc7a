"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

P(grade <= k) = 1 / (1 + exp(-(c_k - w.x))): one weight vector shared by ordered thresholds c_1 < c_2 < ...
x marks which words, and which word beginnings of 4, 5 and 6 bytes, a text has; the expected severity is the
sum of P(grade >= k).  The model is fitted on at most ``SAMPLE`` labelled rows (those with the smallest hash
of their id), four fifths for the weights and one fifth for the severity from which a text is rejected.
Scoring reads every word of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellscape.llm import wordhash as wh
from cellscape.llm.encoder import forget
from cellscape.llm.stage import small_batches

SAMPLE = 8000
BITS = 22
CUTS = (None, 4, 5, 6)
STEPS = 150
RATE = 0.1
SHRINK = 2e-4
LEAST_ROWS = 5
#: A feature is used if its count among the graded rows is so many standard deviations from chance.
DEVIATIONS = 4.0
LEAST_LIMIT = 0.3
LONG = np.int64


def features(data: np.ndarray, bounds: np.ndarray, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs of some texts, sorted; with ``kept``, only features whose entry is true."""
    pairs = []
    for k, cut in enumerate(CUTS):
        words = wh.scan(data, bounds, wh.NOT_ALNUM, lower=True, cut=cut)
        text, mark = words.text_of(), (wh.mix(words.hash + np.uint64(k)) >> np.uint64(64 - BITS)).astype(LONG)
        use = kept[mark] if kept is not None else np.ones(len(mark), dtype=bool)
        if cut is not None:
            use &= words.end - words.start >= cut
        pairs.append((text[use].astype(LONG) << BITS) + mark[use])
    both = np.unique(np.concatenate(pairs))
    return both >> BITS, both & ((1 << BITS) - 1)


def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    for batch in batches:
        out: list[bytes] = []
        for _, data, bounds in wh.chunks(batch.column("text")):
            text, mark = features(data, bounds)
            edges = np.searchsorted(text, np.arange(len(bounds)))
            out.extend(mark[a:b].astype(np.int32).tobytes() for a, b in zip(edges[:-1], edges[1:]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), pa.array(out, pa.binary())],
                                         ["doc_id", "mark", "features"])


@dataclass
class Model:
    weights: np.ndarray  # one for each feature, shared by all thresholds
    cuts: np.ndarray  # ascending
    limit: float  # expected severity from which a text is rejected

    def severity(self, score: np.ndarray) -> np.ndarray:
        return _squash(score[:, None] - self.cuts).sum(axis=1)


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(rows: list[np.ndarray], grades: np.ndarray, levels: int) -> Model:
    """Maximum likelihood by full-batch AdaGrad, with a small ridge penalty."""
    if not rows:
        return Model(np.zeros(1 << BITS, dtype=np.float32), np.full(levels - 1, 10.0), 0.5 * (levels - 1))
    keep = telling(rows, grades > 0)
    rows = [r[keep[r]] for r in rows]
    rows_of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    marks = np.concatenate([*rows, np.empty(0, np.int32)]).astype(LONG)
    used, column = np.unique(marks, return_inverse=True)
    w, steps_w = np.zeros(len(used)), np.full(len(used), 1e-8)
    share = np.array([(grades >= k).mean() for k in range(1, levels)]).clip(1e-3, 1 - 1e-3)
    cuts = np.sort(np.log((1 - share) / share)) + np.arange(levels - 1) * 1e-3
    first, gaps = cuts[0], np.log(np.maximum(np.diff(cuts), 1e-3))
    steps_c = np.full(levels - 1, 1e-8)
    n = max(1, len(rows))
    for _ in range(STEPS):
        cuts = first + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        score = np.bincount(rows_of, w[column], minlength=len(rows))
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        top, low = _squash(edges[grades + 1] - score), _squash(edges[grades] - score)
        top[grades == levels - 1], low[grades == 0] = 1, 0
        p = np.maximum(top - low, 1e-9)
        grad_w = np.bincount(column, (1 - top - low)[rows_of] / n, minlength=len(used)) + SHRINK * w
        density_top, density_low = top * (1 - top) / p, low * (1 - low) / p
        grad_cut = np.zeros(levels + 1)
        np.add.at(grad_cut, grades + 1, -density_top / n)
        np.add.at(grad_cut, grades, density_low / n)
        grad_cut = grad_cut[1:levels]
        tail = np.cumsum(grad_cut[::-1])[::-1]
        grad_c = np.concatenate([[tail[0]], tail[1:] * np.exp(gaps)])
        steps_w += grad_w**2
        steps_c += grad_c**2
        w -= RATE * grad_w / np.sqrt(steps_w)
        move = RATE * grad_c / np.sqrt(steps_c)
        first -= move[0]
        gaps = np.clip(gaps - move[1:], -7, 3)
    weights = np.zeros(1 << BITS, dtype=np.float32)
    weights[used] = np.where(np.abs(w) < 1e-3, 0, w)
    return Model(weights, first + np.concatenate([[0], np.cumsum(np.exp(gaps))]), 0.5 * (levels - 1))


def _counts(rows: list[np.ndarray]) -> np.ndarray:
    """In how many rows each feature stands; a row has it once."""
    out = np.zeros(1 << BITS, dtype=np.int32)
    for r in rows:
        out[r] += 1
    return out


def telling(rows: list[np.ndarray], bad: np.ndarray) -> np.ndarray:
    """Which features stand in the bad rows far more or less often than by chance."""
    every, own = _counts(rows), _counts([r for r, u in zip(rows, bad) if u])
    share, out = bad.mean() if len(bad) else 0.0, np.zeros(1 << BITS, dtype=bool)
    some = np.flatnonzero(every >= LEAST_ROWS)
    n = every[some]
    out[some] = np.abs(own[some] - share * n) > DEVIATIONS * np.sqrt(np.maximum(n * share * (1 - share), 1e-9))
    return out


def make_grades(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Grades 0 to 3 from a 0/1 mark: toxic rows by how many toxic features they have (up to 4, up to 10, more).

    A toxic feature stands in toxic rows far more often than by chance, and in them mostly.
    """
    bad = toxic > 0
    mark = telling(rows, bad) & (_counts([r for r, b in zip(rows, bad) if b]) > _counts([r for r, b in zip(rows, bad) if not b]))
    hits = np.array([mark[r].sum() for r in rows]) if rows else np.empty(0)
    return np.where(bad, 1 + (hits > 4) + (hits > 10), 0).astype(LONG)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on labelled documents; ``labels`` has ``doc_id`` and ``toxic`` (0/1, nulls ignored)."""
    spark = docs.sparkSession
    small_batches(spark)
    chosen = (labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.max("toxic").cast("int").alias("mark")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
            .mapInArrow(feature_rows, "doc_id long, mark int, features binary").toArrow().sort_by("doc_id"))
    marks = [np.frombuffer(f.as_buffer(), dtype=np.int32) for f in rows["features"]]
    toxic = (rows["mark"].to_numpy() > 0).astype(LONG)
    held = np.arange(len(marks)) % 5 == 4
    grades = make_grades([m for m, h in zip(marks, held) if not h], toxic[~held])
    levels = int(grades.max(initial=1)) + 1
    model = fit([m for m, h in zip(marks, held) if not h], grades, levels)
    if held.any() and toxic[held].any():
        severity = model.severity(np.array([model.weights[m].sum() for m, h in zip(marks, held) if h]))
        order = np.argsort(-severity, kind="stable")
        right = np.cumsum(toxic[held][order])
        f1 = 2 * right / (np.arange(1, len(order) + 1) + toxic[held].sum())
        k = int(np.argmax(f1))
        after = severity[order[k + 1]] if k + 1 < len(order) else 0.0
        # a few held-out rows must not reject what the model calls clean
        model.limit = max(float((severity[order[k]] + after) / 2), LEAST_LIMIT)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, expected_severity, grade, rejected)`` for each row; null or empty text has no features."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = shared.value
        for batch in batches:
            total = _scores(own, batch.column("text"))
            severity = own.severity(total)
            grade = (_squash(total[:, None] - own.cuts) >= 0.5).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.round(severity, 9)), pa.array(grade.astype(np.int32)), pa.array(severity >= own.limit)],
                ["doc_id", "expected_severity", "grade", "rejected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, expected_severity double, grade int, rejected boolean")


def _scores(model: Model, texts: pa.Array) -> np.ndarray:
    kept, total = model.weights != 0, np.zeros(len(texts))
    for row, data, bounds in wh.chunks(texts):
        text, mark = features(data, bounds, kept)
        n = len(bounds) - 1
        total[row: row + n] = np.bincount(text, model.weights[mark], minlength=n)
    return total


def without_rejected(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, each judged by its own text, with all their columns.

    Null or empty text has no features and stays unless the thresholds alone reject it; ids do not matter.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        own: Model = shared.value
        for batch in batches:
            yield batch.filter(pa.array(own.severity(_scores(own, batch.column("text"))) < own.limit))

    return docs.mapInArrow(run, docs.schema)


def grade_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Train on the labelled documents and score all.

    One row for each row of ``docs``; a null ``doc_id`` is scored and kept as null.  Without any labelled
    toxic document the severity is that of the thresholds alone and nothing is rejected.
    """
    return score(docs, train(docs, labels, sample))
