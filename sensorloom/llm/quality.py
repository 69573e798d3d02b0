"""Quality by ordinal regression with cumulative links on graded ratings.

Grades are 0 (toxic), 1 (poor) and 2 (good).  With one weight vector ``w`` over
hashed features of a text and ordered thresholds ``t0 < t1``,

    P(grade <= k) = sigmoid(t_k - w . x)

which gives the expected grade and the tail probability ``P(grade >= 2)`` by
which documents are selected.

Features are the presence of words, hashed to ``WORD_SLOTS`` slots after signs
are taken off them, and the shape of the text.  Presence does not fade in long
texts, as a share of words would.  Slots that differ most between the grades
below and above a threshold get a weight, ``KEPT_SLOTS`` for each threshold.

The model is fitted on the driver to about ``PER_GRADE`` rated documents of each
grade at most, whose whole texts become features in tasks; all are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm import features
from sensorloom.llm.hashed_text import word_hashes, word_spans
from sensorloom.llm.workers import sparing

#: Bound of the sample to learn from.
PER_GRADE = 4000
WORD_SLOTS = 1 << 20
KEPT_SLOTS = 256
#: A slot that fewer documents of the sample have is not looked at.
LEAST_DOCUMENTS = 5
GRADES = 3
#: Probability of the highest grade from which a document is selected.
SELECTED_FROM = 0.3
SHAPES = 8
_SCORED = "doc_id long, expected_grade double, tail_probability double"

_UNSIGNED = np.arange(256, dtype=np.uint8)
_UNSIGNED[[c for c in range(33, 127) if not chr(c).isalnum()]] = 32


def parts(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of texts: number of the text and slot of each word, and shape features per text."""
    for _, _, raw, bounds in features.text_groups(texts):
        plain = _UNSIGNED[raw]
        begins, ends = word_spans(plain, bounds)
        text = np.searchsorted(bounds, begins, side="right") - 1
        slots = (word_hashes(plain, begins, ends) & np.uint64(WORD_SLOTS - 1)).astype(np.int64)
        yield text, slots, _shape(raw, bounds)


def _shape(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    counted = features.word_counts(raw, bounds)
    total, size = np.maximum(counted[:, 0], 1), np.maximum(np.diff(bounds), 1)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))

    def share(chosen: np.ndarray) -> np.ndarray:
        return np.bincount(text[chosen], minlength=len(size)) / size

    upper = (raw >= 65) & (raw <= 90)
    lower = (raw >= 97) & (raw <= 122)
    digit = (raw >= 48) & (raw <= 57)
    blank = (raw == 32) | (raw == 10)
    sign = (raw < 128) & ~(upper | lower | digit | blank)
    columns = [
        np.log1p(counted[:, 0]) / 10, counted[:, 1] / total, counted[:, 2] / total,
        size / total / 20, share(upper), share(digit), share(sign), share(raw >= 128),
    ]
    return 5 * np.stack(columns, axis=1).astype(np.float32)


@dataclass(frozen=True)
class Ordinal:
    """Weights of the kept slots, in order, then of the shape features; ordered thresholds."""

    slots: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def rows(self, text: np.ndarray, slots: np.ndarray, shape: np.ndarray) -> np.ndarray:
        """Feature rows of the texts that ``parts`` gives."""
        rows = np.zeros((len(shape), len(self.slots) + SHAPES), np.float32)
        rows[:, len(self.slots) :] = shape
        if len(self.slots):
            place = np.minimum(np.searchsorted(self.slots, slots), len(self.slots) - 1)
            known = self.slots[place] == slots
            rows[text[known], place[known]] = 1
        return rows

    def tails(self, rows: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, .. as columns."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - (rows @ self.weights)[:, None], -40, 40)))


def choose_slots(slots: list[np.ndarray], grades: np.ndarray, kept: int = KEPT_SLOTS) -> np.ndarray:
    """Slots by the difference of their shares below and above each threshold, in its error."""
    documents = np.zeros((GRADES, WORD_SLOTS))
    for grade, own in zip(grades.tolist(), slots, strict=True):
        documents[grade, own] += 1
    sizes = np.bincount(grades, minlength=GRADES)
    chosen: set[int] = set()
    for cut in range(1, GRADES):
        low, high = documents[:cut].sum(axis=0), documents[cut:].sum(axis=0)
        n_low, n_high = max(sizes[:cut].sum(), 1), max(sizes[cut:].sum(), 1)
        share = (low + high) / (n_low + n_high)
        error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n_low + 1 / n_high))
        gap = np.abs(low / n_low - high / n_high) / error
        gap[low + high < LEAST_DOCUMENTS] = 0
        best = np.argsort(-gap, kind="stable")[:kept]
        chosen.update(best[gap[best] > 0].tolist())
    return np.array(sorted(chosen), np.int64)


def fit(
    rows: np.ndarray, grades: np.ndarray, slots: np.ndarray, rounds: int = 300, decay: float = 1e-4
) -> Ordinal:
    """Maximum likelihood with a small penalty, each grade counting alike (Adam)."""
    counts = np.bincount(grades, minlength=GRADES)
    share = 1 / counts[grades] / (counts > 0).sum()
    # Thresholds as a first one and logarithms of the gaps stay in order.
    state = np.zeros(rows.shape[1] + GRADES - 1)
    state[-(GRADES - 1)] = -0.5
    first, second = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, rounds + 1):
        w, cuts = state[: rows.shape[1]], _cuts(state[rows.shape[1] :])
        edges = np.concatenate(([-np.inf], cuts, [np.inf]))
        at = (rows @ w.astype(np.float32)).astype(np.float64)
        high, low = _sigmoid(edges[grades + 1] - at), _sigmoid(edges[grades] - at)
        likely = np.maximum(high - low, 1e-9)
        d_high, d_low = high * (1 - high) / likely * share, low * (1 - low) / likely * share
        grad = np.zeros_like(state)
        grad[: rows.shape[1]] = ((d_high - d_low).astype(np.float32) @ rows) + decay * w
        d_cut = np.array([
            -d_high[grades == k].sum() + d_low[grades == k + 1].sum() for k in range(GRADES - 1)
        ])
        gaps = np.exp(state[rows.shape[1] + 1 :])
        grad[rows.shape[1]] = d_cut.sum()
        grad[rows.shape[1] + 1 :] = [d_cut[k + 1 :].sum() * g for k, g in enumerate(gaps)]
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        state -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Ordinal(slots, state[: rows.shape[1]].astype(np.float32), _cuts(state[rows.shape[1] :]))


def _cuts(raw: np.ndarray) -> np.ndarray:
    return raw[0] + np.concatenate(([0.0], np.cumsum(np.exp(raw[1:]))))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def grades(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of rated documents: toxic 0, poor 1, good 2; unrated ones fall out.

    Of several ratings of a document the lowest counts.
    """
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(
        F.col("quality") == 1, 2
    )
    rated = labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade"))
    return rated.filter("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(
        F.min("grade").cast("int").alias("grade")
    )


def train(documents: DataFrame, rated: DataFrame, per_grade: int = PER_GRADE) -> Ordinal | None:
    """Fit to a sample of rated documents; None if no document is rated.

    Rated ids without a document, and documents without words, teach nothing.  A
    repeated document counts once; of several texts of one the least is learnt from.
    """
    chosen = features.sample(rated, "grade", per_grade)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = features.one_text_each(texts.filter("text IS NOT NULL"), chosen, "grade")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots, shapes = [], []
            for text, own, shape in parts(batch.column("text")):
                ends = np.searchsorted(text, np.arange(len(shape) + 1))
                slots += [np.unique(own[a:b]).astype(np.int32).tobytes() for a, b in zip(ends, ends[1:])]
                shapes += [row.tobytes() for row in shape]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("grade"), pa.array(slots, pa.binary()),
                 pa.array(shapes, pa.binary())],
                names=["doc_id", "grade", "slots", "shape"],
            )

    got = known.mapInArrow(run, "doc_id long, grade int, slots binary, shape binary").toArrow()
    if not got.num_rows:
        return None
    got = got.sort_by([("doc_id", "ascending"), ("slots", "ascending")])
    rated_as = got.column("grade").to_numpy().astype(np.int64)
    slots = [np.frombuffer(own, np.int32).astype(np.int64) for own in got.column("slots").to_pylist()]
    shape = np.frombuffer(b"".join(got.column("shape").to_pylist()), np.float32).reshape(-1, SHAPES)
    blank = Ordinal(choose_slots(slots, rated_as), np.empty(0), np.empty(0))
    text = np.repeat(np.arange(len(slots)), [len(own) for own in slots])
    return fit(blank.rows(text, np.concatenate(slots), shape), rated_as, blank.slots)


def scored(documents: DataFrame, model: Ordinal | None) -> DataFrame:
    """(doc_id, expected_grade, tail_probability) of each row of (doc_id, text).

    A null text counts as empty; a text without words has grade 0 and
    probability 0.  Without a model, nothing is known: all other texts have the
    highest grade and probability 1.  Rows are independent, so repeated ones
    have equal results; a null doc_id stays null; an empty table gives no rows.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tails = tails_of(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(tails.sum(axis=1)), pa.array(tails[:, -1])],
                names=["doc_id", "expected_grade", "tail_probability"],
            )

    frame = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return frame.mapInArrow(run, _SCORED)


def tails_of(texts: pa.Array, model: Ordinal | None) -> np.ndarray:
    tails = [np.empty((0, GRADES - 1))]
    for text, slots, shape in parts(texts):
        part = np.ones((len(shape), GRADES - 1))
        if model is not None:
            part = model.tails(model.rows(text, slots, shape))
        part[shape[:, 0] == 0] = 0  # without words
        tails.append(part)
    return np.concatenate(tails)


def selected(documents: DataFrame, labels: DataFrame, least: float = SELECTED_FROM) -> DataFrame:
    """The rows whose probability of the highest grade is ``least`` or more, all columns kept.

    Each row is judged by its own text where it is, so nothing is shuffled for
    it; rows without words go.
    """
    model = train(documents, grades(labels))
    shared = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = tails_of(batch.column(at), shared.value)[:, -1] >= least
            yield batch.filter(pa.array(good))

    return documents.mapInArrow(sparing(run), documents.schema)
