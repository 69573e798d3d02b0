"""Language of a text by hierarchical discrimination.

A linear classifier tells the language family first.  Within each family, one
linear support vector machine for each pair of languages tells them apart by
majority, ties by the sum of margins.  Features are hashed byte trigrams of the
lower-cased text; models are fitted on the driver to at most ``PER_LANGUAGE``
documents of each language, and to ``IN_ALL`` of all together.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm import features

PER_LANGUAGE, IN_ALL = 1000, 8000
SLOTS = 8192
UNKNOWN = "und"
#: Families of common languages; any other is a family of its own.
FAMILIES = {
    "germanic": ("de", "en", "nl", "sv", "da", "no", "is", "af", "lb", "fy"),
    "romance": ("es", "fr", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
}
_HAS_LETTER = regex.compile(r"\p{L}").search
_PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


def family(language: str) -> str:
    return next((name for name, own in FAMILIES.items() if language in own), language)


def feature_rows(texts: list[str]) -> Iterator[np.ndarray]:
    lowered = pa.array([text.lower() for text in texts], pa.large_string())
    for _, _, raw, bounds in features.text_groups(lowered):
        yield features._unit(features.trigrams(raw, bounds, SLOTS))


def linear_svm(rows: np.ndarray, positive: np.ndarray, rounds: int = 120, decay: float = 1e-4):
    """Weights and bias of a squared-hinge machine, both sides counting alike (Adam)."""
    sign = np.where(positive, 1.0, -1.0)
    share = np.where(positive, 0.5 / max(positive.sum(), 1), 0.5 / max((~positive).sum(), 1))
    state = np.zeros(rows.shape[1] + 1)
    first, second = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, rounds + 1):
        margin = sign * (rows @ state[:-1].astype(np.float32) + state[-1])
        pull = -2 * sign * np.maximum(1 - margin, 0) * share
        grad = np.append(pull.astype(np.float32) @ rows, pull.sum()) + decay * state
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        state -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return state[:-1].astype(np.float32), float(state[-1])


@dataclass(frozen=True)
class Languages:
    """``machines`` has a row of weights for each family, then for each pair within one."""

    names: tuple[str, ...]
    families: tuple[str, ...]
    pairs: tuple[tuple[int, int], ...]
    machines: np.ndarray
    biases: np.ndarray

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the language and a score from 0 to 1 for each row."""
        margins = rows @ self.machines.T + self.biases
        count = len(self.families)
        by_family = _softmax(2 * margins[:, :count])
        chosen = by_family.argmax(axis=1)
        own = np.array([self.families.index(family(name)) for name in self.names])
        votes = np.where(own[None] == chosen[:, None], 0.0, -np.inf)
        belief = np.zeros((len(rows), len(self.names)))
        for k, (a, b) in enumerate(self.pairs):
            margin = margins[:, count + k]
            votes[:, a] += (margin >= 0) + 1e-3 * np.tanh(margin)
            votes[:, b] += (margin < 0) - 1e-3 * np.tanh(margin)
            belief[:, a] += margin
            belief[:, b] -= margin
        best = votes.argmax(axis=1)
        within = np.where(own[None] == chosen[:, None], 2 * belief, -np.inf)
        at = np.arange(len(rows))
        return best, by_family[at, chosen] * _softmax(within)[at, best]


def _softmax(x: np.ndarray) -> np.ndarray:
    if not x.size:
        return x
    grown = np.exp(x - x.max(axis=1, keepdims=True))
    return grown / grown.sum(axis=1, keepdims=True)


def fit(rows: np.ndarray, labels: list[str]) -> Languages:
    names = tuple(sorted(set(labels)))
    families = tuple(sorted({family(name) for name in names}))
    number = np.array([names.index(label) for label in labels])
    own = np.array([families.index(family(label)) for label in labels])
    pairs = tuple(
        (a, b)
        for a, b in itertools.combinations(range(len(names)), 2)
        if family(names[a]) == family(names[b])
    )
    machines = [linear_svm(rows, own == k) for k in range(len(families))]
    for a, b in pairs:
        both = (number == a) | (number == b)
        machines.append(linear_svm(rows[both], number[both] == a))
    weights, biases = zip(*machines, strict=True)
    return Languages(names, families, pairs, np.stack(weights), np.array(biases, np.float32))


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def train(
    documents: DataFrame, per_language: int = PER_LANGUAGE, in_all: int = IN_ALL
) -> Languages | None:
    """Fit to a sample of (doc_id, text, lang) that is not held out; None if there is none.

    A repeated document counts once; of several texts of one the least is learnt from.
    The driver gets the trigrams that a document has, for ``in_all`` documents at most.
    """
    known = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter(
        F.col("lang").isNotNull() & (remainder(F.col("doc_id")) != 2)
    )
    chosen = features.sample(known, "lang", per_language, in_all)
    own = known.join(F.broadcast(chosen), ["doc_id", "lang"])
    texts = own.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [text or "" for text in batch.column("text").to_pylist()]
            slots, weights = [], []
            for rows in feature_rows(held):
                for row in rows:
                    at = np.flatnonzero(row)
                    slots.append(at.astype(np.uint16).tobytes())
                    weights.append(row[at].astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), pa.array(slots, pa.binary()),
                 pa.array(weights, pa.binary())],
                names=["doc_id", "lang", "slots", "weights"],
            )

    schema = "doc_id long, lang string, slots binary, weights binary"
    got = texts.mapInArrow(run, schema).toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("lang", "ascending")])
    if not got.num_rows:
        return None
    rows = np.zeros((got.num_rows, SLOTS), np.float32)
    for row, slots, weights in zip(rows, *(got.column(c).to_pylist() for c in ("slots", "weights")), strict=True):
        row[np.frombuffer(slots, np.uint16)] = np.frombuffer(weights, np.float16)
    return fit(rows, got.column("lang").to_pylist())


def predicted(documents: DataFrame, model: Languages | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row, from its text alone.

    A null text, and one without any letter, is ``und`` with score 0; so is
    every text if there was nothing to learn from.  ``held_out`` is false for a
    null doc_id.  Rows are independent, repeated ones have equal results, an
    empty table gives no rows.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            best, scores = np.full(len(texts), -1), np.zeros(len(texts))
            if own is not None and texts:
                found = [own.predict(rows) for rows in feature_rows(texts)]
                best = np.concatenate([b for b, _ in found])
                scores = np.concatenate([s for _, s in found])
            lettered = np.fromiter((_HAS_LETTER(t) is not None for t in texts), bool, len(texts))
            best = np.where(lettered, best, -1)
            names = [own.names[b] if b >= 0 else UNKNOWN for b in best.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()),
                 pa.array(np.where(best >= 0, np.clip(scores, 0, 1), 0.0))],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    frame = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.coalesce(remainder(F.col("doc_id").cast("long")) == 2, F.lit(False)).alias("held_out"),
    )
    return frame.mapInArrow(run, _PREDICTED)
