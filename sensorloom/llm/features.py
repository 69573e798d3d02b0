"""Hashed features of whole texts, and bounded samples to learn from."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.hashed_text import bytes_and_bounds, groups, mix, word_hashes, word_spans

#: Texts of a group are counted in one matrix.
GROUP_TEXTS = 256


def _counts(group: np.ndarray, slots: np.ndarray, size: int, slots_each: int) -> np.ndarray:
    at = group * slots_each + slots
    return np.bincount(at, minlength=size * slots_each).reshape(size, slots_each).astype(np.float32)


def _unit(counts: np.ndarray) -> np.ndarray:
    weights = np.sqrt(counts)
    return weights / np.maximum(np.sqrt((weights**2).sum(axis=1, keepdims=True)), 1e-9)


def text_groups(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    raw, bounds = bytes_and_bounds(texts)
    for first, last in groups(bounds):
        for low in range(first, last, GROUP_TEXTS):
            high = min(low + GROUP_TEXTS, last)
            yield low, high, raw[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]


def trigrams(raw: np.ndarray, bounds: np.ndarray, slots: int) -> np.ndarray:
    """Counts of hashed byte trigrams, one row per text; none crosses two texts."""
    size = len(bounds) - 1
    if len(raw) < 3:
        return np.zeros((size, slots), np.float32)
    wide = raw.astype(np.uint32)
    codes = wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)
    hashed = (codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - (slots - 1).bit_length())
    text = np.repeat(np.arange(size), np.diff(bounds))
    inside = text[:-2] == text[2:]
    return _counts(text[:-2][inside], hashed[inside].astype(np.int64), size, slots)


def word_counts(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text: words, distinct words, words that repeat the one before."""
    size = len(bounds) - 1
    begins, ends = word_spans(raw, bounds)
    hashes = word_hashes(raw, begins, ends)
    text = np.searchsorted(bounds, begins, side="right") - 1
    total = np.bincount(text, minlength=size)
    again = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    repeats = np.bincount(text[1:][again], minlength=size)
    own = mix(hashes + text.astype(np.uint64) * np.uint64(0x9E37_79B9_7F4A_7C15))
    _, first = np.unique(own, return_index=True)
    distinct = np.bincount(text[first], minlength=size)
    return np.stack([total, distinct, repeats], axis=1)


def sample(rows: DataFrame, label: str, per_label: int, in_all: int | None = None) -> DataFrame:
    """At most ``per_label`` documents of each label, the first by a hash of the doc_id.

    ``in_all`` bounds all labels together: each then gets an equal share at most, and
    one document at least.  A document that is repeated counts once.  Labels with more
    documents are thinned by the hash to about one and a half times the bound first,
    within each task, so that no task ranks all documents of a label; how many there
    are is estimated for that, without gathering ids.
    """
    order = F.shiftrightunsigned(F.xxhash64("doc_id"), 11)
    counts = rows.groupBy(label).agg(F.approx_count_distinct("doc_id").alias("_count"))
    if in_all is not None:
        per_label = max(1, min(per_label, in_all // max(counts.count(), 1)))
    limit = F.greatest(F.lit(1.5 * per_label), F.lit(100.0)) / F.col("_count") * 2.0**53
    thinned = rows.select("doc_id", label).join(F.broadcast(counts), label).filter(order <= limit)
    ranked = thinned.select("doc_id", label).distinct().withColumn(
        "_rank", F.row_number().over(Window.partitionBy(label).orderBy(order, "doc_id"))
    )
    return ranked.filter(F.col("_rank") <= per_label).select("doc_id", label)


def one_text_each(texts: DataFrame, chosen: DataFrame, label: str) -> DataFrame:
    """(doc_id, label, text) of the chosen documents; of several rows of one, the least text."""
    own = texts.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return own.groupBy("doc_id", label).agg(F.min("text").alias("text"))
