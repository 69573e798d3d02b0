"""Words and shingles of many texts at once, as 64-bit hashes in numpy.

A word is a run of bytes other than space and tab to carriage return, with A-Z
lower-cased.  Two different words get the same hash with a chance of about
2**-60, which the operators take as never.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MULTIPLIER = np.uint64(0x9E6C_63D0_876A_3F35)
_INVERSE = np.uint64(pow(int(_MULTIPLIER), -1, 2**64))
_MIX = (np.uint64(0xFF51_AFD7_ED55_8CCD), np.uint64(0xC4CE_B9FE_1A85_EC53))
_PAIR = (np.uint64(0xD6E8_FEB8_6659_FD93), np.uint64(0xA3B1_9535_4A39_B70D))
#: Texts are taken together up to so many bytes; a longer one is taken alone.
GROUP_BYTES = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    values = values ^ (values >> np.uint64(33))
    values = values * _MIX[0]
    values ^= values >> np.uint64(33)
    values *= _MIX[1]
    return values ^ (values >> np.uint64(33))


def _power(which: str, length: int) -> np.ndarray:
    table = _powers[which]
    if len(table) < length:
        factor = _MULTIPLIER if which == "up" else _INVERSE
        table = np.full(length, factor, np.uint64)
        table[0] = 1
        table = np.cumprod(table, dtype=np.uint64)
        if length <= 2 * GROUP_BYTES:
            _powers[which] = table
    return table[:length]


def bytes_and_bounds(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, null as empty, and where each begins; ends with the end."""
    texts = texts.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def groups(bounds: np.ndarray, most: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most so many bytes together, or of one text."""
    first = 0
    while first < len(bounds) - 1:
        last = int(np.searchsorted(bounds, bounds[first] + most, side="right")) - 1
        last = min(max(last, first + 1), len(bounds) - 1)
        yield first, last
        first = last


def word_spans(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word, by byte; no word crosses the bounds of a text."""
    word = _IS_WORD[raw]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(raw))]
    begins[inner] = word[inner]
    ends[inner - 1] = word[inner - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def word_hashes(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * _power("up", len(raw)), out=sums[1:])
    return mix((sums[ends] - sums[begins]) * _power("down", len(raw) + 1)[begins])


def word_lists(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, word hashes of some texts, where each text's begin)."""
    raw, bounds = bytes_and_bounds(texts)
    for first, last in groups(bounds):
        part, inner = raw[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        begins, ends = word_spans(part, inner)
        yield first, word_hashes(part, begins, ends), np.searchsorted(begins, inner)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words, or of all words if they are fewer."""
    if not len(words):
        return words
    size = min(size, len(words))
    runs = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        runs = mix(runs * _PAIR[0] + words[k : len(words) - size + 1 + k] * _PAIR[1])
    runs.sort()
    return runs[np.concatenate(([True], runs[1:] != runs[:-1]))]


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The shingle set of each text, in order."""
    for _, words, starts in word_lists(texts):
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            yield shingle_set(words[a:b], size)
