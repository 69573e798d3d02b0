"""Byte-level BPE encoding and decoding with a public vocabulary of ranks.

A text is split by the vocabulary's pattern, and each piece is merged alone.
Pieces are encoded together: those of similar length are the rows of a padded
matrix of ids, one byte each at first.  Every round looks the rank of each
neighbouring pair up in a hash table, merges the leftmost pair of the least rank
of every row, and moves the rest of the row up; rows without a pair left drop
out.  As a piece of ``n`` bytes takes up to ``n`` rounds over ``n`` places, one
of more than ``LONG`` bytes goes another way to the same ids: it is cut where no
token can reach across, and what is still long is merged by a heap of pairs.  A
piece that is a token as a whole is that token, as is usual with such vocabularies.

The vocabulary (some 50,000 tokens, fixed in size) is read on the driver and
broadcast.  A bounded cache of pieces lives as long as the Python worker.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sensorloom.llm.workers import sparing

LONG = 256
#: A piece takes some 300 bytes in each worker.
CACHE_PIECES = 250_000
#: Characters that are split, and places of padded matrices that are merged, at once.
CHARACTERS, PLACES = 1 << 20, 1 << 18
_NONE = np.int32(2**31 - 1)
_SPREAD = np.uint64(0x9E37_79B9_7F4A_7C15)
_ASCII = {r"\p{L}": "a-zA-Z", r"\p{N}": "0-9"}

_TOKENS = "doc_id long, n_tokens long, ids array<int>, round_trip boolean"
_ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 and rank on each line), by rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PairTable:
    """(left id, right id) -> id of the merged token, by open addressing."""

    def __init__(self, tokens: list[bytes]) -> None:
        ids = {token: i for i, token in enumerate(tokens)}
        keys, values = [], []
        for token, merged in ids.items():
            for cut in range(1, len(token)):
                left, right = ids.get(token[:cut]), ids.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(merged)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, 2**64 - 1, np.uint64)
        self.values = np.full(1 << self.bits, _NONE, np.int32)
        key, value = np.array(keys, np.uint64), np.array(values, np.int32)
        place = self._slot(key)
        self.probes = 1
        while len(key):
            free = self.keys[place] == np.uint64(2**64 - 1)
            _, first = np.unique(place[free], return_index=True)
            taken = np.flatnonzero(free)[first]
            self.keys[place[taken]], self.values[place[taken]] = key[taken], value[taken]
            rest = np.ones(len(key), bool)
            rest[taken] = False
            key, value, place = key[rest], value[rest], (place[rest] + 1) % len(self.keys)
            self.probes += 1
        self.merged = dict(zip(keys, values, strict=True))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * _SPREAD >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        place = self._slot(keys)
        found = np.where(self.keys[place] == keys, self.values[place], _NONE)
        open_ = np.flatnonzero((found == _NONE) & (self.keys[place] != np.uint64(2**64 - 1)))
        for _ in range(self.probes):
            if not len(open_):
                break
            place[open_] = (place[open_] + 1) % len(self.keys)
            at = place[open_]
            found[open_] = np.where(self.keys[at] == keys[open_], self.values[at], _NONE)
            open_ = open_[(found[open_] == _NONE) & (self.keys[at] != np.uint64(2**64 - 1))]
        return found


class ByteBpe:
    """Encoder and decoder for one vocabulary and one pattern."""

    def __init__(self, tokens: list[bytes], pattern: str) -> None:
        self.tokens = tokens
        self.numbers = list(range(len(tokens)))
        self.decimals = [str(i) for i in self.numbers]
        self.whole = ids = {token: i for i, token in enumerate(tokens)}
        self.of_byte = np.array([ids[bytes([b])] for b in range(256)], np.int32)
        self.pairs = PairTable(tokens)
        # For ASCII texts the same pattern without Unicode classes is faster.
        ascii_pattern = pattern
        for wide, narrow in _ASCII.items():
            ascii_pattern = re.sub(
                r"(\[[^\]]*)" + re.escape(wide), lambda m, n=narrow: m[1] + n, ascii_pattern
            )
        for wide, narrow in _ASCII.items():
            while wide in ascii_pattern:
                at = ascii_pattern.index(wide)
                inside = ascii_pattern.rfind("[", 0, at) > ascii_pattern.rfind("]", 0, at)
                narrow_here = narrow if inside else f"[{narrow}]"
                ascii_pattern = ascii_pattern.replace(wide, narrow_here, 1)
        self.split_ascii = re.compile(ascii_pattern, re.ASCII).findall
        self.split_any = regex.compile(pattern).findall
        meets = np.zeros((256, 256), bool)
        for token in tokens:
            raw = np.frombuffer(token, np.uint8)
            meets[raw[:-1], raw[1:]] = True
        self.meets = meets
        self.cache: dict[str, tuple[int, ...]] = {}

    def pieces(self, text: str) -> list[str]:
        return self.split_ascii(text) if text.isascii() else self.split_any(text)

    def encode(self, texts: Iterable[str]) -> Iterator[list[int]]:
        """Ids of each text."""
        split = [self.pieces(text) for text in texts]
        wanted = set().union(*split)
        if len(self.cache) > CACHE_PIECES:
            self.cache = {piece: self.cache[piece] for piece in wanted & self.cache.keys()}
        missing = list(wanted - self.cache.keys())
        raw = [piece.encode() for piece in missing]
        for piece, of, ids in zip(missing, raw, self._merge_all(raw), strict=True):
            # A piece that is a token is that token, though its pairs may not lead there.
            self.cache[piece] = ids if len(ids) == 1 or of not in self.whole else (self.whole[of],)
        known = self.cache.__getitem__
        for pieces in split:
            yield list(chain.from_iterable(map(known, pieces)))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def _merge_all(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        out: list[tuple[int, ...]] = [()] * len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for i in np.flatnonzero(lengths > LONG):
            out[i] = self._merge_long(pieces[i])
        low = 0
        for high in (1, 2, 4, 6, 8, 12, 16, 24, 32, 64, 128, LONG):
            bucket = np.flatnonzero((lengths > low) & (lengths <= high))
            low = high
            step = max(1, PLACES // high)
            for at in range(0, len(bucket), step):
                rows = bucket[at : at + step]
                for i, ids in zip(rows, self._merge_rows([pieces[r] for r in rows], high), strict=True):
                    out[i] = ids
        return out

    def _merge_rows(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)
        ids = self.of_byte[raw.reshape(-1, width)]
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        live = np.arange(len(pieces))
        places = np.arange(width)
        ranks = np.full((len(pieces), width), _NONE, np.int32)
        if width > 1:
            inside = places[1:] < lengths[:, None]
            ranks[:, :-1][inside] = self.pairs.look_up(ids[:, :-1][inside], ids[:, 1:][inside])
        while len(live):
            part = ranks[live]
            at = part.argmin(axis=1)
            least = part[np.arange(len(live)), at]
            going = least != _NONE
            live, at, least = live[going], at[going], least[going]
            if not len(live):
                break
            # Move what follows the pair up by one place.
            source = np.minimum(places + (places > at[:, None]), width - 1)
            moved = np.take_along_axis(ids[live], source, axis=1)
            moved[np.arange(len(live)), at] = least
            part = np.take_along_axis(ranks[live], source, axis=1)
            lengths[live] -= 1
            size = lengths[live]
            part[places >= size[:, None] - 1] = _NONE
            for shift in (-1, 0):
                here = at + shift
                rows = np.flatnonzero((here >= 0) & (here + 1 < size))
                here = here[rows]
                part[rows, here] = self.pairs.look_up(moved[rows, here], moved[rows, here + 1])
            ids[live], ranks[live] = moved, part
        number = self.numbers.__getitem__  # one object for each id, however often it is held
        return [
            tuple(map(number, row[:n]))
            for row, n in zip(ids.tolist(), lengths.tolist(), strict=True)
        ]

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        raw = np.frombuffer(piece, np.uint8)
        cuts = np.flatnonzero(~self.meets[raw[:-1], raw[1:]]) + 1
        bounds = [0, *cuts.tolist(), len(piece)]
        parts = [piece[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        short = [p for p in parts if len(p) <= LONG]
        merged = iter(self._merge_all(short))
        ids: list[int] = []
        for part in parts:
            ids += next(merged) if len(part) <= LONG else self._merge_by_heap(part)
        return tuple(ids)

    def _merge_by_heap(self, piece: bytes) -> list[int]:
        merged = self.pairs.merged
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        size = len(ids)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = []
        for i in range(size - 1):
            rank = merged.get(ids[i] << 32 | ids[i + 1])
            if rank is not None:
                heap.append((rank, i))
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else size
            if j >= size or merged.get(ids[i] << 32 | ids[j]) != rank:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < size:
                before[after[i]] = i
                if (new := merged.get(rank << 32 | ids[after[i]])) is not None:
                    heapq.heappush(heap, (new, i))
            if (left := before[i]) >= 0 and (new := merged.get(ids[left] << 32 | rank)) is not None:
                heapq.heappush(heap, (new, left))
        return [i for i in ids if i >= 0]


_ready: dict[str, ByteBpe] = {}


def vocabulary_digest(tokens: list[bytes], pattern: str) -> str:
    """Tells vocabularies and patterns apart, by all of their bytes."""
    digest = hashlib.sha256(pattern.encode())
    for token in tokens:
        digest.update(b"%d:" % len(token) + token)
    return digest.hexdigest()


def _coder(tokens: list[bytes], pattern: str, key: str) -> ByteBpe:
    """One coder per vocabulary and Python worker, however many tasks it runs."""
    if key not in _ready:
        _ready[key] = ByteBpe(tokens, pattern)
    return _ready[key]


def _slices(texts: list[str], most: int = CHARACTERS) -> Iterator[list[str]]:
    """Runs of texts of about so many characters together, or of one text."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > most:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def tokenize(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of each row of (doc_id, text).

    ``round_trip`` says that the ids decode to the text, as they do.  A null or
    empty text has no ids; any other is taken whole.  Rows are independent:
    repeated ones have equal results, a null doc_id stays null, an empty table
    gives no rows, other columns are not read.
    """

    def rows(coder: ByteBpe, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [text or "" for text in batch.column("text").to_pylist()]
        ids = [one for part in _slices(texts) for one in coder.encode(part)]
        same = [coder.decode(one) == text.encode() for one, text in zip(ids, texts, strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(map(len, ids), pa.int64()),
             pa.array(ids, pa.list_(pa.int32())), pa.array(same, pa.bool_())],
            names=["doc_id", "n_tokens", "ids", "round_trip"],
        )

    return _mapped(documents, path, pattern, rows, _TOKENS)


def digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row of (doc_id, text).

    The same coding as ``tokenize``, of which only digests leave the task: of
    the decimal ids, joined by a space, and of the decoded bytes.
    """

    def rows(coder: ByteBpe, batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, of_ids, of_bytes = [], [], []
        texts = [text or "" for text in batch.column("text").to_pylist()]
        decimals = coder.decimals
        for part in _slices(texts):
            for ids in coder.encode(part):
                counts.append(len(ids))
                line = " ".join(map(decimals.__getitem__, ids)).encode()
                of_ids.append(hashlib.sha256(line).hexdigest())
                of_bytes.append(hashlib.sha256(coder.decode(ids)).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
             pa.array(of_bytes, pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return _mapped(documents, path, pattern, rows, _ENCODED)


def _mapped(documents: DataFrame, path: str, pattern: str, rows, schema: str) -> DataFrame:
    tokens = read_ranks(path)
    key = vocabulary_digest(tokens, pattern)
    shared = documents.sparkSession.sparkContext.broadcast(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared.value, pattern, key)
        for batch in batches:
            yield rows(coder, batch)

    frame = documents.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return frame.mapInArrow(sparing(run), schema)
