"""Fill-in-the-middle over texts that are stored as seekable compressed frames.

A text is stored as independent zstandard frames of ``FRAME_BYTES`` each (at a
character's end), with an index: how many units and code points begin before a
frame, and whether it begins inside a run of letters.  A unit is a run of A-Z and
a-z or one other code point, so units tile the text, and a run may reach over
several frames.

A cut after ``k`` units lies where unit ``k`` begins.  The index tells its frame, and
only this frame is decompressed to find the place.  The transformed text is a list
of frames again: a sentinel is a frame of its own, frames without a cut are taken
over as they are, compressed, and the two with a cut are split.  Digests stream
the frames in order and hold one at a time.  The restored text is read off the
output alone: its frames between sentinels, in the order of the original.

Each row is worked on by itself: nothing is shuffled, and besides the row's own
text a task holds its compressed frames only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FRAME_BYTES = 1 << 14
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Per cent of texts that stay plain, from which remainder; per cent in suffix-first order.
PLAIN_FROM, SUFFIX_FIRST = 90, 20

_FRAME = pa.struct(
    [
        ("first_unit", pa.int64()), ("first_char", pa.int64()), ("inside", pa.bool_()),
        ("payload", pa.binary()),
    ]
)
_STORED = (
    "doc_id long, n long, n_chars long, marked boolean, "
    "frames array<struct<first_unit:long,first_char:long,inside:boolean,payload:binary>>"
)
_TRANSFORMED = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, output array<binary>"
)

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: Bytes that begin a code point.
_FIRST = (np.arange(256) & 0xC0) != 0x80


def _unit_starts(raw: np.ndarray, inside: bool) -> np.ndarray:
    """Where units begin; ``inside``: the byte before is a letter."""
    letter = _LETTER[raw]
    follows = np.empty_like(letter)
    follows[:1] = inside
    follows[1:] = letter[:-1]
    return _FIRST[raw] & ~(letter & follows)


def frames_of(
    raw: bytes, compress: zstandard.ZstdCompressor, frame_bytes: int = FRAME_BYTES
) -> tuple[list[dict], int, int]:
    """(frames, units, code points) of a text's UTF-8 bytes."""
    data = np.frombuffer(raw, np.uint8)
    found, units, chars, at, inside = [], 0, 0, 0, False
    while at < len(raw):
        to = min(at + frame_bytes, len(raw))
        while to < len(raw) and not _FIRST[raw[to]]:
            to += 1
        part = data[at:to]
        found.append(
            {"first_unit": units, "first_char": chars, "inside": inside, "payload": compress.compress(raw[at:to])}
        )
        units += int(_unit_starts(part, inside).sum())
        chars += int(_FIRST[part].sum())
        inside = bool(_LETTER[raw[to - 1]])
        at = to
    return found, units, chars


def stored(documents: DataFrame, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """(doc_id, n, n_chars, marked, frames) for each row of (doc_id, text).

    ``n`` counts units.  ``marked``: the text holds a sentinel.  A null or empty text
    has no frames.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=3)
        for part in _slices(batches):
            rows = []
            for text in part.column("text"):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                frames, units, chars = frames_of(raw, compress, frame_bytes)
                marked = any(sentinel in raw for sentinel in (PREFIX, SUFFIX, MIDDLE))
                rows.append((units, chars, marked, frames))
            units, chars, marked, frames = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array(units, pa.int64()), pa.array(chars, pa.int64()),
                    pa.array(marked), pa.array(frames, pa.list_(_FRAME)),
                ],
                names=["doc_id", "n", "n_chars", "marked", "frames"],
            )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _STORED)


def _slices(batches: Iterable[pa.RecordBatch], most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Runs of rows of so many bytes together, or of one row."""
    for batch in batches:
        at = 0
        each = max(1, batch.num_rows * most // max(batch.nbytes, 1))
        while at < batch.num_rows:
            part = batch.slice(at, each)
            while part.num_rows > 1 and part.nbytes > 2 * most:
                part = part.slice(0, part.num_rows // 2)
            yield part
            at += part.num_rows


def _draws(doc_id: int | None) -> list[int]:
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[at : at + 8], 16) for at in (0, 8, 16, 24)]


class _Cut:
    """The frames before a unit, those from it on, and the code points before it."""

    def __init__(self, frames: list[dict], unit: int, n: int, n_chars: int, coder: _Coder) -> None:
        if unit >= n:
            self.frame, self.inner, self.char = len(frames), 0, n_chars
            return
        firsts = [frame["first_unit"] for frame in frames]
        # The last frame with no more units before it: the unit begins there.
        self.frame = int(np.searchsorted(firsts, unit, "right")) - 1
        frame = frames[self.frame]
        raw = np.frombuffer(coder.open(frame["payload"]), np.uint8)
        starts = np.flatnonzero(_unit_starts(raw, frame["inside"]))
        self.inner = int(starts[unit - frame["first_unit"]])
        self.char = frame["first_char"] + int(_FIRST[raw[: self.inner]].sum())


class _Coder:
    def __init__(self) -> None:
        self._compress = zstandard.ZstdCompressor(level=3)
        self._open = zstandard.ZstdDecompressor()

    def open(self, payload: bytes) -> bytes:
        return self._open.decompress(payload)

    def close(self, raw: bytes) -> bytes:
        return self._compress.compress(raw)

    def between(self, frames: list[dict], begin: _Cut, end: _Cut) -> list[bytes]:
        """Frames from one cut to the other; whole ones are not opened."""
        found = []
        for at in range(begin.frame, min(end.frame + 1, len(frames))):
            payload = frames[at]["payload"]
            first = begin.inner if at == begin.frame else 0
            last = end.inner if at == end.frame else None
            if first or last is not None:
                raw = self.open(payload)[first:last]
                payload = self.close(raw) if raw else b""
            if payload:
                found.append(payload)
        return found


def _transform(row: dict, coder: _Coder) -> tuple[str, int | None, int | None, list[bytes]]:
    n, n_chars, frames = row["n"], row["n_chars"], row["frames"]
    h1, h2, h3, h4 = _draws(row["doc_id"])
    if not n or row["marked"] or h3 % 100 >= PLAIN_FROM:
        return "plain", None, None, [frame["payload"] for frame in frames]
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    places = [_Cut(frames, unit, n, n_chars, coder) for unit in (0, low, high, n)]
    prefix, middle, suffix = (
        coder.between(frames, *ends) for ends in zip(places[:-1], places[1:], strict=True)
    )
    form = "spm" if h4 % 100 < SUFFIX_FIRST else "psm"
    parts = [(PREFIX, prefix), (SUFFIX, suffix)]
    if form == "spm":
        parts.reverse()
    output = [p for sign, part in (*parts, (MIDDLE, middle)) for p in (coder.close(sign), *part)]
    return form, places[1].char, places[2].char - places[1].char, output


def transformed(store: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for each row of ``stored``.

    ``output`` joined is a zstandard stream of the transformed text.  A plain text's
    output is its own frames; it has no prefix and no middle (null).  A null doc_id
    draws as an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _Coder()
        for part in _slices(batches):
            rows = [_transform(row, coder) for row in part.to_pylist()]
            form, prefix, middle, output = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("n"), pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                    pa.array(output, pa.list_(pa.binary())),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return store.mapInArrow(run, _TRANSFORMED)


def restored_frames(form: str, output: list[bytes], coder: _Coder) -> list[bytes]:
    """The frames of the original text, told from a transformed text and its form."""
    if form == "plain":
        return output
    parts: dict[bytes, list[bytes]] = {}
    for payload in output:
        # Sentinels are frames of their own, and no text that is transformed holds one.
        size = zstandard.frame_content_size(payload)
        sign = coder.open(payload) if size == len(PREFIX) else b""
        if sign in (PREFIX, SUFFIX, MIDDLE):
            held = parts[sign] = []
        else:
            held.append(payload)
    return [*parts[PREFIX], *parts[MIDDLE], *parts[SUFFIX]]


def _streamed(frames: list[bytes], coder: _Coder) -> str:
    digest = hashlib.sha256()
    for payload in frames:
        digest.update(coder.open(payload))
    return digest.hexdigest()


def digests(outputs: DataFrame) -> DataFrame:
    """The rows of ``transformed`` with digests of output and restored text in its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _Coder()
        for part in _slices(batches):
            forms, outputs = part.column("form").to_pylist(), part.column("output")
            of_output, of_restored = [], []
            for form, output in zip(forms, outputs, strict=True):
                frames = output.as_py()
                of_output.append(_streamed(frames, coder))
                of_restored.append(
                    of_output[-1]
                    if form == "plain"
                    else _streamed(restored_frames(form, frames, coder), coder)
                )
            kept = [part.column(name) for name in ("doc_id", "n", "form", "prefix_chars", "middle_chars")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(of_output, pa.string()), pa.array(of_restored, pa.string())],
                names=[
                    "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256",
                    "restored_sha256",
                ],
            )

    schema = _TRANSFORMED.replace("output array<binary>", "output_sha256 string, restored_sha256 string")
    return outputs.mapInArrow(run, schema)


def texts(outputs: DataFrame) -> DataFrame:
    """(doc_id, form, text): the transformed texts themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _Coder()
        for part in _slices(batches):
            found = [b"".join(map(coder.open, output.as_py())).decode() for output in part.column("output")]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("form"), pa.array(found, pa.string())],
                names=["doc_id", "form", "text"],
            )

    return outputs.mapInArrow(run, "doc_id long, form string, text string")


def report(store: DataFrame) -> DataFrame:
    """Form, cuts and digests of each row of a table of ``stored`` texts.

    Rows are independent: repeated ones have equal results, a null doc_id stays
    null, a null or empty text is plain with no units, an empty table gives no rows.
    """
    return digests(transformed(store))


def report_sql() -> str:
    """The same for DuckDB, on whole texts."""
    draws = ", ".join(
        f"('0x' || substr(d, {1 + 8 * i}, 8))::UBIGINT AS h{i + 1}" for i in range(4)
    )
    return f"""
    WITH texts AS (
      SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents
    ), units AS (
      SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u, len(u) AS n, {draws} FROM texts
    ), cut AS (
      SELECT *, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS lo, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS hi,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= {PLAIN_FROM}
          THEN 'plain' WHEN h4 % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
      FROM units
    ), parts AS (
      SELECT doc_id, t, n, form, array_to_string(u[:lo], '') AS p,
        array_to_string(u[lo + 1:hi], '') AS m, array_to_string(u[hi + 1:], '') AS s FROM cut)
    SELECT doc_id, n::BIGINT AS n, form,
      CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
      CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
             ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
      sha256(t) AS restored_sha256
    FROM parts"""
