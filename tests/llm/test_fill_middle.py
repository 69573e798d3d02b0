"""The transformation through frames, against plain slicing of whole texts."""

import hashlib
import random
import re
from collections import Counter

import pytest
import zstandard

from sensorloom.llm import fill_middle
from sensorloom.llm.tables import saved


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, sha(text), sha(text)), text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, n)))
    form = "spm" if h4 % 100 < 20 else "psm"
    output = (
        f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    )
    return (doc_id, n, form, len(prefix), len(middle), sha(output), sha(text)), output


ODD = [None, "", "a", "ab cd", "<P>", "text with <M> inside", "<P", "é", "🙂🙂 a🙂b", "\n\r\n", "x" * 5000, "<S >"]


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(11)
    pieces = ["ferry", " ", "é", "🙂", "\n", "A", "zZ", "7", "…", "語", "-", "lowergardens"]
    texts = ["".join(draw.choices(pieces, k=draw.randint(0, 400))) for _ in range(400)]
    return [*enumerate(ODD * 4 + texts), (-5, "negative id"), (None, "no id at all"), (3, "twice"), (3, "twice")]


@pytest.mark.parametrize("frame_bytes", [1, 3, 64, fill_middle.FRAME_BYTES])
def test_as_plain_slicing(spark, rows, frame_bytes):
    frame = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)
    store = saved(fill_middle.stored(frame, frame_bytes), "frames")
    found = Counter(tuple(r) for r in fill_middle.report(store).collect())
    assert found == Counter(plain(*row)[0] for row in rows)
    texts = Counter((r.doc_id, r.text) for r in fill_middle.texts(fill_middle.transformed(store)).collect())
    assert texts == Counter((doc_id, plain(doc_id, text)[1]) for doc_id, text in rows)
    assert {f[2] for f in found} == {"plain", "psm", "spm"}


def test_only_cut_frames_are_opened(monkeypatch):
    raw = ("word 12345 " * 20_000).encode()
    frames, n, n_chars = fill_middle.frames_of(raw, zstandard.ZstdCompressor())
    coder, opened = fill_middle._Coder(), []
    real = coder.open
    monkeypatch.setattr(coder, "open", lambda payload: opened.append(payload) or real(payload))
    row = {"doc_id": 4, "n": n, "n_chars": n_chars, "marked": False, "frames": frames}
    form, *_, output = fill_middle._transform(row, coder)
    assert form != "plain" and len(frames) > 10 and len(set(opened)) <= 2
    assert len({f["payload"] for f in frames} & set(output)) >= min(8, len({f["payload"] for f in frames}) - 2)


def test_output_is_one_stream():
    frames, n, n_chars = fill_middle.frames_of(b"a b c d e f", zstandard.ZstdCompressor(), 2)
    row = {"doc_id": 4, "n": n, "n_chars": n_chars, "marked": False, "frames": frames}
    *_, output = fill_middle._transform(row, fill_middle._Coder())
    reader = zstandard.ZstdDecompressor().stream_reader(b"".join(output), read_across_frames=True)
    assert reader.read().decode() == plain(4, "a b c d e f")[1]


def test_awkward_tables(awkward, with_more_columns, no_documents):
    def run(frame):
        return Counter(tuple(r) for r in fill_middle.report(fill_middle.stored(frame)).collect())

    found = run(awkward)
    assert found == Counter(plain(r.doc_id, r.text)[0] for r in awkward.collect())
    assert run(with_more_columns) == found and not run(no_documents)
