"""What Python workers hold at once, and what they hand back when a task ends."""

import pyarrow as pa
import public_tokenizers
import pytest

from sensorloom.llm import byte_bpe, minhash_forest, quality, workers

ROWS = [(n, f"text {n} of a good many words, all alike but for the number", "en") for n in range(5000)]


class Frame:
    """Stands for a table; keeps the function that a task would run."""

    columns, schema = ["doc_id", "text", "lang"], None

    def __init__(self):
        self.sparkSession = self.sparkContext = self

    def select(self, *_):
        return self

    selectExpr = select

    def broadcast(self, value):
        return type("Shared", (), {"value": value})

    def mapInArrow(self, run, _):
        self.run = run
        return self


def function_of(which):
    if which == "sign":
        return minhash_forest.sign(Frame(), 2).run
    if which == "selected":
        return quality.selected(Frame(), None).run
    return byte_bpe.tokenize(
        Frame(), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ).run


@pytest.mark.parametrize("which", ["sign", "selected", "tokenize"])
def test_a_large_batch_goes_through_in_slices(monkeypatch, which):
    handed_back = []
    monkeypatch.setattr(workers, "released", lambda: handed_back.append(1))
    monkeypatch.setattr(quality, "train", lambda *_: None)
    monkeypatch.setattr(quality, "grades", lambda *_: None)
    columns = zip(*ROWS, strict=True)
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=Frame.columns)
    out = list(function_of(which)(iter([batch, batch.slice(0, 0), batch.slice(4000)])))
    assert max(b.num_rows for b in out) <= 1024
    ids = [n for b in out for n in b.column(0).to_pylist()]
    assert ids == [n for n, *_ in ROWS] + list(range(4000, 5000))
    assert handed_back == [1]


def test_memory_goes_back_after_an_error_too(monkeypatch):
    handed_back = []
    monkeypatch.setattr(workers, "released", lambda: handed_back.append(1))

    def failing(batches):
        yield next(batches)
        raise ValueError("here")

    batch = pa.RecordBatch.from_arrays([pa.array(range(3))], names=["n"])
    with pytest.raises(ValueError, match="here"):
        list(workers.sparing(failing)(iter([batch])))
    assert handed_back == [1]


def test_the_cache_of_pieces_stays_bounded(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_PIECES", 50)
    tokens = [bytes([b]) for b in range(256)] + [b"te", b"xt"]
    coder = byte_bpe.ByteBpe(tokens, public_tokenizers.PATTERN)
    for at in range(0, 1000, 20):
        texts = [f"text{n} w{n}" for n in range(at, at + 20)]
        assert [bytes(coder.decode(ids)).decode() for ids in coder.encode(texts)] == texts
        assert len(coder.cache) <= 50 + 120
