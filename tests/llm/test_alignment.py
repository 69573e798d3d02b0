"""Links between two vocabularies, against pair by pair in Python."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from sensorloom.llm import alignment

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(rows):
    """Every pair of each group, one by one."""
    a_model = tokenizers.Tokenizer.from_file(PATHS[0])
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    known = alignment.Vocabularies(open(PATHS[0]).read(), open(PATHS[1], "rb").read())
    documents = []
    for doc_id, text in rows:
        raw = f" {text or ''}".encode()
        a = a_model.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        if b"".join(known.a_bytes[i] for i in a) != raw or b"".join(known.b_bytes[i] for i in b) != raw:
            a, b = [], []
        ends_a = np.cumsum([len(known.a_bytes[i]) for i in a]).tolist()
        ends_b = np.cumsum([len(known.b_bytes[i]) for i in b]).tolist()
        groups, x, y = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            x_end, y_end = ends_a.index(cut) + 1, ends_b.index(cut) + 1
            groups.append((a[x:x_end], b[y:y_end]))
            x, y = x_end, y_end
        links = [(i, j) for left, right in groups for i in left for j in right]
        documents.append((doc_id, a, b, groups, links))
    counts = Counter(pair for *_, links in documents for pair in set(links))
    most = defaultdict(int)
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    for doc_id, a, b, groups, links in documents:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield (
            doc_id, len(a), len(b), len(groups), len(links),
            sum(counts[pair] == most[pair[0]] for pair in links), sum(counts[pair] for pair in links),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        )


TEXTS = [
    "The ferry lay on the wrong side.", "The ferry lay on the other side.", None, "", " ", "a", "\n\n\t \n",
    "Überraschung über Straßen – naïve façade", "日本語のテキスト 🙂🙃 ok", "x" * 5000, "ab" * 4000, " " * 3000,
    "<|endoftext|> and <s> </s> <0x41>", "already▁there", "1234567890" * 50, "é ​ ",
    "The ferry lay on the wrong side.", "zero\x00byte", "﻿mark", "don't we'll I'M",
]


@pytest.fixture(scope="module")
def documents(spark):
    draw = random.Random(5)
    words = " ".join(t for t in TEXTS if t).split()
    mixed = [" ".join(draw.choices(words, k=draw.randint(1, 60))) for _ in range(150)]
    rows = list(enumerate(TEXTS + mixed)) + [(3, "repeated row"), (3, "repeated row"), (None, "no id")]
    return rows, spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 300, 0])
def test_pair_by_pair(documents, frequent):
    rows, frame = documents
    found = Counter(tuple(r) for r in alignment.scored(frame, *PATHS, frequent=frequent).collect())
    assert found == Counter(plain(rows))


@pytest.mark.parametrize("lane", [1, 7, 64, 10**6])
def test_lanes_change_nothing(lane):
    draw = np.random.default_rng(3)
    ends = [np.cumsum(draw.integers(1, 6, n)) for n in (400, 1, 90)]
    other = []
    for x in ends:
        inner = np.flatnonzero(draw.random(x[-1]) < 0.3)
        other.append(np.unique(np.concatenate((inner[inner > 0], x[-1:]))))
    base = np.concatenate(([0], np.cumsum([x[-1] for x in ends])))
    a = np.concatenate([x + o for x, o in zip(ends, base, strict=False)])
    b = np.concatenate([x + o for x, o in zip(other, base, strict=False)])
    cuts_a, cuts_b = alignment.cuts(a, b, base, lane)
    both = np.intersect1d(a, b)
    assert a[cuts_a].tolist() == both.tolist() == b[cuts_b].tolist()


def test_a_large_group_is_counted_before_it_meets():
    known = alignment._vocabularies(*alignment._files(*PATHS))
    found = alignment.Aligned(known.encode([""]), known)
    found.a, found.b = np.zeros(50_000, np.int64), np.arange(50_000) % 3
    found.sizes_a = found.sizes_b = np.array([50_000])
    found.group_bounds = np.array([0, 1])
    _, pairs, times = found.links()
    assert pairs.tolist() == [0, 1, 2] and times.sum() == 50_000**2


def test_aligned_lists(spark):
    rows = [(1, "The ferry, überall 語"), (2, None), (None, "ok")]
    frame = alignment.aligned(spark.createDataFrame(rows, "doc_id LONG, text STRING"), *PATHS)
    found = {r.doc_id: r for r in frame.collect()}
    assert found[2].ids_a == found[2].cuts_a == []
    row = found[1]
    assert (row.cuts_a[-1], row.cuts_b[-1]) == (len(row.ids_a), len(row.ids_b))
    assert row.cuts_a == sorted(set(row.cuts_a)) and len(row.cuts_a) == len(row.cuts_b)


def test_awkward_tables(spark, awkward, with_more_columns, no_documents):
    rows = [(r.doc_id, r.text) for r in awkward.filter("length(text) < 10000 OR text IS NULL").collect()]
    short = awkward.filter("length(text) < 10000 OR text IS NULL")
    assert Counter(tuple(r) for r in alignment.scored(short, *PATHS).collect()) == Counter(plain(rows))
    more = Counter(tuple(r) for r in alignment.scored(with_more_columns, *PATHS).collect())
    assert more == Counter(tuple(r) for r in alignment.scored(awkward, *PATHS).collect())
    assert more.total() == awkward.count()
    assert alignment.scored(no_documents, *PATHS).count() == 0
