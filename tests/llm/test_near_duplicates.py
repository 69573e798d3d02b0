"""Near duplicates, of texts and of vectors, against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorloom.llm import minhash_forest, p_stable
from sensorloom.llm.components import components
from sensorloom.llm.hashed_text import shingle_sets

import pyarrow as pa  # isort: skip


class Groups:
    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, x, y):
        x, y = sorted((self.find(x), self.find(y)))
        self.parent[y] = x


def brute_force(texts, words, percent):
    """Component and size of each document by comparing all pairs of sets."""
    sets = {}
    for doc, text in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        k = min(words, len(w))
        sets[doc] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
    groups = Groups(sets)
    docs = list(sets)
    for n, x in enumerate(docs):
        for y in docs[:n]:
            both = len(sets[x] & sets[y])
            if sets[x] and sets[y] and 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                groups.join(x, y)
    return {doc: (groups.find(doc), len(sets[doc])) for doc in docs}


def corpus(seed, bases=25, copies=12):
    draw = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(400)]
    texts = []
    for _ in range(bases):
        base = draw.choices(vocabulary, k=draw.randrange(1, 120))
        texts.append(base)
        for _ in range(draw.randrange(copies)):
            copy = list(base)
            for _ in range(draw.randrange(1 + len(base) // 12)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            texts.append(copy)
    draw.shuffle(texts)
    joined = [draw.choice((" ", "\n", "\t ")).join(t) for t in texts]
    return [(3 * n + 1, t.upper() if n % 9 == 0 else t) for n, t in enumerate(joined)]


def found_in(spark, texts, **options):
    table = spark.createDataFrame(texts, "doc_id LONG, text STRING").repartition(4)
    rows = minhash_forest.near_duplicates(table, **options).collect()
    assert all(r.kept == (r.component_id == r.doc_id) for r in rows)
    return {r.doc_id: (r.component_id, r.n_shingles) for r in rows}


@pytest.mark.parametrize("words", [2, 5])
def test_components_of_texts(spark, words):
    texts = [*corpus(words), (2, None), (5, ""), (8, "  "), (11, "Alone"), (14, "alone")]
    assert found_in(spark, texts, words=words) == brute_force(texts, words, 80)


def test_large_groups_go_deeper_and_lose_nothing(spark, monkeypatch):
    """Groups of far more than a block: a crowd, its outliers and a chain."""
    monkeypatch.setattr(minhash_forest, "BLOCK", 16)
    draw = random.Random(9)
    base = [f"b{n}" for n in range(100)]
    texts = []
    for n in range(150):
        copy = list(base)
        for _ in range(draw.choice((1, 2, 9))):
            copy[draw.randrange(100)] = f"x{draw.randrange(10_000)}"
        texts.append((n, " ".join(copy)))
    step = list(base)
    for n in range(40):  # each near the one before it, far from the first
        step = [*step[3:], f"c{n}", f"d{n}", f"e{n}"]
        texts.append((1000 + n, " ".join(step)))
    assert found_in(spark, texts, words=2) == brute_force(texts, 2, 80)


def test_a_large_cluster_without_links(spark, monkeypatch):
    """Many documents that look alike but lie just under the threshold stay apart."""
    monkeypatch.setattr(minhash_forest, "BLOCK", 8)
    base = [f"b{n}" for n in range(60)]
    texts = [(n, " ".join([*base, *[f"own{n}-{k}" for k in range(9)]])) for n in range(40)]
    expected = brute_force(texts, 2, 80)
    assert len({c for c, _ in expected.values()}) == 40
    assert found_in(spark, texts, words=2) == expected


def test_a_crowd_of_thousands_just_under_the_threshold(spark):
    """2,000 texts of one region, far beyond a block, of which a few dozen pairs do link."""
    draw = random.Random(21)
    base = [f"b{n}" for n in range(50)]
    texts = []
    for n in range(2000):
        own = [f"own{n}-{k}" for k in range(7)]
        if n % 60 == 7:  # half of the words of an earlier text
            own[:4] = texts[draw.randrange(n)][1].split()[50:54]
        texts.append((n, " ".join([*base, *own])))
    expected = brute_force(texts, 2, 80)
    linked = sum(doc != component for doc, (component, _) in expected.items())
    assert 10 < linked < 100
    assert found_in(spark, texts, words=2) == expected


@pytest.mark.parametrize("held", [1 << 18, 100])
def test_overlaps(monkeypatch, held):
    monkeypatch.setattr(minhash_forest, "SLICE", held)
    draw = np.random.default_rng(2)
    every = draw.integers(0, 2**64, 3000, dtype=np.uint64)
    sets = [np.unique(draw.choice(every, n)) for n in (0, 1, 500, 2500, 900, 1)]
    found = minhash_forest.overlaps(sets)
    assert found.tolist() == [[len(np.intersect1d(x, y)) for y in sets] for x in sets]


def test_one_row_of_each_group(spark):
    near = "the river rose by a hand in the night and nobody in the upper village had seen it come"
    rows = [(n, "same text over and over again") for n in (5, 5, 3, None, 3, None)]
    rows += [(9, near), (8, near + " now"), (None, near), (None, None), (None, None), (4, "")]
    table = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)
    found = minhash_forest.one_of_each_group(table).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in found) == sorted(
        [("3", rows[0][1]), ("8", near + " now"), ("None", ""), ("None", ""), ("4", "")]
    )


def test_one_row_repeated_very_often(spark):
    from pyspark.sql import functions as F

    once = "a line of more than five words stands here"
    table = spark.range(100_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit(once).alias("text"))
    table = table.unionByName(spark.createDataFrame([(0, once + " too")], "doc_id LONG, text STRING"))
    near = minhash_forest.near_duplicates(table, words=1)
    assert near.where("component_id = 0").count() == 100_001
    assert minhash_forest.one_of_each_group(table, words=1).collect() == [(0, once + " too")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aB \t\n\x0b\x0cé語\x85\xa0", max_size=12), max_size=6), st.integers(1, 4))
def test_shingle_sets(texts, size):
    for text, got in zip(texts, shingle_sets(pa.array(texts, pa.string()), size), strict=True):
        words = text.encode().lower().split()
        k = min(size, len(words))
        expected = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()
        assert len(got) == len(expected) and (np.diff(got.astype(object)) > 0).all()


def test_a_crowd_has_few_links(spark, monkeypatch):
    """Blocks name their trees by the least id, so that those of 25 orders agree on many links."""
    monkeypatch.setattr(minhash_forest, "BLOCK", 64)
    counted = []

    def counting(links):
        counted.append(links.filter("a <> b").select("a", "b").distinct().count())
        return components(links)

    monkeypatch.setattr(minhash_forest, "components", counting)
    base = " ".join(f"b{n}" for n in range(60))
    rows = [(n, f"{base} own{n}") for n in range(300)]
    frame = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    found = minhash_forest.near_duplicates(frame, words=2, percent=80)
    assert {r.component_id for r in found.collect()} == {0}
    assert counted[0] < 12 * len(rows)


def test_links_of_a_crowd_do_not_pile_up(spark, monkeypatch):
    """A crowd of many blocks gives components() about a link for each text, from either side."""
    monkeypatch.setattr(minhash_forest, "BLOCK", 16)
    counted = []

    def counting(links):
        counted.append(links.filter("a <> b").select("a", "b").distinct().count())
        return components(links)

    monkeypatch.setattr(minhash_forest, "components", counting)
    base = " ".join(f"b{n}" for n in range(60))
    rows = [(n, f"{base} own{n}") for n in range(400)]
    frame = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    found = minhash_forest.near_duplicates(frame, words=2, percent=80)
    assert {r.component_id for r in found.collect()} == {0}
    assert len(counted) == 3 and max(counted) < 4 * len(rows), counted


def test_links_to_a_known_component_are_between_names():
    """Two tiles that link a row to different rows of one component give the same link."""
    sets = [np.arange(10, dtype=np.uint64)] * 2
    for other in (3, 4):
        known, minor = np.array([1, 7]), np.array([False, True])
        links = minhash_forest._confirm(np.array([other, 9]), sets, 80, known, minor)
        assert sorted(links[0]) == [1, 7] and len(links) == 1


def test_components_of_hard_graphs(spark):
    draw = random.Random(4)
    path = [(n, n + 1) for n in range(120)]
    star = [(5000, 5001 + n) for n in range(300)]
    noise = [(draw.randrange(200, 400), draw.randrange(200, 400)) for _ in range(150)]
    links = path + star + noise + [(7, 7), (9001, 9000), (9000, 9001)]
    draw.shuffle(links)
    groups = Groups({n for pair in links for n in pair})
    for a, b in links:
        groups.join(a, b)
    frame = spark.createDataFrame([*links, (None, 3), (4, None)], "a LONG, b LONG")
    found = {r.node: r.component for r in components(frame).collect()}
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert found == {n: groups.find(n) for n in linked}


def vectors_near(seed, count=260, dimensions=24):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((12, dimensions))
    rows = []
    for n in range(count):
        spread = draw.choice([0.0, 0.01, 0.05, 0.12, 1.0])
        vector = centres[draw.integers(12)] + spread * draw.standard_normal(dimensions)
        rows.append((int(n * 7 % 1009), (vector * draw.uniform(0.1, 10)).tolist(), int(n % 2)))
    return rows


@pytest.mark.parametrize("block", [256, 10])
def test_links_of_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(p_stable, "BLOCK", block)
    good = vectors_near(block)
    odd = [
        (5000, None, 0), (5001, [], 0), (5002, [0.0] * 24, 0), (5003, [float("nan")] * 24, 0),
        (5004, [None, 1.0], 0), (5005, [float("inf")] + [0.0] * 23, 0), (5006, good[0][1], None),
        (5007, [1.0, 2.0], 0), (5008, [2.0, 4.0], 0), (None, good[0][1], 0), (5009, [1e-300] * 3, 1),
        (5010, [1e300] * 3, 1),
    ]
    rows = good + odd
    groups, counts = Groups([r[0] for r in rows if r[0] is not None]), {r[0]: 0 for r in rows}
    fit = [r for r in rows if r[0] is not None and r[2] is not None and (r[0] < 5000 or r[0] > 5006)]
    for n, (x, v, label) in enumerate(fit):
        for y, w, other in fit[:n]:
            if label == other and len(v) == len(w):
                a, b = (np.array(u) / max(map(abs, u)) for u in (v, w))
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98:
                    groups.join(x, y)
                    counts[x] += 1
                    counts[y] += 1
    table = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>, label INT")
    found = p_stable.near_duplicate_vectors(table.repartition(3)).collect()
    assert len(found) == len(rows) and max(counts.values()) > 12
    assert {r.vec_id: r.n_links for r in found} == counts
    for r in found:
        assert r.component_id == (None if r.vec_id is None else groups.find(r.vec_id))
        assert r.kept == (r.vec_id is None or r.component_id == r.vec_id)
    assert p_stable.near_duplicate_vectors(table.filter("false")).count() == 0
