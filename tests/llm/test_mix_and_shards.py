"""Mixing and sharding: apportionment by hand, laws, reruns, SQL."""

import math
import os
import random
import re
from pathlib import Path

import pytest
from oracle import connect, difference, rows_of_spark, rows_of_sql
from pyspark.sql import functions as F

from sensorloom.llm import feistel, mixing
from sensorloom.llm.queries import oracle_sql, queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def by_hand(votes, seats):
    """One seat after the other to the highest quotient."""
    won = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = max(votes, key=lambda item: (votes[item] / (2 * won[item] + 1), -item))
        won[best] += 1
    return won


def test_apportionment_by_hand(spark):
    draw = random.Random(5)
    rows, expected = [], {}
    for group in range(40):
        shape = draw.choice((1, 3, 40))
        votes = {n: draw.choice((1.0, 7.0, draw.uniform(0.1, 10**draw.randrange(1, 6)))) for n in range(shape)}
        seats = draw.choice((0, 1, shape, 10 * shape + 3, 997))
        rows += [(group, n, v, seats) for n, v in votes.items()]
        expected |= {(group, n): k for n, k in by_hand(votes, seats).items()}
    table = spark.createDataFrame(rows, "g INT, item INT, votes DOUBLE, seats LONG")
    got = mixing.sainte_lague(table, ["g"], "votes", "seats", "won").collect()
    assert {(r.g, r.item): r.won for r in got} == expected


def targets_by_hand(sizes, most):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [n for n in sizes if n is None]
    weights = {n: (5, 2, 1)[k % 3] for k, n in enumerate(names)}
    left, open_, target = sum(sizes.values()), set(names), {}
    while open_:
        share = {n: left * weights[n] / sum(weights[m] for m in open_) for n in open_}
        full = {n for n in open_ if share[n] > most * sizes[n]}
        if not full:
            return target | share
        for n in full:
            target[n] = most * sizes[n]
            left -= target[n]
        open_ -= full
    return target


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(12)
    rows = []
    for n in range(1500):
        source = draw.choice(["big"] * 6 + ["Zed", "a", "é", "tiny", None, "empty"])
        size = 0 if source == "empty" else draw.choice((0, 1, 5, 40, 300, 2000 if n % 50 == 0 else 7))
        if source == "tiny" and n % 4:
            source = "big"
        text = draw.choice(("", " ")) + "".join(f"w{k}{draw.choice((' ', chr(10)))}" for k in range(size))
        rows.append((n, text if n % 97 else None, source))
    return rows, spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING")


def test_plan(corpus):
    rows, table = corpus
    options = {"shard_words": 3000, "block_words": 8}
    found = mixing.plan(table.repartition(5), **options).collect()
    again = mixing.plan(table.repartition(2, "source"), **options).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    size = {n: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for n, t, _ in rows}
    by_source = {}
    for n, _, source in rows:
        by_source[source] = by_source.get(source, 0) + size[n]
    target = targets_by_hand(by_source, 3)
    taken = dict.fromkeys(by_source, 0)
    for r in found:
        assert r.size == size[r.doc_id] and 0 <= r.taken <= 3 * r.size
        assert r.source_size == by_source[r.source] and math.isclose(r.target, target[r.source], abs_tol=1e-6)
        assert r.taken == r.copies * r.size + r.to_1 - r.from_1 + r.to_2 - r.from_2
        taken[r.source] += r.taken
    for source, words in taken.items():
        assert abs(words - target[source]) <= max(16, 0.01 * target[source]), source
    assert any(target[s] == 3 * by_source[s] > 0 for s in by_source)


def test_mixed_texts_are_what_the_plan_takes(corpus):
    rows, table = corpus
    options = {"shard_words": 3000, "block_words": 8}
    taken = {r.doc_id: r.taken for r in mixing.plan(table, **options).collect() if r.taken}
    words = {n: (t or "").split() for n, t, _ in rows}
    got = {}
    for r in mixing.mixed(table, **options).collect():
        part = r.text.split()
        whole = " ".join(words[r.doc_id])
        assert all(w in words[r.doc_id] for w in part) and (" ".join(part) in whole or len(part) < len(words[r.doc_id]))
        got[r.doc_id] = got.get(r.doc_id, 0) + len(part)
    assert got == taken


@pytest.mark.parametrize("rows", [1, 2, 3, 10, 99, 256, 5000])
def test_permutation_and_its_inverse(spark, rows):
    table = spark.range(rows).withColumn("rows", F.lit(rows).cast("long"))
    for seed in (0, 3):
        there = table.withColumn("at", feistel.permuted(F.col("id"), F.col("rows"), seed))
        back = there.withColumn("was", feistel.permuted(F.col("at"), F.col("rows"), seed, backwards=True))
        found = back.collect()
        assert sorted(r["at"] for r in found) == list(range(rows))
        assert all(r.was == r.id for r in found)
    if rows > 1000:
        moved = sum(abs(r["at"] - r.id) > rows / 100 for r in found)
        assert moved > 0.9 * rows


def test_shards(spark):
    texts = [(n, None if n % 9 == 0 else "é" * (n % 40)) for n in range(1003)] + [(5, "x")] * 30
    table = spark.createDataFrame(texts, "doc_id LONG, text STRING")
    found = feistel.sharded(table.repartition(7), 40).collect()
    assert sorted(map(str, found)) == sorted(map(str, feistel.sharded(table.coalesce(1), 40).collect()))
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    spots = [(r.shard, r.slot, r.row_number) for r in found]
    where = spark.createDataFrame(spots, "shard INT, slot LONG, row_number LONG").withColumn(
        "back", feistel.row_at(F.col("shard"), F.col("slot"), F.lit(len(texts)).cast("long"), 40)
    )
    assert where.filter("back <> row_number").count() == 0


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data here")
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_against_sql(spark, name):
    names, rows = rows_of_spark(queries()[name](spark, SF_DIR))
    sql_names, sql_rows = rows_of_sql(connect(SF_DIR), oracle_sql()[name])
    assert names == sql_names and difference(rows, sql_rows) == [] and rows
