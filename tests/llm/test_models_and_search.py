"""Held-out accuracy of the classifiers, recall of the search, and the pipeline's stages."""

import os
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sensorloom.llm import language, one_bit, quality
from sensorloom.llm.queries import op1_p_stable, op6_language, op9_one_bit, queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
LARGER = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not Path(LARGER).exists(), reason="no test data here")


@pytest.mark.parametrize("count,cells", [(7, 4096), (900, 4096), (900, 100)])
def test_search_against_brute_force(spark, monkeypatch, count, cells):
    monkeypatch.setattr(one_bit, "ROWS", cells)
    monkeypatch.setattr(one_bit, "QUERIES", 7)
    draw = np.random.default_rng(count)
    vectors = np.round(draw.standard_normal((count, 33)), 2)
    vectors[3] = vectors[5]  # ties and copies
    rows = [(int(n), v.tolist()) for n, v in enumerate(vectors)]
    odd = [(10_000, None), (10_010, [0.0] * 33), (10_020, [float("nan")] * 33), (10_030, []),
           (10_040, [1.0, 2.0]), (None, [1.0] * 33), (10_050, [None] * 33)]
    table = spark.createDataFrame(rows + odd, "vec_id LONG, embedding ARRAY<DOUBLE>")
    found = one_bit.nearest(table.repartition(4), F.col("vec_id") % 5 == 0, 10).collect()
    hits = 0
    for query in range(0, count, 5):
        own = sorted((r for r in found if r.query_id == query), key=lambda r: r["rank"])
        gaps = np.sqrt(((vectors - vectors[query]) ** 2).sum(axis=1))
        order = [n for n in np.lexsort((np.arange(count), gaps)) if n != query][:10]
        assert [r["rank"] for r in own] == list(range(1, len(order) + 1))
        assert np.allclose([r.score for r in own], [gaps[r.vec_id] for r in own], rtol=1e-13)
        hits += len(set(order) & {r.vec_id for r in own}) / len(order)
    assert hits / len(range(0, count, 5)) > 0.99
    assert {r.query_id for r in found} == set(range(0, count, 5))
    assert one_bit.nearest(table.filter("false"), F.lit(True)).count() == 0


def test_estimates_keep_their_bounds():
    draw = np.random.default_rng(1)
    rows, queries_ = draw.standard_normal((500, 64)), draw.standard_normal((20, 64))
    estimate, slack = one_bit.Codes(*one_bit.encode(rows, np.zeros(64)), 64).bounds(queries_)
    exact = ((queries_[:, None] - rows[None]) ** 2).sum(axis=2)
    assert (np.abs(estimate - exact) <= slack).mean() > 0.99
    assert np.corrcoef(estimate.ravel(), exact.ravel())[0, 1] > 0.85


@needs_data
def test_share_that_is_reranked(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    vectors = np.stack(table.embedding).astype(float)
    mean, asked = vectors.mean(axis=0), np.flatnonzero(table.vec_id % 100 == 0)
    codes = one_bit.Codes(*one_bit.encode(vectors, mean), vectors.shape[1])
    estimate, slack = codes.bounds(vectors[asked] - mean)
    least = estimate - slack
    least[np.arange(len(asked)), asked] = np.inf
    q, v = one_bit.reranked(vectors[asked], vectors, least, 10)
    assert len(q) / least.size < 0.2
    for n, query in enumerate(asked):
        gaps = ((vectors - vectors[query]) ** 2).sum(axis=1)
        gaps[query] = np.inf
        assert set(np.argsort(gaps)[:10]) <= set(v[q == n])


@needs_data
def test_whole_table_searches(spark):
    table = spark.read.parquet(f"{LARGER}/embeddings.parquet").toPandas()
    vectors, ids = np.stack(table.embedding).astype(float), table.vec_id.to_numpy()
    found = op9_one_bit(spark, LARGER).toPandas()
    hits = total = 0
    for n in np.flatnonzero(ids % 100 == 0):
        gaps = ((vectors - vectors[n]) ** 2).sum(axis=1)
        order = [m for m in np.lexsort((ids, gaps)) if m != n][:10]
        hits += len(set(ids[order]) & set(found[found.query_id == ids[n]].vec_id))
        total += 10
    assert hits / total >= 0.99
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    near = (unit @ unit.T >= 0.98) & (table.label.to_numpy()[:, None] == table.label.to_numpy())
    links = dict(zip(ids, near.sum(axis=1) - 1))
    assert {r.vec_id: r.n_links for r in op1_p_stable(spark, LARGER).collect()} == links


@needs_data
def test_language_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    rows = op6_language(spark, LARGER).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_families_and_pairs():
    draw = np.random.default_rng(2)
    names = ["de", "en", "es", "fr", "xx"]
    centres = draw.random((5, 64))
    labels = [names[n % 5] for n in range(400)]
    rows = np.stack([centres[n % 5] + 0.2 * draw.random(64) for n in range(400)]).astype(np.float32)
    model = language.fit(rows, labels)
    assert model.families == ("germanic", "romance", "xx") and len(model.pairs) == 2
    best, score = model.predict(rows)
    assert np.mean([model.names[b] == name for b, name in zip(best, labels)]) > 0.99
    assert (score >= 0).all() and (score <= 1).all()
    single = language.fit(rows[:5:5], ["en"])
    assert single.predict(rows[:3])[0].tolist() == [0, 0, 0]


def test_ordinal_regression_recovers_order():
    draw = np.random.default_rng(3)
    rows = draw.standard_normal((3000, 6)).astype(np.float32)
    at = rows @ np.array([2.0, -1, 0.5, 0, 0, 1]) + draw.logistic(size=3000)
    grades = np.digitize(at, [-1.5, 1.0])
    model = quality.fit(rows[:2000], grades[:2000], np.empty(0, np.int64))
    assert model.thresholds[0] < model.thresholds[1]
    tails = model.tails(rows[2000:])
    assert (tails[:, 0] >= tails[:, 1]).all()
    expected = tails.sum(axis=1)
    assert np.corrcoef(expected, grades[2000:])[0, 1] > 0.7
    w = model.weights.astype(float)
    assert np.corrcoef(w, [2.0, -1, 0.5, 0, 0, 1])[0, 1] > 0.98


@needs_data
def test_quality_of_documents_not_learnt_from(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rated = quality.grades(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    unseen = F.pmod(F.col("doc_id"), F.lit(3)) == 0
    model = quality.train(documents, rated.filter(~unseen))
    scores = quality.scored(documents.filter(unseen), model).join(rated.filter(unseen), "doc_id").toPandas()
    scores["kept"] = scores.tail_probability >= quality.SELECTED_FROM
    kept = scores.groupby("grade").kept.mean()
    assert kept[2] > 0.97 and kept[1] < 0.1 and kept[0] < 0.1
    means = scores.groupby("grade").expected_grade.mean()
    assert means[0] < means[1] < means[2]


@needs_data
def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR).cache()
        assert docs.columns == columns, name
        assert docs.filter("n_chars <> length(text)").count() == 0
        seen.append((name, {r.doc_id for r in docs.select("doc_id").collect()}))
    for (_, before), (name, after) in zip(seen, seen[1:]):
        assert after <= before and after, name
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert tokens.count() == docs.count() and tokens.filter("NOT round_trip").count() == 0
    whole = corpus_pipeline.run(spark, SF_DIR)
    key = F.xxhash64("doc_id", "ids")
    assert whole.agg(F.sum(key % 1_000_003), F.count("*")).first() == tokens.agg(
        F.sum(key % 1_000_003), F.count("*")
    ).first()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "near_dedup", "personal_data", "mix", "tokens"
    ]


def test_queries_are_named_by_number():
    assert [name.split("_")[0] for name in queries()] == [f"op{n}" for n in range(1, 14)]
