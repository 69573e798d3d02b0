"""One row repeated very often, and several rows of one id."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.llm import feistel, features, language, mixing, one_bit, quality, tables

TEXTS = {
    "en": "the river rose by a hand and nobody had seen it come in the night number {}",
    "de": "der fluss stieg um eine hand und niemand hatte ihn in der nacht kommen sehen zahl {}",
}


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(2 * n + (k == "de"), TEXTS[k].format(n), k) for k in TEXTS for n in range(60)]
    few = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING")
    again = few.where("doc_id = 0").crossJoin(spark.range(100_000)).drop("id")
    return few.unionByName(again).repartition(4).cache(), few


def test_a_sample_counts_documents(documents):
    many, few = documents
    for label_bound, in_all in ((1000, None), (40, None), (1000, 50)):
        found = features.sample(many, "lang", label_bound, in_all)
        assert sorted(found.collect()) == sorted(features.sample(few, "lang", label_bound, in_all).collect())
    assert features.sample(many, "lang", 1000, 50).count() == 50
    assert features.sample(many, "lang", 1000, 1).count() == 2


def test_language_learns_each_document_once(documents):
    many, few = documents
    model, other = language.train(many), language.train(few)
    assert model.names == other.names == ("de", "en")
    assert (model.machines == other.machines).all()
    told = language.predicted(many, model).groupBy("lang_pred").count().collect()
    assert {r.lang_pred: r["count"] for r in told} == {"de": 60, "en": 100_060}


def test_quality_learns_each_document_once(documents):
    many, few = documents
    rated = few.select("doc_id", (F.col("doc_id") % 3).cast("int").alias("grade"))
    model, other = quality.train(many, rated), quality.train(few, rated)
    assert (model.slots == other.slots).all() and (model.weights == other.weights).all()


def test_of_several_texts_the_least(spark, documents):
    few = documents[1]
    more = few.unionByName(few.withColumn("text", F.concat(F.lit("zz "), "text")))
    assert (language.train(more).machines == language.train(few).machines).all()


def test_shards_of_repeated_rows(documents, monkeypatch):
    monkeypatch.setattr(tables, "COPIES_AT_ONCE", 1 << 12)
    many = documents[0]
    found = feistel.sharded(many, 7).cache()
    assert found.count() == many.count() == found.select("row_number").distinct().count()
    sizes = {r.shard: (r.n, r.last) for r in found.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n"), F.max("slot").alias("last")).collect()}
    assert all(n == last + 1 for n, last in sizes.values())
    assert max(n for n, _ in sizes.values()) - min(n for n, _ in sizes.values()) <= 1
    assert found.filter("doc_id = 0").count() == 100_001


def test_mix_of_repeated_rows(documents, monkeypatch):
    monkeypatch.setattr(tables, "COPIES_AT_ONCE", 1 << 12)
    many = documents[0].withColumn("source", F.col("lang"))
    blank = many.filter("lang = 'de'").limit(1).withColumn("text", F.lit(" ")).withColumn("source", F.lit("none"))
    whole = many.unionByName(blank.crossJoin(many.sparkSession.range(50_000)).drop("id"))
    taken = mixing.plan(whole).cache()
    assert taken.count() == whole.count()
    by_source = {r.source: r for r in taken.groupBy("source").agg(
        F.sum("size").alias("words"), F.sum("taken").alias("taken"), F.max("target").alias("target"),
        F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect()}
    assert by_source["none"].words == by_source["none"].taken == 0
    assert all(r.over <= 0 and abs(r.taken - r.target) <= 64 + 0.01 * r.target for r in by_source.values())


def test_search_of_repeated_rows(spark):
    draw = np.random.default_rng(4)
    rows = [(n, draw.standard_normal(16).tolist()) for n in range(60)]
    few = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>")
    again = few.filter("vec_id IN (0, 7)").crossJoin(spark.range(20_000)).drop("id")
    second = few.filter("vec_id = 9").select("vec_id", F.transform("embedding", lambda x: F.lit(9.0) + F.abs(x)))
    many = few.unionByName(again).union(second).withColumn("row", F.lit("own")).withColumn("code", F.lit("own"))
    asked = F.col("vec_id") % 10 == 0
    found = one_bit.nearest(many, asked).collect()
    least = many.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    vectors = {r.vec_id: np.array(r.embedding) for r in least.collect()}
    for query in range(0, 60, 10):
        gaps = sorted((float(((v - vectors[query]) ** 2).sum()), n) for n, v in vectors.items() if n != query)
        own = sorted((r for r in found if r.query_id == query), key=lambda r: r["rank"])
        assert [r.vec_id for r in own] == [n for _, n in gaps[:10]]
    assert len(found) == 60 and len({(r.query_id, r.vec_id) for r in found}) == 60
