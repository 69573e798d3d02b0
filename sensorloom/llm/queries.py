"""One query per operator, over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import (
    alignment,
    byte_bpe,
    feistel,
    fill_middle,
    language,
    minhash_forest,
    mixing,
    one_bit,
    p_stable,
    personal_data,
    quality,
    repeated_units,
    secret_scan,
)
from sensorloom.llm.tables import saved
from sensorloom.session import new_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_p_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among the vectors of each label, at a cosine of 0.98."""
    return p_stable.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.98)


def op2_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies by 2-word shingles at a similarity of 0.8."""
    return minhash_forest.near_duplicates(_table(spark, sf_dir, "documents"), words=2, percent=80)


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and places of personal data."""
    return personal_data.report(_table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each text and what they decode to, as digests."""
    return byte_bpe.digests(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.plan(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each text, learnt from the documents that are not held out."""
    documents = _table(spark, sf_dir, "documents")
    return language.predicted(documents, language.train(documents))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and probability of the highest grade of each text."""
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = quality.scored(documents, quality.train(documents, quality.grades(labels)))
    return scored.withColumn("kept", F.col("tail_probability") >= quality.SELECTED_FROM)


def op8_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of each document, of 40 shards."""
    return feistel.sharded(_table(spark, sf_dir, "documents"), shards=40)


def op9_one_bit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of each whose id is divisible by 100."""
    vectors = _table(spark, sf_dir, "embeddings")
    return one_bit.nearest(vectors, F.col("vec_id") % 100 == 0, k=10)


def op10_repeated_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeated passage that goes, with its place, and the document that keeps it."""
    return repeated_units.repeated_runs(_table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between two vocabularies' tokens of each text, scored by the corpus."""
    return alignment.scored(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document, by a ledger that begins empty."""
    return secret_scan.report(_table(spark, sf_dir, "documents"), new_folder(spark, "ledger"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of each transformed text, from a table of its frames."""
    store = saved(fill_middle.stored(_table(spark, sf_dir, "documents")), "frames")
    return fill_middle.report(store)


#: Near copies by counting common shingles of all pairs that have any.
_NEAR_COPIES = r"""
    WITH RECURSIVE worded AS (
      SELECT doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') AS w
      FROM documents
    ), shingled AS (
      SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
               ELSE [array_to_string(w[i:i + 1], ' ') FOR i IN range(1, greatest(len(w), 2))] END) AS s
      FROM worded
    ), sets AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM shingled
    ), common AS (
      SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) + any_value(y.n) AS total, count(*) AS shared
      FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
      WHERE 5 * x.n >= 4 * y.n AND 5 * y.n >= 4 * x.n
      GROUP BY x.doc_id, y.doc_id
    ), links AS MATERIALIZED (SELECT a, b FROM common WHERE 100 * shared >= 80 * (total - shared)
    ), reach AS (
      SELECT doc_id AS a, doc_id AS b FROM documents
      UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
    ), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, len(s) AS n_shingles, component_id, coalesce(doc_id = component_id, true) AS kept
    FROM shingled LEFT JOIN least ON a = doc_id"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_p_stable, op2_minhash_forest, op3_personal_data, op4_byte_bpe, op5_mixing, op6_language,
        op7_quality, op8_feistel, op9_one_bit, op10_repeated_units, op11_alignment, op12_secret_scan,
        op13_fill_middle,
    )
    return {query.__name__: query for query in every}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_p_stable": p_stable.near_duplicate_vectors_sql(cosine=0.98),
        "op2_minhash_forest": _NEAR_COPIES,
        "op5_mixing": mixing.plan_sql(),
        "op8_feistel": feistel.sharded_sql(shards=40),
        "op9_one_bit": one_bit.nearest_sql(every=100, k=10),
        "op12_secret_scan": secret_scan.report_sql(),
        "op13_fill_middle": fill_middle.report_sql(),
    }
