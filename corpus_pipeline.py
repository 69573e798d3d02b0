"""From raw documents to token ids: five stages, each of one operator.

1. ``quality``: documents that the ordinal model rates poor or toxic go.
2. ``near_dedup``: one document of each group of near copies stays.
3. ``personal_data``: spans of personal data are replaced by their kind.
4. ``mix``: sources are mixed to target weights; a document comes as often as
   the mix takes it, in parts where the mix cuts it.
5. ``tokens``: texts become token ids, and the ids are decoded again.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one
before it kept.  All but the last return the columns of ``documents``, other
columns included; ``n_chars`` follows the text.  How nulls, empty texts, repeated
rows and empty tables come out is stated at the operators.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import byte_bpe, minhash_forest, mixing, personal_data, quality
from sensorloom.llm.tables import saved

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Learning and selection cannot be said in SQL; the stages are tested one by one.
ORACLE_SQL: str | None = None


def _recounted(documents: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now, where there is such a column."""
    if "n_chars" not in documents.columns:
        return documents
    kind = documents.schema["n_chars"].dataType
    return documents.withColumn("n_chars", F.length("text").cast(kind))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.selected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_forest.one_of_each_group(docs, words=5, percent=80)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(personal_data.redacted(docs))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(mixing.mixed(docs))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip): whether the ids decode to the text."""
    return byte_bpe.tokenize(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("personal_data", personal_data_stage),
    ("mix", mix_stage),
    ("tokens", tokens_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
