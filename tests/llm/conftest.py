"""Tables that hold every awkward case at once."""

import pytest

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"
#: Columns of other tables and of the operators' own making.
CLASHING = (
    "size", "digest", "label", "rank", "words", "place", "first", "n", "row", "removed", "copies",
    "_size", "_spans", "_hits_0", "_copy", "_nth", "_doc", "component_id", "cluster", "signature",
    "regions", "kept", "target", "shard", "bucket", "at", "grade", "quality", "best", "score",
    "held_out", "run", "runs", "ids", "code", "vec_id", "embedding", "mean", "query", "set",
)

PROSE = (
    "The river rose by a hand in the night. Nobody in the upper village had seen it come, and the "
    "ferry lay on the wrong side. By noon the water stood in the lower gardens, brown and slow."
)


def awkward_rows():
    long_text = " ".join(f"w{n % 977}" for n in range(60_000))
    rows = [
        (0, PROSE, "en", "a", 1),
        (1, PROSE, "en", "a", 1),
        (1, PROSE, "en", "a", 1),  # repeated row
        (2, None, "en", "b", None),
        (3, "", None, None, 0),
        (4, " \n\t ", "de", "b", 4),
        (5, long_text, "fr", "a", None),
        (6, "x" * 300_000, "es", "c", None),
        (7, "1" * 5000, "es", "c", None),
        (None, PROSE, "en", None, 1),
        (None, None, None, None, None),
        (8, "é 語 🙂 " * 50, "fr", "c", 1),
        (9, "one", "de", "b", 3),
        (10, "one", "de", "b", 3),
        (-11, "Mail joe.b@mail.example.org or call +1 (555) 010-9999.", "en", "d", 50),
    ]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def with_more_columns(awkward):
    from pyspark.sql import functions as F

    return awkward.select("*", *[F.lit(f"own {name}").alias(name) for name in CLASHING])


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
