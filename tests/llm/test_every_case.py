"""Every operator on awkward tables: same rows with more columns, no rows from no rows."""

import collections

import public_tokenizers
import pytest
from conftest import PROSE
from pyspark.sql import functions as F

from sensorloom.llm import (
    byte_bpe, feistel, language, minhash_forest, mixing, personal_data, quality, repeated_units,
)

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def _quality(documents):
    return quality.scored(documents, quality.train(documents, quality.grades(_labels(documents))))


def _labels(documents):
    return documents.sparkSession.createDataFrame(
        [(0, 1, 0), (5, 0, 0), (9, 1, 1), (10, None, None), (None, 1, 0), (77, 1, 0), (0, 0, 0)],
        "doc_id LONG, quality INT, toxic INT",
    )


PER_ROW = {
    "near duplicates": minhash_forest.near_duplicates,
    "personal data": personal_data.report,
    "digests": lambda d: byte_bpe.digests(d, *VOCABULARY),
    "tokens": lambda d: byte_bpe.tokenize(d, *VOCABULARY),
    "mix": mixing.plan,
    "language": lambda d: language.predicted(d, language.train(d)),
    "quality": _quality,
    "shards": lambda d: feistel.sharded(d, 4),
    "repeats": repeated_units.report,
}
SAME_COLUMNS = {
    "one of each group": minhash_forest.one_of_each_group,
    "redacted": personal_data.redacted,
    "mixed": mixing.mixed,
    "selected": lambda d: quality.selected(d, _labels(d)),
}


def rows_of(frame):
    return collections.Counter(
        str(tuple(row)) for row in frame.select(*sorted(frame.columns)).collect()
    )


@pytest.mark.parametrize("name", PER_ROW)
def test_a_row_for_each_row(awkward, with_more_columns, no_documents, name):
    operator = PER_ROW[name]
    found = rows_of(operator(awkward))
    assert found.total() == awkward.count()
    assert rows_of(operator(with_more_columns)) == found
    assert operator(no_documents).count() == 0


@pytest.mark.parametrize("name", SAME_COLUMNS)
def test_columns_stay(awkward, with_more_columns, no_documents, name):
    operator = SAME_COLUMNS[name]
    plain, more = operator(awkward), operator(with_more_columns)
    assert plain.columns == awkward.columns and more.columns == with_more_columns.columns
    assert rows_of(more.select(*awkward.columns)) == rows_of(plain)
    others = [c for c in with_more_columns.columns if c not in awkward.columns]
    wrong = [F.col(f"`{c}`") != F.lit(f"own {c}") for c in others]
    assert more.filter(F.array_contains(F.array(*wrong), True)).count() == 0
    assert operator(no_documents).count() == 0


def test_results_of_awkward_rows(awkward):
    near = {r.doc_id: r for r in minhash_forest.near_duplicates(awkward).collect()}
    assert (near[1].component_id, near[1].kept, near[10].component_id) == (0, False, 9)
    assert all(near[i].component_id == i and near[i].kept for i in (0, 2, 3, 4, 5, 6))
    assert near[None].component_id is None and near[None].kept
    found = {r.doc_id: r for r in personal_data.report(awkward).collect()}
    assert found[-11].spans == "email:5:27,phone:36:53"
    assert {r.lang_pred for r in PER_ROW["language"](awkward.filter("doc_id IN (2, 3, 4, 7)")).collect()} == {"und"}
    cleaned = {r.doc_id: r for r in repeated_units.cleaned(awkward).collect()}
    assert cleaned[0].text == PROSE and cleaned[2].text is None
    assert rows_of(repeated_units.cleaned(awkward)).total() == awkward.count()


def test_nothing_to_learn_from(awkward, no_documents):
    assert quality.train(awkward, quality.grades(_labels(awkward).filter("doc_id = 77"))) is None
    assert language.train(no_documents) is None
    assert {r.lang_pred for r in language.predicted(awkward, None).collect()} == {"und"}
    scores = {r.doc_id: r.tail_probability for r in quality.scored(awkward, None).collect()}
    assert scores[0] == 1 and scores[4] == 0
