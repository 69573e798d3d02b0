"""The audit against schema documents other than the contract's."""

import json

import pytest

from sensorloom.operators.audit import audit_by_document

DOCUMENT = {
    "title": "an order",
    "type": "object",
    "required": ["id", "buyer"],
    "additionalProperties": False,
    "properties": {
        "id": {"type": "integer", "minimum": 1, "exclusiveMaximum": 1000},
        "state": {"enum": ["open", 7, None, True]},
        "note": {"type": ["string", "null"], "minLength": 2, "maxLength": 4},
        "on": {"type": "string", "format": "date"},
        "kind": {"const": "order"},
        "buyer": {
            "type": "object",
            "required": ["name"],
            "additionalProperties": False,
            "properties": {"name": {"type": "string", "pattern": "^[A-Z]"}, "address": {
                "type": "object", "required": ["zip"], "properties": {"zip": {"type": "string"}}}},
        },
        "lines": {
            "type": "array",
            "minItems": 1,
            "maxItems": 3,
            "items": {"type": "object", "required": ["sku"], "properties": {"n": {"type": "number", "minimum": 0}}},
        },
        "tags": {"type": "array", "items": {"type": "string"}},
    },
}

CASES = [
    ({"id": 1, "buyer": {"name": "Ann"}}, []),
    ({"id": 5.0, "buyer": {"name": "Ann"}}, []),
    ({"id": 5.5, "buyer": {"name": "Ann"}}, ["type:id"]),
    ({"id": 0, "buyer": {"name": "ann"}}, ["minimum:id", "pattern:buyer.name"]),
    ({"id": 1000, "buyer": {}}, ["exclusiveMaximum:id", "missing:buyer.name"]),
    ({"id": True, "buyer": []}, ["type:id", "type:buyer"]),
    ({"buyer": {"name": 3, "age": 4}}, ["missing:id", "type:buyer.name", "unknown:buyer.age"]),
    ({"id": 1, "buyer": {"name": "A", "address": {}}}, ["missing:buyer.address.zip"]),
    ({"id": 1, "buyer": {"name": "A", "address": {"zip": 1, "x": 2}}}, ["type:buyer.address.zip"]),
    ({"id": 1, "buyer": {"name": "A"}, "state": "open", "note": None}, []),
    ({"id": 1, "buyer": {"name": "A"}, "state": None, "kind": "order"}, []),
    ({"id": 1, "buyer": {"name": "A"}, "state": 7.0}, []),
    ({"id": 1, "buyer": {"name": "A"}, "state": True}, []),
    ({"id": 1, "buyer": {"name": "A"}, "state": False}, ["enum:state"]),
    ({"id": 1, "buyer": {"name": "A"}, "state": {}, "kind": 1}, ["enum:state", "const:kind"]),
    ({"id": 1, "buyer": {"name": "A"}, "note": "x"}, ["minLength:note"]),
    ({"id": 1, "buyer": {"name": "A"}, "note": "xxxxx"}, ["maxLength:note"]),
    ({"id": 1, "buyer": {"name": "A"}, "note": 5}, ["type:note"]),
    ({"id": 1, "buyer": {"name": "A"}, "on": "2031-02-30"}, ["format:on"]),
    ({"id": 1, "buyer": {"name": "A"}, "on": "2031-02-28"}, []),
    ({"id": 1, "buyer": {"name": "A"}, "lines": []}, ["minItems:lines"]),
    ({"id": 1, "buyer": {"name": "A"}, "lines": [{"sku": 1}] * 4}, ["maxItems:lines"]),
    (
        {"id": 1, "buyer": {"name": "A"}, "lines": [{"sku": 1, "n": -1}, {"n": "x"}, 3]},
        ["minimum:lines[].n", "missing:lines[].sku", "type:lines[]", "type:lines[].n"],
    ),
    ({"id": 1, "buyer": {"name": "A"}, "lines": {}}, ["type:lines"]),
    ({"id": 1, "buyer": {"name": "A"}, "tags": ["a", 1, None, "b"]}, ["type:tags[]"]),
    ({"id": 1, "buyer": {"name": "A"}, "tags": [], "zz": 1, "aa": 2}, ["unknown:aa", "unknown:zz"]),
    (["no object"], ["not_an_object"]),
]


def test_nested_documents(spark):
    sent = [(n, json.dumps(message)) for n, (message, _) in enumerate(CASES)]
    sent += [(len(CASES), None), (len(CASES) + 1, "{'id': 1}")]
    raw = spark.createDataFrame(sent, "n INT, value STRING")
    found = {row.n: list(row.violations) for row in audit_by_document(raw, DOCUMENT).collect()}
    for n, (message, expected) in enumerate(CASES):
        assert found[n] == expected, message
    assert found[len(CASES)] == ["not_an_object"]
    assert found[len(CASES) + 1] == ["syntax"]


@pytest.mark.parametrize(
    "inner",
    [{"oneOf": []}, {"type": "text"}, {"format": "email"}, {"additionalProperties": {}}, {"enum": [[1]]}],
)
def test_what_is_not_understood_is_an_error(spark, inner):
    raw = spark.createDataFrame([], "value STRING")
    for document in (
        {"type": "object", "properties": {"a": inner}},
        {"type": "object", "properties": {"a": {"type": "array", "items": inner}}},
    ):
        with pytest.raises(ValueError):
            audit_by_document(raw, document)
    with pytest.raises(ValueError):
        audit_by_document(raw, {"type": "array"})
