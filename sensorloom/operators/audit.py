"""Does a message keep to the letter of a schema document?"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom import contract as c
from sensorloom.functions import wire

# Type names of a schema document, and how schema_of_variant names these
# types.  Decimals carry a precision, containers their elements.
_KINDS = {
    "string": r"^STRING$",
    "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*\))$",
    "integer": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*\))$",
    "boolean": r"^BOOLEAN$",
    "null": r"^VOID$",
    "object": r"^OBJECT<",
    "array": r"^ARRAY<",
}
_KEYWORDS = {
    "object": ("required", "properties", "additionalProperties"),
    "array": ("items", "minItems", "maxItems"),
    "string": ("pattern", "format", "minLength", "maxLength"),
    "number": ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"),
    "any": ("type", "enum", "const"),
    "notes": ("$schema", "$id", "$comment", "title", "description", "default", "examples"),
}


def _is_date_time(text: Column) -> Column:
    """RFC 3339 form, and a date that exists."""
    return text.rlike(c.DATE_TIME_PATTERN) & F.upper(text).try_cast("timestamp").isNotNull()


def _is_date(text: Column) -> Column:
    return text.rlike(r"^\d{4}-\d{2}-\d{2}$") & text.try_cast("date").isNotNull()


_FORMATS: dict[str, Callable[[Column], Column]] = {"date-time": _is_date_time, "date": _is_date}


def _checked(schema: Mapping[str, Any], path: str) -> None:
    """A keyword that is not understood is an error, not a check that is left out."""
    known = {word for words in _KEYWORDS.values() for word in words}
    odd = [word for word in schema if word not in known]
    if schema.get("format", "date") not in _FORMATS:
        odd.append(f"format {schema['format']}")
    odd += [f"type {name}" for name in _types(schema) if name not in _KINDS]
    if not isinstance(schema.get("additionalProperties", True), bool):
        odd.append("additionalProperties as a schema")
    if odd:
        raise ValueError(f"not supported at {path or 'the top'}: {', '.join(odd)}")


def _types(schema: Mapping[str, Any]) -> list[str]:
    named = schema.get("type", [])
    return [named] if isinstance(named, str) else list(named)


def _strings(findings: list[Column]) -> Column:
    return F.array_compact(F.array(*findings)) if findings else F.array().cast("array<string>")


class _Value:
    """A variant with its kind; both null where there is no such member."""

    def __init__(self, variant: Column, kind: Column):
        self.variant, self.kind = variant, kind
        self.text = F.try_variant_get(variant, "$", "string")
        self.number = F.try_variant_get(variant, "$", "double")

    def is_a(self, name: str) -> Column:
        fits = self.kind.rlike(_KINDS[name])
        return fits & (self.number == F.floor(self.number)) if name == "integer" else fits

    def is_any(self, names: list[str]) -> Column:
        fits = F.lit(False)
        for name in names:
            fits = fits | self.is_a(name)
        return fits

    def among(self, allowed: list[Any]) -> Column:
        """Is it one of the values?  Containers among them are not supported."""
        texts = [v for v in allowed if isinstance(v, str)]
        numbers = [float(v) for v in allowed if isinstance(v, int | float) and not isinstance(v, bool)]
        flags = [v for v in allowed if isinstance(v, bool)]
        if len(texts) + len(numbers) + len(flags) + allowed.count(None) != len(allowed):
            raise ValueError("enum and const take texts, numbers, booleans and null")
        found = F.lit(False)
        if texts:
            found = found | (self.is_a("string") & self.text.isin(*texts))
        if numbers:
            found = found | (self.is_a("number") & self.number.isin(*numbers))
        if flags:
            flag = F.try_variant_get(self.variant, "$", "boolean")
            found = found | (self.is_a("boolean") & flag.isin(*flags))
        return found | self.is_a("null") if None in allowed else found


def _type_finding(schema: Mapping[str, Any], value: _Value, path: str) -> list[Column]:
    types = _types(schema)
    return [F.when(~value.is_any(types), F.lit(f"type:{path}"))] if types else []


def _limits(schema: Mapping[str, Any], value: _Value, path: str) -> list[Column]:
    """Findings of the keywords on texts, numbers and listed values."""
    text, number = value.text, value.number
    checks = {
        "pattern": ("string", lambda x: text.rlike(x), "pattern"),
        "format": ("string", lambda x: _FORMATS[x](text), "format"),
        "minLength": ("string", lambda x: F.length(text) >= x, "minLength"),
        "maxLength": ("string", lambda x: F.length(text) <= x, "maxLength"),
        "minimum": ("number", lambda x: number >= x, "minimum"),
        "maximum": ("number", lambda x: number <= x, "maximum"),
        "exclusiveMinimum": ("number", lambda x: number > x, "exclusiveMinimum"),
        "exclusiveMaximum": ("number", lambda x: number < x, "exclusiveMaximum"),
    }
    findings = []
    for word, (kind, holds, label) in checks.items():
        if word in schema:
            broken = value.is_a(kind) & ~holds(schema[word])
            findings.append(F.when(broken, F.lit(f"{label}:{path}")))
    typed = value.is_any(_types(schema)) if _types(schema) else value.kind.isNotNull()
    for word in ("enum", "const"):
        if word in schema:
            allowed = list(schema[word]) if word == "enum" else [schema[word]]
            findings.append(F.when(typed & ~value.among(allowed), F.lit(f"{word}:{path}")))
    return findings


def _inside(schema: Mapping[str, Any], value: _Value, path: str) -> list[Column]:
    """Arrays of findings within an object or array; each container is opened once."""
    found = []
    if any(word in schema for word in _KEYWORDS["object"]):
        members = value.variant.try_cast("map<string, variant>")
        found.append(_bound(members, lambda m: _members(schema, m, None, f"{path}.")))
    if any(word in schema for word in _KEYWORDS["array"]):
        elements = value.variant.try_cast("array<variant>")

        def of_elements(items: Column) -> Column:
            sizes = []
            if "minItems" in schema:
                sizes.append(F.when(F.size(items) < schema["minItems"], F.lit(f"minItems:{path}")))
            if "maxItems" in schema:
                sizes.append(F.when(F.size(items) > schema["maxItems"], F.lit(f"maxItems:{path}")))
            if "items" not in schema:
                return _strings(sizes)
            each = F.transform(
                items, lambda v: _value_findings(schema["items"], _Value(v, F.schema_of_variant(v)), f"{path}[]")
            )
            return F.concat(_strings(sizes), F.array_sort(F.array_distinct(F.flatten(each))))

        found.append(_bound(elements, of_elements))
    return found


def _bound(column: Column, findings: Callable[[Column], Column]) -> Column:
    """Findings over a column that is made once; none where it is null."""
    none = F.array().cast("array<string>")
    opened = F.transform(F.array(column), lambda x: F.when(x.isNotNull(), findings(x)).otherwise(none))
    return F.element_at(opened, 1)


def _value_findings(schema: Mapping[str, Any], value: _Value, path: str) -> Column:
    _checked(schema, path)
    own = _strings(_type_finding(schema, value, path) + _limits(schema, value, path))
    return F.concat(own, *_inside(schema, value, path))


def _members(schema: Mapping[str, Any], members: Column, kinds: Column | None, prefix: str) -> Column:
    """Findings of an object: what is missing, types, limits, what lies deeper, what is unknown."""
    _checked(schema, prefix)
    properties = schema.get("properties", {})
    missing = [
        F.when(~F.map_contains_key(members, name), F.lit(f"missing:{prefix}{name}"))
        for name in schema.get("required", [])
    ]
    types, limits, deeper = [], [], []
    for name, inner in properties.items():
        path, member = f"{prefix}{name}", members[name]
        value = _Value(member, F.schema_of_variant(member) if kinds is None else kinds[name])
        _checked(inner, path)
        types += _type_finding(inner, value, path)
        limits += _limits(inner, value, path)
        deeper += _inside(inner, value, path)
    parts = [_strings(missing + types + limits), *deeper]
    if schema.get("additionalProperties", True) is False:
        names = F.array(*[F.lit(name) for name in properties]).cast("array<string>")
        extra = F.array_sort(F.array_except(F.map_keys(members), names))
        parts.append(F.transform(extra, lambda name: F.concat(F.lit(f"unknown:{prefix}"), name)))
    return F.concat(*parts)


def _unparsed(text: Column) -> Column:
    """Findings where there is no object in strict JSON."""
    readable = wire.record(text)[c.CORRUPT_RECORD].isNull() & (F.trim(text) != "")
    keys = F.json_object_keys(text)
    twice = F.filter(
        F.array_distinct(keys), lambda key: F.size(F.filter(keys, lambda other: other == key)) > 1
    )
    named = F.transform(F.array_sort(twice), lambda key: F.concat(F.lit("duplicate:"), key))
    lenient = F.when(F.size(twice) > 0, named).otherwise(F.array(F.lit("syntax")))
    return F.when(readable & keys.isNotNull(), lenient).otherwise(F.array(F.lit("not_an_object")))


def audit_by_document(raw: DataFrame, document: Mapping[str, Any], value_col: str = "value") -> DataFrame:
    """Add ``violations`` to every message; an empty array means that it conforms.

    ``document`` is a JSON schema as a dictionary.  It is turned into columns once, on
    the driver, and may have objects and arrays within it.  Understood are ``type`` (one
    or several), ``required``, ``properties``, ``additionalProperties`` as a boolean,
    ``enum``, ``const``, ``pattern``, ``format`` (``date-time``, ``date``), limits on
    numbers and lengths, ``items`` and their number.  Any other keyword is an error,
    except those that only describe.

    A finding is the keyword and the path of the value, such as ``pattern:device_id``,
    ``minimum:order.total`` or ``type:tags[]`` (once, however many elements have it);
    ``missing:`` and ``unknown:`` stand for required and additional properties.

    The text is read as a variant, which keeps the JSON type of each member.
    As in :func:`decode`, text after the first object is not looked at.  Where
    strict JSON has no such object but ``decode`` reads one, the finding is
    ``duplicate:`` with each key given twice, or else ``syntax``, as for keys in
    single quotes.  Text that ``decode`` cannot read either is ``not_an_object``.
    """
    if _types(document) != ["object"]:
        raise ValueError("a message is an object")
    text = F.col(value_col).cast("string")
    members = F.try_parse_json(text).try_cast("map<string, variant>")
    parsed = raw.select("*", F.inline(F.array(F.struct(members.alias("members")))))
    kinds = F.transform_values("members", lambda _, member: F.schema_of_variant(member))
    found = _members(document, F.col("members"), F.col("kinds"), "")
    audited = parsed.withColumn("kinds", kinds).withColumn(
        "violations", F.when(F.col("members").isNull(), _unparsed(text)).otherwise(found)
    )
    return audited.drop("members", "kinds")


def audit_contract(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """:func:`audit_by_document` by the contract of telemetry readings.

    Stricter than :func:`classify`, which lets unknown properties, odd ids and
    numbers in quotes pass.
    """
    return audit_by_document(raw, c.TELEMETRY_DOCUMENT, value_col)
