"""Personal data: expressions propose spans, validators confirm, context adjusts the score.

Only column functions are used (:mod:`sensorloom.llm.spans` finds the places, in
code points).  Matches are leftmost and don't overlap within a kind; one that its
validator refuses is dropped, and the search goes on behind it.  Context is looked
for on both sides, by whole words, as far as the next match of the same kind.

The patterns say the same as those of the contract in a form that a
backtracking matcher runs in one pass: possessive repeats, and a beginning only
where no earlier character could belong to the match.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.secret_scan import ASSIGN, long_value
from sensorloom.llm.spans import joined, with_matches, with_replaced
from sensorloom.llm.tables import boxed, unboxed

_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_LOCAL = "[A-Za-z0-9._%+-]"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _is_ip(hit: Column) -> Column:
    return hit.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")


def _is_card(hit: Column) -> Column:
    digits = _digits(hit)
    return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)


def _is_phone(hit: Column) -> Column:
    return F.length(_digits(hit)).between(10, 15)


def _is_iban(hit: Column) -> Column:
    """Mod-97: the first four characters to the end, letters as 10 to 35."""
    plain = F.regexp_replace(hit, " ", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    code = F.filter(F.split(turned, ""), lambda c: c != "")
    value = F.aggregate(
        code,
        F.lit(0),
        lambda rest, c: F.when(
            c.rlike("[0-9]"), F.pmod(rest * 10 + c.try_cast("int"), F.lit(97))
        ).otherwise(F.pmod(rest * 100 + F.ascii(c) - 55, F.lit(97))),
    )
    return F.length(plain).between(15, 34) & (value == 1)


def _always(hit: Column) -> Column:
    return hit.isNotNull()


@dataclass(frozen=True)
class Kind:
    """``near`` are words that raise the score if they stand close to a match."""

    name: str
    pattern: str
    hint: str
    valid: Callable[[Column], Column]
    score: float
    near: tuple[str, ...] = field(default=())


#: The kinds of the contract, in its order.  They need no context.
BASE = (
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
         _always, 0.9, ("mail", "contact", "write")),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", _is_ip, 0.6,
         ("ip", "host", "server", "address")),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", "", _is_card, 0.8, ("card", "visa", "pay", "credit")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", _is_phone, 0.7,
         ("phone", "call", "tel", "mobile", "fax")),
)
#: Further kinds.  A number in the form of a national id counts by its context only.
MORE = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"
         r"(?![A-Za-z0-9])", "", _is_iban, 0.8, ("iban", "account", "bank", "transfer")),
    Kind("national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", _always, 0.3,
         ("ssn", "social", "security", "national", "identity")),
    Kind("secret", ASSIGN, "", long_value, 0.7, ("key", "login", "credential", "private")),
    Kind("access_key", "AKIA[A-Z0-9]{14,}", "AKIA", _always, 0.9),
)
#: How far from a match its context reaches, what a word there adds, what is needed.
REACH, BONUS, ENOUGH = 40, 0.25, 0.5


def with_spans(documents: DataFrame, kinds: tuple[Kind, ...] = BASE + MORE) -> DataFrame:
    """All columns, and ``_spans``: structs (start, kind_no, end, kind, score) by start, then kind.

    ``end`` is exclusive.  A null or empty text has none.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    needed = {"email": "@", "secret": "[:=]", "access_key": "AKIA"}
    found = with_matches(
        documents,
        text,
        {
            f"_found_{i}": (
                kind.pattern,
                F.contains(text, F.lit(kind.hint)) & text.rlike(needed.get(kind.name, "[0-9]")),
            )
            for i, kind in enumerate(kinds)
        },
        {f"_found_{i}": kind.valid for i, kind in enumerate(kinds)},
    )
    nothing = F.array().cast("array<struct<start:int,kind_no:int,end:int,kind:string,score:double>>")
    parts = [F.coalesce(_scored(F.col(f"_found_{i}"), i, kind), nothing) for i, kind in enumerate(kinds)]
    helpers = [f"_found_{i}" for i in range(len(kinds))]
    return found.withColumn("_spans", F.array_sort(F.concat(*parts))).drop(*helpers)


def _scored(matches: Column, number: int, kind: Kind) -> Column:
    words = rf"(?<![a-z0-9])(?:{'|'.join(kind.near)})s?(?![a-z0-9])"

    def score(match: Column) -> Column:
        before = F.lower(F.substring(match["gap"], -REACH, REACH))
        after = F.lower(F.substring(match["next"], 1, REACH))
        near = before.rlike(words) | after.rlike(words) if kind.near else F.lit(False)
        raised = F.lit(kind.score) + F.when(near, F.lit(BONUS)).otherwise(F.lit(0.0))
        return F.least(raised, F.lit(1.0))

    def span(match: Column) -> Column:
        return F.struct(
            match["start"].alias("start"), F.lit(number).alias("kind_no"), match["end"].alias("end"),
            F.lit(kind.name).alias("kind"), score(match).alias("score"),
        )

    valid = F.filter(matches, lambda m: kind.valid(m["hit"]))
    return F.filter(F.transform(valid, span), lambda s: s["score"] >= ENOUGH)


def report(documents: DataFrame) -> DataFrame:
    """Counts, a digest of the contract's spans and all spans of each row of (doc_id, text).

    ``highest_score`` is that of the surest span, null without any.

    Rows are independent: repeated ones have equal results, a null doc_id stays
    null, a null or empty text has no spans, an empty table gives no rows.
    """
    found = with_spans(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    base = F.filter("_spans", lambda s: s["kind_no"] < len(BASE))

    def count(i: int) -> Column:
        return F.size(F.filter("_spans", lambda s: s["kind_no"] == i)).cast("long")

    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{kind.name}") for i, kind in enumerate(BASE)],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("_spans")).alias("spans"),
        F.size("_spans").cast("long").alias("n_spans"),
        F.array_max(F.transform("_spans", lambda s: s["score"])).alias("highest_score"),
    )


def redacted(documents: DataFrame) -> DataFrame:
    """All rows and columns, each span of ``text`` replaced by its kind, as in ``[EMAIL]``.

    Spans that overlap are replaced together, under the kind of the first.  A
    text without spans stays as it is, null too.
    """
    found = with_replaced(with_spans(boxed(documents, "text")), "text", "_spans", "_text")
    return unboxed(found, documents.columns, text=F.col("_text"))
