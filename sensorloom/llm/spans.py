"""Places of the matches of patterns, by column functions alone.

A text is split at the matches of a pattern; the lengths of the gaps and matches
add up to the places, in code points.  The sums are taken in blocks of about the
cube root of the number of matches, first over the blocks, then within each, so
that a text with hundreds of thousands of matches costs little more than its
length.

Arrays that a lambda goes through step by step are zipped into its argument or used
more than once: Spark would put the expression of one that is used once into the
lambda, and work it out again at each step.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_matches(
    documents: DataFrame,
    text: Column,
    patterns: dict[str, tuple[str, Column]],
    counts: dict[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """All columns, and one for each name: the matches of (pattern, condition) in order.

    A match has ``start``, ``end`` (exclusive), ``hit``, and the text between it and
    its neighbours (``gap``, ``next``).  The column is null where the condition does
    not hold, nothing matches, or no hit passes ``counts``, which spares the places of
    what is dropped anyway.  ``text`` must not be null.
    """
    counts = counts or {}
    frame = documents.withColumns(
        {
            f"_hits_{name}": F.when(condition & text.rlike(pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
            for name, (pattern, condition) in patterns.items()
        }
    )
    if counts:
        frame = frame.withColumns(
            {f"_hits_{name}": F.when(F.exists(f"_hits_{name}", some), F.col(f"_hits_{name}")) for name, some in counts.items()}
        )
    frame = frame.withColumns(
        {
            f"_gaps_{name}": F.when(F.col(f"_hits_{name}").isNotNull(), F.split(text, pattern, -1))
            for name, (pattern, _) in patterns.items()
        }
    )
    frame = frame.withColumns(
        {f"_sizes_{name}": _sizes(F.col(f"_gaps_{name}"), F.col(f"_hits_{name}")) for name in patterns}
    )
    frame = with_running(frame, {f"_before_{name}": (f"_sizes_{name}", _sum) for name in patterns})
    frame = frame.withColumns(
        {
            name: _placed(*[F.col(f"_{helper}_{name}") for helper in ("hits", "gaps", "before")])
            for name in patterns
        }
    )
    helpers = ("hits", "gaps", "sizes", "before")
    return frame.drop(*[f"_{helper}_{name}" for helper in helpers for name in patterns])


def _sizes(gaps: Column, hits: Column) -> Column:
    """Length of each match and the gap before it."""
    return F.transform(hits, lambda hit, i: F.length(F.get(gaps, i)) + F.length(hit))


def _sum(a: Column, b: Column) -> Column:
    return a + b


def with_running(
    frame: DataFrame, columns: dict[str, tuple[str, Callable[[Column, Column], Column]]]
) -> DataFrame:
    """For each (array of non-negative integers, how two are combined): what all before each give.

    The first has nothing before it, which is 0.
    """
    frame = frame.withColumns(
        {f"_of_blocks_{name}": _of_blocks(F.col(source), combine) for name, (source, combine) in columns.items()}
    )
    frame = frame.withColumns(
        {
            name: _within(F.col(source), F.col(f"_of_blocks_{name}"), combine)
            for name, (source, combine) in columns.items()
        }
    )
    return frame.drop(*[f"_of_blocks_{name}" for name in columns])


def _block(values: Column, number: Column) -> Column:
    """The places of a block in the array."""
    side = _side(values)
    return F.sequence(number * side, F.least((number + 1) * side, F.size(values)) - 1)


def _side(values: Column) -> Column:
    return F.ceil(F.cbrt(F.size(values))).cast("int")


def _numbers(values: Column) -> Column:
    return F.sequence(F.lit(0), F.ceil(F.size(values) / _side(values)).cast("int") - 1)


def _of_blocks(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    def add(found: Column, number: Column) -> Column:
        own = F.aggregate(_block(values, number), F.lit(0), lambda so_far, i: combine(so_far, F.get(values, i)))
        return F.concat(found, F.array(combine(F.element_at(found, -1), own)))

    whole = F.aggregate(_numbers(values), F.array(F.lit(0)), add)
    return F.when(F.size(values) > 0, whole)


def _within(values: Column, of_blocks: Column, combine: Callable[[Column, Column], Column]) -> Column:
    def of_block(block: Column) -> Column:
        inner = F.aggregate(
            _block(values, block["number"]),
            F.array(block["before"]),
            lambda found, i: F.concat(found, F.array(combine(F.element_at(found, -1), F.get(values, i)))),
        )
        return F.slice(inner, F.lit(1), F.size(inner) - 1)

    numbers = _numbers(values)
    blocks = F.arrays_zip(numbers.alias("number"), F.slice(of_blocks, F.lit(1), F.size(numbers)).alias("before"))
    return F.when(F.size(values) > 0, F.flatten(F.transform(blocks, of_block)))


def with_replaced(frame: DataFrame, text: str, spans: str, into: str) -> DataFrame:
    """All columns, and ``into``: the text with each span (start, end, kind) as ``[KIND]``.

    Spans are in order of their start.  Those that overlap are replaced together,
    under the kind of the first.  The text is cut into about the square root of the
    number of spans first, as finding a place in it takes as long as the place is far.
    """
    frame = frame.withColumn("_ends", F.transform(spans, lambda s: s["end"]))
    frame = with_running(frame, {"_reach": ("_ends", lambda a, b: F.greatest(a, b))})
    placed = F.transform(
        F.arrays_zip(F.col(spans).alias("span"), F.col("_reach").alias("reach")),
        lambda s: F.struct(
            s["span"]["start"].alias("start"), s["reach"].alias("reach"), s["span"]["kind"].alias("kind")
        ),
    )
    frame = frame.withColumn("_apart", F.filter(placed, lambda s: s["start"] >= s["reach"]))
    apart, last = F.col("_apart"), F.array_max("_ends")
    # What the spans up to the next one apart reach is the end of those replaced together.
    ends = F.transform(apart, lambda s, i: F.coalesce(F.get(apart, i + 1)["reach"], last))
    frame = frame.withColumn("_stops", ends)
    stops, size = F.col("_stops"), F.size("_apart")
    side = F.ceil(F.sqrt(size)).cast("int")

    def stop_before(i: Column) -> Column:
        return F.coalesce(F.get(stops, i - 1), F.lit(0))

    def of_block(number: Column) -> Column:
        first, to = number * side, F.least((number + 1) * side, size) - 1
        begin = stop_before(first)
        part = F.substring(F.col(text), begin + 1, F.get(stops, to) - begin)

        def piece(own: Column, i: Column) -> Column:
            span, before = F.get(apart, i), stop_before(i)
            gap = F.substring(own, before - begin + 1, span["start"] - before)
            return F.concat(gap, F.lit("["), F.upper(span["kind"]), F.lit("]"))

        # A one-element array holds the part, so that it is cut out once.
        whole = F.transform(
            F.array(part), lambda own: F.array_join(F.transform(F.sequence(first, to), lambda i: piece(own, i)), "")
        )
        return F.get(whole, F.lit(0))

    blocks = F.sequence(F.lit(0), F.ceil(size / side).cast("int") - 1)
    tail = F.substring(F.col(text), last + 1, F.lit(2**31 - 1))
    changed = F.concat(F.array_join(F.transform(blocks, of_block), ""), tail)
    out = frame.withColumn(into, F.when(F.size(spans) > 0, changed).otherwise(F.col(text)))
    return out.drop("_ends", "_reach", "_apart", "_stops")


def _placed(hits: Column, gaps: Column, before: Column) -> Column:
    def place(match: Column) -> Column:
        start = match["before"] + F.length(match["gap"])
        return F.struct(
            start.alias("start"), (start + F.length(match["hit"])).alias("end"), match["hit"].alias("hit"),
            match["gap"].alias("gap"), match["next"].alias("next"),
        )

    each = F.arrays_zip(
        hits.alias("hit"),
        before.alias("before"),
        F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"),
        F.slice(gaps, F.lit(2), F.size(hits)).alias("next"),
    )
    return F.transform(each, place)


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
