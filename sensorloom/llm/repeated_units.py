"""Repeated lines, sentences and passages of texts, by hashing.

1. Each text is cut into units: lines, and within lines sentences.  A sentence
   begins after one that ends in ``.``, ``!`` or ``?``, or at a capitalised word.
   A unit of more than ``LONG`` words is cut at words chosen by their hash.
2. A unit is normalised (A-Z in lower case, white space as one separator) and
   hashed to 64 bits.
3. The digests are grouped over all documents.  The occurrence ranked first, by
   (doc_id, place), stays; the others are repeats.
4. A repeated line of ``LEAST_LINE`` words or more goes, so at any length, and
   with its lines a paragraph.
5. Neighbouring repeats of a document form a run.  Runs of at least
   ``LEAST_WORDS`` words go, with their place in the original text kept.
6. A passage need not begin or end where a unit does.  So runs of ``GRAM`` words
   are hashed too, the least hash in every ``WINDOW`` neighbours (winnowing): two
   equal runs of ``GRAM + WINDOW - 1 = LEAST_WORDS`` words have one in common,
   wherever they stand.  Where repeated ones begin and end, the runs of
   ``LEAST_WORDS`` words around them are compared word by word, which gives the
   passage to its first and last word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.hashed_text import bytes_and_bounds, groups, mix, word_hashes, word_spans
from sensorloom.llm.tables import boxed, removed, saved, unboxed
from sensorloom.session import new_folder

LONG = 48
#: One word in so many ends a part of a long unit.
CUT = np.uint64(16)
LEAST_WORDS = 25
LEAST_LINE = 1
#: Equal runs of GRAM + WINDOW - 1 words have an anchor in common.
GRAM = 13
WINDOW = 13
#: More than any text has units.
PLACES = 2**31
#: One row in so many tells which digests are frequent; these have so many such rows at least.
SAMPLED, FREQUENT = 64, 8

_FACTOR = np.uint64(0xBF58_476D_1CE4_E5B9)
_BACK = np.uint64(pow(int(_FACTOR), -1, 2**64))
SENTENCE, LINE, ANCHOR, PASSAGE = range(4)
_SALT = np.array([0, 0x51ED_270B_7F4A_7C15, 0x2545_F491_4F6C_DD1D, 0x632B_E59B_D9B4_E019], np.uint64)
_UNITS = "kind byte, digest long, doc_id long, place int, words int, begin int, length int"


def _capitalised(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A-Z, or a capital of Latin-1, with no capital letter behind it."""
    first = raw[begins]
    second = np.where(begins + 1 < ends, raw[np.minimum(begins + 1, len(raw) - 1)], 0)
    third = np.where(begins + 2 < ends, raw[np.minimum(begins + 2, len(raw) - 1)], 0)
    plain = (first >= 65) & (first <= 90)
    latin = (first == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    after = np.where(latin, third, second)
    return (plain | latin) & ~((after >= 65) & (after <= 90)) & (after != 0xC3)


class Digests:
    """Digests of runs of words, from the hashes of the words."""

    def __init__(self, hashes: np.ndarray):
        up = np.full(len(hashes), _FACTOR)
        down = np.full(len(hashes), _BACK)
        up[:1] = down[:1] = 1
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(hashes * np.cumprod(up))))
        self.down = np.cumprod(down)

    def __call__(self, starts: np.ndarray, stops: np.ndarray, kind: int = SENTENCE) -> np.ndarray:
        words = (stops - starts).astype(np.uint64)
        return mix((self.sums[stops] - self.sums[starts]) * self.down[starts] + words + _SALT[kind])


def anchors_of(digests: Digests, first_word: np.ndarray) -> np.ndarray:
    """First words of the chosen runs of GRAM words; the words of each text begin at ``first_word``."""
    words = len(digests.down)
    if words < GRAM + WINDOW - 1:
        return np.empty(0, np.int64)
    starts = np.arange(words - GRAM + 1)
    grams = digests(starts, starts + GRAM, ANCHOR)
    windows = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
    left = np.arange(len(windows))
    text = np.searchsorted(first_word, left, side="right")
    within = left + GRAM + WINDOW - 1 <= np.append(first_word, words)[text]
    chosen = np.zeros(words, bool)
    chosen[(left + windows.argmin(axis=1))[within]] = True
    return np.flatnonzero(chosen)


def units_of(
    raw: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per unit: number of its text, digest, words, and its first and last byte's place."""
    begins, ends = word_spans(raw, bounds)
    if not len(begins):
        return tuple(np.empty(0, np.int64) for _ in range(5))
    hashes = word_hashes(raw, begins, ends)
    text = np.searchsorted(bounds, begins, side="right") - 1
    lines = np.cumsum(raw == 10)
    new = np.ones(len(begins), bool)
    last = raw[ends[:-1] - 1]
    before = np.where(ends[:-1] - begins[:-1] > 1, raw[ends[:-1] - 2], 32)
    stop = np.isin(last, (33, 46, 63)) & ~np.isin(before, (33, 46, 63))
    new[1:] = (
        (text[1:] != text[:-1])
        | (lines[begins[1:]] != lines[begins[:-1]])
        | stop
        | _capitalised(raw, begins, ends)[1:]
    )
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(begins)))
    in_long = np.repeat(counts > LONG, counts)
    new[1:] |= in_long[1:] & (hashes[:-1] % CUT == 0)
    starts = np.flatnonzero(new)
    stops = np.append(starts[1:], len(begins))
    digest = Digests(hashes)(starts, stops)
    return text[starts], digest.view(np.int64), stops - starts, begins[starts], ends[stops - 1]


def _batches(part, inner, ids, spans) -> Iterator[pa.RecordBatch]:
    """Rows of ``_UNITS`` of the (kind, digest, first word, word behind) in ``spans``."""
    begins, ends = word_spans(part, inner)
    first_word = np.searchsorted(begins, inner[:-1])
    points = np.concatenate(([0], np.cumsum((part & 0xC0) != 0x80)))
    for kind, digest, starts, stops in spans:
        if not len(starts):
            continue
        text = np.searchsorted(inner, begins[starts], side="right") - 1
        origin = points[inner[text]]
        columns = (
            starts - first_word[text], stops - starts,
            points[begins[starts]] - origin, points[ends[stops - 1]] - points[begins[starts]],
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(starts), kind, np.int8)),
                pa.array(digest.view(np.int64)),
                pa.array(ids[text]),
                *[pa.array(values.astype(np.int32)) for values in columns],
            ],
            names=["kind", "digest", "doc_id", "place", "words", "begin", "length"],
        )


def _with_text(documents: DataFrame) -> DataFrame:
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.filter("doc_id IS NOT NULL AND text IS NOT NULL")


def cut(documents: DataFrame, passages: bool = True) -> DataFrame:
    """Sentences, lines and, for passages, anchors of each row of (doc_id, text).

    ``place`` is the number of the first word; ``begin`` and ``length`` are code points.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            raw, bounds = bytes_and_bounds(batch.column("text"))
            for first, last in groups(bounds):
                part = raw[bounds[first] : bounds[last]]
                inner = bounds[first : last + 1] - bounds[first]
                begins, ends = word_spans(part, inner)
                if not len(begins):
                    continue
                _, digest, words, begin, _ = units_of(part, inner)
                starts = np.searchsorted(begins, begin)
                spans = [(SENTENCE, digest, starts, starts + words)]
                digests = Digests(word_hashes(part, begins, ends))
                text = np.searchsorted(inner, begins, side="right") - 1
                line = np.cumsum(part == 10)[begins]
                new = np.ones(len(begins), bool)
                new[1:] = (text[1:] != text[:-1]) | (line[1:] != line[:-1])
                starts = np.flatnonzero(new)
                stops = np.append(starts[1:], len(begins))
                spans.append((LINE, digests(starts, stops, LINE), starts, stops))
                if passages:
                    starts = anchors_of(digests, np.searchsorted(begins, inner[:-1]))
                    stops = starts + GRAM
                    spans.append((ANCHOR, digests(starts, stops, ANCHOR), starts, stops))
                yield from _batches(part, inner, ids[first:last], spans)

    return _with_text(documents).mapInArrow(run, _UNITS)


def around(documents: DataFrame, anchors: DataFrame, least_words: int) -> DataFrame:
    """All runs of ``least_words`` words that hold one of the anchors (doc_id, place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            places = batch.column("places")
            raw, bounds = bytes_and_bounds(batch.column("text"))
            for first, last in groups(bounds):
                part = raw[bounds[first] : bounds[last]]
                inner = bounds[first : last + 1] - bounds[first]
                begins, ends = word_spans(part, inner)
                if len(begins) < least_words:
                    continue
                first_word = np.append(np.searchsorted(begins, inner[:-1]), len(begins))
                own = places.slice(first, last - first)
                text = np.repeat(np.arange(last - first), own.value_lengths().to_numpy())
                at = own.flatten().to_numpy() + first_word[text]
                chosen = np.zeros(len(begins), bool)
                for back in range(least_words - GRAM + 1):
                    starts = at - back
                    fits = (starts >= first_word[text]) & (starts + least_words <= first_word[text + 1])
                    chosen[starts[fits]] = True
                starts = np.flatnonzero(chosen)
                stops = starts + least_words
                digest = Digests(word_hashes(part, begins, ends))(starts, stops, PASSAGE)
                yield from _batches(part, inner, ids[first:last], [(PASSAGE, digest, starts, stops)])

    wanted = anchors.groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_set("place").alias("places"))
    both = _with_text(documents).join(wanted, F.col("doc_id") == F.col("_doc"))
    return both.select("doc_id", "text", "places").mapInArrow(run, _UNITS)


def _frequent(units: DataFrame) -> list[int]:
    """Digests that have more than a share of a task's rows, ``8 * tasks`` of them at most.

    Told from one row in ``SAMPLED``; which way a unit goes does not change what is found.
    """
    tasks = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = max(FREQUENT, units.count() // SAMPLED // (8 * tasks))
    some = units.filter(F.pmod(F.xxhash64("doc_id", "place"), F.lit(SAMPLED)) == 0)
    found = some.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > least)
    return [row.digest for row in found.orderBy(F.desc("n"), "digest").limit(8 * tasks).collect()]


def _linked(units: DataFrame) -> DataFrame:
    """The units that occur more than once, with ``source``, and whether they come ``later``.

    What overlaps its first occurrence does not come later.  ``units`` is a saved table.
    Its rows are dealt once, by digest.  The few digests that would crowd a task are
    counted within tasks before that, and their rows are dealt one by one.
    """
    # Five small numbers go through the shuffle as two; the place leads, so that it ranks.
    placed = F.shiftleft(F.col("place").cast("long"), 32).bitwiseOR(F.col("begin").cast("long"))
    sized = F.shiftleft(F.col("words").cast("long"), 32).bitwiseOR(
        F.shiftleft(F.col("length").cast("long"), 2)
    ).bitwiseOR(F.col("kind").cast("long"))
    packed = units.select("digest", "doc_id", placed.alias("placed"), sized.alias("sized"))
    # The rank as one number: the minimum is then a hash aggregate that meets map-side.
    rank = F.col("doc_id").cast("decimal(20,0)") * PLACES + F.shiftright("placed", 32)
    busy = packed.filter(F.col("digest").isin(_frequent(units)))
    firsts = busy.groupBy("digest").agg(F.min(rank).alias("rank"), F.count(F.lit(1)).alias("known_n")).select(
        "digest", "known_n", F.struct(
            F.floor(F.col("rank") / PLACES).cast("long").alias("doc_id"),
            F.shiftleft(F.pmod("rank", F.lit(PLACES)).cast("long"), 32).alias("placed"),
        ).alias("known"),
    )
    alone = F.when(F.col("known_n").isNotNull(), F.xxhash64("doc_id", "placed")).alias("alone")
    group = Window.partitionBy("digest", "alone")
    dealt = packed.join(F.broadcast(firsts), "digest", "left").select("*", alone).select(
        "*",
        F.coalesce("known", F.min(F.struct("doc_id", "placed")).over(group)).alias("first"),
        F.coalesce("known_n", F.count(F.lit(1)).over(group)).alias("n"),
    ).filter("n > 1")
    low = F.lit(2**32 - 1)
    found = dealt.select(
        F.col("sized").bitwiseAND(F.lit(3)).cast("byte").alias("kind"),
        "digest",
        "doc_id",
        F.shiftright("placed", 32).cast("int").alias("place"),
        F.shiftright("sized", 32).cast("int").alias("words"),
        F.col("placed").bitwiseAND(low).cast("int").alias("begin"),
        F.shiftright(F.col("sized").bitwiseAND(low), 2).cast("int").alias("length"),
        F.col("first.doc_id").alias("source"),
        F.shiftright("first.placed", 32).cast("int").alias("first_place"),
    )
    later = (F.col("doc_id") > F.col("source")) | (F.col("place") - F.col("first_place") >= F.col("words"))
    return found.withColumn("later", later).drop("first_place")


def _numbered(pieces: DataFrame) -> DataFrame:
    """``run``: a number for pieces of a document that overlap or follow each other."""
    order = Window.partitionBy("doc_id").orderBy("place", "words")
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max(F.col("place") + F.col("words")).over(so_far)
    fresh = F.when(F.col("place") <= reached, 0).otherwise(1)
    return pieces.withColumn("_fresh", fresh).withColumn("run", F.sum("_fresh").over(order)).drop("_fresh")


def repeated_runs(
    documents: DataFrame,
    least_words: int = LEAST_WORDS,
    least_line: int = LEAST_LINE,
    passages: bool = True,
) -> DataFrame:
    """(doc_id, begin, end, words, first_doc_id) of each run or line to remove.

    ``first_doc_id`` is the document that holds its longest piece first, and keeps
    it.  Runs have ``least_words`` or more; a repeated line that is not within one
    is a row of its own.  ``passages`` finds those that units miss, too, given
    ``least_words`` of ``LEAST_WORDS`` or more.  Rows that share a doc_id are one
    document: the same unit at the same place is one occurrence.  Null ids and
    null texts have no units; documents without repeats have no row; an empty
    table gives none.
    """
    folder = new_folder(documents.sparkSession, "units")
    linked = _linked(saved(cut(documents, passages), "units", folder))
    if passages:
        if least_words < GRAM + WINDOW - 1:
            raise ValueError(f"passages have at least {GRAM + WINDOW - 1} words")
        is_anchor = F.col("kind") == ANCHOR
        linked = linked.filter(is_anchor | F.col("later"))
        linked = saved(linked.withColumn("digest", F.when(is_anchor, F.col("digest"))), "linked_units")
        removed(documents.sparkSession, folder)
        anchors = linked.filter(is_anchor)
        edges = _numbered(anchors.filter("later")).groupBy("doc_id", "run").agg(
            F.min_by("digest", "place").alias("left"), F.max_by("digest", "place").alias("right")
        )
        edges = edges.select(F.explode(F.array("left", "right")).alias("digest")).distinct()
        edges = saved(edges, "edges")
        runs = around(documents, anchors.join(edges, "digest", "left_semi"), least_words)
        linked = linked.unionByName(_linked(saved(runs, "runs")))
    end = F.col("begin") + F.col("length")
    piece = F.struct("begin", end.alias("end"), "words", F.col("source").alias("first_doc_id"))
    is_line = (F.col("kind") == LINE) & (F.col("words") >= least_line)
    runs = (
        _numbered(linked.filter("later"))
        .groupBy("doc_id", "run")
        .agg(F.min("begin").alias("begin"), F.max(end).alias("end"),
             (F.max(F.col("place") + F.col("words")) - F.min("place")).alias("words"),
             F.max_by("source", F.col("words").cast("long") * PLACES - F.col("place")).alias("first_doc_id"),
             F.collect_set(F.when(is_line, piece)).alias("lines"))
    )
    whole = F.array(F.struct("begin", "end", "words", "first_doc_id"))
    goes = F.when(F.col("words") >= least_words, whole).otherwise(F.col("lines"))
    return runs.select("doc_id", F.inline(goes)).withColumn("words", F.col("words").cast("long"))


def report(
    documents: DataFrame, least_words: int = LEAST_WORDS, passages: bool = False
) -> DataFrame:
    """(doc_id, n_removed, removed_words, removed_spans, first_docs) of each row.

    ``removed_spans`` joins ``begin:end`` of the runs, in code points of the
    original text, end exclusive.  A document without repeats, a null or empty
    text and a null doc_id have none.  Other columns are not read; an empty
    table gives no rows.  Passages that begin or end within a unit are found only
    with ``passages``.
    """
    by_document = repeated_runs(documents, least_words, passages=passages).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_removed"),
        F.sum("words").alias("removed_words"),
        F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans"),
        F.array_sort(F.collect_set("first_doc_id")).alias("first_docs"),
    )
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"))
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["begin"], s["end"]))
    return rows.join(by_document, "doc_id", "left").select(
        "doc_id",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed_words", F.lit(0)).cast("long").alias("removed_words"),
        F.coalesce(F.array_join(spans, ","), F.lit("")).alias("removed_spans"),
        F.coalesce("first_docs", F.array().cast("array<long>")).alias("first_docs"),
    )


def cleaned(
    documents: DataFrame, least_words: int = LEAST_WORDS, passages: bool = False
) -> DataFrame:
    """All rows and columns, the runs taken out of ``text``, and ``removed`` with their places.

    ``removed`` is an array of (begin, end) in the original text; it takes the
    place of a column of that name.  For ``passages`` see ``report``.
    """
    runs = repeated_runs(documents, least_words, passages=passages).groupBy(F.col("doc_id").alias("_doc")).agg(
        F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("removed")
    )
    own = boxed(documents, "doc_id", "text")
    both = own.join(runs, F.col("doc_id").cast("long") == F.col("_doc"), "left")
    edges = F.transform(
        "removed",
        lambda s, i: F.struct(
            F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("removed"), i - 1)["end"]).alias("from"),
            s["begin"].alias("to"),
        ),
    )
    kept = F.transform(edges, lambda e: F.substring(F.col("text"), e["from"] + 1, e["to"] - e["from"]))
    rest = F.substring(F.col("text"), F.element_at("removed", -1)["end"] + 1, F.lit(2**31 - 1))
    text = F.when(F.size("removed") > 0, F.concat(F.array_join(kept, ""), rest)).otherwise(F.col("text"))
    nothing = F.array().cast("array<struct<begin:int,end:int>>")
    return unboxed(
        both, documents.columns, text=text, removed=F.coalesce("removed", nothing)
    )
