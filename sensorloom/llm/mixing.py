"""Mixing sources to target weights by Sainte-Lague apportionment.

1. Every source has a target in words: its share of all words by weight, at most
   ``most`` times its own size, the excess reshared by weight.
2. Blocks of equal length are dealt to sources by highest quotients
   ``target / (2 k + 1)``, so each gets an integer number.
3. A source's documents are dealt by hash to shards of bounded size, and the
   source's quota to its shards by the same rule, in two levels.
4. Within a shard the documents stand in seeded order, end to end, and are cut
   into blocks of equal length.  A quota of ``q`` of ``n`` blocks takes all
   ``q // n`` times, and ``q % n`` once more, from a seeded block onwards.

Only column functions are used.  Windows span a shard's distinct rows, a few
thousand shards, or the sources; the number of sources is taken to fit one task
(it is the number of distinct names, not of rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.tables import boxed, copies, saved, unboxed

SHARD_WORDS = 1 << 18
BLOCK_WORDS = 32
#: Shards that one window of step 3 spans at most, for sources of up to its square.
FAN_OUT = 4096
WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"
_GAP_AND_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"


def sainte_lague(items: DataFrame, within: list[str], votes: str, seats: str, name: str) -> DataFrame:
    """Deal each group's ``seats`` to its items by the highest ``votes / (2 k + 1)``.

    ``items`` has distinct rows with positive votes; ties go by the other
    columns in order.  Only quotients near an item's share are looked at: dealing
    starts from the rounded shares, and the bound on how far the result may lie
    from them follows from the number of items and of seats left over.
    """
    columns = items.columns
    group = Window.partitionBy(*within)
    share = F.col(votes) / F.sum(votes).over(group)
    rounded = items.withColumn("_share", share).withColumn(
        "_rounded", F.floor(F.col("_share") * F.col(seats) + 0.5).cast("long")
    )
    slack = F.abs(F.col(seats) - F.sum("_rounded").over(group)) + F.count(F.lit(1)).over(group)
    near = rounded.withColumn(
        "_reach", (F.ceil(slack * F.col("_share")) + 1).cast("long")
    ).withColumn("_sure", F.greatest(F.col("_rounded") - F.col("_reach"), F.lit(0)))
    asked = near.withColumn(
        "_open", F.col(seats) - F.sum("_sure").over(group)
    ).withColumn(
        "_k", F.explode(F.sequence(F.col("_sure"), F.col("_rounded") + F.col("_reach")))
    )
    order = group.orderBy((F.col(votes) / (2 * F.col("_k") + 1)).desc(), *columns, "_k")
    won = F.row_number().over(order) <= F.col("_open")
    return (
        asked.withColumn("_won", won)
        .groupBy(*columns, "_sure")
        .agg(F.count_if("_won").alias("_more"))
        .select(*columns, (F.col("_sure") + F.col("_more")).alias(name))
    )


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, where null equals null; the keys come from the left."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    return left.join(renamed, same, how).drop(*[f"_right_{key}" for key in keys])


def targets(sources: DataFrame, most: int, weights: tuple[int, ...]) -> DataFrame:
    """(source, source_size) with the target of each source.

    Sources are weighed by turns in the order of code points, null last.  Those
    at their limit are the first ones by ``limit / weight``; the others share
    what is left by weight.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int") + 1)
    weighed = sources.withColumn("weight", weight).withColumn(
        "limit", F.lit(most) * F.col("source_size")
    )
    before = Window.orderBy(
        F.col("limit") / F.col("weight"), F.col("source").isNull(), "source"
    ).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    sharing = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    leveled = weighed.withColumn("level", left / sharing)
    fits = F.col("level") * F.col("weight") <= F.col("limit")
    level = F.min(F.when(fits, F.struct(F.col("limit") / F.col("weight"), "level"))).over(everything)
    return leveled.withColumn("level", level["level"]).select(
        "source",
        "source_size",
        F.least(F.col("limit").cast("double"), F.col("level") * F.col("weight")).alias("target"),
    )


def sizes(documents: DataFrame, seed: int) -> DataFrame:
    """(doc_id, source, size, digest): words of each text, and a seeded digest of the row."""
    count = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("doc_id", "size")]
    return documents.select("doc_id", "source", count.alias("size")).withColumn(
        "digest", F.md5(F.concat_ws("|", *parts, F.lit(str(seed))).cast("binary"))
    )


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def plan(
    documents: DataFrame,
    most: int = 3,
    weights: tuple[int, ...] = WEIGHTS,
    seed: int = 1,
    shard_words: int = SHARD_WORDS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """How much of each row of (doc_id, text, source) the mix takes.

    Returns doc_id, source, size, source_size, target, taken, and what is taken:
    ``copies`` of the whole text and the words of two ranges (``from_1`` to
    before ``to_1``, ``from_2`` to before ``to_2``) once more.  Each document is
    taken ``most`` times at most.  Rows without words have size and taken 0; a
    null source is a source of its own, the last; rows that repeat count each
    and may be exchanged; an empty table gives no rows.  Equal input gives equal
    results, however it is partitioned.
    """
    # Rows that agree in these columns are one row with a count until the last step.
    same = sizes(documents, seed).groupBy("doc_id", "source", "size", "digest")
    sized = saved(same.agg(F.count(F.lit(1)).alias("rows")), "mix_sizes")
    words = F.sum(F.col("size") * F.col("rows"))
    by_source = targets(sized.groupBy("source").agg(words.alias("source_size")), most, weights)
    sources = saved(
        by_source.withColumn(
            "shards", F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1))
        ),
        "mix_sources",
    )
    placed = _joined(sized, sources, ["source"]).select(
        "doc_id", "source", "size", "digest", "source_size", "target", "rows",
        F.pmod(_number(F.col("digest")), F.col("shards")).alias("shard"),
    )
    shards = _quotas(placed, sources, most, seed, block_words)
    order = Window.partitionBy("source", "shard").orderBy("digest", "doc_id", "size")
    before = F.col("size") * F.col("rows")
    # Rows without words take no place, so they stay out of the windows.
    starts = placed.filter("size > 0").withColumn(
        "start", F.sum(before).over(order.rowsBetween(Window.unboundedPreceding, 0)) - before
    )
    empty = placed.filter("size = 0").withColumn("start", F.lit(0).cast("long"))
    every = copies(starts.unionByName(empty), "rows")
    found = _joined(every, shards, ["source", "shard"], "left")
    begin = F.col("start") + F.col("copy") * F.col("size")

    def within(edge: str) -> Column:
        inside = F.least(F.greatest(F.col(edge) - begin, F.lit(0)), F.col("size"))
        return F.coalesce(inside, F.lit(0)).cast("long")

    ranged = found.select(
        "doc_id", "source", "size", "source_size", "target", "digest",
        F.coalesce("copies", F.lit(0)).cast("long").alias("copies"),
        within("low_1").alias("from_1"), within("high_1").alias("to_1"),
        within("low_2").alias("from_2"), within("high_2").alias("to_2"),
    )
    part = F.col("to_1") - F.col("from_1") + F.col("to_2") - F.col("from_2")
    return ranged.withColumn("part", part).withColumn(
        "taken", F.col("copies") * F.col("size") + F.col("part")
    )


def _quotas(placed: DataFrame, sources: DataFrame, most: int, seed: int, block_words: int) -> DataFrame:
    """What each shard gives: all of it ``copies`` times, and two ranges of its words."""
    shards = saved(
        placed.filter("size > 0")
        .groupBy("source", "shard")
        .agg(F.sum(F.col("size") * F.col("rows")).alias("words"))
        .withColumn("blocks", F.greatest(F.round(F.col("words") / block_words), F.lit(1)).cast("long"))
        .withColumn("family", F.floor(F.col("shard") / FAN_OUT).cast("long")),
        "mix_shards",
    )
    blocks = shards.groupBy("source").agg(F.sum("blocks").alias("own_blocks"))
    asked = sources.filter("target > 0").select(
        "source", "source_size", "target",
        F.round(F.sum("source_size").over(Window.partitionBy()) / block_words)
        .cast("long").alias("all_blocks"),
        F.lit(0).alias("all"),
    )
    dealt = sainte_lague(asked, ["all"], "target", "all_blocks", "dealt")
    # Blocks of the mix, in blocks of the source, which may be a little longer or shorter.
    source_seats = _joined(dealt, blocks, ["source"]).select(
        "source",
        F.least(
            F.round(F.col("dealt") * block_words * F.col("own_blocks") / F.col("source_size")),
            most * F.col("own_blocks"),
        ).cast("long").alias("seats"),
    )
    families = shards.groupBy("source", "family").agg(F.sum("blocks").alias("blocks"))
    family_seats = sainte_lague(
        _joined(families, source_seats, ["source"]), ["source"], "blocks", "seats", "quota"
    ).select("source", "family", F.col("quota").alias("seats"))
    quotas = sainte_lague(
        _joined(shards, family_seats, ["source", "family"]),
        ["source", "family"], "blocks", "seats", "quota",
    ).withColumn("quota", F.least("quota", most * F.col("blocks")))
    extra = F.pmod(F.col("quota"), F.col("blocks"))
    name = F.concat_ws("|", F.coalesce("source", F.lit("-")), "shard", F.lit(str(seed)))
    first = F.pmod(_number(F.md5(name.cast("binary"))), F.col("blocks"))

    def edge(block: Column) -> Column:
        return F.floor(block * F.col("words") / F.col("blocks")).cast("long")

    last = F.col("first") + F.col("extra")
    return quotas.withColumns({"extra": extra, "first": first}).select(
        "source", "shard",
        F.floor(F.col("quota") / F.col("blocks")).cast("long").alias("copies"),
        edge(F.col("first")).alias("low_1"),
        edge(F.least(last, F.col("blocks"))).alias("high_1"),
        F.lit(0).cast("long").alias("low_2"),
        edge(F.greatest(last - F.col("blocks"), F.lit(0))).alias("high_2"),
    )


def mixed(documents: DataFrame, **options) -> DataFrame:
    """The rows of the mix: each document as often as the plan takes it, with all columns.

    Where the plan takes a part of a text once more, that row has the part only,
    with the white space before its words.  Documents of which nothing is taken
    are left out, texts without words with them.
    """
    planned = plan(documents, **options)
    same = Window.partitionBy("doc_id", "source", "_size")
    count = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    own = boxed(documents, "doc_id", "source", "text")
    texts = own.withColumn("_size", count).withColumn(
        "_nth", F.row_number().over(same.orderBy("text"))
    )
    plans = planned.filter("taken > 0").select(
        F.col("doc_id").alias("_doc"), F.col("source").alias("_source"), F.col("size").alias("_words"),
        "copies", "from_1", "to_1", "from_2", "to_2", "part",
    )
    again = Window.partitionBy("_doc", "_source", "_words").orderBy("copies", "part", "from_1")
    plans = plans.withColumn("_place", F.row_number().over(again)).select(
        "_doc", "_source", "_words", "_place",
        *[F.col(c).alias(f"_{c}") for c in ("copies", "from_1", "to_1", "from_2", "to_2", "part")],
    )
    both = texts.join(
        plans,
        texts["doc_id"].eqNullSafe(plans["_doc"])
        & texts["source"].eqNullSafe(plans["_source"])
        & (texts["_size"] == plans["_words"])
        & (texts["_nth"] == plans["_place"]),
    )
    rows = F.col("_copies") + (F.col("_part") > 0).cast("long")
    words = F.regexp_extract_all(F.col("text"), F.lit(_GAP_AND_WORD), F.lit(0))

    def piece(n: int) -> Column:
        low, high = F.col(f"_from_{n}").cast("int"), F.col(f"_to_{n}").cast("int")
        return F.array_join(F.slice(words, low + 1, high - low), "")

    cut = (F.col("_copy") > F.col("_copies")) & (F.col("_part") < F.col("_size"))
    text = F.when(cut, F.concat(piece(2), piece(1))).otherwise(F.col("text"))
    copied = both.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), rows)))
    return unboxed(copied, documents.columns, text=text)


def _sainte_lague_sql(name: str, items: str, columns: str, within: str, votes: str, seats: str) -> str:
    """CTEs for ``sainte_lague``; the last one, ``name``, has the columns and ``quota``."""
    order = ", ".join(f"{column} NULLS FIRST" for column in columns.split(", "))
    group = f"(PARTITION BY {within})"
    return f"""
        {name}_1 AS (SELECT *, {votes} / sum({votes}) OVER {group} AS share FROM {items}),
        {name}_2 AS (SELECT *, floor(share * {seats} + 0.5)::BIGINT AS rounded FROM {name}_1),
        {name}_3 AS (SELECT *, (ceil((abs({seats} - sum(rounded) OVER {group})
                       + count(*) OVER {group}) * share) + 1)::BIGINT AS reach FROM {name}_2),
        {name}_4 AS (SELECT *, greatest(rounded - reach, 0) AS sure FROM {name}_3),
        {name}_5 AS (SELECT *, {seats} - sum(sure) OVER {group} AS vacant,
                       unnest(range(sure, rounded + reach + 1)) AS k FROM {name}_4),
        {name}_6 AS (SELECT *, row_number() OVER (PARTITION BY {within}
                       ORDER BY {votes} / (2 * k + 1) DESC, {order}, k) <= vacant AS won FROM {name}_5),
        {name} AS (SELECT {columns}, (any_value(sure) + count(*) FILTER (won))::BIGINT AS quota
                   FROM {name}_6 GROUP BY {columns})"""


def plan_sql(
    most: int = 3,
    weights: tuple[int, ...] = WEIGHTS,
    seed: int = 1,
    shard_words: int = SHARD_WORDS,
    block_words: int = BLOCK_WORDS,
) -> str:
    """doc_id, size, source_size, target and taken of ``plan``, as DuckDB SQL over ``documents``."""
    weight = ", ".join(map(str, weights))
    return f"""
        WITH sized AS (
          SELECT doc_id, source, size,
                 md5(coalesce(doc_id::VARCHAR, '-') || '|' || size || '|{seed}') AS digest
          FROM (SELECT doc_id, source,
                       coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS size FROM documents)
        ), weighed AS (
          SELECT source, sum(size)::BIGINT AS source_size, {most} * sum(size)::BIGINT AS most_words,
                 [{weight}][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(weights)} + 1]
                   ::DOUBLE AS weight
          FROM sized GROUP BY source
        ), leveled AS (
          SELECT *, (sum(source_size) OVER () - coalesce(sum(most_words) OVER before, 0))::DOUBLE
                    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS own_level
          FROM weighed WINDOW before AS (ORDER BY most_words / weight, source IS NULL, source
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), sources AS (
          SELECT source, source_size, least(most_words::DOUBLE, weight * (
                   SELECT arg_min(own_level, most_words / weight) FROM leveled
                   WHERE own_level * weight <= most_words)) AS target,
                 greatest(ceil(source_size / {shard_words}), 1)::BIGINT AS shards,
                 round(sum(source_size) OVER () / {block_words})::BIGINT AS all_blocks, 0 AS every
          FROM leveled
        ), placed AS (
          SELECT sized.*, source_size, target, ('0x' || left(digest, 8))::BIGINT % shards AS shard
          FROM sized JOIN sources ON sized.source IS NOT DISTINCT FROM sources.source
        ), shards AS (
          SELECT source, shard, sum(size)::BIGINT AS words,
                 greatest(round(sum(size) / {block_words}), 1)::BIGINT AS blocks,
                 shard // {FAN_OUT} AS family
          FROM placed WHERE size > 0 GROUP BY source, shard
        ), asked AS (SELECT * FROM sources WHERE target > 0),
        {_sainte_lague_sql("dealt", "asked", "source, source_size", "every", "target", "all_blocks")},
        source_seats AS (
          SELECT d.source, least(round(d.quota * {block_words} * own / d.source_size),
                                 {most} * own)::BIGINT AS seats
          FROM dealt d JOIN (SELECT source, sum(blocks) AS own FROM shards GROUP BY source) b
            ON d.source IS NOT DISTINCT FROM b.source
        ), families AS (
          SELECT f.*, seats FROM (SELECT source, family, sum(blocks)::BIGINT AS blocks FROM shards
                                  GROUP BY source, family) f
          JOIN source_seats s ON f.source IS NOT DISTINCT FROM s.source
        ),
        {_sainte_lague_sql("by_family", "families", "source, family", "source", "blocks", "seats")},
        asking AS (
          SELECT s.*, f.quota AS seats FROM shards s
          JOIN by_family f ON s.source IS NOT DISTINCT FROM f.source AND s.family = f.family
        ),
        {_sainte_lague_sql("by_shard", "asking", "source, shard, words, blocks", "source, family",
                           "blocks", "seats")},
        given AS (
          SELECT source, shard, words, blocks, least(quota, {most} * blocks) AS quota,
                 ('0x' || left(md5(coalesce(source, '-') || '|' || shard || '|{seed}'), 8))::BIGINT
                   % blocks AS first
          FROM by_shard
        ), edges AS (
          SELECT source, shard, quota // blocks AS copies, first * words // blocks AS low,
                 least(first + quota % blocks, blocks) * words // blocks AS high,
                 greatest(first + quota % blocks - blocks, 0) * words // blocks AS wrapped
          FROM given
        ), ends AS (
          SELECT *, sum(size) OVER (PARTITION BY source, shard ORDER BY digest, doc_id NULLS FIRST, size
                                    ROWS UNBOUNDED PRECEDING)::BIGINT AS stop
          FROM placed
        )
        SELECT doc_id, size, source_size, target,
               coalesce(copies * size
                 + greatest(least(high, stop) - greatest(low, stop - size), 0)
                 + greatest(least(wrapped, stop) - (stop - size), 0), 0)::BIGINT AS taken
        FROM ends LEFT JOIN edges
          ON ends.source IS NOT DISTINCT FROM edges.source AND ends.shard = edges.shard"""
