"""Shards by a Feistel permutation with cycle walking over global row numbers.

Rows get their number in a fixed order: by the first three hex digits of the
MD5 of (doc_id, checksum, size), then by these columns.  So there are 4,096
buckets, the window that numbers a bucket's distinct rows sees about a 4,096th
of them, and only bucket counts are gathered to turn places within
buckets into global numbers.  The number is permuted, and

    shard = permuted % shards,    slot = permuted // shards

The permutation works on pairs from ``a`` times ``b``, the smallest such
rectangle with ``a = ceil(sqrt(rows))`` that holds all numbers.  A result beyond
the last row is permuted again until it is a row number (cycle walking).
``row_at`` inverts it: which row number stands in a given shard and slot.

Only column functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.tables import copies, saved

#: Keys of the rounds, two for each double round.
ROUND_KEYS = ((915_374_021, 370_248_451), (1_503_267_887, 88_172_645), (643_180_247, 1_271_349_083))
FIRST_FACTOR, SECOND_FACTOR, MASK, DROP = 1_103_515_245, 739_982_445, 2**31 - 1, 9
#: Fewer than ``a`` numbers of the rectangle are no rows, so at most that many
#: steps in a row can fail; beyond 256 rows the chance that 16 do is below 1e-16.
STEPS = 16


def _round(x: Column, key: Column) -> Column:
    mask = F.lit(MASK)
    first = (x.bitwiseAND(mask) * FIRST_FACTOR + key).bitwiseAND(mask)
    return F.shiftright(first * SECOND_FACTOR, DROP).bitwiseAND(mask)


def _rounds(seed: int, backwards: bool = False) -> Column:
    keys = [[(k + 7_919 * seed) % MASK for k in pair] for pair in ROUND_KEYS]
    keys = [pair[::-1] for pair in keys[::-1]] if backwards else keys
    return F.array(*[F.struct(F.lit(x).cast("long").alias("x"), F.lit(y).cast("long").alias("y"))
                     for x, y in keys])


def _pass(number: Column, a: Column, b: Column, seed: int, backwards: bool) -> Column:
    start = F.struct(F.floor(number / b).cast("long").alias("l"), F.pmod(number, b).alias("r"))

    def there(pair: Column, key: Column) -> Column:
        left = F.pmod(pair["l"] + _round(pair["r"], key["x"]), a)
        return F.struct(left.alias("l"), F.pmod(pair["r"] + _round(left, key["y"]), b).alias("r"))

    def back(pair: Column, key: Column) -> Column:
        right = F.pmod(pair["r"] - _round(pair["l"], key["x"]), b)
        return F.struct(F.pmod(pair["l"] - _round(right, key["y"]), a).alias("l"), right.alias("r"))

    return F.aggregate(
        _rounds(seed, backwards), start, back if backwards else there, lambda p: p["l"] * b + p["r"]
    )


def permuted(number: Column, rows: Column, seed: int = 0, backwards: bool = False) -> Column:
    """The number (0 to rows - 1) under the permutation, or under its inverse."""
    a = F.ceil(F.sqrt(rows)).cast("long")
    b = F.ceil(rows / a).cast("long")
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS)),
        _pass(number, a, b, seed, backwards),
        lambda at, _: F.when(at < rows, at).otherwise(_pass(at, a, b, seed, backwards)),
    )
    return F.when(walked < rows, walked).otherwise(
        F.raise_error(F.lit("the walk did not return to a row number"))
    )


def numbered(documents: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, row_number, n_rows) of each row of (doc_id, text).

    Rows that agree in these columns are one row with a count until they have their
    numbers, so the windows see no row twice.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
    )
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("doc_id", "text_crc32", "size")]
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    groups = saved(counted.withColumn("bucket", F.substring(digest, 1, 3)), "shard_rows")
    every = Window.orderBy("bucket")
    counts = groups.groupBy("bucket").agg(F.sum("n").alias("rows"))
    # 4,096 rows at most, of a few bytes.
    offsets = counts.select(
        "bucket",
        (F.sum("rows").over(every) - F.col("rows")).alias("before"),
        F.sum("rows").over(Window.partitionBy()).alias("n_rows"),
    )
    order = Window.partitionBy("bucket").orderBy("doc_id", "text_crc32", "size")
    return copies(
        groups.withColumn("first", F.sum("n").over(order) - F.col("n"))
        .join(F.broadcast(offsets), "bucket")
        .select("doc_id", "size", "text_crc32", "n",
                (F.col("before") + F.col("first")).alias("first"), "n_rows"),
        "n",
    ).select("doc_id", "size", "text_crc32", (F.col("first") + F.col("copy")).alias("row_number"), "n_rows")


def sharded(documents: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number) of each row.

    The law is ``rows``: the numbers of rows in any two shards differ by one at
    most, and slots run from 0 without a gap.  ``size`` is the text's UTF-8 bytes
    and 16; a null text counts as empty.  Rows with equal columns are
    interchangeable; null ids are numbered as any other; an empty table gives no
    rows.  Other columns are not read.
    """
    at = permuted(F.col("row_number"), F.col("n_rows"), seed)
    return numbered(documents).withColumn("at", at).select(
        "doc_id", "size", "text_crc32",
        F.lit("rows").alias("law"),
        F.pmod(F.col("at"), F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("at") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )


def row_at(shard: Column, slot: Column, rows: Column, shards: int, seed: int = 0) -> Column:
    """The row number that ``sharded`` puts there."""
    return permuted(slot.cast("long") * shards + shard, rows, seed, backwards=True)


def sharded_sql(shards: int, seed: int = 0) -> str:
    """The same rows as DuckDB SQL over ``documents``."""

    def mixed(x: str, key: int) -> str:
        key = (key + 7_919 * seed) % MASK
        first = f"((({x}) & {MASK}) * {FIRST_FACTOR} + {key}) & {MASK}"
        return f"(((({first}) * {SECOND_FACTOR}) >> {DROP}) & {MASK})"

    steps, left, right = [], "l0", "r0"
    for k, (x, y) in enumerate(ROUND_KEYS, 1):
        steps.append(f"({left} + {mixed(right, x)}) % a AS l{k}")
        left = f"l{k}"
        steps.append(f"({right} + {mixed(left, y)}) % b AS r{k}")
        right = f"r{k}"
    one_pass = f"x // b AS l0, x % b AS r0, {', '.join(steps)}, {left} * b + {right} AS y"
    return f"""
        WITH RECURSIVE crc_table AS (
          SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k:
                   CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                 ORDER BY i) AS entries
          FROM range(256) AS t(i)
        ), raw AS (
          SELECT doc_id, text, coalesce(hex(encode(text)), '') AS hexed FROM documents
        ), sized AS (
          SELECT doc_id, len(hexed) // 2 + 16 AS size,
                 xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
                     range(1, len(hexed), 2), lambda i: ('0x' || hexed[i:i + 1])::BIGINT)),
                   lambda c, v: xor(entries[(xor(c, v) & 255) + 1], c >> 8)), 4294967295) AS text_crc32
          FROM raw, crc_table
        ), numbered AS (
          SELECT *, count(*) OVER () AS n,
                 row_number() OVER (ORDER BY left(md5(coalesce(doc_id::VARCHAR, '-') || '|'
                   || text_crc32 || '|' || size), 3), doc_id NULLS FIRST, text_crc32, size) - 1
                   AS row_number
          FROM sized
        ), sides AS (
          SELECT *, ceil(sqrt(n))::BIGINT AS a, ceil(n / ceil(sqrt(n)))::BIGINT AS b FROM numbered
        ), walk AS (
          SELECT row_number, n, a, b, y FROM (SELECT *, row_number AS x, {one_pass} FROM sides)
          UNION ALL
          SELECT row_number, n, a, b, y FROM (
            SELECT row_number, n, a, b, x, {one_pass}
            FROM (SELECT row_number, n, a, b, y AS x FROM walk WHERE y >= n))
        )
        SELECT doc_id, size, text_crc32, 'rows' AS law, (y % {shards})::INT AS shard,
               y // {shards} AS slot, NULL::INT AS grown_shard, row_number
        FROM sides JOIN (SELECT row_number, y FROM walk WHERE y < n) USING (row_number)"""
