"""Near-duplicate vectors by Euclidean p-stable hashing.

A table hashes a unit vector ``v`` to ``floor((a . v + b) / width)`` for
``HASHES`` Gaussian directions ``a`` at once.  Unit vectors of cosine 0.98 are
0.2 apart; with a width of 1.2 they agree on one hash with probability 0.87 and
meet in at least one of 40 tables of 10 hashes with probability 0.99998.
Unrelated ones agree on one hash with probability 0.32.  Tables with more
hashes, and more tables, keep buckets small for more vectors per label.

Only (bucket, id) pairs are shuffled at first.  Buckets of one vector fall out,
and vectors travel to the others.  A bucket of more than ``BLOCK`` vectors is
cut into blocks; each pair of blocks is a task's work of its own.  A pair is
counted in the first table in which it meets, so nothing has to be made unique
afterwards, and what leaves a block is a count per vector and a forest of links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.components import Forest, components
from sensorloom.llm.hashed_text import mix
from sensorloom.llm.tables import saved
from sensorloom.llm.vectors import matrix, unit, usable

BLOCK = 256


@dataclass(frozen=True)
class Tables:
    tables: int = 40
    hashes: int = 10
    width: float = 1.2
    seed: int = 7

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """64-bit keys of unit vectors, one column per table."""
        draw = np.random.default_rng([self.seed, vectors.shape[1]])
        directions = draw.standard_normal((vectors.shape[1], self.tables * self.hashes))
        shifts = draw.uniform(0, self.width, self.tables * self.hashes)
        cells = np.floor((vectors @ directions + shifts) / self.width).astype(np.int64)
        cells = cells.view(np.uint64).reshape(len(vectors), self.tables, self.hashes)
        keys = np.broadcast_to(mix(np.arange(1, self.tables + 1, dtype=np.uint64)), cells.shape[:2])
        for level in range(self.hashes):
            keys = mix(keys + cells[:, :, level])
        return keys.view(np.int64)


def near_duplicate_vectors(
    embeddings: DataFrame, cosine: float = 0.98, tables: Tables | None = None
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of (vec_id, embedding, label).

    Links are pairs of equal, non-null label and a cosine of at least ``cosine``
    in double precision.  Null, empty and zero vectors, and such with null or
    non-finite components, link with nothing, and neither do vectors of
    different length.  Equal vectors are one class and count as links of each
    other.  Rows that share a vec_id and a vector count each; a null vec_id
    links with nothing, has a null component and is kept.  Other columns are not
    read; an empty table gives no rows.
    """
    tables = tables or Tables()
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label"),
        F.col("embedding"),
    )
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding"))
    # The text of a number says exactly which one it is.
    text = F.array_join(F.transform("embedding", lambda x: x.cast("string")), ",")
    key = F.md5(F.concat_ws("|", F.col("label").cast("string"), text).cast("binary"))
    rows = rows.withColumn("vector_key", F.when(fit, key))
    keyed = saved(rows.select("vec_id", "vector_key"), "vector_keys")
    classes = keyed.filter("vector_key IS NOT NULL").groupBy("vector_key").agg(
        F.min("vec_id").alias("class_id"), F.count(F.lit(1)).alias("copies")
    )
    firsts = rows.join(
        classes.withColumnRenamed("class_id", "vec_id"), ["vec_id", "vector_key"]
    )
    vectors = saved(
        firsts.groupBy("vec_id", "label", "copies", "vector_key").agg(
            F.first("embedding").alias("embedding")
        ).select(
            F.col("vec_id").alias("class_id"),
            F.xxhash64("label", F.size("embedding")).alias("space"), "copies", "embedding",
        ),
        "vectors",
    )
    found = saved(_links(vectors, cosine, tables), "vector_links")
    linked = found.filter("a <> b").select("a", "b")
    counts = found.groupBy(F.col("a").alias("class_id")).agg(F.sum("n").alias("n"))
    of_class = (
        classes.join(counts, "class_id", "left")
        .join(components(linked).withColumnRenamed("node", "class_id"), "class_id", "left")
        .select(
            "vector_key",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "class_id").alias("component"),
        )
    )
    result = keyed.join(of_class, "vector_key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
    )
    return result.withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )


def _links(vectors: DataFrame, cosine: float, tables: Tables) -> DataFrame:
    """(a, b, n): a forest of links with n = 0, and links n of a with b = a."""
    placed = vectors.select("class_id", "space", "embedding").mapInArrow(
        _place(tables), "class_id long, bucket long"
    )
    shared = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    inside = placed.join(shared, "bucket").select(
        "class_id", "bucket", blocks.alias("blocks"),
        F.pmod(F.xxhash64("class_id"), blocks).cast("int").alias("block"),
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiled = inside.withColumn("other", other).select(
        "class_id", "bucket", "block",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    )
    tile = ["bucket", "low", "high"]
    return (
        tiled.join(vectors, "class_id")
        .repartition(*tile)
        .sortWithinPartitions(*tile)
        .mapInArrow(_compare(cosine, tables), "a long, b long, n long")
    )


def _place(tables: Tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("embedding").value_lengths().to_numpy()
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                part = batch.take(pa.array(rows))
                keys = tables.keys(unit(matrix(part.column("embedding"))))
                space = part.column("space").to_numpy().view(np.uint64)
                buckets = mix(keys.view(np.uint64) ^ mix(space)[:, None]).view(np.int64)
                ids = np.repeat(part.column("class_id").to_numpy(), tables.tables)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(buckets.ravel())], names=["class_id", "bucket"]
                )

    return run


def _whole_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that hold each tile as a whole, from rows in the order of tiles."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        starts = np.flatnonzero(_changes(table))
        yield table.slice(0, int(starts[-1]))
        rest = table.slice(int(starts[-1]))
    if rest is not None:
        yield rest


def _changes(table: pa.Table) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for name in ("bucket", "low", "high"):
        values = table.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return new


def _compare(cosine: float, tables: Tables):
    """Compare all rows of each tile; rows of one block only where the tile is of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_tiles(batches):
            if not table.num_rows:
                continue
            lengths = table.column("embedding").combine_chunks().value_lengths().to_numpy()
            for length in np.unique(lengths):
                part = table.take(pa.array(np.flatnonzero(lengths == length)))
                yield from _compare_tiles(part, cosine, tables).to_batches()

    return run


def _compare_tiles(table: pa.Table, cosine: float, tables: Tables) -> pa.Table:
    tile = np.cumsum(_changes(table))
    block, low, high = (table.column(n).to_numpy() for n in ("block", "low", "high"))
    ids, copies = table.column("class_id").to_numpy(), table.column("copies").to_numpy()
    bucket = table.column("bucket").to_numpy()
    space = mix(table.column("space").to_numpy().view(np.uint64))
    vectors = unit(matrix(table.column("embedding")))
    links = np.zeros(len(ids), np.int64)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for step in range(1, int(np.bincount(tile).max())):
        x = np.flatnonzero(tile[step:] == tile[:-step])
        y = x + step
        apart = (low[x] == high[x]) | (block[x] != block[y])
        x, y = x[apart], y[apart]
        near = np.einsum("ij,ij->i", vectors[x], vectors[y]) >= cosine
        if near.any():
            pairs.append((x[near], y[near]))
    if not pairs:
        return _rows([], [], [])
    x, y = (np.concatenate(side) for side in zip(*pairs, strict=True))
    keep = np.empty(len(x), bool)
    for at in range(0, len(x), 50_000):
        i, j = x[at : at + 50_000], y[at : at + 50_000]
        own, inverse = np.unique(np.concatenate((i, j)), return_inverse=True)
        keys = tables.keys(vectors[own])
        left, right = keys[inverse[: len(i)]], keys[inverse[len(i) :]]
        first = (left == right).argmax(axis=1)
        met = left[np.arange(len(i)), first].view(np.uint64)
        keep[at : at + 50_000] = mix(met ^ space[i]).view(np.int64) == bucket[i]
    x, y = x[keep], y[keep]
    np.add.at(links, x, copies[y])
    np.add.at(links, y, copies[x])
    forest, seen = Forest(len(ids)), {}
    for row, class_id in enumerate(ids.tolist()):
        forest.join(seen.setdefault(class_id, row), row)
    forest.joined.clear()
    for i, j in zip(x.tolist(), y.tolist(), strict=True):
        forest.join(i, j)
    ends = forest.pairs_of(ids)
    counted = np.flatnonzero(links)
    own, inverse = np.unique(ids[counted], return_inverse=True)
    sums = np.bincount(inverse, links[counted], len(own)).astype(np.int64)
    return _rows(
        [a for a, _ in ends] + own.tolist(),
        [b for _, b in ends] + own.tolist(),
        [0] * len(ends) + sums.tolist(),
    )


def _rows(a: list[int], b: list[int], n: list[int]) -> pa.Table:
    return pa.table({k: pa.array(v, pa.int64()) for k, v in (("a", a), ("b", b), ("n", n))})


def near_duplicate_vectors_sql(cosine: float = 0.98) -> str:
    """The same rows as DuckDB SQL over ``embeddings``, by comparing all pairs of a label."""
    return f"""
        WITH RECURSIVE fit AS (
          SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
          WHERE vec_id IS NOT NULL AND label IS NOT NULL
            AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
            AND list_bool_or([x <> 0 FOR x IN embedding])
        ), links AS MATERIALIZED (
          SELECT x.vec_id AS a, y.vec_id AS b
          FROM fit x JOIN fit y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
          WHERE list_cosine_similarity(x.v, y.v) >= {cosine}
        ), reach AS (
          SELECT vec_id AS a, vec_id AS b FROM embeddings
          UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
        ), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
        SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.a = e.vec_id) AS n_links, component_id,
               coalesce(e.vec_id = component_id, true) AS kept
        FROM embeddings e LEFT JOIN least ON least.a = e.vec_id"""
