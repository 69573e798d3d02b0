"""Nearest neighbours by randomly rotated one-bit codes.

The index turns each vector, less the mean of all, by ``ROTATIONS`` random
rotations and keeps of each the signs as packed bits and the correction
``<o, code>``, and the vector's length.  A query's inner product with ``o`` is
estimated as the mean of ``<q, code> / <o, code>``; the error stays within
``BOUND`` standard deviations, of which a single rotation has
``sqrt(1 / <o, code>**2 - 1) / sqrt(dimensions - 1)``.  Vectors are reranked with
the originals in the order of the lower bounds of their distances, until that
bound exceeds the tenth best distance so far.

Queries are compared with all rows in tiles: a block of ``QUERIES`` queries and
a block of ``ROWS`` rows.  Each tile returns its nearest few per query, and the
nearest of these are taken in the end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.tables import saved
from sensorloom.llm.vectors import matrix, usable

ROWS, QUERIES = 2048, 8192
BOUND = 3.0
ROTATIONS = 4
SEED = 11
RERANKED_AT_ONCE = 32

_INDEX = "vec_id long, embedding {kind}, code binary, length double, corrections array<double>"
_FOUND = "query_id long, vec_id long, score double"


def rotations(dimensions: int) -> np.ndarray:
    """``ROTATIONS`` random rotations, always the same ones, one after the other."""
    draws = np.random.default_rng([SEED, dimensions]).standard_normal(
        (ROTATIONS, dimensions, dimensions)
    )
    return np.stack([q * np.sign(np.diag(r)) for q, r in map(np.linalg.qr, draws)])


def encode(rows: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, lengths and corrections (a column per rotation) of the rows less the mean."""
    centred = rows - mean
    lengths = np.sqrt(np.einsum("ij,ij->i", centred, centred))
    codes, corrections = [], []
    for turn in rotations(rows.shape[1]):
        turned = centred @ turn
        sums = np.abs(turned).sum(axis=1) / math.sqrt(rows.shape[1])
        corrections.append(np.divide(sums, lengths, out=np.ones(len(rows)), where=lengths > 0))
        codes.append(np.packbits(turned >= 0, axis=1))
    return np.concatenate(codes, axis=1), lengths, np.stack(corrections, axis=1)


class Codes:
    """The codes of a block of rows, ready to be compared with queries."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, corrections: np.ndarray, dimensions: int):
        self.lengths, self.turns = lengths, rotations(dimensions)
        signs = np.unpackbits(codes.reshape(len(codes), ROTATIONS, -1), axis=2, count=dimensions)
        scale = math.sqrt(dimensions) * ROTATIONS * corrections[:, :, None]
        self.signs = ((signs.astype(np.float64) * 2 - 1) / scale).reshape(len(codes), -1)
        variance = np.maximum(1 / corrections**2 - 1, 0).sum(axis=1) / max(dimensions - 1, 1)
        self.spread = np.sqrt(variance) / ROTATIONS

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated squared distances, queries by rows, and how much less they may be.

        The queries are given less the mean, as the codes are.
        """
        turned = np.concatenate([queries @ turn for turn in self.turns], axis=1)
        norms = np.sqrt(np.einsum("ij,ij->i", queries, queries))[:, None]
        inner = turned @ self.signs.T * self.lengths
        slack = 2 * BOUND * norms * self.lengths * self.spread
        return norms**2 + self.lengths**2 - 2 * inner, slack


def _usable_rows(embeddings: DataFrame) -> DataFrame:
    """One vector for each vec_id; copies meet within tasks first."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"))
    fit = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    return fit.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def _means(rows: DataFrame) -> DataFrame:
    """(size, mean): the mean of all vectors of each length."""
    return (
        rows.select(F.size("embedding").alias("size"), F.posexplode("embedding"))
        .groupBy("size", "pos")
        .agg(F.avg(F.col("col").cast("double")).alias("mean"))
        .groupBy("size")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "mean"))),
                         lambda x: x["mean"]).alias("mean"))
    )


def build_index(rows: DataFrame, means: DataFrame) -> DataFrame:
    """Codes of every row of (vec_id, embedding), from the mean of its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("embedding").value_lengths().to_numpy()
            for length in np.unique(lengths):
                part = batch.take(pa.array(np.flatnonzero(lengths == length)))
                mean = np.array(part.column("mean")[0].as_py())
                codes, norms, corrections = encode(matrix(part.column("embedding")), mean)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id"),
                        part.column("embedding"),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(norms),
                        pa.array(list(corrections), pa.list_(pa.float64())),
                    ],
                    names=["vec_id", "embedding", "code", "length", "corrections"],
                )

    with_mean = rows.withColumn("size", F.size("embedding")).join(means, "size")
    return with_mean.select("vec_id", "embedding", "mean").mapInArrow(
        run, _INDEX.format(kind=rows.schema["embedding"].dataType.simpleString())
    )


def nearest(embeddings: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other rows of each query.

    Nearness is the Euclidean distance in double precision; ties go to the
    smaller vec_id.  Null, empty and zero vectors, such with null or non-finite
    components and rows without vec_id take no part, and vectors of different
    length don't meet.  Repeated rows count once, and of different vectors under
    one vec_id the least counts, as arrays are ordered.  A query with fewer than k
    others gets them all; an empty table gives no rows.
    """
    rows = _usable_rows(embeddings)
    means = saved(_means(rows), "vector_means")
    index = saved(build_index(rows, means), "vector_index").withColumn("size", F.size("embedding"))
    totals = index.groupBy("size").agg(
        F.ceil(F.count(F.lit(1)) / ROWS).cast("int").alias("cells"),
        F.greatest(F.ceil(F.count_if(is_query) / QUERIES), F.lit(1)).cast("int").alias("sets"),
    )
    spread = index.join(totals, "size").select(
        "*",
        F.pmod(F.xxhash64("vec_id"), "cells").cast("int").alias("cell"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), "sets").cast("int").alias("set"),
    )
    columns = ["size", "vec_id", "embedding", "code", "length", "corrections"]
    every = [F.explode(F.sequence(F.lit(0), F.col(n) - 1)) for n in ("sets", "cells")]
    others = spread.select(
        *columns, F.lit(None).cast("array<double>").alias("mean"), "cell", every[0].alias("set")
    )
    queries = spread.filter(is_query).join(means, "size").select(
        *columns, "mean", every[1].alias("cell"), "set"
    )

    def run(tile: pa.Table) -> pa.Table:
        asked = tile.column("mean").is_valid()
        return _nearest_in(tile.filter(asked), tile.filter(pc.invert(asked)), k)

    # Few bytes make much work here, so small partitions must not be joined.
    tasks = int(embeddings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = others.unionByName(queries).repartition(tasks, "size", "cell", "set")
    near = tiles.groupBy("size", "cell", "set").applyInArrow(run, _FOUND)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Euclidean distance of each pair of rows, adding up one component after the other."""
    total = np.zeros(len(left))
    for component in range(left.shape[1]):
        total += (left[:, component] - right[:, component]) ** 2
    return np.sqrt(total)


def _nearest_in(asked: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    found: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
    if asked.num_rows and rows.num_rows:
        queries, vectors = matrix(asked.column("embedding")), matrix(rows.column("embedding"))
        query_ids, ids = (t.column("vec_id").to_numpy() for t in (asked, rows))
        packed = np.stack([np.frombuffer(c, np.uint8) for c in rows.column("code").to_pylist()])
        lengths, corrections = rows.column("length").to_numpy(), matrix(rows.column("corrections"))
        codes = Codes(packed, lengths, corrections, vectors.shape[1])
        mean = np.array(asked.column("mean")[0].as_py())
        for at in range(0, len(queries), 64):
            part = queries[at : at + 64]
            estimate, slack = codes.bounds(part - mean)
            least = estimate - slack
            least[query_ids[at : at + 64, None] == ids[None]] = np.inf
            q, v = reranked(part, vectors, least, k)
            scores = distances(vectors[v], part[q])
            order = np.lexsort((ids[v], scores, q))
            q, v, scores = q[order], v[order], scores[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            top = place < k
            found["query_id"].append(query_ids[at : at + 64][q[top]])
            found["vec_id"].append(ids[v[top]])
            found["score"].append(scores[top])
    types = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
    return pa.table(
        {n: pa.array(np.concatenate(v) if v else [], types[n]) for n, v in found.items()}
    )


def reranked(
    queries: np.ndarray, vectors: np.ndarray, least: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) that may be among the k nearest, by the originals.

    ``least`` has the lower bounds of the squared distances, infinite for pairs
    that don't count.  Rows are taken in this order, some for every query at once;
    a query is done when its next bound exceeds its k-th smallest distance.
    """
    order = np.argsort(least, axis=1, kind="stable")
    best = np.full((len(queries), k), np.inf)
    going, pairs = np.arange(len(queries)), []
    for at in range(0, vectors.shape[0], RERANKED_AT_ONCE):
        next_ones = order[going, at : at + RERANKED_AT_ONCE]
        bound = np.take_along_axis(least[going], next_ones, axis=1)
        # The sum of squares in another order may differ in the last digits.
        worst = best[going].max(axis=1) * (1 + 1e-9)
        wanted = np.isfinite(bound) & (bound <= worst[:, None])
        going, next_ones, wanted = (x[wanted.any(axis=1)] for x in (going, next_ones, wanted))
        if not len(going):
            break
        gaps = vectors[next_ones] - queries[going, None]
        exact = np.where(wanted, np.einsum("ijk,ijk->ij", gaps, gaps), np.inf)
        both = np.concatenate([best[going], exact], axis=1)
        best[going] = np.partition(both, k - 1, axis=1)[:, :k]
        chosen = np.nonzero(wanted)
        pairs.append((going[chosen[0]], next_ones[chosen]))
    if not pairs:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([q for q, _ in pairs]), np.concatenate([v for _, v in pairs])


def nearest_sql(every: int, k: int = 10) -> str:
    """The same search as DuckDB SQL over ``embeddings``, by comparing all pairs."""
    return f"""
        WITH fit AS (
          SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
          WHERE vec_id IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
            AND list_bool_or([x <> 0 FOR x IN embedding])
        ), pairs AS (
          SELECT q.vec_id AS query_id, c.vec_id,
                 sqrt(list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(q.v, c.v)])) AS score
          FROM fit q JOIN fit c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
          WHERE q.vec_id % {every} = 0
        )
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INT AS rank,
               vec_id, score
        FROM pairs QUALIFY rank <= {k}"""
