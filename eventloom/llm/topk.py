"""Exact top-k inner products by branch and bound over columns.

Candidates are packed in blocks in vertical layout, one row of numbers per
dimension. Partial products grow ``STEP`` dimensions at a time; after each step a
candidate stays only if its partial product plus the largest product that the
remaining parts can have (the product of their lengths) still reaches the query's
k-th best score so far, and the columns of those that stay are compacted.

Queries travel in blocks to every group of candidate blocks: a join on the group
number, streamed block against block, so a task holds one block of each and the
best ``k`` of the queries of one block. The work is queries times candidates, as
the search is exact, and splits evenly over groups whatever the values are.

Defined cases: rows whose id or vector is null, or whose vector holds null or
non-finite components, take no part. Only vectors of equal length are compared;
vectors without components score 0. Repeated candidate rows are candidates each;
queries with one id are searched together. A candidate with the query's id is the
query's own row. Scores beyond the range of a long stop at its ends.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import stored

STEP = 8  # dimensions between two looks at the bounds
BLOCK, QUERY_BLOCK = 2048, 256
LEAST, MOST = -(2**63), 2**63 - 1

BLOCKS = "dims int, ids binary, numbers binary"
FOUND = "query_id long, vec_id long, score long"


def usable(vector: Column) -> Column:
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(finite(x.cast("double")), F.lit(False)))


def _pack(size: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of up to ``size`` vectors of one length, as whole numbers kept in doubles."""
        for batch in batches:
            ids = batch.column(0).to_numpy()
            vectors = batch.column(1)
            lengths = vectors.value_lengths().to_numpy()
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.concatenate(([0], np.cumsum(lengths)))
            rows = []
            for dims in np.unique(lengths):
                of = np.flatnonzero(lengths == dims)
                for low in range(0, len(of), size):
                    part = of[low : low + size]
                    columns = flat[starts[part][None, :] + np.arange(dims)[:, None]] if dims else np.empty((0, len(part)))
                    rows.append((int(dims), ids[part].astype(np.int64).tobytes(), np.ascontiguousarray(columns).tobytes()))
            if rows:
                kinds = (pa.int32(), pa.binary(), pa.binary())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["dims", "ids", "numbers"])

    return pack


def _products(query: np.ndarray, columns: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Exact inner products of a query with the ``kept`` columns, ended at the range of a long."""
    if not len(query):
        return np.zeros(len(kept), np.int64)
    columns = columns[:, kept]
    reach = float(np.abs(query).max()) * float(np.abs(columns).max(initial=0)) * len(query)
    if reach < 2**53:
        return (query @ columns).astype(np.int64)
    whole = [[int(x) for x in row] for row in columns.T]
    mine = [int(x) for x in query]
    sums = (sum(a * b for a, b in zip(mine, row, strict=True)) for row in whole)
    return np.array([min(MOST, max(LEAST, s)) for s in sums], np.int64)


def survivors(query: np.ndarray, left: np.ndarray, columns: np.ndarray, remaining: np.ndarray, least: float) -> np.ndarray:
    """Columns whose product with ``query`` can reach ``least``.

    ``left`` and ``remaining`` hold the lengths of what is left of the query and
    of each column from every step on.
    """
    kept = np.arange(columns.shape[1])
    if least == -math.inf:
        return kept
    partial = np.zeros(len(kept))
    for step, low in enumerate(range(0, len(query), STEP)):
        bound = partial + left[step] * remaining[step, kept]
        stay = bound * (1 + 1e-9 * np.sign(bound)) + 1 >= least  # room for rounding
        if not stay.all():
            kept, partial = kept[stay], partial[stay]
        if not len(kept):
            break
        partial = partial + query[low : low + STEP] @ columns[low : low + STEP, kept]
    if len(kept):
        kept = kept[partial + np.abs(partial) * 1e-9 + 1 >= least]
    return kept


def _lengths(columns: np.ndarray) -> np.ndarray:
    """Lengths of what remains of each column from dimension 0, STEP, 2 STEP ... on."""
    squares = np.add.reduceat(columns**2, np.arange(0, len(columns), STEP), axis=0) if len(columns) else columns
    return np.sqrt(np.cumsum(squares[::-1], axis=0)[::-1])


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best ``k`` of each query over the task's candidate blocks; rows come sorted by query block."""
        current, queries, best = None, None, []

        def flush() -> Iterator[pa.RecordBatch]:
            if current is not None:
                ids = np.repeat(queries[0], [len(b[0]) for b in best])
                columns = [ids, np.concatenate([b[0] for b in best]), np.concatenate([b[1] for b in best])]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["query_block"] != current:
                    yield from flush()
                    current = row["query_block"]
                    ids = np.frombuffer(row["query_ids"], np.int64)
                    numbers = np.frombuffer(row["query_numbers"], np.float64).reshape(row["dims"], len(ids))
                    queries = (ids, np.ascontiguousarray(numbers.T), _lengths(numbers))
                    best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in ids]
                names = np.frombuffer(row["ids"], np.int64)
                columns = np.frombuffer(row["numbers"], np.float64).reshape(row["dims"], len(names))
                remaining = _lengths(columns)
                for i, query_id in enumerate(queries[0]):
                    held, scores = best[i]
                    least = float(scores[-1]) if len(scores) == k else -math.inf
                    kept = survivors(queries[1][i], queries[2][:, i], columns, remaining, least)
                    kept = kept[names[kept] != query_id]
                    if len(kept):
                        held = np.concatenate((held, names[kept]))
                        scores = np.concatenate((scores, _products(queries[1][i], columns, kept)))
                        order = np.lexsort((held, -scores.astype(np.float64), -np.maximum(scores, -MOST)))[:k]
                        best[i] = held[order], scores[order]
        yield from flush()

    return search


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best candidates of each query.

    Both sides have ``id`` (long) and ``vector`` (array of whole numbers as doubles).
    Ties go to the smaller id.
    """
    spark = queries.sparkSession
    queries, candidates = (df.select("id", "vector").where("id is not null") for df in (queries, candidates))
    count = queries.count()
    packed_queries = stored(
        queries.repartition(max(1, math.ceil(count / QUERY_BLOCK)))
        .mapInArrow(_pack(QUERY_BLOCK), BLOCKS)
        .withColumn("query_block", F.monotonically_increasing_id()),
        "queries",
    )
    packed = stored(
        candidates.mapInArrow(_pack(BLOCK), BLOCKS).withColumn("block", F.monotonically_increasing_id()), "candidates"
    )
    blocks = packed.count()
    groups = max(1, min(blocks, max(4 * spark.sparkContext.defaultParallelism, blocks // 16)))
    sent = packed_queries.select(
        "dims",
        "query_block",
        F.col("ids").alias("query_ids"),
        F.col("numbers").alias("query_numbers"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"),
    )
    pairs = sent.join(packed.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int")), ["part", "dims"])
    found = (
        pairs.select("query_block", "dims", "query_ids", "query_numbers", "ids", "numbers")
        .sortWithinPartitions("query_block")
        .mapInArrow(_search(k), FOUND)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
