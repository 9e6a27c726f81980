"""Exact top-k search by inner product, a term at a time.

A vector is a sparse row of (term, weight): its places and their non-zero whole numbers. Each task cuts its
candidates into blocks and turns a block into postings, for each term the rows that have it and their weights. A
query then goes through its own terms: each scatters the query's weight times the posting weights into a dense
array with one score per row of the block. Partition selection takes the k best of a block, the task merges
them with those it has, and Spark merges the tasks' lists.

Nothing is left out: every query meets every candidate. Queries go to the tasks in blocks of at most
``BLOCK_TERMS`` terms, or one query if that alone has more, one Spark job a block, so what is broadcast or held for
the best lists has a bound, however many queries there are; candidates are read where they are and never shuffled.

Vectors that are null or hold a null or non-finite component take no part, neither as query nor as candidate. An empty
vector scores 0. Places that the shorter of two vectors lacks count as 0. Rows without id are candidates only, and come
last in ties. A query's own row is all rows of its id; other repeated rows are candidates each, and a repeated query
is answered each time. Scores beyond a 64-bit integer are given as its least or largest value. An empty table gives
no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weirgate.llm.common import stage

SCALE = 256
#: Terms of one block of queries, and of one block of candidates in a task; 16 MB each.
BLOCK_TERMS = 1 << 20
LEAST, LARGEST = -(2**63), 2**63 - 1

#: (first row offsets, terms, weights) of some rows.
Sparse = tuple[np.ndarray, np.ndarray, np.ndarray]


def whole(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x); Python's integers where 64 bits do not hold it."""
    if not len(values) or np.abs(values).max() < 2.0**50:
        return np.floor(values * SCALE).astype(np.int64)
    return np.array([SCALE * int(x) if abs(x) >= 2.0**50 else int(np.floor(x * SCALE)) for x in values.tolist()], object)


def sparse(vectors: pa.ListArray) -> Sparse:
    """Rows as offsets into terms and non-zero weights."""
    offsets = np.asarray(vectors.offsets, np.int64) - vectors.offsets[0].as_py()
    values = np.asarray(vectors.flatten(), np.float64)
    weights = whole(values)
    terms = np.arange(len(values)) - np.repeat(offsets[:-1], np.diff(offsets))
    kept = np.flatnonzero(weights != 0)
    return np.searchsorted(kept, offsets), terms[kept], weights[kept]


def postings(rows: Sparse) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each term the rows that have it, in order, and their weights."""
    starts, terms, weights = rows
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.argsort(terms, kind="stable")
    terms, row, weights = terms[order], row[order], weights[order]
    cuts = np.flatnonzero(np.diff(terms)) + 1
    groups = zip(np.split(terms, cuts), np.split(row, cuts), np.split(weights, cuts))
    return {int(t[0]): (r, w) for t, r, w in groups if len(t)}


def _largest(weights: np.ndarray) -> int:
    return max(int(np.abs(weights).max()), 1) if len(weights) else 1


def _fitting(queries: Sparse, rows: Sparse) -> type:
    """The narrowest kind of number that holds every score of these rows."""
    longest = max([1, *np.diff(queries[0]).tolist()])
    bound = _largest(queries[2]) * _largest(rows[2]) * longest
    return np.int32 if bound < 2**31 else np.int64 if bound < 2**63 else object


class Best:
    """The k best candidates of each query so far: scores, ids and whether there is an id, best first."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = [np.zeros(0, np.int64) for _ in range(queries)]
        self.ids = [np.zeros(0, np.int64) for _ in range(queries)]
        self.unnamed = [np.zeros(0, bool) for _ in range(queries)]

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        scores = np.concatenate([self.scores[q], scores])
        ids, unnamed = np.concatenate([self.ids[q], ids]), np.concatenate([self.unnamed[q], unnamed])
        order = np.lexsort((ids, unnamed, -1 - scores))[: self.k]  # -1 - x has no overflow, unlike -x
        self.scores[q], self.ids[q], self.unnamed[q] = scores[order], ids[order], unnamed[order]

    def lowest(self, q: int) -> int:
        """No candidate below this score can enter."""
        return int(self.scores[q][-1]) if len(self.scores[q]) == self.k else LEAST


def score_block(queries: Sparse, query_ids: np.ndarray, rows: Sparse, ids: np.ndarray, unnamed: np.ndarray, best: Best) -> None:
    """Accumulate every query's scores over a block of rows and take in its best."""
    kind = _fitting(queries, rows)
    # Rows in the order of their ids: of equal scores the first ones are those wanted.
    by_id = np.lexsort((ids, unnamed))
    place = np.empty(len(ids), np.int64)
    place[by_id] = np.arange(len(ids))
    ids, unnamed = ids[by_id], unnamed[by_id]
    lists = {t: (place[r], w.astype(kind)) for t, (r, w) in postings(rows).items()}
    starts, terms, weights = queries
    weights = weights.astype(kind)
    named = len(ids) - int(unnamed.sum())
    for q, own in enumerate(query_ids.tolist()):
        scores = np.zeros(len(ids), kind)
        for i in range(starts[q], starts[q + 1]):
            found = lists.get(int(terms[i]))
            if found is not None:
                scores[found[0]] += weights[i] * found[1]
        if kind is object:
            scores = np.array([min(max(s, LEAST), LARGEST) for s in scores], np.int64)
        low, high = np.searchsorted(ids[:named], own), np.searchsorted(ids[:named], own, "right")
        if high > low:
            scores, others = np.delete(scores, np.s_[low:high]), np.delete(np.arange(len(ids)), np.s_[low:high])
        else:
            others = np.arange(len(ids))
        if not len(scores):
            continue
        at = max(len(scores) - best.k, 0)
        least = max(int(np.partition(scores, at)[at]), best.lowest(q))
        chosen = np.flatnonzero(scores >= least)
        if len(chosen):
            first = chosen[np.argsort(-1 - scores[chosen].astype(np.int64), kind="stable")[: best.k]]
            best.add(q, scores[first].astype(np.int64), ids[others[first]], unnamed[others[first]])


def _scorer(numbers: np.ndarray, query_ids: np.ndarray, queries: Sparse, k: int, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(query_ids), k)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                offsets = np.asarray(batch.column(1).offsets)
                rows = max(int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1 - at, 1)
                block = batch.slice(at, rows)
                ids, unnamed = block.column(0), np.asarray(block.column(0).is_null())
                score_block(queries, query_ids, sparse(block.column(1)), np.asarray(ids.fill_null(0)), unnamed, best)
                at += rows
        found = [len(s) for s in best.scores]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(numbers, found)),
                pa.array(np.repeat(query_ids, found)),
                pa.array(np.concatenate([*best.ids, np.zeros(0, np.int64)]), mask=np.concatenate([*best.unnamed, np.zeros(0, bool)])),
                pa.array(np.concatenate([*best.scores, np.zeros(0, np.int64)])),
            ],
            ["number", "query_id", "id", "score"],
        )

    return run


def usable(vector: Column) -> Column:
    """Is the vector there, with finite components only?"""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """query_id, rank, id, score: the k candidates of each query with the highest inner product, ties to smaller ids.

    Both tables have (id bigint, vector array<double>). Rows are scored in one job per block of queries.
    """
    spark = candidates.sparkSession
    candidates = candidates.select(F.col("id").cast("bigint"), F.col("vector").cast("array<double>")).where(usable(F.col("vector")))
    asked = queries.select(F.col("id").cast("bigint"), F.col("vector").cast("array<double>")).where("id is not null").where(usable(F.col("vector")))
    asked = stage(asked.withColumn("number", F.monotonically_increasing_id()), "queries")
    found = stage(_in_blocks(asked, block_terms), "query-blocks")
    blocks = found.agg(F.max("block")).first()[0]
    parts = []
    for block in range(0 if blocks is None else blocks + 1):
        rows = found.where(F.col("block") == block).select("number", "id", "vector").toArrow()
        if rows.num_rows:
            rows = rows.combine_chunks().to_batches()[0]
            scorer = _scorer(np.asarray(rows.column(0)), np.asarray(rows.column(1)), sparse(rows.column(2)), k, block_terms)
            parts.append(stage(candidates.mapInArrow(scorer, "number bigint, query_id bigint, id bigint, score bigint"), "best"))
    if not parts:
        return spark.createDataFrame([], "query_id bigint, rank int, id bigint, score bigint")
    best = parts[0]
    for part in parts[1:]:
        best = best.unionByName(part)
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")


def _in_blocks(asked: DataFrame, block_terms: int) -> DataFrame:
    """Number the blocks by the terms before each query: sums over stored partitions, then within them."""
    terms = F.greatest(F.size("vector"), F.lit(1)).cast("bigint")
    sized = asked.select("*", terms.alias("terms"), F.shiftright("number", 33).alias("part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sized.groupBy("part").agg(F.sum("terms").alias("all"))
    starts = sums.select("part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("start") + F.coalesce(F.sum("terms").over(within), F.lit(0))
    return sized.join(starts, "part").select("number", "id", "vector", F.floor(at / block_terms).cast("bigint").alias("block"))
