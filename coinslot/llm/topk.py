"""Exact top-k search by distributed histogram selection.

Vectors become whole numbers. Queries go out in blocks of bounded size; every task scores its own
candidates against the block as matrix products. The k-th highest score of each query is located by
global histograms of all scores, refined until a bin is one score. Rows above it are in, ties are
broken by the smaller id.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coinslot.session import materialise

#: Queries that are sent to the tasks at once (4 MB at 64 components) and scored in one product.
QUERY_BLOCK, AT_ONCE = 8192, 256
#: Candidates in one product.
CANDIDATES = 2048
#: Bins per query and step.
BINS = 256
NONE = np.iinfo(np.int64).min

def quantised(vectors: DataFrame, scale: int, id_column: str, vector: str) -> DataFrame:
    """``vec_id`` and ``v`` (array of double holding whole numbers): floor(scale * x) of every component.

    Rows with a null id or vector, or with a null or non-finite component, are left out, empty vectors too.
    """
    x = F.col("x")
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
    whole = rows.filter(
        F.col("vec_id").isNotNull() & (F.size(x) > 0)
        & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    )
    return whole.select("vec_id", F.transform(x, lambda c: F.floor(c * F.lit(scale)).cast("double")).alias("v"))


def _scored(batches: Iterator[pa.RecordBatch], asked: np.ndarray, ids: np.ndarray) -> Iterator[tuple]:
    """Scores of a task's rows: first query of the product, candidate ids, scores (query x candidate).

    Rows of another width have no inner product. A query's own row scores NONE.
    """
    for batch in batches:
        same = np.asarray(batch.column("v").value_lengths()) == asked.shape[1]
        batch = batch.filter(pa.array(same))
        rows = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, asked.shape[1])
        row_ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
        for c in range(0, len(row_ids), CANDIDATES):
            some = row_ids[c : c + CANDIDATES]
            for q in range(0, len(ids), AT_ONCE):
                scores = (asked[q : q + AT_ONCE] @ rows[c : c + CANDIDATES].T).astype(np.int64)
                scores[ids[q : q + AT_ONCE, None] == some[None, :]] = NONE
                yield q, some, scores


def _histograms(batches: Iterator[pa.RecordBatch], block: tuple, low: np.ndarray, width: int, k: int) -> Iterator[pa.RecordBatch]:
    """Per query and bin, how many of the task's scores: its highest bins that together hold k of them.

    The task's k-th score is not above that of all rows, so lower bins cannot matter. The bin past the
    last holds all scores above the range.
    """
    asked, ids = block
    table = np.zeros((len(ids), BINS + 2), np.int64)
    for q, _, scores in _scored(batches, asked, ids):
        n = len(scores)
        bins = np.clip((np.maximum(scores, low[q : q + n, None] - 1) - low[q : q + n, None]) // width, -1, BINS) + 1
        flat = bins + np.arange(n)[:, None] * (BINS + 2)
        table[q : q + n] += np.bincount(flat.ravel(), minlength=n * (BINS + 2)).reshape(n, -1)
    table = table[:, 1:]
    above = np.cumsum(table[:, ::-1], axis=1)[:, ::-1] - table
    at = np.nonzero((table > 0) & (above < k))
    yield pa.RecordBatch.from_arrays([pa.array(at[0]), pa.array(at[1]), pa.array(table[at])], names=["i", "bin", "n"])


def _chosen(batches: Iterator[pa.RecordBatch], block: tuple, floor: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """The task's rows at or above each query's floor: at most k per query and product, best first."""
    asked, ids = block
    for q, some, scores in _scored(batches, asked, ids):
        at = np.nonzero((scores >= floor[q : q + len(scores), None]) & (scores > NONE))
        order = np.lexsort((some[at[1]], -scores[at], at[0]))
        i, j = at[0][order], at[1][order]
        first = np.arange(len(i)) - np.searchsorted(i, i) < k
        i, j = i[first], j[first]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[q + i]), pa.array(some[j]), pa.array(scores[i, j])], names=["query_id", "vec_id", "score"]
        )


def kth_scores(rows: DataFrame, block: tuple, k: int, reach: int) -> np.ndarray:
    """The k-th highest score of each query of a block, or a lower bound of all scores if there are fewer."""
    spark = rows.sparkSession
    low, width = np.full(len(block[1]), -reach, np.int64), -(-(2 * reach + 1) // BINS)
    shipped = spark.sparkContext.broadcast(block)
    while True:
        def run(batches, low=low, width=width):
            return _histograms(batches, shipped.value, low, width, k)

        counts = rows.mapInArrow(run, "i long, bin long, n long").groupBy("i", "bin").agg(F.sum("n").alias("n")).toPandas()
        table = np.zeros((len(low), BINS + 1), np.int64)
        table[counts["i"].to_numpy(np.int64), counts["bin"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
        enough = np.cumsum(table[:, ::-1], axis=1) >= k
        low = low + np.where(enough.any(axis=1), BINS - np.argmax(enough, axis=1), 0) * width
        if width == 1:
            return low
        width = -(-width // BINS)


def top_k(
    vectors: DataFrame, is_query: Column, k: int, scale: int = 64, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id, rank`` (from 1), ``vec_id, score`` of the ``k`` highest integer inner products per query.

    ``is_query`` tells from ``vec_id`` which rows ask; all other rows of the same width answer, rows with
    the query's own id do not. A query with fewer than ``k`` candidates gets all, one without gets none.
    Ties go to the smaller id. An id that repeats asks once, by its least vector, and answers with each
    of its rows. Scores are exact while they stay below 2**53.

    Query blocks follow each other: the driver holds one block of at most QUERY_BLOCK vectors and, per
    query, its bounds and bins, whatever the number of rows.
    """
    spark = vectors.sparkSession
    rows = materialise(quantised(vectors, scale, id_column, vector), "topk-rows")
    asked = rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    # Blocks by a running number: within ranges of ids, so no task sees all of them.
    numbered = materialise(asked.withColumn("w", F.size("v")).repartitionByRange("w", "vec_id").sortWithinPartitions("w", "vec_id")
                           .withColumn("n", F.monotonically_increasing_id()), "topk-queries")
    blocks = numbered.groupBy("w", F.shiftright("n", 33).alias("part"), (F.col("n") % (1 << 33) / QUERY_BLOCK).cast("long").alias("b"))
    longest = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))).first()[0] or 0.0
    out = None
    for key in blocks.count().orderBy("w", "part", "b").toLocalIterator():
        mine = numbered.filter(
            (F.col("w") == key["w"]) & (F.shiftright("n", 33) == key["part"])
            & (F.col("n") % (1 << 33)).between(key["b"] * QUERY_BLOCK, (key["b"] + 1) * QUERY_BLOCK - 1)
        ).select("vec_id", "v").toPandas()
        block = (np.stack(mine["v"].to_numpy()).astype(np.float64), mine["vec_id"].to_numpy(np.int64))
        floor = kth_scores(rows, block, k, int(longest) + 1)
        shipped = spark.sparkContext.broadcast(block)
        best = rows.mapInArrow(
            functools.partial(lambda batches, b, f: _chosen(batches, b.value, f, k), b=shipped, f=floor),
            "query_id long, vec_id long, score long",
        )
        out = best if out is None else out.unionAll(best)
    if out is None:
        out = spark.createDataFrame([], "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
