"""Nearest vectors for a short list of query vectors."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Query vectors that are sent to the tasks at once, and catalog rows in one product.
QUERY_BLOCK, ROWS = 1024, 2048


def centroids(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Mean vector per group, as ``query_id`` and ``embedding``; reduced per dimension before the shuffle."""
    cells = df.select(group, F.posexplode(vector).alias("pos", "v")).groupBy(group, "pos").agg(F.avg("v").alias("v"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "v")))
    return cells.groupBy(group).agg(F.transform(ordered, lambda x: x.v).alias("embedding")).withColumnRenamed(
        group, "query_id"
    )


def _query_blocks(queries: DataFrame) -> Iterator[tuple[list, np.ndarray]]:
    """The queries in order of their id, a block at a time on the driver."""
    ids, vectors = [], []
    for row in queries.select("query_id", "embedding").orderBy("query_id").toLocalIterator():
        ids.append(row[0])
        vectors.append(row[1])
        if len(ids) == QUERY_BLOCK:
            yield ids, np.array(vectors, dtype="float64")
            ids, vectors = [], []
    if ids:
        yield ids, np.array(vectors, dtype="float64")


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Top k by score, ties by id, without losing ties at the cut before they are ordered."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[scores >= floor], scores[scores >= floor]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def cosine_topk(catalog: DataFrame, queries: DataFrame, k: int, id_column: str, vector: str = "embedding") -> DataFrame:
    """Exact top-k by cosine. Every task scores its rows against a block of queries in matrix products
    and passes on k rows per query, so the shuffle does not grow with the catalog's rows.

    ``queries`` (query_id bigint, embedding) may have any length: it is worked through in blocks, each a
    pass over the catalog. Catalog vectors of another length or without direction have no cosine.
    """
    parts = [_block_topk(catalog, ids, matrix, id_column, vector, k) for ids, matrix in _query_blocks(queries)]
    if not parts:
        return catalog.sparkSession.createDataFrame([], f"query_id bigint, {id_column} bigint, similarity double, rank int")
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), id_column)
    ranked = reduce(DataFrame.unionAll, parts).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k)


def _block_topk(catalog: DataFrame, query_ids: list, matrix: np.ndarray, id_column: str, vector: str, k: int) -> DataFrame:
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    shipped = catalog.sparkSession.sparkContext.broadcast(unit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shipped.value
        best = [(np.empty(0, dtype="int64"), np.empty(0)) for _ in query_ids]
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype("float64")
                norms = np.linalg.norm(rows, axis=1)
                ids, rows, norms = ids[norms > 0], rows[norms > 0], norms[norms > 0]
                scores = np.round((rows @ q.T) / norms[:, None], 6)
                for j, (seen_ids, seen) in enumerate(best):
                    best[j] = _best(np.concatenate([seen_ids, ids]), np.concatenate([seen, scores[:, j]]), k)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(query_ids, [len(i) for i, _ in best]), pa.int64()),
                pa.array(np.concatenate([i for i, _ in best]), pa.int64()),
                pa.array(np.concatenate([s for _, s in best]), pa.float64()),
            ],
            names=["query_id", id_column, "similarity"],
        )

    usable = catalog.filter(F.size(vector) == matrix.shape[1]).select(F.col(id_column).cast("long"), vector)
    return usable.mapInArrow(run, f"query_id bigint, {id_column} bigint, similarity double")


def squared_distances(catalog: DataFrame, queries: DataFrame, id_column: str, vector: str = "embedding") -> DataFrame:
    """Squared distance of every catalog row to every query of a short list, summed by dimension."""
    cells = catalog.select(F.col(id_column), F.posexplode(F.col(vector).cast("array<double>")).alias("pos", "x"))
    asked = queries.select("query_id", F.posexplode("embedding").alias("pos", "y"))
    return cells.join(asked, "pos").groupBy("query_id", id_column).agg(F.sum((F.col("x") - F.col("y")) ** 2).alias("squared"))


def lsh_matches(
    catalog: DataFrame, queries: DataFrame, threshold: float, id_column: str, vector: str = "embedding",
    bucket_length: float = 4.0, tables: int = 4,
) -> DataFrame:
    """Approximate search: pairs of query and catalog row within ``threshold`` of each other.

    The query side is a short list, so candidates are at most queries x rows of a bucket.
    """
    rows = catalog.select(F.col(id_column).alias("id"), array_to_vector(F.col(vector).cast("array<double>")).alias("v"))
    asked = queries.select(F.col("query_id").alias("id"), array_to_vector(F.col("embedding")).alias("v"))
    lsh = BucketedRandomProjectionLSH(
        inputCol="v", outputCol="hashes", bucketLength=bucket_length, numHashTables=tables, seed=42
    )
    pairs = lsh.fit(rows).approxSimilarityJoin(asked, rows, threshold, "distance")
    return pairs.select(
        F.col("datasetA.id").alias("query_id"), F.col("datasetB.id").alias(id_column), F.round("distance", 6).alias("distance")
    )
