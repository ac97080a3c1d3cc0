"""Vector search by inverted lists: every row lies in the cell of its nearest centre, a query visits a few cells.

Centres are fitted on a bounded sample (``SAMPLE`` rows, whatever the catalog's size); every row is indexed.
The index is a stored table, ordered by cell and cut into blocks of about ``BLOCK`` rows, so a cell that holds a
third of all rows is many blocks. A search meets blocks of rows with blocks of queries that visit the cell;
no task holds more than one of each, and k rows per query leave it. How many cells to visit is measured, not
guessed: ``tune_probes`` doubles them until a set of queries finds the share of its true neighbours asked for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coinslot.ml.similarity import _best
from coinslot.operators.layout import clustered_write
from coinslot.session import materialise

SAMPLE, BLOCK, ROWS = 200_000, 4096, 2048


@dataclass(frozen=True)
class Index:
    """Where the lists are stored, and the centres: cells x dimensions numbers, which do not grow with the rows."""

    path: str
    centres: np.ndarray
    id_column: str
    vector: str

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def _usable(df: DataFrame, vector: str, dims: int | None = None) -> DataFrame:
    """Rows with a direction: vectors without nulls, without infinities, not zero, of the given length."""
    v = F.col(vector).cast("array<double>")
    squares = F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x)
    right = squares.between(1e-300, 1e300)
    return df.filter(right if dims is None else right & (F.size(vector) == dims))


def fit_centres(catalog: DataFrame, vector: str, cells: int, seed: int = 11) -> np.ndarray:
    """Unit centres of at most ``cells`` cells, from a sample of at most ``SAMPLE`` rows."""
    usable = _usable(catalog, vector)
    common = usable.groupBy(F.size(vector).alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if common is None:
        return np.zeros((0, 0))
    usable = usable.filter(F.size(vector) == common["dims"])
    share = min(1.0, SAMPLE / common["count"])
    unit = F.col(vector).cast("array<double>")
    norm = F.sqrt(F.aggregate(unit, F.lit(0.0), lambda acc, x: acc + x * x))
    sample = (usable if share == 1.0 else usable.sample(share, seed)).select(array_to_vector(F.transform(unit, lambda x: x / norm)).alias("features"))
    sample = materialise(sample, "cell-sample")
    model = KMeans(k=max(2, cells), seed=seed, maxIter=10, distanceMeasure="cosine").fit(sample)
    return np.array(model.clusterCenters(), dtype="float64")


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    found = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    matrix = found.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1).astype("float64")
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def nearest_cells(df: DataFrame, centres: np.ndarray, id_column: str, vector: str, probes: int) -> DataFrame:
    """(id, embedding, cell) for the ``probes`` nearest cells of every usable row."""
    shipped = df.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                scores = _matrix(batch.column(1), batch.num_rows) @ shipped.value.T
                cells = np.argsort(-scores, axis=1, kind="stable")[:, :probes]
                rows = np.repeat(np.arange(batch.num_rows), cells.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)), pa.array(cells.ravel(), pa.int32())],
                    names=["id", "embedding", "cell"],
                )

    usable = _usable(df, vector, centres.shape[1]) if len(centres) else df.filter(F.lit(False))
    named = usable.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("embedding"))
    return named.mapInArrow(run, "id bigint, embedding array<float>, cell int")


def build(catalog: DataFrame, path: str, id_column: str, vector: str = "embedding", cells: int | None = None) -> Index:
    """Stores every usable row under its cell. Vectors without direction, or of a rarer length, are in no list."""
    cells = cells or max(2, math.isqrt(catalog.count()))
    centres = fit_centres(catalog, vector, cells)
    listed = materialise(nearest_cells(catalog, centres, id_column, vector, 1), "cells")
    blocks = listed.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    cut = listed.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    clustered_write(cut, path, ["cell", "block"])
    return Index(path, centres, id_column, vector)


def search(spark: SparkSession, index: Index, queries: DataFrame, k: int, probes: int) -> DataFrame:
    """The best k of the visited cells by cosine, ties to the smaller id: query_id, id, similarity, rank.

    ``queries`` (query_id bigint, embedding) may have any length. Rows meet a query once, as a row is in one cell.
    """
    out = f"query_id bigint, {index.id_column} bigint, similarity double"
    asked = materialise(nearest_cells(queries, index.centres, "query_id", "embedding", probes), "probes")
    asked = asked.withColumnRenamed("id", "query_id")
    rows = index.rows(spark)
    # At most one number per cell: the scan reads the row groups of visited cells only.
    visited = [r[0] for r in asked.select("cell").distinct().collect()]
    rows = rows.filter(F.col("cell").isin(visited))
    sides = rows.groupBy("cell").agg(F.max("blocks").alias("row_blocks")).join(
        asked.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("query_blocks")), "cell"
    )
    sides = materialise(sides, "cell-blocks")
    # A block of rows goes to every block of queries of its cell, and the other way round.
    left = rows.drop("blocks").join(sides.select("cell", "query_blocks"), "cell").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1))
    )
    right = asked.join(sides, "cell").withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("query_blocks")).cast("int"))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)))
    keys = ["cell", "block", "part"]

    def score(row_table: pa.Table, query_table: pa.Table) -> pa.Table:
        found_q, found_i, found_s = [], [], []
        if row_table.num_rows and query_table.num_rows:
            ids = row_table["id"].to_numpy()
            vectors = _matrix(row_table["embedding"], row_table.num_rows)
            asked_ids, wanted = query_table["query_id"].to_numpy(), _matrix(query_table["embedding"], query_table.num_rows)
            for at in range(0, len(asked_ids), 256):
                scores = np.round(wanted[at : at + 256] @ vectors.T, 6)
                for query, line in zip(asked_ids[at : at + 256], scores):
                    best, value = _best(ids, line, k)
                    found_q.append(np.full(len(best), query))
                    found_i.append(best)
                    found_s.append(value)
        joined = [np.concatenate(c) if c else np.empty(0) for c in (found_q, found_i, found_s)]
        arrays = [pa.array(joined[0].astype("int64")), pa.array(joined[1].astype("int64")), pa.array(joined[2].astype("float64"))]
        return pa.Table.from_arrays(arrays, names=["query_id", index.id_column, "similarity"])

    met = left.select(*keys, "id", "embedding").groupBy(*keys).cogroup(right.select(*keys, "query_id", "embedding").groupBy(*keys))
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), index.id_column)
    return met.applyInArrow(score, out).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame, id_column: str) -> float:
    """Share of the exact neighbours that were found, over all queries; 1 without any."""
    hit = found.select("query_id", id_column, F.lit(1).alias("hit"))
    share = exact.join(hit, ["query_id", id_column], "left").agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0]
    return 1.0 if share is None else float(share)


def tune_probes(spark: SparkSession, index: Index, queries: DataFrame, exact: DataFrame, k: int, asked: float = 0.9):
    """(probes, recall, matches) for the first of 1, 2, 4, ... cells to find at least ``asked`` of ``exact``. All cells find all."""
    probes = 1
    while True:
        found = materialise(search(spark, index, queries, k, probes), "cell-matches")
        share = recall(found, exact, index.id_column)
        if share >= asked or probes >= len(index.centres):
            return probes, share, found
        probes = min(2 * probes, len(index.centres))
