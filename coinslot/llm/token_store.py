"""Token ids in Parquet: a list column in document order, laid out for selective reads.

Ids are dictionary encoded (the vocabulary is small), counts and document ids delta encoded, pages
carry an index, and row groups are kept small, so a reader of some documents or of the counts alone
fetches little. Rows are in ascending order of the document id over all files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coinslot.llm.rows import slices
from coinslot.llm.words import encoder, with_end

#: Layout of the files: a row group of 32 MB, pages of 256 kB with an index, version 2 encodings
#: (delta for integers without a dictionary).
LAYOUT = {
    "parquet.block.size": str(32 * 1024 * 1024),
    "parquet.page.size": str(256 * 1024),
    "parquet.page.row.count.limit": "2000",
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
    "parquet.dictionary.page.size": str(1024 * 1024),
    "compression": "zstd",
}


def tokenized(docs: DataFrame, path: str, end_id: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (array of int) per row; the end id closes every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            for part in slices(batch, "text"):
                ids, starts = with_end(*encode(part.column("text")), end_id)
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids.astype(np.int32)))
                counts = pa.array(np.diff(starts), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), counts, lists], names=["doc_id", "n_tokens", "ids"])

    columns = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return columns.mapInArrow(run, "doc_id long, n_tokens int, ids array<int>")


def write_tokens(
    docs: DataFrame, folder: str, path: str, end_id: int, id_column: str = "doc_id", text: str = "text",
    partitions: int | None = None,
) -> None:
    """Encodes ``docs`` and writes the files. Null ids come first; equal ids keep any order among themselves.

    Null text counts as empty, so such a document is its end id alone. No document gives no rows.
    Texts are put in order before they are encoded, so sampling for the ranges costs no encoding.
    """
    columns = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    placed = columns.repartitionByRange(partitions, "doc_id") if partitions else columns.repartitionByRange("doc_id")
    rows = tokenized(placed.sortWithinPartitions("doc_id"), path, end_id)
    rows.write.options(**LAYOUT).mode("errorifexists").parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The stored rows with their place: ``file`` and ``row`` within it."""
    stored = spark.read.schema("doc_id long, n_tokens int, ids array<int>").parquet(folder)
    return stored.withColumns({"file": F.col("_metadata.file_path"), "row": F.col("_metadata.row_index")})


def with_starts(rows: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Adds ``start``, the count of ids of all documents before, to rows that have doc_id, n_tokens, file and row.

    Positions come from two steps: a running count within each file, whose rows are bounded by the
    writer, and the sum of the files before (one row per file). Leave wide columns out of ``rows``,
    as they are shuffled by file. ``stored``, the same rows as read, spares computing ``rows`` a second
    time for the sums.
    """
    count = F.col("n_tokens").cast("long")
    files = (rows if stored is None else stored).groupBy("file").agg(F.sum(count).alias("_tokens"), F.min("doc_id").alias("_first"))
    order = Window.orderBy(F.asc_nulls_first("_first"), "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("_tokens").over(order), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_inside", F.coalesce(F.sum(count).over(inside), F.lit(0)))
    return placed.join(files, "file").withColumn("start", F.col("_before") + F.col("_inside")).drop("_before", "_inside")


def checksums(rows: DataFrame) -> DataFrame:
    """Replaces ``ids`` by ``ids_crc32``: the unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            kept = batch.drop_columns(["ids"])
            yield kept.append_column("ids_crc32", pa.array(crc, pa.int64()))

    columns = [c for c in rows.columns if c != "ids"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*columns).schema)
    return rows.select(*columns, "ids").mapInArrow(run, f"{schema}, ids_crc32 long")
