"""Token counts from flat, unindexed token files by a scan for the end-of-document id.

Files are read in blocks, in parallel and by offset. A block is searched as one vector; documents
that cross block borders are stitched by a prefix scan over the blocks' last separators.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coinslot.llm.rows import slices
from coinslot.llm.words import encoder, with_end

#: Bytes of a file that a task searches at once.
BLOCK_BYTES = 4 * 1024 * 1024
DTYPE = "<u2"


def write_flat(
    docs: DataFrame, folder: str, path: str, end_id: int, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Writes one file of little-endian unsigned 16-bit ids per task below ``folder``/tokens.

    Each document is closed by ``end_id``, which the tokenizer must not give to any text. Returns which
    document stands where: ``file`` (name), ``ordinal`` in it and ``doc_id``, stored beside the files.
    A file appears under its name when it is whole, and a repeated task writes the same file again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A special token's name inside a text is plain text here, or it would close a document.
        encode = encoder(path, False).encode
        store, base = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        name = f"{task.partitionId():06d}.bin"
        store.create_dir(f"{base}/tokens", recursive=True)
        draft = f"{base}/tokens/_{name}-{task.taskAttemptId()}"
        ordinal = 0
        with store.open_output_stream(draft) as out:
            for batch in batches:
                for part in slices(batch, "text"):
                    ids, _ = with_end(*encode(part.column("text")), end_id)
                    if len(ids) and ids.max() >= 1 << 16:
                        raise ValueError("ids above 16 bits")
                    out.write(ids.astype(DTYPE).tobytes())
                    n = part.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * n), pa.array(np.arange(ordinal, ordinal + n)), part.column("doc_id")],
                        names=["file", "ordinal", "doc_id"],
                    )
                    ordinal += n
        store.move(draft, f"{base}/tokens/{name}")

    columns = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    where = "file string, ordinal long, doc_id long"
    columns.mapInArrow(run, where).write.mode("errorifexists").parquet(f"{folder}/places")
    return docs.sparkSession.read.schema(where).parquet(f"{folder}/places")


def files_of(spark: SparkSession, folder: str) -> DataFrame:
    """One row per finished file: ``file`` and ``bytes``."""
    store, base = fs.FileSystem.from_uri(folder)
    found = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
    rows = [(f.base_name, f.size) for f in found if f.is_file and not f.base_name.startswith(("_", "."))]
    return spark.createDataFrame(rows, "file string, bytes long")


def scan_counts(spark: SparkSession, folder: str, end_id: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document of the flat files in ``folder``: ``file``, ``ordinal`` in it, ``n_tokens`` without the separator.

    Documents without tokens count 0. Tokens after a file's last separator are a document too. An empty
    file has no documents. ``block_bytes`` must be a whole number of ids.
    """
    if block_bytes % 2:
        raise ValueError("a block must hold whole ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{base}/{row['file']}") as source:
                    data = source.read_at(min(block_bytes, row["bytes"] - row["at"]), row["at"])
                found = np.flatnonzero(np.frombuffer(data, DTYPE) == end_id) + row["at"] // 2
                if row["at"] + block_bytes >= row["bytes"] and (not len(found) or found[-1] != row["bytes"] // 2 - 1):
                    found = np.append(found, row["bytes"] // 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["file"]]), pa.array([row["at"]]), pa.array([found], pa.list_(pa.int64()))],
                    names=["file", "at", "ends"],
                )

    blocks = files_of(spark, folder).filter("bytes > 0").select(
        "file", "bytes", F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(block_bytes).cast("long"))).alias("at")
    )
    n = max(1, spark.sparkContext.defaultParallelism)
    ends = blocks.repartition(max(n, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file", "at")
    ends = ends.mapInArrow(run, "file string, at long, ends array<long>")
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.element_at("ends", -1))
    stitched = ends.filter(F.size("ends") > 0).select(
        "file", "ends",
        F.coalesce(F.sum(F.size("ends").cast("long")).over(before), F.lit(0)).alias("first"),
        F.coalesce(last.over(before), F.lit(-1)).alias("carry"),
    )
    starts = F.concat(F.array("carry"), F.slice("ends", F.lit(1), F.size("ends") - 1))
    lengths = F.zip_with("ends", starts, lambda end, start: end - start - 1)
    each = stitched.select("file", "first", F.posexplode(lengths).alias("i", "n_tokens"))
    return each.select("file", (F.col("first") + F.col("i")).alias("ordinal"), "n_tokens")


def token_counts(docs: DataFrame, folder: str, path: str, end_id: int) -> DataFrame:
    """``doc_id`` and ``n_tokens`` per row of ``docs``: encodes, writes flat files, counts by scanning them."""
    places = write_flat(docs, folder, path, end_id)
    counts = scan_counts(docs.sparkSession, f"{folder}/tokens", end_id)
    # The planner takes the counts for small, as they come from a list of files; they are one row per document.
    return places.join(counts.hint("merge"), ["file", "ordinal"]).select("doc_id", "n_tokens")
