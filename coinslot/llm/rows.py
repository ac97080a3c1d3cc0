"""Row helpers shared by the operators: Arrow slices of bounded size and pass-through columns."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Text bytes that are worked on at once inside a task. A longer single text is a slice of its own.
SLICE_BYTES = 4_000_000
#: Bytes of the Arrow batches that go to tasks' Python workers: with its last row a batch mostly is one slice.
BATCH_BYTES = 3_900_000

#: Where the C library has it: gives the system back what is free on its heap.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Batches of the session are cut by bytes as well: by rows alone, long texts make them as large as the rows are long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def filled(text: pa.Array) -> pa.Array:
    """Texts as one large_string array; null counts as empty."""
    return pc.fill_null(text.cast(pa.large_string()), "")


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after another, and where each text starts (one more entry for the end)."""
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
    data = text.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def release() -> None:
    """Gives back the memory a worker no longer uses: workers outlive their tasks and share their executor's memory."""
    pa.default_memory_pool().release_unused()
    _trim(0)


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with at most ``limit`` bytes of text, but at least one row. Memory is released behind the last."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, stop - at)
        at = stop
    release()


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have yet, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
