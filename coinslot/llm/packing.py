"""Cost-balanced packing of documents into sequences of bounded length.

A document's cost is estimated as linear plus quadratic in its tokens, as attention stays within a
document. Each group of documents (a task works through its rows group by group) has as many
sequences as its tokens need. Whole capacities are cut from long documents first. What is left is
assigned in descending length to the sequence of lowest cost with enough room; where none has
room, the document is cut and fills the roomiest ones. Only the last sequence of a group has padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinslot.llm.rows import slices
from coinslot.llm.words import encoder, with_end

#: Tokens per sequence, at most.
CAPACITY = 4096
#: Cost of n tokens that attend to each other: LINEAR * n + n * n, for a model of width 1024 about 12 * 1024 / 2.
LINEAR = 6144
#: Tokens that are packed together: bounds a task's memory. Padding is below one sequence in about 250.
GROUP_TOKENS = 1_000_000

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def assign(lengths: np.ndarray, capacity: int = CAPACITY, linear: int = LINEAR) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) for documents of the given lengths.

    Every token lies in one piece, offsets of a sequence have no gaps. Ties take the earlier document
    and the earlier sequence. Documents without tokens get no piece.
    """
    n_sequences = -(-int(lengths.sum()) // capacity)
    used = np.zeros(n_sequences, np.int64)
    cost = np.zeros(n_sequences, np.float64)
    pieces = []

    def put(doc: int, start: int, length: int, sequence: int) -> None:
        pieces.append((doc, start, length, sequence, int(used[sequence])))
        used[sequence] += length
        cost[sequence] += float(linear) * length + float(length) ** 2

    at, rest = 0, []
    for doc, length in enumerate(lengths.tolist()):
        whole = length // capacity
        for k in range(whole):
            put(doc, k * capacity, capacity, at)
            at += 1
        if length % capacity:
            rest.append((length % capacity, doc, whole * capacity))
    for length, doc, start in sorted(rest, key=lambda x: (-x[0], x[1])):
        room = capacity - used[at:]
        while length:
            fits = np.flatnonzero(room >= length)
            if len(fits):
                best = fits[np.argmin(cost[at:][fits])]
                part = length
            else:
                best = int(np.argmax(room))
                part = int(room[best])
            put(doc, start, part, at + int(best))
            room[best] -= part
            start, length = start + part, length - part
    return pieces


def pack(
    docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset`` and ``ids`` (little-endian uint32).

    A document is its ids and the end id, so null and empty texts are one token. Rows that repeat are
    documents of their own; a null id stays null; no rows give no pieces. Nothing is shuffled: sequence
    ids are the task's number and a running number, the same again when a task is repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        first = TaskContext.get().partitionId() << 40
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        tokens = 0
        for batch in batches:
            for part in slices(batch, "text"):
                ids, starts = with_end(*encode(part.column("text")), end_id)
                held.append((part.column("doc_id").to_pylist(), ids, starts))
                tokens += len(ids)
                if tokens >= GROUP_TOKENS:
                    out, n = packed(held, first, capacity)
                    yield out
                    held, tokens, first = [], 0, first + n
        if tokens:
            yield packed(held, first, capacity)[0]

    columns = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return columns.mapInArrow(run, PIECES)


def packed(held: list[tuple[list, np.ndarray, np.ndarray]], first: int, capacity: int) -> tuple[pa.RecordBatch, int]:
    """The pieces of a group as rows, and its number of sequences."""
    doc_ids = [i for ids, _, _ in held for i in ids]
    flat = np.concatenate([ids for _, ids, _ in held]).astype("<u4")
    lengths = np.concatenate([np.diff(starts) for _, _, starts in held])
    begins = np.cumsum(lengths) - lengths
    pieces = sorted(assign(lengths, capacity), key=lambda p: (p[3], p[4]))
    doc, start, length, sequence, offset = np.array(pieces, np.int64).T
    at = begins[doc] + start
    columns = [
        pa.array([doc_ids[d] for d in doc], pa.int64()), pa.array(start), pa.array(length), pa.array(lengths[doc]),
        pa.array(sequence + first), pa.array(offset),
        pa.array([flat[a : a + n].tobytes() for a, n in zip(at, length)], pa.binary()),
    ]
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    return pa.RecordBatch.from_arrays(columns, names=names), int(sequence.max()) + 1


def piece_checksums(pieces: DataFrame) -> DataFrame:
    """The pieces with ``ids_crc32`` (unsigned) in place of ``ids``."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
