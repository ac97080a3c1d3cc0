"""Exact duplicates by composable polynomial fingerprints, then compared chunk by chunk.

The fingerprint of a byte string b is the pair of sums b[i] * B**i over two primes. Fingerprints of
chunks combine: f(xy) = f(x) + B**len(x) * f(y), so a huge text is hashed in chunks in any order.
Rows with equal length and fingerprints are candidates; their chunks are then compared byte by byte,
and a group that holds different texts is told apart by the texts' digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinslot.llm.rows import filled, slices, text_bytes
from coinslot.session import materialise

#: Bytes per hashed chunk. A byte times a residue below 2**43, summed over a chunk, stays below 2**63.
CHUNK = 2048
#: Two primes below 2**43 and a base for each.
PRIMES = (8796093022151, 8796093022141)
BASES = (5746212308149, 2718281828459)
#: Bytes per compared chunk.
COMPARED = 65_536
#: White space that does not count. Fixed value.
WHITE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])

_POWERS = []
for _p, _b in zip(PRIMES, BASES):
    _row = [1]
    for _ in range(CHUNK - 1):
        _row.append(_row[-1] * _b % _p)
    _POWERS.append(np.array(_row, np.uint64))


def combine(left: tuple[int, int], left_bytes: int, right: tuple[int, int]) -> tuple[int, int]:
    """Fingerprint of two byte strings one after the other."""
    return tuple((x + pow(b, left_bytes, p) * y) % p for x, y, b, p in zip(left, right, BASES, PRIMES))


def fingerprints(data: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
    """Fingerprints of the byte strings ``data[bounds[k]:bounds[k + 1]]``; an empty one has (0, 0)."""
    lengths = np.diff(bounds)
    chunks = -(-lengths // CHUNK)
    starts = np.repeat(bounds[:-1], chunks) + CHUNK * (np.arange(chunks.sum()) - np.repeat(np.cumsum(chunks) - chunks, chunks))
    if not len(starts):
        return [(0, 0)] * len(lengths)
    sizes = np.diff(np.append(starts, bounds[-1]))
    inside = np.arange(bounds[-1] - bounds[0]) - np.repeat(starts - bounds[0], sizes)
    values = data[bounds[0] : bounds[-1]].astype(np.uint64) + np.uint64(1)
    sums = [
        np.add.reduceat(values * powers[inside], starts - bounds[0]) % np.uint64(p) for powers, p in zip(_POWERS, PRIMES)
    ]
    pairs, out, at = list(zip(sums[0].tolist(), sums[1].tolist())), [], 0
    for n in chunks.tolist():
        total = pairs[at] if n else (0, 0)
        for k in range(1, n):
            total = combine(total, k * CHUNK, pairs[at + k])
        out.append(total)
        at += n
    return out


def normalised(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes without white space, and where each begins (with the end)."""
    data, bounds = text_bytes(text)
    kept = ~WHITE[data]
    return data[kept], np.concatenate([[0], np.cumsum(kept)])[bounds]


def signed_rows(docs: DataFrame, id_column: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes`` (normalised), ``f1``, ``f2``, ``points`` (code points as given), ``sha``, on demand ``text``."""
    given = ["text"] if with_text else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = filled(part.column("text"))
                data, bounds = normalised(texts)
                marks = fingerprints(data, bounds)
                shas = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:])]
                columns = [
                    part.column("doc_id"), pa.array(np.diff(bounds)), pa.array([m[0] for m in marks], pa.int64()),
                    pa.array([m[1] for m in marks], pa.int64()), pc.utf8_length(texts).cast(pa.int64()), pa.array(shas),
                ]
                columns += [part.column(c) for c in given]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "f1", "f2", "points", "sha", *given])

    columns = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return columns.mapInArrow(run, ", ".join(["doc_id long, n_bytes long, f1 long, f2 long, points long, sha string", *(f"{c} string" for c in given)]))


def _chunks(members: DataFrame) -> DataFrame:
    """Normalised texts in pieces: the group's key, ``part`` and ``piece``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, bounds = normalised(filled(part.column("text")))
                rows, numbers, pieces = [], [], []
                for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                    for number, at in enumerate(range(a, b, COMPARED)):
                        rows.append(k)
                        numbers.append(number)
                        pieces.append(data[at : min(b, at + COMPARED)].tobytes())
                keys = [part.column(c).take(pa.array(rows, pa.int64())) for c in ("n_bytes", "f1", "f2")]
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array(numbers, pa.int64()), pa.array(pieces, pa.binary())],
                    names=["n_bytes", "f1", "f2", "part", "piece"],
                )

    return members.select("text", "n_bytes", "f1", "f2").mapInArrow(
        run, "n_bytes long, f1 long, f2 long, part long, piece binary"
    )


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Null text counts as empty; all texts of white space alone are equal. Of a group the row with the most
    code points stays, then the smallest doc_id (a null id last). Rows that repeat an id with an equal
    text are counted each and decided alike. No rows give no rows.

    Groups are reduced to one row per key before they meet, so a group may hold most of the table.
    """
    key = ["n_bytes", "f1", "f2"]
    rows = materialise(signed_rows(docs, id_column, text), "exact-rows")
    best = F.min(F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d")))
    reduced = [best.alias("best"), F.count("*").alias("group_size")]
    groups = rows.groupBy(*key).agg(*reduced)
    several = rows.join(groups.filter("group_size > 1 AND n_bytes > 0").select(*key), key, "left_semi").select("doc_id", *key)
    # A text is met by its own id and key only, so an id with many texts, null too, multiplies none of them.
    listed = several.distinct().select(F.col("doc_id").alias("_id"), *[F.col(c).alias(f"_{c}") for c in key])
    own = F.col("doc_id").eqNullSafe(F.col("_id"))
    for c in key:
        own = own & (F.col(c) == F.col(f"_{c}"))
    members = signed_rows(docs, id_column, text, True).select("doc_id", *key, "text").join(listed, own, "left_semi")
    differing = _chunks(members).groupBy(*key, "part").agg(F.min("piece").alias("low"), F.max("piece").alias("high"))
    mixed = materialise(differing.filter("low <> high").select(*key).distinct(), "exact-mixed")

    def decided(some: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
        return some.join(found, by).select(
            "doc_id", F.col("best.d").alias("keep_id"), "group_size",
            F.col("doc_id").eqNullSafe(F.col("best.d")).alias("kept"), F.col("sha").alias("text_sha256"),
        )

    if mixed.isEmpty():
        return decided(rows, groups, key)
    apart = rows.join(mixed, key, "left_semi")
    return decided(rows.join(mixed, key, "left_anti"), groups, key).unionByName(
        decided(apart, apart.groupBy(*key, "sha").agg(*reduced), [*key, "sha"])
    )
