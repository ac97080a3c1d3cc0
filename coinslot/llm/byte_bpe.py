"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Texts are encoded match by match of the splitting pattern, without special tokens. A long text is
cut first, at places where the pattern cuts anyway: after a printable ASCII character or a letter
and before ASCII white space no match goes on. Ids decode to raw bytes, which need not be UTF-8.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinslot.llm.rows import filled, slices

#: Characters of a text that go to the library at once.
CUT_CHARS = 65_536
#: White space of the pattern's \s; longer runs are one match each and skip the pattern. Fixed value.
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_SPACES = re.compile(f"[{SPACES}]{{4096,}}")
SAFE = re.compile(r"(?<=[!-~\u00df-\u00f6])(?=[ \n\r\t])")


@functools.lru_cache(maxsize=2)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The worker's encoder: loaded once per Python worker. Each line of the file: base64 bytes, rank."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def cuts(text: str, limit: int = CUT_CHARS) -> Iterator[str]:
    """The text in parts of about ``limit`` characters that encode to the same ids as the whole.

    A part is longer where no safe place comes: then it is a single match of the pattern, or nearly.
    """
    at = 0
    while len(text) - at > limit:
        found = SAFE.search(text, at + limit)
        if not found:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def encode_text(enc: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of a whole text as uint32."""
    if len(text) <= CUT_CHARS:
        return enc.encode_to_numpy(text, allowed_special=set(), disallowed_special=())
    parts, at = [], 0
    for run in LONG_SPACES.finditer(text):
        # A run before other text leaves its last character to the next match.
        stop = run.end() if run.end() == len(text) else run.end() - 1
        parts += [encode_part(enc, part) for part in cuts(text[at : run.start()])]
        parts.append(np.array(enc._core_bpe.encode_single_piece(text[run.start() : stop].encode()), np.uint32))
        at = stop
    parts += [encode_part(enc, part) for part in cuts(text[at:])]
    return np.concatenate(parts).astype(np.uint32)


def encode_part(enc: tiktoken.Encoding, part: str) -> np.ndarray:
    return np.asarray(enc.encode_to_numpy(part, allowed_special=set(), disallowed_special=()), np.uint32)


def encode_documents(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_tokens`` and ``ids`` (little-endian uint32, binary).

    Null and empty texts have no ids. Rows that repeat stay; a null id stays null. Other columns are
    not read, so their names cannot clash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = [encode_text(enc, t) for t in filled(part.column("text")).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(i) for i in ids], pa.int64()),
                        pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()),
                    ],
                    names=["doc_id", "n_tokens", "ids"],
                )

    columns = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return columns.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """The rows of ``encode_documents`` with ``decoded``, the raw bytes of the ids; null ids decode to nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for batch in batches:
            texts = [enc.decode_bytes(np.frombuffer(ids or b"", "<u4").tolist()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded binary")
