"""N-gram Jaccard join: documents whose sets of word n-grams overlap by three quarters, exactly.

1. Every text becomes its set of hashed n-grams. Chunks of documents send each n-gram once, with its
   count, to the n-gram's partition, which tells the chunk how many documents hold it. N-grams that no
   other document holds are known by that, come first in the rare-first order and can match nothing.
2. A document's prefix is the shortest that any match must meet. Documents with nothing but rare
   n-grams in it are done. The others post their prefix n-grams.
3. Where many documents post one n-gram they are mostly copies of each other, so first each is only
   compared with one leader of the list, in two rounds. Links found give groups; pairs within a group
   need no more comparing.
4. Then all pairs of a list that lie in different groups pass the length, positional and suffix
   filters, inside the task that holds the list; long lists are cut into blocks. First only the most
   promising pair of any two groups is verified, which joins most groups that belong together; then
   every pair that is still between groups, once per pair on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinslot.llm.components import components
from coinslot.llm.rows import filled, release, slices, text_bytes
from coinslot.session import materialise

#: Words of an n-gram, and the similarity that links, in per cent.
WORDS, PERCENT = 5, 75
#: Text of a chunk, at most, and of one partition of n-grams, about, in bytes.
CHUNK_BYTES, PARTITION_BYTES = 4_000_000, 8_000_000
#: Partitions of the shuffle, at most; each then works through several partitions of n-grams.
SHUFFLED = 20_000
#: Documents of a chunk, at most (their numbers have 16 bits).
CHUNK_ROWS = 32_768
#: An n-gram in this many documents of a chunk keeps their numbers at the chunk.
OFTEN = 16
#: Postings of a block of a long list, and pairs that a task looks at together.
BLOCK, PAIRS = 4096, 200_000
#: Cells of the suffix filter.
CELLS = 1024
LEADER_ROUNDS = 2

_LOW = np.uint64((1 << 40) - 1)
_WEIGHTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_WHITE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += 32


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, bounds: np.ndarray, window: int = 1_000_000) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word (A-Z lower-cased), and the words per text. Long texts go window by window."""
    solid = ~_WHITE[data]
    starts_text = np.zeros(len(data) + 1, bool)
    starts_text[bounds] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | starts_text[1:-1]
    begins = np.flatnonzero(first)
    last = solid
    last[:-1] &= ~solid[1:] | starts_text[1:-1]
    ends = np.flatnonzero(last) + 1
    hashes = np.empty(len(begins), np.uint64)
    at = 0
    while at < len(begins):
        stop = max(at + 1, int(np.searchsorted(ends, begins[at] + window, side="right")))
        a, b = begins[at:stop], ends[at:stop]
        lengths = b - a
        offsets = np.cumsum(lengths) - lengths
        place = np.arange(lengths.sum()) - np.repeat(offsets, lengths)
        letters = _FOLD[data[np.repeat(a, lengths) + place]]
        cells = _mixed(letters + (place.astype(np.uint64) << np.uint64(8)) + np.uint64(1))
        hashes[at:stop] = _mixed(np.add.reduceat(cells, offsets) + lengths.astype(np.uint64))
        at = stop
    return hashes, np.diff(np.searchsorted(begins, bounds))


def shingles(hashes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts, and the text of each, in text order. Texts with fewer words have one."""
    text_of = np.repeat(np.arange(len(words)), words)
    found, owners = [], []
    if len(hashes) >= WORDS:
        span = len(hashes) - WORDS + 1
        code = np.zeros(span, np.uint64)
        for k in range(WORDS):
            code += hashes[k : k + span] * _WEIGHTS[k]
        whole = text_of[:span] == text_of[WORDS - 1 :]
        found.append(_mixed(code[whole]))
        owners.append(text_of[:span][whole])
    short = np.flatnonzero((words > 0) & (words < WORDS))
    firsts = np.cumsum(words) - words
    for k in short:
        some = hashes[firsts[k] : firsts[k] + words[k]]
        found.append(_mixed((some * _WEIGHTS[: len(some)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(some))))
        owners.append(np.array([k]))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    codes, owner = np.concatenate(found), np.concatenate(owners)
    if len(short):
        order = np.argsort(owner, kind="stable")
        codes, owner = codes[order], owner[order]
    return codes, owner


SENT = "p int, chunk long, low binary, counts binary, numbers binary, ids binary, sizes binary, marks binary, often binary"


def _sent(docs: DataFrame, partitions: int) -> DataFrame:
    """Per chunk: its distinct n-grams by partition, and a row that describes its documents (p of its own choice)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                for part in slices(batch.slice(at, CHUNK_ROWS), "text", CHUNK_BYTES):
                    yield _chunk_rows(part, chunk, partitions)
                    chunk += 1

    return docs.mapInArrow(run, SENT)


def _chunk_rows(part: pa.RecordBatch, chunk: int, partitions: int) -> pa.RecordBatch:
    ids = part.column("doc_id")
    codes, owner = shingles(*word_hashes(*text_bytes(filled(part.column("text")))))
    n = part.num_rows
    # A mark of each text's whole list of n-grams, to fold copies before anything is sent.
    bounds = np.searchsorted(owner, np.arange(n + 1))
    some = np.flatnonzero(np.diff(bounds))
    marks = np.zeros((n, 2), np.uint64)
    for column, salt in enumerate((0x1234567, 0x89ABCDE)):
        if len(some):
            marks[some, column] = np.add.reduceat(_mixed(codes + np.uint64(salt)), bounds[some])
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    _, first = np.unique(np.rec.fromarrays([marks[:, 0], marks[:, 1], np.diff(bounds), ~known]), return_index=True)
    speaks = np.zeros(n, bool)
    speaks[first] = True
    speaks &= known
    kept = speaks[owner]
    codes, owner = codes[kept], owner[kept]
    keys = ((codes >> np.uint64(40)) % np.uint64(partitions) << np.uint64(40)) | (codes & _LOW)
    order = np.argsort(keys)
    keys, owner = keys[order], owner[order]
    same = np.flatnonzero(keys[1:] == keys[:-1])
    if len(same):
        # Only runs of one key need their owners in order.
        runs = np.unique(np.concatenate([same, same + 1]))
        owner[runs] = owner[runs][np.lexsort((owner[runs], keys[runs]))]
    once = np.ones(len(keys), bool)
    once[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    keys, owner = keys[once], owner[once]
    sizes = np.bincount(owner, minlength=n).astype(np.int64)
    # Copies within the chunk have the size of the one that speaks for them.
    by_mark = {tuple(marks[k].tolist()): k for k in np.flatnonzero(speaks)}
    for k in np.flatnonzero(~speaks & (np.diff(bounds) > 0)):
        speaker = by_mark.get(tuple(marks[k].tolist()))
        sizes[k] = sizes[speaker] if speaker is not None else len(np.unique(codes_of(part, k)))
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    counts = np.diff(np.append(firsts, len(keys)))
    distinct = keys[firsts]
    often = counts >= OFTEN
    repeated = np.repeat(often, counts)
    hot = b"".join(
        keys[a : a + c].astype("<u8").tobytes() for a, c in zip(firsts[often].tolist(), counts[often].tolist())
    ) + owner[repeated].astype("<u2").tobytes()
    cuts = np.searchsorted(distinct >> np.uint64(40), np.arange(partitions + 1))
    numbers = owner.astype("<u2")
    ends = np.cumsum(np.where(often, 0, counts))
    numbers = numbers[~repeated]
    low = (distinct & _LOW).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    rows = {name: [] for name in ("p", "low", "counts", "numbers")}
    for p in np.flatnonzero(np.diff(cuts)):
        a, b = cuts[p], cuts[p + 1]
        rows["p"].append(int(p))
        rows["low"].append(np.ascontiguousarray(low[a:b]).tobytes())
        rows["counts"].append(counts[a:b].astype("<u4").tobytes())
        rows["numbers"].append(numbers[ends[a - 1] if a else 0 : ends[b - 1]].tobytes())
    m = len(rows["p"])
    none = [None] * m
    return pa.RecordBatch.from_arrays(
        [
            pa.array([*rows["p"], chunk % partitions], pa.int32()), pa.array([chunk] * (m + 1), pa.int64()),
            *[pa.array([*rows[c], None], pa.binary()) for c in ("low", "counts", "numbers")],
            pa.array([*none, pa_bytes(ids)], pa.binary()), pa.array([*none, sizes.astype("<i8").tobytes()], pa.binary()),
            pa.array([*none, marks.astype("<u8").tobytes()], pa.binary()), pa.array([*none, hot], pa.binary()),
        ],
        names=["p", "chunk", "low", "counts", "numbers", "ids", "sizes", "marks", "often"],
    )


def codes_of(part: pa.RecordBatch, k: int) -> np.ndarray:
    return shingles(*word_hashes(*text_bytes(filled(part.column("text").slice(k, 1)))))[0]


def pa_bytes(ids: pa.Array) -> bytes:
    """Ids and, after them, which are null."""
    values = np.array([0 if i is None else i for i in ids.to_pylist()], "<i8")
    return values.tobytes() + np.array([i is None for i in ids.to_pylist()], np.uint8).tobytes()


def _keys(low: bytes, p: int) -> np.ndarray:
    wide = np.zeros((len(low) // 5, 8), np.uint8)
    wide[:, :5] = np.frombuffer(low, np.uint8).reshape(-1, 5)
    return wide.view("<u8").ravel().astype(np.uint64) | np.uint64(p << 40)


def _told(sent: DataFrame, partitions: int) -> DataFrame:
    """What each partition of n-grams tells each chunk: those of its n-grams that two documents or more hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by p: one partition of n-grams is held at a time.
        held: list[pa.RecordBatch] = []
        for batch in batches:
            numbers = batch.column("p").to_numpy()
            for p in np.unique(numbers).tolist():
                if held and held[0].column("p")[0].as_py() != p:
                    yield from told(held[0].column("p")[0].as_py(), pa.Table.from_batches(held)).to_batches()
                    held = []
                a, b = np.searchsorted(numbers, [p, p + 1])
                held.append(batch.slice(a, b - a))
        if held:
            yield from told(held[0].column("p")[0].as_py(), pa.Table.from_batches(held)).to_batches()
        held = []
        release()

    def told(p: int, rows: pa.Table) -> pa.Table:
        own = rows.filter(rows.column("low").is_valid())
        passed = rows.filter(rows.column("ids").is_valid())
        passed = passed.append_column("df", pa.nulls(passed.num_rows, pa.binary()))
        passed = passed.select([c for c in TOLD_NAMES])
        if not own.num_rows:
            return passed
        keys = [_keys(b, p) for b in own.column("low").to_pylist()]
        counts = [np.frombuffer(b, "<u4").astype(np.int64) for b in own.column("counts").to_pylist()]
        everything = np.concatenate(keys)
        order = np.argsort(everything)
        firsts = np.flatnonzero(np.concatenate([[True], everything[order][1:] != everything[order][:-1]]))
        totals = np.add.reduceat(np.concatenate(counts)[order], firsts)
        df = np.empty(len(everything), np.int64)
        df[order] = np.repeat(totals, np.diff(np.append(firsts, len(everything))))
        out = {c: [] for c in ("chunk", "low", "counts", "numbers", "df")}
        at = 0
        for chunk, low, count, numbers in zip(
            own.column("chunk").to_pylist(), own.column("low").to_pylist(), counts, own.column("numbers").to_pylist()
        ):
            mine = df[at : at + len(count)]
            at += len(count)
            shared = mine >= 2
            if not shared.any():
                continue
            out["chunk"].append(chunk)
            out["low"].append(np.frombuffer(low, np.uint8).reshape(-1, 5)[shared].tobytes())
            out["counts"].append(count[shared].astype("<u4").tobytes())
            carried = np.where(count < OFTEN, count, 0)
            out["numbers"].append(np.frombuffer(numbers, "<u2")[np.repeat(shared, carried)].tobytes())
            out["df"].append(mine[shared].astype("<u4").tobytes())
        m = len(out["chunk"])
        found = pa.table({
            "p": pa.array([p] * m, pa.int32()), "chunk": pa.array(out["chunk"], pa.int64()),
            **{c: pa.array(out[c], pa.binary()) for c in ("low", "counts", "numbers")},
            **{c: pa.nulls(m, pa.binary()) for c in ("ids", "sizes", "marks", "often")},
            "df": pa.array(out["df"], pa.binary()),
        })
        return pa.concat_tables([passed.cast(found.schema), found])

    # Partitions of n-grams go to those of the shuffle in turn: a hash of the number would put several into one.
    n = min(partitions, SHUFFLED)
    placed = sent.repartitionById(n, F.col("p") % n).sortWithinPartitions("p")
    return placed.mapInArrow(run, SENT + ", df binary")


TOLD_NAMES = ("p", "chunk", "low", "counts", "numbers", "ids", "sizes", "marks", "often", "df")
SETS = "doc_id long, n_shingles long, m1 long, m2 long, shared int, prefix binary, held binary, cells binary"


def _sets(told: DataFrame, chunks: int) -> DataFrame:
    """One row per document: its size, mark, and, if it can match anything, its prefix and shared n-grams."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        release()
        about = rows.filter(rows.column("ids").is_valid()).to_pylist()[0]
        sizes = np.frombuffer(about["sizes"], "<i8")
        n = len(sizes)
        ids = np.frombuffer(about["ids"][: 8 * n], "<i8")
        null = np.frombuffer(about["ids"][8 * n :], np.uint8).astype(bool)
        marks = np.frombuffer(about["marks"], "<u8").reshape(n, 2).astype(np.int64)
        hot_n = len(about["often"]) // 10
        hot_keys, hot_numbers = np.frombuffer(about["often"][: 8 * hot_n], "<u8"), np.frombuffer(about["often"][8 * hot_n :], "<u2")
        keys, dfs, numbers = [], [], []
        for row in rows.filter(rows.column("low").is_valid()).to_pylist():
            mine, df = _keys(row["low"], row["p"]), np.frombuffer(row["df"], "<u4").astype(np.int64)
            count = np.frombuffer(row["counts"], "<u4").astype(np.int64)
            few = np.where(count < OFTEN, count, 0)
            keys.append(np.repeat(mine, few))
            dfs.append(np.repeat(df, few))
            numbers.append(np.frombuffer(row["numbers"], "<u2"))
            many = np.flatnonzero(count >= OFTEN)
            if len(many):
                a = np.searchsorted(hot_keys, mine[many])
                where = np.repeat(a - (np.cumsum(count[many]) - count[many]), count[many]) + np.arange(count[many].sum())
                keys.append(hot_keys[where])
                dfs.append(np.repeat(df[many], count[many]))
                numbers.append(hot_numbers[where])
        prefix, held, cells, shared = [None] * n, [None] * n, [None] * n, np.zeros(n, np.int64)
        if keys:
            key_, df_, number = np.concatenate(keys), np.concatenate(dfs), np.concatenate(numbers).astype(np.int64)
            shared = np.bincount(number, minlength=n)
            # The shared n-grams follow the others; those within the first size - ceil(0.75 size) + 1 are prefix.
            reach = np.maximum(sizes - -(-PERCENT * sizes // 100) + 1 - (sizes - shared), 0)
            able = reach[number] > 0
            key_, df_, number = key_[able], df_[able], number[able]
            order = np.lexsort((key_, df_, number))
            key_, number = key_[order], number[order]
            bounds = np.searchsorted(number, np.arange(n + 1))
            for k in np.flatnonzero(np.diff(bounds)):
                mine = key_[bounds[k] : bounds[k + 1]]
                prefix[k] = mine[: reach[k]].astype("<u8").tobytes()
                held[k] = np.sort(mine).astype("<u8").tobytes()
                cells[k] = np.packbits(np.bincount((_mixed(mine) % np.uint64(CELLS)).astype(np.int64), minlength=CELLS) & 1).tobytes()
        return pa.table({
            "doc_id": pa.array(ids, pa.int64(), mask=null), "n_shingles": pa.array(sizes, pa.int64()),
            "m1": pa.array(marks[:, 0], pa.int64(), mask=null | (sizes == 0)), "m2": pa.array(marks[:, 1], pa.int64()),
            "shared": pa.array(shared, pa.int32()), "prefix": pa.array(prefix, pa.binary()),
            "held": pa.array(held, pa.binary()), "cells": pa.array(cells, pa.binary()),
        })

    return told.repartition(chunks, "chunk").groupBy("chunk").applyInArrow(run, SETS)


POSTINGS = "token long, doc long, n long, own long, pos long"


def _postings(sets: DataFrame) -> DataFrame:
    """A row per document and prefix n-gram: its place in the order, and how many unshared n-grams come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [np.frombuffer(b, "<u8").astype(np.int64) for b in batch.column("prefix").to_pylist()]
            counts = np.array([len(t) for t in tokens], np.int64)
            doc, n, shared = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64), counts) for c in ("doc_id", "n_shingles", "shared"))
            place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            flat = np.concatenate(tokens) if tokens else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (flat, doc, n, n - shared, n - shared + place)], names=["token", "doc", "n", "own", "pos"]
            )

    return sets.select("doc_id", "n_shingles", "shared", "prefix").mapInArrow(run, POSTINGS)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The distinct pairs (u, v) whose sets overlap enough: by the suffix filter first, then by the whole sets."""
    of = sets.filter("held IS NOT NULL").select("doc_id", "n_shingles", "shared", "cells", "held")

    def side(name: str, *columns: str) -> DataFrame:
        return of.select(F.col("doc_id").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in columns])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b, n, m in zip(*(batch.column(c).to_pylist() for c in ("u_held", "v_held", "u_n_shingles", "v_n_shingles"))):
                common = len(np.intersect1d(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"), assume_unique=True))
                keep.append(100 * common >= PERCENT * (n + m - common))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (_cells(batch.column(f"{s}_cells")) for s in "uv")
                n, r = ([batch.column(f"{s}_{c}").to_numpy(zero_copy_only=False).astype(np.int64) for s in "uv"] for c in ("n_shingles", "shared"))
                possible = r[0] + r[1] - _apart(x, y) >= 2 * _needed(n[0], n[1])
                yield batch.select(["u", "v"]).filter(pa.array(possible))

    filtered = ("n_shingles", "shared", "cells")
    some = pairs.distinct().join(side("u", *filtered), "u").join(side("v", *filtered), "v").mapInArrow(near, "u long, v long")
    whole = some.join(side("u", "n_shingles", "held"), "u").join(side("v", "n_shingles", "held"), "v")
    return whole.mapInArrow(linked, "u long, v long")


def _cells(column: pa.Array) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint64).reshape(len(column), CELLS // 64)


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Suffix filter: cells that hold an odd number of n-grams in one document only; as many differ at least."""
    return np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)


def _needed(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Common n-grams that link sets of these sizes, at least."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def _candidates(lists: DataFrame, best: bool = False) -> DataFrame:
    """Pairs (u, v) of different groups within a list or pair of blocks, after length, positional and suffix filter.

    ``best``: of the pairs between two groups that a task looks at together only the one of least distance, for
    its size. ``lists`` comes sorted by ``token, low, high``; a list's rows, at most two blocks, are held together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < 2 * BLOCK:
                continue
            table = pa.Table.from_batches(held)
            last = _same_as_last(table)
            if last > 0:
                yield from _pairs_of(table.slice(0, last), best)
                held, rows = table.slice(last).to_batches(), table.num_rows - last
        if rows:
            yield from _pairs_of(pa.Table.from_batches(held), best)

    return lists.mapInArrow(run, "u long, v long")


def _columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(c).to_numpy().astype(np.int64) for c in names]


def _same_as_last(table: pa.Table) -> int:
    """Where the last list of the table begins."""
    token, low, high = _columns(table, "token", "low", "high")
    other = np.flatnonzero((token != token[-1]) | (low != low[-1]) | (high != high[-1]))
    return int(other[-1]) + 1 if len(other) else 0


def _pairs_of(table: pa.Table, best: bool) -> Iterator[pa.RecordBatch]:
    token, low, high, block, doc, n, own, pos, group = _columns(table, "token", "low", "high", "block", "doc", "n", "own", "pos", "grp")
    cells = _cells(table.column("cells").combine_chunks())
    order = np.lexsort((group, block, high, low, token))
    token, low, high, block, doc, n, own, pos, group = (x[order] for x in (token, low, high, block, doc, n, own, pos, group))
    cells = cells[order]
    new = np.ones(len(token) + 1, bool)
    new[1:-1] = (token[1:] != token[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    starts = np.flatnonzero(new)
    list_end = np.repeat(starts[1:], np.diff(starts))
    # Rows of one block meet those of later groups; rows of two blocks meet the whole other block.
    turn = np.ones(len(token) + 1, bool)
    turn[1:-1] = new[1:-1] | (block[1:] != block[:-1])
    at = np.flatnonzero(turn)
    block_end = np.repeat(at[1:], np.diff(at))
    change = np.ones(len(token) + 1, bool)
    change[1:-1] = turn[1:-1] | (group[1:] != group[:-1])
    at = np.flatnonzero(change)
    group_end = np.repeat(at[1:], np.diff(at))
    begin = np.where(low == high, group_end, block_end)
    count = list_end - begin
    ends = np.cumsum(count)
    row = 0
    while row < len(token):
        stop = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + PAIRS, side="right")))
        some = count[row:stop]
        x = np.repeat(np.arange(row, stop), some)
        y = np.repeat(begin[row:stop] - (np.cumsum(some) - some), some) + np.arange(some.sum())
        row = stop
        possible = (100 * np.minimum(n[x], n[y]) >= PERCENT * np.maximum(n[x], n[y])) & (group[x] != group[y])
        x, y = x[possible], y[possible]
        needed = _needed(n[x], n[y])
        before = np.minimum(pos[x] - own[x], pos[y] - own[y])
        after = np.minimum(n[x] - pos[x], n[y] - pos[y])
        possible = before + after >= needed
        x, y, needed = x[possible], y[possible], needed[possible]
        shared = n[x] - own[x] + n[y] - own[y]
        spare = np.empty(len(x), np.int64)
        for k in range(0, len(x), 50_000):
            spare[k : k + 50_000] = shared[k : k + 50_000] - _apart(cells[x[k : k + 50_000]], cells[y[k : k + 50_000]])
        possible = spare >= 2 * needed
        if best:
            x, y, worth = x[possible], y[possible], (spare / needed)[possible]
            a, b = np.minimum(group[x], group[y]), np.maximum(group[x], group[y])
            order = np.lexsort((-worth, b, a))
            head = np.ones(len(order), bool)
            head[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
            x, y = x[order[head]], y[order[head]]
            possible = np.ones(len(x), bool)
        u, v = np.minimum(doc[x], doc[y])[possible], np.maximum(doc[x], doc[y])[possible]
        if len(u):
            pairs = np.unique(np.stack([u, v]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["u", "v"])


def _with_group(rows: DataFrame, groups: DataFrame | None) -> DataFrame:
    if groups is None:
        return rows.withColumn("grp", F.col("doc"))
    found = groups.select(F.col("id").alias("doc"), "component")
    return rows.join(found, "doc", "left").withColumn("grp", F.coalesce("component", "doc")).drop("component")


def _leader_pairs(postings: DataFrame, turn: int) -> DataFrame:
    """Each posting with its list's leader, unless they are in one group or too unequal in size."""
    leader = F.min(F.struct(F.xxhash64("doc", F.lit(turn)).alias("h"), F.col("doc").alias("d"), F.col("n").alias("m"), F.col("grp").alias("g")))
    lists = postings.groupBy("token").agg(leader.alias("l"), F.min("grp").alias("a"), F.max("grp").alias("b")).filter("a <> b")
    pairs = postings.join(lists.select("token", "l.*"), "token").filter("grp <> g")
    fits = pairs.filter(F.lit(100) * F.least("n", "m") >= F.lit(PERCENT) * F.greatest("n", "m"))
    return fits.select(F.least("doc", "d").alias("u"), F.greatest("doc", "d").alias("v")).distinct()


def _lists(postings: DataFrame, sets: DataFrame) -> DataFrame:
    """Postings of lists with more than one group, long lists as pairs of blocks, sorted for ``_candidates``."""
    lists = postings.groupBy("token").agg(F.count("*").alias("c"), F.min("grp").alias("a"), F.max("grp").alias("b")).filter("a <> b")
    blocks = F.ceil(F.col("c") / BLOCK).cast("long")
    rows = postings.join(lists.select("token", blocks.alias("blocks")), "token")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "blocks")
    cells = sets.filter("cells IS NOT NULL").select(F.col("doc_id").alias("doc"), "cells")
    placed = rows.join(cells, "doc").repartition("token", "low", "high")
    return placed.sortWithinPartitions("token", "low", "high")


def jaccard_components(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles`` and ``component_id``, the smallest id reachable by links.

    A text of fewer than five words has one n-gram, one without words none; null counts as empty. Sets
    without n-grams link to nothing. A null id links to nothing and has a null component. Rows that repeat
    an id are one vertex with all its rows' links. No rows give no rows.

    N-grams are compared by 46 to 63 bits of a hash; a set's order and links depend on no other rows.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    size = given.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(parallel, size // PARTITION_BYTES + 1)
    told = _told(_sent(given, partitions), partitions)
    sets = materialise(_sets(told, max(parallel, size // CHUNK_BYTES + 1)), "jaccard-sets")

    mark = ["m1", "m2", "n_shingles"]
    marked = sets.filter("m1 IS NOT NULL").select("doc_id", *mark, F.col("prefix").isNull().alias("idle"))
    same = marked.groupBy(*mark).agg(
        F.min("doc_id").alias("first"), F.min(F.struct("idle", "doc_id")).alias("speaker"), F.count("*").alias("copies")
    )
    copies = marked.join(same.filter("copies > 1"), mark).filter("doc_id <> first").select(F.col("doc_id").alias("u"), F.col("first").alias("v"))
    links = materialise(copies, "jaccard-links")
    speakers = same.filter("NOT speaker.idle").select(F.col("speaker.doc_id").alias("doc_id"))
    speaking = sets.filter("prefix IS NOT NULL").join(speakers, "doc_id", "left_semi")
    postings = materialise(_postings(speaking), "jaccard-postings")

    groups = None
    for turn in range(LEADER_ROUNDS):
        found = materialise(_verified(_leader_pairs(_with_group(postings, groups), turn), sets), "jaccard-links")
        links = links.unionByName(found)
        groups = components(links)
    for best in (True, False):
        grouped = materialise(_with_group(postings, groups), "jaccard-grouped")
        found = materialise(_verified(_candidates(_lists(grouped, sets), best), sets), "jaccard-links")
        links = links.unionByName(found)
        groups = components(links)
    result = sets.select("doc_id", "n_shingles").join(groups.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return result.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
