"""Periodic runs of words: stretches that repeat themselves at least twice, with their smallest period.

A run with period q is at least 2q long, so every word of it occurs twice in it. A word that occurs once
in the current segment of a text therefore belongs to no run and splits the segment; the parts are split
again until nothing changes, and parts too short for a run fall away. What survives is scanned by lags.

The scan takes short lags one by one. Lags from s to 2s, s a power of two, are taken together: words that equal
those q further on form a stretch of at least s places, which holds a whole block of s/2 words at a
multiple of s/2. Only such blocks are compared, by hash, with what lies s to 2s further; hits are then
measured word by word. A scan of n words compares about 2n hashes for each doubling of the lag.
All segments of many texts are scanned at once: their words are numbered apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinslot.llm.rows import filled, slices

#: Words in a run at least; and lags below this are scanned one by one.
LEAST, DIRECT = 12, 8
#: Bytes of text worked on at once; a longer single text is worked on alone. Hash comparisons made at once.
SLICE, COMPARED = 2_000_000, 1 << 20

RUNS = "array<struct<start:long,length:long,period:long>>"

_M = np.uint64(0x9E3779B97F4A7C15)
_K = np.uint64(0xBF58476D1CE4E5B9)


def split_rare(codes: np.ndarray, texts: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Places that survive the splitting, and the segment of each; ``texts`` numbers the text of every word."""
    at = np.arange(len(codes))
    segment = texts
    words = int(codes.max(initial=0)) + 1
    while len(at):
        # Parts are numbered anew: a gap in the places or another text begins one.
        fresh = np.ones(len(at), bool)
        fresh[1:] = (np.diff(at) > 1) | (np.diff(segment) != 0)
        segment = np.cumsum(fresh) - 1
        long = np.bincount(segment) >= least
        keep = long[segment]
        at, segment = at[keep], segment[keep]
        if not len(at):
            break
        keys = segment * words + codes[at]
        _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
        often = counts[which] > 1
        if often.all():
            return at, segment
        at, segment = at[often], segment[often]
    return at, segment[: len(at)]


def equal_stretches(codes: np.ndarray, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """All maximal stretches of at least ``least`` places whose words equal those ``lag`` further on."""
    same = np.zeros(max(0, len(codes) - lag) + 2, np.int8)
    same[1:-1] = codes[: len(codes) - lag] == codes[lag:] if len(codes) > lag else 0
    turns = np.diff(same)
    begin, end = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    long = end - begin >= least
    return begin[long], end[long]


def scan_lags(codes: np.ndarray, lengths: np.ndarray, least: int = LEAST) -> np.ndarray:
    """All runs, as rows of (start, length, period), of segments that lie one behind the other.

    Words of different segments have different numbers, so no run crosses a border.
    """
    runs = [np.empty((0, 3), np.int64)]
    for lag in range(1, DIRECT):
        begin, end = equal_stretches(codes, lag, max(least - lag, lag))
        runs.append(np.stack([begin, end - begin + lag, np.full(len(begin), lag)], 1))
    place = np.arange(len(codes))
    size, lag = lengths, DIRECT
    while len(size := size[size >= 2 * lag]):
        # Only segments that can hold a run of such a period are scanned further.
        wide = lengths >= 2 * lag
        keep = np.repeat(wide, lengths)
        codes, place, lengths = codes[keep], place[keep], lengths[wide]
        known = np.concatenate(runs)
        runs.append(_scan_band(codes, place, lag, least, known))
        lag *= 2
    found = np.concatenate(runs)
    # A stretch found with a multiple of its smallest period has the same borders.
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    first = np.ones(len(found), bool)
    first[1:] = (np.diff(found[:, 0]) != 0) | (np.diff(found[:, 1]) != 0)
    return found[first]


def _hashes(codes: np.ndarray, words: int) -> np.ndarray:
    """A hash of the ``words`` words from every place on; ``words`` is a power of two."""
    h = (codes.astype(np.uint64) + np.uint64(1)) * _M
    h ^= h >> np.uint64(29)
    width = 1
    while width < words:
        # Behind the end there are no words; such places are never compared.
        h = h[:-width] * _K + h[width:]
        h ^= h >> np.uint64(31)
        width *= 2
    return h


def _scan_band(codes: np.ndarray, place: np.ndarray, lag: int, least: int, known: np.ndarray) -> np.ndarray:
    """Runs with periods from ``lag`` to twice that, exclusive."""
    block = lag // 2
    hashes = _hashes(codes, block)
    anchors = np.arange(0, len(hashes), block)
    anchors = anchors[anchors + lag < len(hashes)]
    inside = _inside(known, place, lag + block)
    hits = []
    step = max(1, COMPARED // lag)
    for at in range(0, len(anchors), step):
        here = anchors[at : at + step]
        there = here[:, None] + np.arange(lag, 2 * lag)
        match = hashes[np.minimum(there, len(hashes) - 1)] == hashes[here][:, None]
        match &= there < len(hashes)
        row, column = np.nonzero(match)
        where, lags = here[row], column + lag
        covered = np.zeros(len(where), bool)
        for begin, end, period in inside:
            # What lies in a run whose period divides the lag has that run's borders.
            low, high = np.searchsorted(where, (begin, end))
            if low < high:
                covered[low:high] |= (where[low:high] + lags[low:high] + block <= end) & (lags[low:high] % period == 0)
        where, lags = where[~covered], lags[~covered]
        hits.append(np.stack([lags, where], 1))
    hits = np.concatenate(hits) if hits else np.empty((0, 2), np.int64)
    if not len(hits):
        return np.empty((0, 3), np.int64)
    hits = hits[np.lexsort((hits[:, 1], hits[:, 0]))]
    # Neighbouring blocks of one lag belong to one stretch.
    fresh = np.ones(len(hits), bool)
    fresh[1:] = (np.diff(hits[:, 0]) != 0) | (np.diff(hits[:, 1]) != block)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(hits)) - 1
    runs = []
    for (q, begin), end in zip(hits[first].tolist(), (hits[last, 1] + block).tolist()):
        low, high = max(0, begin - block), min(len(codes) - q, end + block)
        same = codes[low:high] == codes[low + q : high + q]
        if not same[begin - low : end - low].all():
            # Equal hashes of different words: each stretch of equal words stands for itself.
            begins, ends = _stretches(same)
        else:
            miss = np.flatnonzero(~same[: begin - low])
            start = int(miss[-1]) + 1 if len(miss) else 0
            miss = np.flatnonzero(~same[end - low :])
            stop = end - low + int(miss[0]) if len(miss) else len(same)
            begins, ends = [start], [stop]
        for start, stop in zip(begins, ends):
            if stop - start >= max(least - q, q):
                runs.append((int(place[low + start]), stop - start + q, q))
    return np.unique(np.array(runs, np.int64).reshape(-1, 3), axis=0)


def _stretches(same: np.ndarray) -> tuple[list[int], list[int]]:
    turns = np.diff(np.concatenate([[0], same.astype(np.int8), [0]]))
    return np.flatnonzero(turns == 1).tolist(), np.flatnonzero(turns == -1).tolist()


def _inside(known: np.ndarray, place: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Begin, end and period of the known runs of at least ``least`` words, by their present places."""
    known = known[known[:, 1] >= least]
    begin = np.minimum(np.searchsorted(place, known[:, 0]), len(place) - 1)
    # Runs of segments that are scanned no further lie nowhere.
    present = place[begin] == known[:, 0]
    known, begin = known[present], begin[present]
    return sorted(zip(begin.tolist(), (begin + known[:, 1]).tolist(), known[:, 2].tolist()))


def word_lists(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another, and how many each text has. Null: none."""
    split = pc.ascii_split_whitespace(filled(text))
    words = split.flatten()
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    return words.filter(pa.array(full)), np.bincount(owner[full], minlength=len(split))


def find_runs(words: pa.Array, counts: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Runs in all texts as rows of (start, length, period), by text, start and period, and the text of each row."""
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    texts = np.repeat(np.arange(len(counts)), counts)
    begins = np.cumsum(counts) - counts
    at, segment = split_rare(codes, texts, least)
    if not len(at):
        return np.empty((0, 3), np.int64), np.empty(0, np.int64)
    _, apart = np.unique(segment * (int(codes.max()) + 1) + codes[at], return_inverse=True)
    _, lengths = np.unique(segment, return_counts=True)
    runs = scan_lags(apart, lengths, least)
    start = at[runs[:, 0]]
    owner = texts[start]
    runs = np.stack([start - begins[owner], runs[:, 1], runs[:, 2]], 1)
    order = np.lexsort((runs[:, 2], runs[:, 0], owner))
    return runs[order], owner[order]


def periodic_runs(docs: DataFrame, least: int = LEAST, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``runs`` (by start, then period) and the ``collapsed`` text.

    Words are what stands between ASCII white space, numbered from 0. A run has ``least`` words or more and at
    least two periods, and cannot be extended. ``collapsed`` has, joined by one space, the words that
    are in no run or among some run's first period and in no other run behind that.

    Null, empty and white texts have no words: no runs and an empty ``collapsed``. Rows that repeat stay,
    a null id stays null, no rows give none. Other columns are not read, so their names cannot clash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words, counts = word_lists(part.column("text"))
                runs, owner = find_runs(words, counts, least)
                ends = np.concatenate([[0], np.cumsum(counts)])
                # Words behind the first period of a run are dropped.
                first = ends[owner] + runs[:, 0]
                depth = np.zeros(len(words) + 1, np.int64)
                np.add.at(depth, first + runs[:, 2], 1)
                np.add.at(depth, first + runs[:, 1], -1)
                kept = np.cumsum(depth)[:-1] == 0
                bounds = np.concatenate([[0], np.cumsum(kept)])[ends]
                lists = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), words.filter(pa.array(kept)))
                of_row = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(part)))])
                listed = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in range(3)], names=["start", "length", "period"])
                columns = [
                    part.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(of_row, pa.int32()), listed),
                    pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "runs", "collapsed"])

    columns = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return columns.mapInArrow(run, f"doc_id long, runs {RUNS}, collapsed string")


def longest_run(runs: Column) -> Column:
    """The run of greatest length; of equals the smallest start, then period. Null without runs."""
    key = F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    best = F.array_min(key)
    return F.when(
        F.size(runs) > 0, F.struct(best["s"].alias("start"), (-best["l"]).alias("length"), best["p"].alias("period"))
    )


def planted(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Id and text, with the words of every tenth document (by crc32 of its id) going on in circles from some place.

    With h that checksum, g = h div 10 and n words: word i from a = g mod n on becomes word
    a + (i - a) mod p, where p = 1 + (n - a) div (3 + g mod 8). Rows without id or words stay as they are.
    """
    number = F.col(id_column).cast("long")
    h = F.crc32(number.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")
    rows = docs.select(number.alias("doc_id"), F.col(text).cast("string").alias("text"), h.alias("h"), g.alias("g"))
    chosen = F.when(F.col("h") % 10 == 0, words)
    n = F.size("words")
    rows = rows.withColumn("words", chosen)
    rows = rows.withColumn("a", F.when(n > 0, (F.col("g") % n).cast("int")))
    period = (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    rows = rows.withColumn("p", period)
    place = F.sequence(F.lit(0), n - 1)
    circled = F.transform(place, lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(circled, " ")).otherwise(F.col("text")).alias("text"))
