"""Alignment of two tokenizers on the same texts: groups of tokens that cover the same bytes, and their links.

Both tokenizers' tokens lie on the bytes of a space and the text. Where a token of each ends, a group
ends. Most groups are one token to one: such stretches lie on a diagonal of the two end arrays, which
is followed by probes that double in length; where it breaks, the irregular group is resolved end by
end, and the walk goes on along the diagonal that starts behind it.

Texts are cut into units where neither tokenizer has a token that goes on, so no group or link does
either. A unit is encoded and aligned when a worker meets it first; a text is put together from its units.

Texts are worked on in chunks. A chunk lists its different pairs of ids once, with how often they are
linked; counts over the corpus are sums of these lists, and go back to the chunks that hold a pair.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinslot.llm import greedy_bpe
from coinslot.llm.byte_bpe import SPACES
from coinslot.llm.greedy_bpe import LETTERS, gather
from coinslot.llm.rows import slices
from coinslot.session import materialise

#: Bytes of text in a chunk; a longer single text is a chunk of its own.
CHUNK_BYTES = 2_000_000
#: Bytes that the units a worker remembers may take, and what a unit takes beside its characters, its
#: groups as text and its links; beyond that only units met again stay. Bounds memory, changes no result.
REMEMBERED_BYTES, UNIT_BYTES = 120_000_000, 240
#: Characters of new units that are aligned at once; a longer single unit is aligned alone.
BLOCK = 300_000

#: Texts of these characters are cut into units of letters, of digits and of other signs, each with the white
#: space before it, as the splitter of the byte-level file cuts them: contractions are cut off, unless behind a space.
PLAIN = re.compile(f"[\\t\\n -~{LETTERS}]*")
UNITS = re.compile(
    f"[\\t\\n ]*(?:[{LETTERS}]+|(?<! )'(?:[stmd]|re|ve|ll)[{LETTERS}]*|[0-9]+|[^\\t\\n {LETTERS}0-9]+)|[\\t\\n ]+"
)
#: Other texts are cut only before the white space that no piece of the piece model holds behind a character.
WORDS = re.compile(f"[{SPACES}]*[^{SPACES}]+(?:(?![\\t\\n ])[{SPACES}]+[^{SPACES}]+)*+(?:(?![\\t\\n ])[{SPACES}]+)?+|[{SPACES}]+")
#: What no piece may hold if texts are cut like that.
BORDERS = re.compile(f"[{LETTERS}][^{LETTERS}]|[^{LETTERS}▁][{LETTERS}]|[0-9][^0-9]|[^0-9▁][0-9]|[^▁]▁|[\\t\\n ]")

PAIRS = "array<struct<id_a:int,id_b:int,n:long>>"
ALIGNED = f"doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, chunk long, codes binary, pairs {PAIRS}"


def units(text: str) -> list[str]:
    """A text cut where no token of either tokenizer goes on, and so that each unit has the same tokens alone."""
    if PLAIN.fullmatch(text):
        return UNITS.findall(text)
    return [u for w in WORDS.findall(text) for u in (UNITS.findall(w) if PLAIN.fullmatch(w) else [w])]


class PieceEncoder:
    """Ids of a sentencepiece model for texts that may begin anywhere: the model's own space before a text is left out.

    A model whose pieces go on over the borders of units, or that rewrites texts, is refused.
    """

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        as_byte = [self.model.is_byte(i) for i in range(len(pieces))]
        named = [self.model.is_control(i) or self.model.is_unknown(i) for i in range(len(pieces))]
        if any(BORDERS.search(p) for p, *other in zip(pieces, as_byte, named) if not any(other)):
            raise ValueError("pieces that go on over a border of units cannot be found unit by unit")
        if self.model.encode("ﬁ  x ", out_type=str)[0][0] != "▁" or self.model.decode(self.model.encode("ﬁ  x ")) != "ﬁ  x ":
            raise ValueError("the model rewrites texts")
        if sum(as_byte) != 256:
            raise ValueError("the model loses characters it does not know")
        as_bytes = [bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode() for p, byte in zip(pieces, as_byte)]
        self.bytes = pa.array(as_bytes, pa.large_binary())
        self.lengths = np.fromiter(map(len, as_bytes), np.int64, len(as_bytes))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another and where each starts (with the end)."""
        # No piece holds a line feed: the model's space and one are two pieces before the text's own.
        found = self.model.encode(["\n" + t for t in texts], num_threads=1) if texts else []
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        starts = np.concatenate([[0], np.cumsum(lengths)])
        own = np.ones(starts[-1], bool)
        own[starts[:-1]] = own[starts[:-1] + 1] = False
        flat = np.fromiter(chain.from_iterable(found), np.int64, int(starts[-1]))
        return flat[own], starts - 2 * np.arange(len(starts))


class Tokens:
    """A worker's two encoders with the bytes of their ids, and the aligned units it remembers."""

    def __init__(self, path_a: str, path_b: str) -> None:
        with open(path_a, encoding="utf-8") as file:
            content = json.load(file)
        # Without its added tokens the file takes their texts as plain text.
        self.a, self.b = tokenizers.Tokenizer.from_str(json.dumps(content | {"added_tokens": []})), PieceEncoder(path_b)
        self.a.no_truncation(), self.a.no_padding()
        self.lengths_a = np.diff(np.frombuffer(greedy_bpe.token_bytes(path_a).buffers()[1], np.int64))
        #: Decimal ids with the sign behind them: ``,`` inside a side of a group, ``|`` between sides, ``;`` between groups.
        self.size = max(len(self.lengths_a), len(self.b.lengths))
        self.decimals = pa.array([f"{i}{sign}" for sign in ",|;" for i in range(self.size)], pa.large_string())
        self.slots: dict[str, int] = {}
        #: Per unit: whether its pieces give its bytes back; numbers of tokens of both, groups and links; how often it was met.
        self.same, self.numbers, self.met = np.empty(0, bool), np.empty((0, 4), np.int32), np.empty(0, np.int64)
        #: Groups as text, with ``;`` behind each, and links as places in ``keys``: of all units, and where each unit's start.
        self.groups, self.group_starts = np.empty(0, np.uint8), np.zeros(1, np.int64)
        self.links, self.link_starts = np.empty(0, np.int32), np.zeros(1, np.int64)
        #: Pairs of ids of all links.
        self.keys, self.places = np.empty(0, np.int64), {}
        self.held = 0

    def find(self, wanted: list[str]) -> np.ndarray:
        """Slots of the units; new ones are aligned."""
        if self.held > REMEMBERED_BYTES:
            self._forget()
        at = np.fromiter(map(self.slots.get, wanted, repeat(-1)), np.int64, len(wanted))
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            missed = [wanted[i] for i in unknown.tolist()]
            self._learn(list(dict.fromkeys(missed)))
            at[unknown] = np.fromiter(map(self.slots.__getitem__, missed), np.int64, len(missed))
        self.met += np.bincount(at, minlength=len(self.met))
        return at

    def _learn(self, fresh: list[str]) -> None:
        blocks = np.cumsum(np.fromiter(map(len, fresh), np.int64, len(fresh))) // BLOCK
        cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(fresh)]
        parts = [align_units(self, fresh[x:y]) for x, y in zip(cuts[:-1], cuts[1:])]
        same, numbers, groups, group_sizes, keys, link_sizes = map(np.concatenate, zip(*parts))
        self.slots.update(zip(fresh, range(len(self.slots), len(self.slots) + len(fresh))))
        self.same, self.numbers = np.concatenate([self.same, same]), np.concatenate([self.numbers, numbers])
        self.met = np.concatenate([self.met, np.zeros(len(fresh), np.int64)])
        self.groups = np.concatenate([self.groups, groups])
        self.group_starts = np.concatenate([self.group_starts, self.group_starts[-1] + np.cumsum(group_sizes)])
        different, which = np.unique(keys, return_inverse=True)
        new = [k for k in different.tolist() if k not in self.places]
        self.places.update(zip(new, range(len(self.keys), len(self.keys) + len(new))))
        self.keys = np.concatenate([self.keys, np.array(new, np.int64)])
        places = np.fromiter(map(self.places.__getitem__, different.tolist()), np.int32, len(different))
        self.links = np.concatenate([self.links, places[which]])
        self.link_starts = np.concatenate([self.link_starts, self.link_starts[-1] + np.cumsum(link_sizes)])
        self.held += sum(map(len, fresh)) + len(groups) + 4 * len(keys) + UNIT_BYTES * len(fresh)

    def _forget(self) -> None:
        """Keeps units met again since the last time, the most frequent if they fill more than half of the bound."""
        words, least = list(self.slots), 1
        sizes = UNIT_BYTES + np.fromiter(map(len, words), np.int64, len(words)) + np.diff(self.group_starts) + 4 * np.diff(self.link_starts)
        while sizes[self.met > least].sum() > REMEMBERED_BYTES // 2:
            least *= 2
        kept = np.flatnonzero(self.met > least)
        self.slots = dict(zip(map(words.__getitem__, kept.tolist()), range(len(kept))))
        self.same, self.numbers, self.met = self.same[kept], self.numbers[kept], np.zeros(len(kept), np.int64)
        self.groups, self.group_starts = gather(self.groups, self.group_starts, kept)
        links, self.link_starts = gather(self.links, self.link_starts, kept)
        used, links = np.unique(links, return_inverse=True)
        self.links, self.keys = links.astype(np.int32), self.keys[used]
        self.places = dict(zip(self.keys.tolist(), range(len(self.keys))))
        self.held = int(sizes[kept].sum())


@functools.lru_cache(maxsize=1)
def tokens(path_a: str, path_b: str) -> Tokens:
    return Tokens(path_a, path_b)


def irregular(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Groups that are not one token to one: rows of (first of a, behind a, first of b, behind b).

    Both arrays rise and finish with the same end.
    """
    a, b = ends_a.tolist(), ends_b.tolist()
    n, m = len(a), len(b)
    found = []
    i = j = 0
    while i < n:
        if a[i] == b[j]:
            # One to one on this diagonal: blocks of doubling length, then halves of the block that fails.
            i, j, width = i + 1, j + 1, 2
            room = min(n - i, m - j)
            while room and a[i : i + width] == b[j : j + width]:
                width = min(width, room)
                i, j, room, width = i + width, j + width, room - width, width * 2
            width = min(width, room)
            while width > 1:
                width //= 2
                if a[i : i + width] == b[j : j + width]:
                    i, j = i + width, j + width
            # The halves leave at most a few equal ends, which the next turn takes.
            continue
        p, q, x, y = i, j, a[i], b[j]
        while x != y:
            if x < y:
                p += 1
                x = a[p]
            else:
                q += 1
                y = b[q]
        found.append((i, p + 1, j, q + 1))
        i, j = p + 1, q + 1
    return np.array(found, np.int64).reshape(-1, 4)


def group_ends(count: int, first: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """For every token whether its group ends with it; tokens outside the given groups stand alone."""
    inner = np.zeros(count + 1, np.int64)
    np.add.at(inner, first, 1)
    np.add.at(inner, behind - 1, -1)
    return np.cumsum(inner[:-1]) == 0


def joined(table: pa.Array, ids: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
    """Bytes of the ids one after another, and where each id's bytes begin (with the end)."""
    taken = table.take(pa.array(ids, pa.int64()))
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[: len(ids) + 1]
    return taken.buffers()[2] or pa.py_buffer(b""), offsets


def align_units(both: Tokens, texts: list[str]) -> tuple[np.ndarray, ...]:
    """What ``Tokens`` has of each unit, with lengths instead of starts and pairs of ids instead of places.

    A unit whose pieces do not give its bytes back has no tokens.
    """
    raw = [t.encode() for t in texts]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    ids_a = np.array(both.a.encode(texts, is_pretokenized=True, add_special_tokens=False).ids, np.int64)
    at_a = np.concatenate([[0], np.searchsorted(np.cumsum(both.lengths_a[ids_a]), np.cumsum(sizes), side="right")])
    ids_b, at_b = both.b.encode(texts)
    data, offsets = joined(both.b.bytes, ids_b)
    bounds = offsets[at_b]
    same = np.diff(bounds) == sizes
    if not same.all() or not data[: int(bounds[-1])].equals(pa.py_buffer(b"".join(raw))):
        same = np.array([data[int(x) : int(y)].equals(pa.py_buffer(r)) for x, y, r in zip(bounds[:-1], bounds[1:], raw)], bool)
    n_a, n_b = np.where(same, np.diff(at_a), 0), np.where(same, np.diff(at_b), 0)
    if not same.all():
        ids_a, ids_b = ids_a[np.repeat(same, np.diff(at_a))], ids_b[np.repeat(same, np.diff(at_b))]
    ends_a, ends_b = np.cumsum(both.lengths_a[ids_a]), np.cumsum(both.b.lengths[ids_b])

    odd = irregular(ends_a, ends_b)
    last_a, last_b = group_ends(len(ids_a), odd[:, 0], odd[:, 1]), group_ends(len(ids_b), odd[:, 2], odd[:, 3])
    stop_a, stop_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
    unit_a, unit_b = np.cumsum(n_a), np.cumsum(n_b)
    groups = np.diff(np.searchsorted(stop_a, unit_a, side="right"), prepend=0)

    # Every stretch of bytes between two ends of any kind is one link.
    ends = np.concatenate([ends_a, ends_b])
    ends.sort(kind="stable")
    ends = ends[np.flatnonzero(np.diff(ends, prepend=-1))]
    link_a, link_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    link_stops = np.searchsorted(link_a, unit_a)

    # Ids as text in group order: behind each token of a come the tokens of b of all groups before, and the reverse.
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    before_b, until_a = np.concatenate([[0], stop_b]), stop_a
    items = np.empty(len(ids_a) + len(ids_b), np.int64)
    items[np.arange(len(ids_a)) + before_b[group_a]] = ids_a + both.size * last_a
    items[np.arange(len(ids_b)) + until_a[group_b]] = ids_b + 2 * both.size * last_b
    text, at = joined(both.decimals, items)
    places = at[np.concatenate([[0], unit_a + unit_b])]
    numbers = np.stack([n_a, n_b, groups, np.diff(link_stops, prepend=0)], 1).astype(np.int32)
    keys = ids_a[link_a] << 32 | ids_b[link_b]
    return same, numbers, np.frombuffer(text, np.uint8)[: places[-1]], np.diff(places), keys, numbers[:, 3]


def align_chunk(both: Tokens, texts: list[str | None]) -> dict:
    """Everything about a chunk's texts; see ``align_documents``."""
    of_text = [units(f" {t}") if t else [] for t in texts]
    at = both.find(list(chain.from_iterable(of_text)))
    counts = np.fromiter(map(len, of_text), np.int64, len(texts))
    # Bytes get lost on the way through pieces, but never more: a text comes back only if all its units do.
    lost = ~both.same[at]
    if lost.any():
        whole = np.ones(len(texts), bool)
        text = np.repeat(np.arange(len(texts)), counts)
        whole[text[lost]] = False
        at, counts = at[whole[text]], np.where(whole, counts, 0)
    stops = np.concatenate([[0], np.cumsum(counts)])
    numbers = both.numbers[at].astype(np.int64)
    sums = np.diff(np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(numbers, axis=0)])[stops], axis=0)

    places, _ = gather(both.links, both.link_starts, at)
    linked = np.bincount(places, minlength=len(both.keys))
    present = np.flatnonzero(linked)
    present = present[np.argsort(both.keys[present])]
    codes = np.empty(len(both.keys), "<u2" if len(present) <= 1 << 16 else "<u4")
    codes[present] = np.arange(len(present))

    table = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(both.same), [None, pa.py_buffer(both.group_starts), pa.py_buffer(both.groups)]
    )
    text, offsets = joined(table, at)
    ends = offsets[stops].tolist()
    return {
        "n_a": sums[:, 0], "n_b": sums[:, 1], "n_groups": sums[:, 2], "n_links": sums[:, 3],
        "groups": [text[x : max(x, y - 1)].to_pybytes().decode() for x, y in zip(ends[:-1], ends[1:])],
        "codes": codes[places], "keys": both.keys[present], "counts": linked[present],
    }


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, counts of tokens, groups and links, and ``groups`` as ``a1,a2|b1;a3|b2``.

    ``chunk`` names the rows that were worked on together, ``pairs`` (on the first of them) its different
    linked pairs of ids with their number, in order of ids, and ``codes`` the row's links as places in
    that list, little-endian and unsigned, of two bytes where they suffice for the list and four otherwise.

    Null and empty texts, and texts that a tokenizer does not give back byte by byte, have no tokens: zeros
    and an empty ``groups``. Rows that repeat stay, a null id stays null, no rows give none. Other columns
    are not read, so their names cannot clash. Names of chunks hold within one run: store the rows
    before they are read twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokens(path_a, path_b)
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", CHUNK_BYTES):
                got = align_chunk(both, part.column("text").to_pylist())
                stops = np.cumsum(got["n_links"])
                codes = [got["codes"][y - x : y].tobytes() for x, y in zip(got["n_links"].tolist(), stops.tolist())]
                listed = pa.StructArray.from_arrays(
                    [pa.array(got["keys"] >> 32, pa.int32()), pa.array(got["keys"] & 0xFFFFFFFF, pa.int32()), pa.array(got["counts"], pa.int64())],
                    names=["id_a", "id_b", "n"],
                )
                bounds = [0] + [len(listed)] * len(part)
                # All rows but the first have no list.
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), listed, mask=pa.array([False] + [True] * (len(part) - 1)))
                columns = [part.column("doc_id"), *(pa.array(got[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links"))]
                columns += [pa.array(got["groups"], pa.string()), pa.array([chunk] * len(part), pa.int64())]
                columns += [pa.array(codes, pa.binary()), lists]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "chunk", "codes", "pairs"]
                )
                chunk += 1

    columns = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return columns.mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """How often each pair of ids is linked in all texts, and whether no pair of its ``id_b`` is linked more often."""
    listed = aligned.filter("pairs IS NOT NULL").select(F.inline("pairs"))
    totals = listed.groupBy("id_a", "id_b").agg(F.sum("n").alias("count"))
    # At most one row per id of the second vocabulary.
    most = totals.groupBy("id_b").agg(F.max("count").alias("_most"))
    return totals.join(F.broadcast(most), "id_b").select("id_a", "id_b", "count", (F.col("count") == F.col("_most")).alias("best"))


def score_links(aligned: DataFrame) -> DataFrame:
    """Adds ``n_best``, a row's links whose pair is the most frequent of its ``id_b``, and ``count_sum`` over its links.

    ``aligned`` has the columns of ``align_documents`` (``groups`` may be left out or replaced) and is
    stored: chunks are named anew whenever it is computed. Each chunk's list of pairs meets the counts, and
    then the rows of the chunk; nothing is larger than a chunk or its list.
    """
    counts = materialise(pair_counts(aligned), "pair-counts")
    listed = aligned.filter("pairs IS NOT NULL").select("chunk", F.inline("pairs")).drop("n")
    answers = listed.join(counts, ["id_a", "id_b"]).select(
        F.col("chunk").alias("of_chunk"), "id_a", "id_b", "count", "best"
    )
    rows = aligned.drop("pairs")
    kept = [f for f in rows.schema if f.name not in ("chunk", "codes")]

    def score(part: pa.Table, answer: pa.Table) -> pa.Table:
        answer = answer.sort_by([("id_a", "ascending"), ("id_b", "ascending")])
        count, best = answer["count"].to_numpy(), answer["best"].to_numpy().astype(np.int64)
        links = np.frombuffer(b"".join(part["codes"].to_pylist()), "<u2" if len(count) <= 1 << 16 else "<u4")
        ends = np.concatenate([[0], np.cumsum(part["n_links"].to_numpy())])
        out = part.select([f.name for f in kept])
        for name, values in (("n_best", best), ("count_sum", count)):
            sums = np.concatenate([[0], np.cumsum(values[links])])[ends]
            out = out.append_column(name, pa.array(np.diff(sums), pa.int64()))
        return out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.groupBy("chunk").cogroup(answers.groupBy("of_chunk")).applyInArrow(score, f"{schema}, n_best long, count_sum long")
