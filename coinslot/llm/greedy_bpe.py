"""Byte-level BPE by a tokenizers file: propose by longest match, verify all neighbours, merge what fails.

A sequence of tokens is what the merges give exactly if every token comes out of its own bytes whole
and every two neighbours stay apart when their joined bytes are merged. So a word's greedy
longest-match tokens are proposed for all new words at once, every adjacent pair is tested in one
vectorised pass, and only words with a failing pair are merged step by step.

Words are cut out at white space, where no match of the splitter goes on; a worker remembers the ids
of the words it has met, up to a bound.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinslot.llm.byte_bpe import SPACES
from coinslot.llm.rows import filled, slices

#: Bytes that the words a worker remembers may take, and what a word takes beside its characters; beyond
#: that it starts afresh. Bounds memory, changes no result.
REMEMBERED_BYTES, WORD_BYTES = 48_000_000, 150

#: Bytes of text encoded at once; a longer single text is encoded alone.
SLICE = 2_000_000

#: White space before a word, and the word; white space at the end stands alone.
SEGMENT = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")

#: Letters of Latin scripts, all of them \p{L}; texts of these, digits and other ASCII are split here as
#: the file's splitter does. Fixed values.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
PLAIN = re.compile(f"[\\t-\\r -~{LETTERS}]*")
PIECES = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\\t-\\r {LETTERS}0-9]+|[\\t-\\r ]+(?![^\\t-\\r ])|[\\t-\\r ]+"
)

NEVER = np.int64(1 << 40)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level files: itself if printable, else the next above 255."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class MergeTable:
    """Tokens, merges and tests on them, all as arrays."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]) -> None:
        letters = byte_letters()
        size = max(vocabulary.values()) + 1
        self.size = size
        self.bytes: list[bytes] = [b""] * size
        for token, number in vocabulary.items():
            if all(c in letters for c in token):
                self.bytes[number] = bytes(letters[c] for c in token)
        self.of_byte = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.of_byte[byte] = vocabulary[letter]
        left = np.array([vocabulary[a] for a, _ in merges], np.int64)
        right = np.array([vocabulary[b] for _, b in merges], np.int64)
        made = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        keys = left * size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.results = keys[order], order.astype(np.int64), made[order]
        #: Rank of the merge that makes a token and its two parts; -1 for single bytes.
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for array, values in ((self.rank, np.arange(len(made))), (self.left, left), (self.right, right)):
            array[made[::-1]] = values[::-1]
        self.steps = {(a, b): (r, m) for r, (a, b, m) in enumerate(zip(left.tolist(), right.tolist(), made.tolist()))}
        self.whole = self._whole(made)
        self._trie()

    def _whole(self, made: np.ndarray) -> np.ndarray:
        """Tokens that their own bytes merge to."""
        whole = np.zeros(self.size, bool)
        whole[self.of_byte] = True
        whole[made] = self.apart(self.left[made], self.right[made], self.rank[made])
        while True:
            known = whole & ((self.rank < 0) | (whole[self.left] & whole[self.right]))
            if (known == whole).all():
                return whole
            whole = known

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NEVER)

    def apart(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | int = NEVER) -> np.ndarray:
        """Whether no merge crosses from ``a`` to ``b`` before the merges inside them that touch the border.

        Undoes the later of the two tokens' merges again and again: a crossing merge that comes before the
        one undone last (or at the same time, but further left) would have been made instead.
        """
        good = np.ones(len(a), bool)
        live, limit = np.arange(len(a)), np.broadcast_to(np.asarray(limit, np.int64), (len(a),))
        while len(live):
            crossed = self.pair_rank(a, b) < limit
            good[live[crossed]] = False
            of_a, of_b = self.rank[a], self.rank[b]
            go = ~crossed & ((of_a >= 0) | (of_b >= 0))
            live, a, b, of_a, of_b = live[go], a[go], b[go], of_a[go], of_b[go]
            in_a = of_a > of_b
            limit = np.where(in_a, of_a, of_b + 1)
            a, b = np.where(in_a, self.right[a], a), np.where(in_a, b, self.left[b])
        return good

    def _trie(self) -> None:
        """Prefixes of all whole tokens: sorted (prefix, next byte) keys, the prefix each leads to, and its token."""
        children: dict[int, int] = {}
        token_of = [-1]
        for number in np.flatnonzero(self.whole).tolist():
            node = 0
            for byte in self.bytes[number]:
                key = node << 8 | byte
                node = children.get(key, 0)
                if not node:
                    node = children[key] = len(token_of)
                    token_of.append(-1)
            token_of[node] = number
        self.token_of = np.array(token_of, np.int64)
        keys = np.fromiter(children.keys(), np.int64, len(children))
        order = np.argsort(keys)
        self.trie_keys = np.append(keys[order], NEVER)
        self.trie_nodes = np.append(np.fromiter(children.values(), np.int64, len(children))[order], 0)
        #: Prefixes of two bytes are found without a search; 0 where there is none.
        first = np.array([children[b] for b in range(256)])
        self.first = first
        self.second = np.zeros(1 << 16, np.int64)
        for byte in range(256):
            for after in range(256):
                self.second[byte << 8 | after] = children.get(int(first[byte]) << 8 | after, 0)

    def propose(self, data: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest-match tokens over all pieces: where each begins, and its id.

        ``stops`` has, for every byte, the end of the piece it lies in; no token goes beyond.
        """
        n = len(data)
        length, token = np.ones(n, np.int64), self.of_byte[data]
        wide = data.astype(np.int64)
        at = np.flatnonzero(np.arange(1, n + 1) < stops)
        node = self.second[wide[at] << 8 | wide[at + 1]]
        at, node, depth = at[node > 0], node[node > 0], 2
        while len(at):
            found = self.token_of[node]
            known = found >= 0
            length[at[known]], token[at[known]] = depth, found[known]
            inside = at + depth < stops[at]
            at, node = at[inside], node[inside]
            keys = node << 8 | wide[at + depth]
            slot = np.searchsorted(self.trie_keys, keys)
            hit = self.trie_keys[slot] == keys
            at, node, depth = at[hit], self.trie_nodes[slot[hit]], depth + 1
        begins, step, here = [], length.tolist(), 0
        while here < n:
            begins.append(here)
            here += step[here]
        begins = np.array(begins, np.int64)
        return begins, token[begins]

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece by its merges: lowest rank first, leftmost of equals, in n log n."""
        ids: list[int] = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        steps = self.steps
        queue = []
        for i in range(n - 1):
            step = steps.get((ids[i], ids[i + 1]))
            if step:
                queue.append((step[0], i, ids[i], ids[i + 1], step[1]))
        heapq.heapify(queue)
        while queue:
            _, i, a, b, made = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = made, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                step = steps.get((made, ids[k]))
                if step:
                    heapq.heappush(queue, (step[0], i, made, ids[k], step[1]))
            h = before[i]
            if h >= 0:
                step = steps.get((ids[h], made))
                if step:
                    heapq.heappush(queue, (step[0], h, ids[h], made, step[1]))
        return [x for x in ids if x >= 0]

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after another and where each piece starts (with the end). No piece is empty."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        begins, ids = self.propose(np.frombuffer(b"".join(pieces), np.uint8), np.repeat(ends, sizes))
        piece = np.searchsorted(ends, begins, side="right")
        inner = np.flatnonzero(piece[1:] == piece[:-1])
        codes, which = np.unique(ids[inner] * self.size + ids[inner + 1], return_inverse=True)
        fails = ~self.apart(codes // self.size, codes % self.size)
        failing = np.unique(piece[inner[fails[which]]])
        counts = np.bincount(piece, minlength=len(pieces))
        if len(failing):
            merged = [self.merge(pieces[i]) for i in failing.tolist()]
            changed = np.zeros(len(pieces), bool)
            changed[failing] = True
            kept = ~changed[piece]
            order = np.concatenate([piece[kept], np.repeat(failing, [len(m) for m in merged])])
            ids = np.concatenate([ids[kept], np.fromiter((i for m in merged for i in m), np.int64, len(order) - kept.sum())])
            ids = ids[np.argsort(order, kind="stable")]
            counts = np.bincount(order, minlength=len(pieces))
        return ids, np.concatenate([[0], np.cumsum(counts)])


class GreedyEncoder:
    """Ids of whole texts, as the library gives them with ``add_special_tokens=False``.

    ``special``: texts of the file's added tokens inside a text are those tokens; otherwise plain text.
    """

    def __init__(self, path: str, special: bool) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.splitter = tokenizers.Tokenizer.from_file(path).pre_tokenizer
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in content["model"]["merges"]]
        self.table = MergeTable(content["model"]["vocab"], merges)
        self.added = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, self.added))) if special and self.added else None
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.held = 0
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.used = self.count = 0
        if self.special:
            for literal, number in self.added.items():
                self._keep([literal], np.array([number]), np.array([0, 1]))

    def _keep(self, words: list[str], ids: np.ndarray, starts: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while self.count + len(words) >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.starts[self.count : self.count + len(words) + 1] = self.used + starts
        self.slots.update(zip(words, range(self.count, self.count + len(words))))
        self.used += len(ids)
        self.count += len(words)
        self.held += sum(map(len, words)) + WORD_BYTES * len(words)

    def _pieces(self, word: str) -> list[str]:
        if PLAIN.fullmatch(word):
            return PIECES.findall(word)
        return [word[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(word)]

    def _learn(self, words: list[str]) -> None:
        """Encodes new words; a piece that several of them share is encoded once."""
        of_word = [self._pieces(w) for w in words]
        distinct = {p: None for pieces in of_word for p in pieces}
        distinct = dict(zip(distinct, range(len(distinct))))
        ids, starts = self.table.encode_pieces([p.encode() for p in distinct])
        counts = np.fromiter(map(len, of_word), np.int64, len(words))
        at = np.fromiter((distinct[p] for pieces in of_word for p in pieces), np.int64, int(counts.sum()))
        flat, ends = gather(ids, starts, at)
        self._keep(words, flat, ends[np.concatenate([[0], np.cumsum(counts)])])

    def _segments(self, text: str) -> list[str]:
        if not self.special or not self.special.search(text):
            return SEGMENT.findall(text)
        found, at = [], 0
        for literal in self.special.finditer(text):
            found += SEGMENT.findall(text[at : literal.start()])
            found.append(literal.group())
            at = literal.end()
        return found + SEGMENT.findall(text[at:])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids (uint32) of all texts one after another, and where each text starts (with the end)."""
        if self.held > REMEMBERED_BYTES:
            self._forget()
        of_text = [self._segments(t) for t in texts]
        words = [w for segments in of_text for w in segments]
        fresh = [w for w in dict.fromkeys(words) if w not in self.slots]
        if fresh:
            self._learn(fresh)
        at = np.fromiter(map(self.slots.__getitem__, words), np.int64, len(words))
        ids, ends = gather(self.ids, self.starts, at)
        counts = np.fromiter(map(len, of_text), np.int64, len(texts))
        return ids, ends[np.concatenate([[0], np.cumsum(counts)])]


def gather(values: np.ndarray, starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists numbered ``at`` one after another, and where each begins (with the end)."""
    lengths = starts[at + 1] - starts[at]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return values[np.repeat(starts[at] - ends[:-1], lengths) + np.arange(ends[-1])], ends


@functools.lru_cache(maxsize=2)
def encoder(path: str, special: bool = True) -> GreedyEncoder:
    """The worker's encoder for a file: loaded once per Python worker."""
    return GreedyEncoder(path, special)


@functools.lru_cache(maxsize=2)
def token_bytes(path: str) -> pa.LargeBinaryArray:
    """The bytes of every id; an added token has its own text, an id without token nothing."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    vocabulary, added = content["model"]["vocab"], content["added_tokens"]
    table = [b""] * (max([*vocabulary.values(), *(t["id"] for t in added)]) + 1)
    letters = byte_letters()
    for token, number in vocabulary.items():
        table[number] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    for token in added:
        table[token["id"]] = token["content"].encode()
    return pa.array(table, pa.large_binary())


def encode_documents(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``n_tokens`` and ``ids`` (little-endian uint32, binary).

    Null and empty texts have no ids. Rows that repeat stay; a null id stays null; no rows give none.
    Other columns are not read, so their names cannot clash. Texts of any length are encoded whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                ids, starts = enc.encode(filled(part.column("text")).to_pylist())
                lists = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(part), [None, pa.py_buffer(starts * 4), pa.py_buffer(ids.astype("<u4"))]
                )
                arrays = [part.column("doc_id"), pa.array(np.diff(starts), pa.int64()), lists.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "ids"])

    columns = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return columns.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encode_documents`` with ``decoded``, the text of the ids.

    Bytes that are no UTF-8 become U+FFFD, as in the library. Null ids decode to an empty text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path)
        for batch in batches:
            for part in slices(batch, "ids"):
                texts = []
                for ids in part.column("ids"):
                    joined = table.take(pa.array(np.frombuffer(ids.as_buffer() or b"", "<u4")))
                    bounds = np.frombuffer(joined.buffers()[1], np.int64)
                    data = joined.buffers()[2]
                    texts.append(data[int(bounds[0]) : int(bounds[len(joined)])].to_pybytes().decode("utf-8", "replace") if data else "")
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")
