"""Token ids by the tokenizers library, each different word encoded once per worker.

The tokenizer drops white space and never merges over it, so a text's ids are those of its words
one after another. Most words repeat: a worker keeps the ids of the words it has met, up to a bound.
"""

from __future__ import annotations

import functools
import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tokenizers

from coinslot.llm.rows import filled

#: Words a worker remembers; beyond that it starts afresh. Bounds memory, changes no result.
REMEMBERED = 400_000

#: Words of printable ASCII and Latin-1 letters, and their pieces in lower case as the file's own splitter
#: cuts them; words that are cut together have a line each. Fixed values.
PLAIN = "^[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*$"
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|\n|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff\n]+")
LATIN = [chr(c) for c in range(0xDF, 0x100) if c != 0xF7]


class IdLists:
    """Lists of ids by their text, in flat arrays."""

    def __init__(self) -> None:
        self.slots: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.used = 0
        self.starts = np.empty(1 << 14, np.int64)
        self.lengths = np.empty(1 << 14, np.int64)

    def find(self, texts: list[str]) -> np.ndarray:
        """Slots of the texts, -1 where unknown."""
        return np.fromiter(map(self.slots.get, texts, repeat(-1)), np.int64, len(texts))

    def add(self, texts: list[str], lengths: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """Takes in new texts with the lengths of their lists and these one after another; returns their slots."""
        first, n = len(self.slots), len(texts)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while first + n > len(self.starts):
            self.starts = np.concatenate([self.starts, np.empty_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.empty_like(self.lengths)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.starts[first : first + n] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first : first + n] = lengths
        self.used += len(flat)
        self.slots.update(zip(texts, range(first, first + n)))
        return np.arange(first, first + n)

    def take(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of the slots one after another, and where each ends, from 0."""
        lengths = self.lengths[slots]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.ids[np.repeat(self.starts[slots] - ends[:-1], lengths) + np.arange(ends[-1])], ends


def listed(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()


def flattened(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the lists, and the lists one after another."""
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    return lengths, np.fromiter(chain.from_iterable(lists), np.uint32, int(lengths.sum()))


class WordEncoder:
    """Ids of whole texts by a tokenizers file whose splitter cuts at white space.

    ``special``: names of the file's special tokens inside a text are those tokens, the library's default;
    otherwise they are plain text.
    """

    def __init__(self, path: str, special: bool = True) -> None:
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        added = self.tokenizer.get_added_tokens_decoder() if special else {}
        self.special = {token.content: number for number, token in added.items()}
        self.names = pa.array(list(self.special), pa.large_string())
        #: How the file writes letters outside ASCII: byte by byte, so each by itself.
        self.written = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in LATIN}
        self._forget()

    def _forget(self) -> None:
        self.words, self.pieces = IdLists(), IdLists()
        # The end of a line has no ids.
        self.pieces.add(["\n"], np.zeros(1, np.int64), np.empty(0, np.uint32))

    def _word(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Plain words are cut here, all at once, and their pieces looked up."""
        cut = pa.array(PIECES.findall("\n".join(words).lower()), pa.large_string()).dictionary_encode()
        pieces = listed(cut.dictionary)
        slots = self.pieces.find(pieces)
        fresh = [pieces[k] for k in np.flatnonzero(slots < 0)]
        if fresh:
            tokenize = self.tokenizer.model.tokenize
            found = [[t.id for t in tokenize(p if p.isascii() else p.translate(self.written))] for p in fresh]
            slots[slots < 0] = self.pieces.add(fresh, *flattened(found))
        codes = cut.indices.to_numpy(zero_copy_only=False)
        flat, ends = self.pieces.take(slots[codes])
        breaks = np.flatnonzero(codes == pieces.index("\n")) if len(words) > 1 else np.empty(0, np.int64)
        return np.diff(ends[np.concatenate([[0], breaks, [len(codes)]])]), flat

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Slots of new words. Plain ones are cut here; all others take the library's whole way."""
        plain = pc.match_substring_regex(words, PLAIN)
        if len(self.names):
            plain = pc.and_not(plain, pc.is_in(words, self.names))
        plain = plain.to_numpy(zero_copy_only=False)
        slots = np.empty(len(words), np.int64)
        for some, encoded in ((plain, self._plain), (~plain, lambda rest: flattened([self._word(w) for w in rest]))):
            if some.any():
                texts = listed(words.filter(pa.array(some)))
                slots[some] = self.words.add(texts, *encoded(texts))
        return slots

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids (uint32) of all texts one after another, and where each text starts (with the end). Null: empty."""
        texts = filled(texts)
        for name in self.special:
            # Such a name is a word of its own, whatever it touches; white space between words gives no ids.
            if pc.any(pc.match_substring(texts, name)).as_py():
                texts = pc.replace_substring(texts, name, f" {name} ")
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        if len(self.words.slots) > REMEMBERED:
            self._forget()
        slots = self.words.find(listed(coded.dictionary))
        fresh = np.flatnonzero(slots < 0)
        if len(fresh):
            slots[fresh] = self._learn(coded.dictionary.take(pa.array(fresh)))
        ids, ends = self.words.take(slots[coded.indices.to_numpy(zero_copy_only=False)])
        bounds = np.frombuffer(split.buffers()[1], np.int64 if pa.types.is_large_list(split.type) else np.int32)
        bounds = bounds[split.offset : split.offset + len(split) + 1].astype(np.int64)
        return ids, ends[bounds - bounds[0]]


@functools.lru_cache(maxsize=2)
def encoder(path: str, special: bool = True) -> WordEncoder:
    """The worker's encoder for a file: loaded once per Python worker."""
    return WordEncoder(path, special)


def with_end(ids: np.ndarray, starts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same texts with one id appended to each."""
    return np.insert(ids, starts[1:], np.uint32(end_id)), starts + np.arange(len(starts))
