"""Ids of a public word-BPE vocabulary, by the tokenizers library, with a bounded table of words in each worker.

The vocabulary cuts a text into letter runs, single digits and runs of marks (an apostrophe may take letters with it),
drops white space, and merges inside these alone, so a text's ids are the concatenation of its pieces' ids. For texts in
Latin-1 (where lower-casing is by character and NFC changes nothing) numpy finds the pieces of a whole batch, looks
them up in an open-addressing table by their bytes, and only pieces that the table lacks go to the library's model.
Other texts, and those that may hold a special token, go through the library whole, one by one.
"""

from __future__ import annotations

import os

import numpy as np
import regex

from .automaton import byte_letters
from .common import buffers, mix64

#: Pieces that a worker's table holds before it starts anew.
TABLE_ENTRIES = 2_000_000
#: Longer pieces (in characters) are encoded each time.
KEY_BYTES = 24
#: The vocabulary's word pattern, as its file states it.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

GAP, LETTER, DIGIT, MARK, QUOTE, ODD = range(6)


def _class(c: str) -> int:
    if c in " \t\n\r":
        return GAP
    if c.isspace() or "\x1c" <= c <= "\x1f":
        return ODD  # white space that is rare enough to be left to the pattern
    return LETTER if regex.match(r"\p{L}", c) else DIGIT if regex.match(r"\p{N}", c) else QUOTE if c == "'" else MARK


_LOWER = np.array([ord(chr(i).lower()) if len(chr(i).lower()) == 1 and ord(chr(i).lower()) < 256 else i for i in range(256)], np.uint8)
_CLASS = np.array([_class(chr(i)) for i in range(256)], np.uint8)
#: Whether a piece ends between two characters, by 8 * class + class. What a letter follows an apostrophe stays with it.
_CUT = np.zeros(64, bool)
for _a in range(6):
    for _b in range(6):
        if GAP in (_a, _b):
            _CUT[8 * _a + _b] = True
        elif ODD not in (_a, _b):
            _CUT[8 * _a + _b] = DIGIT in (_a, _b) or (_a == LETTER) != (_b == LETTER) and not (_a == QUOTE and _b == LETTER)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)

_made: dict[str, "WordEncoder"] = {}


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Table:
    """Pieces of at most KEY_BYTES bytes, keyed exactly by three words of their bytes and their length, to runs of ids in a pool."""

    def __init__(self, dtype: str):
        self.dtype = dtype
        self.clear()

    def clear(self) -> None:
        self.n, self.slots = 0, np.full(1 << 16, -1, np.int32)
        self.keys = np.zeros((1 << 15, 4), np.uint64)
        self.at, self.size = np.zeros(1 << 15, np.int64), np.zeros(1 << 15, np.int32)
        self.pool, self.used = np.zeros(1 << 17, self.dtype), 0

    @staticmethod
    def _hash(keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64(mix64(mix64(keys[:, 0]) ^ keys[:, 1]) ^ keys[:, 2] ^ (keys[:, 3] << np.uint64(56)))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's entry, or -1."""
        mask = np.int64(len(self.slots) - 1)
        place = (self._hash(keys) >> np.uint64(8)).astype(np.int64) & mask
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        while len(left):
            e = self.slots[place]
            hit = e >= 0
            same = hit & (self.keys[e] == keys[left]).all(1)
            out[left[same]] = e[same]
            go = hit & ~same
            left, place = left[go], (place[go] + 1) & mask
        return out

    def _place(self, entries: np.ndarray) -> None:
        mask = np.int64(len(self.slots) - 1)
        place = (self._hash(self.keys[entries]) >> np.uint64(8)).astype(np.int64) & mask
        while len(entries):
            free = self.slots[place] < 0
            self.slots[place[free]] = entries[free]
            go = self.slots[place] != entries
            entries, place = entries[go], (place[go] + 1) & mask

    def add(self, keys: np.ndarray, ids: list[np.ndarray]) -> np.ndarray:
        """Enters distinct new keys; returns their entries."""
        n, m = self.n, len(keys)
        flat = np.concatenate(ids) if ids else np.zeros(0, self.dtype)
        while n + m > len(self.at):
            self.keys, self.at, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.keys, self.at, self.size))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        size = np.array([len(x) for x in ids], np.int32)
        self.keys[n : n + m], self.size[n : n + m] = keys, size
        self.at[n : n + m] = self.used + np.cumsum(size) - size
        self.pool[self.used : self.used + len(flat)] = flat
        self.n, self.used = n + m, self.used + len(flat)
        if 2 * self.n > len(self.slots):
            self.slots = np.full(4 * len(self.slots), -1, np.int32)
            self._place(np.arange(self.n, dtype=np.int32))
        else:
            self._place(np.arange(n, n + m, dtype=np.int32))
        return np.arange(n, n + m)


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        #: Ids as stored: two bytes where the vocabulary allows it.
        self.largest = max(self.library.get_vocab(with_added_tokens=True).values())
        self.dtype = "<u2" if self.largest < 1 << 16 else "<u4"
        self.tokenize = self.library.model.tokenize
        self.letters = {b: c for c, b in byte_letters().items()}
        self.table = Table(self.dtype)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype)

    def piece(self, raw: bytes) -> np.ndarray:
        """The ids of a lower-case Latin-1 piece."""
        text = raw.decode("latin-1")
        out = []
        for w in [text] if raw.isalpha() and raw.isascii() else WORDS.findall(text):
            out += [t.id for t in self.tokenize(w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(self.letters))]
        return np.array(out, self.dtype)

    def _learn(self, keys: np.ndarray, low: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Entries of pieces that the table lacks."""
        order = np.lexsort(keys.T)
        new = np.r_[True, (keys[order][1:] != keys[order][:-1]).any(1)]
        first = order[new]
        ids = [self.piece(low[s:e]) for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        entry = self.table.add(keys[first], ids)
        out = np.empty(len(keys), np.int64)
        out[order] = entry[np.cumsum(new) - 1]
        return out

    def encode(self, data: np.ndarray, off: np.ndarray, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of the texts in them) of UTF-8 texts data[off[i]:off[i + 1]], each with end_id after it where one is given."""
        docs = len(off) - 1
        # two-byte letters of Latin-1 have one of two leads; any higher lead is beyond it
        beyond = np.flatnonzero(data > 0xC3)
        special = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124))
        whole = np.flatnonzero((np.diff(np.searchsorted(beyond, off)) > 0) | (np.diff(np.searchsorted(special, off)) > 0))
        lead = data >= 0xC2
        after = np.zeros(len(data), np.uint8)
        after[1:] = (data[:-1] == 0xC3) * np.uint8(0x40)
        keep = ~lead
        low = _LOWER[(data + after)[keep]]
        cut = np.concatenate([[0], np.cumsum(keep)])[off]
        kind = _CLASS[low]
        for d in whole.tolist():
            kind[cut[d] : cut[d + 1]] = GAP
        inside = kind != GAP
        edge = np.ones(len(low) + 1, bool)
        if len(low):
            edge[1:-1] = _CUT[8 * kind[:-1] + kind[1:]]
        edge[cut] = True
        starts, ends = np.flatnonzero(edge[:-1] & inside), np.flatnonzero(edge[1:] & inside) + 1
        at, n, extra = self._runs(low, starts, ends)
        row = np.searchsorted(starts, cut)  # first piece of each text
        if len(whole):
            got = [self.ids(data[off[d] : off[d + 1]].tobytes().decode("utf-8", "replace")) for d in whole.tolist()]
            size = np.array([len(x) for x in got], np.int64)
            base = self.table.used + sum(len(x) for x in extra)
            at, n = np.insert(at, row[whole], base + np.cumsum(size) - size), np.insert(n, row[whole], size)
            extra += got
            row = row + np.searchsorted(whole, np.arange(docs + 1), "left")
        if end_id is not None:
            at, n = np.insert(at, row[1:], self.table.used + sum(len(x) for x in extra)), np.insert(n, row[1:], 1)
            extra.append(np.array([end_id], self.dtype))
            row = row + np.arange(docs + 1)
        pool = np.concatenate([self.table.pool[: self.table.used], *extra]) if extra else self.table.pool
        end = np.concatenate([[0], np.cumsum(n)])
        return pool[np.repeat(at - end[:-1], n) + np.arange(int(end[-1]))], end[row]

    def _runs(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """(place in the pool, ids) of each piece; pieces that are too long for the table follow the pool, in the list."""
        if self.table.n > TABLE_ENTRIES:
            self.table.clear()
        size = ends - starts
        padded = np.concatenate([low, np.zeros(KEY_BYTES, np.uint8)])
        eight = np.ndarray((len(low) + KEY_BYTES - 7,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
        keys = np.zeros((len(starts), 4), np.uint64)
        keys[:, 3] = size
        for k in range(3):
            some = np.flatnonzero(size > 8 * k) if k else slice(None)
            keys[some, k] = eight[starts[some] + 8 * k] & _MASKS[np.minimum(size[some] - 8 * k, 8)]
        short = size <= KEY_BYTES
        entry = np.full(len(starts), -1, np.int64)
        if short.all():
            entry = self.table.find(keys)
        else:
            entry[short] = self.table.find(keys[short])
        missing = np.flatnonzero(short & (entry < 0))
        raw = low.tobytes()
        if len(missing):
            entry[missing] = self._learn(keys[missing], raw, starts[missing], ends[missing])
        at, n = self.table.at[entry], self.table.size[entry].astype(np.int64)
        far, extra = np.flatnonzero(~short).tolist(), []
        to, seen = self.table.used, {}
        for i in far:
            w = raw[starts[i] : ends[i]]
            if w not in seen:
                extra.append(self.piece(w))
                seen[w] = (to, len(extra[-1]))
                to += len(extra[-1])
            at[i], n[i] = seen[w]
        return at, n, extra

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        """For each text its ids."""
        import pyarrow as pa

        ids, off = self.encode(*buffers(pa.array(texts, pa.large_string())))
        return [ids[a:z] for a, z in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]


def encoder(path: str) -> WordEncoder:
    """This process's encoder for a vocabulary; kept between tasks."""
    if path not in _made:
        _made[path] = WordEncoder(path)
    return _made[path]


def width(path: str) -> str:
    """The type in which a vocabulary's ids are stored."""
    return encoder(path).dtype
