"""BPE encoding and decoding by a tokenization automaton.

``Automaton`` starts as one state with a loop for each byte and applies a merge gadget for every merge (u, v) in
rank order: the state that u-arcs lead to is copied without its v-arc, u-arcs are led to the copy, and every
state that has a u-arc gets a uv-arc to where v led. What is left accepts exactly the correct tokenizations
(M. Berglund, W. Martens, B. van der Merwe, "Constructing a BPE tokenization DFA"). By induction all arcs with
one label lead to one state, so the table holds for each label its target, and for each copy its parent, the arc
it dropped and when; whether a state has an arc follows from these and is kept in a transition table.

A word is encoded left to right: after each prefix the automaton is in one state, reached by the one arc whose
label ends there and whose source state has it. A trie of the labels gives those that start at a place. Decoding emits arc labels. Texts are split into words by the
vocabulary's public pattern; a bounded cache in each worker keeps encoded words.

Null texts are empty (no ids); repeated rows keep their results; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import json
import re
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix64, read_table, text_chunks, text_col

#: The public pattern that splits texts for byte-level vocabularies.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: The same for texts in ASCII, by the standard library, which is faster.
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
#: Entries of a worker's word cache before it starts anew, characters of the longest cached word.
CACHE_ENTRIES, CACHE_CHARS = 200_000, 64
#: Entries of the transition table of single words, and of that of many words together.
TABLE_ENTRIES, ARC_SLOTS = 300_000, 1 << 21


def byte_letters() -> dict[str, int]:
    """The public byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


class Automaton:
    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]]):
        """labels: bytes of each token id; merges: (u, v, uv) ids in rank order."""
        self.labels = labels
        self.id_of = {b: i for i, b in labels.items()}
        # states: the parent, the dropped label and the merge at which the copy was made
        parent, dropped, made = [-1], [-1], [-1]
        target = {i: 0 for i, b in labels.items() if len(b) == 1}
        #: uv -> (its rank, u): what the uv-arcs were made from
        self.made_of: dict[int, tuple[int, int]] = {}
        self.parent, self.dropped, self.made, self.target = parent, dropped, made, target
        self._drops: dict[int, dict[int, int]] = {}
        for rank, (u, v, uv) in enumerate(merges):
            if u not in target or v not in target or uv in target:
                continue
            at = target[u]
            if not self._has(at, v):  # no path s -u-> at -v->: nothing to merge
                continue
            to = target[v]
            parent.append(at), dropped.append(v), made.append(rank)
            target[u] = len(parent) - 1
            target[uv] = to
            self.made_of[uv] = (rank, u)
        self._drops.clear()
        self.table: dict[int, bool] = {}
        #: The labels with arcs as a trie: node and byte -> node, and the label that ends at each node or -1.
        self.step: dict[int, int] = {}
        self.ends = [-1]
        for t in target:
            node = 0
            for b in labels[t]:
                node = self.step.setdefault(node << 8 | b, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(-1)
            self.ends[node] = t
        # the trie's inner nodes as rows of a table, for many words at once
        keys, to = np.array([*self.step], np.int64), np.array([*self.step.values()], np.int32)
        self.row = np.full(len(self.ends), -1, np.int32)
        inner = np.unique(keys >> 8)
        self.row[inner] = np.arange(len(inner))
        self.next = np.zeros((max(len(inner), 1), 256), np.int32)
        self.next[self.row[keys >> 8], keys & 255] = to
        self.end_of = np.array(self.ends, np.int64)
        self.target_of = np.zeros(max(target, default=0) + 1, np.int64)
        self.target_of[[*target]] = [*target.values()]
        #: Answers of `_has` by state << 20 | label, one for each value of a hash.
        self.asked, self.answer = np.full(ARC_SLOTS, -1, np.int64), np.zeros(ARC_SLOTS, bool)

    def _dropped_by(self, state: int) -> dict[int, int]:
        """label -> merge at which it went, along the copies that led to state."""
        got = self._drops.get(state)
        if got is None:
            chain, at = [], state
            while at > 0 and at not in self._drops:
                chain.append(at)
                at = self.parent[at]
            base = self._drops.get(at, {})
            got = dict(base)
            for s in reversed(chain):
                got.setdefault(self.dropped[s], self.made[s])
            if len(self._drops) > 60_000:
                self._drops.clear()
            self._drops[state] = got
        return got

    def _has(self, state: int, label: int) -> bool:
        """Whether state has an arc with this label: no label that it was made from had gone when it was made."""
        drops, before = self._dropped_by(state), len(self.made_of) + (1 << 40)
        while True:
            if drops.get(label, before + 1) <= before:
                return False
            got = self.made_of.get(label)
            if got is None:
                return True
            before, label = got

    def encode(self, word: bytes) -> list[int]:
        if word in self.id_of and self.id_of[word] in self.target and self._has(0, self.id_of[word]):
            return [self.id_of[word]]
        n, target, table, step, ends = len(word), self.target, self.table, self.step, self.ends
        state, last, back = [0] * (n + 1), [-1] * (n + 1), [0] * (n + 1)
        for j in range(n):
            at = state[j] << 20
            node = 0
            for i in range(j, n):
                node = step.get(node << 8 | word[i])
                if node is None:
                    break
                t = ends[node]
                if t < 0:
                    continue
                arc = table.get(at | t)
                if arc is None:
                    if len(table) > TABLE_ENTRIES:
                        table.clear()
                    arc = table[at | t] = self._has(state[j], t)
                if arc:
                    state[i + 1], last[i + 1], back[i + 1] = target[t], t, j
        out = []
        while n:
            out.append(last[n])
            n = back[n]
        return out[::-1]

    def _arcs(self, keys: np.ndarray) -> np.ndarray:
        """`_has` for keys state << 20 | label."""
        slot = (mix64(keys.astype(np.uint64)) % np.uint64(ARC_SLOTS)).astype(np.int64)
        out, lack = self.answer[slot], np.flatnonzero(self.asked[slot] != keys)
        if len(lack):
            new, first, which = np.unique(keys[lack], return_index=True, return_inverse=True)
            got = np.array([self._has(k >> 20, k & 0xFFFFF) for k in new.tolist()], bool)
            out[lack] = got[which]
            # one after the other where two keys have one slot: both arrays keep the last
            for place, key, has in zip(slot[lack[first]].tolist(), new.tolist(), got.tolist(), strict=True):
                self.asked[place], self.answer[place] = key, has
        return out

    def encode_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, offsets of the words in them); the steps of `encode`, taken by all words together."""
        size = np.array([len(w) for w in words], np.int64)
        data, start = np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size
        base = start + np.arange(len(words))  # a word's places: before each of its bytes, and its end
        state, last, back = (np.zeros(len(data) + len(words), np.int64) for _ in range(3))
        order = np.argsort(-size, kind="stable")
        by_size = -size[order]
        for j in range(int(size.max(initial=0))):
            who = order[: np.searchsorted(by_size, -j, "left")]
            at, node, i = state[base[who] + j] << 20, np.zeros(len(who), np.int32), j
            while len(who):
                node = self.next[self.row[node], data[start[who] + i]]
                i += 1
                t = self.end_of[node]
                some = np.flatnonzero((node > 0) & (t >= 0))
                some = some[self._arcs(at[some] | t[some])]
                place = base[who[some]] + i
                state[place], last[place], back[place] = self.target_of[t[some]], t[some], j
                go = np.flatnonzero((node > 0) & (self.row[node] >= 0) & (size[who] > i))
                who, at, node = who[go], at[go], node[go]
        used = np.zeros(len(state), bool)
        who, n = np.flatnonzero(size), size[size > 0]
        while len(who):
            used[base[who] + n] = True
            n = back[base[who] + n]
            who, n = who[n > 0], n[n > 0]
        return last[used], np.concatenate([[0], np.cumsum(used)])[np.append(base, len(state))]


_made: dict[str, "Codec"] = {}


class Codec:
    """Texts to ids and back with a byte-level vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        self.path = path
        spec = self._spec()
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        labels = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if t not in self.special}
        #: Ids as cached: two bytes where the vocabulary allows it.
        self.dtype = "<u2" if max([*vocab.values(), *self.special.values()]) < 1 << 16 else "<u4"
        self.arcs = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for i, b in labels.items():
            self.arcs[i] = b
        for t, i in self.special.items():
            self.arcs[i] = t.encode()
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.cache: dict[str, bytes] = {}

    def _spec(self) -> dict:
        with open(self.path, encoding="utf-8") as f:
            return json.load(f)

    @cached_property
    def automaton(self) -> Automaton:
        """Made by the first text that is encoded; a worker that only decodes holds the labels alone."""
        model = self._spec()["model"]
        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        special = set(self.special.values())
        return Automaton({i: self.arcs[i] for i in vocab.values() if i not in special}, [(vocab[u], vocab[v], vocab[u + v]) for u, v in pairs])

    def _learn(self, words: set[str], known: dict[str, bytes]) -> None:
        """Enters the ids of new words into known."""
        new = [w for w in words if len(w) <= CACHE_CHARS]
        ids, off = self.automaton.encode_all([w.encode("utf-8") for w in new])
        raw, off = ids.astype(self.dtype).tobytes(), (off * int(self.dtype[-1])).tolist()
        known.update({w: raw[a:z] for w, a, z in zip(new, off[:-1], off[1:], strict=True)})

    def _join(self, words: list[str], known: dict[str, bytes]) -> bytes:
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:  # words too long for the cache
            return b"".join([known[w] if w in known else np.array(self.automaton.encode(w.encode("utf-8")), self.dtype).tobytes() for w in words])

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned ids of dtype of each text."""
        parts = [self.split.split(t) if self.split is not None and self.split.search(t) else [t] for t in texts]
        words = [[x if x in self.special else (ASCII_WORDS if x.isascii() else WORDS).findall(x) for x in p if x] for p in parts]
        known = self.cache
        if len(known) > CACHE_ENTRIES:
            known.clear()
        new: set[str] = set()
        for p in words:
            for x in p:
                if not isinstance(x, str):
                    new.update(x)
        new = new.difference(known)
        if new:
            self._learn(new, known)
        return [b"".join([np.array([self.special[x]], self.dtype).tobytes() if isinstance(x, str) else self._join(x, known) for x in p]) for p in words]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.arcs.__getitem__, ids)).decode("utf-8", "replace")


def codec(path: str) -> Codec:
    """This worker's codec for a vocabulary; kept between tasks."""
    if path not in _made:
        _made[path] = Codec(path)
    return _made[path]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_texts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit) of whole texts."""

    def run(batches):
        made = codec(vocabulary)
        for rows, _, _ in text_chunks(batches, most=1 << 20):
            ids = [np.frombuffer(x, made.dtype).astype("<u4").tobytes() for x in made.encode_many([t or "" for t in rows.column("text").to_pylist()])]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_col()).mapInArrow(run, "doc_id long, ids binary")


def decode_ids(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """tokens (doc_id, ids) with text, the decoded ids."""

    def run(batches):
        made = codec(vocabulary)
        for rows, data, off in text_chunks(batches, "ids", 4 << 20):
            ids = data.view("<u4").tolist()
            cuts = (off // 4).tolist()
            texts = [made.decode(ids[a:z]) for a, z in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string())], [*rows.schema.names, "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def op2_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    path = vocabulary()
    tokens = decode_ids(encode_texts(read_table(spark, sf_dir, "documents"), path), path)
    return tokens.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
