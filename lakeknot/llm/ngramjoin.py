"""N-gram Jaccard join: exact links between documents whose word-shingle sets are alike, and their groups.

Sets are ordered rarest shingle first by counts over all documents, so a set's prefix (size - need + 1 shingles) meets
the prefix of every set that it links with. Work is skipped by the relations between sets, as in X. Wang et al.,
"Leveraging set relations in exact set similarity join":

* equal sets are one set: only the smallest document of each class is indexed;
* index lists are cut into blocks of one size range, each in order of places; from a set on, whole blocks out of its
  size range are skipped, and in the others all places from which the need can't be met;
* lists of at most LIST documents give their pairs; those whose parity sketches differ in more bits than two sets that
  link can are dropped (no link is: a shingle that one set lacks changes one bit), the others are checked on the whole
  sets (64-bit shingle hashes);
* longer ones (their shingles and counts are known beforehand) never do. Each has a centre, with which all its
  documents are compared; what links with it takes over its group, and the answers of the others are derived from
  the computed one: two documents share what the centre has, less what either has lost, plus what they have lost or
  added in common. No pair is left out, and none is sent.

`links` gives every link between the smallest documents of different sets; `groups` needs connections alone, so that in a star documents which
link with its centre are not compared with each other.

Shuffled data: packed hashes once for the counts, prefixes and sketches (a 64th to a 32nd of a set's bytes), pairs, the sets
of documents that have a candidate, and differences from centres. Sets are compared in rounds, each of which sends sets of about half the input's bytes
(`ROUND`) and drops its shuffles before the next: a document that is in many pairs or stars takes no more disk.

Results for odd rows: null texts and texts without words have an empty set and link with nothing; rows with a null
id are returned without a group; repeated rows link as equal sets, and so do the texts of rows that share an id; ties
go to the smaller id; a text of any length is one set; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import buckets_for, discard, input_bytes, mix64, read_table, release, run_hashes, split_rows, stored, text_chunks, text_col
from .graph import components

WORDS, PERCENT = 5, 80
#: Documents of an index list that gives its pairs at once.
LIST = 64
#: A shingle in more documents than this has its count sent to the tasks; doubled until at most HOT_MOST shingles are.
HOT, HOT_MOST = 8, 1_000_000
#: Ids up to which the documents that have a candidate are picked out by a broadcast; more are joined by a shuffle.
IDS_MOST = 2_000_000
#: Classes of equal sets with 1 / LARGE_MOST of all rows or more have their group sent to the tasks: at most so many.
LARGE_MOST = 4096
#: Share of the input's bytes that the sets of a round may have, and bytes that they always may.
ROUND, ROUND_LEAST = 0.5, 32 << 20
CHUNK = 1 << 20
#: Bits that counts leave out; shingles that differ in them alone are counted together, which moves both in the order, no more.
KEY = np.uint64(24)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LETTERS = mix64(np.arange(256, dtype=np.uint64))
_TURN = mix64(np.arange(1000, 1100, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(data: np.ndarray, off: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    with np.errstate(over="ignore"):
        low = _LOWER[data]
        gap = _SPACE[low]
        n = len(low)
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        start, stop = ~gap, ~gap
        start[1:] &= gap[:-1] | edge[1:-1]
        stop[:-1] &= gap[1:] | edge[1:-1]
        s, e = np.flatnonzero(start), np.flatnonzero(stop) + 1
        word = run_hashes(_LETTERS[low], s, e)
        first = np.searchsorted(s, off)
        m = len(word)
        full = np.zeros(max(0, m - words + 1), np.uint64)
        for k in range(words if m >= words else 0):
            full += mix64(word[k : m - words + 1 + k] * _TURN[k])
        full = mix64(full)
        out = []
        for a, z in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if z - a >= words:
                h = np.sort(full[a : z - words + 1])
                keep = np.ones(len(h), bool)
                np.not_equal(h[1:], h[:-1], out=keep[1:])
                out.append(h[keep])
            elif z > a:
                short = np.uint64(z - a)
                for k in range(z - a):
                    short = short + mix64(word[a + k : a + k + 1] * _TURN[k + words])[0]
                out.append(mix64(np.array([short], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def needed(n: int, percent: int = PERCENT) -> int:
    """Shingles that a set of n must share with any set that it links with."""
    return -(-percent * n // 100)


def _pack(*columns: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(c).tobytes() for c in columns)


def _unpack(blobs: list[bytes], *types: str) -> list[np.ndarray]:
    width = sum(np.dtype(t).itemsize for t in types)
    parts: list[list[np.ndarray]] = [[] for _ in types]
    for b in blobs:
        n, at = len(b) // width, 0
        for k, t in enumerate(types):
            parts[k].append(np.frombuffer(b, t, n, at))
            at += n * np.dtype(t).itemsize
    return [np.concatenate(p) if p else np.zeros(0, t) for p, t in zip(parts, types, strict=True)]


def _counts(base: DataFrame, buckets: int, words: int) -> DataFrame:
    """shingle, n: blobs of the 40 upper hash bits and the documents of every shingle in over HOT documents."""

    def out(batches):
        for _, data, off in text_chunks(batches, most=2 * CHUNK):
            h, n = np.unique(np.concatenate(shingle_sets(data, off, words)) >> KEY, return_counts=True)
            rows = split_rows((h % np.uint64(buckets)).astype(np.int64), buckets)
            blobs = [_pack((h[at] >> np.uint64(8)).astype("<u4"), (h[at] & np.uint64(0xFF)).astype("u1"), n[at].astype("<u4")) for _, at in rows]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "blob"])

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        hi, lo, n = _unpack(list(rows["blob"]), "<u4", "u1", "<u4")
        h = hi.astype(np.uint64) << np.uint64(8) | lo
        order = np.argsort(h)
        h, n = h[order], n[order]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
        n = np.add.reduceat(n.astype(np.int64), first) if len(h) else n
        hot = n > HOT
        return pd.DataFrame({"shingles": [h[first][hot].astype("<u8").tobytes()], "n": [n[hot].astype("<i8").tobytes()]})

    return base.mapInArrow(out, "bucket int, blob binary").groupBy("bucket").applyInPandas(total, "shingles binary, n binary")


def hot_shingles(base: DataFrame, buckets: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(40 upper hash bits, documents) of the shingles in the most documents: at most HOT_MOST of them.

    Any order of the shingles gives the same links, so the limit changes the work alone."""
    found = stored(_counts(base, buckets, words))
    least, size = HOT, F.length("n") / 8
    while (found.agg(F.sum(size)).head()[0] or 0) > HOT_MOST:
        least *= 2
        keep = least

        def run(batches, keep=keep):
            for b in batches:
                s, n = (_unpack(b.column(k).to_pylist(), "<u8" if k == 0 else "<i8")[0] for k in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array([s[n > keep].tobytes()], pa.binary()), pa.array([n[n > keep].tobytes()], pa.binary())], ["shingles", "n"])

        fewer = stored(found.mapInArrow(run, "shingles binary, n binary"))
        discard(found)
        found = fewer
    rows = found.toPandas()
    discard(found)
    s, n = _unpack(list(rows["shingles"]), "<u8")[0], _unpack(list(rows["n"]), "<i8")[0]
    order = np.argsort(s)
    return s[order], n[order]


def sketch(s: np.ndarray) -> bytes:
    """The parity of the shingles at each of a power of two of places, from the set's size on and 64 at least."""
    bits = 1 << max(6, (len(s) - 1).bit_length())
    at = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(at.astype(np.uint8), bitorder="little").tobytes()


def able(n: int, m: int, x: bytes, y: bytes, percent: int) -> bool:
    """Whether sets of n and m shingles with these sketches may link: they differ in as many shingles as sketches do in bits, or more."""
    p, q = int.from_bytes(x, "little"), int.from_bytes(y, "little")
    size = min(len(x), len(y))
    for k, v in enumerate((x, y)):
        length = len(v)
        while length > size:  # a place of the smaller sketch is that of two halves
            length //= 2
            if k:
                q = (q >> 8 * length) ^ (q & ((1 << 8 * length) - 1))
            else:
                p = (p >> 8 * length) ^ (p & ((1 << 8 * length) - 1))
    shared = (n + m - (p ^ q).bit_count()) // 2
    return 100 * shared >= percent * (n + m - shared)


def _prefixes(base: DataFrame, hot: np.ndarray, hot_n: np.ndarray, words: int, percent: int) -> DataFrame:
    """doc_id, n, digest of the set, prefix (hashes, rarest first), sketch of the set."""

    def run(batches):
        for rows, data, off in text_chunks(batches, most=CHUNK):
            n, digest, prefix, parity = [], [], [], []
            sets = shingle_sets(data, off, words)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            key = flat >> KEY
            at = np.minimum(np.searchsorted(hot, key), max(0, len(hot) - 1))
            count = np.where(hot[at] == key, hot_n[at], 0) if len(hot) else np.zeros(len(flat), np.int64)
            end = 0
            for s in sets:
                begin, end = end, end + len(s)
                k = len(s) - needed(len(s), percent) + 1 if len(s) else 0
                c = count[begin:end]
                cool = np.flatnonzero(c == 0)[:k]
                if len(cool) < k:
                    warm = np.flatnonzero(c)
                    cool = np.concatenate([cool, warm[np.lexsort((s[warm], c[warm]))][: k - len(cool)]])
                n.append(len(s)), digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest()), prefix.append(s[cool].tobytes()), parity.append(sketch(s))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(n, pa.int64()), *[pa.array(x, pa.binary()) for x in (digest, prefix, parity)]], ["doc_id", "n", "digest", "prefix", "sketch"])

    return base.mapInArrow(run, "doc_id long, n long, digest binary, prefix binary, sketch binary")


def _postings(reps: DataFrame, hot: np.ndarray, hot_n: np.ndarray, buckets: int, long: bool) -> DataFrame:
    """Of shingles in at most LIST documents: bucket, blob of (shingle, doc, n, place); of the others: shingle, doc, n."""
    listed = hot[hot_n > LIST]

    def run(batches):
        for rows, data, off in text_chunks(batches, "prefix", 1 << 21):
            h = data.view("<u8")
            size = off // 8
            doc = np.repeat(rows.column("doc_id").to_numpy(), np.diff(size))
            n = np.repeat(rows.column("n").to_numpy(), np.diff(size))
            place = np.arange(len(h)) - np.repeat(size[:-1], np.diff(size))
            key = h >> KEY
            at = np.minimum(np.searchsorted(listed, key), max(0, len(listed) - 1))
            many = listed[at] == key if len(listed) else np.zeros(len(h), bool)
            if long:
                yield pa.RecordBatch.from_arrays([pa.array(h[many].view(np.int64)), pa.array(doc[many], pa.int64()), pa.array(n[many], pa.int64())], ["shingle", "doc", "n"])
                continue
            h, doc, n, place = h[~many], doc[~many], n[~many], place[~many]
            split = split_rows((h % np.uint64(buckets)).astype(np.int64), buckets)
            blobs = [_pack(h[i].astype("<u8"), doc[i].astype("<i8"), n[i].astype("<u4"), place[i].astype("<u4")) for _, i in split]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in split], pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "blob"])

    return reps.select("doc_id", "n", "prefix").mapInArrow(run, "shingle long, doc long, n long" if long else "bucket int, blob binary")


#: Entries of a block of an index list; its sizes differ by at most a RANGE-th.
SKIP, RANGE = 8, 16


def list_blocks(n: list[int], place: list[int]) -> list[tuple[int, int, list[int], list[int]]]:
    """(least size, largest size, places in order, their entries) of the blocks of a list that is in order of sizes."""
    out, at = [], 0
    while at < len(n):
        to = at + 1
        while to < len(n) and to - at < SKIP and (n[to] - n[at]) * RANGE <= n[at]:
            to += 1
        members = sorted(range(at, to), key=place.__getitem__)
        out.append((n[at], n[to - 1], [place[i] for i in members], members))
        at = to
    return out


def list_pairs(doc: np.ndarray, n: np.ndarray, place: np.ndarray, percent: int = PERCENT) -> tuple[list[tuple[int, int]], int]:
    """(pairs of one index list that may link, entries that were looked at).

    From each set, blocks of larger sizes are read until the sizes are out of range; in a block only the stretch of
    places is read from which the need can still be met, which may be none of it."""
    order = np.lexsort((place, n))
    doc, n, place = doc[order].tolist(), n[order].tolist(), place[order].tolist()
    blocks = list_blocks(n, place)
    of = [k for k, b in enumerate(blocks) for _ in b[3]]
    out, seen = [], 0
    for i in range(len(doc)):
        most = 100 * n[i] // percent  # the largest size that still links
        p, left = place[i], n[i] - place[i]
        for k in range(of[i], len(blocks)):
            lo, hi, places, members = blocks[k]
            if lo > most:
                break
            # shared: at most the shingles before both places, and from them on
            least = needed(max(lo, n[i]), percent)
            for at in range(bisect_left(places, least - left), bisect_right(places, hi - least + p)):
                j = members[at]
                if j <= i:
                    continue
                seen += 1
                if n[j] <= most and 100 * (min(p, place[j]) + min(left, n[j] - place[j])) >= percent * n[j]:
                    out.append((min(doc[i], doc[j]), max(doc[i], doc[j])))
    return out, seen


def _pairs(percent: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        h, doc, n, place = _unpack(list(rows["blob"]), "<u8", "<i8", "<u4", "<u4")
        order = np.argsort(h, kind="stable")
        h, doc, n, place = h[order], doc[order], n[order].astype(np.int64), place[order].astype(np.int64)
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(h)))
        found: set[tuple[int, int]] = set()
        for at, k in zip(first[size > 1].tolist(), size[size > 1].tolist(), strict=True):
            found.update(list_pairs(doc[at : at + k], n[at : at + k], place[at : at + k], percent)[0])
        return pd.DataFrame(sorted(found), columns=["a", "b"], dtype="int64")

    return run


def _able(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs that may link by their sketches."""

    def run(batches):
        for b in batches:
            keep = [able(*x, percent) for x in zip(*(b.column(c).to_pylist() for c in ("na", "nb", "sa", "sb")), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda c: reps.select(F.col("doc_id").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link, checked on whole sets."""

    def run(batches):
        for b in batches:
            a, z, keep = b.column("sa"), b.column("sb"), []
            for x, y in zip(a, z, strict=True):
                p, q = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                at = np.searchsorted(q, p)
                shared = int((q[np.minimum(at, len(q) - 1)] == p).sum())
                keep.append(100 * shared >= percent * (len(p) + len(q) - shared))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a").join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b")
    return joined.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _sets(base: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    def run(batches):
        for rows, data, off in text_chunks(batches, most=CHUNK):
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array([s.tobytes() for s in shingle_sets(data, off, words)], pa.binary())], ["doc_id", "shingles"])

    some = F.broadcast(ids) if ids.count() <= IDS_MOST else ids
    # rows that share an id count once; their sets would be compared with themselves
    return base.join(some, "doc_id", "left_semi").mapInArrow(run, "doc_id long, shingles binary")


def _rounds(rows: DataFrame, by: str, n, room: int) -> list[DataFrame]:
    """rows cut by a hash of a column, so that each part's sets (n shingles in a row) have about room bytes."""
    parts = int(-(-(rows.agg(F.sum(n * 8)).head()[0] or 0) // room))
    return [rows.where(F.pmod(F.xxhash64(F.lit(parts), by), F.lit(parts)) == k) for k in range(parts)] if parts > 1 else [rows]


def _united(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _ids(rows: DataFrame, *columns: str) -> DataFrame:
    """doc_id: the documents in these columns of rows, once each; stored."""
    return stored(_united([rows.select(F.col(c).alias("doc_id")) for c in columns]).distinct())


#: Documents of a star that one task compares with as many others.
BLOCK = 4096
#: Documents that share at least NEAR of a star's centre are told by their differences from it, others by their sets.
NEAR = 0.5
_EXTRA = np.uint64(1 << 63)


def _differences(joined: DataFrame, percent: int) -> DataFrame:
    """center, doc, near, size (of the centre), lost, added, tokens: how a document differs from its centre, or its set.

    A document below NEAR can only link with those that lie at most the link's distance above it, so these are told
    both ways and no pair is lost."""

    def run(batches):
        for b in batches:
            out = []
            for center, doc, x, o in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
                x, o = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(o.as_buffer(), "<u8")
                at = np.searchsorted(o, x)
                has = o[np.minimum(at, len(o) - 1)] == x
                shared = int(has.sum())
                alike = shared / (len(x) + len(o) - shared)
                if alike >= NEAR:
                    kept = np.zeros(len(o), bool)
                    kept[at[has]] = True
                    out.append((center, doc, True, len(o), len(o) - shared, len(x) - shared, _pack(np.flatnonzero(~kept).astype("<u8"), x[~has] | _EXTRA)))
                if alike <= NEAR + 1 - percent / 100:
                    out.append((center, doc, False, len(o), 0, len(x), x.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["center", "doc", "near", "size", "lost", "added", "tokens"])

    return joined.mapInArrow(run, "center long, doc long, near boolean, size long, lost long, added long, tokens binary")


def star_links(rows: pd.DataFrame, percent: int = PERCENT, every: bool = False) -> list[tuple[int, int]]:
    """Links of a star between rows that ask and rows that answer: those that connect anew, or every one.

    The shingles that two documents share follow from the centre's size, what each has lost and added, and what of this
    they have in common; a document that links with the centre needs no further answer."""
    answer, ask = rows[rows["answers"]], rows[~rows["answers"]]
    near = bool(rows["near"].iloc[0])
    docs, lost, added = (answer[c].to_numpy(np.int64) for c in ("doc", "lost", "added"))
    size = int(rows["size"].iloc[0]) if near else 0
    tokens = [np.frombuffer(t, "<u8") for t in answer["tokens"]]
    flat = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    keys, row = flat[order], np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])[order]
    parent = {int(d): int(d) for d in [*docs.tolist(), *ask["doc"].tolist()]}

    def root(d: int) -> int:
        while parent[d] != d:
            parent[d] = parent[parent[d]]
            d = parent[d]
        return d

    total, out = size - lost + added, []
    for doc, l, a, t in zip(ask["doc"].tolist(), ask["lost"].tolist(), ask["added"].tolist(), ask["tokens"], strict=True):
        t = np.frombuffer(t, "<u8")
        lo, hi = np.searchsorted(keys, t, "left"), np.searchsorted(keys, t, "right")
        common = np.bincount(np.concatenate([row[x:z] for x, z in zip(lo.tolist(), hi.tolist(), strict=True)]) if len(t) else np.zeros(0, np.int64), minlength=len(docs))
        shared = size - l - lost + common if near else common
        hit = (100 * shared >= percent * (size - l + a + total - shared)) & (docs != doc)
        for other in docs[hit].tolist():
            p, q = root(doc), root(other)
            if every or p != q:
                parent[max(p, q)] = min(p, q)
                out.append((min(doc, other), max(doc, other)))
    return out


def _told(members: DataFrame, known: DataFrame, words: int, percent: int, room: int) -> list[DataFrame]:
    """The documents of the long lists (shingle, doc, n) by their differences from a centre, in rounds; stored.

    A list's centre is the document in the most long lists: copies spend their prefixes on what only they have, what
    they were made from does not. All documents of the lists of a centre form a star and are told by their
    differences from it; those that do not link with it are compared with the others, in blocks, by these alone."""
    often = members.groupBy("doc").agg(F.count("*").alias("k"))
    best = members.join(often, "doc").groupBy("shingle").agg(F.max(F.struct("k", (-F.col("doc")).alias("d"))).alias("p")).select("shingle", (-F.col("p.d")).alias("center"))
    stars = stored(members.join(best, "shingle").select("center", "doc", "n").distinct())
    told = []
    for part in _rounds(stars, "doc", F.col("n"), room):
        ids = _ids(part, "doc", "center")
        sets = _sets(known, ids, words)
        joined = part.join(sets.select(F.col("doc_id").alias("doc"), F.col("shingles").alias("x")), "doc").join(sets.select(F.col("doc_id").alias("center"), F.col("shingles").alias("o")), "center")
        told.append(stored(_differences(joined.select("center", "doc", "x", "o"), percent), "none"))
        discard(ids)
        del sets, joined
        release(members.sparkSession)
    discard(stars)
    return told


def _star_pairs(told: DataFrame, percent: int, every: bool) -> DataFrame:
    """a, b: links between documents that share a long list. Blocks of those that ask meet blocks of those that answer."""
    inside = F.col("size") - F.col("lost")
    linked = F.col("near") & (100 * inside >= percent * (F.col("size") + F.col("added")))
    direct = told.where(linked & (F.col("doc") != F.col("center"))).select(F.least("doc", "center").alias("a"), F.greatest("doc", "center").alias("b"))
    told = told.withColumn("asks", F.lit(True) if every else ~linked)
    some = lambda n: F.ceil(n / BLOCK).cast("int")
    blocks = told.groupBy("center", "near").agg(some(F.count("*")).alias("answer_blocks"), some(F.count_if("asks")).alias("ask_blocks")).where(F.col("ask_blocks") > 0)
    dealt = told.join(blocks, ["center", "near"])
    own = lambda n: F.pmod(F.xxhash64("doc"), n).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    answers = dealt.withColumns({"j": own("answer_blocks"), "answers": F.lit(True)}).withColumn("i", all_of("ask_blocks"))
    asks = dealt.where("asks").withColumns({"i": own("ask_blocks"), "answers": F.lit(False)}).withColumn("j", all_of("answer_blocks"))
    sent = answers.select("center", "near", "i", "j", "answers", "doc", "size", "lost", "added", "tokens").unionByName(asks.select("center", "near", "i", "j", "answers", "doc", "size", "lost", "added", "tokens"))
    found = sent.groupBy("center", "near", "i", "j").applyInPandas(lambda rows: pd.DataFrame(star_links(rows, percent, every), columns=["a", "b"], dtype="int64"), "a long, b long")
    return direct.unionByName(found)


def _joined(docs: DataFrame, words: int, percent: int, every: bool) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(doc_id, n, digest of every row; links between the smallest documents of classes; tables that these read)."""
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_col())
    known = base.where(F.col("doc_id").isNotNull())
    buckets = buckets_for(spark, input_bytes(docs))
    hot, hot_n = hot_shingles(known, buckets, words)
    release(spark)
    prefixes = stored(_prefixes(base, hot, hot_n, words, percent), "none")
    small = stored(prefixes.select("doc_id", "n", "digest"))
    indexed = prefixes.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    reps = stored(indexed.groupBy("digest").agg(F.min(F.struct("doc_id", "n", "prefix", "sketch")).alias("r")).select("r.*"), "none")
    discard(prefixes)
    release(spark)
    met = stored(_postings(reps, hot, hot_n, buckets, False).groupBy("bucket").applyInPandas(_pairs(percent), "a long, b long").distinct())
    release(spark)
    pairs = stored(_able(met, reps, percent))
    discard(met)
    release(spark)
    members = stored(_postings(reps, hot, hot_n, buckets, True))
    discard(reps)
    # the sets of documents with a candidate are made where they are compared; shuffled once, they serve both sides
    room = max(ROUND_LEAST, int(ROUND * input_bytes(docs)))
    mean = small.where(F.col("n") > 0).agg(F.avg("n")).head()[0] or 0
    links = []
    for part in _rounds(pairs, "a", F.lit(mean), room):
        ids = _ids(part, "a", "b")
        links.append(stored(_verified(part, _sets(known, ids, words), percent)))
        discard(ids)
        release(spark)
    discard(pairs)
    told = _told(members, known, words, percent, room)
    discard(members)
    return small, _united(links).unionByName(_star_pairs(_united(told), percent, every)), [*links, *told]


def links(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """a, b: every link between different sets, each by its smallest document (a < b)."""
    _, found, _ = _joined(docs, words, percent, True)
    return found.distinct()


def _least(small: DataFrame) -> DataFrame:
    return small.where(F.col("doc_id").isNotNull() & (F.col("n") > 0)).groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows"))


def groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id, text)."""
    small, found, tables = _joined(docs, words, percent, False)
    star = components(found)
    of_class = stored(_least(small).join(star.withColumnRenamed("node", "rep"), "rep", "left").select("digest", "rows", F.coalesce("component", "rep").alias("group")))
    discard(*tables)
    release(docs.sparkSession)
    # at most LARGE_MOST classes hold that share of all rows, so they can be sent; no key of the shuffled join is hot then
    large = F.broadcast(of_class.where(F.col("rows") * LARGE_MOST >= small.count()).select("digest", "group"))
    full = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    own = small.where(full)
    alone = small.where(~full).withColumn("group", F.lit(None).cast("long"))
    rest = own.join(large.select("digest"), "digest", "left_anti").join(of_class.select("digest", "group"), "digest", "left")
    out = own.join(large, "digest").unionByName(rest).unionByName(alone)
    group = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("group")).otherwise(F.col("doc_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), group.alias("component_id"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(read_table(spark, sf_dir, "documents"), words=4, percent=85)
