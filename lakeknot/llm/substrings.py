"""Suffix-array dedup: removes every byte covered by a LENGTH-byte string that also starts in a document with a smaller id.

Suffixes are sampled by content: a gram of GRAM bytes is an anchor when its hash is the least in some window of
LENGTH - GRAM + 1 grams, so every LENGTH-byte string holds an anchor, the same one wherever it stands. An
anchor's context is all that a LENGTH-byte string around it can hold.

1. Anchors go, packed, to buckets by gram. Of equal contexts only the smallest document's stays; in the others every
   string around the anchor is a repeat. Tasks drop what they have sent for a smaller document already, so a
   passage in a third of all documents sends one context a task, not one a document.
2. Contexts that share a gram but differ, the borders of repeats, are brought together. Each gram's suffixes are
   sorted with their common prefixes (an enhanced suffix array); a stack scan gives its tree of common-prefix
   intervals; in each interval the left contexts are scanned alike, which tests left-extension diversity and gives
   the maximal repeats with all occurrences. All but those in the smallest document are removed.

Step 1 compares hashes, not bytes: 40 bits of the gram's and 48 of the context's. Among the 7e12 anchors of 100 TB (2e25
pairs) 0.07 false repeats are expected, among those of 100 GB fewer than 1e-7. It exists because most repeats are whole
equal contexts, and any number of those needs one row a task; step 2, which decides all borders, compares bytes.

What is decided goes back to the texts as byte ranges, by joins on doc_id. Matches are on UTF-8 bytes and never cross
documents; overlaps count; strings are judged on the input, not on what is left.

Results for odd rows: null texts are empty; texts under LENGTH bytes lose nothing; rows with a null id are returned
whole; rows that share an id are one document: they don't match each other, and a range that goes from one goes from
all; of equal texts the smallest id's stays; a text of any length is read whole, in a chunk of its own; an empty table
gives no rows; other columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import buckets_for, column, input_bytes, mix64, powers, read_table, release, run_hashes, split_rows, stored, text_chunks, text_col

LENGTH, GRAM = 50, 20
CHUNK = 2 << 20
#: Contexts that a task remembers to have sent.
SENT_MOST = 500_000
#: Stands for what lies outside a document; no byte of UTF-8.
OUTSIDE = 0xFF

_LETTERS = mix64(np.arange(2000, 2256, dtype=np.uint64))


def grams(x: np.ndarray, k: int) -> np.ndarray:
    """The polynomial of each run of k letters."""
    if k == 1:
        return x
    half = k // 2
    p = powers(k + 1)[0]
    g = grams(x, half)
    g = g[: len(g) - half] * p[half] + g[half:]
    return g[:-1] * p[1] + x[k - 1 :] if k % 2 else g


def _slide(x: np.ndarray, w: int, f) -> np.ndarray:
    """f over each window of w."""
    n, size, out = len(x) - w + 1, 1, x
    while size * 2 <= w:
        out = f(out[:-size], out[size:])
        size *= 2
    return f(out[:n], out[w - size : w - size + n]) if size < w else out


def anchors(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(place in data, gram hash, context hash, bytes before, bytes from it on) of the anchors that lie in a string of `length` bytes of one text."""
    w = length - gram + 1
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    with np.errstate(over="ignore"):
        x = _LETTERS[data]
        h = mix64(grams(x, gram))
        rank = (h >> np.uint64(32)).astype(np.uint32)
        inside = np.ones(len(h), bool)
        for cut in off[1:-1].tolist():  # grams across two texts
            inside[max(0, cut - gram + 1) : cut] = False
        rank[~inside] = 0xFFFFFFFF
        low = _slide(rank, w, np.minimum) if len(rank) >= w else np.array([rank.min()], np.uint32)
        edge = np.zeros(w - 1, np.uint32)
        top = _slide(np.concatenate([edge, low, edge]), w, np.maximum)[: len(rank)]
        at = np.flatnonzero((top == rank) & inside)
        doc = np.searchsorted(off, at, "right") - 1
        before, after = np.minimum(at - off[doc], length - gram), np.minimum(off[doc + 1] - at, length)
        some = before + after >= length
        at, before, after = at[some], before[some], after[some]
        context = run_hashes(x, at - before, at + after) ^ mix64((before * 256 + after).astype(np.uint64))
        return at, h[at], context, before, after


def _planes(x: np.ndarray, size: int) -> bytes:
    """The lowest bytes of each number, all first bytes first: equal planes compress to nothing."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def _unplanes(blobs: list[bytes], sizes: tuple[int, ...]) -> list[np.ndarray]:
    width, parts = sum(sizes), [[] for _ in sizes]
    for b in blobs:
        n, at = len(b) // width, 0
        raw = np.frombuffer(b, np.uint8)
        for k, s in enumerate(sizes):
            full = np.zeros((n, 8), np.uint8)
            full[:, :s] = raw[at : at + n * s].reshape(s, n).T
            parts[k].append(full.view("<u8").ravel())
            at += n * s
    return [np.concatenate(p) if p else np.zeros(0, np.uint64) for p in parts]


#: Bytes of: gram hash, context hash, doc_id, place, before, after.
ANCHOR = (5, 6, 8, 4, 1, 1)
#: Bytes of: doc_id, start, end, whether the anchor at start is open.
RANGE = (8, 4, 4, 1)


def _send(parts: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p for p, _ in parts], pa.int32()), pa.array([b for _, b in parts], pa.binary())], ["part", "blob"])


def _ranges(doc: np.ndarray, start: np.ndarray, end: np.ndarray, open_: np.ndarray, groups: int, first: int = 0) -> list[tuple[int, bytes]]:
    """The ranges by group of documents."""
    where = (mix64(doc.astype(np.uint64)) % np.uint64(groups)).astype(np.int64)
    return [(first + g, b"".join([_planes(doc[i].astype(np.int64).view(np.uint64), 8), _planes(start[i], 4), _planes(end[i], 4), _planes(open_[i], 1)])) for g, i in split_rows(where, groups)]


def _emit(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent, least = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # contexts met in several documents, and the smallest that was sent
        for rows, data, off in text_chunks(batches, most=CHUNK):
            at, h, c, before, after = anchors(data, off)
            ids = rows.column("doc_id").to_numpy()
            row = np.searchsorted(off, at, "right") - 1
            doc, place = ids[row], at - off[row]
            key = mix64(h) ^ c
            order = np.lexsort((doc, key))
            k, d = key[order], doc[order]
            new = np.r_[True, k[1:] != k[:-1]] if len(k) else np.zeros(0, bool)
            group = np.cumsum(new) - 1
            smallest = d[new]
            found = np.minimum(np.searchsorted(sent, k[new]), max(0, len(sent) - 1))
            known = sent[found] == k[new] if len(sent) else np.zeros(int(new.sum()), bool)
            limit = np.where(known, np.minimum(smallest, least[found]) if len(sent) else smallest, smallest)
            repeat = np.empty(len(k), bool)
            repeat[order] = d > limit[group]
            if len(sent):
                least[found[known]] = limit[known]
            several = np.bincount(group, np.r_[0, (d[1:] != d[:-1]) | new[1:]] if len(d) else d, int(new.sum())) > 1
            several &= ~known
            if several.any() and len(sent) < SENT_MOST:
                sent, least = np.concatenate([sent, k[new][several]]), np.concatenate([least, smallest[several]])
                by = np.argsort(sent)
                sent, least = sent[by], least[by]
            stay = ~repeat
            parts = []
            for p, i in split_rows((h[stay] % np.uint64(buckets)).astype(np.int64), buckets):
                i = np.flatnonzero(stay)[i]
                parts.append((p, b"".join([_planes(h[i] >> np.uint64(24), 5), _planes(c[i], 6), _planes(doc[i].view(np.uint64), 8), _planes(place[i], 4), _planes(before[i], 1), _planes(after[i], 1)])))
            if repeat.any():
                parts += _ranges(doc[repeat], (place - before)[repeat], (place + after)[repeat], np.zeros(int(repeat.sum()), np.int64), buckets, buckets)
            if parts:
                yield _send(parts)

    return run


def _resolve(buckets: int):
    """Anchors of a bucket to ranges by group of documents: repeats of a context, and open anchors."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        if int(key[0]) >= buckets:
            return pd.DataFrame({"part": [int(key[0]) - buckets] * len(rows), "blob": list(rows["blob"])})
        h, c, doc, place, before, after = _unplanes(list(rows["blob"]), ANCHOR)
        doc = doc.view(np.int64)
        order = np.lexsort((doc, c, h))
        h, c, doc, place, before, after = (x[order] for x in (h, c, doc, place.astype(np.int64), before.astype(np.int64), after.astype(np.int64)))
        n = len(h)
        new_h = np.r_[True, h[1:] != h[:-1]]
        new_c = new_h | np.r_[True, c[1:] != c[:-1]]
        least = doc[new_c][np.cumsum(new_c) - 1]
        repeat = doc > least
        gram = np.cumsum(new_h) - 1
        first, last = np.full(int(new_h.sum()), np.iinfo(np.int64).max), np.full(int(new_h.sum()), np.iinfo(np.int64).min)
        np.minimum.at(first, gram[new_c], doc[new_c])
        np.maximum.at(last, gram[new_c], doc[new_c])
        # several contexts whose smallest documents differ
        open_ = ~repeat & (first[gram] != last[gram])
        use = repeat | open_
        parts = _ranges(doc[use], np.where(open_, place, place - before)[use], (place + after)[use], open_[use].astype(np.int64), buckets) if n else []
        return pd.DataFrame(parts, columns=["part", "blob"])

    return run


def merged(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The union of ranges, as rows (start, end) by start."""
    if not len(start):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.r_[True, start[1:] > end[:-1]]
    return np.stack([start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]], 1)


def _by_document(rows: pd.DataFrame) -> pd.DataFrame:
    doc, start, end, open_ = _unplanes(list(rows["blob"]), RANGE)
    doc = doc.view(np.int64)
    order = np.lexsort((start, doc))
    doc, start, end, open_ = doc[order], start[order].astype(np.int64), end[order].astype(np.int64), open_[order] > 0
    cuts = np.append(np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]), len(doc)) if len(doc) else np.zeros(1, np.int64)
    out = []
    for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        o = open_[a:z]
        out.append((int(doc[a]), merged(start[a:z][~o], end[a:z][~o]).astype("<i8").tobytes(), np.unique(start[a:z][o]).astype("<i8").tobytes()))
    return pd.DataFrame(out, columns=["doc_id", "ranges", "open"])


DECIDED = "doc_id long, ranges binary, open binary"


def _contexts(buckets: int):
    """Open anchors with their contexts, by gram."""

    def run(batches):
        for rows, data, off in text_chunks(batches, most=CHUNK // 2):
            opened = [np.frombuffer(b.as_buffer(), "<i8") for b in rows.column("open")]
            size = np.array([len(o) for o in opened])
            row = np.repeat(np.arange(len(size)), size)
            if not len(row):
                continue
            place = np.concatenate(opened)
            at = off[row] + place
            before, after = np.minimum(place, LENGTH - GRAM), np.minimum(off[row + 1] - at, LENGTH)
            step = np.arange(-(LENGTH - GRAM), LENGTH)
            where = at[:, None] + step
            text = data[np.clip(where, 0, len(data) - 1)]
            text[(step < -before[:, None]) | (step >= after[:, None])] = OUTSIDE
            h = mix64(grams(_LETTERS[text[:, LENGTH - GRAM : LENGTH].ravel()], GRAM)[::GRAM])
            doc = rows.column("doc_id").to_numpy()[row]
            yield _send([(p, b"".join([_planes(h[i], 8), _planes(doc[i].view(np.uint64), 8), _planes(place[i], 4), np.ascontiguousarray(text[i]).tobytes()])) for p, i in split_rows((h % np.uint64(buckets)).astype(np.int64), buckets)])

    return run


def intervals(common: list[int]) -> Iterator[tuple[int, int, int]]:
    """(common length, first, last) of the common-prefix intervals of a sorted list, common[i] being that of entries i and i + 1; children first."""
    stack: list[tuple[int, int]] = []
    for i, size in enumerate([*common, -1]):
        first = i
        while stack and stack[-1][0] > size:
            top, first = stack.pop()
            yield top, first, i
        if size >= 0 and (not stack or stack[-1][0] < size):
            stack.append((size, first))


def repeats(left: list[int], right_common: list[int], before: list[int], least: int, width: int) -> Iterator[tuple[int, int, list[int]]]:
    """(bytes to the left, to the right, occurrences) of the maximal repeats of at least `least` bytes around one gram.

    Entries are in the order of their suffixes; left: their reversed left contexts as numbers of `width` bytes;
    right_common: common prefixes of neighbours."""
    bits = width * 8
    for size, first, last in intervals(right_common):
        if size + width < least:
            continue
        if last == first + 1:
            e = min((bits - (left[first] ^ left[last]).bit_length()) // 8, before[first], before[last])
            if e + size >= least:
                yield e, size, [first, last]
            continue
        members = sorted(range(first, last + 1), key=left.__getitem__)
        common = [min((bits - (left[i] ^ left[j]).bit_length()) // 8, before[i], before[j]) for i, j in zip(members, members[1:], strict=False)]
        for e, a, z in intervals(common):
            if e + size >= least:
                yield e, size, members[a : z + 1]


def _maximal(buckets: int):
    """Contexts of a bucket to ranges by group of documents."""
    reach = LENGTH - GRAM

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [[], [], [], []]
        size = 20 + reach + LENGTH
        for b in rows["blob"]:
            n = len(b) // size
            for k, x in enumerate(_unplanes([b[: n * 20]], (8, 8, 4))):
                parts[k].append(x)
            parts[3].append(np.frombuffer(b, np.uint8, n * (reach + LENGTH), n * 20).reshape(n, -1))
        h, doc, place, text = (np.concatenate(p) for p in parts)
        doc, place = doc.view(np.int64), place.astype(np.int64)
        right = np.ascontiguousarray(text[:, reach:])
        sort_key = np.concatenate([h.astype(">u8").view(np.uint8).reshape(-1, 8), right], 1)
        order = np.argsort(np.ascontiguousarray(sort_key).view(f"S{sort_key.shape[1]}").ravel(), kind="stable")
        h, doc, place, text, right = h[order], doc[order], place[order], text[order], right[order]
        n = len(h)
        before, after = np.minimum(place, reach), (right != OUTSIDE).sum(1)
        common = np.zeros(max(0, n - 1), np.int64)
        for a in range(0, n - 1, 1 << 16):
            z = min(n - 1, a + (1 << 16))
            differ = right[a:z] != right[a + 1 : z + 1]
            common[a:z] = np.where(differ.any(1), differ.argmax(1), LENGTH)
        common = np.minimum(common, np.minimum(after[:-1], after[1:]))
        common[h[1:] != h[:-1]] = 0
        lefts = [int.from_bytes(x, "big") for x in np.ascontiguousarray(text[:, reach - 1 :: -1] if reach else text[:, :0]).reshape(n, -1)[:, :reach].copy().view(f"V{reach}").ravel().tolist()] if reach else [0] * n
        befores, docs, commons, places = before.tolist(), doc.tolist(), common.tolist(), place.tolist()
        out_doc, out_start, out_end = [], [], []
        cuts = np.append(np.flatnonzero(np.r_[True, common < GRAM]), n).tolist() if n else [0]
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            if z - a < 2:
                continue
            for e, size, members in repeats(lefts[a:z], commons[a : z - 1], befores[a:z], LENGTH, reach):
                least = min(docs[a + m] for m in members)
                for m in members:
                    if docs[a + m] > least:
                        out_doc.append(docs[a + m]), out_start.append(places[a + m] - e), out_end.append(places[a + m] + size)
        d = np.array(out_doc, np.int64)
        return pd.DataFrame(_ranges(d, np.array(out_start, np.int64), np.array(out_end, np.int64), np.zeros(len(d), np.int64), buckets) if len(d) else [], columns=["part", "blob"])

    return run


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """doc_id, ranges: the bytes to remove, as little-endian 64-bit pairs; stored, a row for each decision step and document."""
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH))
    buckets = buckets_for(spark, input_bytes(docs))
    blob = "part int, blob binary"
    first = stored(base.mapInArrow(_emit(buckets), blob).groupBy("part").applyInPandas(_resolve(buckets), blob).groupBy("part").applyInPandas(_by_document, DECIDED))
    release(spark)
    opened = first.where(F.length("open") > 0).select("doc_id", "open")
    contexts = base.join(opened, "doc_id").select("doc_id", "text", "open").mapInArrow(_contexts(buckets), blob)
    second = stored(contexts.groupBy("part").applyInPandas(_maximal(buckets), blob).groupBy("part").applyInPandas(_by_document, DECIDED))
    release(spark)
    return first.unionByName(second).where(F.length("ranges") > 0).select("doc_id", "ranges")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """row (a struct of all columns of docs but text), n_bytes, kept (the bytes that stay) and ranges (array of start, end: the maximal removed runs)."""
    ranges = repeated_ranges(docs).groupBy("doc_id").agg(F.collect_list("ranges").alias("ranges"))
    rest = F.struct(*[column(c).alias(c) for c in docs.columns if c != "text"])
    base = docs.select(F.col("doc_id").cast("long").alias("key"), rest.alias("row"), text_col())
    joined = base.join(ranges, F.col("key") == F.col("doc_id"), "left").select("row", "text", F.concat_ws("", F.transform("ranges", lambda x: F.hex(x))).alias("cuts"))
    schema = StructType([joined.schema["row"], *StructType.fromDDL("n_bytes long, kept binary, ranges array<struct<start:long,end:long>>")])

    def run(batches):
        for rows, data, off in text_chunks(batches, most=CHUNK):
            n, kept, ranges = [], [], []
            for a, z, x in zip(off[:-1].tolist(), off[1:].tolist(), rows.column("cuts").to_pylist(), strict=True):
                pairs = np.frombuffer(bytes.fromhex(x), "<i8").reshape(-1, 2)
                runs = merged(pairs[:, 0], pairs[:, 1])
                stay = np.ones(z - a, bool)
                for s, e in runs.tolist():
                    stay[s:e] = False
                n.append(z - a), kept.append(data[a:z][stay].tobytes()), ranges.append([{"start": s, "end": e} for s, e in runs.tolist()])
            yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array(n, pa.int64()), pa.array(kept, pa.binary()), pa.array(ranges, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], schema.names)

    return joined.mapInArrow(run, schema)


def valid_text(kept: Column) -> Column:
    """kept as text, without the bytes of characters that were cut in two."""
    # invalid bytes become U+FFFD and go; a text that is valid keeps such characters of its own
    return F.coalesce(F.try_validate_utf8(kept.cast("string")), F.replace(F.make_valid_utf8(kept.cast("string")), F.lit("\ufffd"), F.lit("")))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("ranges").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
