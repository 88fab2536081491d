"""The k best documents of each query in numpy: what `retrieve.search` runs over blocks of the index.

A country's tokens are numbered from the rarest on, so a query's first r numbers are its rarest tokens. Documents are dealt to
blocks of bounded size; a block holds classes of documents with equal tokens, the postings of these classes, and the ids.
Each part of the queries meets each block of its country. Per query its rarest tokens are opened, as many as a number of
postings allows; what can still reach the kth score is completed from the classes' own tokens. Where a class without any of
these tokens could reach it too, the best by the other tokens alone come in; these are found once for each set of such
tokens. All else scores less than k classes that are known, or ties with them and has a larger id: the result is exact.
"""

from __future__ import annotations

import io
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.catalog import scratch

#: Tokens of a part that is numbered, postings of a block, queries of a part.
TOKENS, POSTINGS, QUERIES = 2_000_000, 4_000_000, 32_768
#: A part has fewer queries, but these at least, where its index is small: one for so many postings that are sent to it.
FEWEST, SENT = 2_048, 40
#: Distinct queries with the same further tokens from which on these are summed once for all classes.
SHARED = 8
#: Tokens of a country that are sent to each of its parts; with more, `retrieve.search` joins.
VOCABULARY_MOST = 4_000_000
#: Scores are told apart by six digits; bounds keep a little more distance.
SLACK = 1e-5


def _packed(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpacked(data) -> dict:
    with np.load(io.BytesIO(data)) as z:
        return {k: z[k] for k in z.files}


def _ipc(values: pa.Array) -> np.ndarray:
    sink = pa.BufferOutputStream()
    t = pa.table({"x": values})
    with pa.ipc.new_stream(sink, t.schema) as w:
        w.write_table(t)
    return np.frombuffer(sink.getvalue(), np.uint8)


def _from_ipc(data: np.ndarray) -> pa.Array:
    return pa.ipc.open_stream(pa.py_buffer(data)).read_all()["x"].combine_chunks()


def _flat(lists) -> tuple[np.ndarray, pa.Array]:
    """Starts and values of an array of lists; a null list is empty."""
    x = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), x.flatten()


def _vocabulary(country: tuple, rows: pa.Table) -> pa.Table:
    """The tokens of a country from the rarest on; a token's place is its number."""
    rows = rows.sort_by([("df", "ascending"), ("token", "ascending")])
    words = _packed(tokens=_ipc(rows["token"]), df=rows["df"].to_numpy(), idf=rows["idf"].to_numpy())
    return pa.table({"country": [country[0].as_py()], "words": pa.array([words], pa.binary()), "weights": pa.array([rows["idf"].to_numpy().tobytes()], pa.binary())})


def _numbered(r: int | None):
    """(key, rows, vocabulary) to id, toks and, of the r rarest of a query, how many are opened; rows of an id are one."""

    def number(key: tuple, rows: pa.Table, words: pa.Table) -> pa.Table:
        schema = pa.schema([("country", pa.string()), ("id", rows.schema.field("id").type), ("toks", pa.list_(pa.int32())), ("k", pa.int32()), ("opened", pa.int32())])
        if not rows.num_rows or not words.num_rows:
            return schema.empty_table()
        v = _unpacked(words["words"][0].as_py())
        coded = rows["id"].combine_chunks().dictionary_encode()
        of, ids = coded.indices.to_numpy(), coded.dictionary
        starts, values = _flat(rows["sig"])
        code = pc.fill_null(pc.index_in(values, value_set=_from_ipc(v["tokens"])), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        of = np.repeat(of, np.diff(starts))[code >= 0]
        both = np.sort((of.astype(np.int64) << 32) | code[code >= 0])
        of, code = both >> 32, both & 0xFFFFFFFF
        first = np.searchsorted(of, np.arange(len(ids)))
        k = np.zeros(len(ids), np.int64)
        np.maximum.at(k, coded.indices.to_numpy(), rows["k"].to_numpy())
        opened = np.zeros(len(ids), np.int64)
        if r is not None:
            rank = np.arange(len(of)) - first[of]
            stay = (rank < r) & ((v["idf"][code] > 0) | (rank == 0))
            of, code = of[stay], code[stay]
            first = np.searchsorted(of, np.arange(len(ids)))
            df = v["df"][code]
            n = df[0] * np.exp(v["idf"][code[0]]) if len(df) else 0
            sums = np.cumsum(df)
            at = sums - (sums[first[of]] - df[first[of]])
            rank = np.arange(len(of)) - first[of]
            opened = np.bincount(of, (rank == 0) | (at <= max(1024, n / 32)), len(ids)).astype(np.int64)
        ends = np.append(first, len(of))
        have = np.diff(ends) > 0
        toks = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(code.astype(np.int32)))
        out = pa.table([pa.array([key[0].as_py()] * len(ids), pa.string()), ids, toks, pa.array(k.astype(np.int32)), pa.array(opened.astype(np.int32))], schema=schema)
        return out.filter(pa.array(have))

    return number


def _block(most: int):
    def block(key: tuple, rows: pa.Table) -> pa.Table:
        """The classes of a shard's documents, numbered by their smallest id, with the `most` smallest ids of each."""
        rows = rows.sort_by("id")
        starts, values = _flat(rows["toks"])
        values = values.to_numpy(zero_copy_only=False)
        places, of = {}, np.empty(len(starts) - 1, np.int64)
        data, at = values.tobytes(), (starts * 4).tolist()
        for i, (a, b) in enumerate(zip(at, at[1:], strict=False)):
            of[i] = places.setdefault(data[a:b], len(places))
        sizes = np.array([len(x) // 4 for x in places], np.int64)
        toks = np.frombuffer(b"".join(places), np.int32)
        owner = np.repeat(np.arange(len(places), dtype=np.int32), sizes)
        by_token = np.argsort(toks, kind="stable")
        members = np.argsort(of, kind="stable")
        counts = np.bincount(of)
        rank = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
        members = members[rank < most]
        kept = _packed(ids=_ipc(rows["id"]), sizes=sizes, toks=toks, postings=owner[by_token], members=members.astype(np.int32), counts=np.minimum(counts, most))
        return pa.table({"country": pa.array([key[0].as_py()], pa.string()), "shard": pa.array([key[1].as_py()], pa.int32()), "block": pa.array([kept], pa.binary())})

    return block


class Block:
    """An index block that finds the best classes of a query."""

    def __init__(self, data: bytes, weights: bytes, norm: bool, most: int):
        b = _unpacked(data)
        self.weights = np.frombuffer(weights)
        self.ids, self.toks, self.sizes, self.postings, self.most = _from_ipc(b["ids"]), b["toks"], b["sizes"], b["postings"].astype(np.intp), most
        self.first = np.concatenate([[0], np.cumsum(b["sizes"])])
        self.members, self.member = b["members"], np.concatenate([[0], np.cumsum(b["counts"])])
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(b["toks"], minlength=len(self.weights)))])
        self.norm = np.sqrt(b["sizes"]) if norm else np.ones(len(b["sizes"]))
        self.least = self.norm.min()
        n = len(b["sizes"])
        self.sum, self.slot, self.seen, self.asked = np.zeros(n), np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(len(self.weights))
        self.others: dict[bytes, tuple] = {}
        self.held_of, self.sums = b"", np.zeros(n)

    def opened(self, toks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes with one of the tokens, and the sums of their weights."""
        a, b = self.starts[toks].tolist(), self.starts[toks + 1].tolist()
        post = np.concatenate([self.postings[x:y] for x, y in zip(a, b, strict=True)])
        np.add.at(self.sum, post, np.repeat(self.weights[toks], np.subtract(b, a)))
        place = np.arange(len(post))
        self.slot[post] = place
        classes = post[self.slot[post] == place]
        sums = self.sum[classes]
        self.sum[classes] = 0
        return classes, sums

    def completed(self, classes: np.ndarray, toks: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The weight of these tokens in each of the classes: by the tokens' postings or by the classes' tokens, whichever are fewer."""
        a, b = self.starts[toks], self.starts[toks + 1]
        sizes = self.sizes[classes]
        if (b - a).sum() <= sizes.sum():
            post = np.concatenate([self.postings[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)])
            np.add.at(self.sum, post, np.repeat(weights, b - a))
            sums = self.sum[classes]
            self.sum[post] = 0
            return sums
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self.first[classes] - ends + sizes, sizes)
        np.add.at(self.asked, toks, weights)
        sums = np.add.reduceat(self.asked[self.toks[at]], ends - sizes)
        self.asked[toks] = 0
        return sums

    def held(self, toks: np.ndarray) -> np.ndarray:
        """The weight of these tokens in every class; kept for the next queries with the same ones."""
        if self.held_of != toks.tobytes():
            self.held_of = toks.tobytes()
            self.sums[:] = 0
            for t in toks.tolist():
                # a class is once in a token's postings
                self.sums[self.postings[self.starts[t] : self.starts[t + 1]]] += self.weights[t]
        return self.sums

    def by_held(self, toks: np.ndarray, held: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Classes with one of the tokens (more than once, maybe), and the k best of them with what is held added."""
        parts = [self.postings[self.starts[t] : self.starts[t + 1]] for t in toks.tolist()]
        for part, weight in zip(parts, self.weights[toks].tolist(), strict=True):
            self.sum[part] = self.sum.take(part) + weight
        every = np.concatenate(parts)
        scores = (self.sum.take(every) + held.take(every)) / self.norm.take(every)
        self.sum[every] = 0
        # a class is in all parts at most, so these hold k classes
        classes, most = every, k * len(parts)
        if len(every) > most:
            able = np.flatnonzero(scores >= np.partition(scores, len(scores) - most)[len(scores) - most] - SLACK)
            classes, scores = classes[able], scores[able]
        classes, first = np.unique(classes, return_index=True)
        return every, *self.top(classes, rounded(scores[first]), k)

    def of_others(self, toks: np.ndarray, held: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The best classes by these tokens alone."""
        key = toks.tobytes()
        if key not in self.others:
            if len(self.others) > 20_000:
                self.others.clear()
            if held is None:
                classes, sums = self.opened(toks)
            else:
                classes = np.flatnonzero(held)
                sums = held[classes]
            self.others[key] = self.top(classes, rounded(sums / self.norm[classes]), self.most)
        return self.others[key]

    def top(self, classes: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best classes, ties to the smaller number."""
        if len(scores) > k:
            able = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
            classes, scores = classes[able], scores[able]
        order = np.lexsort((classes, -scores))[:k]
        return classes[order], scores[order]

    def best(self, toks: np.ndarray, p: int, k: int, shared: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Places of the k best documents among the ids, and their scores. shared: other queries have the same further tokens."""
        rest, held = toks[p:], None
        if shared and len(rest):
            held = self.held(rest)
            every, classes, scores = self.by_held(toks[:p], held, k)
        else:
            every, sums = self.opened(toks[:p])
            classes = every
            if len(rest) and len(every):
                weights, norm = self.weights[rest], self.norm[every]
                if len(every) > k:
                    low = sums / norm
                    low = np.partition(low, len(low) - k)[len(low) - k]
                    able = (sums + weights.sum()) / norm >= low - SLACK
                    classes, sums = every[able], sums[able]
                sums = sums + self.completed(classes, rest, weights)
            classes, scores = self.top(classes, rounded(sums / self.norm[classes]), k)
        if len(rest):
            enough = np.searchsorted(np.cumsum(self.member[classes + 1] - self.member[classes]), k)
            beyond = (np.cumsum(self.weights[rest]) / np.maximum(self.least, np.sqrt(np.arange(1, len(rest) + 1)))).max()
            if enough >= len(classes) or beyond >= scores[enough] - SLACK:
                more, also = self.of_others(rest, held)
                self.seen[every] = True
                new = ~self.seen[more]
                self.seen[every] = False
                classes, scores = self.top(np.concatenate([classes, more[new]]), np.concatenate([scores, also[new]]), k)
        a, b = self.member[classes], self.member[classes + 1]
        found = np.concatenate([self.members[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]) if len(a) else self.members[:0]
        scores = np.repeat(scores, b - a)
        order = np.lexsort((found, -scores))[:k]
        return found[order], scores[order]


def rounded(x: np.ndarray) -> np.ndarray:
    """To six digits, halves up."""
    return np.floor(x * 1e6 + 0.5) / 1e6


def _found(norm: bool, most: int):
    def found(key: tuple, queries: pa.Table, blocks: pa.Table) -> pa.Table:
        schema = pa.schema([("country", pa.string()), ("query", queries.schema.field("id").type), ("id", blocks.schema.field("like").type), ("score", pa.float64()), ("rn", pa.int32()), ("k", pa.int32())])
        if not queries.num_rows or not blocks.num_rows:
            return schema.empty_table()
        block = Block(blocks["block"][0].as_py(), blocks["weights"][0].as_py(), norm, most)
        starts, values = _flat(queries["toks"])
        values, at = values.to_numpy(zero_copy_only=False), starts.tolist()
        ks, ps = queries["k"].to_pylist(), queries["opened"].to_pylist()
        known: dict[tuple, int] = {}
        docs, scores, of = [], [], np.empty(len(ks), np.int64)
        asked = [(values[a + p : b].tobytes(), values[a:b].tobytes(), k) for a, b, p, k in zip(at, at[1:], ps, ks, strict=False)]
        alike = Counter(rest for rest, _, _ in set(asked))
        # those with the same further tokens one after another
        for i in sorted(range(len(ks)), key=lambda i: asked[i][0]):
            rest, same, k = asked[i]
            if (same, k) not in known:
                known[same, k] = len(docs)
                d, s = block.best(values[at[i] : at[i + 1]], ps[i], k, alike[rest] >= SHARED)
                docs.append(d)
                scores.append(s)
            of[i] = known[same, k]
        sizes = np.array([len(d) for d in docs], np.int64)
        first = np.cumsum(sizes) - sizes
        n = sizes[of]
        rank = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        place = np.repeat(first[of], n) + rank
        query = queries["id"].combine_chunks().take(pa.array(np.repeat(np.arange(len(of)), n)))
        ids = block.ids.take(pa.array(np.concatenate(docs)[place]))
        return pa.table([pa.array([key[0].as_py()] * len(place), pa.string()), query, ids, pa.array(np.concatenate(scores)[place]), pa.array((rank + 1).astype(np.int32)), pa.array(np.repeat(np.array(ks, np.int32), n))], schema=schema)

    return found


def _parts(rows: DataFrame, size, most: int) -> DataFrame:
    """country, parts: so many that each has about `most`; a row for each country, sent to all tasks."""
    return F.broadcast(rows.groupBy("country").agg(F.ceil(F.greatest(F.sum(size), F.lit(1)) / most).cast("int").alias("parts")))


def _queries_most(entries: DataFrame) -> DataFrame:
    """country, most: queries of a part; a small index is sent to more parts, so that all cores search it."""
    return entries.groupBy("country").agg(F.least(F.lit(QUERIES), F.greatest(F.lit(FEWEST), F.sum(F.size("toks")) / SENT)).cast("int").alias("most"))


def _dealt(rows: DataFrame, parts: DataFrame, by: str = "id") -> DataFrame:
    return rows.join(parts, "country").withColumn("part", F.pmod(F.xxhash64(by), F.col("parts")).cast("int")).drop("parts")


def _for_all(blocks: DataFrame, parts: DataFrame) -> DataFrame:
    return blocks.join(parts, "country").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")


def _coded(rows: DataFrame, words: DataFrame, r: int | None) -> DataFrame:
    rows = rows.where(F.col("country").isNotNull() & F.col("id").isNotNull())
    parts = _parts(rows, F.greatest(F.size("sig"), F.lit(0)), TOKENS)
    left = _dealt(rows, parts).groupBy("country", "part")
    kind = rows.schema["id"].dataType.simpleString()
    return left.cogroup(_for_all(words.select("country", "words"), parts).groupBy("country", "part")).applyInArrow(_numbered(r), f"country string, id {kind}, toks array<int>, k int, opened int")


def best(queries: DataFrame, docs: DataFrame, frequencies: DataFrame, r: int, k: int, norm: bool) -> tuple[DataFrame, bool]:
    """country, query, id, score, rn, k of each query's best documents, and whether these are of several shards still. queries: country, id, sig, k."""
    words = scratch(frequencies.groupBy("country").applyInArrow(_vocabulary, "country string, words binary, weights binary"), "words")
    entries = scratch(_coded(docs.select("country", "id", "sig", F.lit(0).alias("k")), words, None).drop("k", "opened"), "entries")
    shards = _parts(entries, F.size("toks"), POSTINGS)
    several = (shards.agg(F.max("parts")).first()[0] or 0) > 1
    kind = docs.schema["id"].dataType.simpleString()
    blocks = _dealt(entries, shards).withColumnRenamed("part", "shard").groupBy("country", "shard").applyInArrow(_block(k), "country string, shard int, block binary")
    blocks = scratch(blocks.join(words.select("country", "weights"), "country").withColumn("like", F.lit(None).cast(kind)), "blocks")

    asked = scratch(_coded(queries.select("country", "id", "sig", "k"), words, r).withColumn("others", F.expr("xxhash64(slice(toks, opened + 1, greatest(size(toks) - opened, 0)))")), "asked")
    most = F.broadcast(_queries_most(entries))
    parts = F.broadcast(asked.groupBy("country").agg(F.count("*").alias("n")).join(most, "country").select("country", F.ceil(F.col("n") / F.col("most")).cast("int").alias("parts")))
    # queries with the same further tokens are together, but for the sets that very many share: a row for every half part's queries at most
    many = asked.groupBy("country", "others").agg(F.count("*").alias("n")).join(most, "country").where(F.col("n") > F.col("most") / 2)
    many = F.broadcast(many.select("country", "others", F.lit(True).alias("many")))
    asked = asked.join(many, ["country", "others"], "left").withColumn("others", F.when(F.col("many"), F.xxhash64("id")).otherwise(F.col("others")))
    each = F.broadcast(shards.select("country", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("shard")))
    left = _dealt(asked.select("country", "id", "toks", "k", "opened", "others"), parts, "others").join(each, "country")
    right = _for_all(blocks, parts)
    key = ["country", "part", "shard"]
    # few bytes and much work: tasks go by the groups, not by bytes; twice as many, as keys meet by chance
    tasks = 2 * (parts.join(shards.withColumnRenamed("parts", "shards"), "country").agg(F.sum(F.col("parts").cast("long") * F.col("shards"))).first()[0] or 1)
    left, right = left.drop("others").repartition(tasks, *key), right.repartition(tasks, *key)
    out = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_found(norm, k), f"country string, query {queries.schema['id'].dataType.simpleString()}, id {kind}, score double, rn int, k int")
    return out, several
