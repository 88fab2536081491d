"""Best-fit packing by a grouping genetic algorithm on islands with elite migration.

A text's ids (public vocabulary, plus an end id) are cut into pieces of at most CAPACITY ids, and pieces are packed
into as few sequences as possible. Only (doc_id, piece, length) takes part, never the ids. Pieces are dealt by hash
into shards of about SHARD_PIECES, so that no task grows with the input. Each
shard is bred on ISLANDS islands: genomes are piece -> bin tables, crossover injects whole well-filled bins of one
parent into another, drops the bins that hold duplicates of their pieces, lets the displaced ones take better places
of others and best-fits what is left; after
each round an island's elite moves on to the next. An island that reaches the lower bound ceil(sum / CAPACITY)
is optimal and stops. The best genome of all islands is the answer. The least filled sequences of all shards are then packed again together.

Null texts are empty (a piece with the end id alone); repeated rows are packed each; rows with a null id are packed
too; rows that share an id keep a piece 0 each; a text of any length is cut into pieces; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import wordbpe
from .common import read_table, stored, text_chunks, text_col

CAPACITY = 4096
END_ID = 1
SHARD_PIECES = 12_000
ISLANDS, ROUNDS, GENERATIONS, POPULATION, ELITE = 3, 2, 40, 6, 2


def pieces_of(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of whole texts."""

    def run(batches):
        made = wordbpe.encoder(vocabulary)
        for rows, data, off in text_chunks(batches, most=1 << 20):
            ids, cut = made.encode(data, off, end_id)
            size = np.diff(cut)
            n = -(-size // capacity)
            row = np.repeat(np.arange(len(n)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(capacity, size[row] - start)
            raw, at = memoryview(ids.astype("<u4").tobytes()), 4 * (cut[row] + start)
            crc = [zlib.crc32(raw[a:z]) for a, z in zip(at.tolist(), (at + 4 * length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_col()).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Packer:
    """Genomes over one shard's piece lengths: an array with each piece's bin."""

    def __init__(self, lengths: np.ndarray, capacity: int, seed: int):
        self.lengths, self.capacity, self.rng = lengths.astype(np.int64), capacity, np.random.default_rng(seed)
        self.bound = int(-(-self.lengths.sum() // capacity))

    def best_fit(self, genome: np.ndarray, loose: np.ndarray) -> np.ndarray:
        """Places the loose pieces, longest first, each into the fullest bin with room; bins are numbered anew."""
        kept = np.ones(len(genome), bool)
        kept[loose] = False
        names, inverse = np.unique(genome[kept], return_inverse=True)
        out = np.empty(len(genome), np.int64)
        out[kept] = inverse
        room = self.capacity - np.bincount(inverse, self.lengths[kept], len(names)).astype(np.int64)
        open_bins = sorted((r, b) for b, r in enumerate(room.tolist()) if r > 0)
        bins = len(names)
        for i, size in sorted(zip(loose.tolist(), self.lengths[loose].tolist(), strict=True), key=lambda x: -x[1]):
            at = bisect_left(open_bins, (size, -1))
            if at < len(open_bins):
                left, b = open_bins.pop(at)
            else:
                left, b, bins = self.capacity, bins, bins + 1
            out[i] = b
            if left > size:
                insort(open_bins, (left - size, b))
        return out

    def fills(self, genome: np.ndarray) -> np.ndarray:
        return np.bincount(genome, self.lengths)

    def fitness(self, genome: np.ndarray) -> tuple[int, float]:
        """Fewer bins, then the mean square fill; smaller is better."""
        fill = self.fills(genome)
        return len(fill), -float(np.mean((fill / self.capacity) ** 2))

    def optimal(self, genome: np.ndarray) -> bool:
        return len(genome) == 0 or int(genome.max()) + 1 <= self.bound

    def first(self) -> np.ndarray:
        return self.best_fit(np.zeros(0, np.int64) if not len(self.lengths) else np.zeros(len(self.lengths), np.int64), np.arange(len(self.lengths)))

    def exchange(self, genome: np.ndarray, loose: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One or two pieces of a bin change places with one or two loose ones that fill it better (S. Martello and P. Toth's dominance, as E. Falkenauer uses it)."""
        genome, kept = genome.copy(), np.ones(len(genome), bool)
        kept[loose] = False
        fill = np.bincount(genome[kept], self.lengths[kept], int(genome.max()) + 1)
        free = sorted((int(self.lengths[i]), i) for i in loose.tolist())
        order = np.argsort(genome, kind="stable")
        order = order[kept[order]]
        cuts = np.searchsorted(genome[order], np.arange(len(fill) + 1))
        for b in np.flatnonzero((fill > 0) & (fill < self.capacity)).tolist():
            items, room = order[cuts[b] : cuts[b + 1]].tolist(), self.capacity - int(fill[b])
            out = [(int(self.lengths[i]), (i,)) for i in items] + [(int(self.lengths[i] + self.lengths[j]), (i, j)) for k, i in enumerate(items) for j in items[k + 1 :]]
            best = (0, (), ())
            for size, go in out:
                most = size + room
                at = bisect_left(free, (most + 1,)) - 1
                if at >= 0 and free[at][0] - size > best[0]:
                    best = (free[at][0] - size, go, (free[at],))
                lo, hi = 0, len(free) - 1
                while lo < hi and len(go) == 2:
                    both = free[lo][0] + free[hi][0]
                    if both > most:
                        hi -= 1
                        continue
                    if both - size > best[0]:
                        best = (both - size, go, (free[lo], free[hi]))
                    lo += 1
                if best[0] == room:
                    break
            if best[0]:
                for x in best[2]:
                    free.remove(x)
                    genome[x[1]] = b
                for i in best[1]:
                    insort(free, (int(self.lengths[i]), i))
        return genome, np.array([i for _, i in free], np.int64)

    def place(self, genome: np.ndarray, loose: np.ndarray) -> np.ndarray:
        return self.best_fit(*self.exchange(genome, loose)) if len(loose) else genome

    def cross(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Injects half of b's well-filled bins into a."""
        fill = self.fills(b)
        good = np.flatnonzero(fill >= np.quantile(fill, 0.5))
        taken = self.rng.permutation(good)[: max(1, len(good) // 2)]
        injected = np.isin(b, taken)
        hit = np.unique(a[injected])  # a's bins with a duplicate of an injected piece
        child = np.where(injected, b + int(a.max()) + 1, a)
        return self.place(child, np.flatnonzero(np.isin(a, hit) & ~injected))

    def mutate(self, genome: np.ndarray) -> np.ndarray:
        """Empties the least filled bin and a few others."""
        fill = self.fills(genome)
        some = self.rng.choice(len(fill), min(len(fill), int(self.rng.integers(2, 7))), replace=False)
        return self.place(genome, np.flatnonzero(np.isin(genome, np.append(some, fill.argmin()))))

    def evolve(self, population: list[np.ndarray], generations: int) -> list[np.ndarray]:
        if not population:
            population = [self.first()]
        if any(map(self.optimal, population)):
            return [min(population, key=self.fitness)]
        while len(population) < POPULATION:
            population.append(self.mutate(population[0]))
        for _ in range(generations):
            population.sort(key=self.fitness)
            if self.optimal(population[0]):
                break
            a, b = (population[int(self.rng.integers(len(population) // 2 + 1))] for _ in range(2))
            child = self.cross(a, b)
            population[-1] = child if self.rng.random() < 0.7 else self.mutate(child)
        return sorted(population, key=self.fitness)


def _pick(items: pd.DataFrame) -> pd.DataFrame:
    return items.sort_values(["doc_id", "piece", "length"], kind="stable", na_position="first").reset_index(drop=True)


def _evolve(capacity: int, generations: int):
    def run(key, items: pd.DataFrame, elites: pd.DataFrame) -> pd.DataFrame:
        shard, island = (int(x) for x in key)
        items = _pick(items)
        p = Packer(items["length"].to_numpy(), capacity, seed=shard * 1009 + island * 31 + len(elites))
        got = [np.frombuffer(g, "<i4").astype(np.int64) for g in elites["genome"]] if len(elites) else []
        best = p.evolve(got, generations)[:ELITE]
        fit = [p.fitness(g) for g in best]
        # the best stays, the elite also moves on to the next island of the ring
        rows = [(shard, to, f[0], f[1], g.astype("<i4").tobytes()) for g, f in zip(best, fit, strict=True) for to in (island, (island + 1) % ISLANDS)]
        return pd.DataFrame(rows, columns=["shard", "island", "bins", "unfit", "genome"])

    return run


#: Sequences of a shard, the least filled ones, that are packed once more together with those of other shards.
LOOSE = 2


def _assign(capacity: int, level: int):
    def run(key, items: pd.DataFrame, genomes: pd.DataFrame) -> pd.DataFrame:
        items = _pick(items)
        best = genomes.sort_values(["bins", "unfit", "island"], kind="stable").iloc[0] if len(genomes) else None
        genome = np.frombuffer(best["genome"], "<i4").astype(np.int64) if best is not None else np.zeros(0, np.int64)
        order = np.argsort(genome, kind="stable")
        lengths = items["length"].to_numpy()[order]
        before = np.cumsum(lengths) - lengths
        bins = genome[order]
        first = np.r_[True, bins[1:] != bins[:-1]] if len(bins) else np.zeros(0, bool)
        base = np.repeat(before[first], np.diff(np.append(np.flatnonzero(first), len(bins)))) if len(bins) else before
        out = items.iloc[order].copy()
        out["sequence_id"] = (level << 58) + (int(key[0]) << 24) + bins
        out["offset"] = before - base
        fill = np.bincount(bins, lengths)
        loose = np.argsort(fill, kind="stable")[:LOOSE]
        out["loose"] = np.isin(bins, loose[fill[loose] < capacity])
        return out[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "loose"]]

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES, level: int = 0) -> DataFrame:
    """pieces (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    pieces should be a stored table: each round reads it again. What is loose in the shards is packed by itself, in
    as few shards as it takes, until one shard is left."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, loose boolean"
    shards = max(1, -(-pieces.count() // shard_pieces))
    items = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", F.lit(level)), F.lit(shards)))
    ring = items.select("shard", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"), "doc_id", "piece", "length").groupBy("shard", "island")
    genome = "shard long, island int, bins int, unfit double, genome binary"
    elites = pieces.sparkSession.createDataFrame([], genome)
    for _ in range(ROUNDS):
        elites = stored(ring.cogroup(elites.groupBy("shard", "island")).applyInPandas(_evolve(capacity, GENERATIONS), genome))
    made = items.groupBy("shard").cogroup(elites.groupBy("shard")).applyInPandas(_assign(capacity, level), schema)
    if shards == 1:
        return made.drop("loose")
    made = stored(made)
    again = stored(made.where("loose").select(pieces.columns))
    return made.where(~F.col("loose")).drop("loose").unionByName(pack(again, capacity, shard_pieces, level + 1))


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(stored(pieces_of(docs, vocabulary, capacity)), capacity)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), wordbpe.vocabulary())
