"""Quality classifier: supervised subword embeddings.

Learned vectors of hashed words, word repetitions and character n-grams are averaged over a document; a softmax over
the mean gives the score. Training is stochastic gradient descent in numpy on the driver, over the hashed counts of
at most SAMPLE labelled rows of each class outside the held-out fold, chosen by a hash of their ids; a document's
counts have at most BUCKETS entries, however long it is. Scoring covers whole texts: embeddings and softmax weights
are folded into one number a bucket, so a chunk of texts is a few array operations.

Null and empty texts have no features and get the score of the bias alone; repeated rows get equal scores; an empty
table gives no rows; without labelled rows every score is 0.5; labels that are null are not used; other columns are
not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HELD_OUT, id_mod4, mix64, read_table, run_hashes, text_chunks, text_col, with_scores

BITS = 18
BUCKETS = 1 << BITS
#: Labelled rows of each class that training sees at most.
SAMPLE = 1500
DIM, EPOCHS, RATE, SEED = 10, 6, 0.5, 7
#: Character n-grams, and distances at which a repeated word counts.
GRAMS, LAGS = (3, 4), (1, 2, 3, 4, 6, 8)
THRESHOLD = 0.7

_LETTERS = mix64(np.arange(1 << 16, dtype=np.uint64))
_P = np.uint64(0x9E3779B97F4A7C15 | 1)


def features(data: np.ndarray, off: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, first of each document and the end) for each kind of feature, over the texts in data."""
    with np.errstate(over="ignore"):
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        cut = lead[off]
        point = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        n = len(point)
        x = _LETTERS[point & 0xFFFF]
        high = point >> 16
        if high.any():
            x = x ^ (high.astype(np.uint64) * _P)
        shift, out = np.uint64(64 - BITS), []
        kind = np.uint64(1)
        for g in GRAMS:
            if n >= g:
                h = x[: n - g + 1]
                for k in range(1, g):
                    h = h * _P + x[k : n - g + 1 + k]
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                keep = np.ones(len(h), bool)  # not across documents
                for c in cut[1:-1]:
                    keep[max(0, c - g + 1) : c] = False
                at = np.concatenate([[0], np.cumsum(keep)])
                out.append(((h[keep] >> shift).astype(np.int64), at[np.minimum(cut, len(h))]))
        space = point <= 32
        start = ~space
        start[1:] &= space[:-1]
        edge = np.zeros(n + 1, bool)
        edge[cut] = True
        start |= edge[:-1] & ~space
        s = np.flatnonzero(start)
        stop = ~space
        stop[:-1] &= space[1:] | edge[1:-1]
        e = np.flatnonzero(stop) + 1
        word = run_hashes(x, s, e)
        first = np.searchsorted(s, cut)
        out.append(((word >> shift).astype(np.int64), first))
        doc = np.repeat(np.arange(len(cut) - 1), np.diff(first))
        for lag in LAGS:
            same = np.flatnonzero((word[lag:] == word[:-lag]) & (doc[lag:] == doc[:-lag])) if len(word) > lag else np.zeros(0, np.int64)
            bucket = int(mix64(np.array([lag], np.uint64))[0] >> shift)
            at = np.concatenate([[0], np.cumsum(np.bincount(doc[same], minlength=len(cut) - 1))]).astype(np.int64)
            # a repetition counts as a few features, or long texts would drown it
            out.append((np.full(len(same), bucket, np.int64), at))
    return out


def hashed(docs: DataFrame, extra: list[str]) -> DataFrame:
    """doc_id, extra columns, buckets and counts (little-endian 32-bit) of whole texts."""
    schema = ", ".join(f"{c} {t}" for c, t in docs.select("doc_id", *extra).dtypes) + ", buckets binary, counts binary"

    def run(batches):
        for rows, data, off in text_chunks(batches, most=1 << 20):
            parts = features(data, off)
            b, c = [], []
            for k in range(rows.num_rows):
                u, n = np.unique(np.concatenate([f[at[k] : at[k + 1]] for f, at in parts]), return_counts=True)
                b.append(u.astype("<i4").tobytes()), c.append(n.astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([rows.column(x) for x in ["doc_id", *extra]] + [pa.array(b, pa.binary()), pa.array(c, pa.binary())], ["doc_id", *extra, "buckets", "counts"])

    return docs.select("doc_id", *extra, text_col()).mapInArrow(run, schema)


@dataclass
class Model:
    weight: np.ndarray  # of each bucket, in log odds of label 1
    bias: float

    def scores(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        total, n = np.zeros(len(off) - 1), np.zeros(len(off) - 1)
        for bucket, at in features(data, off):
            run = np.concatenate([[0.0], np.cumsum(self.weight[bucket], dtype=np.float64)])
            total += run[at[1:]] - run[at[:-1]]
            n += np.diff(at)
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) + self.bias, -30, 30)))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], share: float) -> Model:
    """rows: (buckets, counts, label); share: of label 1 among all labelled rows, to which the balanced sample's odds are led back."""
    if not rows:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    rng = np.random.default_rng(SEED)
    vec = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            u, c, y = rows[k]
            rate = RATE * (1 - done / steps)
            done += 1
            w = (c / max(1, c.sum())).astype(np.float32)
            mean = w @ vec[u] if len(u) else np.zeros(DIM, np.float32)
            z = out @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = p @ out
            out -= rate * np.outer(p, mean)
            bias -= rate * 0.1 * p
            if len(u):
                # the mean's gradient reaches each vector by its weight; scaled as if each came once
                vec[u] -= rate * np.minimum(w * len(u), 20.0)[:, None] * back[None, :]
    seen = np.mean([y for _, _, y in rows])
    odds = lambda s: float(np.log(min(max(s, 1e-3), 1 - 1e-3) / (1 - min(max(s, 1e-3), 1 - 1e-3))))
    return Model((vec @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0]) + odds(share) - odds(seen))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from rows outside the held-out fold; never sees lang, source or ids but to choose rows."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(F.col("quality").isin(0, 1) & (id_mod4() != HELD_OUT))
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    n = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    one = lambda q: known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    # at most 2 * SAMPLE ids are sent to the scan of the texts
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(one(0).unionByName(one(1))), "doc_id")
    got = hashed(chosen, ["quality"]).toPandas().drop_duplicates("doc_id").sort_values("doc_id")
    rows = [(np.frombuffer(b, "<i4"), np.frombuffer(c, "<i4"), int(q)) for b, c, q in zip(got["buckets"], got["counts"], got["quality"], strict=True)]
    return train(rows, n.get(1, 0) / max(1, sum(n.values())))


def score(docs: DataFrame, model: Model, keep: list[str] = (), prefix: str = "") -> DataFrame:
    """doc_id, the columns of keep, and with the prefix held_out, score, predicted.

    keep may hold any columns; give a prefix where their names clash with the new ones."""

    def run(rows, data, off):
        p = model.scores(data, off)
        return [pa.array(p, pa.float64()), pa.array((p >= THRESHOLD).astype(np.int32), pa.int32())]

    return with_scores(docs, keep, prefix, run, "score double, predicted int")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score(docs, fit(docs, read_table(spark, sf_dir, "labels")))
