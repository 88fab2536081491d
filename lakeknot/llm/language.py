"""Language ID: a byte convolutional network.

Byte embeddings, filters of several widths, ReLU, a maximum over the window and a softmax, trained in numpy on the
driver with windows of at most SAMPLE labelled rows of each language outside the held-out fold (at most TRAIN_WINDOWS
windows a row, spread over its text). Whole texts are cut into fixed-length windows, batched, and a document's
probabilities are the mean over its windows, weighted by their bytes.

Null texts and texts without a letter are `und` with score 0; repeated rows get equal results; an empty table gives
no rows; rows with a null lang or id are predicted but not learned from; rows that share an id are learned from and
predicted each; languages of equal probability go to the first by name; a text of any length is read whole, window by
window; without any labelled row all are `und`; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import HELD_OUT, id_mod4, read_table, text_chunks, text_col, with_scores

WINDOW = 192
DIM = 8
WIDTHS, FILTERS = (2, 3, 4), 8
#: Labelled rows of each language that training sees at most, and windows of each.
SAMPLE, TRAIN_WINDOWS = 800, 5
EPOCHS, BATCH, RATE, SEED = 10, 32, 0.3, 11
UND = "und"
#: Windows that go through the network at once.
AT_ONCE = 512
SPAN = max(WIDTHS)

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def windows(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows by WINDOW bytes, padded with 0; the document of each; its bytes)."""
    size = np.diff(off)
    n = -(-size // WINDOW)
    doc = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    inside = np.arange(int(n.sum())) - first[doc]
    used = np.minimum(WINDOW, size[doc] - inside * WINDOW)
    if len(doc) == 0:
        return np.zeros((0, WINDOW), np.uint8), doc, used
    out = np.zeros(len(doc) * WINDOW, np.uint8)
    to = np.arange(len(data)) - np.repeat(off[:-1], size) + np.repeat(first * WINDOW, size)
    out[to] = data
    return out.reshape(-1, WINDOW), doc, used


@dataclass
class Network:
    names: list[str]
    embed: np.ndarray  # (256, DIM)
    filters: np.ndarray  # (SPAN * DIM, filters of all widths); rows beyond a filter's width are 0
    bias: np.ndarray
    out: np.ndarray  # (filters, languages)
    out_bias: np.ndarray

    def pooled(self, win: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pre-activations' maxima, the embedded windows)."""
        x = self.embed[win]  # (n, WINDOW, DIM)
        n = len(win)
        view = np.lib.stride_tricks.as_strided(x, (n, WINDOW - SPAN + 1, SPAN * DIM), (x.strides[0], x.strides[1], x.strides[2]))
        y = np.ascontiguousarray(view).reshape(-1, SPAN * DIM) @ self.filters
        return y.reshape(n, WINDOW - SPAN + 1, -1), x

    def probabilities(self, win: np.ndarray) -> np.ndarray:
        parts = []
        for at in range(0, len(win), AT_ONCE):
            top = np.maximum(self.pooled(win[at : at + AT_ONCE])[0].max(1) + self.bias, 0)
            z = top @ self.out + self.out_bias
            p = np.exp(z - z.max(1, keepdims=True))
            parts.append(p / p.sum(1, keepdims=True))
        return np.concatenate(parts) if parts else np.zeros((0, len(self.names)), np.float32)


def train(win: np.ndarray, label: np.ndarray, names: list[str]) -> Network:
    rng = np.random.default_rng(SEED)
    f = FILTERS * len(WIDTHS)
    mask = np.zeros((SPAN * DIM, f), np.float32)
    for k, w in enumerate(WIDTHS):
        mask[: w * DIM, k * FILTERS : (k + 1) * FILTERS] = 1
    net = Network(names, rng.normal(0, 0.5, (256, DIM)).astype(np.float32), (rng.normal(0, 0.3, (SPAN * DIM, f)) * mask).astype(np.float32), np.zeros(f, np.float32), rng.normal(0, 0.3, (f, len(names))).astype(np.float32), np.zeros(len(names), np.float32))
    steps, done = EPOCHS * max(1, -(-len(win) // BATCH)), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(win))
        for at in range(0, len(order), BATCH):
            b = order[at : at + BATCH]
            w, y = win[b], label[b]
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            conv, x = net.pooled(w)
            arg = conv.argmax(1)  # (n, f)
            raw = np.take_along_axis(conv, arg[:, None, :], 1)[:, 0] + net.bias
            top = np.maximum(raw, 0)
            z = top @ net.out + net.out_bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(b)), y] -= 1
            p /= len(b)
            back = (p @ net.out.T) * (raw > 0)  # (n, f)
            at_pos = arg[:, :, None] + np.arange(SPAN)  # (n, f, SPAN)
            patch = x[np.arange(len(b))[:, None, None], at_pos].reshape(len(b), f, SPAN * DIM)
            g_filter = np.einsum("nf,nfk->kf", back, patch) * mask
            g_embed = np.zeros_like(net.embed)
            np.add.at(g_embed, w[np.arange(len(b))[:, None, None], at_pos].ravel(), (back[:, :, None] * net.filters.T[None]).reshape(-1, DIM))
            net.out -= rate * (top.T @ p)
            net.out_bias -= rate * p.sum(0)
            net.bias -= rate * back.sum(0)
            net.filters -= rate * g_filter
            net.embed -= rate * g_embed
    return net


def fit(docs: DataFrame) -> Network | None:
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang").where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (id_mod4() != HELD_OUT))
    # the SAMPLE least hashes of a language lie, but for a chance below 1e-80, in its first 2 * SAMPLE / n of their range
    n = known.groupBy(F.col("lang").alias("of")).agg(F.least(F.lit(1.0), 2.0 * SAMPLE / F.count("*")).alias("share"))
    place = (F.xxhash64("doc_id").cast("double") + 2.0**63) / 2.0**64
    near = known.join(F.broadcast(n), F.col("lang") == F.col("of")).where(place <= F.col("share"))
    # at most SAMPLE ids of each language are sent to the scan of the texts
    known = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))).where(F.col("rank") <= SAMPLE)
    chosen = known.select("doc_id", F.col("lang").alias("label"))

    def run(batches):
        for rows, data, off in text_chunks(batches, most=1 << 19):
            got = []
            raw = data.tobytes()
            for a, z in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                starts = sorted({0, *(int(k * max(0, z - a - WINDOW) / (TRAIN_WINDOWS - 1)) for k in range(1, TRAIN_WINDOWS))})
                got.append(b"".join(raw[a + s : min(z, a + s + WINDOW)].ljust(WINDOW, b"\0") for s in starts))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("label"), pa.array(got, pa.binary())], ["doc_id", "label", "windows"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.length("text") > 0).join(F.broadcast(chosen), "doc_id")
    got = texts.select("doc_id", "label", text_col()).mapInArrow(run, "doc_id long, label string, windows binary").toPandas().sort_values(["doc_id", "label"])
    if not len(got):
        return None
    names = sorted(got["label"].unique())
    of = {x: k for k, x in enumerate(names)}
    win = [np.frombuffer(w, np.uint8).reshape(-1, WINDOW) for w in got["windows"]]
    return train(np.concatenate(win), np.repeat([of[x] for x in got["label"]], [len(w) for w in win]), names)


def predict(docs: DataFrame, net: Network | None, keep: list[str] = (), prefix: str = "") -> DataFrame:
    """doc_id, the columns of keep, and with the prefix held_out, lang_pred, score.

    keep may hold any columns; give a prefix where their names clash with the new ones."""

    def run(rows, data, off):
        n = rows.num_rows
        letters = np.concatenate([[0], np.cumsum(_LETTER[data])])[off]
        has = np.diff(letters) > 0
        for k in np.flatnonzero(~has & (np.diff(off) > 0)):
            has[k] = any(map(str.isalpha, data[off[k] : off[k + 1]].tobytes().decode("utf-8", "replace")))
        pred, best = [UND] * n, np.zeros(n)
        if net is not None and has.any():
            win, doc, used = windows(data, off)
            p = net.probabilities(win) * used[:, None]
            mean = np.stack([np.bincount(doc, p[:, k], n) for k in range(p.shape[1])], 1) / np.maximum(np.diff(off), 1)[:, None]
            top = mean.argmax(1)
            pred = [net.names[t] if h else UND for t, h in zip(top.tolist(), has.tolist(), strict=True)]
            best = np.where(has, np.clip(mean[np.arange(n), top], 0, 1), 0.0)
        return [pa.array(pred, pa.string()), pa.array(best, pa.float64())]

    return with_scores(docs, keep, prefix, run, "lang_pred string, score double")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return predict(docs, fit(docs))
