"""Token-ID output: canonical length-limited Huffman blocks with bit-offset checkpoints, written and read by Spark.

``write_ids`` encodes every text of a table with the tokenizers library, appends an end id, counts ids over the
whole corpus, builds one canonical length-limited Huffman code by package-merge and writes

    <path>/codebook   id, length: the code, canonical by (length, id)
    <path>/blocks     file_no, block_no, doc_ids, n_tokens, checkpoints, bits: the coded documents

File numbers ascend with doc_id and so do the documents of a file, so the whole is in ascending doc_id order.
A block is independent: it holds whole documents, each from a byte boundary, with the bit offset of every
STRIDE-th id as a checkpoint, from which ``read_ids`` decodes all stretches at once by table look-ups.
Parquet is the container, because Spark can put it into any store it can read.

Null texts are empty (the end id alone); rows with a null id sort first; repeated ids keep all their rows; an
empty table gives an empty file set; other columns are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import wordbpe
from .common import binary_array, discard, files_for, input_bytes, read_table, shared_dir, stored, text_chunks, text_col

#: Ids between two checkpoints.
STRIDE = 128
#: Longest code, in bits; more where the vocabulary needs it.
LIMIT = 18
END_ID = 1


#: Bytes of text that make up a block.
BLOCK_TEXT = 2 << 20
BLOCK_COLUMNS = "file_no int, block_no int, n_ids long, doc_ids array<long>, n_tokens array<long>"


def tokenize(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """Blocks of whole documents in ascending doc_id order, with their ids in the vocabulary's width; a task's last row counts its ids instead.

    Documents are dealt to files by ranges of doc_id (rows that share one also by a hash of their text), so that neither
    ids nor codes are shuffled."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_col()).withColumn("tie", F.xxhash64("text"))
    files = files_for(docs.sparkSession, input_bytes(docs))
    sorted_ = base.repartitionByRange(files, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text", F.spark_partition_id().alias("file_no"))

    def run(batches):
        made = wordbpe.encoder(vocabulary)
        total, file_no, block_no = np.zeros(made.largest + 1, np.int64), 0, 0
        for rows, data, off in text_chunks(batches, most=BLOCK_TEXT):
            ids, cut = made.encode(data, off, end_id)
            total += np.bincount(ids, minlength=len(total))
            file_no = rows.column("file_no")[0].as_py()
            yield _block_row(file_no, block_no, len(ids), _list(rows.column("doc_id")), _list(pa.array(np.diff(cut), pa.int64())), [binary_array(ids, np.array([0, len(ids)])), pa.nulls(1, pa.binary())], ["ids", "counts"])
            block_no += 1
        some = np.flatnonzero(total)
        if len(some):
            counts = np.concatenate([some, total[some]]).astype("<i8")
            yield _block_row(file_no, block_no, 0, _list(pa.array([], pa.int64())), _list(pa.array([], pa.int64())), [pa.nulls(1, pa.binary()), binary_array(counts, np.array([0, len(counts)]))], ["ids", "counts"])

    return sorted_.mapInArrow(run, f"{BLOCK_COLUMNS}, ids binary, counts binary")


def _list(values: pa.Array) -> pa.ListArray:
    """A list column of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _block_row(file_no: int, block_no: int, n_ids: int, doc_ids: pa.ListArray, n_tokens: pa.ListArray, more: list[pa.Array], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([file_no], pa.int32()), pa.array([block_no], pa.int32()), pa.array([n_ids], pa.int64()), doc_ids, n_tokens, *more], ["file_no", "block_no", "n_ids", "doc_ids", "n_tokens", *names])


def id_counts(tokens: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(ids, counts) over all documents, from the counts of the tokenizing tasks; at most a row for each id of the vocabulary comes back."""

    def run(batches):
        for b in batches:
            for raw in b.column(0):
                x = np.frombuffer(raw.as_buffer(), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(x[: len(x) // 2]), pa.array(x[len(x) // 2 :])], ["id", "n"])

    found = tokens.where(F.col("counts").isNotNull()).select("counts").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    return found["id"].to_numpy(np.int64), found["n"].to_numpy(np.int64)


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code with no code over `limit` bits, by package-merge."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    limit = max(limit, int(np.ceil(np.log2(n))) + 1)
    order = np.argsort(counts, kind="stable")
    w = counts[order].astype(np.float64)
    packages, leaves = np.zeros(0), []
    for _ in range(limit):
        merged = np.concatenate([w, packages])
        at = np.argsort(merged, kind="stable")
        merged = merged[at]
        leaves.append(np.cumsum(at < n))
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
    lengths, need = np.zeros(n, np.int64), 2 * n - 2
    for level in reversed(leaves):
        if need <= 0:
            break
        k = int(level[need - 1])
        lengths[:k] += 1
        need = 2 * (need - k)
    out = np.zeros(n, np.int64)
    out[order] = lengths
    return out


class Codebook:
    """A canonical code: codes ascend with (length, id)."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[order], lengths[order]
        self.width = int(self.lengths.max()) if len(ids) else 1
        step = np.left_shift(1, self.width - self.lengths).astype(np.int64)
        first = np.cumsum(step) - step  # codes, left-justified in width bits
        size = int(self.ids.max()) + 1 if len(ids) else 1
        self.code, self.length = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code[self.ids] = (first >> (self.width - self.lengths)).astype(np.uint64)
        self.length[self.ids] = self.lengths
        self.symbol_at = np.zeros((1 << self.width) + 1, np.uint16 if size <= 1 << 16 else np.uint32)
        self.length_at = np.ones((1 << self.width) + 1, np.uint8)
        used = int(step.sum())
        self.symbol_at[:used] = np.repeat(self.ids, step)
        self.length_at[:used] = np.repeat(self.lengths, step)

    def encode(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, byte offset of each document, bit offset of each id in its document); a document starts at each of starts."""
        size = self.length[ids]
        end = np.cumsum(size)
        begin = end - size
        ends = np.append(starts[1:], len(ids))
        bits = np.where(ends > starts, end[np.maximum(ends, 1) - 1] - begin[np.minimum(starts, len(ids) - 1)], 0) if len(ids) else np.zeros(len(starts), np.int64)
        nbytes = (bits + 7) >> 3
        offset = np.cumsum(nbytes) - nbytes
        inside = begin - np.repeat(begin[np.minimum(starts, max(len(ids) - 1, 0))] if len(ids) else starts, ends - starts)
        at = np.repeat(offset * 8, ends - starts) + inside
        total = int(nbytes.sum())
        word, shift = at >> 5, (at & 31).astype(np.uint64)
        # each code lies in a 64-bit window that starts at its 32-bit word
        window = self.code[ids] << (np.uint64(64) - shift - size.astype(np.uint64))
        words = np.bincount(word, (window >> np.uint64(32)).astype(np.float64), total // 4 + 3) + np.bincount(word + 1, (window & np.uint64(0xFFFFFFFF)).astype(np.float64), total // 4 + 3)
        return words.astype(np.uint64).astype(">u4").view(np.uint8)[:total], offset, inside

    def decode(self, data: np.ndarray, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The ids of stretches, one after another: stretch i starts at bit at[i] and has counts[i] ids."""
        if not len(at):
            return np.zeros(0, self.symbol_at.dtype)
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        words = (padded[:-3].astype(np.uint32) << 24) | (padded[1:-2].astype(np.uint32) << 16) | (padded[2:-1].astype(np.uint32) << 8) | padded[3:]
        order = np.argsort(-counts, kind="stable")
        at, left = at[order].copy(), counts[order]
        out = np.zeros((int(left[0]), len(at)), self.symbol_at.dtype)
        live = np.searchsorted(-left, -np.arange(1, int(left[0]) + 1), "right")
        mask, drop = np.uint32((1 << self.width) - 1), 32 - self.width
        for k in range(int(left[0])):
            n = live[k]
            a = at[:n]
            peek = (words[a >> 3] >> (drop - (a & 7)).astype(np.uint32)) & mask
            out[k, :n] = self.symbol_at[peek]
            at[:n] += self.length_at[peek]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return out.T[back][np.arange(out.shape[0])[None, :] < counts[:, None]]


def _coded(tokens: DataFrame, book: Codebook, width: str) -> DataFrame:
    """The blocks with doc_bytes, checkpoints (little-endian unsigned 64-bit bit offsets in the document) and bits."""

    def run(batches):
        for b in batches:
            for row in range(b.num_rows):
                one = b.slice(row, 1)
                ids = np.frombuffer(one.column("ids")[0].as_buffer(), width)
                n = one.column("n_tokens").flatten().to_numpy()
                starts = np.cumsum(n) - n
                bits, offset, inside = book.encode(ids, starts)
                stretches = -(-n // STRIDE)
                first = np.repeat(starts, stretches)
                marks = inside[first + STRIDE * (np.arange(len(first)) - np.repeat(np.cumsum(stretches) - stretches, stretches))].astype("<u8")
                size = np.diff(np.append(offset, len(bits)))
                yield _block_row(one.column("file_no")[0].as_py(), one.column("block_no")[0].as_py(), len(ids), _list(one.column("doc_ids").flatten()), _list(one.column("n_tokens").flatten()), [_list(pa.array(size, pa.int64())), binary_array(marks, np.array([0, len(marks)])), binary_array(bits, np.array([0, len(bits)]))], ["doc_bytes", "checkpoints", "bits"])

    blocks = tokens.where(F.col("ids").isNotNull()).select("file_no", "block_no", "doc_ids", "n_tokens", "ids")
    return blocks.mapInArrow(run, f"{BLOCK_COLUMNS}, doc_bytes array<long>, checkpoints binary, bits binary")


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID) -> str:
    """Writes the ids of every text of docs (doc_id, text) under path; returns path."""
    spark = docs.sparkSession
    tokens = stored(tokenize(docs, vocabulary, end_id), "none")
    ids, n = id_counts(tokens)
    lengths = code_lengths(n)
    book = Codebook(ids, lengths)
    spark.createDataFrame([(int(i), int(x)) for i, x in zip(ids, lengths, strict=True)], "id long, length int").coalesce(1).write.parquet(f"{path}/codebook")
    _coded(tokens, book, wordbpe.width(vocabulary)).write.option("compression", "none").parquet(f"{path}/blocks")
    discard(tokens)
    return path


def read_codebook(spark: SparkSession, path: str) -> Codebook:
    rows = spark.read.parquet(f"{path}/codebook").toPandas()
    return Codebook(rows["id"].to_numpy(np.int64), rows["length"].to_numpy(np.int64))


def _decoded(n: np.ndarray, sizes: np.ndarray, checkpoints: np.ndarray, bits: np.ndarray, book: Codebook) -> np.ndarray:
    """The ids of a block's documents, from their counts and bytes."""
    stretches = -(-n // STRIDE)
    at = np.repeat((np.cumsum(sizes) - sizes) * 8, stretches) + checkpoints.astype(np.int64)
    counts = np.full(len(at), STRIDE, np.int64)
    some = n > 0
    counts[(np.cumsum(stretches) - 1)[some]] = (n - (stretches - 1) * STRIDE)[some]
    return book.decode(bits, at, counts)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, file_no, block_no, start_in_block, n_tokens, ids_u32 (little-endian unsigned 32-bit ids) as the files hold them."""
    book = read_codebook(spark, path)

    def run(batches):
        for b in batches:
            for row in range(b.num_rows):
                one = b.slice(row, 1)
                raw = lambda c: one.column(c)[0].as_buffer()  # noqa: E731, B023
                n = one.column("n_tokens").flatten().to_numpy()
                ids = _decoded(n, one.column("doc_bytes").flatten().to_numpy(), np.frombuffer(raw("checkpoints"), "<u8"), np.frombuffer(raw("bits"), np.uint8), book)
                cuts, k = np.append(0, np.cumsum(n)), len(n)
                same = lambda c, t: pa.array(np.full(k, one.column(c)[0].as_py()), t)  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([one.column("doc_ids").flatten(), same("file_no", pa.int32()), same("block_no", pa.int32()), pa.array(cuts[:-1], pa.int64()), pa.array(n, pa.int64()), binary_array(ids.astype("<u4"), cuts)], ["doc_id", "file_no", "block_no", "start_in_block", "n_tokens", "ids_u32"])

    return spark.read.parquet(f"{path}/blocks").mapInArrow(run, "doc_id long, file_no int, block_no int, start_in_block long, n_tokens long, ids_u32 binary")


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """file_no, block_no, block_start: ids before each block; from the small columns of the files alone."""
    sizes = spark.read.parquet(f"{path}/blocks").select("file_no", "block_no", "n_ids")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    # a row for each file: as many as the write's tasks
    files = sizes.groupBy("file_no").agg(F.sum("n_ids").alias("n")).withColumn("file_start", F.coalesce(F.sum("n").over(before.orderBy("file_no")), F.lit(0))).drop("n")
    inside = F.coalesce(F.sum("n_ids").over(before.partitionBy("file_no").orderBy("block_no")), F.lit(0))
    return sizes.withColumn("inside", inside).join(files, "file_no").select("file_no", "block_no", (F.col("file_start") + F.col("inside")).alias("block_start"))


def op9_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    path = write_ids(read_table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}", wordbpe.vocabulary())
    docs = read_ids(spark, path).select("doc_id", "file_no", "block_no", "start_in_block", "n_tokens", F.crc32("ids_u32").alias("ids_crc32"))
    return docs.join(block_starts(spark, path), ["file_no", "block_no"]).select("doc_id", (F.col("block_start") + F.col("start_in_block")).alias("start"), "n_tokens", "ids_crc32")
