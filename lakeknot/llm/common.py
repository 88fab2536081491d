"""Helpers that the training-data operators share: inputs, shared folders, Arrow text buffers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Bytes of text that a worker turns into arrays at once; one longer text forms a chunk of its own.
CHUNK_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; in local mode (tests) a folder of our own where it is unset."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        import tempfile

        at = tempfile.mkdtemp(prefix="lakeknot-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(at)
    return at


#: Folders of the tables that this process has written and not yet deleted.
_tables: dict[str, SparkSession] = {}


def stored(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """df written once to a table in the shared folder and read back: cuts lineage, survives lost executors.

    Files are as many as the plan's tasks: the scan's splits, or what a shuffle's bytes make. The table lasts until
    `discard` or `drop_tables`."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    _tables[path] = spark
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _tables.pop(path, None)


def drop_tables() -> None:
    """Deletes every table that `stored` has written, once no result that reads them is needed any more."""
    for path, spark in list(_tables.items()):
        _delete(spark, path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `stored` wrote, once all that needs them is stored itself."""
    for t in tables:
        _delete(t.sparkSession, t.stored_at)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def buckets_for(spark: SparkSession, df_bytes: int, target: int = 8 << 20, least: int = 16) -> int:
    """A bucket count that follows the input, so that a bucket stays about the same size."""
    return int(max(least, shuffle_parts(spark), -(-df_bytes // target)))


def input_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan (for files, their bytes); where it knows none, the bytes of the texts, which are read once more for it."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < 1 << 55:
        return size
    return df.agg(F.sum(F.octet_length(F.col("text").cast("string")))).head()[0] or 0


def text_col(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias("text")


#: The fold that nothing is learned from.
HELD_OUT = 2


def id_mod4(col: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 4: the fold; 2 is held out."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % 4


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary array; nulls count as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and len(col) else np.zeros(0, np.uint8)
    return data, off - off[0]


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes of their texts, offsets): slices of the batches with at most `most` bytes of text, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, off = buffers(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
            yield batch.slice(at, to - at), data[off[at] : off[to]], off[at : to + 1] - off[at]
            at = to


_MIX = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads 64-bit values (the public splitmix64 steps)."""
    with np.errstate(over="ignore"):
        x = x + _MIX
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse mod 2^64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for k, base in enumerate((_P, _INV)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def run_hashes(letters: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs letters[starts:ends], equal for equal runs wherever they stand."""
    with np.errstate(over="ignore"):
        p, inv = powers(len(letters) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters * p[: len(letters)], dtype=np.uint64)])
        return mix64((total[ends] - total[starts]) * inv[starts])


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of plans that are no longer referred to."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def split_rows(keys: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """(key, places) of each key that occurs, for keys below n; places in order."""
    if not len(keys):
        return []
    order = np.argsort(keys.astype(np.uint16) if n <= 1 << 16 else keys, kind="stable")
    by = keys[order]
    cuts = np.append(np.flatnonzero(np.r_[True, by[1:] != by[:-1]]), len(by))
    return [(int(by[a]), order[a:z]) for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def binary_array(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary values without a copy for each: values[cuts[i]:cuts[i + 1]] of one typed array."""
    at = cuts.astype(np.int64) * values.itemsize
    if at[-1] < 1 << 31:
        return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])
    raw = memoryview(np.ascontiguousarray(values)).cast("B")
    return pa.array([raw[a:z] for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to differ from all columns."""
    taken, out = {c.lower() for c in columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def column(name: str) -> Column:
    """A column by its whole name, whatever letters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def files_for(spark: SparkSession, size: int, most: int = 128 << 20, least: int = 8 << 20) -> int:
    """Files for `size` bytes: `most` bytes each, or smaller ones (not under `least`) while the cores would lack work."""
    return max(1, -(-size // most), min(-(-size // least), 4 * spark.sparkContext.defaultParallelism))


def with_scores(docs: DataFrame, keep: list[str], prefix: str, run, added: str) -> DataFrame:
    """doc_id, the columns of keep, held_out and the added columns (named with the prefix) that run makes of whole texts.

    run(rows, bytes, offsets) gives the added arrays of a chunk. keep may hold any columns; where a new name clashes
    with one of them, choose another prefix (`fresh` finds one)."""
    keep = ["doc_id", *[c for c in keep if c != "doc_id"]]
    held = F.coalesce(id_mod4() == HELD_OUT, F.lit(False))
    inner = docs.select(F.struct(*[column(c) for c in keep]).alias("kept"), held.alias("held"), text_col())
    new = StructType.fromDDL(added)
    schema = StructType([inner.schema["kept"], inner.schema["held"], *[StructField(f"n{k}", f.dataType) for k, f in enumerate(new)]])

    def chunks(batches):
        for rows, data, off in text_chunks(batches, most=1 << 19):
            yield pa.RecordBatch.from_arrays([rows.column("kept"), rows.column("held"), *run(rows, data, off)], schema.names)

    out = inner.mapInArrow(chunks, schema)
    return out.select(*[F.col("kept")[c].alias(c) for c in keep], F.col("held").alias(f"{prefix}held_out"), *[F.col(f"n{k}").alias(f"{prefix}{f.name}") for k, f in enumerate(new)])
