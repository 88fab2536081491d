"""Tables of a linkage project: raw text, normalised records, candidates, scores, lists.

Raw tables are tab-separated text without quoting, all columns text; an empty field is an empty text, never NULL.
Everything that is written is a partitioned Parquet table, so country and source prune files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

SOURCE = StructType([StructField(c, StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
TRUTH = StructType([StructField(c, StringType()) for c in ("source1_entity_id", "matched_entity_ids")])
TSV = {"sep": "\t", "quote": "", "header": "true", "escape": "", "encoding": "UTF-8"}


@dataclass(frozen=True)
class Catalog:
    """Where the tables of a project are; root is any path that Spark can read and write."""

    root: str

    def source_tsv(self, split: str, source: int) -> str:
        return f"{self.root}/raw/{split}_source{source}.tsv"

    def source(self, split: str, source: int) -> str:
        return f"{self.root}/source/split={split}/source={source}"

    def truth(self, split: str) -> str:
        return f"{self.root}/truth/split={split}"

    def norm(self, split: str) -> str:
        return f"{self.root}/norm/split={split}"

    def candidates(self, split: str) -> str:
        return f"{self.root}/candidates/split={split}"

    def scored(self, split: str) -> str:
        return f"{self.root}/scored/split={split}"

    def output(self, name: str) -> str:
        return f"{self.root}/output/{name}"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def scan_tsv(spark: SparkSession, path: str, schema: StructType = SOURCE) -> DataFrame:
    """A raw table; stray quotes, backslashes, blanks, NULL and NA are text like any other."""
    rows = spark.read.schema(schema).options(**TSV).option("mode", "PERMISSIVE").option("nullValue", "\u0000").csv(path)
    return rows.select(*[F.coalesce(c, F.lit("")).alias(c) for c in schema.names])


def write_tsv(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Rows as tab-separated text with a header in each file; mode 'append' resumes."""
    rows.write.mode(mode).options(**TSV).option("emptyValue", "").option("nullValue", "").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)


def tsv_to_parquet(spark: SparkSession, tsv: str, parquet: str, schema: StructType = SOURCE) -> None:
    scan_tsv(spark, tsv, schema).write.mode("overwrite").option("compression", "zstd").parquet(parquet)


def read_source(spark: SparkSession, catalog: Catalog, split: str, source: int, columns: list[str] | None = None) -> DataFrame:
    """The Parquet table where there is one, else the text; only the named columns are read."""
    path = catalog.source(split, source)
    rows = spark.read.schema(SOURCE).parquet(path) if exists(spark, path) else scan_tsv(spark, catalog.source_tsv(split, source))
    return rows.select(*columns) if columns else rows


def countries(records: DataFrame) -> DataFrame:
    """country, n by count, then name."""
    return records.groupBy("country").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "country")


def write_partitioned(rows: DataFrame, path: str, *by: str) -> None:
    """Writes over the partitions that rows have and leaves the others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*by).parquet(path)


def load_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Candidate pairs; readers that need an order ask for one."""
    return spark.read.parquet(path)


def cached(spark: SparkSession, path: str, make, *by: str) -> DataFrame:
    """The table at path, made and written first where there is none."""
    if not exists(spark, f"{path}/_SUCCESS"):
        write_partitioned(make(), path, *by)
    return spark.read.parquet(path)


def package(files: dict[str, str], target: str, required: tuple[str, ...]) -> str:
    """A zip of local files (name -> path) at target; ValueError where a required one lacks or the zip doesn't read back."""
    import zipfile

    if lacks := [n for n in required if n not in files]:
        raise ValueError(f"missing: {', '.join(lacks)}")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for name, path in sorted(files.items()):
            z.write(path, name)
    with zipfile.ZipFile(target) as z:
        if z.testzip() or sorted(z.namelist()) != sorted(files):
            raise ValueError("the archive does not read back")
    return target


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: under spark.checkpoint.dir, or a temporary one where that is unset in local mode (tests)."""
    import tempfile
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="lakeknot-")
    return f"{base}/{name}-{uuid.uuid4().hex}"


#: Folders that `scratch` has written and not yet deleted.
_scratch: dict[str, SparkSession] = {}


def scratch(rows: DataFrame, name: str) -> DataFrame:
    """rows written once to a work folder and read back: they are made a single time, and lost executors don't make them again."""
    path = work_folder(rows.sparkSession, name)
    _scratch[path] = rows.sparkSession
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def drop_scratch() -> None:
    """Deletes all that `scratch` has written, once no result that reads it is needed any more."""
    for path, spark in list(_scratch.items()):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        del _scratch[path]


def numbered(rows: DataFrame, *by: str) -> DataFrame:
    """rows with __row: their number, from 0, in the order of the columns; by a range sort and the sizes of its parts, not in one task."""
    parts = scratch(rows.orderBy(*by).withColumn("__place", F.monotonically_increasing_id()), "numbered")
    part, place = F.shiftright("__place", 33), F.col("__place").bitwiseAND((1 << 33) - 1)
    # a row for each task of the sort
    sizes = parts.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return parts.withColumn("__part", part).join(F.broadcast(sizes), "__part").withColumn("__row", F.col("__before") + place).drop("__part", "__before", "__place")
