"""The corpus pipeline: five stages over documents, each calling one operator.

quality    documents that the quality classifier does not predict to be good go
language   documents without an identified language go: no letter, or no language with MIN_SCORE
near       of each group of near duplicates (five-word shingles, Jaccard 0.8 or more) the smallest doc_id stays
repeats    passages of 50 bytes or more that also start in a document with a smaller doc_id are cut out of the text
packing    what is left is packed into sequences

All but the last return the columns of documents; `repeats` sets text and n_chars anew, dropping the bytes of a
character that was cut in two, and keeps documents of which nothing is left. Null texts count as empty texts; rows with
a null doc_id pass `near` and `repeats` as they are; rows that share an id share their fate in `near`; of ties the smallest
doc_id stays; texts of any length are read whole; empty tables pass all stages; extra columns of any name pass all but
the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeknot.llm import language, ngramjoin, packing, quality, substrings, wordbpe
from lakeknot.llm.common import column, discard, fresh, read_table, stored

#: Mean probability from which a language counts as identified; chance alone gives less.
MIN_SCORE = 0.35


def unused_prefix(docs: DataFrame) -> str:
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    return prefix


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model, own = quality.fit(docs, read_table(spark, sf_dir, "labels")), unused_prefix(docs)
    scored = quality.score(docs, model, keep=docs.columns, prefix=own)
    return scored.where(column(f"{own}predicted") == 1).select(*map(column, docs.columns))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = unused_prefix(docs)
    found = language.predict(docs, language.fit(docs), keep=docs.columns, prefix=own)
    return found.where((column(f"{own}lang_pred") != language.UND) & (column(f"{own}score") >= MIN_SCORE)).select(*map(column, docs.columns))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    copy = fresh(docs.columns, "copy")[0]
    found = ngramjoin.groups(docs)
    copies = found.where(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias(copy)).distinct()
    return docs.join(copies, column("doc_id") == column(copy), "left_anti").select(*map(column, docs.columns))


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(docs)
    text = F.when(F.size("ranges") > 0, substrings.valid_text(F.col("kept"))).otherwise(F.col("kept").cast("string"))
    made = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return cut.select("row", text.alias("text")).select(*[made.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, wordbpe.vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near", near_stage),
    ("repeats", repeats_stage),
    ("packing", packing_stage),
]

#: SQL can't express the learned stages and the packing; tests hold the others against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES[:-1]):
        after = stored(stage(spark, docs, sf_dir))
        if n:
            discard(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
