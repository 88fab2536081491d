"""The whole linkage as one plan, and the batch that runs, checks and promotes it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import normalized
from ..operators import decide, features, model, retrieve
from ..sources import catalog as C

#: A new model takes over when its macro F is above the old by more than this.
GAIN = 0.0005


@dataclass
class Linker:
    """Scores candidate pairs by one or two models and gives each record one owner."""

    first: Model
    second: Model | None = None
    rule: decide.Rule = field(default_factory=decide.Rule)
    reverse: retrieve.Reverse = field(default_factory=retrieve.Reverse)

    def candidates(self, clean: DataFrame, noisy: DataFrame) -> DataFrame:
        return retrieve.reverse(clean, noisy, self.reverse).drop("rn").withColumn("pass_id", F.lit(1))

    def score_pairs(self, pairs: DataFrame, clean: DataFrame, noisy: DataFrame) -> DataFrame:
        rows = model.score(features.stage1(pairs, clean, noisy), self.first, features.STAGE1, "score1")
        if self.second is None:
            return rows.withColumn("score", F.col("score1"))
        return model.score(features.stage2(rows, clean), self.second, model.STAGE2_NAMES, "score")

    def link(self, clean: DataFrame, noisy: DataFrame) -> DataFrame:
        """country, source, s1_id, cand_id, score of the pairs that stay."""
        scored = self.score_pairs(self.candidates(clean, noisy), clean, noisy).select("country", "source", "s1_id", "cand_id", "score")
        return decide.exclusive(decide.rule(scored, self.rule))


def predict(linker: Linker, catalog: C.Catalog, split: str, records: DataFrame) -> str:
    """Writes candidates, scores and lists to staging; returns the staging path. records: raw rows with source."""
    spark = records.sparkSession
    norm = C.cached(spark, catalog.norm(split), lambda: normalized(records), "source", "country")
    clean, noisy = norm.where(F.col("source") == 1), norm.where(F.col("source") > 1)
    pairs = C.cached(spark, catalog.candidates(split), lambda: linker.candidates(clean, noisy), "country", "source")
    scored = C.cached(spark, catalog.scored(split), lambda: linker.score_pairs(pairs, clean, noisy).select("country", "source", "s1_id", "cand_id", "score"), "country", "source")
    kept = decide.exclusive(decide.rule(scored, linker.rule))
    entities = clean.select(F.col("entity_id").alias("s1_id"))
    staging = catalog.output("staging")
    C.write_tsv(decide.entity_lists(entities, kept, "matched_entity_ids").withColumnRenamed("s1_id", "source1_entity_id"), f"{staging}/matching")
    C.write_tsv(decide.entity_lists(entities, pairs, "candidate_entity_ids").withColumnRenamed("s1_id", "source1_entity_id"), f"{staging}/candidates")
    return staging


def promote(checks: DataFrame, macro_f: float, best_so_far: float) -> bool:
    """Whether the staged output may take over: all checks clean and the gain large enough."""
    return macro_f > best_so_far + GAIN and checks.where(F.col("bad") > 0).isEmpty()


def incremental_link(linker: Linker, clean: DataFrame, batch: DataFrame) -> DataFrame:
    """Owners of a new batch of raw noisy rows against the standing clean records."""
    return linker.link(clean, normalized(batch))
