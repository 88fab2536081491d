"""Macro F-beta, sweeps over rules, blocking recall, and deterministic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.catalog import numbered
from . import decide

BETA2 = 0.25
#: Buckets of entities: the first for fitting, the next for validation.
FIT, VALIDATION, BUCKETS = 30, 8, 100
#: Depths at which recall is told.
KS = (1, 2, 3, 4, 5, 8, 12)


def f_beta(pred: Column, true: Column, tp: Column, beta2: float = BETA2) -> Column:
    """An entity's F; 1 where nothing is predicted and nothing true."""
    p, r = F.when(pred > 0, tp / pred).otherwise(0.0), F.when(true > 0, tp / true).otherwise(0.0)
    d = beta2 * p + r
    return F.when((pred == 0) & (true == 0), 1.0).when(d > 0, (1 + beta2) * p * r / d).otherwise(0.0)


def entity_counts(pairs: DataFrame, *also: str) -> DataFrame:
    """pred, tp of each entity that has pairs (y: 1 for true ones)."""
    return pairs.groupBy(*also, "s1_id").agg(F.count("*").alias("pred"), F.sum("y").cast("bigint").alias("tp"))


def macro_f(entities: DataFrame, predicted: DataFrame) -> DataFrame:
    """macro_f, entities: over every entity (s1_id, n_true), those without predictions too."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    joined = entities.join(entity_counts(predicted), "s1_id", "left")
    return joined.agg(F.round(F.avg(f_beta(zero("pred"), F.col("n_true"), zero("tp"))), 6).alias("macro_f"), F.count("*").alias("entities"))


def grid(lo: float, hi: float, by: float) -> list[float]:
    """lo, lo + by, ... up to hi, two digits each."""
    return [round(lo + k * by, 2) for k in range(round((hi - lo) / by) + 1)]


def level(value: Column, levels: list) -> Column:
    """How many of the rising levels value reaches, by halving."""

    def among(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value >= levels[mid], among(mid + 1, hi)).otherwise(among(lo, mid))

    return among(0, len(levels))


def sweep(entities: DataFrame, pairs: DataFrame, thresholds: list[float], floors: list[float], one_owner: bool = False, only_scored: bool = False, by: str | None = None) -> DataFrame:
    """thr, rel, macro_f of each rule of the grid (rising thresholds and floors).

    Ranks and owners don't depend on a rule, so they are found once. A pair is reduced to the highest threshold and the
    highest floor that it reaches, pairs to counts of these for each entity; from the top down, an entity's F changes
    only at thresholds where it has pairs, and only these changes are summed. by: a column of entities, for whose values
    the grid is told too, 'ALL' standing for all. only_scored: over entities with pairs alone."""
    held = decide.exclusive(pairs) if one_owner else pairs
    # an entity's best score is over all its pairs, those that others own too
    best = pairs.groupBy("s1_id").agg(F.max("score").alias("best"))
    reached = held.join(best, "s1_id").select("s1_id", "y", level(F.col("score"), thresholds).alias("t"), level(F.col("score"), [F.lit(r) * F.col("best") for r in floors]).alias("f"))
    counts = reached.where((F.col("t") > 0) & (F.col("f") > 0)).groupBy("s1_id", "t", "f").agg(F.count("*").alias("n"), F.sum("y").alias("tp"))
    counts = counts.withColumn("f", F.explode(F.sequence(F.lit(1), F.col("f")))).groupBy("s1_id", "f", "t").agg(F.sum("n").alias("n"), F.sum("tp").alias("tp"))
    base = entities.join(best.select("s1_id"), "s1_id", "left_semi") if only_scored else entities
    base = base.select("s1_id", "n_true", (F.col(by) if by else F.lit("ALL")).alias("part"))
    down = Window.partitionBy("s1_id", "f").orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = counts.withColumns({"pred": F.sum("n").over(down), "hit": F.sum("tp").over(down)}).join(base, "s1_id")
    change = f_beta(F.col("pred"), F.col("n_true"), F.col("hit")) - f_beta(F.col("pred") - F.col("n"), F.col("n_true"), F.col("hit") - F.col("tp"))
    parts = F.explode(F.array_distinct(F.array("part", F.lit("ALL")))).alias("part")
    # from here on a row for each part and rule
    changes = upto.select("part", "f", "t", change.alias("g")).groupBy("part", "f", "t").agg(F.sum("g").alias("g")).select(parts, "f", "t", "g").groupBy("part", "f", "t").agg(F.sum("g").alias("g"))
    without = base.groupBy("part").agg(F.sum((F.col("n_true") == 0).cast("int")).alias("zero"), F.count("*").alias("n")).select(parts, "zero", "n").groupBy("part").agg(F.sum("zero").alias("zero"), F.sum("n").alias("n"))
    rules = without.withColumn("r", F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.lit(x).alias("thr"), F.lit(f).alias("f"), F.lit(r).alias("rel")) for t, x in enumerate(thresholds, 1) for f, r in enumerate(floors, 1)]))).select("part", "zero", "n", "r.*")
    above = Window.partitionBy("part", "f").orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum(F.coalesce("g", F.lit(0.0))).over(above) + F.col("zero")
    out = rules.join(changes, ["part", "f", "t"], "left").select(*([F.col("part").alias(by)] if by else []), "thr", "rel", F.round(total / F.col("n"), 6).alias("macro_f"))
    return out


def best_rule(swept: DataFrame, *by: str) -> DataFrame:
    """The first best rule, of all or for each value of by."""
    first = Window.partitionBy(*(by or [F.lit(1)])).orderBy(F.desc("macro_f"), "thr", "rel")
    return swept.withColumn("__rn", F.row_number().over(first)).where(F.col("__rn") == 1).drop("__rn")


def truth_pairs(truth: DataFrame, source: int) -> DataFrame:
    """s1_id, cand_id of one source, from comma-joined lists (source1_entity_id, matched_entity_ids)."""
    rows = truth.where(F.col("matched_entity_ids") != "").select(F.col("source1_entity_id").alias("s1_id"), F.explode(F.split("matched_entity_ids", ",")).alias("cand_id"))
    return rows.where(F.col("cand_id").startswith(f"S{source}-"))


def truth_counts(truth: DataFrame) -> DataFrame:
    n = F.when(F.col("matched_entity_ids") == "", 0).otherwise(F.size(F.split("matched_entity_ids", ",")))
    return truth.select(F.col("source1_entity_id").alias("s1_id"), n.cast("bigint").alias("n_true"))


def labelled(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """pairs with y: 1 where truth (s1_id, cand_id) has them."""
    t = truth.select("s1_id", "cand_id").distinct().withColumn("__hit", F.lit(1))
    return pairs.join(t, ["s1_id", "cand_id"], "left").withColumn("y", F.coalesce("__hit", F.lit(0))).drop("__hit")


def blocking_recall(clean: DataFrame, pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """country, source (0: all): true, found, recall, pairs for each entity, entities with a match found."""
    n = clean.groupBy("country").agg(F.count("*").alias("n_s1"))
    hits = labelled(truth.select("country", "source", "s1_id", "cand_id"), pairs)
    both = F.explode(F.array(F.col("source"), F.lit(0))).alias("source")
    t = hits.select("country", both, "s1_id", "y").groupBy("country", "source").agg(F.count("*").alias("true"), F.sum("y").cast("bigint").alias("found"), F.countDistinct("s1_id").alias("with_truth"), F.countDistinct(F.when(F.col("y") == 1, F.col("s1_id"))).alias("reached"))
    c = pairs.select("country", both).groupBy("country", "source").agg(F.count("*").alias("pairs"))
    out = t.join(c, ["country", "source"], "left").join(n, "country")
    return out.select("country", "source", "true", "found", F.round(F.col("found") / F.greatest("true", F.lit(1)), 6).alias("recall"), F.round(F.coalesce("pairs", F.lit(0)) / F.col("n_s1"), 6).alias("per_entity"), F.round(F.col("reached") / F.greatest("with_truth", F.lit(1)), 6).alias("reachable"))


def recall_micro_macro(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    hits = labelled(truth.select("s1_id", "cand_id"), pairs)
    each = hits.groupBy("s1_id").agg(F.sum("y").alias("hit"), F.count("*").alias("n"))
    return each.agg(F.round(F.sum("hit") / F.sum("n"), 6).alias("micro"), F.round(F.avg(F.col("hit") / F.col("n")), 6).alias("macro"))


def recall_at_k(pairs: DataFrame, truth: DataFrame, ks: tuple[int, ...] = KS) -> DataFrame:
    """k, recall, recall_all: records whose true entity is among the first k (rn), of those with candidates and truth, and of all with truth."""
    own = truth.select("cand_id", F.col("s1_id").alias("own"))
    found = pairs.select("cand_id", "s1_id", "rn").join(own, "cand_id", "right")
    at = found.groupBy("cand_id").agg(F.min(F.when(F.col("s1_id") == F.col("own"), F.col("rn"))).alias("at"), F.count("s1_id").alias("some"))
    row = at.agg(F.count("*").alias("all"), F.count_if(F.col("some") > 0).alias("n"), *[F.count_if(F.col("at") <= k).alias(f"k{k}") for k in ks])
    share = lambda k, n: F.round(F.col(f"k{k}") / F.greatest(n, F.lit(1)), 6)
    return row.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), share(k, "n").alias("recall"), share(k, "all").alias("recall_all")) for k in ks])).alias("r")).select("r.*")


def bucket(index: Column) -> Column:
    """A record's bucket by a multiplicative hash of its row number."""
    return F.shiftright((index.cast("bigint") * 2654435761).bitwiseAND(4294967295), 13) % BUCKETS


def fold(entity: Column, folds: int = 5) -> Column:
    return F.shiftright((entity.cast("bigint") * 2654435761).bitwiseAND(4294967295), 7) % folds


def sampled(index: Column) -> Column:
    return bucket(index) < FIT + VALIDATION


def split_of(index: Column) -> Column:
    b = bucket(index)
    return F.when(b < FIT, "fit").when(b < FIT + VALIDATION, "validation").otherwise("rest")


def entity_code(country_index: Column, index: Column) -> Column:
    return country_index.cast("bigint") * 10_000_000 + index


def hash_sample(records: DataFrame, key: str, n: int) -> DataFrame:
    """n records in order of a hash of their key."""
    return records.orderBy(F.xxhash64(key), key).limit(n)


def stop_entities(validation: DataFrame) -> DataFrame:
    """Every fifth validation entity, in order; early stopping watches them."""
    return numbered(validation.select("s1_id").distinct(), "s1_id").where(F.col("__row") % 5 == 0).drop("__row")
