"""Decision rules, one owner for each record, and the lists that are handed in."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Values of the hash that orders samples.
HASHES = 10007


@dataclass(frozen=True)
class Rule:
    """threshold; share of the entity's best score that is needed (0: none); pairs an entity keeps at most (0: all)."""

    threshold: float = 0.5
    rel_floor: float = 0.0
    max_per_entity: int = 0


def parse_rule(spec: str) -> Rule:
    """'thr=0.8,rel=0.3,cap=2' to a Rule; a KeyError for other keys."""
    names = {"thr": ("threshold", float), "rel": ("rel_floor", float), "cap": ("max_per_entity", lambda v: int(float(v)))}
    return Rule(**{names[k][0]: names[k][1](v) for k, v in (part.split("=") for part in spec.split(","))})


def within(entity: str = "s1_id") -> Column:
    """A pair's place among its entity's, best score first; ties by source and record."""
    return F.row_number().over(Window.partitionBy(entity).orderBy(F.desc("score"), "source", "cand_id"))


def apply_rule(pairs: DataFrame, threshold, rel_floor, cap) -> DataFrame:
    """Pairs (s1_id, source, cand_id, score) that a rule keeps; its parts are numbers or columns."""
    c = lambda x: x if isinstance(x, Column) else F.lit(x)
    best = F.max("score").over(Window.partitionBy("s1_id"))
    held = pairs.withColumns({"__best": best, "__place": within()})
    keep = (F.col("score") >= c(threshold)) & ((c(rel_floor) <= 0) | (F.col("score") >= c(rel_floor) * F.col("__best"))) & ((c(cap) <= 0) | (F.col("__place") <= c(cap)))
    return held.where(keep).drop("__best", "__place")


def rule(pairs: DataFrame, r: Rule) -> DataFrame:
    return apply_rule(pairs, r.threshold, r.rel_floor, r.max_per_entity)


def rethreshold(pairs: DataFrame, rules: DataFrame) -> DataFrame:
    """Cached scores under each country's rule (country, threshold, rel_floor, cap), then exclusive."""
    kept = apply_rule(pairs.join(rules, "country"), F.col("threshold"), F.col("rel_floor"), F.col("cap"))
    return exclusive(kept.drop("threshold", "rel_floor", "cap"))


def exclusive(pairs: DataFrame, *also: str) -> DataFrame:
    """Each record only for the entity that scores it best; ties to the smaller entity. also: more keys, as of a grid."""
    owner = Window.partitionBy(*also, "source", "cand_id").orderBy(F.desc("score"), "s1_id")
    return pairs.withColumn("__rn", F.row_number().over(owner)).where(F.col("__rn") == 1).drop("__rn")


def entity_lists(entities: DataFrame, pairs: DataFrame, ids: str = "ids") -> DataFrame:
    """s1_id, ids: comma-joined records by source and id, '' for entities without any; every entity has a row."""
    joined = pairs.groupBy("s1_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("source", "cand_id"))), lambda x: x["cand_id"].cast("string")), ",").alias(ids))
    return entities.select("s1_id").join(joined, "s1_id", "left").withColumn(ids, F.coalesce(ids, F.lit("")))


def merge_lists(first: Column, second: Column) -> Column:
    """Two comma-joined lists as one, without a stray comma."""
    return F.concat_ws(",", F.when(first != "", first), F.when(second != "", second))


def list_checks(entities: DataFrame, matched: DataFrame, candidates: DataFrame) -> DataFrame:
    """check, bad: counts of entities without or with several rows, of unknown entities, repeated records, and matches that aren't candidates."""
    flat = lambda t, c: t.where(F.col(c) != "").select("s1_id", F.explode(F.split(c, ",")).alias("cand"))
    m, c = flat(matched, "matched"), flat(candidates, "candidates")
    rows = matched.groupBy("s1_id").agg(F.count("*").alias("n"))
    checks = [
        ("missing entity", entities.join(rows, "s1_id", "left_anti")),
        ("repeated entity", rows.where(F.col("n") > 1)),
        ("unknown entity", rows.join(entities, "s1_id", "left_anti")),
        ("record of several entities", m.groupBy("cand").agg(F.count("*").alias("n")).where(F.col("n") > 1)),
        ("match not a candidate", m.join(c, ["s1_id", "cand"], "left_anti")),
    ]
    out = None
    for name, bad in checks:
        row = bad.agg(F.count("*").alias("bad")).select(F.lit(name).alias("check"), "bad")
        out = row if out is None else out.unionByName(row)
    return out


def in_band(score: Column, lo: float = 0.20, hi: float = 0.90) -> Column:
    return score.between(lo, hi)


def blend(first: Column, second: Column, weight: Column | float) -> Column:
    """In the band a weighted mean of two scorers, outside it the first."""
    w = weight if isinstance(weight, Column) else F.lit(weight)
    return F.when(in_band(first), (1 - w) * first + w * second).otherwise(first)


def band_sample(pairs: DataFrame, cap: int) -> DataFrame:
    """Pairs in the band and each entity's hardest negative, as many of either label, at most cap, in order of a hash; ties by entity and record.

    The hash has HASHES values; counts of these tell from which on a label's rows are too many, and only the rows of that
    one value are put in order."""
    hardest = Window.partitionBy("s1_id").orderBy(F.col("y"), F.desc("score"), "source", "cand_id")
    some = pairs.withColumn("__rn", F.row_number().over(hardest)).where(in_band(F.col("score")) | ((F.col("__rn") == 1) & (F.col("y") == 0))).drop("__rn")
    some = some.withColumn("__h", (F.col("cand_id") * 7919 + F.col("s1_id") * 31) % HASHES)
    counts = some.groupBy("y", "__h").agg(F.count("*").alias("__n"))
    each = counts.agg(F.sum(F.when(F.col("y") == 1, F.col("__n"))).alias("p"), F.sum(F.when(F.col("y") == 0, F.col("__n"))).alias("q"))
    per = each.select(F.least(F.lit(cap // 2), *[F.greatest(F.coalesce(c, F.lit(0)), F.lit(1)) for c in ("p", "q")]).alias("__per"))
    before = Window.partitionBy("y").orderBy("__h").rowsBetween(Window.unboundedPreceding, -1)
    # at most 2 * HASHES rows
    room = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).join(per).where(F.col("__before") < F.col("__per"))
    room = room.select("y", "__h", (F.col("__per") - F.col("__before")).alias("__room"), (F.col("__per") - F.col("__before") < F.col("__n")).alias("__cut"))
    near = some.join(F.broadcast(room), ["y", "__h"])
    order = Window.partitionBy("y", "__h").orderBy("s1_id", "cand_id")
    last = near.where("__cut").withColumn("__rn", F.row_number().over(order)).where(F.col("__rn") <= F.col("__room")).drop("__rn")
    return near.where(~F.col("__cut")).unionByName(last).drop("__h", "__room", "__cut")
