"""Loss attribution, noise classes, and profiles of sources, truth and output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab


def upper_case(c: Column) -> Column:
    """Whether c has letters and none of them is small."""
    return (F.upper(c) == c) & (F.lower(c) != c)


def noise_label(pair_flags: Column, addr_empty: Column, shares_word: Column, name: Column) -> Column:
    """The most specific noise class of a noisy record beside its clean one."""
    return (
        F.when(pair_flags.bitwiseAND(1) > 0, "indic script").when(pair_flags.bitwiseAND(4) > 0, "url-like name").when(addr_empty, "empty address").when(~shares_word, "alias name").when(upper_case(name), "allcaps").otherwise("clean-ish")
    )


def noise_of(name: Column, addr: Column) -> Column:
    """The noise class of a record by itself."""
    return F.when(addr == "", "empty address").when(name.rlike(vocab.INDIC), "indic script").when(name.rlike("(?i)" + vocab.URL_NOISE), "url-like name").when(upper_case(name), "allcaps").otherwise("other")


def loss_attribution(truth: DataFrame, scored: DataFrame, threshold: float) -> DataFrame:
    """country (ALL: together): blocked, tp, fn, fp at a threshold."""
    t = truth.select("country", "s1_id", "cand_id").withColumn("y", F.lit(1))
    s = scored.select("country", "s1_id", "cand_id", "score")
    both = t.join(s, ["country", "s1_id", "cand_id"], "full_outer").withColumn("y", F.coalesce("y", F.lit(0)))
    count = lambda c: F.sum(c.cast("int")).cast("bigint")
    hit = F.coalesce(F.col("score") >= threshold, F.lit(False))
    rows = both.withColumn("country", F.explode(F.array("country", F.lit("ALL"))))
    return rows.groupBy("country").agg(count((F.col("y") == 1) & F.col("score").isNull()).alias("blocked"), count((F.col("y") == 1) & hit).alias("tp"), count((F.col("y") == 1) & F.col("score").isNotNull() & ~hit).alias("fn"), count((F.col("y") == 0) & hit).alias("fp"))


def crosstab(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Counts by both columns, with margins as 'All'."""
    return rows.cube(a, b).agg(F.count("*").alias("n")).select(F.coalesce(a, F.lit("All")).alias(a), F.coalesce(b, F.lit("All")).alias(b), "n")


def miss_cause(shared: Column, indexed: Column) -> Column:
    """Why a true entity was not retrieved, by the words shared with it and those of them in the index."""
    return F.when(F.size(shared) == 0, "no shared token").when(F.size(indexed) == 0, "shared but unindexed").otherwise("outranked")


def fn_reason(truth: DataFrame, scored: DataFrame, ruled: DataFrame, predicted: DataFrame, threshold: float) -> DataFrame:
    """source, s1_id, cand_id, reason of each true pair that is not predicted. ruled: the pairs that the rule keeps, before owners are found."""
    key = ["source", "s1_id", "cand_id"]
    missed = truth.select(*key).join(predicted.select(*key), key, "left_anti").join(scored.select(*key, "score"), key, "left").join(ruled.select(*key, F.lit(True).alias("kept")), key, "left")
    reason = F.when(F.col("score").isNull(), "never_a_candidate").when(F.col("score") < threshold, "below_threshold").when(F.col("kept").isNull(), "below_floor_or_cap").otherwise("taken_by_another_s1")
    return missed.select(*key, reason.alias("reason"))


def fp_owner(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """source, s1_id, cand_id, true_owner of each predicted pair that is not true."""
    own = truth.select("source", "cand_id", F.col("s1_id").alias("true_owner"))
    return predicted.join(own, ["source", "cand_id"], "left").where(F.col("true_owner").isNull() | (F.col("true_owner") != F.col("s1_id"))).select("source", "s1_id", "cand_id", "true_owner")


def source_profile(records: DataFrame) -> DataFrame:
    """source: rows and counts of what its names and addresses look like."""
    name, addr = F.col("business_name"), F.col("business_address")
    count = lambda c: F.count_if(c)
    return records.groupBy("source").agg(
        F.count("*").alias("rows"),
        count(name == "").alias("empty_name"),
        count(addr == "").alias("empty_address"),
        count(name.rlike("[ऀ-ॿ]")).alias("devanagari"),
        count(name.rlike(r"[^\x00-\x7F]")).alias("non_ascii"),
        count(name.rlike("(?i)" + vocab.URLISH)).alias("url_like"),
        count(name.startswith("--")).alias("dashes"),
        count(~name.rlike("[a-z]")).alias("name_caps"),
        count(~addr.rlike("[a-z]")).alias("addr_caps"),
        count(addr.rlike(r"\b[0-9]{5}\b")).alias("five_digits"),
        count(addr.rlike(r"\b[0-9]{6}\b")).alias("six_digits"),
        F.countDistinct("business_name").alias("names"),
        F.round(F.avg(F.length("business_name")), 6).alias("name_len"),
        F.round(F.avg(F.length("business_address")), 6).alias("addr_len"),
    )


def country_shares(records: DataFrame) -> DataFrame:
    """source, country, n, share of the source; by count."""
    n = records.groupBy("source", "country").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("source")), 6))


def truth_profile(truth: DataFrame) -> DataFrame:
    """One row: entities, singletons, matches of the others, distinct matched records, F of empty answers."""
    n = F.when(F.col("matched_entity_ids") == "", 0).otherwise(F.size(F.split("matched_entity_ids", ",")))
    rows = truth.select("matched_entity_ids", n.alias("n"))
    some = F.when(F.col("n") > 0, F.col("n"))
    ids = rows.where(F.col("n") > 0).select(F.explode(F.split("matched_entity_ids", ",")).alias("id")).agg(F.count("*").alias("ids"), F.countDistinct("id").alias("distinct_ids"), F.count_if(F.col("id").startswith("S2-")).alias("used_s2"))
    return rows.agg(F.count("*").alias("entities"), F.count_if(F.col("n") == 0).alias("singletons"), F.round(F.avg(some), 6).alias("mean"), F.median(some).alias("median"), F.max(some).alias("max"), F.round(F.avg((F.col("n") == 0).cast("int")), 6).alias("empty_f")).join(ids)


def truth_sizes(truth: DataFrame, most: int = 12) -> DataFrame:
    """n, entities: how many entities have n matches, for the first sizes."""
    n = F.size(F.split("matched_entity_ids", ","))
    return truth.where(F.col("matched_entity_ids") != "").groupBy(n.alias("n")).agg(F.count("*").alias("entities")).orderBy("n").limit(most)


def country_consistency(truth: DataFrame, records: DataFrame) -> DataFrame:
    """s1_country, cand_country, n of true pairs (s1_id, cand_id)."""
    a = records.select(F.col("entity_id").alias("s1_id"), F.col("country").alias("s1_country"))
    b = records.select(F.col("entity_id").alias("cand_id"), F.col("country").alias("cand_country"))
    return truth.select("s1_id", "cand_id").join(a, "s1_id").join(b, "cand_id").groupBy("s1_country", "cand_country").agg(F.count("*").alias("n"))


def output_calibration(lists: DataFrame) -> DataFrame:
    """country: entities, singleton rate, matches, from lists (country, s1_id, ids)."""
    n = F.when(F.col("ids") == "", 0).otherwise(F.size(F.split("ids", ",")))
    return lists.withColumn("n", n).groupBy("country").agg(F.count("*").alias("entities"), F.round(F.avg((F.col("n") == 0).cast("int")), 6).alias("singleton_rate"), F.round(F.avg(F.when(F.col("n") > 0, F.col("n"))), 6).alias("per_nonsingleton"), F.round(F.avg("n"), 6).alias("per_entity"))


def assigned_share(records: DataFrame, pairs: DataFrame) -> DataFrame:
    """source, country, records, share_assigned of the noisy records."""
    used = pairs.select(F.col("cand_id").alias("entity_id")).distinct().withColumn("__used", F.lit(1))
    return records.where(F.col("source") > 1).join(used, "entity_id", "left").groupBy("source", "country").agg(F.count("*").alias("records"), F.round(F.avg(F.coalesce("__used", F.lit(0))), 6).alias("share_assigned"))


def best_candidate(pairs: DataFrame) -> DataFrame:
    """Each record's best pair by block_score, ties to the smaller entity."""
    best = Window.partitionBy("country", "source", "cand_id").orderBy(F.desc("block_score"), "s1_id")
    return pairs.withColumn("__rn", F.row_number().over(best)).where(F.col("__rn") == 1).drop("__rn")


def pattern_counts(texts: DataFrame, column: str, patterns: dict[str, str]) -> DataFrame:
    """pattern, n: occurrences in the lower-case column."""
    low = F.lower(F.col(column))
    row = texts.agg(*[F.sum(F.regexp_count(low, F.lit(p))).cast("bigint").alias(k) for k, p in patterns.items()])
    return row.select(F.explode(F.array(*[F.struct(F.lit(k).alias("pattern"), F.coalesce(F.col(f"`{k}`"), F.lit(0)).alias("n")) for k in patterns])).alias("r")).select("r.*")
