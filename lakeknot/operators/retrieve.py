"""Candidate retrieval: a weighted token join with a document-frequency cap and a top-k for each query.

The index side is the clean source, the query side a noisy one; both never leave their country. A token's weight is
ln(documents / documents with it); a score is the sum over shared tokens divided by the root of the index record's
indexed tokens. Scores are ranked rounded to six digits and ties go to the smaller id, so results don't depend on the
order of sums. A token that all documents hold weighs nothing: it opens candidates only for a query without any other.

The join is made block by block in numpy (`topk`), with the tokens of a country sent to its parts. Where these are too many to
be sent, it is bounded in two rounds of joins, exactly. In the first each query opens its rarest tokens, as many as fit a budget of
postings (one at least); documents that could still reach the kth score are completed with the query's other tokens.
If no unseen document can reach the kth score, by the weight of the tokens left over the norm that this many tokens ask
for, the query is done. In the second round the others open just the tokens that it takes to say so (all, where fewer
than k documents were found). Joins are equi-joins on (country, token); the top-k is a window with a literal bound, which
Spark prunes before its shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..sources.catalog import numbered, scratch
from . import topk
from .topk import SLACK

#: Postings that a query opens in the first round of joins.
BUDGET = 128


@dataclass(frozen=True)
class Reverse:
    """Noisy records query the clean ones."""

    maxdf: int = 60_000
    rarest: int = 28
    k: int = 3
    k_short: int = 18
    short_tokens: int = 2
    length_norm: bool = True


@dataclass(frozen=True)
class Forward:
    """Clean records query the noisy ones, by address, name and address prefixes."""

    maxdf_addr: int = 5_000
    maxdf_name: int = 20_000
    maxdf_prefix: int = 5_000
    rarest: int = 24
    k_addr: int = 24
    k_name: int = 12
    k_prefix: int = 12
    prefix_len: int = 4


def typed_signature(records: DataFrame, rich: bool = False) -> DataFrame:
    """records with sig: distinct tokens a:address, n:name, s:name skeleton; rich adds p:address prefix, b:address skeleton."""
    tag = lambda words, kind: F.transform(words, lambda t: F.concat(F.lit(kind), t))

    def bones(words: str, kind: str):
        # skeletons of over two letters that differ from their word
        pairs = F.transform(words, lambda t: F.struct(t.alias("t"), N.skeleton(t).alias("s")))
        return F.transform(F.filter(pairs, lambda p: (F.length(p["s"]) > 2) & (p["s"] != p["t"])), lambda p: F.concat(F.lit(kind), p["s"]))

    parts = [tag(F.col("addr_tok"), "a:"), tag(F.col("name_core"), "n:"), bones("name_core", "s:")]
    if rich:
        parts += [tag(F.transform(F.filter("addr_tok", lambda t: F.length(t) > 4), lambda t: F.substring(t, 1, 4)), "p:"), bones("addr_tok", "b:")]
    return records.withColumn("sig", F.array_distinct(F.concat(*parts)))


def postings(docs: DataFrame) -> DataFrame:
    """docs (country, id, sig) to a row for each token."""
    return docs.select("country", "id", F.explode("sig").alias("token"))


def doc_freq(docs: DataFrame, maxdf: int | None = None) -> DataFrame:
    """country, token, df, idf of the tokens in at most maxdf documents; all documents count, those without tokens too."""
    n = docs.groupBy("country").agg(F.count("*").alias("n_doc"))
    df = postings(docs).groupBy("country", "token").agg(F.count("*").alias("df"))
    if maxdf is not None:
        df = df.where(F.col("df") <= maxdf)
    return df.join(F.broadcast(n), "country").select("country", "token", "df", F.log(F.col("n_doc") / F.col("df")).alias("idf"))


def indexed(docs: DataFrame, maxdf: int) -> DataFrame:
    """country, token, id, df, idf: the postings of capped tokens."""
    return postings(docs).join(doc_freq(docs, maxdf), ["country", "token"])


def length_norm(index: DataFrame) -> DataFrame:
    """id, norm: the root of a document's indexed tokens."""
    return index.groupBy("country", "id").agg(F.sqrt(F.greatest(F.count("*"), F.lit(1)).cast("double")).alias("norm"))


def rarest(queries: DataFrame, frequencies: DataFrame, r: int) -> DataFrame:
    """country, query, token, df, idf, rn: the r rarest indexed tokens of each query, ties to the smaller token; without weight only the first."""
    rank = Window.partitionBy("country", "query").orderBy("df", "token")
    found = postings(queries).withColumnRenamed("id", "query").join(frequencies, ["country", "token"])
    return found.withColumn("rn", F.row_number().over(rank)).where((F.col("rn") <= r) & ((F.col("idf") > 0) | (F.col("rn") == 1)))


def token_join(queries: DataFrame, docs: DataFrame, maxdf: int, r: int, norm: bool = True) -> DataFrame:
    """country, query, id, score of every pair that shares one of the query's r rarest tokens: what `search` finds the best of without making all."""
    index = indexed(docs, maxdf)
    asked = rarest(queries, doc_freq(docs, maxdf), r).select("country", "query", "token")
    score = asked.join(index, ["country", "token"]).groupBy("country", "query", "id").agg(F.sum("idf").alias("score"))
    if norm:
        score = score.join(length_norm(index), ["country", "id"]).withColumn("score", F.col("score") / F.col("norm"))
    return score.select("country", "query", "id", F.round("score", 6).alias("score"))


def search(queries: DataFrame, docs: DataFrame, maxdf: int, r: int, k: int, norm: bool = True) -> DataFrame:
    """country, query, id, score, rn: the k best of `token_join` for each query; a column k of queries may ask for fewer."""
    frequencies = scratch(doc_freq(docs, maxdf), "frequencies")
    most = frequencies.groupBy("country").count().agg(F.max("count")).first()[0] or 0
    if most > topk.VOCABULARY_MOST:
        return _search_by_joins(queries, docs, maxdf, r, k, norm)
    depth = F.least("k", F.lit(k)) if "k" in queries.columns else F.lit(k)
    found, several = topk.best(queries.withColumn("k", depth.cast("int")), docs, frequencies, r, k, norm)
    if several:
        found = top_k(found, k).where(F.col("rn") <= F.col("k"))
    return found.drop("k")


def _search_by_joins(queries: DataFrame, docs: DataFrame, maxdf: int, r: int, k: int, norm: bool = True, budget: int = BUDGET) -> DataFrame:
    """`search` where a country's tokens are too many to be sent."""
    key = ["country", "query"]
    index = scratch(indexed(docs, maxdf), "index")
    norms = length_norm(index) if norm else index.select("country", "id").distinct().withColumn("norm", F.lit(1.0))
    norms = scratch(norms, "norms")
    least = norms.groupBy("country").agg(F.min("norm").alias("least"))
    tokens = index.groupBy("country", "token").agg(F.first("df").alias("df"), F.first("idf").alias("idf"))
    so_far = Window.partitionBy(*key).orderBy("rn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    asked = rarest(queries, tokens, r).withColumns({"opens": F.sum("df").over(so_far), "above": F.sum("idf").over(so_far)})
    depth = queries.select("country", F.col("id").alias("query"), (F.least("k", F.lit(k)) if "k" in queries.columns else F.lit(k)).alias("k"))
    asked = scratch(asked.join(depth, key).select(*key, "token", "idf", "rn", "opens", "above", "k"), "asked")

    first = asked.where((F.col("rn") == 1) | (F.col("opens") <= budget))
    found = scratch(_completed(first, asked, index, norms, k), "found")
    # per query: weights from its rarest token on, how many are open, and the kth score so far
    sums = asked.join(least, "country").groupBy(*key).agg(F.array_sort(F.collect_list("above")).alias("sums"), F.first("least").alias("least"))
    state = sums.join(first.groupBy(*key).agg(F.max("rn").alias("p")), key).join(found.where(F.col("rn") == F.col("k")).select(*key, F.col("score").alias("end")), key, "left")
    # an unseen document holds tokens of the rest alone, and at least as many indexed tokens as it shares
    beyond = "aggregate(sequence({p} + 1, size(sums)), 0D, (m, i) -> greatest(m, (sums[i - 1] - sums[{p} - 1]) / greatest(least, sqrt(CAST(i - {p} AS DOUBLE)))))"
    enough = f"coalesce(end - {SLACK}, 0D) > CASE WHEN {{p}} < size(sums) THEN {beyond} ELSE -1D END"
    state = state.withColumn("need", F.expr(f"CASE WHEN p = size(sums) OR {enough.format(p='p')} THEN 0 ELSE coalesce(filter(sequence(p, size(sums)), q -> {enough.format(p='q')})[0], size(sums)) END"))
    state = scratch(state.select(*key, "need"), "state")
    left = asked.join(state.where(F.col("need") > 0), key)
    more = scratch(_completed(left.where(F.col("rn") <= F.col("need")).drop("need"), left.drop("need"), index, norms, k), "found")
    return found.join(state.where(F.col("need") == 0).select(*key), key, "left_semi").unionByName(more).drop("k")


def _completed(opened: DataFrame, asked: DataFrame, index: DataFrame, norms: DataFrame, k: int) -> DataFrame:
    """country, query, id, score, rn, k: the k best documents that the opened tokens lead to, by all tokens asked."""
    key = ["country", "query"]
    partial = opened.join(index.select("country", "token", "id"), ["country", "token"]).groupBy(*key, "id").agg(F.sum("idf").alias("s")).join(norms, ["country", "id"])
    at = opened.groupBy(*key).agg(F.max("rn").alias("p"), F.max("above").alias("seen"), F.first("k").alias("k"))
    gain = asked.groupBy(*key).agg(F.max("above").alias("all")).join(at, key).select(*key, "k", (F.col("all") - F.col("seen")).alias("gain"))
    partial = scratch(partial.join(gain, key), "partial")
    # a lower bound on the kth score: the kth of what the opened tokens alone give
    kth = _kth(partial.select(*key, "id", "k", (F.col("s") / F.col("norm")).alias("score")), k)
    able = partial.join(kth, key, "left").where(F.col("kth").isNull() | ((F.col("s") + F.col("gain")) / F.col("norm") >= F.col("kth") - SLACK)).select(*key, "id", "s", "norm", "k")
    rest = asked.join(at.select(*key, "p"), key).where(F.col("rn") > F.col("p")).select(*key, "token", "idf")
    more = able.select(*key, "id").join(rest, key).join(index.select("country", "token", "id"), ["country", "token", "id"]).groupBy(*key, "id").agg(F.sum("idf").alias("m"))
    scored = able.join(more, [*key, "id"], "left").select(*key, "id", "k", F.round((F.col("s") + F.coalesce("m", F.lit(0.0))) / F.col("norm"), 6).alias("score"))
    return top_k(scored, k).where(F.col("rn") <= F.col("k"))


def _kth(scored: DataFrame, k: int) -> DataFrame:
    """country, query, kth: the kth score of queries that have as many."""
    return top_k(scored, k).where(F.col("rn") == F.col("k")).select("country", "query", F.col("score").alias("kth"))


def top_k(scored: DataFrame, k: int, limit=None) -> DataFrame:
    """The k best of each query (fewer where the column limit says so), with rank rn."""
    best = Window.partitionBy("country", "query").orderBy(F.desc("score"), "id")
    out = scored.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k)
    return out if limit is None else out.where(F.col("rn") <= limit)


def _docs(records: DataFrame, sig) -> DataFrame:
    return records.select("country", F.col("entity_id").alias("id"), sig.alias("sig"))


def reverse(clean: DataFrame, noisy: DataFrame, params: Reverse = Reverse(), rich: bool = False) -> DataFrame:
    """country, source, s1_id, cand_id, block_score, rn: the best clean records of each noisy one.

    Records with at most short_tokens address tokens get k_short, all others k."""
    docs = _docs(typed_signature(clean, rich), F.col("sig"))
    depth = F.when(F.size("addr_tok") <= params.short_tokens, params.k_short).otherwise(params.k)
    asked = typed_signature(noisy, rich).select("country", F.col("entity_id").alias("id"), "sig", depth.alias("k"))
    best = search(asked, docs, params.maxdf, params.rarest, max(params.k, params.k_short), params.length_norm)
    of = noisy.select("country", F.col("entity_id").alias("query"), "source")
    return best.join(of, ["country", "query"]).select("country", "source", F.col("id").alias("s1_id"), F.col("query").alias("cand_id"), F.col("score").alias("block_score"), "rn")


def passes(noisy: DataFrame, params: Forward = Forward()) -> list[tuple[int, DataFrame, Column, int, int]]:
    """(pass_id, index side, tokens, cap, depth) of the forward passes: address, name, address prefixes; a depth of 0 leaves one out."""
    with_addr = noisy.where(F.size("addr_tok") > 0)
    prefix = N.prefixes(F.col("addr_tok"), params.prefix_len)
    made = [(1, with_addr, F.col("addr_tok"), params.maxdf_addr, params.k_addr), (2, noisy, F.col("name_core"), params.maxdf_name, params.k_name), (3, with_addr, prefix, params.maxdf_prefix, params.k_prefix)]
    return [p for p in made if p[-1]]


def forward_pass(clean: DataFrame, side: DataFrame, sig: Column, maxdf: int, rarest: int, k: int) -> DataFrame:
    """country, s1_id, cand_id, block_score: the best noisy records of each clean one by one kind of token."""
    best = search(_docs(clean, sig), _docs(side, sig), maxdf, rarest, k)
    return best.select("country", F.col("query").alias("s1_id"), F.col("id").alias("cand_id"), F.col("score").alias("block_score"))


def forward(clean: DataFrame, noisy: DataFrame, params: Forward = Forward()) -> DataFrame:
    """country, source, s1_id, cand_id, block_score, pass_id: three passes in one, the best score of a pair, ties to the lower pass."""
    return united([forward_pass(clean, side, sig, maxdf, params.rarest, k).withColumn("pass_id", F.lit(n)) for n, side, sig, maxdf, k in passes(noisy, params)], noisy)


def united(found: list[DataFrame], noisy: DataFrame) -> DataFrame:
    """One row for each pair of several passes (country, s1_id, cand_id, block_score, pass_id), with its source."""
    union = found[0]
    for x in found[1:]:
        union = union.unionByName(x)
    return dedup_best(union).join(noisy.select(F.col("entity_id").alias("cand_id"), "source"), "cand_id")


def dedup_best(pairs: DataFrame) -> DataFrame:
    """One row for each pair: the highest score, ties to the lowest pass."""
    best = F.max(F.struct("block_score", (-F.col("pass_id")).alias("p")))
    return pairs.groupBy("country", "s1_id", "cand_id").agg(best.alias("b")).select("country", "s1_id", "cand_id", F.col("b.block_score"), (-F.col("b.p")).alias("pass_id"))


def query_fraction(records: DataFrame, step: int) -> DataFrame:
    """Every step-th record of a country, in order of ids."""
    rows = numbered(records, "country", "entity_id")
    first = rows.groupBy("country").agg(F.min("__row").alias("__first"))
    return rows.join(first, "country").where((F.col("__row") - F.col("__first")) % step == 0).drop("__row", "__first")


def keep_entities(pairs: DataFrame, kept: DataFrame) -> DataFrame:
    """Pairs of the kept clean records (s1_id); to be applied after the top-k."""
    return pairs.join(kept.select("s1_id"), "s1_id", "left_semi")
