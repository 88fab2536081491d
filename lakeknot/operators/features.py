"""Features of candidate pairs: set and string similarities, ranks among rivals, family evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..functions import similarity as S

#: The features of the first stage in the order in which models take them ...
STAGE1 = """
block_score pass_id source name_inter name_jac name_cont name_n1 name_n2 addr_inter addr_jac addr_cont addr_n1 addr_n2
num_inter num_jac postal_cmp fuzz_name_set fuzz_name_core fuzz_addr_sort cand_indic cand_nonascii cand_url cand_addr_empty
name_len1 name_len2 n_cand rank_addr rank_name rank_total addr_gap_best name_gap_best total_gap_best
rev_n rev_rank rev_gap_best rev_gap_addr rev_gap_name rev_margin_2nd
name_tri_cos name_idf_share addr_idf_share skel_ratio nospace_ratio acronym_match house_eq
""".split()
#: ... and of the second.
STAGE2 = """
fam_size fam_addr_share fam_name_share fam_addr_idf fam_is_member fam_score_max fam_score_mean fam_score_gap own_rev_margin
novel_s1_tok novel_cand_tok one_word_swap novel_edit_sim novel_is_common house_norm_eq house_num_diff house_trunc
house_fam_match_s1 house_fam_majority house_fam_share novel_fam_decoy
""".split()
#: Stage-1 score from which a candidate backs its entity.
CONFIDENT = 0.80
SIDE = ["name_norm", "name_core", "addr_tok", "addr_nums", "postal", "first_num", "name_flags"]


def gather(pairs: DataFrame, clean: DataFrame, noisy: DataFrame) -> DataFrame:
    """Pairs with both records' columns, the clean one's as a_..., the noisy one's as b_..."""
    a = clean.select("country", F.col("entity_id").alias("s1_id"), *[F.col(c).alias(f"a_{c}") for c in SIDE])
    b = noisy.select("country", F.col("entity_id").alias("cand_id"), *[F.col(c).alias(f"b_{c}") for c in SIDE])
    return pairs.join(a, ["country", "s1_id"]).join(b, ["country", "cand_id"])


def set_features() -> dict[str, Column]:
    out = {}
    for short, col, some in (("name", "name_core", "inter jac cont n1 n2"), ("addr", "addr_tok", "inter jac cont n1 n2"), ("num", "addr_nums", "inter jac")):
        made = S.overlap(F.col(f"a_{col}"), F.col(f"b_{col}"))
        out |= {f"{short}_{k}": made[k] for k in some.split()}
    flag = lambda n: F.shiftright(F.col("b_name_flags").cast("int"), n).bitwiseAND(1)
    a, b = N.acronym(F.col("a_name_core")), N.acronym(F.col("b_name_core"))
    x, y = N.nospace(F.col("a_name_norm")), N.nospace(F.col("b_name_norm"))
    out |= {
        "postal_cmp": S.three_way(F.col("a_postal"), F.col("b_postal")),
        "cand_indic": flag(0),
        "cand_nonascii": flag(1),
        "cand_url": flag(2),
        "cand_addr_empty": (F.size("b_addr_tok") == 0).cast("int"),
        "name_len1": F.length("a_name_norm"),
        "name_len2": F.length("b_name_norm"),
        "name_tri_cos": F.round(S.cosine(N.char_ngrams(F.col("a_name_norm")), N.char_ngrams(F.col("b_name_norm"))), 6),
        "acronym_match": F.when((a != "") & (a == b), 2).when(((a != "") & (a == y)) | ((b != "") & (b == x)), 1).otherwise(0),
        "house_eq": S.three_way(F.col("a_first_num"), F.col("b_first_num")),
    }
    return out


def fuzzy_features(gathered: DataFrame) -> DataFrame:
    words = lambda c: F.array_join(c, " ")
    args = [f(F.col(f"{side}_{c}")) for c, f in (("name_norm", lambda c: c), ("name_core", words), ("addr_tok", words), ("name_core", N.skeletons), ("name_norm", N.nospace)) for side in "ab"]
    return gathered.withColumn("__f", S.fuzzy_udf()(*args)).select("*", "__f.*").drop("__f")


def idf_table(clean: DataFrame, field: str) -> DataFrame:
    """country, token, idf over the clean source: ln((records + 1) / (records with the token + 1))."""
    n = clean.groupBy("country").agg(F.count("*").alias("n"))
    df = clean.select("country", F.explode(field).alias("token")).groupBy("country", "token").agg(F.count("*").alias("df"))
    return df.join(n, "country").select("country", "token", "df", F.log((F.col("n") + 1) / (F.col("df") + 1)).alias("idf"))


def weighted(clean: DataFrame, field: str, total: str) -> DataFrame:
    """country, s1_id, total: the weight of all tokens of a clean record; map: token -> weight."""
    one = clean.select("country", F.col("entity_id").alias("s1_id"), F.explode(field).alias("token")).join(idf_table(clean, field), ["country", "token"])
    return one.groupBy("country", "s1_id").agg(F.sum("idf").alias(total), F.map_from_entries(F.collect_list(F.struct("token", "idf"))).alias(f"{total}_of"))


def idf_share(gathered: DataFrame, clean: DataFrame) -> DataFrame:
    """name_idf_share, addr_idf_share: the shared part of the clean record's weight."""
    for field, out in (("name_core", "name_idf_share"), ("addr_tok", "addr_idf_share")):
        gathered = gathered.join(weighted(clean, field, "__w"), ["country", "s1_id"], "left")
        both = F.array_intersect(f"a_{field}", f"b_{field}")
        shared = F.aggregate(both, F.lit(0.0), lambda acc, t: acc + F.coalesce(F.col("__w_of")[t], F.lit(0.0)))
        gathered = gathered.withColumn(out, F.round(shared / F.greatest(F.coalesce("__w", F.lit(0.0)), F.lit(1e-6)), 6)).drop("__w", "__w_of")
    return gathered


def rank_features(pairs: DataFrame) -> DataFrame:
    """How a pair ranks among the entity's candidates of its source, and among the record's entities."""
    pairs = pairs.withColumn("__total", F.round(F.col("addr_jac") + F.col("name_jac"), 9))
    own, rec = Window.partitionBy("country", "source", "s1_id"), Window.partitionBy("country", "source", "cand_id")
    out = {"n_cand": F.count("*").over(own)}
    for name, col in (("addr", "addr_jac"), ("name", "name_jac"), ("total", "__total")):
        out |= {f"rank_{name}": F.rank().over(own.orderBy(F.desc(col))), f"{name}_gap_best": F.round(F.col(col) - F.max(col).over(own), 6)}
    first = rec.orderBy(F.desc("__total"), "s1_id")
    margin = F.when(F.row_number().over(first) == 1, F.coalesce(F.col("__total") - F.lead("__total").over(first), F.lit(0.0))).otherwise(0.0)
    out |= {
        "rev_n": F.count("*").over(rec),
        "rev_rank": F.rank().over(rec.orderBy(F.desc("__total"))),
        "rev_gap_best": F.round(F.col("__total") - F.max("__total").over(rec), 6),
        "rev_gap_addr": F.round(F.col("addr_jac") - F.max("addr_jac").over(rec), 6),
        "rev_gap_name": F.round(F.col("name_jac") - F.max("name_jac").over(rec), 6),
        "rev_margin_2nd": F.round(margin, 6),
    }
    return pairs.withColumns(out).drop("__total")


def stage1(pairs: DataFrame, clean: DataFrame, noisy: DataFrame, fuzzy: bool = True) -> DataFrame:
    """pairs (country, source, s1_id, cand_id, block_score, pass_id) with all features of the first stage and both records."""
    out = gather(pairs, clean, noisy).withColumns(set_features())
    out = rank_features(idf_share(out, clean))
    return fuzzy_features(out) if fuzzy else out


def name_diff(pairs: DataFrame, clean: DataFrame, edit: bool = True) -> DataFrame:
    """novel_*: words that only one side has; one word swapped for another."""
    s1, cand = F.greatest(F.col("name_n1") - F.col("name_inter"), F.lit(0)), F.greatest(F.col("name_n2") - F.col("name_inter"), F.lit(0))
    out = pairs.withColumns({"novel_s1_tok": s1, "novel_cand_tok": cand})
    out = out.withColumn("one_word_swap", ((F.col("novel_s1_tok") == 1) & (F.col("novel_cand_tok") == 1) & (F.col("name_inter") >= 1)).cast("int"))
    word = lambda a, b: F.when(F.col("one_word_swap") == 1, F.try_element_at(F.array_except(a, b), F.lit(1)))
    out = out.withColumns({"__a": word("a_name_core", "b_name_core"), "__b": word("b_name_core", "a_name_core")})
    common = idf_table(clean, "name_core").where(F.col("df") >= 5).select("country", F.col("token").alias("__b"), F.lit(1).alias("__common"))
    out = out.join(common, ["country", "__b"], "left").withColumn("novel_is_common", F.coalesce("__common", F.lit(0)))
    again = F.count("*").over(Window.partitionBy("country", "source", "s1_id", "__b"))
    out = out.withColumn("novel_fam_decoy", F.when(F.col("__b").isNotNull() & (again >= 2), 1).otherwise(0))
    if edit:
        out = out.withColumn("novel_edit_sim", F.when(F.col("one_word_swap") == 1, S.ratio_udf()("__a", "__b")).otherwise(0.0))
    return out.drop("__a", "__b", "__common")


def house_features(pairs: DataFrame) -> DataFrame:
    """house_*: house numbers of both records and of the entity's other candidates."""
    h = {f"__{k}{s}": f(F.col(f"{s}_first_num")) for s in "ab" for k, f in (("n", N.house_number), ("d", N.house_digits))}
    out = pairs.withColumns(h)
    both, own = (F.col("__na") >= 0) & (F.col("__nb") >= 0), Window.partitionBy("country", "source", "s1_id")
    equal = F.when(both & (F.col("__na") == F.col("__nb")), 1).otherwise(0)
    others = F.greatest(F.count("*").over(own) - 1, F.lit(1))
    same = F.when(F.col("__nb") >= 0, F.count("*").over(Window.partitionBy("country", "source", "s1_id", "__nb"))).otherwise(1)
    out = out.withColumns({"__eq": equal, "__others": others, "__same": same})
    return out.withColumns({
        "house_norm_eq": F.when(both, F.col("__eq")).otherwise(-1),
        "house_num_diff": F.when(both, F.abs(F.col("__na") - F.col("__nb"))).otherwise(-1),
        "house_trunc": F.when(both & (F.col("__da") != F.col("__db")) & (F.col("__da").contains(F.col("__db")) | F.col("__db").contains(F.col("__da"))), 1).otherwise(0),
        "house_fam_match_s1": F.round(F.when(F.col("__na") >= 0, (F.sum("__eq").over(own) - F.col("__eq")) / F.col("__others")).otherwise(0.0), 6),
        "house_fam_majority": F.when((F.col("__nb") >= 0) & (F.col("__same") == F.max("__same").over(own)), 1).otherwise(0),
        "house_fam_share": F.round(F.when(F.col("__nb") >= 0, (F.col("__same") - 1) / F.col("__others")).otherwise(0.0), 6),
    }).drop("__na", "__nb", "__da", "__db", "__eq", "__others", "__same")


def family_scores(pairs: DataFrame, conf: float = CONFIDENT) -> DataFrame:
    """fam_size, fam_is_member and the entity's scores."""
    own = Window.partitionBy("country", "source", "s1_id")
    member = (F.col("score1") >= conf).cast("int")
    return pairs.withColumns({
        "fam_is_member": member,
        "fam_size": F.sum(member).over(own),
        "fam_score_max": F.max("score1").over(own),
        "fam_score_mean": F.avg("score1").over(own),
        "fam_score_gap": F.round(F.col("score1") - F.max("score1").over(own), 6),
        "own_rev_margin": F.col("rev_margin_2nd"),
    })


def family_tokens(pairs: DataFrame, clean: DataFrame) -> DataFrame:
    """fam_addr_share, fam_name_share, fam_addr_idf: a candidate against the pooled words of its confident siblings.

    Shares leave out the candidate's own words; the weighted share does not."""
    key = ["country", "source", "s1_id"]
    out = pairs
    for field, share, idf in (("addr_tok", "fam_addr_share", "fam_addr_idf"), ("name_core", "fam_name_share", None)):
        words = pairs.select(*key, "cand_id", "fam_is_member", F.explode(f"b_{field}").alias("token"))
        pool = words.where(F.col("fam_is_member") == 1).groupBy(*key, "token").agg(F.count("*").alias("cnt"))
        joined = words.join(pool, [*key, "token"], "left").withColumn("cnt", F.coalesce("cnt", F.lit(0)))
        sums = [F.sum("cnt").alias("__sum")]
        if idf:
            # words that the clean source lacks weigh as if in none of its records
            n = clean.groupBy("country").agg(F.count("*").alias("n"))
            joined = joined.join(idf_table(clean, field).select("country", "token", "idf"), ["country", "token"], "left").join(n, "country").withColumn("idf", F.coalesce("idf", F.log(F.col("n") + 1.0)))
            sums += [F.sum(F.col("cnt") * F.col("idf")).alias("__wsum"), F.sum("idf").alias("__w")]
        out = out.join(joined.groupBy(*key, "cand_id").agg(*sums), [*key, "cand_id"], "left")
        size = F.size(f"b_{field}")
        rest = F.coalesce("__sum", F.lit(0)) - F.when(F.col("fam_is_member") == 1, size).otherwise(0)
        made = {share: F.round(rest / (F.greatest(size, F.lit(1)) * F.greatest(F.col("fam_size") - F.col("fam_is_member"), F.lit(1))), 6)}
        if idf:
            made[idf] = F.round(F.coalesce("__wsum", F.lit(0.0)) / F.greatest(F.coalesce("__w", F.lit(0.0)), F.lit(1e-6)), 6)
        out = out.withColumns(made).drop("__sum", "__wsum", "__w")
    return out


def stage2(pairs: DataFrame, clean: DataFrame, conf: float = CONFIDENT, edit: bool = True) -> DataFrame:
    """stage1's pairs with score1 to all features of the second stage."""
    return family_tokens(family_scores(house_features(name_diff(pairs, clean, edit)), conf), clean)
