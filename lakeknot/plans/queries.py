"""One query for each operator, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..functions import similarity as S
from ..functions import vocab
from ..operators import decide, diagnose, features, metrics, model, retrieve
from ..sources import catalog as C
from . import fixtures as X
from . import link
from . import oracle as O

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLES[name or f.__name__] = sql
        return f

    return add


_tables: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame], *by: str) -> DataFrame:
    """The tables that a project keeps between its steps, made once a session and input."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _tables:
        path = C.work_folder(spark, name)
        C.write_partitioned(make(), path, *by)
        _tables[key] = path
    return spark.read.parquet(_tables[key])


def norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "norm", lambda: N.normalized(X.registry(spark, sf_dir)), "source", "country")


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    n = norm(spark, sf_dir)
    return n.where(F.col("source") == 1), n.where(F.col("source") > 1)


def candidates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    clean, noisy = sides(spark, sf_dir)
    return clean, noisy, stored(spark, sf_dir, "candidates", lambda: retrieve.reverse(clean, noisy), "country", "source")


def pairs(spark: SparkSession, sf_dir: str, fuzzy: bool = False) -> DataFrame:
    clean, noisy, found = candidates(spark, sf_dir)
    return features.stage1(found.drop("rn").withColumn("pass_id", F.lit(1)), clean, noisy, fuzzy)


def owned(found: DataFrame, noisy: DataFrame) -> DataFrame:
    """Candidate pairs with y, and all true pairs."""
    truth = noisy.select("country", "source", F.col("owner").alias("s1_id"), F.col("entity_id").alias("cand_id"))
    return metrics.labelled(found, truth), truth


def joined(c) -> F.Column:
    return F.array_join(F.array_sort(c), " ")


# sources and sinks ----------------------------------------------------------------------------------------------


def _raw(spark, sf_dir):
    return X.registry(spark, sf_dir).where(F.col("source") == 1).select("entity_id", F.translate("business_name", "\n\t", "  ").alias("business_name"), F.translate("business_address", "\n\t", "  ").alias("business_address"), "country")


RAW = O.select(O.REG, "SELECT entity_id, translate(business_name, chr(10) || chr(9), '  ') AS business_name, translate(business_address, chr(10) || chr(9), '  ') AS business_address, country FROM reg WHERE source = 1")


@query(RAW)
def a1_scan_tsv(spark, sf_dir):
    path = C.work_folder(spark, "tsv")
    C.write_tsv(_raw(spark, sf_dir), path)
    return C.scan_tsv(spark, path)


@query(RAW)
def a3_tsv_to_parquet(spark, sf_dir):
    c = C.Catalog(C.work_folder(spark, "project"))
    C.write_tsv(_raw(spark, sf_dir), c.source_tsv("train", 1))
    C.tsv_to_parquet(spark, c.source_tsv("train", 1), c.source("train", 1))
    return C.read_source(spark, c, "train", 1)


@query(O.select(O.REG, "SELECT entity_id, country FROM reg WHERE source = 1"))
def a4_read_source(spark, sf_dir):
    c = C.Catalog(C.work_folder(spark, "project"))
    C.write_tsv(_raw(spark, sf_dir), c.source_tsv("train", 1))
    return C.read_source(spark, c, "train", 1, ["entity_id", "country"])


@query(O.select(O.REG, "SELECT country, count(*) AS n FROM reg WHERE source = 1 GROUP BY country"))
def a6_countries(spark, sf_dir):
    return C.countries(X.registry(spark, sf_dir).where(F.col("source") == 1))


@query(O.select(O.REV, "SELECT country, CAST(source AS INT) AS source, s1_id, cand_id, block_score FROM rev"))
def a10_write_candidates(spark, sf_dir):
    path = C.work_folder(spark, "candidates")
    out = C.cached(spark, path, lambda: candidates(spark, sf_dir)[2].drop("rn"), "country", "source")
    return C.load_pairs(spark, path) if out else out


@query(O.select(O.REV, "SELECT s1_id, cand_id, block_score FROM rev WHERE country = 'B' AND source = 3"))
def a7_load_pairs(spark, sf_dir):
    """One shard of the candidates: the only files that are read."""
    path = C.work_folder(spark, "candidates")
    C.write_partitioned(candidates(spark, sf_dir)[2].drop("rn"), path, "country", "source")
    return C.load_pairs(spark, path).where((F.col("country") == "B") & (F.col("source") == 3)).select("s1_id", "cand_id", "block_score")


@query(O.select(O.SCORED, "SELECT s1_id, cand_id, source, score, country FROM scored"))
def a11_scored_pair_cache(spark, sf_dir):
    path = C.work_folder(spark, "scored")
    return C.cached(spark, path, lambda: X.scored(spark, sf_dir).select("s1_id", "cand_id", "source", "score", "country"), "country").select("s1_id", "cand_id", "source", "score", "country")


LISTS = f"""{O.SCORED}, {O.ENTITIES},
kept AS (SELECT * FROM scored WHERE score >= 0.8),
excl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, cand_id ORDER BY score DESC, s1_id) AS rn FROM kept) WHERE rn = 1),
lists AS (SELECT e.s1_id, coalesce(string_agg(CAST(cand_id AS VARCHAR), ',' ORDER BY source, cand_id), '') AS ids FROM ents AS e LEFT JOIN excl USING (s1_id) GROUP BY e.s1_id)"""


def entities(spark, sf_dir):
    """s1_id, n_true of every customer."""
    n = X.scored(spark, sf_dir).groupBy("s1_id").agg(F.sum("y").alias("n"))
    return X.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("s1_id")).join(n, "s1_id", "left").select("s1_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_true"))


def kept(spark, sf_dir, threshold=0.8):
    return decide.exclusive(decide.rule(X.scored(spark, sf_dir), decide.Rule(threshold)))


@query(O.select(LISTS, "SELECT CAST(s1_id AS VARCHAR) AS s1_id, ids FROM lists"))
def a9_write_tsv_rows(spark, sf_dir):
    path = C.work_folder(spark, "lists")
    C.write_tsv(decide.entity_lists(entities(spark, sf_dir), kept(spark, sf_dir)), path)
    return C.scan_tsv(spark, path, C.StructType([C.StructField("s1_id", C.StringType()), C.StructField("ids", C.StringType())]))


def _checks(lists: str, table: str) -> str:
    m = f"(SELECT s1_id, unnest(string_split(ids, ',')) AS cand FROM {table} WHERE ids <> '')"
    return f"""
SELECT '{lists}' AS lists, 'missing entity' AS "check", count(*) AS bad FROM ents WHERE s1_id NOT IN (SELECT s1_id FROM {table})
UNION ALL SELECT '{lists}', 'repeated entity', count(*) FROM (SELECT s1_id FROM {table} GROUP BY s1_id HAVING count(*) > 1)
UNION ALL SELECT '{lists}', 'unknown entity', count(DISTINCT s1_id) FROM {table} WHERE s1_id NOT IN (SELECT s1_id FROM ents)
UNION ALL SELECT '{lists}', 'record of several entities', count(*) FROM (SELECT cand FROM {m} GROUP BY cand HAVING count(*) > 1)
UNION ALL SELECT '{lists}', 'match not a candidate', count(*) FROM {m} AS x WHERE NOT EXISTS (SELECT 1 FROM cands AS c WHERE c.s1_id = x.s1_id AND c.cand = x.cand)"""


BROKEN = "SELECT s1_id, ids FROM lists WHERE s1_id % 97 <> 5 UNION ALL SELECT s1_id, ids FROM lists WHERE s1_id % 89 = 3 UNION ALL SELECT -1, '1'"


@query(O.select(f"{LISTS}, cands AS (SELECT DISTINCT s1_id, CAST(cand_id AS VARCHAR) AS cand FROM scored), broken AS ({BROKEN})", _checks("right", "lists") + " UNION ALL " + _checks("broken", "broken")))
def a13_submission_checks(spark, sf_dir):
    """Checks of right lists, and of lists that lack, repeat and invent entities."""
    e = entities(spark, sf_dir)
    matched = decide.entity_lists(e, kept(spark, sf_dir), "matched")
    broken = matched.where(F.col("s1_id") % 97 != 5).unionByName(matched.where(F.col("s1_id") % 89 == 3)).unionByName(spark.createDataFrame([(-1, "1")], "s1_id long, matched string"))
    cands = decide.entity_lists(e, X.scored(spark, sf_dir), "candidates")
    check = lambda name, m: decide.list_checks(e.select("s1_id"), m, cands).withColumn("lists", F.lit(name))
    return check("right", matched).unionByName(check("broken", broken))


# text ------------------------------------------------------------------------------------------------------------

DOC = "SELECT doc_id, {} FROM documents"


@query(DOC.format(f"{O.fold('text')} AS folded"))
def b1_ascii_fold(spark, sf_dir):
    return X.table(spark, sf_dir, "documents").select("doc_id", N.ascii_fold(N.text("text")).alias("folded"))


@query(f"SELECT page_id, {O.norm_text('url')} AS norm FROM pages")
def b2_norm_text(spark, sf_dir):
    return X.table(spark, sf_dir, "pages").select("page_id", N.norm_text(N.text("url")).alias("norm"))


QUERIES["b3_strip_junk"] = lambda spark, sf_dir: X.registry(spark, sf_dir).select("entity_id", N.norm_text(F.col("business_name")).alias("norm"))
ORACLES["b3_strip_junk"] = O.select(O.REG, f"SELECT entity_id, {O.norm_text('business_name')} AS norm FROM reg")
LED = "CASE k % 5 WHEN 0 THEN '-- ' WHEN 1 THEN '@' WHEN 2 THEN 'Mr. ' WHEN 3 THEN 'the Shri ' ELSE '' END"


@query(f"WITH c AS (SELECT c_custkey AS k, c_name FROM customer) SELECT k, {O.strip_lead(LED + ' || c_name')} AS name FROM c")
def b4_strip_lead(spark, sf_dir):
    k = X.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_name")
    return k.select("k", N.strip_lead(F.concat(F.expr(LED), F.col("c_name"))).alias("name"))


@query(O.select(O.NORM, "SELECT entity_id, name_norm, name_flags, array_to_string(name_core, ' ') AS name_core FROM norm"))
def b6_name_fields(spark, sf_dir):
    return norm(spark, sf_dir).select("entity_id", "name_norm", "name_flags", F.array_join("name_core", " ").alias("name_core"))


@query(f"SELECT doc_id, {O.flags('text')} AS name_flags FROM documents")
def b5_name_flags(spark, sf_dir):
    return X.table(spark, sf_dir, "documents").select("doc_id", N.name_flags(N.text("text")).alias("name_flags"))


@query(O.select(O.NORM, "SELECT entity_id, array_to_string(addr_tok, ' ') AS addr_tok, array_to_string(addr_nums, ' ') AS addr_nums, postal, first_num FROM norm"))
def b7_addr_fields(spark, sf_dir):
    return norm(spark, sf_dir).select("entity_id", joined("addr_tok").alias("addr_tok"), joined("addr_nums").alias("addr_nums"), "postal", "first_num")


@query(f"SELECT doc_id, array_to_string({O.addr_tokens(O.norm_text('text'))}, ' ') AS addr_tok FROM documents")
def b7_addr_tok_documents(spark, sf_dir):
    docs = X.table(spark, sf_dir, "documents")
    return docs.select("doc_id", joined(N.addr_tokens(N.norm_text(F.col("text")))).alias("addr_tok"))


#: Words, and what the vocabularies make of them, written by hand: legal form, address stop word, street form, state code.
PROBES = """
inc 1 0 - -|llc 1 0 - -|sarl 1 0 - -|gmbh 1 0 - -|pvt 1 0 - -|ltd 1 0 - -|bakery 0 0 - -|selarl 1 0 - -|corporation 1 0 - -
street 0 0 st -|road 0 0 rd -|avenue 0 0 ave -|av 0 0 ave -|boulevard 0 0 blvd -|bd 0 0 blvd -|lane 0 0 ln -|rue 0 0 r -|chemin 0 0 ch -|impasse 0 0 imp -|square 0 0 sq -|highway 0 0 hwy -|terrace 0 0 ter -
null 0 1 - -|near 0 1 - -|suite 0 1 - -|apt 0 1 - -|floor 0 1 - -|district 0 1 - -|the 0 1 - -|du 0 1 - -|bis 0 1 - -|ter 0 1 ter -|door 0 1 - -
california 0 0 - ca|texas 0 0 - tx|maharashtra 0 0 - mh|bihaar 0 0 - br|odisha 0 0 - od|orissa 0 0 - od|delhi 0 0 - dl|alabama 0 0 - al|kerala 0 0 - kl|punjab 0 0 - pb|wyoming 0 0 - wy|telangana 0 0 - tg
"""
_rows = [x.split() for line in PROBES.strip().splitlines() for x in line.split("|")]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{w}', {'true' if a == '1' else 'false'}, {'true' if b == '1' else 'false'}, '{c if c != '-' else ''}', '{d if d != '-' else ''}')" for w, a, b, c, d in _rows) + ") AS v(word, legal, stop, street, state)")
def b10_vocabularies(spark, sf_dir):
    word = F.col("word")
    found = lambda t: F.coalesce(N.table(t)[word], F.lit(""))
    return spark.createDataFrame([(r[0],) for r in _rows], "word string").select("word", N.one_of(word, vocab.LEGAL).alias("legal"), N.one_of(word, vocab.ADDR_STOP).alias("stop"), found(vocab.STREET).alias("street"), found(vocab.STATE).alias("state"))


@query(O.select(O.NORM, f"SELECT entity_id, array_to_string(list_transform(name_core, lambda t: {O.skeleton('t')}), ' ') AS skel, array_to_string(list_sort(list_distinct(list_transform(addr_tok, lambda t: substr(t, 1, 4)))), ' ') AS prefixes, replace(name_norm, ' ', '') AS nospace, {O.acronym('name_core')} AS acronym, array_to_string(list_sort({O.grams('name_norm')}), '|') AS grams, name_norm || CASE WHEN addr_norm = '' THEN ' |' ELSE ' | ' || addr_norm END AS pair_text FROM norm"))
def b11_name_shapes(spark, sf_dir):
    """Skeletons, prefixes, joined letters, acronyms, character n-grams and the text of a pair's side."""
    return norm(spark, sf_dir).select(
        "entity_id", N.skeletons(F.col("name_core")).alias("skel"), joined(N.prefixes(F.col("addr_tok"))).alias("prefixes"), N.nospace(F.col("name_norm")).alias("nospace"), N.acronym(F.col("name_core")).alias("acronym"),
        F.array_join(F.array_sort(N.char_ngrams(F.col("name_norm"))), "|").alias("grams"), N.pair_text(F.col("name_norm"), F.col("addr_norm")).alias("pair_text"),
    )


@query(O.select(O.NORM, "SELECT entity_id, regexp_extract(first_num, '^0*([0-9]+)', 1) AS digits, coalesce(try_cast(regexp_extract(first_num, '^0*([0-9]+)', 1) AS BIGINT), -1) AS number FROM norm"))
def b17_house_norm(spark, sf_dir):
    return norm(spark, sf_dir).select("entity_id", N.house_digits(F.col("first_num")).alias("digits"), N.house_number(F.col("first_num")).alias("number"))


@query()
def b19_token_hash(spark, sf_dir):
    return norm(spark, sf_dir).select(F.explode("name_core").alias("token")).distinct().select("token", N.token_hash(F.col("token")).alias("hash"))


@query(O.select(O.NORM, "SELECT entity_id, source, country, name_norm, array_to_string(name_core, ' ') AS name_core, name_flags, array_to_string(addr_tok, ' ') AS addr_tok, array_to_string(addr_nums, ' ') AS addr_nums, postal FROM norm"))
def b21_prepare(spark, sf_dir):
    path = C.work_folder(spark, "norm")
    C.write_partitioned(N.normalized(X.registry(spark, sf_dir)), path, "source", "country")
    return spark.read.parquet(path).select("entity_id", "source", "country", "name_norm", F.array_join("name_core", " ").alias("name_core"), "name_flags", joined("addr_tok").alias("addr_tok"), joined("addr_nums").alias("addr_nums"), "postal")


# retrieval -------------------------------------------------------------------------------------------------------

for _rich in (False, True):

    @query(O.select(O.NORM, f"SELECT entity_id, array_to_string(list_sort({O.signature(_rich)}), ' ') AS sig FROM norm"), "c1_typed_signature" + "_rich" * _rich)
    def _signature(spark, sf_dir, _rich=_rich):
        return retrieve.typed_signature(norm(spark, sf_dir), _rich).select("entity_id", joined("sig").alias("sig"))


def _clean_docs(spark, sf_dir):
    clean, _ = sides(spark, sf_dir)
    return retrieve._docs(retrieve.typed_signature(clean), F.col("sig"))


CAP, RAREST = retrieve.Reverse().maxdf, retrieve.Reverse().rarest
IDX = f"{O.SIG},\n{O.token_join('rk', O.side('source = 1'), O.side('source > 1'), CAP, RAREST)}"


@query(O.select(IDX, "SELECT country, token, df, round(idf, 6) AS idf FROM rk_w"))
def c2_doc_freq_cap_idf(spark, sf_dir):
    return retrieve.doc_freq(_clean_docs(spark, sf_dir), CAP).withColumn("idf", F.round("idf", 6))


@query(O.select(IDX, "SELECT country, id, round(norm, 6) AS norm FROM rk_l"))
def c5_length_norm(spark, sf_dir):
    return retrieve.length_norm(retrieve.indexed(_clean_docs(spark, sf_dir), CAP)).withColumn("norm", F.round("norm", 6))


@query(O.select(IDX, "SELECT country, query, token FROM rk_r"))
def c6_rarest_r(spark, sf_dir):
    _, noisy = sides(spark, sf_dir)
    asked = retrieve._docs(retrieve.typed_signature(noisy), F.col("sig"))
    return retrieve.rarest(asked, retrieve.doc_freq(_clean_docs(spark, sf_dir), CAP), RAREST).select("country", "query", "token")


@query(O.select(IDX, "SELECT country, query, id, score, rn FROM rk WHERE rn <= 4"))
def c8_token_join_topk(spark, sf_dir):
    _, noisy = sides(spark, sf_dir)
    asked = retrieve._docs(retrieve.typed_signature(noisy), F.col("sig"))
    return retrieve.search(asked, _clean_docs(spark, sf_dir), CAP, RAREST, 4).select("country", "query", "id", "score", "rn")


@query(O.select(O.REV, "SELECT country, source, s1_id, cand_id, block_score, rn FROM rev"))
def c10_reverse_topk(spark, sf_dir):
    return retrieve.reverse(*sides(spark, sf_dir)).select("country", "source", "s1_id", "cand_id", "block_score", "rn")


FXDOC = f"""d AS (SELECT doc_id, lang, {O.norm_text('text')} AS t FROM documents),
sig AS (SELECT lang AS country, doc_id AS entity_id, list_distinct({O.tokens('t')}) AS sig FROM d)"""


@query(O.select(f"{FXDOC},\n{O.token_join('rk', O.side('entity_id % 5 = 0'), O.side('entity_id % 5 <> 0'), 60000, 28)}", "SELECT country, query, id, score, rn FROM rk WHERE rn <= 3"))
def c9_reverse_topk_documents(spark, sf_dir):
    """The nearest of every fifth document for all others, by their whole texts."""
    sig = F.array_distinct(N.tokens(N.norm_text(N.text("text"))))
    docs = stored(spark, sf_dir, "docsig", lambda: X.table(spark, sf_dir, "documents").select(F.col("lang").alias("country"), F.col("doc_id").alias("id"), sig.alias("sig")))
    return retrieve.search(docs.where(F.col("id") % 5 != 0), docs.where(F.col("id") % 5 == 0), CAP, RAREST, 3)


@query(O.select(O.REG, "SELECT entity_id FROM (SELECT entity_id, row_number() OVER (PARTITION BY country ORDER BY entity_id) - 1 AS n FROM reg WHERE source = 2) WHERE n % 4 = 0"))
def c11_query_fraction(spark, sf_dir):
    return retrieve.query_fraction(X.registry(spark, sf_dir).where(F.col("source") == 2), 4).select("entity_id")


@query(O.select(O.REV, f"SELECT s1_id, cand_id, block_score FROM rev WHERE {O.bucket('CAST(substr(s1_id, 4) AS BIGINT)')} < 38"))
def c12_keep_s1_filter(spark, sf_dir):
    clean, _, found = candidates(spark, sf_dir)
    key = F.substring("entity_id", 4, 20).cast("bigint")
    chosen = clean.where(metrics.sampled(key)).select(F.col("entity_id").alias("s1_id"))
    return retrieve.keep_entities(found, chosen).select("s1_id", "cand_id", "block_score")


def _pass(name: str, col: str, where: str, maxdf: int, k: int) -> tuple[str, str]:
    ctes = O.token_join(name, O.side(where, col), O.side("source = 1", col), maxdf, 24)
    return ctes, f"SELECT country, query AS s1_id, id AS cand_id, score AS block_score FROM {name} WHERE rn <= {k}"


PREFIX = "list_distinct(list_transform(addr_tok, lambda t: substr(t, 1, 4)))"
PASSES = [_pass("fa", "addr_tok", "source > 1 AND len(addr_tok) > 0", 5000, 24), _pass("fn", "name_core", "source > 1", 20000, 12), _pass("fp", PREFIX, "source > 1 AND len(addr_tok) > 0", 5000, 12)]
for _n, (_name, _sig, _addr, _maxdf, _k) in enumerate((("c14_forward_addr_pass", lambda: F.col("addr_tok"), True, 5000, 24), ("c15_forward_name_pass", lambda: F.col("name_core"), False, 20000, 12), ("c16_forward_prefix_pass", lambda: N.prefixes(F.col("addr_tok")), True, 5000, 12))):

    @query(O.select(f"{O.SIG},\n{PASSES[_n][0]}", PASSES[_n][1]), _name)
    def _forward(spark, sf_dir, sig=_sig, addr=_addr, maxdf=_maxdf, k=_k):
        clean, noisy = sides(spark, sf_dir)
        noisy = noisy.where(F.size("addr_tok") > 0) if addr else noisy
        return retrieve.forward_pass(clean, noisy, sig(), maxdf, 24, k)


UNION = " UNION ALL ".join(f"SELECT *, {n} AS pass_id FROM ({body})" for n, (_, body) in enumerate(PASSES, 1))
FORWARD = f"{O.SIG},\n" + ",\n".join(c for c, _ in PASSES) + f",\nu AS ({UNION}),\nfwd AS (SELECT country, s1_id, cand_id, block_score, pass_id FROM (SELECT *, row_number() OVER (PARTITION BY country, s1_id, cand_id ORDER BY block_score DESC, pass_id) AS best FROM u) WHERE best = 1)"


@query(O.select(FORWARD, "SELECT * FROM fwd"))
def c17_pass_union(spark, sf_dir):
    return retrieve.forward(*sides(spark, sf_dir)).select("country", "s1_id", "cand_id", "block_score", "pass_id")


@query(O.select(O.SCORED, "SELECT country, s1_id, cand_id, max(score) AS block_score, 1 AS pass_id FROM scored GROUP BY ALL"))
def c13_dedup_best(spark, sf_dir):
    p = X.scored(spark, sf_dir).withColumnRenamed("score", "block_score")
    twice = p.withColumn("pass_id", F.lit(1)).unionByName(p.withColumns({"block_score": F.col("block_score") / 2, "pass_id": F.lit(2)}).where(F.col("block_score") > 0))
    return retrieve.dedup_best(twice)


# joins -----------------------------------------------------------------------------------------------------------


@query(O.select(O.REV, "SELECT s1_id, cand_id, a.business_name AS a_name, b.business_name AS b_name FROM rev JOIN norm AS a ON a.entity_id = s1_id JOIN norm AS b ON b.entity_id = cand_id"))
def d1_side_gather(spark, sf_dir):
    clean, noisy, found = candidates(spark, sf_dir)
    a = clean.select(F.col("entity_id").alias("s1_id"), F.col("business_name").alias("a_name"))
    b = noisy.select(F.col("entity_id").alias("cand_id"), F.col("business_name").alias("b_name"))
    return found.join(a, "s1_id").join(b, "cand_id").select("s1_id", "cand_id", "a_name", "b_name")


@query(O.select(LISTS, "SELECT l.s1_id, ids, c_nationkey FROM lists AS l LEFT JOIN customer ON c_custkey = l.s1_id AND c_nationkey < 10"))
def d2_left_join(spark, sf_dir):
    lists = decide.entity_lists(entities(spark, sf_dir), kept(spark, sf_dir))
    own = X.table(spark, sf_dir, "customer").where(F.col("c_nationkey") < 10).select(F.col("c_custkey").alias("s1_id"), "c_nationkey")
    return lists.join(own, "s1_id", "left")


@query(O.select(LISTS, "SELECT DISTINCT cand_id, source FROM scored WHERE cand_id IN (SELECT cand_id FROM excl)"))
def d3_semi_join(spark, sf_dir):
    return X.scored(spark, sf_dir).select("cand_id", "source").distinct().join(kept(spark, sf_dir).select("cand_id"), "cand_id", "left_semi")


@query(O.select(O.REV, "SELECT n.owner AS s1_id, n.entity_id AS cand_id FROM norm AS n WHERE source > 1 AND NOT EXISTS (SELECT 1 FROM rev AS r WHERE r.cand_id = n.entity_id AND r.s1_id = n.owner)"))
def d4_anti_join(spark, sf_dir):
    _, noisy, found = candidates(spark, sf_dir)
    truth = noisy.select(F.col("owner").alias("s1_id"), F.col("entity_id").alias("cand_id"))
    return truth.join(found, ["s1_id", "cand_id"], "left_anti")


@query(O.select(O.REV, "SELECT s1_id, cand_id, CAST(s1_id = owner AS INT) AS y FROM rev"))
def d5_membership_label(spark, sf_dir):
    _, noisy, found = candidates(spark, sf_dir)
    return owned(found, noisy)[0].select("s1_id", "cand_id", "y")


@query(O.select(O.REG, "SELECT n.entity_id, c.country AS owner_country FROM reg AS n JOIN reg AS c ON c.entity_id = n.owner WHERE n.source > 1"))
def d6_map_lookup(spark, sf_dir):
    r = X.registry(spark, sf_dir)
    own = r.where(F.col("source") == 1).select(F.col("entity_id").alias("owner"), F.col("country").alias("owner_country"))
    return r.where(F.col("source") > 1).join(own, "owner").select("entity_id", "owner_country")


@query(O.select(O.SCORED, "SELECT coalesce(a.s1_id, b.s1_id) AS s1_id, coalesce(a.n, 0) AS n_high, coalesce(b.n, 0) AS n_low FROM (SELECT s1_id, count(*) AS n FROM scored WHERE score >= 0.9 GROUP BY s1_id) AS a FULL JOIN (SELECT s1_id, count(*) AS n FROM scored WHERE score < 0.1 GROUP BY s1_id) AS b ON a.s1_id = b.s1_id"))
def d7_outer_join(spark, sf_dir):
    s = X.scored(spark, sf_dir)
    high, low = (s.where(c).groupBy("s1_id").agg(F.count("*").alias(n)) for c, n in ((F.col("score") >= 0.9, "n_high"), (F.col("score") < 0.1, "n_low")))
    return high.join(low, "s1_id", "full_outer").select("s1_id", F.coalesce("n_high", F.lit(0)).alias("n_high"), F.coalesce("n_low", F.lit(0)).alias("n_low"))


FLOORS = [0.0, 0.3, 0.5, 0.7]
#: Thresholds of the one-threshold sweep, of the rule sweep, of the evaluation and of the blend.
SWEEP, RULE_SWEEP, EVALUATION, BLEND = metrics.grid(0.05, 0.95, 0.01), metrics.grid(0.2, 0.9, 0.02), metrics.grid(0.2, 0.92, 0.02), metrics.grid(0.3, 0.9, 0.02)
WEIGHTS = (0.0, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8, 1.0)


def _grid_sql(thresholds: list[float], floors: list[float]) -> str:
    return f"g AS (SELECT CAST(t AS DOUBLE) AS thr, CAST(r AS DOUBLE) AS rel FROM (SELECT unnest({thresholds}) AS t), (SELECT unnest({floors}) AS r))"


def _sweep_sql(pool: str, ents: str, thresholds: list[float], floors: list[float]) -> str:
    f = O.f_beta("coalesce(pred, 0)", "n_true", "coalesce(tp, 0)")
    return O.select(f"{O.SCORED}, {O.ENTITIES}, {_grid_sql(thresholds, floors)}, {pool}, b AS (SELECT s1_id, max(score) AS best FROM scored GROUP BY s1_id), c AS (SELECT thr, rel, s1_id, count(*) AS pred, sum(y) AS tp FROM pool JOIN b USING (s1_id) JOIN g ON score >= thr AND score >= rel * best GROUP BY ALL)", f"SELECT g.thr, g.rel, round(avg({f}), 6) AS macro_f FROM g CROSS JOIN ({ents}) AS e LEFT JOIN c ON c.thr = g.thr AND c.rel = g.rel AND c.s1_id = e.s1_id GROUP BY g.thr, g.rel")


ALL_PAIRS = "pool AS (SELECT * FROM scored)"
EXCLUSIVE = "pool AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, cand_id ORDER BY score DESC, s1_id) AS rn FROM scored) WHERE rn = 1)"


@query(_sweep_sql(ALL_PAIRS, "SELECT * FROM ents", EVALUATION, FLOORS))
def d8_rule_grid(spark, sf_dir):
    return metrics.sweep(entities(spark, sf_dir), X.scored(spark, sf_dir), EVALUATION, FLOORS)


# features --------------------------------------------------------------------------------------------------------

KEY = ["country", "source", "s1_id", "cand_id"]


#: A little is added before rounding, so that halves don't depend on the order of a sum.
def _features(name: str, columns: str, make=lambda spark, sf_dir: pairs(spark, sf_dir), ctes: str = O.PAIRS, table: str = "p", rounded: str = "") -> None:
    cols = columns.split()
    pick = ", ".join(f"round({c} + 1e-9, 6) AS {c}" if c in rounded.split() else c for c in cols)
    ORACLES[name] = O.select(ctes, f"SELECT {', '.join(KEY)}, {pick} FROM {table}")
    QUERIES[name] = lambda spark, sf_dir: make(spark, sf_dir).select(*KEY, *[F.round(F.col(c) + 1e-9, 6).alias(c) if c in rounded.split() else F.col(c) for c in cols])


_features("e2_name_overlap", "name_inter name_jac name_cont name_n1 name_n2", rounded="name_jac name_cont")
_features("e3_addr_overlap", "addr_inter addr_jac addr_cont addr_n1 addr_n2", rounded="addr_jac addr_cont")
_features("e4_num_overlap", "num_inter num_jac postal_cmp house_eq", rounded="num_jac")
_features("e9_flags_lengths", "cand_indic cand_nonascii cand_url cand_addr_empty name_len1 name_len2 block_score pass_id")
_features("e11_trigram_cosine_acronym", "name_tri_cos acronym_match")
IDF_SHARE = f"""{O.PAIRS},
wa AS (SELECT entity_id AS s1_id, 'n' AS field, unnest(name_core) AS token, country FROM norm WHERE source = 1 UNION ALL SELECT entity_id, 'a', unnest(addr_tok), country FROM norm WHERE source = 1),
ws AS (SELECT s1_id, field, sum(idf) AS total FROM wa JOIN w USING (country, token, field) GROUP BY ALL),
sh AS (SELECT s1_id, cand_id, field, sum(idf) AS shared FROM (SELECT country, s1_id, cand_id, 'n' AS field, unnest(list_intersect(a_core, b_core)) AS token FROM p UNION ALL SELECT country, s1_id, cand_id, 'a', unnest(list_intersect(a_addr, b_addr)) FROM p) JOIN w USING (country, token, field) GROUP BY ALL),
pi AS (SELECT p.*, round(coalesce(n.shared, 0) / greatest(coalesce(nt.total, 0), 1e-6), 6) AS name_idf_share, round(coalesce(a.shared, 0) / greatest(coalesce(aw.total, 0), 1e-6), 6) AS addr_idf_share
  FROM p LEFT JOIN sh AS n ON n.s1_id = p.s1_id AND n.cand_id = p.cand_id AND n.field = 'n' LEFT JOIN ws AS nt ON nt.s1_id = p.s1_id AND nt.field = 'n'
  LEFT JOIN sh AS a ON a.s1_id = p.s1_id AND a.cand_id = p.cand_id AND a.field = 'a' LEFT JOIN ws AS aw ON aw.s1_id = p.s1_id AND aw.field = 'a')"""
_features("e12_idf_share", "name_idf_share addr_idf_share", ctes=IDF_SHARE, table="pi")
_features("f1_rank_features", "n_cand rank_addr rank_name rank_total addr_gap_best name_gap_best total_gap_best")
_features("f4_reverse_features", "rev_n rev_rank rev_gap_best rev_gap_addr rev_gap_name rev_margin_2nd")


@query()
def e6_fuzzy_features(spark, sf_dir):
    return pairs(spark, sf_dir, fuzzy=True).select(*KEY, *[F.round(c, 6).alias(c) for c in "fuzz_name_set fuzz_name_core fuzz_addr_sort skel_ratio nospace_ratio".split()])


@query(O.select(O.SCORED, "SELECT s1_id, cand_id, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, source, cand_id) AS place, round(max(score) OVER (PARTITION BY s1_id), 6) AS best, round(avg(score) OVER (PARTITION BY s1_id), 12) AS mean FROM scored"))
def f8_entity_windows(spark, sf_dir):
    own = Window.partitionBy("s1_id")
    return X.scored(spark, sf_dir).select("s1_id", "cand_id", decide.within().alias("place"), F.round(F.max("score").over(own), 6).alias("best"), F.round(F.avg("score").over(own), 12).alias("mean"))


#: A stand-in for the first stage's score that both engines compute alike.
SCORE1 = "round((addr_jac + name_jac) / 2 + CASE WHEN rev_rank = 1 THEN 0.3 ELSE 0.0 END, 6)"


def family(spark, sf_dir):
    clean, noisy, found = candidates(spark, sf_dir)
    p = features.stage1(found.drop("rn").withColumn("pass_id", F.lit(1)), clean, noisy, False).withColumn("score1", F.expr(SCORE1))
    return features.stage2(p, clean, edit=False)


HOUSE = "coalesce(try_cast(regexp_extract({0}, '^0*([0-9]+)', 1) AS BIGINT), -1)"
FAMILY = f"""{O.PAIRS},
f0 AS (SELECT *, {SCORE1} AS score1, greatest(name_n1 - name_inter, 0) AS novel_s1_tok, greatest(name_n2 - name_inter, 0) AS novel_cand_tok,
  {HOUSE.format('a_num')} AS ha, {HOUSE.format('b_num')} AS hb, regexp_extract(a_num, '^0*([0-9]+)', 1) AS da, regexp_extract(b_num, '^0*([0-9]+)', 1) AS db FROM p),
f1 AS (SELECT *, CAST(novel_s1_tok = 1 AND novel_cand_tok = 1 AND name_inter >= 1 AS INT) AS one_word_swap, CAST(score1 >= 0.8 AS INT) AS fam_is_member, CAST(ha >= 0 AND ha = hb AS INT) AS eq FROM f0),
f2 AS (SELECT *, CASE WHEN one_word_swap = 1 THEN list_filter(b_core, lambda t: NOT list_contains(a_core, t))[1] END AS nov,
  greatest(count(*) OVER own - 1, 1) AS others, CASE WHEN hb >= 0 THEN count(*) OVER (PARTITION BY country, source, s1_id, hb) ELSE 1 END AS same FROM f1 WINDOW own AS (PARTITION BY country, source, s1_id)),
f3 AS (SELECT f2.*, CAST(cw.token IS NOT NULL AS INT) AS novel_is_common, CASE WHEN nov IS NOT NULL AND count(*) OVER (PARTITION BY f2.country, source, s1_id, nov) >= 2 THEN 1 ELSE 0 END AS novel_fam_decoy,
  CASE WHEN ha >= 0 AND hb >= 0 THEN eq ELSE -1 END AS house_norm_eq, CASE WHEN ha >= 0 AND hb >= 0 THEN abs(ha - hb) ELSE -1 END AS house_num_diff,
  CASE WHEN ha >= 0 AND hb >= 0 AND da <> db AND (contains(da, db) OR contains(db, da)) THEN 1 ELSE 0 END AS house_trunc,
  round(CASE WHEN ha >= 0 THEN (sum(eq) OVER own - eq) / others ELSE 0.0 END, 6) AS house_fam_match_s1,
  CASE WHEN hb >= 0 AND same = max(same) OVER own THEN 1 ELSE 0 END AS house_fam_majority, round(CASE WHEN hb >= 0 THEN (same - 1) / others ELSE 0.0 END, 6) AS house_fam_share,
  sum(fam_is_member) OVER own AS fam_size, max(score1) OVER own AS fam_score_max, avg(score1) OVER own AS fam_score_mean, round(score1 - max(score1) OVER own, 6) AS fam_score_gap, rev_margin_2nd AS own_rev_margin
  FROM f2 LEFT JOIN (SELECT country, token FROM w WHERE field = 'n' AND df >= 5) AS cw ON cw.country = f2.country AND cw.token = nov WINDOW own AS (PARTITION BY f2.country, source, s1_id)),
ft AS (SELECT country, source, s1_id, cand_id, fam_is_member, 'a' AS field, unnest(b_addr) AS token FROM f3 UNION ALL SELECT country, source, s1_id, cand_id, fam_is_member, 'n', unnest(b_core) FROM f3),
fp AS (SELECT country, source, s1_id, field, token, count(*) AS cnt FROM ft WHERE fam_is_member = 1 GROUP BY ALL),
fn AS (SELECT country, count(*) AS n FROM norm WHERE source = 1 GROUP BY country),
fs AS (SELECT ft.country, ft.source, ft.s1_id, cand_id, ft.field, sum(coalesce(cnt, 0)) AS s, sum(coalesce(cnt, 0) * coalesce(idf, ln(n + 1.0))) AS ws, sum(coalesce(idf, ln(n + 1.0))) AS wt
  FROM ft LEFT JOIN fp USING (country, source, s1_id, field, token) LEFT JOIN w ON w.country = ft.country AND w.token = ft.token AND w.field = ft.field JOIN fn ON fn.country = ft.country GROUP BY ALL),
f AS (SELECT f3.*, round((coalesce(a.s, 0) - CASE WHEN fam_is_member = 1 THEN len(b_addr) ELSE 0 END) / (greatest(len(b_addr), 1) * greatest(fam_size - fam_is_member, 1)), 6) AS fam_addr_share,
  round((coalesce(n.s, 0) - CASE WHEN fam_is_member = 1 THEN len(b_core) ELSE 0 END) / (greatest(len(b_core), 1) * greatest(fam_size - fam_is_member, 1)), 6) AS fam_name_share,
  round(coalesce(a.ws, 0) / greatest(coalesce(a.wt, 0), 1e-6), 6) AS fam_addr_idf
  FROM f3 LEFT JOIN fs AS a ON a.country = f3.country AND a.source = f3.source AND a.s1_id = f3.s1_id AND a.cand_id = f3.cand_id AND a.field = 'a'
  LEFT JOIN fs AS n ON n.country = f3.country AND n.source = f3.source AND n.s1_id = f3.s1_id AND n.cand_id = f3.cand_id AND n.field = 'n')"""
for _name, _cols in (
    ("g1_family_scores", "fam_size fam_is_member fam_score_max fam_score_mean fam_score_gap own_rev_margin"),
    ("g4_family_tokens", "fam_addr_share fam_name_share fam_addr_idf"),
    ("g6_novel_tokens", "novel_s1_tok novel_cand_tok one_word_swap novel_is_common novel_fam_decoy"),
    ("g10_house_features", "house_norm_eq house_num_diff house_trunc house_fam_match_s1 house_fam_majority house_fam_share"),
):
    _features(_name, _cols, family, FAMILY, "f", "fam_score_mean")


@query()
def g8_novel_edit_sim(spark, sf_dir):
    clean, noisy, found = candidates(spark, sf_dir)
    p = features.stage1(found.drop("rn").withColumn("pass_id", F.lit(1)), clean, noisy, False)
    return features.name_diff(p, clean).where(F.col("one_word_swap") == 1).select(*KEY, F.round("novel_edit_sim", 6).alias("novel_edit_sim"))


# models ----------------------------------------------------------------------------------------------------------

def _labelled_pairs(spark, sf_dir):
    clean, noisy, found = candidates(spark, sf_dir)
    make = lambda: owned(features.stage1(found.drop("rn").withColumn("pass_id", F.lit(1)), clean, noisy), noisy)[0].withColumn("entity", F.substring("s1_id", 4, 20).cast("bigint")).withColumn("part", metrics.split_of(F.col("entity")))
    return stored(spark, sf_dir, "labelled", make, "country", "source"), clean


_models: dict[tuple[str, str], dict] = {}


def trained(spark, sf_dir) -> dict:
    """Both stages' models over all their features, and the rows that they were made from; once a session and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        rows, clean = _labelled_pairs(spark, sf_dir)
        stop = metrics.stop_entities(rows.where(F.col("part") == "validation")).withColumn("stop", F.lit(True))
        fitting = lambda r: r.join(stop, "s1_id", "left").withColumn("stop", F.coalesce("stop", F.lit(False))).where((F.col("part") == "fit") | F.col("stop"))
        first = model.train(C.scratch(fitting(rows), "fit"), features.STAGE1, trees=20, depth=5, stop="stop")
        folded = model.out_of_fold(C.scratch(rows.where(F.col("part") != "rest"), "folds"), features.STAGE1, trees=10, depth=5)
        full = C.scratch(features.stage2(folded, clean), "stage2")
        second = model.train(C.scratch(fitting(full), "fit2"), model.STAGE2_NAMES, trees=20, depth=5, stop="stop")
        _models[key] = {"first": first, "second": second, "rows": rows, "full": full}
    return _models[key]


@query()
def h1_stage1_scores(spark, sf_dir):
    """Scores of a model that was trained on the fitting entities, early stopping on every fifth validation entity."""
    m = trained(spark, sf_dir)
    return model.score(m["rows"], m["first"], features.STAGE1, "score").select(*KEY, "score", "y")


@query()
def h4_two_stage_scores(spark, sf_dir):
    """Second-stage scores over out-of-fold first ones."""
    m = trained(spark, sf_dir)
    return model.score(m["full"], m["second"], model.STAGE2_NAMES, "score").select(*KEY, "score1", "score", "y")


@query()
def h6_feature_importance(spark, sf_dir):
    return model.importance_table(spark, trained(spark, sf_dir)["second"], model.STAGE2_NAMES)


@query(O.select(O.REV, "SELECT s1_id, cand_id, round(len(list_intersect(string_split(a.name_norm, ' '), string_split(b.name_norm, ' '))) / greatest(len(list_distinct(string_split(a.name_norm, ' '))), 1), 6) AS score FROM rev JOIN norm AS a ON a.entity_id = s1_id JOIN norm AS b ON b.entity_id = cand_id"))
def h8_pair_scorer(spark, sf_dir):
    """Any scorer of pairs of texts, here the share of the left words that the right has, in batches."""

    def load():
        def score(left, right):
            return [len(set(a.split(" ")) & set(b.split(" "))) / max(len(set(a.split(" "))), 1) for a, b in zip(left, right, strict=True)]

        return score

    clean, noisy, found = candidates(spark, sf_dir)
    both = found.join(clean.select(F.col("entity_id").alias("s1_id"), F.col("name_norm").alias("a")), "s1_id").join(noisy.select(F.col("entity_id").alias("cand_id"), F.col("name_norm").alias("b")), "cand_id")
    return both.select("s1_id", "cand_id", F.round(model.pair_scorer(load)("a", "b"), 6).alias("score"))


@query("SELECT c_custkey AS entity, ((CAST(c_custkey AS BIGINT) * 2654435761 & 4294967295) >> 7) % 5 AS fold FROM customer")
def h3_oof_fold(spark, sf_dir):
    return X.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity"), metrics.fold(F.col("c_custkey")).alias("fold"))


@query(O.select(O.SCORED, f"SELECT s1_id FROM (SELECT s1_id, row_number() OVER (ORDER BY s1_id) - 1 AS n FROM (SELECT DISTINCT s1_id FROM scored WHERE {O.bucket('s1_id')} BETWEEN 30 AND 37)) WHERE n % 5 = 0"))
def h5_early_stop_split(spark, sf_dir):
    return metrics.stop_entities(X.scored(spark, sf_dir).where(metrics.split_of(F.col("s1_id")) == "validation"))


@query(O.select(O.SCORED, "SELECT s1_id, cand_id, score BETWEEN 0.2 AND 0.9 AS in_band FROM scored"))
def h9_band_mask(spark, sf_dir):
    return X.scored(spark, sf_dir).select("s1_id", "cand_id", decide.in_band(F.col("score")).alias("in_band"))


@query(O.select(f"{O.SCORED}, h AS (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY y, score DESC, source, cand_id) AS rn FROM scored), s AS (SELECT * FROM h WHERE score BETWEEN 0.2 AND 0.9 OR (rn = 1 AND y = 0)), n AS (SELECT least(1000, greatest(sum(y), 1), greatest(sum(1 - y), 1)) AS per FROM s)", "SELECT s1_id, cand_id, y FROM (SELECT *, row_number() OVER (PARTITION BY y ORDER BY (cand_id * 7919 + s1_id * 31) % 10007, s1_id, cand_id) AS k FROM s), n WHERE k <= per"))
def h10_sample_band(spark, sf_dir):
    return decide.band_sample(X.scored(spark, sf_dir), 2000).select("s1_id", "cand_id", "y")


@query(O.select(O.SCORED, "SELECT s1_id, cand_id, round(CASE WHEN score BETWEEN 0.2 AND 0.9 THEN 0.6 * score + 0.4 * (1 - score) ELSE score END, 6) AS blended FROM scored"))
def h11_blend(spark, sf_dir):
    return X.scored(spark, sf_dir).select("s1_id", "cand_id", F.round(decide.blend(F.col("score"), 1 - F.col("score"), 0.4), 6).alias("blended"))


TUNE = " UNION ALL ".join(f"SELECT CAST({w} AS DOUBLE) AS w, s1_id, y, source, cand_id, round(CASE WHEN score BETWEEN 0.2 AND 0.9 THEN {1 - w} * score + {w} * (1 - score) ELSE score END, 6) AS score FROM scored" for w in WEIGHTS)


@query(O.select(f"{O.SCORED}, {O.ENTITIES}, {_grid_sql(BLEND, FLOORS[:3])}, pool AS ({TUNE}), b AS (SELECT w, s1_id, max(score) AS best FROM pool GROUP BY ALL), c AS (SELECT w, thr, rel, s1_id, count(*) AS pred, sum(y) AS tp FROM pool JOIN b USING (w, s1_id) JOIN g ON score >= thr AND score >= rel * best GROUP BY ALL)", f"SELECT v.w, g.thr, g.rel, round(avg({O.f_beta('coalesce(pred, 0)', 'n_true', 'coalesce(tp, 0)')}), 6) AS macro_f FROM (SELECT CAST(unnest({list(WEIGHTS)}) AS DOUBLE) AS w) AS v CROSS JOIN g CROSS JOIN ents AS e LEFT JOIN c ON c.w = v.w AND c.thr = g.thr AND c.rel = g.rel AND c.s1_id = e.s1_id GROUP BY v.w, g.thr, g.rel"))
def h12_tune_blend(spark, sf_dir):
    out = None
    for w in WEIGHTS:
        p = X.scored(spark, sf_dir).withColumn("score", F.round(decide.blend(F.col("score"), 1 - F.col("score"), w), 6))
        one = metrics.sweep(entities(spark, sf_dir), p, BLEND, FLOORS[:3]).select(F.lit(w).alias("w"), "*")
        out = one if out is None else out.unionByName(one)
    return out


# decisions -------------------------------------------------------------------------------------------------------

RULE = "SELECT s1_id, source, cand_id, score FROM (SELECT *, max(score) OVER (PARTITION BY s1_id) AS best, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, source, cand_id) AS place FROM scored) WHERE score >= {0} AND score >= {1} * best AND ({2} <= 0 OR place <= {2})"
for _name, _rule in (("i1_threshold", decide.Rule(0.5)), ("i2_rel_floor", decide.Rule(0.3, 0.6)), ("i3_max_per_entity", decide.parse_rule("thr=0.4,rel=0.2,cap=3"))):

    @query(O.select(O.SCORED, RULE.format(_rule.threshold, _rule.rel_floor, _rule.max_per_entity)), _name)
    def _ruled(spark, sf_dir, r=_rule):
        return decide.rule(X.scored(spark, sf_dir), r).select("s1_id", "source", "cand_id", "score")


@query(O.select(LISTS, "SELECT s1_id, source, cand_id, score FROM excl"))
def i4_exclusive(spark, sf_dir):
    return kept(spark, sf_dir).select("s1_id", "source", "cand_id", "score")


@query(O.select(LISTS, "SELECT s1_id, ids FROM lists"))
def i5_entity_lists(spark, sf_dir):
    return decide.entity_lists(entities(spark, sf_dir), kept(spark, sf_dir))


@query(O.select(LISTS, "SELECT s1_id, ids FROM lists"))
def i6_merge_source_lists(spark, sf_dir):
    e, k = entities(spark, sf_dir), kept(spark, sf_dir)
    two, three = (decide.entity_lists(e, k.where(F.col("source") == n), f"l{n}") for n in (2, 3))
    return two.join(three, "s1_id").select("s1_id", decide.merge_lists(F.col("l2"), F.col("l3")).alias("ids"))


@query()
def i7_predict(spark, sf_dir):
    """The batch from raw rows to lists: candidates, two stages, rule, one owner; from what it wrote."""
    m = trained(spark, sf_dir)
    linker = link.Linker(m["first"], m["second"], decide.Rule(0.5, 0.3))
    staging = link.predict(linker, C.Catalog(C.work_folder(spark, "project")), "test", X.registry(spark, sf_dir))
    lists = C.StructType([C.StructField("source1_entity_id", C.StringType()), C.StructField("matched_entity_ids", C.StringType())])
    return C.scan_tsv(spark, f"{staging}/matching", lists)


RULES = [("A", 0.6, 0.5, 0), ("B", 0.7, 0.0, 2), ("C", 0.5, 0.8, 1)]


@query(O.select(f"{O.SCORED}, r AS (SELECT * FROM (VALUES {', '.join(f'({O.q(c)}, {t}, {f}, {n})' for c, t, f, n in RULES)}) AS v(country, threshold, rel_floor, cap)), k AS (SELECT s.* FROM (SELECT *, max(score) OVER (PARTITION BY s1_id) AS best, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, source, cand_id) AS place FROM scored) AS s JOIN r USING (country) WHERE score >= threshold AND (rel_floor <= 0 OR score >= rel_floor * best) AND (cap <= 0 OR place <= cap))", "SELECT s1_id, source, cand_id, score FROM (SELECT *, row_number() OVER (PARTITION BY source, cand_id ORDER BY score DESC, s1_id) AS rn FROM k) WHERE rn = 1"))
def i8_rethreshold(spark, sf_dir):
    return decide.rethreshold(X.scored(spark, sf_dir), spark.createDataFrame(RULES, "country string, threshold double, rel_floor double, cap int")).select("s1_id", "source", "cand_id", "score")


# sampling and metrics --------------------------------------------------------------------------------------------


@query(f"SELECT c_custkey AS id, {O.bucket('c_custkey')} AS bucket, {O.bucket('c_custkey')} < 38 AS sampled, CASE WHEN {O.bucket('c_custkey')} < 30 THEN 'fit' WHEN {O.bucket('c_custkey')} < 38 THEN 'validation' ELSE 'rest' END AS part, CAST(c_nationkey AS BIGINT) * 10000000 + c_custkey AS code FROM customer")
def j1_buckets(spark, sf_dir):
    k = F.col("c_custkey")
    return X.table(spark, sf_dir, "customer").select(k.alias("id"), metrics.bucket(k).alias("bucket"), metrics.sampled(k).alias("sampled"), metrics.split_of(k).alias("part"), metrics.entity_code(F.col("c_nationkey"), k).alias("code"))


@query()
def j5_random_sample(spark, sf_dir):
    return metrics.hash_sample(X.registry(spark, sf_dir), "entity_id", 100)


@query(O.select(LISTS + ", c AS (SELECT s1_id, count(*) AS pred, sum(y) AS tp FROM excl GROUP BY s1_id)", f"SELECT round(avg({O.f_beta('coalesce(pred, 0)', 'n_true', 'coalesce(tp, 0)')}), 6) AS macro_f, count(*) AS entities FROM ents LEFT JOIN c USING (s1_id)"))
def k1_macro_f(spark, sf_dir):
    return metrics.macro_f(entities(spark, sf_dir), kept(spark, sf_dir))


@query(O.select(LISTS, "SELECT s1_id, count(*) AS pred, sum(y) AS tp FROM excl GROUP BY s1_id"))
def k2_count_per_entity(spark, sf_dir):
    return metrics.entity_counts(kept(spark, sf_dir))


@query(_sweep_sql(EXCLUSIVE, "SELECT * FROM ents", SWEEP, [0.0]))
def k3_threshold_sweep(spark, sf_dir):
    return metrics.sweep(entities(spark, sf_dir), X.scored(spark, sf_dir), SWEEP, [0.0], one_owner=True)


@query(_sweep_sql(ALL_PAIRS, "SELECT * FROM ents WHERE s1_id IN (SELECT s1_id FROM scored)", RULE_SWEEP, FLOORS))
def k4_rule_sweep(spark, sf_dir):
    return metrics.sweep(entities(spark, sf_dir), X.scored(spark, sf_dir), RULE_SWEEP, FLOORS, only_scored=True)


COUNTRY = "CASE s1_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END"


@query(" UNION ALL ".join(f"SELECT * FROM (SELECT '{c}' AS country, * FROM ({_sweep_sql(ALL_PAIRS, f'SELECT * FROM ents WHERE {where}', EVALUATION, FLOORS)}) ORDER BY macro_f DESC, thr, rel LIMIT 1)" for c, where in (("ALL", "true"), ("A", f"{COUNTRY} = 'A'"), ("B", f"{COUNTRY} = 'B'"), ("C", f"{COUNTRY} = 'C'"))))
def k5_best_rule(spark, sf_dir):
    """The best rule over all entities and for each country."""
    e = entities(spark, sf_dir).withColumn("country", F.expr(COUNTRY))
    return metrics.best_rule(metrics.sweep(e, X.scored(spark, sf_dir), EVALUATION, FLOORS, by="country"), "country").select("country", "thr", "rel", "macro_f")


TRUTH = f"{O.REG}, truth AS (SELECT c.entity_id AS source1_entity_id, coalesce(string_agg(n.entity_id, ',' ORDER BY n.entity_id), '') AS matched_entity_ids FROM (SELECT * FROM reg WHERE source = 1) AS c LEFT JOIN (SELECT * FROM reg WHERE source > 1) AS n ON n.owner = c.entity_id GROUP BY c.entity_id)"


def truth_table(spark, sf_dir):
    r = X.registry(spark, sf_dir)
    ids = r.where(F.col("source") > 1).groupBy(F.col("owner").alias("entity_id")).agg(F.array_join(F.array_sort(F.collect_list("entity_id")), ",").alias("ids"))
    return r.where(F.col("source") == 1).select("entity_id").join(ids, "entity_id", "left").select(F.col("entity_id").alias("source1_entity_id"), F.coalesce("ids", F.lit("")).alias("matched_entity_ids"))


@query(O.select(TRUTH, "SELECT owner AS s1_id, entity_id AS cand_id FROM reg WHERE source = 2"))
def k6_truth_pairs(spark, sf_dir):
    return metrics.truth_pairs(truth_table(spark, sf_dir), 2)


@query(O.select(TRUTH, "SELECT c.entity_id AS s1_id, count(n.entity_id) AS n_true FROM (SELECT * FROM reg WHERE source = 1) AS c LEFT JOIN (SELECT * FROM reg WHERE source > 1) AS n ON n.owner = c.entity_id GROUP BY c.entity_id"))
def k7_truth_counts(spark, sf_dir):
    return metrics.truth_counts(truth_table(spark, sf_dir))


RECALL = f"{O.REV}, t AS (SELECT country, source, owner AS s1_id, entity_id AS cand_id FROM norm WHERE source > 1), h AS (SELECT t.*, CAST(r.cand_id IS NOT NULL AS INT) AS y FROM t LEFT JOIN rev AS r ON r.s1_id = t.s1_id AND r.cand_id = t.cand_id)"


@query(O.select(RECALL + ", hh AS (SELECT * FROM h UNION ALL SELECT country, 0, s1_id, cand_id, y FROM h), cc AS (SELECT country, source, count(*) AS pairs FROM (SELECT country, source FROM rev UNION ALL SELECT country, 0 FROM rev) GROUP BY ALL)", 'SELECT hh.country, hh.source, count(*) AS "true", sum(y) AS found, round(sum(y) / count(*), 6) AS recall, round(any_value(pairs) / any_value(n_s1), 6) AS per_entity, round(count(DISTINCT CASE WHEN y = 1 THEN s1_id END) / count(DISTINCT s1_id), 6) AS reachable FROM hh JOIN cc ON cc.country = hh.country AND cc.source = hh.source JOIN (SELECT country, count(*) AS n_s1 FROM norm WHERE source = 1 GROUP BY country) AS n ON n.country = hh.country GROUP BY hh.country, hh.source'))
def k8_blocking_recall(spark, sf_dir):
    clean, noisy, found = candidates(spark, sf_dir)
    return metrics.blocking_recall(clean, found, owned(found, noisy)[1])


@query(O.select(RECALL, "SELECT round(sum(hit) / sum(n), 6) AS micro, round(avg(hit / n), 6) AS macro FROM (SELECT s1_id, sum(y) AS hit, count(*) AS n FROM h GROUP BY s1_id)"))
def k9_recall_micro_macro(spark, sf_dir):
    _, noisy, found = candidates(spark, sf_dir)
    return metrics.recall_micro_macro(found, owned(found, noisy)[1])


@query(O.select(O.REV + ", a AS (SELECT t.entity_id, count(r.s1_id) AS hits, min(CASE WHEN r.s1_id = t.owner THEN rn END) AS place FROM sig AS t LEFT JOIN rev AS r ON r.cand_id = t.entity_id WHERE t.source > 1 GROUP BY t.entity_id)", f"SELECT k, round(count(*) FILTER (place <= k) / count(*) FILTER (hits > 0), 6) AS recall, round(count(*) FILTER (place <= k) / count(*), 6) AS recall_all FROM a, (SELECT unnest({list(metrics.KS)}) AS k) GROUP BY k"))
def k10_recall_at_k(spark, sf_dir):
    _, noisy, found = candidates(spark, sf_dir)
    return metrics.recall_at_k(found, owned(found, noisy)[1])


@query(O.select(FORWARD, "SELECT DISTINCT s1_id, cand_id FROM u"))
def k11_pair_union(spark, sf_dir):
    return retrieve.forward(*sides(spark, sf_dir)).select("s1_id", "cand_id").distinct()


#: Caps and depths of the passes: address, name, address prefixes.
K12 = [(2000, 20, 2000, 10, 0, 0), (2000, 20, 20000, 10, 0, 0), (2000, 20, 2000, 10, 2000, 10), (2000, 20, 20000, 10, 5000, 10), (5000, 24, 20000, 12, 5000, 12)]
K12_SIDE = {1: ("addr_tok", "source > 1 AND len(addr_tok) > 0"), 2: ("name_core", "source > 1"), 3: (PREFIX, "source > 1 AND len(addr_tok) > 0")}
K12_PASSES = sorted({(n, row[2 * n - 2], row[2 * n - 1]) for row in K12 for n in (1, 2, 3) if row[2 * n - 1]})


def _k12_sql() -> str:
    ctes, name = [O.SIG], {}
    for n, cap, k in K12_PASSES:
        name[n, cap, k] = f"p{n}_{cap}_{k}"
        made, body = _pass(name[n, cap, k], *K12_SIDE[n], cap, k)
        ctes.append(f"{made},\n{name[n, cap, k]}_o AS ({body})")
    rows = []
    for at, row in enumerate(K12, 1):
        own = [(n, name[n, row[2 * n - 2], row[2 * n - 1]]) for n in (1, 2, 3) if row[2 * n - 1]]
        rows += [f"SELECT {at} AS grid, {n} AS pass_id, s1_id, cand_id FROM {t}_o" for n, t in own]
        rows.append(f"SELECT DISTINCT {at}, 0, s1_id, cand_id FROM (" + " UNION ALL ".join(f"SELECT s1_id, cand_id FROM {t}_o" for _, t in own) + ")")
    return O.select(",\n".join(ctes), f"SELECT grid, pass_id, count(*) AS pairs, CAST(sum(CASE WHEN owner = s1_id THEN 1 ELSE 0 END) AS BIGINT) AS found FROM ({' UNION ALL '.join(rows)}) JOIN sig ON entity_id = cand_id GROUP BY grid, pass_id")


@query(_k12_sql())
def k12_forward_grid(spark, sf_dir):
    """Pairs and true pairs of each forward pass, and of their union (pass 0), for five rows of caps and depths."""
    clean, noisy = sides(spark, sf_dir)
    made = {}
    for n, cap, k in K12_PASSES:
        side, sig = {p: (s, c) for p, s, c, _, _ in retrieve.passes(noisy)}[n]
        made[n, cap, k] = retrieve.forward_pass(clean, side, sig, cap, retrieve.Forward().rarest, k).select("s1_id", "cand_id")
    own, out = noisy.select(F.col("entity_id").alias("cand_id"), "owner"), None
    for at, row in enumerate(K12, 1):
        found = [(n, made[n, row[2 * n - 2], row[2 * n - 1]]) for n in (1, 2, 3) if row[2 * n - 1]]
        union = found[0][1]
        for _, p in found[1:]:
            union = union.unionByName(p)
        for n, p in [*found, (0, union.distinct())]:
            p = p.select(F.lit(at).alias("grid"), F.lit(n).alias("pass_id"), "s1_id", "cand_id")
            out = p if out is None else out.unionByName(p)
    return out.join(own, "cand_id").groupBy("grid", "pass_id").agg(F.count("*").alias("pairs"), F.count_if(F.col("owner") == F.col("s1_id")).alias("found"))


# diagnosis -------------------------------------------------------------------------------------------------------

NOISE = "CASE WHEN (b.name_flags & 1) > 0 THEN 'indic script' WHEN (b.name_flags & 4) > 0 THEN 'url-like name' WHEN len(b.addr_tok) = 0 THEN 'empty address' WHEN len(list_intersect(a.name_core, b.name_core)) = 0 THEN 'alias name' WHEN upper(b.business_name) = b.business_name AND lower(b.business_name) <> b.business_name THEN 'allcaps' ELSE 'clean-ish' END"
NOISY = f"{O.NORM}, noise AS (SELECT b.entity_id, b.source, b.country, {NOISE} AS noise FROM norm AS b JOIN norm AS a ON a.entity_id = b.owner WHERE b.source > 1)"


def noise(spark, sf_dir):
    clean, noisy = sides(spark, sf_dir)
    own = clean.select(F.col("entity_id").alias("owner"), F.col("name_core").alias("a_core"))
    label = diagnose.noise_label(F.col("name_flags").cast("int"), F.size("addr_tok") == 0, F.arrays_overlap("a_core", "name_core"), F.col("business_name"))
    return noisy.join(own, "owner").select("entity_id", "source", "country", label.alias("noise"))


@query(O.select(NOISY, "SELECT * FROM noise"))
def l1_noise_labels(spark, sf_dir):
    return noise(spark, sf_dir)


#: Retrieved pairs with a score that both engines compute alike, and all true pairs, retrieved or not.
RETRIEVED = f"{O.PAIRS}, s AS (SELECT country, source, s1_id, cand_id, {SCORE1} AS score FROM p), t AS (SELECT country, source, owner AS s1_id, entity_id AS cand_id, 1 AS y FROM norm WHERE source > 1)"


def retrieved(spark, sf_dir):
    _, noisy, found = candidates(spark, sf_dir)
    return pairs(spark, sf_dir).withColumn("score", F.expr(SCORE1)).select(*KEY, "score"), owned(found, noisy)[1]


@query(O.select(f"{RETRIEVED}, j AS (SELECT coalesce(t.country, s.country) AS country, coalesce(t.y, 0) AS y, s.score FROM t FULL JOIN s ON t.s1_id = s.s1_id AND t.cand_id = s.cand_id), jj AS (SELECT * FROM j UNION ALL SELECT 'ALL', y, score FROM j)", "SELECT country, count(*) FILTER (y = 1 AND score IS NULL) AS blocked, count(*) FILTER (y = 1 AND score >= 0.6) AS tp, count(*) FILTER (y = 1 AND score < 0.6) AS fn, count(*) FILTER (y = 0 AND score >= 0.6) AS fp FROM jj GROUP BY country"))
def l2_loss_attribution(spark, sf_dir):
    s, truth = retrieved(spark, sf_dir)
    return diagnose.loss_attribution(truth, s, 0.6)


@query(O.select(NOISY, "SELECT coalesce(noise, 'All') AS noise, coalesce(country, 'All') AS country, count(*) AS n FROM noise GROUP BY CUBE (noise, country)"))
def l3_noise_crosstab(spark, sf_dir):
    return diagnose.crosstab(noise(spark, sf_dir), "noise", "country")


CAUSE = f"""{O.SIG}, i AS (SELECT country, token FROM (SELECT country, unnest(sig) AS token FROM sig WHERE source = 1) GROUP BY ALL HAVING count(*) <= {CAP}),
m AS (SELECT b.country, b.entity_id, list_intersect(a.sig, b.sig) AS shared FROM sig AS b JOIN sig AS a ON a.entity_id = b.owner WHERE b.source > 1),
x AS (SELECT entity_id, count(*) AS n FROM (SELECT country, entity_id, unnest(shared) AS token FROM m) JOIN i USING (country, token) GROUP BY entity_id)"""


@query(O.select(CAUSE, "SELECT m.entity_id, CASE WHEN len(shared) = 0 THEN 'no shared token' WHEN coalesce(x.n, 0) = 0 THEN 'shared but unindexed' ELSE 'outranked' END AS cause FROM m LEFT JOIN x USING (entity_id)"))
def l4_miss_cause(spark, sf_dir):
    clean, noisy = (retrieve.typed_signature(s) for s in sides(spark, sf_dir))
    df = retrieve.doc_freq(retrieve._docs(clean, F.col("sig")), CAP).select("country", "token", F.lit(1).alias("known"))
    both = noisy.join(clean.select(F.col("entity_id").alias("owner"), F.col("sig").alias("own")), "owner").select("country", "entity_id", F.array_intersect("sig", "own").alias("shared"))
    kept = both.select("country", "entity_id", F.explode("shared").alias("token")).join(df, ["country", "token"]).groupBy("entity_id").agg(F.collect_list("token").alias("indexed"))
    return both.join(kept, "entity_id", "left").select("entity_id", diagnose.miss_cause(F.col("shared"), F.coalesce("indexed", F.array().cast("array<string>"))).alias("cause"))


@query(O.select(O.REG, f"SELECT entity_id, CASE WHEN business_address = '' THEN 'empty address' WHEN regexp_matches(business_name, '{vocab.INDIC}') THEN 'indic script' WHEN regexp_matches(business_name, '(?i){vocab.URL_NOISE}') THEN 'url-like name' WHEN upper(business_name) = business_name AND lower(business_name) <> business_name THEN 'allcaps' ELSE 'other' END AS noise FROM reg"))
def l5_noise_of(spark, sf_dir):
    return X.registry(spark, sf_dir).select("entity_id", diagnose.noise_of(F.col("business_name"), F.col("business_address")).alias("noise"))


@query(O.select(RETRIEVED + ", ruled AS (SELECT * FROM (SELECT *, max(score) OVER (PARTITION BY s1_id) AS best, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, source, cand_id) AS place FROM s) WHERE score >= 0.6 AND score >= 0.9 * best AND place <= 2), excl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, cand_id ORDER BY score DESC, s1_id) AS rn FROM ruled) WHERE rn = 1)", "SELECT t.source, t.s1_id, t.cand_id, CASE WHEN s.score IS NULL THEN 'never_a_candidate' WHEN s.score < 0.6 THEN 'below_threshold' WHEN r.s1_id IS NULL THEN 'below_floor_or_cap' ELSE 'taken_by_another_s1' END AS reason FROM t LEFT JOIN s ON s.s1_id = t.s1_id AND s.cand_id = t.cand_id LEFT JOIN ruled AS r ON r.s1_id = t.s1_id AND r.cand_id = t.cand_id WHERE NOT EXISTS (SELECT 1 FROM excl AS x WHERE x.s1_id = t.s1_id AND x.cand_id = t.cand_id)"))
def l6_fn_reason(spark, sf_dir):
    s, truth = retrieved(spark, sf_dir)
    ruled = decide.rule(s, decide.Rule(0.6, 0.9, 2))
    return diagnose.fn_reason(truth, s, ruled, decide.exclusive(ruled), 0.6)


@query(O.select(LISTS + ", t AS (SELECT source, cand_id, min(s1_id) AS true_owner FROM scored WHERE y = 1 GROUP BY ALL)", "SELECT x.source, x.s1_id, x.cand_id, true_owner FROM excl AS x LEFT JOIN t USING (source, cand_id) WHERE true_owner IS NULL OR true_owner <> x.s1_id"))
def l7_fp_true_owner(spark, sf_dir):
    truth = X.scored(spark, sf_dir).where(F.col("y") == 1).groupBy("source", "cand_id").agg(F.min("s1_id").alias("s1_id"))
    return diagnose.fp_owner(truth, kept(spark, sf_dir))


_like = lambda c, p: f"count(*) FILTER (regexp_matches({c}, {O.q(p)}))"


@query(O.select(O.REG, f"SELECT source, count(*) AS rows, count(*) FILTER (business_name = '') AS empty_name, count(*) FILTER (business_address = '') AS empty_address, {_like('business_name', '[ऀ-ॿ]')} AS devanagari, {_like('business_name', '[^\\x00-\\x7F]')} AS non_ascii, {_like('business_name', '(?i)' + vocab.URLISH)} AS url_like, count(*) FILTER (starts_with(business_name, '--')) AS dashes, count(*) FILTER (NOT regexp_matches(business_name, '[a-z]')) AS name_caps, count(*) FILTER (NOT regexp_matches(business_address, '[a-z]')) AS addr_caps, {_like('business_address', r'\\b[0-9]{5}\\b'.replace(chr(92) * 2, chr(92)))} AS five_digits, {_like('business_address', r'\\b[0-9]{6}\\b'.replace(chr(92) * 2, chr(92)))} AS six_digits, count(DISTINCT business_name) AS names, round(avg(length(business_name)), 6) AS name_len, round(avg(length(business_address)), 6) AS addr_len FROM reg GROUP BY source"))
def l8_source_profile(spark, sf_dir):
    return diagnose.source_profile(X.registry(spark, sf_dir))


@query(O.select(O.REG, "SELECT source, country, n, round(n / sum(n) OVER (PARTITION BY source), 6) AS share FROM (SELECT source, country, count(*) AS n FROM reg GROUP BY ALL)"))
def l8_country_shares(spark, sf_dir):
    return diagnose.country_shares(X.registry(spark, sf_dir))


@query(O.select(TRUTH + ", n AS (SELECT *, CASE WHEN matched_entity_ids = '' THEN 0 ELSE len(string_split(matched_entity_ids, ',')) END AS n FROM truth), i AS (SELECT unnest(string_split(matched_entity_ids, ',')) AS id FROM truth WHERE matched_entity_ids <> '')", "SELECT count(*) AS entities, count(*) FILTER (n = 0) AS singletons, round(avg(CASE WHEN n > 0 THEN n END), 6) AS mean, median(CASE WHEN n > 0 THEN n END) AS median, CAST(max(CASE WHEN n > 0 THEN n END) AS INT) AS max, round(avg(CASE WHEN n = 0 THEN 1 ELSE 0 END), 6) AS empty_f, (SELECT count(*) FROM i) AS ids, (SELECT count(DISTINCT id) FROM i) AS distinct_ids, (SELECT count(*) FILTER (starts_with(id, 'S2-')) FROM i) AS used_s2 FROM n"))
def l9_truth_profile(spark, sf_dir):
    return diagnose.truth_profile(truth_table(spark, sf_dir))


@query(O.select(TRUTH, "SELECT CAST(len(string_split(matched_entity_ids, ',')) AS INT) AS n, count(*) AS entities FROM truth WHERE matched_entity_ids <> '' GROUP BY 1 ORDER BY 1 LIMIT 12"))
def l9_truth_sizes(spark, sf_dir):
    return diagnose.truth_sizes(truth_table(spark, sf_dir))


@query(O.select(O.REG, "SELECT c.country AS s1_country, n.country AS cand_country, count(*) AS n FROM reg AS n JOIN reg AS c ON c.entity_id = n.owner WHERE n.source > 1 GROUP BY ALL"))
def l10_country_consistency(spark, sf_dir):
    r = X.registry(spark, sf_dir)
    return diagnose.country_consistency(r.where(F.col("source") > 1).select(F.col("owner").alias("s1_id"), F.col("entity_id").alias("cand_id")), r)


@query(O.select(LISTS + ", n AS (SELECT CASE s1_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS country, CASE WHEN ids = '' THEN 0 ELSE len(string_split(ids, ',')) END AS n FROM lists)", "SELECT country, count(*) AS entities, round(avg(CASE WHEN n = 0 THEN 1 ELSE 0 END), 6) AS singleton_rate, round(avg(CASE WHEN n > 0 THEN n END), 6) AS per_nonsingleton, round(avg(n), 6) AS per_entity FROM n GROUP BY country"))
def l11_output_calibration(spark, sf_dir):
    lists = decide.entity_lists(entities(spark, sf_dir), kept(spark, sf_dir))
    return diagnose.output_calibration(lists.withColumn("country", F.expr("CASE s1_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END")))


@query(O.select(O.REV, "SELECT n.source, n.country, count(*) AS records, round(avg(CASE WHEN r.cand_id IS NULL THEN 0 ELSE 1 END), 6) AS share_assigned FROM norm AS n LEFT JOIN (SELECT DISTINCT cand_id FROM rev WHERE block_score >= 5) AS r ON r.cand_id = n.entity_id WHERE n.source > 1 GROUP BY ALL"))
def l11_assigned_share(spark, sf_dir):
    _, noisy, found = candidates(spark, sf_dir)
    return diagnose.assigned_share(noisy, found.where(F.col("block_score") >= 5))


@query(O.select(O.REV, "SELECT country, source, s1_id, cand_id, block_score FROM (SELECT *, row_number() OVER (PARTITION BY country, source, cand_id ORDER BY block_score DESC, s1_id) AS b FROM rev) WHERE b = 1"))
def l12_best_block_per_cand(spark, sf_dir):
    return diagnose.best_candidate(candidates(spark, sf_dir)[2]).select("country", "source", "s1_id", "cand_id", "block_score")


@query(" UNION ALL ".join(f"SELECT {O.q(k)} AS pattern, CAST(sum(len(regexp_extract_all(lower(business_address || ' ' || business_name), {O.q(p)}))) AS BIGINT) AS n FROM reg" for k, p in vocab.FRENCH.items()).join((f"WITH {O.REG}\n", "")))
def l13_pattern_freq(spark, sf_dir):
    r = X.registry(spark, sf_dir).select(F.concat_ws(" ", "business_address", "business_name").alias("t"))
    return diagnose.pattern_counts(r, "t", vocab.FRENCH)
