"""DuckDB SQL that says what the queries must return: common table expressions that build on each other."""

from __future__ import annotations

from ..functions import normalize as N
from ..functions import vocab
from . import fixtures


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def words(some) -> str:
    return "[" + ", ".join(map(q, some)) + "]"


def fold(x: str) -> str:
    one, to = N._single()
    x = f"translate({x}, {q(one)}, {q(to)})"
    for c, v in N._others().items():
        if ord(c) < 0x180:
            x = f"replace({x}, {q(c)}, {q(v)})"
    return f"regexp_replace({x}, '[^\\x00-\\x7F]', '', 'g')"


def norm_text(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({fold(x)}), {q('(?i)' + vocab.JUNK)}, ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"


def tokens(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def strip_lead(x: str) -> str:
    return f"regexp_replace(trim({x}), {q('(?i)' + vocab.LEAD)}, '')"


def flags(x: str) -> str:
    bit = lambda p, n: f"CASE WHEN regexp_matches({x}, {q(p)}) THEN {n} ELSE 0 END"
    return f"CAST({bit(vocab.INDIC, 1)} + {bit('[^\\x00-\\x7F]', 2)} + {bit('(?i)' + vocab.URLISH, 4)} AS TINYINT)"


def name_core(norm: str) -> str:
    every = f"list_sort(list_distinct({tokens(norm)}))"
    core = f"list_filter({every}, lambda t: NOT list_contains({words(vocab.LEGAL)}, t) AND length(t) > 1)"
    return f"CASE WHEN len({core}) > 0 THEN {core} ELSE {every} END"


DIGIT = "regexp_matches(t, '[0-9]')"


def addr_tokens(norm: str) -> str:
    """Sorted; the operator keeps the order of the text."""
    states, streets = vocab.STATE, vocab.STREET
    code = f"({words(states.values())})[list_position({words(states)}, t)]"
    kept = f"list_filter({tokens(norm)}, lambda t: {DIGIT} OR NOT list_contains({words(vocab.ADDR_STOP)}, t))"
    short = f"list_transform({kept}, lambda t: CASE WHEN {DIGIT} THEN t WHEN list_contains({words(states)}, t) THEN CASE WHEN {code} = '' THEN '' ELSE '@' || {code} END ELSE coalesce(({words(streets.values())})[list_position({words(streets)}, t)], t) END)"
    return f"list_sort(list_distinct(list_filter({short}, lambda t: {DIGIT} OR length(t) >= 2)))"


def skeleton(x: str) -> str:
    x = f"regexp_replace({x}, '[aeiou]', '', 'g')"
    for c in "bcdfghjklmnpqrstvwxyz0123456789":
        x = f"regexp_replace({x}, '{c}+', '{c}', 'g')"
    return x


def grams(x: str, n: int = 3) -> str:
    return f"CASE WHEN {x} = '' THEN [] ELSE list_distinct(list_transform(range(1, greatest(length({x}) - {n - 1}, 1) + 1), lambda i: substr({x}, i, {n}))) END"


REG = f"reg AS ({fixtures.duck(fixtures.REGISTRY)})"
NORM = f"""{REG},
norm0 AS (SELECT *, {norm_text(strip_lead('business_name'))} AS name_norm, {norm_text('business_address')} AS addr_norm, {flags('business_name')} AS name_flags FROM reg),
norm AS (SELECT *, {name_core('name_norm')} AS name_core, {addr_tokens('addr_norm')} AS addr_tok,
  list_sort(list_distinct(list_filter({tokens('addr_norm')}, lambda t: {DIGIT}))) AS addr_nums,
  coalesce(list_filter({tokens('addr_norm')}, lambda t: regexp_matches(t, '^[0-9]{{5,6}}$'))[1], '') AS postal,
  coalesce(list_filter({tokens('addr_norm')}, lambda t: {DIGIT})[1], '') AS first_num FROM norm0)"""


def signature(rich: bool = False) -> str:
    tag = lambda x, k: f"list_transform({x}, lambda t: '{k}' || t)"
    bones = lambda x, k: f"list_transform(list_filter({x}, lambda t: length({skeleton('t')}) > 2 AND {skeleton('t')} <> t), lambda t: '{k}' || {skeleton('t')})"
    parts = [tag("addr_tok", "a:"), tag("name_core", "n:"), bones("name_core", "s:")]
    if rich:
        parts += [tag("list_transform(list_filter(addr_tok, lambda t: length(t) > 4), lambda t: substr(t, 1, 4))", "p:"), bones("addr_tok", "b:")]
    return f"list_distinct(flatten([{', '.join(parts)}]))"


SIG = f"{NORM},\nsig AS (SELECT *, {signature()} AS sig FROM norm)"


def token_join(name: str, clean: str, noisy: str, maxdf: int, r: int) -> str:
    """CTEs ending in name(country, query, id, score, rn): clean and noisy are selects of (country, id, sig)."""
    n = name
    return f"""{n}_i AS (SELECT country, id, unnest(sig) AS token FROM ({clean})),
{n}_n AS (SELECT country, count(*) AS n_doc FROM ({clean}) GROUP BY country),
{n}_d AS (SELECT country, token, count(*) AS df FROM {n}_i GROUP BY country, token HAVING count(*) <= {maxdf}),
{n}_w AS (SELECT country, token, df, ln(n_doc / df) AS idf FROM {n}_d JOIN {n}_n USING (country)),
{n}_x AS (SELECT country, id, token, df, idf FROM {n}_i JOIN {n}_w USING (country, token)),
{n}_l AS (SELECT country, id, sqrt(greatest(count(*), 1)) AS norm FROM {n}_x GROUP BY country, id),
{n}_q AS (SELECT country, id AS query, unnest(sig) AS token FROM ({noisy})),
{n}_r AS (SELECT country, query, token, idf FROM (SELECT *, row_number() OVER (PARTITION BY country, query ORDER BY df, token) AS rn FROM {n}_q JOIN {n}_w USING (country, token)) WHERE rn <= {r} AND (idf > 0 OR rn = 1)),
{n}_s AS (SELECT country, query, x.id, sum(x.idf) AS s FROM {n}_r JOIN {n}_x AS x USING (country, token) GROUP BY country, query, x.id),
{n} AS (SELECT country, query, id, score, row_number() OVER (PARTITION BY country, query ORDER BY score DESC, id) AS rn
  FROM (SELECT country, query, id, round(s / norm, 6) AS score FROM {n}_s JOIN {n}_l USING (country, id)))"""


def side(where: str, sig: str = "sig") -> str:
    return f"SELECT country, entity_id AS id, {sig} AS sig FROM sig WHERE {where}"


REV = f"""{SIG},
{token_join('rk', side('source = 1'), side('source > 1'), 60000, 28)},
rev AS (SELECT rk.country, source, rk.id AS s1_id, query AS cand_id, score AS block_score, rn, owner FROM rk JOIN sig ON entity_id = query WHERE rn <= CASE WHEN len(addr_tok) <= 2 THEN 18 ELSE 3 END)"""


def overlap(short: str, col: str, some: str) -> str:
    inter, n1, n2 = f"len(list_intersect(a.{col}, b.{col}))", f"len(a.{col})", f"len(b.{col})"
    made = {"inter": inter, "jac": f"{inter} / greatest({n1} + {n2} - {inter}, 1)", "cont": f"{inter} / greatest(least({n1}, {n2}), 1)", "n1": n1, "n2": n2}
    return ", ".join(f"{made[k]} AS {short}_{k}" for k in some.split())


def three_way(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' OR {b} = '' THEN -1 ELSE CAST({a} = {b} AS INT) END"


def acronym(x: str) -> str:
    return f"array_to_string(list_transform({x}, lambda t: substr(t, 1, 1)), '')"


PAIRS = f"""{REV},
w AS (SELECT f.country, f.token, f.field, f.df, ln((n + 1) / (f.df + 1)) AS idf FROM (
  SELECT country, token, field, count(*) AS df FROM (SELECT country, unnest(name_core) AS token, 'n' AS field FROM norm WHERE source = 1 UNION ALL SELECT country, unnest(addr_tok), 'a' FROM norm WHERE source = 1) GROUP BY ALL) AS f
  JOIN (SELECT country, count(*) AS n FROM norm WHERE source = 1 GROUP BY country) USING (country)),
p0 AS (SELECT r.country, r.source, s1_id, cand_id, block_score, 1 AS pass_id, r.owner, a.name_core AS a_core, b.name_core AS b_core, a.addr_tok AS a_addr, b.addr_tok AS b_addr, a.first_num AS a_num, b.first_num AS b_num,
  {overlap('name', 'name_core', 'inter jac cont n1 n2')}, {overlap('addr', 'addr_tok', 'inter jac cont n1 n2')}, {overlap('num', 'addr_nums', 'inter jac')},
  {three_way('a.postal', 'b.postal')} AS postal_cmp, b.name_flags & 1 AS cand_indic, (b.name_flags >> 1) & 1 AS cand_nonascii, (b.name_flags >> 2) & 1 AS cand_url,
  CAST(len(b.addr_tok) = 0 AS INT) AS cand_addr_empty, length(a.name_norm) AS name_len1, length(b.name_norm) AS name_len2,
  round(len(list_intersect({grams('a.name_norm')}, {grams('b.name_norm')})) / sqrt(greatest(len({grams('a.name_norm')}), 1) * greatest(len({grams('b.name_norm')}), 1)), 6) AS name_tri_cos,
  CASE WHEN {acronym('a.name_core')} <> '' AND {acronym('a.name_core')} = {acronym('b.name_core')} THEN 2
    WHEN ({acronym('a.name_core')} <> '' AND {acronym('a.name_core')} = replace(b.name_norm, ' ', '')) OR ({acronym('b.name_core')} <> '' AND {acronym('b.name_core')} = replace(a.name_norm, ' ', '')) THEN 1 ELSE 0 END AS acronym_match,
  {three_way('a.first_num', 'b.first_num')} AS house_eq
  FROM rev AS r JOIN norm AS a ON a.entity_id = s1_id JOIN norm AS b ON b.entity_id = cand_id),
p1 AS (SELECT *, round(addr_jac + name_jac, 9) AS total FROM p0),
p AS (SELECT *, count(*) OVER own AS n_cand, rank() OVER (own ORDER BY addr_jac DESC) AS rank_addr, rank() OVER (own ORDER BY name_jac DESC) AS rank_name, rank() OVER (own ORDER BY total DESC) AS rank_total,
  round(addr_jac - max(addr_jac) OVER own, 6) AS addr_gap_best, round(name_jac - max(name_jac) OVER own, 6) AS name_gap_best, round(total - max(total) OVER own, 6) AS total_gap_best,
  count(*) OVER rec AS rev_n, rank() OVER (rec ORDER BY total DESC) AS rev_rank, round(total - max(total) OVER rec, 6) AS rev_gap_best,
  round(addr_jac - max(addr_jac) OVER rec, 6) AS rev_gap_addr, round(name_jac - max(name_jac) OVER rec, 6) AS rev_gap_name,
  round(CASE WHEN row_number() OVER (rec ORDER BY total DESC, s1_id) = 1 THEN coalesce(total - lead(total) OVER (rec ORDER BY total DESC, s1_id), 0.0) ELSE 0.0 END, 6) AS rev_margin_2nd
  FROM p1 WINDOW own AS (PARTITION BY country, source, s1_id), rec AS (PARTITION BY country, source, cand_id))"""

SCORED = f"scored AS ({fixtures.duck(fixtures.SCORED)})"
#: Entities of the scored pairs with how many true pairs each has, entities without any included.
ENTITIES = "ents AS (SELECT c_custkey AS s1_id, coalesce(n, 0) AS n_true FROM customer LEFT JOIN (SELECT s1_id, sum(y) AS n FROM scored GROUP BY s1_id) ON c_custkey = s1_id)"


def f_beta(pred: str, true: str, tp: str) -> str:
    p, r = f"(CASE WHEN {pred} > 0 THEN {tp} / {pred} ELSE 0.0 END)", f"(CASE WHEN {true} > 0 THEN {tp} / {true} ELSE 0.0 END)"
    d = f"(0.25 * {p} + {r})"
    return f"CASE WHEN {pred} = 0 AND {true} = 0 THEN 1.0 WHEN {d} > 0 THEN 1.25 * {p} * {r} / {d} ELSE 0.0 END"


def bucket(x: str) -> str:
    return f"(((CAST({x} AS BIGINT) * 2654435761) & 4294967295) >> 13) % 100"


def select(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"
