"""License scans: an exact set-similarity join of text blocks with license templates, in DataFrame functions alone.

A template of n words meets blocks of its own length class: windows of 2 * STEP words at every STEP words, STEP being
the next power of two from n (8 at least), so any phrase of n words lies whole in one. A block meets a template when
it holds at least CONTAINMENT of the template's distinct words, and no fewer than FLOOR of them (all, if it has fewer),
or a few common words near each other would be a license. Tokens are ordered by their counts over all documents,
rarest first. Only a template's prefix (size - need + 1 rarest tokens) can open a candidate; the length filter drops
blocks with fewer template words than needed, the positional filter drops those whose tokens after the shared one
cannot reach the need; the rest are verified. Whole texts without any prefix token are passed over by one regular
expression, which loses nothing: a block that meets a template holds one of its prefix tokens.

The templates are a fixed list, so the token counts, prefixes and orders (at most as many rows as the templates
have words) are literals of the plan; blocks are grouped by (doc_id, class, block), which no key makes large.

Null texts are empty: no words, no labels, score 0; a text of any length is scanned whole; rows that share a doc_id share
their labels; rows with a null id match each other alone; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, text_col

CONTAINMENT, FLOOR, SHORTEST = 0.8, 6, 8
#: Phrases and the labels they give, each place counted.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Template label: its words, as public licenses and notices state them.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "apache-2.0-notice": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-2-clause-text": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-3.0-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mit-notice": "released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words, as a class of Java's and RE2's expressions.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def need(words: set[str]) -> int:
    return max(ceil(CONTAINMENT * len(words) - 1e-9), min(len(words), FLOOR))


def step(words: str) -> int:
    """The length class of a template."""
    return max(SHORTEST, 1 << (len(words.split()) - 1).bit_length())


def normal(text: Column) -> Column:
    """The words with one blank before, between and after; without words one blank."""
    return F.concat(F.lit(" "), F.ltrim(F.regexp_replace(F.concat(F.translate(text, UPPER, LOWER), F.lit(" ")), GAP, " ")))


def blanks(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _places() -> str:
    return " (?:" + "|".join(PHRASES) + ")(?= )"


def token_counts(norm: DataFrame, tokens: list[str]) -> dict[str, int]:
    """Counts of the template tokens over all documents; at most len(tokens) rows come back."""
    found = norm.select(F.explode(F.regexp_extract_all("norm", F.lit("(?<= )(?:" + "|".join(tokens) + ")(?= )"), F.lit(0))).alias("token"))
    return {r["token"]: r["n"] for r in found.groupBy("token").agg(F.count("*").alias("n")).collect()}


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and matches: (label, first_word, words, containment) of every block found."""
    templates = templates or TEMPLATES
    sets = {label: set(words.split()) for label, words in sorted(templates.items())}
    tokens = sorted(set().union(*sets.values()))
    norm = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_col()).select("doc_id", normal(F.col("text")).alias("norm"))
    count = token_counts(norm, tokens)
    order = sorted(tokens, key=lambda t: (count.get(t, 0), t))
    rank = {t: k for k, t in enumerate(order)}

    # positions of the template tokens in each block, as ranks in the global order
    steps = {label: step(words) for label, words in templates.items()}
    prefix = [(label, steps[label], rank[t], at, len(s), need(s)) for label, s in sets.items() for at, t in enumerate(sorted(s, key=rank.get)[: len(s) - need(s) + 1])]
    openers = sorted({order[p[2]] for p in prefix})
    classes = {t: sorted({steps[label] for label, s in sets.items() if t in s}) for t in order}
    known = F.create_map(*[x for t in order for x in (F.lit(t), F.struct(F.lit(rank[t]).alias("rank"), F.array(*map(F.lit, classes[t])).alias("steps")))])
    some = norm.where(F.col("norm").rlike(" (?:" + "|".join(openers) + ") "))
    words = some.select("doc_id", F.posexplode(F.split(F.trim("norm"), " ")).alias("at", "word")).where(F.col("word").isin(tokens))
    classed = words.select("doc_id", "at", known[F.col("word")].alias("k")).select("doc_id", "at", "k.rank", F.explode("k.steps").alias("step"))
    last = F.floor(F.col("at") / F.col("step")).cast("long")
    placed = classed.select("doc_id", "step", "rank", F.explode(F.sequence(F.greatest(last - 1, F.lit(0)), last)).alias("block"))
    blocks = placed.groupBy("doc_id", "step", "block").agg(F.array_sort(F.collect_set("rank")).alias("tokens"))
    spark = docs.sparkSession
    index = spark.createDataFrame(prefix, "label string, step int, rank int, at int, size int, need int")
    whole = F.create_map(*[x for label, s in sets.items() for x in (F.lit(label), F.array(*[F.lit(rank[t]) for t in sorted(s, key=rank.get)]))])
    # only template tokens of its own class are in a block, so its size bounds what a template can share with it
    opened = blocks.select("doc_id", "step", "block", "tokens", F.posexplode("tokens").alias("pos", "rank")).join(F.broadcast(index), ["step", "rank"])
    passed = opened.where((F.size("tokens") >= F.col("need")) & (F.least(F.size("tokens") - F.col("pos"), F.col("size") - F.col("at")) + F.least(F.col("pos"), F.col("at")) >= F.col("need")))
    shared = F.size(F.array_intersect("tokens", whole[F.col("label")]))
    met = passed.select("doc_id", "step", "block", "label", "need", "size", shared.alias("shared")).where(F.col("shared") >= F.col("need")).distinct()
    found = met.groupBy("doc_id").agg(F.collect_set("label").alias("found"), F.max(F.col("shared") / F.col("size")).alias("best"), F.array_sort(F.collect_list(F.struct("label", (F.col("block") * F.col("step")).alias("first_word"), (2 * F.col("step")).alias("words"), (F.col("shared") / F.col("size")).alias("containment")))).alias("matches"))

    n_base = F.regexp_count("norm", F.lit(_places()))
    base = norm.select("doc_id", (blanks(F.col("norm")) - 1).cast("long").alias("n_words"), n_base.cast("long").alias("n_base"), F.when(n_base > 0, F.col("norm")).alias("hit"))
    first = blanks(F.regexp_extract("hit", "(?s)^(.*?)" + _places(), 1))
    final = blanks(F.regexp_extract("hit", "(?s)^(.*)" + _places(), 1))
    labels = F.filter(F.array(*[F.when(F.col("hit").rlike(f" {p} "), F.lit(x)) for p, x in PHRASES.items()]), lambda x: x.isNotNull())
    base = base.select("doc_id", "n_words", "n_base", first.cast("long").alias("first_word"), final.cast("long").alias("last_word"), F.coalesce(labels, F.array().cast("array<string>")).alias("base"))
    f = found.withColumnRenamed("doc_id", "found_id")
    out = base.join(f, base["doc_id"].eqNullSafe(f["found_id"]), "left")
    text = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    none = F.array().cast("array<string>")
    score = F.round(F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.lit(0.0))), 6)
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", text(F.col("base")).alias("base_labels"), text(F.concat("base", F.coalesce("found", none))).alias("labels"), score.alias("score"), "matches")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents")).drop("matches")


def oracle(templates: dict[str, str] | None = None) -> str:
    """DuckDB SQL by brute force: every block against every template."""
    sets = {label: sorted(set(words.split())) for label, words in sorted((templates or TEMPLATES).items())}
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    steps = {label: step(words) for label, words in (templates or TEMPLATES).items()}
    rows = ", ".join(f"({quoted(label)}, [{', '.join(map(quoted, s))}], {need(set(s))}, {steps[label]})" for label, s in sets.items())
    starts = " + ".join(f"len(list_filter(range(1, len(w) + 1), lambda i: {' AND '.join(f'w[i + {k}] = {quoted(x)}' for k, x in enumerate(p.split()))}))" for p in PHRASES)
    places = " OR ".join("(" + " AND ".join(f"w[i + {k}] = {quoted(x)}" for k, x in enumerate(p.split())) + ")" for p in PHRASES)
    base = ", ".join(f"CASE WHEN len(list_filter(range(1, len(w) + 1), lambda i: {' AND '.join(f'w[i + {k}] = {quoted(x)}' for k, x in enumerate(p.split()))})) > 0 THEN {quoted(x)} END" for p, x in [(p, x) for p, x in PHRASES.items()])
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT * FROM (VALUES {rows}) AS v(label, tokens, need, step)),
c AS (SELECT DISTINCT step FROM t),
b AS (SELECT doc_id, step, unnest(range(0, greatest(1, CAST(ceil(len(w) / CAST(step AS DOUBLE)) AS BIGINT)))) AS block, w FROM d, c),
s AS (SELECT doc_id, step, block, w[block * step + 1 : block * step + 2 * step] AS words FROM b),
m AS (SELECT doc_id, label, len(list_intersect(words, tokens)) / len(tokens) AS c FROM s JOIN t USING (step) WHERE len(list_intersect(words, tokens)) >= need),
f AS (SELECT doc_id, list(DISTINCT label) AS found, max(c) AS best FROM m GROUP BY doc_id),
n AS (SELECT doc_id, len(w) AS n_words, {starts} AS n_base, list_filter(range(1, len(w) + 1), lambda i: {places}) AS places, list_filter([{base}], lambda x: x IS NOT NULL) AS base FROM d)
SELECT n.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_base AS BIGINT) AS n_base, list_min(places) - 1 AS first_word, list_max(places) - 1 AS last_word,
  array_to_string(list_sort(base), ',') AS base_labels, array_to_string(list_sort(list_distinct(list_concat(base, coalesce(found, [])))), ',') AS labels,
  round(greatest(coalesce(best, 0.0), CASE WHEN n_base > 0 THEN 1.0 ELSE 0.0 END), 6) AS score
FROM n LEFT JOIN f ON n.doc_id IS NOT DISTINCT FROM f.doc_id"""
