"""Text normalisation as native column expressions.

Missing text counts as empty text everywhere: a NULL or '' input gives '' or an empty array, never NULL.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab


def text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


@cache
def _single() -> tuple[str, str]:
    """Latin letters that fold to one ASCII letter, and these."""
    some = {c: v for c, v in vocab.fold_table().items() if len(v) == 1 and ord(c) < 0x180}
    return "".join(some), "".join(some.values())


@cache
def _others() -> dict[str, str]:
    single = set(_single()[0])
    return {c: v for c, v in vocab.fold_table().items() if c not in single}


#: Letters of over one ASCII letter that are common enough to be replaced before the others.
PLAIN = "ßÆæŒœÞþ"


def once(c: Column, f) -> Column:
    """f of c, with c evaluated a single time."""
    return F.transform(F.array(c), f)[0]


def table(of: dict[str, str]) -> Column:
    """A map as one literal, so that plans stay small; no key or value may hold a tab or a line break."""
    return F.str_to_map(F.lit("\n".join(f"{k}\t{v}" for k, v in of.items())), F.lit("\n"), F.lit("\t"))


def one_of(t: Column, words) -> Column:
    return F.array_contains(F.split(F.lit(" ".join(words)), " "), t)


def ascii_fold(c: Column) -> Column:
    """ASCII text: Latin letters lose their marks, Indic letters are romanised, what else is not ASCII goes."""
    plain = F.translate(c, *_single())
    for x in PLAIN:
        plain = F.replace(plain, F.lit(x), F.lit(_others()[x]))
    # the rest, letter by letter, and only where there is any
    letters = table({x: v for x, v in _others().items() if x not in PLAIN})
    spelled = lambda x: F.array_join(F.transform(F.split(x, ""), lambda y: F.when(y <= "\x7f", y).otherwise(F.coalesce(letters[y], F.lit("")))), "")
    return once(plain, lambda x: F.when(x.rlike(r"[^\x00-\x7F]"), spelled(x)).otherwise(x))


#: What any junk begins with: looked at first, so that not every letter is held against all kinds of junk.
JUNK_FIRST = r"(?=[(.<hw]|\b[dmt])"


def norm_text(c: Column) -> Column:
    """Lower-case ASCII words with single blanks, without junk."""
    low = F.lower(ascii_fold(c))
    return F.trim(F.regexp_replace(F.regexp_replace(low, f"(?i){JUNK_FIRST}(?:{vocab.JUNK})", " "), "[^a-z0-9]+", " "))


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda t: t != "")


def strip_lead(c: Column) -> Column:
    """Without leading marks and honorifics."""
    return F.regexp_replace(F.trim(c), "(?i)" + vocab.LEAD, "")


def name_flags(c: Column) -> Column:
    """1: an Indic letter, 2: not all ASCII, 4: looks like a web address."""
    bit = lambda p, n: F.when(c.rlike(p), n).otherwise(0)
    return (bit(vocab.INDIC, 1) + bit(r"[^\x00-\x7F]", 2) + bit("(?i)" + vocab.URLISH, 4)).cast("tinyint")


def name_core(norm: Column) -> Column:
    """The sorted distinct words but legal forms and single letters; all words if none is left."""
    core = lambda every: F.filter(every, lambda t: ~one_of(t, vocab.LEGAL) & (F.length(t) > 1))
    return once(F.array_sort(F.array_distinct(tokens(norm))), lambda every: once(core(every), lambda x: F.when(F.size(x) > 0, x).otherwise(every)))


def addr_tokens(norm: Column) -> Column:
    """Distinct address words in order: those with a digit as they are; of the others no stop words, states as @code, street types in short form, none under two letters."""
    states, streets = table(vocab.STATE), table(vocab.STREET)
    digit = lambda t: t.rlike("[0-9]")
    kept = F.filter(tokens(norm), lambda t: digit(t) | ~one_of(t, vocab.ADDR_STOP))

    def short(t: Column) -> Column:
        code = states[t]
        return F.when(digit(t), t).when(code == "", F.lit("")).when(code.isNotNull(), F.concat(F.lit("@"), code)).otherwise(F.coalesce(streets[t], t))

    return F.array_distinct(F.filter(F.transform(kept, short), lambda t: digit(t) | (F.length(t) >= 2)))


def addr_nums(norm: Column) -> Column:
    """Distinct words with a digit, in order."""
    return F.array_distinct(F.filter(tokens(norm), lambda t: t.rlike("[0-9]")))


def postal(norm: Column) -> Column:
    """The first word of five or six digits, or ''."""
    return F.coalesce(F.try_element_at(F.filter(tokens(norm), lambda t: t.rlike("^[0-9]{5,6}$")), F.lit(1)), F.lit(""))


def first_num(norm: Column) -> Column:
    """The first word with a digit, or ''."""
    return F.coalesce(F.try_element_at(F.filter(tokens(norm), lambda t: t.rlike("[0-9]")), F.lit(1)), F.lit(""))


def skeleton(t: Column) -> Column:
    """Without vowels, runs of a letter once."""
    return F.regexp_replace(F.regexp_replace(t, "[aeiou]", ""), r"(.)\1+", "$1")


def skeletons(words: Column) -> Column:
    return F.array_join(F.transform(words, skeleton), " ")


def prefixes(words: Column, n: int = 4) -> Column:
    return F.array_distinct(F.transform(words, lambda t: F.substring(t, 1, n)))


def nospace(norm: Column) -> Column:
    return F.replace(norm, F.lit(" "), F.lit(""))


def acronym(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda t: F.substring(t, 1, 1)), "")


def char_ngrams(s: Column, n: int = 3) -> Column:
    """Distinct runs of n letters; a shorter text is its own."""
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - (n - 1), F.lit(1))), lambda i: s.substr(i, F.lit(n)))
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.array_distinct(runs))


def house_digits(num: Column) -> Column:
    """The digits that a house number starts with, without leading zeros, or ''."""
    return F.regexp_extract(num, "^0*([0-9]+)", 1)


def house_number(num: Column) -> Column:
    """As a number; -1 without one (or with more digits than a long holds)."""
    return F.coalesce(house_digits(num).try_cast("bigint"), F.lit(-1).cast("bigint"))


def pair_text(name: Column, addr: Column) -> Column:
    return F.when(addr == "", F.concat(name, F.lit(" |"))).otherwise(F.concat(name, F.lit(" | "), addr))


def token_hash(t: Column, bits: int = 22) -> Column:
    """A stable hash of a token."""
    return F.crc32(t.cast("binary")).bitwiseAND((1 << bits) - 1)


def normalized(records):
    """records (entity_id, source, country, business_name, business_address, ...) with the normalised columns."""
    stripped = strip_lead(text("business_name"))
    out = records.withColumns({"name_norm": norm_text(stripped), "addr_norm": norm_text(text("business_address")), "name_flags": name_flags(text("business_name"))})
    return out.withColumns({"name_core": name_core(F.col("name_norm")), "addr_tok": addr_tokens(F.col("addr_norm")), "addr_nums": addr_nums(F.col("addr_norm")), "postal": postal(F.col("addr_norm")), "first_num": first_num(F.col("addr_norm"))})
