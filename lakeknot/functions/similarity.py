"""Set and string similarities of record pairs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def overlap(a: Column, b: Column) -> dict[str, Column]:
    """inter, jac, cont, n1, n2 of two arrays of distinct words."""
    inter, n1, n2 = F.size(F.array_intersect(a, b)), F.size(a), F.size(b)
    return {"inter": inter, "jac": inter / F.greatest(n1 + n2 - inter, F.lit(1)), "cont": inter / F.greatest(F.least(n1, n2), F.lit(1)), "n1": n1, "n2": n2}


def cosine(a: Column, b: Column) -> Column:
    """Of two sets: shared over the root of the product of sizes."""
    one = F.lit(1)
    return F.size(F.array_intersect(a, b)) / F.sqrt(F.greatest(F.size(a), one) * F.greatest(F.size(b), one))


def three_way(a: Column, b: Column) -> Column:
    """1 equal, 0 different, -1 where either is missing."""
    return F.when((a == "") | (b == ""), -1).otherwise((a == b).cast("int"))


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits of one number (H. Hyyro's recurrence)."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    rest = full
    for c in b:
        hit = rest & where.get(c, 0)
        rest = (rest + hit | rest - hit) & full
    return len(a) - rest.bit_count()


def ratio(a: str, b: str) -> float:
    """100 times twice the common subsequence over both lengths; two empty texts are equal."""
    return 100.0 * 2 * common_subsequence(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not left or not right):
        return 100.0
    one, two = f"{both} {left}".strip(), f"{both} {right}".strip()
    best = ratio(one, two)
    return max(best, ratio(both, one), ratio(both, two)) if both else best


FUZZY = "fuzz_name_set double, fuzz_name_core double, fuzz_addr_sort double, skel_ratio double, nospace_ratio double"


def fuzzy_udf():
    """All string similarities of a pair in one Arrow pass."""

    @F.pandas_udf(FUZZY)
    def fuzzy(n1: pd.Series, n2: pd.Series, c1: pd.Series, c2: pd.Series, a1: pd.Series, a2: pd.Series, s1: pd.Series, s2: pd.Series, p1: pd.Series, p2: pd.Series) -> pd.DataFrame:
        def each(f, x, y):
            return [f(a, b) for a, b in zip(x, y, strict=True)]

        return pd.DataFrame({"fuzz_name_set": each(token_set_ratio, n1, n2), "fuzz_name_core": each(ratio, c1, c2), "fuzz_addr_sort": each(token_sort_ratio, a1, a2), "skel_ratio": each(token_sort_ratio, s1, s2), "nospace_ratio": each(ratio, p1, p2)})

    return fuzzy


def ratio_udf():
    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in parts:
            yield pd.Series([ratio(x or "", y or "") for x, y in zip(a, b, strict=True)])

    return score
