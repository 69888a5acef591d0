"""Fuzzy string scores on 0-100: normalised insert/delete similarity, token sort and token set.

ratio = 100 * 2 * LCS / (|a| + |b|), LCS the longest common subsequence. The scores run in
Arrow-batched workers with Hyyrö's bit-parallel LCS; lcs_native is the same as a Catalyst
expression, kept as their test oracle and for small inputs.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over the shorter string."""
    if len(a) > len(b):
        a, b = b, a
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & where.get(ch, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


def plain(a: str, b: str) -> float:
    n = len(a) + len(b)
    return 100.0 if n == 0 else 200.0 * lcs(a, b) / n


def token_sort(a: str, b: str) -> float:
    return plain(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """100 if one word set holds the other and they meet; else the best of three ratios around the shared words."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, dx, dy = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not dx or not dy):
        return 100.0
    s, p, q = " ".join(both), " ".join(dx), " ".join(dy)
    best = plain(p, q) if not both else 0.0
    if both:
        sp, sq = f"{s} {p}".strip(), f"{s} {q}".strip()
        best = max(plain(sp, sq), plain(s, sp), plain(s, sq))
    return best


def _udf(f, name: str):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        memo: dict[tuple, float] = {}
        out = []
        for p, q in zip(a, b):
            if p is None or q is None:
                out.append(None)
                continue
            k = (p, q)
            v = memo.get(k)
            if v is None:
                v = memo[k] = f(p, q)
            out.append(v)
        return pd.Series(out, dtype="float64")

    run.__name__ = name
    return F.pandas_udf(run, "double")


def ratio(a: Column, b: Column) -> Column:
    return _udf(plain, "ratio")(a, b)


def token_sort_ratio(a: Column, b: Column) -> Column:
    return _udf(token_sort, "token_sort_ratio")(a, b)


def token_set_ratio(a: Column, b: Column) -> Column:
    return _udf(token_set, "token_set_ratio")(a, b)


def sorted_tokens(s: Column) -> Column:
    """Words in order, joined by one blank: token_sort_ratio is the ratio of two of these."""
    return F.array_join(F.array_sort(F.filter(F.split(F.trim(s), r"\s+"), lambda w: w != "")), " ")


def length_bound(a: Column, b: Column) -> Column:
    """Upper bound of the ratio from the lengths alone: cuts pairs before any score is computed."""
    n = F.length(a) + F.length(b)
    return F.when(n == 0, 100.0).otherwise(200.0 * F.least(F.length(a), F.length(b)) / n)


def lcs_native(a: Column, b: Column) -> Column:
    """Longest common subsequence as an aggregate over an array of row states, inside Catalyst."""
    chars = lambda s: F.filter(F.split(s, ""), lambda x: x != "")
    y = chars(b)
    start = F.transform(F.sequence(F.lit(0), F.length(b)), lambda i: F.lit(0))

    def step(row: Column, ch: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.greatest(F.size(y), F.lit(1))),
            F.array(F.lit(0)),
            lambda new, j: F.concat(
                new,
                F.array(
                    F.when(F.coalesce(F.get(y, j - 1) == ch, F.lit(False)), F.coalesce(F.get(row, j - 1), F.lit(0)) + 1).otherwise(
                        F.greatest(F.coalesce(F.get(row, j), F.lit(0)), F.coalesce(F.get(new, j - 1), F.lit(0)))
                    )
                ),
            ),
        )

    return F.element_at(F.aggregate(chars(a), start, step), -1)
