"""Matching printed column headers to canonical names: plain Python over the few headers of a table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.similarity import token_set

# Words by which a header names a canonical column, in the order they are tried.
SYNONYMS: dict[str, tuple[str, ...]] = {
    "sr_no": (r"^s\.?\s*r?\.?\s*no", r"^#$", r"^serial"),
    "folio_no": ("folio", "ledger", "member id", "l/f no"),
    "demat_account": ("demat", "dp id", "client id", "dp/cl", "beneficiary"),
    "pincode": (r"\bpin", "postal code", r"\bzip"),
    "state": (r"\bstate", "region"),
    "address": ("address", r"\baddr", "residence"),
    "nominee": ("nomin",),
    "father_husband_name": ("father", "husband"),
    "name": ("name of holder", "shareholder", "investor", "member name", "first named holder", r"^name$", "holder name"),
    "current_holding": ("holding", r"\bshares", r"\bunits", r"\bqty"),
    "total_dividend": ("amount", r"\bamt", "payable", "unpaid"),
    "pan_number": (r"\bpan\b",),
    "email_id": ("mail",),
    "mobile_number": ("mobile", "phone", "contact"),
}
_FY = re.compile(r"(20\d\d)\s*-\s*(20\d\d|1\d|\d\d)")


def map_header(header: str) -> str | None:
    """The first canonical name one of whose patterns occurs in the header."""
    low = " ".join(header.lower().split())
    for name, patterns in SYNONYMS.items():
        if any(re.search(p, low) for p in patterns):
            return name
    return None


def fy_header(header: str) -> str | None:
    """dividend_[kind_]fy_YYYY_YY of a header that names money of a year."""
    flat = " ".join(header.split())
    m = _FY.search(flat)
    if not m or not re.search(r"divid|div\b|amount|amt|unclaimed|unpaid", flat, re.I):
        return None
    kind = next((k for k in ("interim", "final", "special") if k in flat.lower()), "")
    return f"dividend_{kind + '_' if kind else ''}fy_{m[1]}_{m[2][-2:]}"


def canonical_names(headers: list[str]) -> tuple[list[str | None], list[str]]:
    """(names, issues): each header's column name; the first to claim one keeps it, later years get a number.

    None for headers to drop; each is told among the issues.
    """
    taken: dict[str, int] = {}
    out: list[str | None] = []
    issues = []
    for h in headers:
        year = fy_header(h)
        name = year or map_header(h)
        if name is None or (name in taken and not year):
            issues.append(h)
            out.append(None)
            continue
        taken[name] = taken.get(name, -1) + 1
        out.append(name if not taken[name] else f"{name}_{taken[name]}")
    return out, issues


def map_alias(header: str, aliases: dict[str, list[str]], least: float = 80.0) -> str | None:
    """Exact alias without case, a canonical name itself, a year, else the best token-set score of at least least."""
    low = " ".join(header.lower().split())
    exact = {a.lower(): name for name, names in aliases.items() for a in names}  # a later name overrides
    if low in exact:
        return exact[low]
    if low in aliases:
        return low
    if year := fy_header(header):
        return year
    best = max(((token_set(low, a), -i, name) for i, (a, name) in enumerate(exact.items())), default=(0.0, 0, None))
    return best[2] if best[0] >= least else None


def rename(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """The table under canonical names, and the headers that were dropped."""
    names, issues = canonical_names(df.columns)
    return df.toDF(*[f"__{i}" for i in range(len(names))]).select(*[F.col(f"__{i}").alias(n) for i, n in enumerate(names) if n]), issues


def probe(df: DataFrame, candidates: list[str]) -> str | None:
    """The first candidate there is among the columns, letter case aside."""
    by = {c.lower(): c for c in df.columns}
    return next((by[c.lower()] for c in candidates if c.lower() in by), None)


def header_column(header: Column) -> Column:
    """map_header as an expression, for tables that hold headers as values."""
    low = F.lower(F.trim(F.regexp_replace(header, r"\s+", " ")))
    out = F.lit(None).cast("string")
    for name, patterns in reversed(SYNONYMS.items()):
        out = F.when(low.rlike("|".join(f"({p})" for p in patterns)), name).otherwise(out)
    return out
