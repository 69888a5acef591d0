"""Normal forms of the fields printed in dividend registers, as native expressions.

All functions take a Column or a column name and return a Column; null in, null out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


#: A financial year in any printed form: FY14-15, F.Y. 2014-2015, 2014_15, 2014 - 15.
FY_PATTERN = r"(?<!\d)(\d{4}|\d{2})\s*[-/_‐-―]\s*(\d{4}|\d{2})(?!\d)"


def fy_start(year: Column | str) -> Column:
    """First calendar year of a printed financial year; null where none can be read.

    The second year must follow the first, otherwise the text is not a financial year.
    """
    y = _c(year)
    a = F.regexp_extract(y, FY_PATTERN, 1)
    b = F.regexp_extract(y, FY_PATTERN, 2)
    start = F.when(F.length(a) == 4, a.try_cast("int")).when(F.length(a) == 2, 2000 + a.try_cast("int"))
    ok = (start + 1) % 100 == b.try_cast("int") % 100
    return F.when(ok & start.between(1900, 2100), start)


def fy_label(start: Column) -> Column:
    """YYYY-YY of a first calendar year."""
    return F.format_string("%d-%02d", start, (start + 1) % 100)


def folio_key(folio: Column | str) -> Column:
    """Normal form of a folio number: no label, separators, padding zeros; the letter O among digits is 0.

    Null where nothing is left.
    """
    # One chain of replacements, so that nothing is computed twice.
    s = F.regexp_replace(F.upper(_c(folio)), r"[^A-Z0-9]", "")
    s = F.regexp_replace(s, r"^(FOLIO(NO)?|(NA|NIL|NONE|NULL)$)", "")
    s = F.regexp_replace(s, r"O(?=[0-9O]*[0-9][0-9O]*$)|(?<=[0-9]O{0,8})O(?=O*$)", "0")
    return F.nullif(F.regexp_replace(s, r"^([A-Z]*)0+(?=[0-9]+$)", "$1"), F.lit(""))


def company_key(company: Column | str) -> Column:
    """Normal form of a company: lower case, no bracketed addition, no legal form."""
    s = F.regexp_replace(F.lower(_c(company)), r"\([^)]*\)", " ")
    s = F.trim(F.regexp_replace(s, r"[^\p{L}\p{N}]+", " "))
    s = F.regexp_replace(s, r"( (private|pvt|co|company|limited|ltd|lmtd|ltd))+$", "")
    return F.when(s != "", s)


def demat_digits(demat: Column | str) -> Column:
    """Digits of a demat number (an account may be printed in full, masked or by its client part)."""
    d = F.regexp_replace(_c(demat), r"[^0-9]", "")
    return F.when(F.length(d) >= 8, d)


def demat_client(demat: Column | str) -> Column:
    """The last eight digits: the client part, present in every printed form."""
    d = demat_digits(demat)
    return F.when(d.isNotNull(), F.substring(d, -8, 8))
