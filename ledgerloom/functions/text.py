"""Scalar functions for dirty register text, as native expressions.

Every function takes a Column (or a name) and returns a Column; nothing runs in Python workers.
Unless stated otherwise a null gives the empty value the register tools use ('' or 0), so that
callers who want nulls must ask before.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def title_case(s: Column | str) -> Column:
    """Upper case after any character that is no letter (D.K., O'Neil, Mc2Donald), unlike initcap."""
    return F.array_join(F.transform(F.regexp_extract_all(_c(s), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1), F.initcap), "")


def clean_name(s: Column | str) -> Column:
    """Drops up to four leading words that carry digits, keeping a fragment of two letters or more after the last digit.

    Closed form of the loop "while the first of at most four words has a digit": the first of
    the first four words that has no digit or leaves a fragment ends it.
    """
    words = F.filter(F.split(F.upper(F.trim(F.coalesce(_c(s), F.lit("")))), r"\s+"), lambda w: w != "")
    head = F.slice(words, 1, 4)
    tail = F.transform(head, lambda w: F.regexp_extract(w, r"([^0-9]*)$", 1))
    stops = F.transform(head, lambda w: (~w.rlike("[0-9]")) | (F.length(F.regexp_extract(w, r"([^0-9]*)$", 1)) >= 2))
    at = F.array_position(stops, F.lit(True)).cast("int")
    kept = F.when(at == 0, F.slice(words, 5, F.greatest(F.size(words), F.lit(1)))).otherwise(
        F.concat(F.array(F.get(tail, at - 1)), F.slice(words, at + 1, F.greatest(F.size(words), F.lit(1))))
    )
    return F.when(F.size(words) == 0, "").otherwise(title_case(F.array_join(kept, " ")))


def squeeze(s: Column | str) -> Column:
    """Trimmed, runs of white space as one blank; null stays null."""
    return F.trim(F.regexp_replace(_c(s), r"\s+", " "))


def join_address(parts: list[Column | str]) -> Column:
    """Non-blank parts, each squeezed, joined by comma and blank."""
    arr = F.transform(F.array(*[F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts]), squeeze)
    return F.array_join(F.filter(arr, lambda x: x != ""), ", ")


_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def try_double(s: Column) -> Column:
    """A number as a plain reader takes it (no type suffixes); null otherwise."""
    return F.when(s.rlike(_NUMBER), s.try_cast("double"))


def parse_amount(s: Column | str) -> Column:
    """Rupee signs, commas and blanks between digits ("3 9 2 . 0 0") off; 0.0 where no number is left."""
    t = F.trim(F.regexp_replace(_c(s), "[₹,]", ""))
    t = F.regexp_replace(F.regexp_replace(t, r"(?<=[\d.]) (?=[\d.])", ""), r"^\s+|\s+$", "")
    return F.coalesce(try_double(t), F.lit(0.0))


def to_float(s: Column | str) -> Column:
    """All blanks, commas and rupee signs off; 0.0 on failure."""
    return F.coalesce(try_double(F.regexp_replace(_c(s), r"[₹,\s]", "")), F.lit(0.0))


def to_int(s: Column | str) -> Column:
    """As to_float, truncated towards zero."""
    return to_float(s).cast("long")


def clean_text(s: Column | str, title: bool = False) -> Column:
    """Squeezed; with title, characters but letters, digits, blank, . ' and - dropped and title case."""
    t = squeeze(F.coalesce(_c(s), F.lit("")))
    if not title:
        return t
    return title_case(F.regexp_replace(t, r"[^\p{L}\p{N}_\s.'-]", ""))


def clean_folio(s: Column | str) -> Column:
    """Upper case without blanks."""
    return F.replace(F.upper(clean_text(s)), F.lit(" "), F.lit(""))


#: Date patterns in the order they are tried (fixed values); 03/04/2020 is thus the 4th of March.
DATE_FORMATS = ("yyyy-M-d", "d-M-yyyy", "M/d/yyyy", "d/M/yyyy")
_DATE_SHAPES = (r"^\d{4}-\d{1,2}-\d{1,2}$", r"^\d{1,2}-\d{1,2}-\d{4}$", r"^\d{1,2}/\d{1,2}/\d{4}$", r"^\d{1,2}/\d{1,2}/\d{4}$")


def iso_date(s: Column | str) -> Column:
    """yyyy-MM-dd of the first pattern that fits, '' if none does."""
    t = F.trim(_c(s))
    tries = [F.date_format(F.when(t.rlike(shape), F.try_to_timestamp(t, F.lit(f))), "yyyy-MM-dd") for f, shape in zip(DATE_FORMATS, _DATE_SHAPES)]
    return F.coalesce(*tries, F.lit(""))


def name_parts(s: Column | str) -> Column:
    """struct(first, middle, last): one word is first, two are first and last, all between are middle."""
    w = F.filter(F.split(F.trim(F.coalesce(_c(s), F.lit(""))), r"\s+"), lambda x: x != "")
    n = F.size(w)
    get = lambda i: F.coalesce(F.get(w, i), F.lit(""))
    return F.struct(
        get(F.lit(0)).alias("first"),
        F.when(n >= 3, F.array_join(F.slice(w, F.lit(2), F.greatest(n - 2, F.lit(0))), " ")).otherwise("").alias("middle"),
        F.when(n >= 2, get(n - 1)).otherwise("").alias("last"),
    )


def file_year(name: Column | str) -> Column:
    """YYYY-YY of a file name with a range of years, else its first 20dd, else 'unknown'."""
    n = _c(name)
    a, b = F.regexp_extract(n, r"(20\d\d)-(20\d\d|\d\d)", 1), F.regexp_extract(n, r"(20\d\d)-(20\d\d|\d\d)", 2)
    single = F.regexp_extract(n, r"(20\d\d)", 1)
    return F.when(a != "", F.concat(a, F.lit("-"), F.substring(b, -2, 2))).when(single != "", single).otherwise("unknown")


#: Words of file names that name no company (fixed values).
FILE_STOP = ("iepf", "unpaid", "unclaimed", "dividend", "final", "interim", "list", "statement", "report", "annexure")


def slug(s: Column | str) -> Column:
    """Lower case, runs of other characters than a-z and 0-9 as one hyphen, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(_c(s), F.lit(""))), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def file_company(name: Column | str) -> Column:
    """Title-cased head before the first underscore, unless it is a stop word, a year or starts with fy; then the slug."""
    stem = F.regexp_replace(_c(name), r"\.[A-Za-z0-9]+$", "")
    head = F.lower(F.substring_index(stem, "_", 1))
    bad = head.isin(*FILE_STOP) | head.rlike(r"^(20\d\d|fy)") | (head == "")
    label = F.nullif(title_case(F.replace(slug(stem), F.lit("-"), F.lit(" "))), F.lit(""))
    return F.when(bad, F.coalesce(label, F.lit("Unknown"))).otherwise(title_case(head))


def sheet_name(s: Column | str) -> Column:
    """At most 31 characters, others than letters, digits, _ and - as _."""
    return F.coalesce(F.nullif(F.substring(F.regexp_replace(F.coalesce(_c(s), F.lit("")), r"[^\p{L}\p{N}_-]", "_"), 1, 31), F.lit("")), F.lit("Sheet"))


def identity_name(s: Column | str) -> Column:
    """Lower case, other characters than a-z and 0-9 as blank, squeezed."""
    return squeeze(F.regexp_replace(F.lower(F.coalesce(_c(s), F.lit(""))), "[^a-z0-9 ]", " "))


def identity_hash(pan: Column | str, folio: Column | str, company: Column | str, name: Column | str) -> Column:
    """SHA-256 of the best key there is: pan, else folio and company (by its natural key), else name."""
    blank = lambda c: F.nullif(F.trim(_c(c)), F.lit(""))
    return F.sha2(
        F.coalesce(
            F.concat(F.lit("pan:"), F.upper(blank(pan))),
            F.concat(F.lit("folio:"), F.upper(blank(folio)), F.lit(":co:"), identity_name(company)),
            F.concat(F.lit("name:"), identity_name(name)),
        ),
        256,
    )


def phone_digits(s: Column | str) -> Column:
    """Digits of a telephone number with the country code 91, one form for all ways to write it."""
    d = F.regexp_replace(F.coalesce(_c(s), F.lit("")), "[^0-9]", "")
    d = F.regexp_replace(d, "^(0091|091)", "91")
    d = F.when((F.length(d) == 11) & d.startswith("0"), F.substring(d, 2, 10)).otherwise(d)
    return F.when(F.length(d) == 10, F.concat(F.lit("91"), d)).otherwise(d)


def phone(s: Column | str) -> Column:
    """struct(number, status): +91XXXXXXXXXX with valid_format; not_mobile or invalid_format without a number.

    A documented subset of a numbering plan: twelve digits, the first of the last ten is 6 to 9.
    """
    d = phone_digits(s)
    ok, mobile = d.rlike(r"^91\d{10}$"), d.rlike(r"^91[6-9]\d{9}$")
    return F.struct(
        F.when(mobile, F.concat(F.lit("+"), d)).otherwise("").alias("number"),
        F.when(mobile, "valid_format").when(ok, "not_mobile").otherwise("invalid_format").alias("status"),
    )


def city_state(address: Column | str) -> Column:
    """struct(city, state): the last two non-blank parts between commas."""
    p = F.filter(F.transform(F.split(F.coalesce(_c(address), F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    n = F.size(p)
    return F.struct(F.when(n >= 2, F.get(p, n - 2)).otherwise("").alias("city"), F.when(n >= 1, F.get(p, n - 1)).otherwise("").alias("state"))


def completeness(cols: list[Column | str]) -> Column:
    """Number of columns that are neither null nor blank."""
    return reduce(lambda a, b: a + b, [F.coalesce((F.trim(_c(c).cast("string")) != "").cast("int"), F.lit(0)) for c in cols])


def percent(x: Column) -> Column:
    """One decimal and a percent sign."""
    return F.format_string("%.1f%%", x)


def half_even(x: Column, digits: int = 0) -> Column:
    """Rounding to even, as the report figures are rounded."""
    return F.bround(x, digits)


#: What an uploaded file's name says before a year or a word for the kind of list (fixed values: lengths, words, years).
UPLOAD_HEAD = r"(?i)^([a-z][a-z0-9 &]{2,40}?)\s+(?:20[0-2]\d|iepf|share|annual)"
UPLOAD_YEAR = r"(20[0-2]\d)"
#: The year of a link (a fixed value).
LINK_YEAR = r"((?:19|20)\d{2})"


def upload_company(name: Column | str) -> Column:
    """Slug of an uploaded file's company: what stands before a year or a word for the kind of list, else the first word.

    A first word of less than three characters names nothing: 'unknown'.
    """
    stem = F.regexp_replace(_c(name), r"\.[^.]+$", "")
    plain = F.regexp_replace(stem, "[_-]", " ")
    before = F.regexp_extract(plain, UPLOAD_HEAD, 1)
    first = F.regexp_extract(stem, r"^([^\s_-]*)", 1)
    return F.coalesce(F.nullif(slug(F.when(before != "", before).when(F.length(first) >= 3, first)), F.lit("")), F.lit("unknown"))


def upload_year(name: Column | str) -> Column:
    """The first year from 2000 to 2029 in an uploaded file's name, else 'unknown'."""
    y = F.regexp_extract(F.regexp_replace(_c(name), r"\.[^.]+$", ""), UPLOAD_YEAR, 1)
    return F.coalesce(F.nullif(y, F.lit("")), F.lit("unknown"))


def link_year(url: Column | str) -> Column:
    """The first year from 1900 to 2099 in a link, else 'unknown'."""
    return F.coalesce(F.nullif(F.regexp_extract(_c(url), LINK_YEAR, 1), F.lit("")), F.lit("unknown"))


def download_name(url: Column | str, company: Column | str, year: Column | str) -> Column:
    """company_year_file of a link, other characters of the file than word characters, dot and hyphen as _."""
    file = F.regexp_extract(F.regexp_replace(_c(url), r"[?#].*$", ""), r"^[a-zA-Z]+://[^/]+/(?:.*/)?([^/]+)/?$", 1)
    file = F.regexp_replace(F.coalesce(F.nullif(file, F.lit("")), F.lit("document.pdf")), r"[^A-Za-z0-9_.\-]", "_")
    return F.concat_ws("_", _c(company), _c(year), file)


def recency(at: Column, year: Column, dates: list[Column]) -> Column:
    """How recent a row is: its time in seconds, else its year as a number, else the first date that reads as one, else 0."""
    seconds = [F.unix_timestamp(F.coalesce(F.try_to_timestamp(d.cast("string"), F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(d.cast("string"), F.lit("yyyy-MM-dd")))).cast("double") for d in dates]
    return F.coalesce(F.unix_timestamp(at).cast("double"), year.cast("string").try_cast("double"), *seconds, F.lit(0.0))
