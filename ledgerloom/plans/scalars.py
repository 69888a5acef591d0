"""Queries of the scalar functions over the register tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.functions.similarity import ratio, token_set_ratio, token_sort_ratio
from ledgerloom.session import table

Q, SQL = {}, {}

#: Python-like title casing in SQL: first letter of each run of letters upper, the rest lower.
_TITLE = "array_to_string(list_transform(regexp_extract_all({0}, '([\\p{{L}}]+|[^\\p{{L}}]+)'), lambda z: upper(z[1]) || lower(z[2:])), '')"


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query(
    r"""
WITH w AS (SELECT id, list_filter(regexp_split_to_array(upper(trim(coalesce(full_name, ''))), '\s+'), lambda x: x <> '') AS ws FROM shareholders),
h AS (SELECT id, ws, ws[1:4] AS head FROM w),
s AS (SELECT id, ws, list_position(list_transform(head, lambda x: NOT regexp_matches(x, '[0-9]') OR length(regexp_extract(x, '([^0-9]*)$', 1)) >= 2), true) AS pos,
      list_transform(head, lambda x: regexp_extract(x, '([^0-9]*)$', 1)) AS tails FROM h),
k AS (SELECT id, CASE WHEN len(ws) = 0 THEN '' WHEN pos IS NULL OR pos = 0 THEN array_to_string(ws[5:], ' ')
      ELSE array_to_string(list_concat([tails[pos]], ws[pos + 1:]), ' ') END AS t FROM s)
SELECT id, """ + _TITLE.format("t") + """ AS clean FROM k"""
)
def f01_clean_name(spark, sf):
    return table(spark, sf, "shareholders").select("id", T.clean_name("full_name").alias("clean"))


@query(
    r"""
SELECT id, array_to_string(list_filter(list_transform([address, city, state, pincode],
  lambda x: trim(regexp_replace(coalesce(x, ''), '\s+', ' ', 'g'))), lambda x: x <> ''), ', ') AS full_address FROM shareholders"""
)
def f03_join_address(spark, sf):
    return table(spark, sf, "shareholders").select("id", T.join_address(["address", "city", "state", "pincode"]).alias("full_address"))


@query(
    """
SELECT id, coalesce(total_dividend, 0.0) AS amount, coalesce(current_holding, 0) AS whole, coalesce(total_dividend, 0.0) AS loose FROM shareholders"""
)
def f04_amounts(spark, sf):
    """Amounts printed with sign, thousands and stray blanks between digits, and read again."""
    d = table(spark, sf, "shareholders")
    printed = F.concat(F.lit("₹ "), F.format_number("total_dividend", 2))
    spaced = F.concat_ws(" ", F.filter(F.split(F.format_string("%.2f", "total_dividend"), ""), lambda x: x != ""))
    return d.select(
        "id",
        T.parse_amount(F.when(F.col("id") % 2 == 0, printed).otherwise(spaced)).alias("amount"),
        T.to_int(F.format_number("current_holding", 0)).alias("whole"),
        T.to_float(printed).alias("loose"),
    )


@query(
    r"""
SELECT id, trim(regexp_replace(coalesce(full_name, ''), '\s+', ' ', 'g')) AS plain, """
    + _TITLE.format(r"regexp_replace(trim(regexp_replace(coalesce(full_name, ''), '\s+', ' ', 'g')), '[^\p{L}\p{N}_\s.''-]', '', 'g')")
    + r""" AS titled, replace(upper(trim(regexp_replace(coalesce(folio_no, ''), '\s+', ' ', 'g'))), ' ', '') AS folio FROM shareholders"""
)
def f07_strings(spark, sf):
    return table(spark, sf, "shareholders").select("id", T.clean_text("full_name").alias("plain"), T.clean_text("full_name", True).alias("titled"), T.clean_folio("folio_no").alias("folio"))


@query(
    r"""
SELECT id, CASE WHEN regexp_full_match(trim(date_processed), '\d{4}-\d{1,2}-\d{1,2}') THEN coalesce(strftime(try_strptime(trim(date_processed), '%Y-%m-%d'), '%Y-%m-%d'), '')
  WHEN regexp_full_match(trim(date_processed), '\d{1,2}-\d{1,2}-\d{4}') THEN coalesce(strftime(try_strptime(trim(date_processed), '%d-%m-%Y'), '%Y-%m-%d'), '')
  WHEN regexp_full_match(trim(date_processed), '\d{1,2}/\d{1,2}/\d{4}') THEN coalesce(strftime(try_strptime(trim(date_processed), '%m/%d/%Y'), '%Y-%m-%d'), strftime(try_strptime(trim(date_processed), '%d/%m/%Y'), '%Y-%m-%d'), '')
  ELSE '' END AS iso FROM shareholders"""
)
def f09_dates(spark, sf):
    return table(spark, sf, "shareholders").select("id", T.iso_date("date_processed").alias("iso"))


@query(
    r"""
WITH w AS (SELECT id, list_filter(regexp_split_to_array(trim(coalesce(full_name, '')), '\s+'), lambda x: x <> '') AS ws FROM shareholders)
SELECT id, coalesce(ws[1], '') AS first, CASE WHEN len(ws) >= 3 THEN array_to_string(ws[2:len(ws) - 1], ' ') ELSE '' END AS middle,
  CASE WHEN len(ws) >= 2 THEN ws[len(ws)] ELSE '' END AS last FROM w"""
)
def f10_name_parts(spark, sf):
    return table(spark, sf, "shareholders").select("id", T.name_parts("full_name").alias("p")).select("id", "p.first", "p.middle", "p.last")


@query(
    r"""
WITH s AS (SELECT id, source_pdf, full_name, father_husband_name, CASE WHEN company_name < 'M' THEN coalesce(list_filter(regexp_split_to_array(trim(coalesce(full_name, '')), '\s+'), lambda x: x <> '')[1], '') ELSE '' END AS p1, coalesce(city, '') AS p2 FROM shareholders),
f AS (SELECT source_pdf, max(CASE WHEN p1 <> '' THEN 1 ELSE 0 END) AS p, max(CASE WHEN trim(coalesce(father_husband_name, '')) <> '' THEN 1 ELSE 0 END) AS h FROM s WHERE source_pdf IS NOT NULL GROUP BY 1)
SELECT s.id, CASE WHEN f.p = 1 THEN concat_ws(' ', nullif(trim(p1), ''), nullif(trim(p2), '')) WHEN f.h = 1 THEN trim(coalesce(s.father_husband_name, '')) ELSE trim(coalesce(s.full_name, '')) END AS chosen_name
FROM s LEFT JOIN f ON s.source_pdf = f.source_pdf"""
)
def f11_name_choice(spark, sf):
    """The column a whole file takes its names from: name parts, which files of some companies have, else holder, else name."""
    from ledgerloom.operators.merge import chosen_name

    s = table(spark, sf, "shareholders")
    d = s.select("id", "source_pdf", "full_name", "father_husband_name", F.when(F.col("company_name") < "M", T.name_parts("full_name")["first"]).otherwise("").alias("p1"), F.coalesce("city", F.lit("")).alias("p2"))
    return chosen_name(d, "source_pdf", ["p1", "p2"], "father_husband_name", "full_name").select("id", "chosen_name")


@query(
    r"""
WITH f AS (SELECT DISTINCT source_pdf FROM shareholders WHERE source_pdf IS NOT NULL),
p AS (SELECT source_pdf, regexp_extract(source_pdf, '(20\d\d)-(20\d\d|\d\d)', 1) AS a, regexp_extract(source_pdf, '(20\d\d)-(20\d\d|\d\d)', 2) AS b, regexp_extract(source_pdf, '(20\d\d)', 1) AS s,
  lower(split_part(regexp_replace(source_pdf, '\.[A-Za-z0-9]+$', ''), '_', 1)) AS h FROM f)
SELECT source_pdf, CASE WHEN a <> '' THEN a || '-' || right(b, 2) WHEN s <> '' THEN s ELSE 'unknown' END AS year,
  upper(h[1]) || lower(h[2:]) AS company, regexp_replace(regexp_replace(lower(source_pdf), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug,
  substring(regexp_replace(source_pdf, '[^\p{L}\p{N}_-]', '_', 'g'), 1, 31) AS sheet FROM p"""
)
def f12_file_names(spark, sf):
    f = table(spark, sf, "shareholders").select("source_pdf").where("source_pdf is not null").distinct()
    return f.select("source_pdf", T.file_year("source_pdf").alias("year"), T.file_company("source_pdf").alias("company"), T.slug("source_pdf").alias("slug"), T.sheet_name("source_pdf").alias("sheet"))


@query(
    r"""
SELECT id, trim(regexp_replace(regexp_replace(lower(coalesce(name_raw, '')), '[^a-z0-9 ]', ' ', 'g'), '\s+', ' ', 'g')) AS norm,
  sha256(CASE WHEN nullif(trim(pan), '') IS NOT NULL THEN 'pan:' || upper(trim(pan)) ELSE 'name:' || trim(regexp_replace(regexp_replace(lower(coalesce(name_raw, '')), '[^a-z0-9 ]', ' ', 'g'), '\s+', ' ', 'g')) END) AS hash FROM persons"""
)
def f18_identity(spark, sf):
    return table(spark, sf, "persons").select("id", T.identity_name("name_raw").alias("norm"), T.identity_hash("pan", F.lit(None).cast("string"), F.lit(""), "name_raw").alias("hash"))


@query(
    r"""
WITH a AS (SELECT id, regexp_replace(regexp_replace(coalesce(contact, ''), '[^0-9]', '', 'g'), '^(0091|091)', '91') AS d FROM inhouse_contacts),
b AS (SELECT id, CASE WHEN length(d) = 11 AND d[1] = '0' THEN d[2:] ELSE d END AS d FROM a),
c AS (SELECT id, CASE WHEN length(d) = 10 THEN '91' || d ELSE d END AS d FROM b)
SELECT id, CASE WHEN regexp_full_match(d, '91[6-9]\d{9}') THEN '+' || d ELSE '' END AS number,
  CASE WHEN regexp_full_match(d, '91[6-9]\d{9}') THEN 'valid_format' WHEN regexp_full_match(d, '91\d{10}') THEN 'not_mobile' ELSE 'invalid_format' END AS status FROM c"""
)
def f21_phones(spark, sf):
    return table(spark, sf, "inhouse_contacts").select("id", T.phone("contact").alias("p")).select("id", "p.number", "p.status")


@query(
    r"""
WITH p AS (SELECT id, list_filter(list_transform(string_split(coalesce(address, ''), ','), lambda x: trim(x)), lambda x: x <> '') AS p FROM inhouse_contacts)
SELECT id, CASE WHEN len(p) >= 2 THEN p[len(p) - 1] ELSE '' END AS city, CASE WHEN len(p) >= 1 THEN p[len(p)] ELSE '' END AS state FROM p"""
)
def f22_city_state(spark, sf):
    return table(spark, sf, "inhouse_contacts").select("id", T.city_state("address").alias("p")).select("id", "p.city", "p.state")


_LCS = """list_last(list_reduce(list_concat([list_transform(range(0, length(b) + 1), lambda i: 0)], list_transform(range(1, length(a) + 1), lambda i: [i])),
  lambda r, c: list_reduce(list_concat([[0]], list_transform(range(1, length(b) + 1), lambda j: [j])), lambda n, j:
    list_append(n, CASE WHEN b[j[1]:j[1]] = a[c[1]:c[1]] THEN r[j[1]] + 1 ELSE greatest(r[j[1] + 1], n[j[1]]) END))))"""


@query(
    """
WITH p AS (SELECT id, trim(replace(lower(name_raw), chr(160), ' ')) AS a, trim(name_normalized) AS b FROM persons WHERE name_raw IS NOT NULL AND name_normalized IS NOT NULL),
s AS (SELECT id, array_to_string(list_sort(list_filter(regexp_split_to_array(a, '\\s+'), lambda x: x <> '')), ' ') AS a, array_to_string(list_sort(list_filter(regexp_split_to_array(b, '\\s+'), lambda x: x <> '')), ' ') AS b FROM p),
l AS (SELECT id, length(a) + length(b) AS n, CASE WHEN length(a) = 0 OR length(b) = 0 THEN 0 ELSE """ + _LCS + """ END AS l FROM s)
SELECT id, round(CASE WHEN n = 0 THEN 100.0 ELSE 200.0 * l / n END, 6) AS sort_score FROM l"""
)
def f23_token_sort(spark, sf):
    d = table(spark, sf, "persons").where("name_raw is not null and name_normalized is not null")
    return d.select("id", F.round(token_sort_ratio(F.lower("name_raw"), F.col("name_normalized")), 6).alias("sort_score"))


_SPLIT = "list_distinct(list_filter(regexp_split_to_array({0}, '[\\s\\x{{A0}}]+'), lambda x: x <> ''))"
_RATIO = "CASE WHEN length({0}) + length({1}) = 0 THEN 100.0 ELSE 200.0 * ({2}) / (length({0}) + length({1})) END"


def _lcs_of(a: str, b: str) -> str:
    return f"CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE " + _LCS.replace("length(b)", f"length({b})").replace("length(a)", f"length({a})").replace(" b[j", f" {b}[j").replace("= a[c", f"= {a}[c") + " END"


@query(
    f"""
WITH n AS (SELECT id, lower(name_raw) AS na, name_normalized AS nb, {_SPLIT.format("lower(name_raw)")} AS wx, {_SPLIT.format("name_normalized")} AS wy FROM persons WHERE name_raw IS NOT NULL AND name_normalized IS NOT NULL),
w AS (SELECT *, array_to_string(list_sort(list_filter(wx, lambda x: list_contains(wy, x))), ' ') AS ts, array_to_string(list_sort(list_filter(wx, lambda x: NOT list_contains(wy, x))), ' ') AS tp, array_to_string(list_sort(list_filter(wy, lambda x: NOT list_contains(wx, x))), ' ') AS tq FROM n),
v AS (SELECT *, trim(ts || ' ' || tp) AS sp, trim(ts || ' ' || tq) AS sq FROM w)
SELECT id, round({_RATIO.format("na", "nb", _lcs_of("na", "nb"))}, 6) AS plain_score,
  round(CASE WHEN len(wx) = 0 OR len(wy) = 0 THEN 0 WHEN ts <> '' AND (tp = '' OR tq = '') THEN 100 WHEN ts = '' THEN {_RATIO.format("tp", "tq", _lcs_of("tp", "tq"))}
    ELSE greatest({_RATIO.format("sp", "sq", _lcs_of("sp", "sq"))}, 200.0 * length(ts) / (length(ts) + length(sp)), 200.0 * length(ts) / (length(ts) + length(sq))) END, 6) AS set_score FROM v"""
)
def f24_token_set(spark, sf):
    d = table(spark, sf, "persons").where("name_raw is not null and name_normalized is not null")
    return d.select("id", F.round(token_set_ratio(F.lower("name_raw"), F.col("name_normalized")), 6).alias("set_score"), F.round(ratio(F.lower("name_raw"), F.col("name_normalized")), 6).alias("plain_score"))


_TEXTS = ("folio_no", "company_name", "demat_account", "full_name", "address", "city", "state", "pincode")


@query(
    "SELECT id, " + " + ".join(f"CASE WHEN trim(coalesce({c}, '')) <> '' THEN 1 ELSE 0 END" for c in _TEXTS)
    + " AS filled, epoch(created_at) :: BIGINT AS recency FROM shareholders"
)
def f26_completeness(spark, sf):
    return table(spark, sf, "shareholders").select("id", T.completeness(list(_TEXTS)).alias("filled"), F.unix_timestamp(F.col("created_at").cast("timestamp")).alias("recency"))


@query(
    """
SELECT company_name, printf('%.1f%%', round_even(100.0 * count(mobile_number) / count(*), 1)) AS with_phone, round_even(avg(current_holding), 1) AS mean_holding
FROM shareholders GROUP BY company_name"""
)
def f28_percent(spark, sf):
    g = table(spark, sf, "shareholders").groupBy("company_name").agg((100.0 * F.count("mobile_number") / F.count(F.lit(1))).alias("p"), F.avg("current_holding").alias("h"))
    return g.select("company_name", T.percent(T.half_even(F.col("p"), 1)).alias("with_phone"), T.half_even(F.col("h"), 1).alias("mean_holding"))
