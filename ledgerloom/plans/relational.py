"""Queries of the relational operators over the register tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.functions.registers import fy_label, fy_start
from ledgerloom.operators import dedup, fuzzy, lookup, merge, store
from ledgerloom.plans.scalars import _LCS
from ledgerloom.session import table

Q, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_FY = r"""CASE WHEN length(regexp_extract({0}, '(\d{{4}}|\d{{2}})\s*[-/_‐-―]\s*(\d{{4}}|\d{{2}})', 1)) = 4 THEN CAST(regexp_extract({0}, '(\d{{4}}|\d{{2}})\s*[-/_‐-―]\s*(\d{{4}}|\d{{2}})', 1) AS INT)
 WHEN length(regexp_extract({0}, '(\d{{4}}|\d{{2}})\s*[-/_‐-―]\s*(\d{{4}}|\d{{2}})', 1)) = 2 THEN 2000 + CAST(regexp_extract({0}, '(\d{{4}}|\d{{2}})\s*[-/_‐-―]\s*(\d{{4}}|\d{{2}})', 1) AS INT) END"""
_LABEL = "({0} || '-' || lpad(CAST(({0} + 1) % 100 AS VARCHAR), 2, '0'))"


def _t(spark, sf, name):
    return table(spark, sf, name)


# ---- sources, union, projections -------------------------------------------------------------


@query(
    """
SELECT id, company_name, source_pdf, 1 AS part, NULL::VARCHAR AS mobile_number FROM shareholders WHERE id % 2 = 0
UNION ALL SELECT id, company_name, NULL, 2, mobile_number FROM shareholders WHERE id % 2 <> 0"""
)
def u01_union_by_name(spark, sf):
    """Union by name of two frames that print different columns."""
    s = _t(spark, sf, "shareholders")
    a = s.where("id % 2 = 0").select("id", "company_name", "source_pdf", F.lit(1).alias("part"))
    b = s.where("id % 2 <> 0").select("mobile_number", "id", "company_name", F.lit(2).alias("part"))
    return merge.union_by_name([a, b])


@query(
    r"""
SELECT id, replace(upper(trim(regexp_replace(coalesce(folio_no, ''), '\s+', ' ', 'g'))), ' ', '') AS folio_no, trim(regexp_replace(coalesce(full_name, ''), '\s+', ' ', 'g')) AS name,
  CAST(coalesce(current_holding, 0) AS DOUBLE) AS current_holding FROM shareholders
WHERE lower(trim(coalesce(folio_no, ''))) NOT IN ('folio no', 'folio no.', 'folio', 'folio number', 'sr no', 's.no') AND (trim(coalesce(folio_no, '')) <> '' OR trim(coalesce(full_name, '')) <> '')"""
)
def row01_normalize(spark, sf):
    s = _t(spark, sf, "shareholders").select("id", "folio_no", F.col("full_name").alias("name"), F.col("current_holding").cast("string").alias("current_holding"))
    return merge.normalize(s, ["current_holding"], ["name"])


#: The years a holding snapshot can be of, as columns of the wide form.
WIDE_YEARS = range(2010, 2030)
_VARIANTS = ("", "final_", "interim_")
_fy = lambda y: f"{y}_{(y + 1) % 100:02d}"


def _wide(spark, sf):
    """One row a holding with a column for each year in three variants."""
    h = _t(spark, sf, "holding_snapshots").withColumn("y", fy_start("financial_year")).groupBy("holding_id")
    year = lambda y, v: F.max(F.when((F.col("y") == y) & (F.pmod("id", F.lit(3)) == v), F.col("market_value")))
    return h.agg(*[year(y, v).alias(f"dividend_{n}fy_{_fy(y)}") for v, n in enumerate(_VARIANTS) for y in WIDE_YEARS])


_WIDE = (
    "w AS (SELECT holding_id, " + ", ".join(f"max(CASE WHEN y = {y} AND id % 3 = {v} THEN market_value END) AS {n}{y}" for v, n in enumerate("bfi") for y in WIDE_YEARS)
    + f" FROM (SELECT *, {_FY.format('financial_year')} AS y FROM holding_snapshots) GROUP BY 1)"
)
_MOST = {y: f"greatest(coalesce(b{y}, 0), coalesce(f{y}, 0), coalesce(i{y}, 0))" for y in WIDE_YEARS}


@query(f"WITH {_WIDE} SELECT holding_id, " + ", ".join(f"{m} AS dividend_fy_{_fy(y)}" for y, m in _MOST.items()) + f", round({' + '.join(_MOST.values())}, 2) AS total_dividend FROM w")
def row03_consolidate(spark, sf):
    """Variants of each year folded into its greatest, and the total over all years."""
    return merge.total_dividend(merge.consolidate(_wide(spark, sf))).withColumn("total_dividend", F.round("total_dividend", 2))


@query(f"WITH {_WIDE} SELECT holding_id, " + ", ".join(f"CASE WHEN b{y} > 0 THEN b{y} WHEN f{y} > 0 THEN f{y} WHEN i{y} > 0 THEN i{y} ELSE 0.0 END AS fy{y}" for y in WIDE_YEARS) + " FROM w")
def row02_unified(spark, sf):
    """For each year the first positive of base, final, interim."""
    w = _wide(spark, sf)
    return w.select("holding_id", *[merge.first_positive([F.col(f"dividend_{n}fy_{_fy(y)}") for n in _VARIANTS]).alias(f"fy{y}") for y in WIDE_YEARS])


@query("SELECT id, row_number() OVER (ORDER BY id) AS sr_no FROM shareholders")
def row06_numbering(spark, sf):
    return merge.numbered(_t(spark, sf, "shareholders").select("id"), ["id"]).select("id", F.col("sr_no").cast("long").alias("sr_no"))


@query("SELECT id, CASE WHEN father_husband_name IN ('nan', '<NA>') THEN '' ELSE coalesce(father_husband_name, '') END AS father_husband_name, coalesce(current_holding, 0) AS current_holding, coalesce(total_dividend, 0.0) AS total_dividend FROM shareholders")
def row07_scrub(spark, sf):
    return merge.scrub(_t(spark, sf, "shareholders").select("id", "father_husband_name", "current_holding", "total_dividend"))


@query(
    r"""
WITH l AS (SELECT doc_id, CAST(pos AS INT) - 1 AS line, trim(t) AS t FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL) WHERE trim(t) <> ''),
k AS (SELECT doc_id, line, CASE WHEN regexp_matches(t, '^[A-Z]') THEN t ELSE '' END AS key, t FROM l),
g AS (SELECT *, sum(CASE WHEN key <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line) AS g FROM k)
SELECT doc_id, min(line) AS line, count(*) - 1 AS continued, max(key) AS key, string_agg(t, ' ' ORDER BY line) AS body FROM g WHERE g > 0 GROUP BY doc_id, g"""
)
def row08_continuations(spark, sf):
    """Lines that do not begin with a capital continue the line above (P8 on lines of documents)."""
    d = _t(spark, sf, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t")).withColumn("t", F.trim("t")).where("t <> ''")
    d = d.select("doc_id", "line", F.when(F.col("t").rlike("^[A-Z]"), F.col("t")).otherwise("").alias("key"), F.col("t").alias("body"))
    return merge.merge_continuations(d, "doc_id", "line", "key", "body", ["body"]).select("doc_id", "line", "continued", "key", "body")


@query(
    """
SELECT id, (coalesce(current_holding >= 500, false) OR coalesce(total_dividend >= 10000, false)) AS is_flagged,
  CASE WHEN coalesce(current_holding >= 500, false) OR coalesce(total_dividend >= 10000, false) THEN concat_ws(',', CASE WHEN current_holding >= 500 THEN 'current_holding' END, CASE WHEN total_dividend >= 10000 THEN 'total_dividend' END) ELSE '' END AS matched_criteria FROM shareholders"""
)
def row09_flag(spark, sf):
    """Threshold criteria joined by or, with the audit of what matched."""
    s = _t(spark, sf, "shareholders").select("id", "current_holding", "total_dividend")
    return lookup.flag(s, {"current_holding": F.col("current_holding") >= 500, "total_dividend": F.col("total_dividend") >= 10000}).select("id", "is_flagged", "matched_criteria")


@query(
    """
SELECT count(*) AS rows, sum(CASE WHEN current_holding >= 500 THEN 1 ELSE 0 END) AS by_holding, sum(CASE WHEN total_dividend >= 10000 THEN 1 ELSE 0 END) AS by_dividend,
  sum(CASE WHEN current_holding >= 500 AND total_dividend >= 10000 THEN 1 ELSE 0 END) AS by_both FROM shareholders"""
)
def agg02_hits(spark, sf):
    s = _t(spark, sf, "shareholders")
    a, b = F.coalesce(F.col("current_holding") >= 500, F.lit(False)), F.coalesce(F.col("total_dividend") >= 10000, F.lit(False))
    n = lambda c: F.sum(c.cast("int"))
    return s.agg(F.count(F.lit(1)).alias("rows"), n(a).alias("by_holding"), n(b).alias("by_dividend"), n(a & b).alias("by_both"))


@query("SELECT id, company_name, total_dividend FROM shareholders WHERE current_holding >= 500 AND total_dividend >= 10000")
def row13_high(spark, sf):
    return _t(spark, sf, "shareholders").where("current_holding >= 500 and total_dividend >= 10000").select("id", "company_name", "total_dividend")


@query("SELECT id, full_name FROM shareholders WHERE pincode = '045164' AND mobile_number IS NOT NULL AND trim(mobile_number) <> ''")
def row14_point_filters(spark, sf):
    return _t(spark, sf, "shareholders").where("pincode = '045164' and mobile_number is not null and trim(mobile_number) <> ''").select("id", "full_name")


@query("SELECT id, name, sector FROM companies WHERE (name ILIKE '%sugar%' OR nse_symbol ILIKE '%sugar%') AND sector ILIKE '%food%' ORDER BY name DESC LIMIT 20")
def row15_registry(spark, sf):
    c = _t(spark, sf, "companies")
    return c.where((F.col("name").ilike("%sugar%") | F.col("nse_symbol").ilike("%sugar%")) & F.col("sector").ilike("%food%")).orderBy(F.desc("name")).limit(20).select("id", "name", "sector")


@query(
    f"""
WITH y AS (SELECT id, total_dividend, {_FY.format("pdf_financial_year")} AS y, CASE WHEN trim(coalesce(mobile_number, '')) <> '' THEN 'verified' ELSE 'pending' END AS contact FROM shareholders)
SELECT {_LABEL.format("y")} AS fy, contact, count(*) AS n, round(sum(total_dividend), 2) AS total, round(avg(total_dividend), 4) AS mean FROM y WHERE total_dividend > 0 AND y IS NOT NULL GROUP BY ALL"""
)
def row16_fy_view(spark, sf):
    """Rows with a positive amount by year, with totals and contact status."""
    s = _t(spark, sf, "shareholders").select(fy_start("pdf_financial_year").alias("y"), "total_dividend", F.when(F.trim(F.coalesce("mobile_number", F.lit(""))) != "", "verified").otherwise("pending").alias("contact"))
    g = s.where("total_dividend > 0 and y is not null").groupBy(fy_label(F.col("y")).alias("fy"), "contact")
    return g.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("total_dividend"), 2).alias("total"), F.round(F.avg("total_dividend"), 4).alias("mean"))


@query("SELECT id FROM inhouse_contacts WHERE trim(coalesce(contact, '')) = '' AND trim(coalesce(email, '')) = ''")
def row18_layer_gate(spark, sf):
    return _t(spark, sf, "inhouse_contacts").where("trim(coalesce(contact, '')) = '' and trim(coalesce(email, '')) = ''").select("id")


# ---- joins -------------------------------------------------------------------------------------

_ACC = "nullif(upper(regexp_replace({0}, '[^A-Za-z0-9]', '', 'g')), '')"
_NORM = "array_to_string(list_sort(list_filter(regexp_split_to_array(trim(lower(regexp_replace(replace(coalesce({0}, ''), chr(160), ' '), '[\\s,;]+', ' ', 'g'))), '\\s+'), lambda x: x <> '')), ' ')"


def _lcs(a, b):
    return f"CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE " + _LCS.replace("length(b)", f"length({b})").replace("length(a)", f"length({a})").replace(" b[j", f" {b}[j").replace("= a[c", f"= {a}[c") + " END"


@query(
    f"""
WITH c AS (SELECT {_ACC.format("demat_no")} AS k, min(id) AS contact_id FROM inhouse_contacts GROUP BY 1)
SELECT r.folio_no, c.contact_id FROM shareholders_filtered r LEFT JOIN c ON {_ACC.format("r.demat_account")} = c.k AND c.k IS NOT NULL"""
)
def j01_exact_account(spark, sf):
    acc = lambda c: F.nullif(F.upper(F.regexp_replace(F.col(c), r"[^A-Za-z0-9]", "")), F.lit(""))
    c = _t(spark, sf, "inhouse_contacts").select(acc("demat_no").alias("k"), "id").where("k is not null").groupBy("k").agg(F.min("id").alias("contact_id"))
    return _t(spark, sf, "shareholders_filtered").withColumn("k", acc("demat_account")).join(c, "k", "left").select("folio_no", "contact_id")


@query()
def j02_exact_then_fuzzy(spark, sf):
    """Layer 1: account number, else the most similar name and address."""
    norm = lambda c: F.regexp_replace(F.col(c), "\xa0", " ")
    r = _t(spark, sf, "shareholders_filtered").select(F.col("folio_no").alias("row_id"), norm("name").alias("name"), norm("address").alias("address"), F.col("demat_account").alias("account"))
    c = _t(spark, sf, "inhouse_contacts").select(F.col("id").alias("contact_id"), norm("name").alias("name"), norm("address").alias("address"), F.col("demat_no").alias("account"))
    return lookup.exact_then_fuzzy(r, c).withColumn("score", F.round("score", 6))


def _people(spark, sf):
    norm = lambda c: F.regexp_replace(F.col(c), "\xa0", " ")
    return _t(spark, sf, "persons").select("id", norm("name_raw").alias("name"), norm("address").alias("address"))


@query(
    f"""
WITH t AS (SELECT b, n, a, min(id) AS r, count(*) AS k FROM (SELECT id, {_NORM.format("name_raw")} AS n, {_NORM.format("address")} AS a, substring(lower(trim(replace(name_raw, chr(160), ' '))), 1, 3) AS b FROM persons WHERE name_raw IS NOT NULL AND address IS NOT NULL) WHERE n <> '' AND a <> '' GROUP BY b, n, a),
p AS (SELECT x.r AS row_a, y.r AS row_b, x.n AS n1, y.n AS n2, x.a AS a1, y.a AS a2, x.k AS copies_a, y.k AS copies_b FROM t x JOIN t y ON x.b = y.b AND x.r < y.r
  WHERE 200.0 * least(length(x.n), length(y.n)) / (length(x.n) + length(y.n)) >= 85 AND 200.0 * least(length(x.a), length(y.a)) / (length(x.a) + length(y.a)) >= 85),
s AS (SELECT *, 200.0 * ({_lcs("n1", "n2")}) / (length(n1) + length(n2)) AS name_score FROM p),
q AS (SELECT *, 200.0 * ({_lcs("a1", "a2")}) / (length(a1) + length(a2)) AS address_score FROM s WHERE name_score >= 85)
SELECT row_a, row_b, round(name_score, 6) AS name_score, round(address_score, 6) AS address_score, copies_a, copies_b FROM q WHERE address_score >= 85"""
)
def j03_similar_pairs(spark, sf):
    """Fuzzy self-join in blocks of names that begin alike."""
    p = dedup.similar_pairs(_people(spark, sf), "id", "name", "address")
    return p.withColumns({c: F.round(c, 6) for c in ("name_score", "address_score")})


@query(
    """
WITH k AS (SELECT id AS r, upper(trim(demat_account)) AS k FROM shareholders WHERE trim(coalesce(demat_account, '')) <> ''), g AS (SELECT k, min(r) AS first_row, count(*) AS group_rows FROM k GROUP BY k HAVING count(*) > 1)
SELECT first_row, r AS later_row, group_rows FROM k JOIN g USING (k) WHERE r > first_row"""
)
def j04_account_pairs(spark, sf):
    return dedup.account_pairs(_t(spark, sf, "shareholders"), F.nullif(F.upper(F.trim("demat_account")), F.lit("")), "id")


@query()
def j05_set_pairs(spark, sf):
    """Fuzzy self-join by token sets, not blocked by how names begin."""
    return dedup.set_similar_pairs(_people(spark, sf), "id", "name", "address")


@query(
    """
WITH f AS (SELECT DISTINCT lower(regexp_extract(source_pdf, '^([a-z]+)_', 1)) AS stem FROM shareholders WHERE source_pdf IS NOT NULL),
m AS (SELECT stem, min(id) AS company_id FROM f JOIN companies c ON contains(c.name_normalized, stem) OR contains(stem, c.name_normalized) WHERE stem <> '' GROUP BY stem)
SELECT stem, company_id FROM m"""
)
def j06_known_company(spark, sf):
    """File stems resolved to companies by containment either way, first company wins."""
    f = _t(spark, sf, "shareholders").select(F.lower(F.regexp_extract("source_pdf", "^([a-z]+)_", 1)).alias("stem")).where("stem <> ''").distinct()
    c = _t(spark, sf, "companies").select("id", "name_normalized")
    return fuzzy.containing(f, c, "stem", "name_normalized").groupBy("stem").agg(F.min("id").alias("company_id"))


_DIM = "array_to_string(list_sort(list_filter(regexp_split_to_array(trim(lower(regexp_replace({0}, '[^A-Za-z0-9 ]', ' ', 'g'))), '\\s+'), lambda x: x <> '')), ' ')"


@query(
    f"""
WITH k AS (SELECT DISTINCT company_name AS key, {_DIM.format("company_name")} AS kn FROM shareholders WHERE company_name IS NOT NULL),
d AS (SELECT {_DIM.format("name")} AS dn, min(name) AS name FROM companies GROUP BY 1),
e AS (SELECT key, name, 100.0 AS score FROM k JOIN d ON kn = dn WHERE kn <> ''),
t AS (SELECT DISTINCT kn FROM k WHERE kn <> '' AND key NOT IN (SELECT key FROM e)),
p AS (SELECT kn, dn, name FROM t JOIN d ON dn <> '' AND 200.0 * least(length(kn), length(dn)) / (length(kn) + length(dn)) > 80),
s AS (SELECT kn, name, 200.0 * ({_lcs("kn", "dn")}) / (length(kn) + length(dn)) AS score FROM p),
b AS (SELECT kn, arg_min(name, (-score, name)) AS name, max(score) AS score FROM s WHERE score > 80 GROUP BY kn)
SELECT key, name, round(score, 6) AS score FROM e UNION ALL SELECT key, name, round(score, 6) FROM k JOIN b USING (kn) WHERE key NOT IN (SELECT key FROM e)"""
)
def j07_best_dimension(spark, sf):
    """Printed company names looked up in the list of companies, exact else most similar."""
    return lookup.best_dimension(_t(spark, sf, "shareholders").select("company_name").where("company_name is not null"), _t(spark, sf, "companies"), "company_name", "name").withColumn("score", F.round("score", 6))


@query(
    """
WITH r AS (SELECT lower(regexp_replace(identity_hash, '\\s', '', 'g')) AS h, count(*) AS searches, sum(CASE WHEN match_found THEN 1 ELSE 0 END) AS hits, bool_or(contact_number IS NOT NULL) AS has_phone FROM contact_results WHERE identity_hash IS NOT NULL GROUP BY 1)
SELECT p.id, coalesce(r.searches, 0) AS searches, coalesce(r.hits, 0) AS hits, coalesce(r.has_phone, false) AS has_phone FROM persons p LEFT JOIN r ON r.h = p.identity_hash"""
)
def j08_person_summary(spark, sf):
    """Persons with what was found about them, the branch aggregated before the join."""
    r = _t(spark, sf, "contact_results").where("identity_hash is not null").groupBy(F.lower(F.regexp_replace("identity_hash", r"\s", "")).alias("identity_hash"))
    r = r.agg(F.count(F.lit(1)).alias("searches"), F.sum(F.col("match_found").cast("int")).alias("hits"), F.bool_or(F.col("contact_number").isNotNull()).alias("has_phone"))
    z = lambda c, v: F.coalesce(c, F.lit(v)).alias(c)
    return _t(spark, sf, "persons").join(r, "identity_hash", "left").select("id", z("searches", 0), z("hits", 0), z("has_phone", False))


@query("SELECT id FROM persons p WHERE EXISTS (SELECT 1 FROM contact_results r WHERE r.identity_hash = p.identity_hash AND r.match_found)")
def j09_semi(spark, sf):
    return _t(spark, sf, "persons").join(_t(spark, sf, "contact_results").where("match_found"), "identity_hash", "left_semi").select("id")


@query("SELECT s.id FROM shareholders s WHERE NOT EXISTS (SELECT 1 FROM contact_results r WHERE try_cast(trim(r.shareholder_id) AS BIGINT) = s.id)")
def j10_not_done(spark, sf):
    done = _t(spark, sf, "contact_results").select(F.trim("shareholder_id").try_cast("long").alias("id"))
    return _t(spark, sf, "shareholders").select("id").join(done, "id", "left_anti")


# ---- aggregates --------------------------------------------------------------------------------


@query(f"SELECT company_name, {_FY.format('pdf_financial_year')} AS y, count(*) AS n FROM shareholders GROUP BY ALL")
def agg01_company_year(spark, sf):
    return _t(spark, sf, "shareholders").groupBy("company_name", fy_start("pdf_financial_year").alias("y")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """
WITH k AS (SELECT upper(trim(demat_account)) AS k, count(*) AS c FROM shareholders WHERE trim(coalesce(demat_account, '')) <> '' GROUP BY 1), n AS (SELECT count(*) AS before FROM shareholders)
SELECT before, CAST(sum(c - 1) AS BIGINT) AS exact_duplicates, round(100.0 * (before - sum(c - 1)) / greatest(1, before), 4) AS retention FROM k, n GROUP BY before"""
)
def agg03_dedup_stats(spark, sf):
    s = _t(spark, sf, "shareholders").select(F.nullif(F.upper(F.trim("demat_account")), F.lit("")).alias("k"))
    g = s.groupBy("k").agg(F.count(F.lit(1)).alias("c"))
    a = g.agg(F.sum("c").alias("before"), F.sum(F.when(F.col("k").isNotNull(), F.col("c") - 1)).alias("exact_duplicates"))
    return a.select("before", "exact_duplicates", F.round(100.0 * (F.col("before") - F.col("exact_duplicates")) / F.greatest(F.lit(1), F.col("before")), 4).alias("retention"))


@query("SELECT coalesce(source, 'none') AS source, count(*) AS searches, sum(CASE WHEN match_found THEN 1 ELSE 0 END) AS hits, round(100.0 * sum(CASE WHEN match_found THEN 1 ELSE 0 END) / greatest(1, count(*)), 4) AS rate, round(avg(match_score), 4) AS mean_score FROM contact_results GROUP BY 1")
def agg05_layer_report(spark, sf):
    """Hits and rates per source of contacts."""
    g = _t(spark, sf, "contact_results").groupBy(F.coalesce("source", F.lit("none")).alias("source")).agg(F.count(F.lit(1)).alias("searches"), F.sum(F.col("match_found").cast("int")).alias("hits"), F.round(F.avg("match_score"), 4).alias("mean_score"))
    return g.select("source", "searches", "hits", F.round(100.0 * F.col("hits") / F.greatest(F.lit(1), F.col("searches")), 4).alias("rate"), "mean_score")


@query("SELECT count(*) AS total, count(*) FILTER (WHERE status = 'completed' OR status = 'complete') AS done, count(*) FILTER (WHERE status = 'initialized') AS open, sum(merger.total_records) AS records, sum(merger.files_processed)::BIGINT AS files FROM progress_status")
def agg09_registry_stats(spark, sf):
    """Counts per status and over the nested run records."""
    p = _t(spark, sf, "progress_status")
    return p.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status").isin("complete", "completed")).alias("done"), F.count_if(F.col("status") == "initialized").alias("open"), F.sum("merger.total_records").alias("records"), F.sum("merger.files_processed").alias("files"))


@query("SELECT full_name, company_name, count(*) AS n FROM shareholders GROUP BY 1, 2 HAVING count(*) > 1")
def agg13_repeated(spark, sf):
    return _t(spark, sf, "shareholders").groupBy("full_name", "company_name").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("SELECT count(DISTINCT company_name) AS companies, count(DISTINCT source_pdf) AS files FROM shareholders")
def agg14_distinct(spark, sf):
    return _t(spark, sf, "shareholders").agg(F.count_distinct("company_name").alias("companies"), F.count_distinct("source_pdf").alias("files"))


@query("SELECT DISTINCT company_name FROM shareholders WHERE total_dividend >= 5000 AND company_name IS NOT NULL")
def agg15_facets(spark, sf):
    return _t(spark, sf, "shareholders").where("total_dividend >= 5000 and company_name is not null").select("company_name").distinct().orderBy("company_name")


# ---- survivors ---------------------------------------------------------------------------------

_FILLED = " + ".join(f"CASE WHEN trim(coalesce({c}, '')) <> '' THEN 1 ELSE 0 END" for c in ("folio_no", "full_name", "address", "city", "state", "pincode"))


@query(
    f"""
WITH k AS (SELECT id, nullif(upper(trim(demat_account)), '') AS k, {_FILLED} AS filled, created_at FROM shareholders)
SELECT id FROM k WHERE k IS NULL UNION ALL
SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY k ORDER BY filled DESC, created_at DESC NULLS LAST, id) AS rn FROM k WHERE k IS NOT NULL) WHERE rn = 1"""
)
def d01_keep_best(spark, sf):
    s = _t(spark, sf, "shareholders").select("id", "demat_account", "created_at", T.completeness(["folio_no", "full_name", "address", "city", "state", "pincode"]).alias("filled"))
    return dedup.keep_best(s, F.nullif(F.upper(F.trim("demat_account")), F.lit("")), [F.desc("filled"), F.desc_nulls_last("created_at"), F.asc("id")]).select("id")


@query()
def d02_greedy(spark, sf):
    """Greedy removal over all similar pairs in order, copies of one text among them."""
    return dedup.greedy_similar(_people(spark, sf), "id", "name", "address")


@query(
    """
WITH k AS (SELECT id, folio_no, company_name FROM shareholders)
SELECT id FROM k WHERE folio_no IS NULL OR trim(folio_no) = '' OR company_name IS NULL OR trim(company_name) = '' UNION ALL
SELECT max(id) AS id FROM k WHERE trim(folio_no) <> '' AND trim(company_name) <> '' GROUP BY folio_no, company_name"""
)
def d04_keep_last(spark, sf):
    return dedup.keep_last(_t(spark, sf, "shareholders").select("id", "folio_no", "company_name"), [F.col("folio_no"), F.col("company_name")], "id").select("id")


@query()
def d05_drop_earlier(spark, sf):
    return dedup.drop_earlier(dedup.set_similar_pairs(_people(spark, sf), "id", "name", "address"))


@query("SELECT DISTINCT folio_no, company_name, demat_account, full_name, address FROM shareholders")
def d06_distinct(spark, sf):
    return _t(spark, sf, "shareholders").select("folio_no", "company_name", "demat_account", "full_name", "address").distinct()


@query(
    """
WITH o AS (SELECT *, row_number() OVER (PARTITION BY folio_no, source_pdf ORDER BY (CASE WHEN id % 3 = 0 THEN 1 ELSE 0 END) DESC, id DESC) AS rn FROM shareholders) SELECT id, folio_no, source_pdf FROM o WHERE rn = 1"""
)
def d07_append_keep_last(spark, sf):
    """Append to the kept table: new rows win over old ones with the same key."""
    s = _t(spark, sf, "shareholders").select("id", "folio_no", "source_pdf")
    return merge.append_keep_last(s.where("id % 3 <> 0"), s.where("id % 3 = 0"), ["folio_no", "source_pdf"], "id")


@query("SELECT city, min(id) AS first_row FROM shareholders WHERE city IS NOT NULL GROUP BY city")
def d09_ordered_distinct(spark, sf):
    return _t(spark, sf, "shareholders").where("city is not null").groupBy("city").agg(F.min("id").alias("first_row"))


# ---- store, pages ------------------------------------------------------------------------------


@query(
    """
WITH b AS (SELECT *, row_number() OVER (PARTITION BY folio_no, company_name ORDER BY id DESC) AS rn FROM shareholders WHERE id % 2 = 0 AND trim(coalesce(folio_no, '')) <> '' AND trim(coalesce(company_name, '')) <> ''),
o AS (SELECT *, row_number() OVER (PARTITION BY folio_no, company_name ORDER BY id DESC) AS rn FROM shareholders WHERE id % 2 = 1 AND trim(coalesce(folio_no, '')) <> '' AND trim(coalesce(company_name, '')) <> '')
SELECT coalesce(b.id, o.id) AS id, coalesce(o.created_at, b.created_at) AS created_at, CASE WHEN b.id IS NULL THEN 'kept' WHEN o.id IS NULL THEN 'inserted' ELSE 'updated' END AS action
FROM (SELECT * FROM b WHERE rn = 1) b FULL JOIN (SELECT * FROM o WHERE rn = 1) o ON b.folio_no = o.folio_no AND b.company_name = o.company_name"""
)
def m01_upsert(spark, sf):
    s = _t(spark, sf, "shareholders").select("id", "folio_no", "company_name", "created_at")
    old = dedup.keep_last(s.where("id % 2 = 1").where("trim(coalesce(folio_no, '')) <> '' and trim(coalesce(company_name, '')) <> ''"), [F.col("folio_no"), F.col("company_name")], "id")
    return store.upsert(old, s.where("id % 2 = 0"), ["folio_no", "company_name"], "id", "created_at").select("id", "created_at", "action")


@query(
    f"""
WITH s AS (SELECT holding_id, {_FY.format("financial_year")} AS y, shares, market_value, recorded_at, id FROM holding_snapshots)
SELECT holding_id, {_LABEL.format("y")} AS fy, arg_max(struct_pack(a := shares), (recorded_at, id)).a AS shares, arg_max(struct_pack(a := market_value), (recorded_at, id)).a AS market_value FROM s WHERE y IS NOT NULL GROUP BY holding_id, y"""
)
def m04_snapshot_upsert(spark, sf):
    """The last row of each holding and year wins (M4)."""
    s = _t(spark, sf, "holding_snapshots").withColumn("y", fy_start("financial_year")).where("y is not null")
    return store.latest_by_key(s, ["holding_id", "y"], ["recorded_at", "id"], ["shares", "market_value"]).select("holding_id", fy_label(F.col("y")).alias("fy"), "shares", "market_value")


@query(
    """
WITH p AS (SELECT identity_hash, min(id) AS first_row FROM persons WHERE trim(coalesce(name_raw, '')) <> '' GROUP BY 1), c AS (SELECT lower(trim(company_name)) AS k, min(id) AS first_row FROM shareholders WHERE trim(coalesce(company_name, '')) <> '' GROUP BY 1)
SELECT 'person' AS kind, identity_hash AS key, dense_rank() OVER (ORDER BY first_row) AS surrogate_id FROM p UNION ALL SELECT 'company', k, dense_rank() OVER (ORDER BY first_row) FROM c"""
)
def m03_star_keys(spark, sf):
    """Get-or-create: surrogate numbers of persons and companies by first appearance (M3, M5)."""
    p = _t(spark, sf, "persons").where("trim(coalesce(name_raw, '')) <> ''").groupBy(F.col("identity_hash").alias("key")).agg(F.min("id").alias("first_row"))
    c = _t(spark, sf, "shareholders").where("trim(coalesce(company_name, '')) <> ''").groupBy(F.lower(F.trim("company_name")).alias("key")).agg(F.min("id").alias("first_row"))
    number = lambda d, kind: merge.numbered(d, ["first_row"], name="surrogate_id").select(F.lit(kind).alias("kind"), "key", F.col("surrogate_id").cast("long").alias("surrogate_id"))
    return number(p, "person").unionByName(number(c, "company"))


@query("SELECT min(id) AS id, trim(company_name) AS name FROM shareholders s WHERE trim(coalesce(company_name, '')) <> '' AND NOT EXISTS (SELECT 1 FROM companies c WHERE c.name = trim(s.company_name) OR c.name_normalized = trim(s.company_name)) GROUP BY 2")
def m06_insert_absent(spark, sf):
    """Company names of the register that the list of companies has under neither name, with their first line."""
    name = F.nullif(F.trim("company_name"), F.lit(""))
    batch = _t(spark, sf, "shareholders").select("id", name.alias("name"), name.alias("name_normalized")).where("name is not null")
    return store.insert_absent(_t(spark, sf, "companies"), batch, ["name", "name_normalized"], [F.asc("id")]).select("id", "name")


@query("SELECT register_id, CASE WHEN register_id = 2 THEN 'archived' ELSE status END AS status FROM progress_status")
def m07_status_update(spark, sf):
    return _t(spark, sf, "progress_status").select("register_id", F.when(F.col("register_id") == 2, "archived").otherwise(F.col("status")).alias("status"))


@query("SELECT id, full_name, total_dividend FROM shareholders ORDER BY total_dividend DESC NULLS LAST, id LIMIT 50 OFFSET 100")
def l01_page(spark, sf):
    """The third page of fifty (the page is the feature)."""
    return store.page(_t(spark, sf, "shareholders").select("id", "full_name", "total_dividend"), [F.desc_nulls_last("total_dividend"), F.asc("id")], 3, 50)


@query("SELECT count(*) AS total, greatest(1, CAST(ceil(count(*) / 50.0) AS BIGINT)) AS pages FROM shareholders WHERE lower(company_name) = 'arunomont power limited'")
def l01_page_info(spark, sf):
    return store.page_info(_t(spark, sf, "shareholders").where(F.lower("company_name") == "arunomont power limited"), 50)


@query("SELECT id FROM shareholders WHERE contains(lower(concat_ws(' ', full_name, folio_no, company_name)), 'pavmulla') AND coalesce(total_dividend, 0) >= 1000")
def q01_search(spark, sf):
    """Free text over values and a least amount (Q1-Q4)."""
    return store.free_text(_t(spark, sf, "shareholders"), ["full_name", "folio_no", "company_name"], "Pavmulla").where(F.coalesce("total_dividend", F.lit(0)) >= 1000).select("id")


@query("SELECT id, row_number() OVER (ORDER BY try_cast(replace(current_holding::VARCHAR, ',', '') AS DOUBLE) DESC NULLS LAST, lower(current_holding::VARCHAR) DESC NULLS LAST, id) AS place FROM shareholders QUALIFY place <= 200")
def q05_sorted(spark, sf):
    """Numeric or text order, whichever the values call for; the first 200 places (a top-k report)."""
    s = _t(spark, sf, "shareholders").select("id", "current_holding")
    n, t = store.sort_key(s, "current_holding")
    top = s.orderBy(n.desc_nulls_last(), t.desc_nulls_last(), "id").limit(200)
    return top.select("id", F.row_number().over(Window.orderBy(n.desc_nulls_last(), t.desc_nulls_last(), F.col("id"))).cast("long").alias("place"))


@query(
    """
SELECT 'lines' AS stage, count(*) AS n FROM shareholders UNION ALL SELECT 'selected', count(*) FROM shareholders_filtered UNION ALL SELECT 'searched', count(DISTINCT try_cast(trim(shareholder_id) AS BIGINT)) FROM contact_results
UNION ALL SELECT 'found', count(DISTINCT try_cast(trim(shareholder_id) AS BIGINT)) FROM contact_results WHERE match_found"""
)
def q09_funnel(spark, sf):
    r = _t(spark, sf, "contact_results").withColumn("s", F.trim("shareholder_id").try_cast("long"))
    one = lambda d, name, c: d.agg(c.alias("n")).select(F.lit(name).alias("stage"), "n")
    return (
        one(_t(spark, sf, "shareholders"), "lines", F.count(F.lit(1)))
        .unionByName(one(_t(spark, sf, "shareholders_filtered"), "selected", F.count(F.lit(1))))
        .unionByName(one(r, "searched", F.count_distinct("s")))
        .unionByName(one(r.where("match_found"), "found", F.count_distinct("s")))
    )


# ---- enrichment --------------------------------------------------------------------------------

_PROVIDERS = "('inhouse_db', 1), ('mca', 2), ('iepf', 3), ('apollo', 4)"


@query(
    f"""
WITH pr AS (SELECT * FROM (VALUES {_PROVIDERS}) v(source, priority)),
r AS (SELECT try_cast(trim(shareholder_id) AS BIGINT) AS id, source, priority, max(contact_number) AS phone, max(email) AS email FROM (SELECT r.*, coalesce(pr.priority, 9) AS priority FROM contact_results r LEFT JOIN pr USING (source)) GROUP BY ALL),
w AS (SELECT id, min(priority) FILTER (WHERE phone IS NOT NULL OR email IS NOT NULL) AS best, max(priority) AS last FROM r GROUP BY id)
SELECT w.id, r.source, r.phone, r.email, coalesce(w.best, w.last) AS attempts FROM w LEFT JOIN r ON r.id = w.id AND r.priority = w.best"""
)
def e02_first_provider(spark, sf):
    """Ordered sources, the first with a telephone or mail wins."""
    pr = spark.createDataFrame([("inhouse_db", 1), ("mca", 2), ("iepf", 3), ("apollo", 4)], "source string, priority int")
    r = _t(spark, sf, "contact_results").withColumn("id", F.trim("shareholder_id").try_cast("long")).join(F.broadcast(pr), "source", "left")
    r = r.withColumn("priority", F.coalesce("priority", F.lit(9)))  # sources not in the list come last
    r = r.groupBy("id", "source", "priority").agg(F.max("contact_number").alias("phone"), F.max("email").alias("email"))
    return lookup.first_provider(r.select("id").distinct(), r, "id", F.col("phone").isNotNull() | F.col("email").isNotNull())


@query(
    rf"""
WITH a AS (SELECT id, lower(name) AS x, lower(inhouse_name) AS y, regexp_replace(regexp_replace(coalesce(contact_number, ''), '[^0-9]', '', 'g'), '^(0091|091)', '91') AS d FROM contact_results),
b AS (SELECT id, x, y, CASE WHEN length(d) = 11 AND d[1] = '0' THEN d[2:] ELSE d END AS d FROM a),
c AS (SELECT id, x, y, CASE WHEN length(d) = 10 THEN '91' || d ELSE d END AS d FROM b),
e AS (SELECT id, d, CASE WHEN length(x) + length(y) = 0 THEN 1.0 WHEN x IS NOT NULL AND y IS NOT NULL THEN 2.0 * ({_lcs("x", "y")}) / (length(x) + length(y)) END AS s FROM c)
SELECT id, CASE WHEN regexp_full_match(d, '91[6-9]\d{{9}}') THEN '+' || d ELSE '' END AS number, floor(s * 1000 + 1e-6) AS name_match_permille,
  CASE WHEN regexp_full_match(d, '91[6-9]\d{{9}}') THEN CASE WHEN s IS NULL THEN 'unchecked' WHEN s >= 0.7 THEN 'verified' ELSE 'name_differs' END WHEN regexp_full_match(d, '91\d{{10}}') THEN 'not_mobile' ELSE 'invalid_format' END AS status FROM e"""
)
def e07_verified(spark, sf):
    """Telephone format, and whether name and quoted name agree to 0.7."""
    from ledgerloom.functions.similarity import ratio

    r = _t(spark, sf, "contact_results").select("id", T.phone("contact_number").alias("p"), (ratio(F.lower("name"), F.lower("inhouse_name")) / 100).alias("s"))
    status = F.when(F.col("p.status") != "valid_format", F.col("p.status")).when(F.col("s") >= 0.7, "verified").when(F.col("s").isNull(), "unchecked").otherwise("name_differs")
    return r.select("id", F.col("p.number").alias("number"), F.floor(F.col("s") * 1000 + 1e-6).cast("double").alias("name_match_permille"), status.alias("status"))


# ---- sinks -------------------------------------------------------------------------------------


@query(r"SELECT substring(regexp_replace(company_name, '[^\p{L}\p{N}_-]', '_', 'g'), 1, 31) AS sheet, count(*) AS n, max(length(address)) AS widest, greatest(30, least(max(length(address)) + 4, 60)) AS width FROM shareholders WHERE company_name IS NOT NULL GROUP BY 1")
def s22_sheets(spark, sf):
    """One sheet a company with the width of its widest cell."""
    g = _t(spark, sf, "shareholders").where("company_name is not null").groupBy(T.sheet_name("company_name").alias("sheet")).agg(F.count(F.lit(1)).alias("n"), F.max(F.length("address")).alias("widest"))
    return g.withColumn("width", F.greatest(F.lit(30), F.least(F.col("widest") + 4, F.lit(60))))
