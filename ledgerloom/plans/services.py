"""Queries of presets, layers, audits, star load, search and views, each with its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.functions.registers import fy_start
from ledgerloom.operators import dedup, lookup, merge, store
from ledgerloom.plans.relational import _ACC, _FY
from ledgerloom.session import table
from ledgerloom.sources import ingest

Q, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_t = table
_PRESET_SQL = """
WITH s AS (SELECT id, current_holding AS h, total_dividend AS t, CASE WHEN y = 2014 THEN total_dividend END AS d14, CASE WHEN y = 2015 THEN total_dividend END AS d15 FROM (SELECT *, {fy} AS y FROM shareholders)),
r AS (
  SELECT 'high_value' AS preset, concat_ws(',', CASE WHEN h >= 500 THEN 'current_holding' END, CASE WHEN t >= 10000 THEN 'total_dividend' END) AS audit FROM s WHERE h >= 500 OR t >= 10000
  UNION ALL SELECT 'ultra_high_value', 'current_holding,total_dividend' FROM s WHERE h >= 5000 AND t >= 100000
  UNION ALL SELECT 'single_year', 'single_year_dividend' FROM s WHERE greatest(d14, d15) >= 1000)
SELECT preset, audit, count(*) AS n FROM r GROUP BY ALL"""


@query(_PRESET_SQL.format(fy=_FY.format("pdf_financial_year")))
def row11_presets(spark, sf):
    """Rows flagged by each preset, custom with nothing set among them (it flags none), and by the largest amount of one year."""
    y = fy_start("pdf_financial_year")
    s = _t(spark, sf, "shareholders").select("id", "current_holding", "total_dividend", F.when(y == 2014, F.col("total_dividend")).alias("dividend_2014_15"), F.when(y == 2015, F.col("total_dividend")).alias("dividend_2015_16"))
    runs = [(p, p, {}) for p in lookup.PRESETS] + [("single_year", "custom", {"single_year": 1000})]
    each = [lookup.flag_preset(s, p, **v).where("is_flagged").select(F.lit(n).alias("preset"), F.col("matched_criteria").alias("audit")) for n, p, v in runs]
    return reduce(lambda a, b: a.unionByName(b), each).groupBy("preset", "audit").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT folio_no, coalesce(lower(trim(investor_type)) = 'hni', false) AND coalesce(current_holding >= 100, false) AS is_flagged FROM shareholders_filtered")
def row09_investor_type(spark, sf):
    """Investor type and a least holding, joined by and."""
    return lookup.flag_preset(_t(spark, sf, "shareholders_filtered"), "custom", holding=100, investor_type="HNI", logic="and").select("folio_no", "is_flagged")


@query(
    """
SELECT 'current_holding' AS criterion, sum(CASE WHEN current_holding >= 500 THEN 1 ELSE 0 END)::BIGINT AS hits, round(100.0 * sum(CASE WHEN current_holding >= 500 THEN 1 ELSE 0 END) / greatest(1, count(*)), 4) AS rate FROM shareholders
UNION ALL SELECT 'total_dividend', sum(CASE WHEN total_dividend >= 10000 THEN 1 ELSE 0 END)::BIGINT, round(100.0 * sum(CASE WHEN total_dividend >= 10000 THEN 1 ELSE 0 END) / greatest(1, count(*)), 4) FROM shareholders"""
)
def agg02_hit_rates(spark, sf):
    """Hits of each criterion and their rate, in one pass (A2)."""
    s = _t(spark, sf, "shareholders")
    crit = {"current_holding": F.col("current_holding") >= 500, "total_dividend": F.col("total_dividend") >= 10000}
    one = s.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(k) for k, c in crit.items()])
    row = F.explode(F.array(*[F.struct(F.lit(k).alias("criterion"), F.col(k).alias("hits")) for k in crit]))
    return one.select("n", row.alias("x")).select("x.criterion", "x.hits", F.round(100.0 * F.col("x.hits") / F.greatest(F.lit(1), F.col("n")), 4).alias("rate"))


@query("SELECT id, row_number() OVER (ORDER BY total_dividend DESC, id) AS rank FROM shareholders WHERE current_holding >= 500 AND total_dividend >= 10000")
def row13_ranked(spark, sf):
    """Rows above both thresholds in order of their dividend, numbered by range."""
    s = _t(spark, sf, "shareholders").where("current_holding >= 500 and total_dividend >= 10000").select("id", (-F.col("total_dividend")).alias("down"))
    return merge.numbered(s, ["down", "id"], name="rank").select("id", F.col("rank").cast("long").alias("rank"))


@query(
    f"""
WITH s AS (SELECT *, {_FY.format("pdf_financial_year")} AS y FROM shareholders),
r AS (
  SELECT 'year' AS filter, id FROM s WHERE y = 2015 UNION ALL SELECT 'year_company', id FROM s WHERE y = 2015 AND lower(trim(company_name)) = 'arunomont power limited'
  UNION ALL SELECT 'company', id FROM s WHERE lower(trim(company_name)) = 'arunomont power limited' UNION ALL SELECT 'pincode', id FROM s WHERE trim(pincode) = '045164'
  UNION ALL SELECT 'state', id FROM s WHERE lower(trim(state)) = 'purvanchala' UNION ALL SELECT 'mobile', id FROM s WHERE trim(coalesce(mobile_number, '')) <> '')
SELECT filter, id FROM r"""
)
def row14_filters(spark, sf):
    """The point filters: year, year and company, company, postcode, state, has a telephone."""
    s = _t(spark, sf, "shareholders")
    y, co = fy_start("pdf_financial_year") == 2015, F.lower(F.trim("company_name")) == "arunomont power limited"
    conds = {"year": y, "year_company": y & co, "company": co, "pincode": F.trim("pincode") == "045164", "state": F.lower(F.trim("state")) == "purvanchala", "mobile": F.trim(F.coalesce("mobile_number", F.lit(""))) != ""}
    return s.select("id", F.explode(F.array(*[F.when(c, F.lit(k)) for k, c in conds.items()])).alias("filter")).where("filter is not null").select("filter", "id")


@query(f"SELECT id, full_name, total_dividend, row_number() OVER (ORDER BY total_dividend DESC, id) AS rank FROM shareholders WHERE {_FY.format('pdf_financial_year')} = 2016 AND total_dividend > 0")
def row16_rows(spark, sf):
    """The rows of one year with a positive amount, largest first."""
    s = _t(spark, sf, "shareholders").where((fy_start("pdf_financial_year") == 2016) & (F.col("total_dividend") > 0)).select("id", "full_name", "total_dividend", (-F.col("total_dividend")).alias("down"))
    return merge.numbered(s, ["down", "id"], name="rank").select("id", "full_name", "total_dividend", F.col("rank").cast("long").alias("rank"))


@query("SELECT id, trim(contact_number) AS phone FROM contact_results WHERE trim(coalesce(contact_number, '')) <> ''")
def row19_to_verify(spark, sf):
    return _t(spark, sf, "contact_results").where("trim(coalesce(contact_number, '')) <> ''").select("id", F.trim("contact_number").alias("phone"))


# ---- look-ups in layers ------------------------------------------------------------------------

_LAYERS = f"""
WITH c AS (SELECT {_ACC.format("demat_no")} AS k, min(id) AS id FROM inhouse_contacts WHERE demat_no IS NOT NULL GROUP BY 1),
l1 AS (SELECT f.folio_no, 'account_exact' AS match_type, i.contact AS phone, i.email, i.name AS inhouse_name FROM shareholders_filtered f JOIN c ON c.k = {_ACC.format("f.demat_account")} JOIN inhouse_contacts i ON i.id = c.id),
l2 AS (SELECT folio_no, 'search_result' AS match_type, arg_min(contact_number, id) AS phone, arg_min(e, id) AS email, arg_min(n, id) AS inhouse_name
  FROM (SELECT folio_no, id, coalesce(contact_number, '') AS contact_number, coalesce(email, '') AS e, coalesce(inhouse_name, '') AS n FROM contact_results WHERE match_found AND folio_no IS NOT NULL AND (contact_number IS NOT NULL OR email IS NOT NULL)) GROUP BY 1),
l3 AS (SELECT folio_no, 'register' AS match_type, arg_max(m, id) AS phone, arg_max(e, id) AS email, '' AS inhouse_name
  FROM (SELECT folio_no, id, coalesce(mobile_number, '') AS m, coalesce(email_id, '') AS e FROM shareholders WHERE folio_no IS NOT NULL AND (mobile_number IS NOT NULL OR email_id IS NOT NULL)) GROUP BY 1),
r AS (
SELECT f.folio_no, CASE WHEN l1.folio_no IS NOT NULL THEN 1 WHEN l2.folio_no IS NOT NULL THEN 2 WHEN l3.folio_no IS NOT NULL THEN 3 ELSE 0 END AS contact_layer,
  coalesce(l1.match_type, l2.match_type, l3.match_type) AS match_type,
  nullif(CASE WHEN l1.folio_no IS NOT NULL THEN l1.phone WHEN l2.folio_no IS NOT NULL THEN l2.phone ELSE l3.phone END, '') AS phone,
  nullif(CASE WHEN l1.folio_no IS NOT NULL THEN l1.email WHEN l2.folio_no IS NOT NULL THEN l2.email ELSE l3.email END, '') AS email,
  nullif(CASE WHEN l1.folio_no IS NOT NULL THEN l1.inhouse_name WHEN l2.folio_no IS NOT NULL THEN l2.inhouse_name ELSE l3.inhouse_name END, '') AS inhouse_name
FROM shareholders_filtered f LEFT JOIN l1 USING (folio_no) LEFT JOIN l2 USING (folio_no) LEFT JOIN l3 USING (folio_no))
"""


def layers(spark, sf):
    acc = lambda c: F.nullif(F.upper(F.regexp_replace(F.col(c), r"[^A-Za-z0-9]", "")), F.lit(""))
    f = _t(spark, sf, "shareholders_filtered")
    said = [F.col("phone"), F.col("email"), F.col("inhouse_name")]
    c = _t(spark, sf, "inhouse_contacts").select(acc("demat_no").alias("k"), "id", F.col("contact").alias("phone"), "email", F.col("name").alias("inhouse_name")).where("k is not null")
    c = c.groupBy("k").agg(F.min_by(F.struct(*said), "id").alias("m"))
    one = f.select("folio_no", acc("demat_account").alias("k")).join(c, "k").select("folio_no", F.lit("account_exact").alias("match_type"), "m.*")
    r = _t(spark, sf, "contact_results").where("match_found and folio_no is not null and (contact_number is not null or email is not null)")
    two = r.withColumnRenamed("contact_number", "phone").groupBy("folio_no").agg(F.min_by(F.struct(*said), "id").alias("m")).select("folio_no", F.lit("search_result").alias("match_type"), "m.*")
    s = _t(spark, sf, "shareholders").where("folio_no is not null and (mobile_number is not null or email_id is not null)")
    three = s.groupBy("folio_no").agg(F.max_by(F.struct(F.col("mobile_number").alias("phone"), F.col("email_id").alias("email"), F.lit(None).cast("string").alias("inhouse_name")), "id").alias("m")).select("folio_no", F.lit("register").alias("match_type"), "m.*")
    blank = lambda x: F.nullif(F.col(x), F.lit("")).alias(x)
    return lookup.layered(f.select("folio_no"), "folio_no", [one, two, three]).select("folio_no", "contact_layer", "match_type", blank("phone"), blank("email"), blank("inhouse_name"))


@query(_LAYERS + "SELECT * FROM r")
def e05_layers(spark, sf):
    """Account match in the address book, then earlier search results, then the register itself; the first that knows a folio answers (E5)."""
    return layers(spark, sf)


@query(_LAYERS + "SELECT contact_layer, count(*) AS n, round(100.0 * count(*) / greatest(1, (SELECT count(*) FROM r)), 4) AS rate FROM r GROUP BY contact_layer")
def agg05_layers(spark, sf):
    """Rows and rate of each layer from 0 to 3 (A5)."""
    g = layers(spark, sf).groupBy("contact_layer").agg(F.count(F.lit(1)).alias("n"))
    total = g.agg(F.sum("n").alias("t"))
    return g.crossJoin(F.broadcast(total)).select("contact_layer", "n", F.round(100.0 * F.col("n") / F.greatest(F.lit(1), F.col("t")), 4).alias("rate"))


@query()
def e01_batch(spark, sf):
    """Layer 1 as a batch: account number, else the most similar name and address, with all it says of the contact."""
    from ledgerloom.plans.relational import j02_exact_then_fuzzy

    f = _t(spark, sf, "shareholders_filtered").select(F.col("folio_no").alias("row_id"))
    c = _t(spark, sf, "inhouse_contacts").select(F.col("id").alias("contact_id"), F.col("contact").alias("contact_number"), "email", F.col("name").alias("inhouse_name"), F.col("address").alias("inhouse_address"), F.col("demat_no").alias("inhouse_demat"))
    hit = j02_exact_then_fuzzy(spark, sf).join(c, "contact_id")
    return f.join(hit, "row_id", "left").select(
        "row_id", F.col("contact_id").isNotNull().alias("match_found"), F.coalesce("match_type", F.lit("none")).alias("match_type"), F.coalesce("score", F.lit(0.0)).alias("match_score"), "contact_number", "email", "inhouse_name", "inhouse_address", "inhouse_demat"
    )


# ---- audits ------------------------------------------------------------------------------------

_AUDIT = """
WITH a AS (SELECT id, upper(trim(demat_account)) AS k FROM shareholders WHERE trim(coalesce(demat_account, '')) <> ''),
b AS (SELECT id, upper(trim(folio_no)) || '|' || lower(trim(company_name)) AS k FROM shareholders WHERE trim(coalesce(folio_no, '')) <> '' AND trim(coalesce(company_name, '')) <> ''),
p AS (SELECT min(id) OVER (PARTITION BY k) AS row_a, id AS row_b, 'account' AS match_type, 100.0 AS score FROM a UNION ALL SELECT min(id) OVER (PARTITION BY k), id, 'folio_company', 100.0 FROM b),
q AS (SELECT row_b AS removed_row, arg_min(row_a, (row_a, match_type)) AS kept_row, arg_min(match_type, (row_a, match_type)) AS match_type, arg_min(score, (row_a, match_type)) AS score FROM p WHERE row_a < row_b GROUP BY row_b)
"""


def _removed(spark, sf):
    s = _t(spark, sf, "shareholders")
    keys = {"account": F.nullif(F.upper(F.trim("demat_account")), F.lit("")), "folio_company": F.concat(F.nullif(F.upper(F.trim("folio_no")), F.lit("")), F.lit("|"), F.nullif(F.lower(F.trim("company_name")), F.lit("")))}
    each = [dedup.account_pairs(s, k, "id").select(F.col("first_row").alias("row_a"), F.col("later_row").alias("row_b"), F.lit(n).alias("match_type"), F.lit(100.0).alias("score")) for n, k in keys.items()]
    return dedup.removal_audit(each[0].unionByName(each[1]))


@query(_AUDIT + "SELECT * FROM q")
def d03_audit(spark, sf):
    """Removed rows with the row that stays and the rule that found them (D3)."""
    return _removed(spark, sf)


@query(_AUDIT + "SELECT match_type, count(*) AS removed, count(DISTINCT kept_row) AS kept, avg(score) AS mean_score FROM q GROUP BY match_type")
def agg04_removals(spark, sf):
    """Removals by rule (A4)."""
    return _removed(spark, sf).groupBy("match_type").agg(F.count(F.lit(1)).alias("removed"), F.count_distinct("kept_row").alias("kept"), F.avg("score").alias("mean_score"))


# ---- kept tables -------------------------------------------------------------------------------


@query(
    """
WITH o AS (SELECT DISTINCT folio_no, company_name FROM shareholders WHERE id <= (SELECT max(id) / 2 FROM shareholders)),
b AS (SELECT folio_no, company_name, trim(coalesce(folio_no, '')) <> '' AND trim(coalesce(company_name, '')) <> '' AS ok, count(*) AS n FROM shareholders WHERE id > (SELECT max(id) / 2 FROM shareholders) GROUP BY ALL)
SELECT sum(CASE WHEN ok AND o.folio_no IS NULL THEN 1 ELSE 0 END)::BIGINT AS inserted, sum(CASE WHEN ok THEN CASE WHEN o.folio_no IS NULL THEN n - 1 ELSE n END ELSE 0 END)::BIGINT AS updated, sum(CASE WHEN ok THEN 0 ELSE n END)::BIGINT AS failed
FROM b LEFT JOIN o ON o.folio_no = b.folio_no AND o.company_name = b.company_name"""
)
def m01_counts(spark, sf):
    """The later half of the lines as a batch on the earlier one: inserted, updated, failed (M1)."""
    s = _t(spark, sf, "shareholders")
    half = s.agg((F.max("id") / 2).alias("half"))
    s = s.crossJoin(F.broadcast(half)).select("folio_no", "company_name", (F.col("id") <= F.col("half")).alias("old"))
    return store.upsert_counts(s.where("old").drop("old"), s.where("not old").drop("old"), ["folio_no", "company_name"])


@query("SELECT folio_no, max(id) AS id, arg_max(coalesce(full_name, '-'), id) AS name FROM shareholders WHERE trim(coalesce(folio_no, '')) <> '' GROUP BY folio_no")
def m02_replace(spark, sf):
    """A table replaced as a whole, the last line of each folio (M2)."""
    return store.replaced(_t(spark, sf, "shareholders").select("folio_no", "id", F.coalesce("full_name", F.lit("-")).alias("name")), "folio_no", "id")


_STAR = f"""
WITH f AS (SELECT id, sha256(lower(trim(full_name))) AS person, lower(trim(company_name)) AS company_key, upper(coalesce(nullif(trim(folio_no), ''), '')) AS folio_key, CAST({_FY.format("pdf_financial_year")} AS VARCHAR) AS year, current_holding AS shares, total_dividend AS amount
  FROM shareholders WHERE trim(coalesce(full_name, '')) <> '' AND trim(coalesce(company_name, '')) <> '')
"""


def _star(spark, sf):
    s = _t(spark, sf, "shareholders")
    return store.star(s.select("id", F.col("full_name").alias("name"), F.col("company_name").alias("company"), F.col("folio_no").alias("folio"), fy_start("pdf_financial_year").cast("string").alias("year"), F.col("current_holding").alias("shares"), F.col("total_dividend").alias("amount")), "id")


@query(
    _STAR
    + """SELECT 'persons' AS frame, count(DISTINCT person) AS n FROM f UNION ALL SELECT 'companies', count(DISTINCT company_key) FROM f UNION ALL SELECT 'holdings', count(DISTINCT (person, company_key, folio_key)) FROM f
UNION ALL SELECT 'snapshots', count(DISTINCT (person, company_key, folio_key, year)) FROM f WHERE year IS NOT NULL UNION ALL SELECT 'dividends', count(DISTINCT (person, company_key, folio_key, year)) FROM f WHERE year IS NOT NULL AND coalesce(amount, 0) <> 0"""
)
def m05_star_counts(spark, sf):
    """Rows of the five frames a flat register is loaded into (M5)."""
    each = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("frame"), "n") for k, df in _star(spark, sf).items()]
    return reduce(lambda a, b: a.unionByName(b), each)


@query(_STAR + "SELECT person, company_key, folio_key, year, arg_max(amount, id) AS amount FROM f WHERE year IS NOT NULL AND coalesce(amount, 0) <> 0 GROUP BY ALL")
def m04_dividends(spark, sf):
    """Dividends per holding and year, the last line counts, none without year or amount (M4)."""
    return _star(spark, sf)["dividends"]


# ---- search, persons, views --------------------------------------------------------------------


@query(
    """
WITH h AS (SELECT id, full_name, company_name, total_dividend FROM shareholders WHERE lower(trim(company_name)) = 'arunomont power limited' AND contains(lower(concat_ws(' ', full_name, address, folio_no)), 'sid') AND coalesce(total_dividend, 0) >= 100),
t AS (SELECT count(*) AS total FROM h)
SELECT id, full_name, company_name, total_dividend, total, CAST(greatest(1, ceil(total / 25)) AS BIGINT) AS pages FROM h, t ORDER BY total_dividend DESC, id LIMIT 25 OFFSET 25"""
)
def q01_whole(spark, sf):
    """Company, free text and least wealth together, the second page with total and pages (Q1-Q4)."""
    s = _t(spark, sf, "shareholders")
    got = store.search(s, "Arunomont Power Limited ", "sid", ["full_name", "address", "folio_no"], "total_dividend", "100", [F.desc("total_dividend"), F.asc("id")], 2, 25)
    return got.select("id", "full_name", "company_name", "total_dividend", "total", "pages")


@query(
    r"""
WITH r AS (SELECT DISTINCT lower(regexp_replace(identity_hash, '\s', '', 'g')) AS h, try_cast(trim(shareholder_id) AS BIGINT) AS sid FROM contact_results WHERE match_found AND identity_hash IS NOT NULL),
d AS (SELECT h, count(DISTINCT s.company_name) AS companies, count(*) AS holdings, sum(coalesce(s.current_holding, 0))::BIGINT AS shares, bool_or(trim(coalesce(s.mobile_number, '')) <> '' OR trim(coalesce(s.email_id, '')) <> '') AS any_contact FROM r JOIN shareholders s ON s.id = r.sid GROUP BY h)
SELECT p.id, p.name_raw, coalesce(companies, 0) AS companies, coalesce(holdings, 0) AS holdings, coalesce(shares, 0) AS shares, coalesce(any_contact, false) AS any_contact FROM persons p LEFT JOIN d ON d.h = p.identity_hash"""
)
def q08_person_detail(spark, sf):
    """Persons with the companies and shares of the lines their searches were for, aggregated before the join."""
    r = _t(spark, sf, "contact_results").where("match_found and identity_hash is not null").select(F.lower(F.regexp_replace("identity_hash", r"\s", "")).alias("identity_hash"), F.trim("shareholder_id").try_cast("long").alias("id")).distinct()
    s = _t(spark, sf, "shareholders").select("id", "company_name", "current_holding", ((F.trim(F.coalesce("mobile_number", F.lit(""))) != "") | (F.trim(F.coalesce("email_id", F.lit(""))) != "")).alias("c"))
    d = r.join(s, "id").groupBy("identity_hash").agg(F.count_distinct("company_name").alias("companies"), F.count(F.lit(1)).alias("holdings"), F.sum(F.coalesce("current_holding", F.lit(0))).alias("shares"), F.bool_or("c").alias("any_contact"))
    z = lambda c, v: F.coalesce(c, F.lit(v)).alias(c)
    return _t(spark, sf, "persons").join(d, "identity_hash", "left").select("id", "name_raw", z("companies", 0), z("holdings", 0), z("shares", 0), z("any_contact", False))


@query("SELECT DISTINCT trim(company_name) AS company FROM shareholders WHERE trim(coalesce(company_name, '')) <> ''")
def q10_company_names(spark, sf):
    return _t(spark, sf, "shareholders").select(F.trim("company_name").alias("company")).where("company <> ''").distinct()


@query("SELECT id, name_raw FROM persons ORDER BY id LIMIT 50 OFFSET 100")
def l02_persons_page(spark, sf):
    """The third page of persons; the offset needs an order, which is the number of the person (L2)."""
    return store.page(_t(spark, sf, "persons").select("id", "name_raw"), [F.asc("id")], 3, 50)


@query(f"SELECT id, row_number() OVER (ORDER BY company_name NULLS LAST, y NULLS LAST, folio_no NULLS LAST, id) AS sr_no FROM (SELECT *, {_FY.format('pdf_financial_year')} AS y FROM shareholders)")
def l03_sorted(spark, sf):
    """Lines by company, year and folio, what is missing last, numbered by range."""
    s = _t(spark, sf, "shareholders").select("id", "company_name", fy_start("pdf_financial_year").alias("y"), "folio_no")
    keys = [x for c in ("company_name", "y", "folio_no") for x in (f"no_{c}", c)]
    s = s.withColumns({f"no_{c}": F.col(c).isNull() for c in ("company_name", "y", "folio_no")})
    return merge.numbered(s, [*keys, "id"]).select("id", F.col("sr_no").cast("long").alias("sr_no"))


# ---- names of files and links ------------------------------------------------------------------


@query(
    r"""
WITH f AS (SELECT DISTINCT source_pdf AS name, regexp_replace(source_pdf, '\.[^.]+$', '') AS stem FROM shareholders WHERE source_pdf IS NOT NULL),
g AS (SELECT name, stem, regexp_extract(regexp_replace(stem, '[_-]', ' ', 'g'), '^([a-z][a-z0-9 &]{2,40}?)\s+(?:20[0-2]\d|iepf|share|annual)', 1, 'i') AS before, regexp_extract(stem, '^([^\s_-]*)', 1) AS first FROM f),
h AS (SELECT *, CASE WHEN before <> '' THEN before WHEN length(first) >= 3 THEN first ELSE '' END AS c FROM g)
SELECT name, coalesce(nullif(regexp_replace(regexp_replace(lower(c), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'unknown') AS company, coalesce(nullif(regexp_extract(stem, '(20[0-2]\d)', 1), ''), 'unknown') AS year FROM h"""
)
def f14_upload_parts(spark, sf):
    """Company and year of the names of uploaded files."""
    return _t(spark, sf, "shareholders").select(F.col("source_pdf").alias("name")).where("name is not null").distinct().select("name", T.upload_company("name").alias("company"), T.upload_year("name").alias("year"))


@query(
    r"""
WITH f AS (SELECT DISTINCT source_pdf AS p FROM shareholders WHERE source_pdf IS NOT NULL)
SELECT 'https://registrar.example/lists/' || p || '?v=2' AS url, coalesce(nullif(regexp_extract(p, '((?:19|20)\d{2})', 1), ''), 'unknown') AS year,
  'x_' || coalesce(nullif(regexp_extract(p, '((?:19|20)\d{2})', 1), ''), 'unknown') || '_' || regexp_replace(p, '[^A-Za-z0-9_.\-]', '_', 'g') AS file FROM f"""
)
def f16_link_parts(spark, sf):
    """Year and name of a file behind a link (F16)."""
    u = _t(spark, sf, "shareholders").select(F.concat(F.lit("https://registrar.example/lists/"), "source_pdf", F.lit("?v=2")).alias("url")).where("url is not null").distinct()
    return u.select("url", T.link_year("url").alias("year"), T.download_name("url", F.lit("x"), T.link_year("url")).alias("file"))


@query(
    f"""
SELECT id, coalesce(CASE WHEN id % 3 = 0 THEN epoch(date_trunc('second', created_at)) END, CASE WHEN id % 3 < 2 THEN CAST({_FY.format("pdf_financial_year")} AS DOUBLE) END, epoch(try_strptime(date_processed, '%Y-%m-%d')), 0.0) AS recency FROM shareholders"""
)
def f27_recency(spark, sf):
    """Recency by time, else by year, else by the first date that reads as one: a third of the rows has each."""
    s = _t(spark, sf, "shareholders")
    at = F.when(F.col("id") % 3 == 0, F.col("created_at"))
    year = F.when(F.col("id") % 3 < 2, fy_start("pdf_financial_year"))
    return s.select("id", T.recency(at, year, [F.when(F.col("date_processed").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col("date_processed"))]).alias("recency"))


@query(
    r"""
WITH l AS (SELECT id, regexp_replace(coalesce(demat_account, ''), '[^0-9]', '', 'g') || ' ' || coalesce(full_name, '') AS line FROM shareholders)
SELECT id, regexp_extract(line, '(\d{14,16})\s+([A-Za-z][A-Za-z\s]+)', 1) AS identity, trim(regexp_extract(line, '(\d{14,16})\s+([A-Za-z][A-Za-z\s]+)', 2)) AS name FROM l"""
)
def s16_identity_lines(spark, sf):
    """Number and name of lines that print both, from every line of the register."""
    line = F.concat(F.regexp_replace(F.coalesce("demat_account", F.lit("")), "[^0-9]", ""), F.lit(" "), F.coalesce("full_name", F.lit("")))
    return _t(spark, sf, "shareholders").select("id", ingest.identity_and_name(line).alias("p")).select("id", "p.identity", "p.name")
