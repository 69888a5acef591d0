"""Queries pN_... of the problems tagged llm, with SQL where SQL can say the same."""

from __future__ import annotations

from ledgerloom.llm import addresses, components, crossmatch, holders, leakage, packing, sentences, survivors
from ledgerloom.session import table


def p1_found(spark, sf):
    return survivors.account_rows(table(spark, sf, "shareholders"))


def p1_survivors(spark, sf):
    return survivors.survivors(table(spark, sf, "shareholders"))


def p5_found(spark, sf):
    return components.search_result_groups(table(spark, sf, "contact_results"))


def p9_found(spark, sf):
    return leakage.leaked_items(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p3_found(spark, sf):
    return addresses.same_addresses(table(spark, sf, "shareholders"), table(spark, sf, "inhouse_contacts"))


def p10_found(spark, sf):
    return sentences.sentence_units(table(spark, sf, "documents"))


def p2_found(spark, sf):
    return holders.same_holders(table(spark, sf, "shareholders"), table(spark, sf, "inhouse_contacts"), table(spark, sf, "name_aliases"))


def p4_matches(spark, sf):
    return crossmatch.quoted_holders(*[table(spark, sf, t) for t in ("shareholders_filtered", "contact_results", "inhouse_contacts", "name_aliases")])


def p4_found(spark, sf):
    return p4_matches(spark, sf).select("record_source", "record_key", "contact_id")


def p8_assignment(spark, sf):
    return packing.packed(table(spark, sf, "documents"), table(spark, sf, "container_sizes"))


def p8_fill(spark, sf):
    return packing.fill_report(p8_assignment(spark, sf), table(spark, sf, "container_sizes"))


QUERIES = {"p8_assignment": p8_assignment, "p8_fill": p8_fill, "p4_found": p4_found, "p4_matches": p4_matches, "p2_found": p2_found, "p3_found": p3_found, "p10_found": p10_found, "p9_found": p9_found, "p1_found": p1_found, "p1_survivors": p1_survivors, "p5_found": p5_found}

_ACCOUNTS = r"""
WITH a AS (
  SELECT *, trim(regexp_replace(regexp_replace(lower(company_name), '\([^)]*\)', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')) AS c0,
         regexp_replace(regexp_replace(upper(folio_no), '[^A-Z0-9]', '', 'g'), '^FOLIO(NO)?', '') AS f0,
         regexp_replace(demat_account, '[^0-9]', '', 'g') AS d0
  FROM shareholders),
b AS (
  SELECT *, coalesce(regexp_replace(c0, '( (private|pvt|co|company|limited|ltd|lmtd))+$', ''), '') AS co,
         CASE WHEN f0 = '' THEN NULL WHEN regexp_matches(f0, '^[A-Z]*?[0-9O]*[0-9][0-9O]*$')
              THEN regexp_extract(f0, '^([A-Z]*?)([0-9O]*[0-9][0-9O]*)$', 1)
                   || regexp_replace(replace(regexp_extract(f0, '^([A-Z]*?)([0-9O]*[0-9][0-9O]*)$', 2), 'O', '0'), '^0+(.)', '\1')
              ELSE f0 END AS fo,
         CASE WHEN length(d0) >= 8 THEN d0 END AS fu, CASE WHEN length(d0) >= 8 THEN right(d0, 8) END AS cl
  FROM a),
mf AS (SELECT co, fu, min(fo) AS v FROM b WHERE fo IS NOT NULL AND cl IS NOT NULL GROUP BY co, fu HAVING min(fo) = max(fo)),
mc AS (SELECT co, cl, min(fo) AS v FROM b WHERE fo IS NOT NULL AND cl IS NOT NULL GROUP BY co, cl HAVING min(fo) = max(fo)),
acc AS (
  SELECT b.*, coalesce('f:' || b.fo, 'f:' || mf.v, 'f:' || mc.v, 'd:' || b.cl, 'r:' || b.id) AS acct,
         coalesce(CASE length(y0) WHEN 4 THEN CAST(y0 AS INT) WHEN 2 THEN 2000 + CAST(y0 AS INT) END, 0) AS yr
  FROM (SELECT *, regexp_extract(pdf_financial_year, '(\d{4}|\d{2})\s*[-/_‐-―]\s*(\d{4}|\d{2})', 1) AS y0 FROM b) b
  LEFT JOIN mf ON b.fo IS NULL AND mf.co = b.co AND mf.fu = b.fu
  LEFT JOIN mc ON b.fo IS NULL AND mc.co = b.co AND mc.cl = b.cl)
"""

SQL = {
    "p1_found": _ACCOUNTS
    + """
SELECT min(id) AS first_row, arg_max(id, (yr, id)) AS year_row,
       arg_max(id, (yr, id)) FILTER (WHERE current_holding IS NOT NULL) AS holding_row
FROM acc GROUP BY co, acct HAVING count(*) > 1
""",
    "p5_found": r"""
WITH RECURSIVE e AS (
  SELECT DISTINCT regexp_replace(regexp_replace(shareholder_id, '\s', '', 'g'), '^0+(\d)', '\1') AS a,
         lower(regexp_replace(identity_hash, '\s', '', 'g')) AS b
  FROM contact_results WHERE match_found AND identity_hash IS NOT NULL AND shareholder_id IS NOT NULL),
l AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(v, u) AS (SELECT a, a FROM l UNION SELECT l.b, r.u FROM r JOIN l ON l.a = r.v)
SELECT v AS record_key, min(u) AS group_key FROM r GROUP BY v
""",
}
