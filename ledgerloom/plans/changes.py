"""Queries on deliveries: snapshots that change (problem 6), files whose columns drift (problem 7)."""

from __future__ import annotations

from ledgerloom.operators.drift import consistent_cells, drift_report
from ledgerloom.operators.snapshots import snapshot_changes
from ledgerloom.session import table


def p6_found(spark, sf):
    return snapshot_changes(table(spark, sf, "holding_snapshots"))


def p7_found(spark, sf):
    return drift_report(table(spark, sf, "raw_files"), table(spark, sf, "raw_records"))


def p7_cells(spark, sf):
    return consistent_cells(table(spark, sf, "raw_files"), table(spark, sf, "raw_records"))


QUERIES = {"p6_found": p6_found, "p7_found": p7_found, "p7_cells": p7_cells}

SQL = {
    "p6_found": r"""
WITH r AS (
  SELECT holding_id, shares, recorded_at, id,
         regexp_extract(financial_year, '(\d{4}|\d{2})\s*[-/_‐-―]\s*(\d{4}|\d{2})', 1) AS a
  FROM holding_snapshots WHERE holding_id IS NOT NULL),
y AS (SELECT *, CASE length(a) WHEN 4 THEN CAST(a AS INT) WHEN 2 THEN 2000 + CAST(a AS INT) END AS yr FROM r WHERE a <> ''),
l AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY holding_id, yr ORDER BY recorded_at DESC, id DESC) = 1),
d AS (SELECT yr, lag(yr) OVER (ORDER BY yr) AS prev FROM (SELECT DISTINCT yr FROM y)),
n AS (SELECT l.holding_id, d.yr, l.shares FROM l JOIN d USING (yr) WHERE prev IS NOT NULL),
o AS (SELECT l.holding_id, d.yr, l.shares FROM l JOIN d ON l.yr = d.prev),
j AS (SELECT coalesce(n.holding_id, o.holding_id) AS holding_id, coalesce(n.yr, o.yr) AS yr,
             n.holding_id IS NOT NULL AS i_n, o.holding_id IS NOT NULL AS i_o, n.shares AS ns, o.shares AS os
      FROM n FULL JOIN o ON n.holding_id = o.holding_id AND n.yr = o.yr)
SELECT holding_id, yr || '-' || lpad(CAST((yr + 1) % 100 AS VARCHAR), 2, '0') AS financial_year,
       CASE WHEN NOT i_o THEN 'added' WHEN NOT i_n THEN 'removed' ELSE 'changed' END AS change_kind
FROM j WHERE NOT i_o OR NOT i_n OR ((ns IS NULL) <> (os IS NULL)) OR abs(ns - os) > 0.001
"""
}
