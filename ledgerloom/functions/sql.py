"""SQL functions of a session: the same rules as functions.text, as temporary functions the planner inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: name -> (parameters and result, body).
FUNCTIONS = {
    "ll_squeeze": ("s STRING) RETURNS STRING", r"trim(regexp_replace(s, r'\s+', ' '))"),
    "ll_title_case": ("s STRING) RETURNS STRING", r"array_join(transform(regexp_extract_all(s, r'(\p{L}+|[^\p{L}]+)', 1), x -> initcap(x)), '')"),
    "ll_slug": ("s STRING) RETURNS STRING", r"regexp_replace(regexp_replace(lower(coalesce(s, '')), '[^a-z0-9]+', '-'), '^-+|-+$', '')"),
    "ll_clean_folio": ("s STRING) RETURNS STRING", r"replace(upper(trim(regexp_replace(coalesce(s, ''), r'\s+', ' '))), ' ', '')"),
    "ll_to_float": ("s STRING) RETURNS DOUBLE", r"coalesce(CASE WHEN regexp_replace(s, r'[₹,\s]', '') RLIKE r'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$' THEN try_cast(regexp_replace(s, r'[₹,\s]', '') AS DOUBLE) END, 0.0D)"),
    "ll_identity_name": ("s STRING) RETURNS STRING", r"trim(regexp_replace(regexp_replace(lower(coalesce(s, '')), '[^a-z0-9 ]', ' '), r'\s+', ' '))"),
    "ll_upload_year": ("s STRING) RETURNS STRING", r"coalesce(nullif(regexp_extract(regexp_replace(s, r'\.[^.]+$', ''), r'(20[0-2]\d)', 1), ''), 'unknown')"),
}


def register(spark: SparkSession) -> list[str]:
    """Makes the functions known to the session's SQL; returns their names."""
    for name, (head, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({head} RETURN {body}")
    return sorted(FUNCTIONS)
