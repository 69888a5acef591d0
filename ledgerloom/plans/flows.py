"""Queries of sources, headers and progress events, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators.drift import cells
from ledgerloom.sources import headers, ingest
from ledgerloom.session import table
from ledgerloom.streaming import progress

Q, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_P = """p AS (SELECT user_id AS job_id, event_id AS seq, ts, event_type AS step, CAST(floor(value) AS BIGINT) % 101 AS pct,
  CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'done' ELSE 'running' END AS status FROM events)"""


def _p(spark, sf):
    return progress.from_events(table(spark, sf, "events"))


@query("WITH " + _P + " SELECT job_id, seq, status FROM p QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY seq DESC) <= 500")
def t01_last_events(spark, sf):
    return progress.last_events(_p(spark, sf)).select("job_id", "seq", "status")


@query("WITH " + _P + ", c AS (SELECT job_id, min(seq) FILTER (WHERE status IN ('done', 'error')) AS cut FROM p GROUP BY 1) SELECT p.job_id, p.seq, p.status FROM p JOIN c USING (job_id) WHERE cut IS NULL OR seq <= cut")
def t02_until_terminal(spark, sf):
    return progress.until_terminal(_p(spark, sf)).select("job_id", "seq", "status")


@query("WITH " + _P + " SELECT job_id, arg_max(step, seq) AS step, arg_max(pct, seq) AS pct, arg_max(status, seq) AS status, count(*) AS events FROM p GROUP BY 1")
def t03_latest_status(spark, sf):
    return progress.latest_status(_p(spark, sf)).select("job_id", "step", F.col("pct").cast("long").alias("pct"), "status", "events")


@query("SELECT event_id, CASE WHEN event_type = 'view' THEN CAST(trunc(60 * least(value / 100, 1.0)) AS INT) WHEN event_type = 'click' THEN CAST(trunc(60 + 30 * least(value / 100, 1.0)) AS INT) WHEN event_type = 'signup' THEN 91 WHEN event_type = 'purchase' THEN 100 ELSE 0 END AS overall FROM events")
def t04_bands(spark, sf):
    step = F.when(F.col("event_type") == "view", "download").when(F.col("event_type") == "click", "parse").when(F.col("event_type") == "signup", "merge").when(F.col("event_type") == "purchase", "done").otherwise("")
    return table(spark, sf, "events").withColumn("s", step).select("event_id", progress.band_percent(F.col("s"), F.col("value") / 100).alias("overall"))


@query("WITH " + _P + ", g AS (SELECT job_id, count(*) AS n, epoch(max(ts))::BIGINT - epoch(min(ts))::BIGINT AS s FROM (SELECT job_id, date_trunc('second', ts) AS ts FROM p) GROUP BY 1) SELECT job_id, n, CASE WHEN s > 0 THEN round(n * 3600.0 / s, 4) END AS per_hour, CASE WHEN s > 0 THEN round((100000 - n) * s / (n * 3600.0), 4) END AS hours_left FROM g")
def t05_throughput(spark, sf):
    return progress.throughput(_p(spark, sf), 100000)


@query("WITH " + _P + ", g AS (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY job_id ORDER BY ts, seq) AS gap_us FROM p) SELECT job_id, seq, gap_us FROM g WHERE gap_us < 60000000")
def t06_too_soon(spark, sf):
    return progress.too_soon(_p(spark, sf), "job_id", 60).select("job_id", "seq", "gap_us")


@query("WITH " + _P + " SELECT job_id, seq, count(*) OVER w AS total, CAST(sum(CASE WHEN status = 'error' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS failed FROM p WINDOW w AS (PARTITION BY job_id ORDER BY seq ROWS UNBOUNDED PRECEDING)")
def t07_running_counts(spark, sf):
    return progress.running_counts(_p(spark, sf))


@query("SELECT date_trunc('hour', ts) AS start, event_type AS step, count(*) AS n FROM events GROUP BY 1, 2")
def t08_windows(spark, sf):
    """The streaming window counts, run over the table (the same function takes the stream)."""
    d = _p(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    return progress.counts_by_window(d).select(F.col("start").cast("timestamp_ntz").alias("start"), "step", "n")


_HEADER_SQL = "CASE " + " ".join(
    f"WHEN regexp_matches(low, '{'|'.join('(' + p + ')' for p in patterns)}') THEN '{name}'" for name, patterns in headers.SYNONYMS.items()
) + " END"


@query(
    r"""
WITH k AS (SELECT DISTINCT trim(regexp_replace(lower(unnest(json_keys(payload))), '\s+', ' ', 'g')) AS low FROM raw_records) SELECT low AS header, """ + _HEADER_SQL + """ AS canonical FROM k"""
)
def h01_headers(spark, sf):
    """Every header printed in the yearly files and the canonical column it names (H-A)."""
    h = cells(table(spark, sf, "raw_records")).select(F.trim(F.regexp_replace(F.lower("header"), r"\s+", " ")).alias("header")).distinct()
    return h.select("header", headers.header_column(F.col("header")).alias("canonical"))


@query("SELECT doc_id, length(trim(coalesce(text, ''))) < 20 AS scanned, length(trim(coalesce(text, ''))) < 50 OR (NOT contains(coalesce(text, ''), ' | ') AND length(trim(coalesce(text, ''))) < 500) AS title_page FROM documents")
def s11_pages(spark, sf):
    """Documents taken as pages: scanned ones and title pages."""
    d = table(spark, sf, "documents")
    return d.select("doc_id", ingest.scanned_page(F.col("text")).alias("scanned"), ingest.title_page(F.col("text"), F.coalesce(F.contains("text", F.lit(" | ")), F.lit(False))).alias("title_page"))


@query(
    r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc_id, line, t, regexp_split_to_array(trim(t), '\s{2,}') AS cells FROM l WHERE trim(t) <> '')
SELECT doc_id, CAST(line AS INT) AS line, len(cells) AS n_cells, cells[1] AS first_cell, len(cells) >= 3 AND regexp_matches(lower(t), 'folio|name|address|amount|shares|dividend') AS is_header FROM c"""
)
def s14_text_rows(spark, sf):
    r = ingest.text_rows(table(spark, sf, "documents").where("text is not null"), "doc_id", "text")
    return r.select("doc_id", "line", F.size("cells").alias("n_cells"), F.get("cells", F.lit(0)).alias("first_cell"), "is_header")


def _pages(spark, sf):
    """A page of links a company."""
    s = F.lower(F.col("nse_symbol"))
    html = F.concat(F.lit('<a href="/'), s, F.lit('/unpaid.pdf">Unclaimed dividend</a> <a href="/about">About</a> <a href="/iepf/'), s, F.lit('">IEPF list</a> <a href="/'), s, F.lit('/unpaid.pdf">again</a>'))
    return table(spark, sf, "companies").where("nse_symbol is not null").select(F.col("id").alias("page_id"), html.alias("html"))


@query(
    """
SELECT id AS page_id, 0 AS pos, '/' || lower(nse_symbol) || '/unpaid.pdf' AS href, 3 AS score FROM companies WHERE nse_symbol IS NOT NULL
UNION ALL SELECT id, 2, '/iepf/' || lower(nse_symbol), 1 FROM companies WHERE nse_symbol IS NOT NULL"""
)
def s19_links(spark, sf):
    return ingest.links(_pages(spark, sf), "page_id", "html", ["unclaimed", "dividend", "unpaid", "iepf"]).select("page_id", "pos", "href", "score")


@query("SELECT id AS page_id, '/' || lower(nse_symbol) || '/unpaid.pdf' AS href, 1 AS place FROM companies WHERE nse_symbol IS NOT NULL UNION ALL SELECT id, '/iepf/' || lower(nse_symbol), 2 FROM companies WHERE nse_symbol IS NOT NULL")
def s20_best_links(spark, sf):
    return ingest.best_links(s19_links(spark, sf), "page_id", 5).select("page_id", "href", "place")


#: Columns of the largest table whose text is the same in every engine (all but the amount, whose digits are not).
_TEXTS = ("id", "folio_no", "company_name", "demat_account", "full_name", "father_husband_name", "address", "city", "state", "pincode", "current_holding", "source_pdf", "pdf_financial_year", "date_processed", "mobile_number", "email_id", "created_at")


@query("SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _TEXTS) + " FROM shareholders")
def s05_all_text(spark, sf):
    return ingest.all_text(table(spark, sf, "shareholders").select(*_TEXTS))


@query("SELECT event_id, coalesce(TRY_CAST(json_extract(props, '$.k') AS INT), 0) AS k, 'none' AS missing FROM events")
def s06_json_defaults(spark, sf):
    j = ingest.json_with_defaults(F.col("props"), "k int, missing string", {"k": 0, "missing": "none"})
    return table(spark, sf, "events").select("event_id", j.alias("j")).select("event_id", "j.k", "j.missing")


@query("SELECT id, full_name, total_dividend AS dividend, current_holding AS shares FROM shareholders")
def s27_legacy_names(spark, sf):
    return ingest.with_legacy_names(table(spark, sf, "shareholders").select("id", "full_name", "total_dividend", "current_holding")).select("id", "full_name", "dividend", "shares")
