"""Page text, OCR boxes, links, headers, sinks; and the streams end to end."""

import os

from pyspark.sql import functions as F

from ledgerloom.sources import headers, ingest
from ledgerloom.streaming import progress


def test_headers():
    assert headers.map_header("Name of Shareholder") == "name"
    assert headers.map_header("Company") is None
    assert headers.fy_header("Final Dividend Amount\nFY 2017-2018 (₹)") == "dividend_final_fy_2017_18"
    names, issues = headers.canonical_names(["Folio No", "Ledger Folio", "Dividend FY 2017-18", "Dividend 2017-18", "Zzz"])
    assert names == ["folio_no", None, "dividend_fy_2017_18", "dividend_fy_2017_18_1", None]
    assert issues == ["Ledger Folio", "Zzz"]
    alias = {"folio_no": ["Folio Number"], "name": ["Investor Name"]}
    assert [headers.map_alias(h, alias) for h in ("folio number", "name", "Dividend FY 2018-19", "Name of Investor", "qqq")] == ["folio_no", "name", "dividend_fy_2018_19", "name", None]


def test_register_lines(spark):
    text = "12  12345678901234 ASHA RAO  1 MG Road, Pune 411001 x\nAB12345 1,234.50\n200\nnoise"
    r = ingest.register_lines(spark.createDataFrame([(1, text)], "p int, t string"), "p", "t").first()
    assert (r["sr_no"], r["identity"], r["name"], r["pincode"], r["address"], r["folio"], r["amount"], r["shares"]) == (12, "12345678901234", "ASHA RAO", "411001", "1 MG Road, Pune", "AB12345", "1,234.50", "200")


def test_ocr_cells(spark):
    w = spark.createDataFrame([(1, "A", 0, 0, 90.0), (1, "Rao", 100, 4, 90.0), (1, "B", 2, 30, 90.0), (1, "junk", 2, 60, 10.0), (1, "far", 900, 31, 90.0)], "p int, word string, left int, top int, conf double")
    h = spark.createDataFrame([(1, "folio", 40), (1, "name", 160)], "p int, col string, right int")
    got = sorted((r["line"], r["col"], r["cell"]) for r in ingest.ocr_cells(w, "p", h).collect())
    assert got == [(0, "folio", "A"), (0, "name", "Rao"), (1, "folio", "B"), (1, "name", "far")]


def test_header_injection(spark):
    df = spark.createDataFrame([("f", 1, ["Folio", "Name"], ["1", "x"]), ("f", 2, ["a", "b"], ["2", "y"]), ("f", 3, ["c"], ["3"]), ("f", 4, ["d", "e"], ["folio", "z"])], "file string, page int, header array<string>, row array<string>")
    assert [r["used_header"] for r in ingest.inject_headers(df, "file", "page", "header", "row").orderBy("page").collect()] == [["Folio", "Name"], ["Folio", "Name"], ["c"], ["d", "e"]]


def test_bytes_and_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "b.PDF").write_bytes(b"\x89PNG")
    (tmp_path / "c.txt").write_bytes(b"")
    got = {os.path.basename(r["path"]): r["ok"] for r in ingest.list_files(spark, str(tmp_path)).withColumn("ok", ingest.is_pdf(F.col("magic"))).collect()}
    assert got == {"a.pdf": True, "b.PDF": False}
    (tmp_path / "l.csv").write_bytes("a,b\nJosé,1\n".encode("latin-1"))
    assert ingest.read_csv(spark, str(tmp_path / "l.csv")).first()["a"] == "José"
    good, bad = ingest.read_folder(spark, [str(tmp_path / "l.csv"), str(tmp_path / "no.parquet")])
    assert len(good) == 1 and len(bad) == 1


def test_swap_and_partitions(spark, tmp_path):
    p = str(tmp_path / "t")
    ingest.swap_table(spark.range(3).toDF("a"), p)
    ingest.swap_table(spark.range(5).toDF("a"), p)
    assert spark.read.parquet(p).count() == 5
    ingest.write_partitioned(spark.createDataFrame([("A & B", "2017-18", 1)], "c string, y string, v int"), str(tmp_path / "q"), "c", "y")
    assert os.path.isdir(tmp_path / "q" / "slug=a-b" / "fy=2017-18")


def test_streams_match_batches(spark, tmp_path):
    sf = "/root/testdata/sf0.001/events.parquet"
    src = tmp_path / "in"
    ev = spark.read.parquet(sf)
    ev.where("event_id % 2 = 0").coalesce(1).write.parquet(str(src))
    s = progress.event_stream(spark, str(src))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    progress.run_once(progress.terminal_stream(s, forget_hours=10_000), out, ck)
    ev.where("event_id % 2 = 1").coalesce(1).write.mode("append").parquet(str(src))
    progress.run_once(progress.terminal_stream(progress.event_stream(spark, str(src)), forget_hours=10_000), out, ck)  # goes on where it was
    got = spark.read.parquet(out)
    jobs = {r[0] for r in progress.from_events(ev).where(F.col("status").isin("done", "error")).select("job_id").distinct().collect()}
    assert {r["job_id"] for r in got.select("job_id").distinct().collect()} == jobs
    assert got.count() == len(jobs)


def test_window_counts_stream(spark, tmp_path):
    src = tmp_path / "in"
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").coalesce(1).write.parquet(str(src))
    q = progress.counts_by_window(progress.event_stream(spark, str(src))).writeStream.format("memory").queryName("wins").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination()
    assert spark.table("wins").agg(F.sum("n")).first()[0] == spark.read.parquet(str(src)).count()
