"""Reading registers: folders of tables, JSON documents, page text, links; and writing them."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import slug


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """A reader by the file's ending; all columns as they stand."""
    end = os.path.splitext(path.rstrip("/"))[1].lower()
    if end in (".csv", ".txt"):
        return read_csv(spark, path)
    if end == ".parquet":
        return spark.read.parquet(path)
    if end in (".json", ".jsonl"):
        return spark.read.json(path)
    raise ValueError(f"no reader for {end or 'a file without ending'}")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns text; Latin-1 where the bytes are no UTF-8."""
    df = spark.read.option("header", True).csv(path, encoding="UTF-8")
    bad = df.where(F.concat_ws("", *[F.col(f"`{c}`") for c in df.columns]).contains("�")).limit(1).count()
    return spark.read.option("header", True).csv(path, encoding="ISO-8859-1") if bad else df


def read_folder(spark: SparkSession, paths: list[str]) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """One frame a file, with its path as source_file; unreadable files are told and left out."""
    good, bad = {}, {}
    for p in paths:
        try:
            good[p] = read_any(spark, p).withColumn("source_file", F.lit(os.path.basename(p.rstrip("/"))))
        except Exception as e:  # noqa: BLE001
            bad[p] = str(e).splitlines()[0]
    return good, bad


def all_text(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def json_with_defaults(text: Column, schema: str, defaults: dict[str, object]) -> Column:
    """Fields of a JSON document, defaults where it is corrupt or lacks them."""
    j = F.from_json(text, schema)
    return F.struct(*[F.coalesce(j[k], F.lit(v)).alias(k) for k, v in defaults.items()])


def list_files(spark: SparkSession, folder: str, glob: str = "*.{pdf,PDF}") -> DataFrame:
    """Paths, sizes and first bytes of the files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder).select("path", "length", F.substring("content", 1, 4).alias("magic")).distinct()


def is_pdf(content: Column) -> Column:
    """Whether bytes begin like a PDF; empty or null does not."""
    return F.coalesce(F.hex(F.substring(content, 1, 4)) == "25504446", F.lit(False))


def title_page(text: Column, has_table: Column) -> Column:
    """A page with little text, or without a table and not much text."""
    n = F.length(F.trim(F.coalesce(text, F.lit(""))))
    return (n < 50) | (~has_table & (n < 500))


def scanned_page(text: Column) -> Column:
    return F.length(F.trim(F.coalesce(text, F.lit("")))) < 20


#: Words one of which a header line holds (fixed values).
HEADER_WORDS = ("folio", "name", "address", "amount", "shares", "dividend")


def text_rows(pages: DataFrame, page: str, text: str) -> DataFrame:
    """(page, line, cells, is_header): lines cut at two blanks or more; a header has three cells and a header word."""
    l = pages.select(page, F.posexplode(F.split(text, "\n")).alias("line", "t")).where("trim(t) <> ''")
    cells = F.split(F.trim("t"), r"\s{2,}")
    word = F.exists(F.array(*[F.lit(w) for w in HEADER_WORDS]), lambda w: F.contains(F.lower("t"), w))
    return l.select(page, "line", cells.alias("cells"), ((F.size(cells) >= 3) & word).alias("is_header"))


def padded(cells: Column, n: int) -> list[Column]:
    """n cells, '' where a row is short."""
    return [F.coalesce(F.get(cells, i), F.lit("")) for i in range(n)]


def register_lines(pages: DataFrame, page: str, text: str) -> DataFrame:
    """Records of policy registers: serial, long identity number, name, then address before a postcode;
    folio, amount and shares from the next two lines by the shape of their tokens, first token wins."""
    l = pages.select(page, F.posexplode(F.split(text, "\n")).alias("line", "t"))
    w = Window.partitionBy(page).orderBy("line")
    l = l.withColumns({"n1": F.lead("t", 1).over(w), "n2": F.lead("t", 2).over(w)})
    p = r"^\s*(\d{1,5})\s+(\d{14,16})\s+([A-Za-z][A-Za-z .]*?)(?:\s{2,}(.*))?$"
    g = lambda i: F.regexp_extract("t", p, i)
    pin = F.regexp_extract(g(4), r"\b(\d{6})\b", 1)
    follow = F.split(F.trim(F.concat_ws(" ", "n1", "n2")), r"\s+")
    first = lambda rx: F.coalesce(F.get(F.filter(follow, lambda x: x.rlike(rx)), 0), F.lit(""))
    return l.where(F.col("t").rlike(p)).select(
        page, "line", g(1).cast("int").alias("sr_no"), g(2).alias("identity"), F.trim(g(3)).alias("name"), pin.alias("pincode"),
        F.trim(F.regexp_replace(g(4), r"\b\d{6}\b.*$", "")).alias("address"),
        first(r"^[A-Z]{1,3}\d{4,}$").alias("folio"), first(r"^[\d,]+\.\d{2}$").alias("amount"), first(r"^\d{1,6}$").alias("shares"),
    )


#: A long number before a name (a fixed value: the pattern the design document gives).
IDENTITY_LINE = r"(\d{14,16})\s+([A-Za-z][A-Za-z\s]+)"


def identity_and_name(line: Column) -> Column:
    """struct(identity, name) of a line that prints a long number before a name; both '' where it does not."""
    rx = IDENTITY_LINE
    return F.struct(F.regexp_extract(line, rx, 1).alias("identity"), F.trim(F.regexp_extract(line, rx, 2)).alias("name"))


def inject_headers(tables: DataFrame, file: str, page: str, header: str, first_row: str) -> DataFrame:
    """The header of page 1 for later pages of the same width whose own first row is no header."""
    w = Window.partitionBy(file).orderBy(page)
    one = F.first(header).over(w)
    like = F.exists(F.col(first_row), lambda c: F.exists(F.array(*[F.lit(x) for x in HEADER_WORDS]), lambda k: F.contains(F.lower(c), k)))
    return tables.withColumn("used_header", F.when((F.size(header) == F.size(one)) & ~like, one).otherwise(F.col(header)))


def ocr_cells(words: DataFrame, page: str, headers: DataFrame, least: float = 30.0, height: int = 10, gap: int = 15) -> DataFrame:
    """Word boxes to lines and cells.

    words: page, word, left, top, width, conf; headers: page, col, right. A line begins at the
    first word that is not within height of the current line's first word (an aggregate over the
    sorted boxes of one page); a cell is the first header whose right edge plus gap reaches the
    word's left edge, else the last.
    """
    good = words.where(F.col("conf") > least)
    boxes = F.array_sort(F.collect_list(F.struct("top", "left", "word")))
    state = F.struct(F.lit(-1).cast("int").alias("n"), F.lit(-1_000_000).cast("int").alias("top"), F.array().cast("array<struct<line:int,left:int,word:string>>").alias("out"))

    def step(s: Column, b: Column) -> Column:
        fresh = b["top"] - s["top"] > height
        n = F.when(fresh, s["n"] + 1).otherwise(s["n"])
        row = F.struct(n.cast("int").alias("line"), b["left"].cast("int").alias("left"), b["word"].alias("word"))
        return F.struct(n.cast("int").alias("n"), F.when(fresh, b["top"]).otherwise(s["top"]).cast("int").alias("top"), F.concat(s["out"], F.array(row)).alias("out"))

    lines = good.groupBy(page).agg(boxes.alias("b")).select(page, F.inline(F.aggregate("b", state, step, lambda s: s["out"])))
    heads = headers.groupBy(page).agg(F.array_sort(F.collect_list(F.struct("right", "col"))).alias("h"))
    pick = F.coalesce(F.get(F.filter("h", lambda x: x["right"] + gap >= F.col("left")), 0), F.element_at("h", -1))
    cell = lines.join(heads, page).select(page, "line", "left", "word", pick["col"].alias("col"))
    return cell.groupBy(page, "line", "col").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("left", "word"))), lambda x: x["word"]), " ").alias("cell"))


def links(pages: DataFrame, page: str, html: str, words: list[str], ending: str = ".pdf") -> DataFrame:
    """(page, pos, href, score): links with the ending or a word in target or text, the first of equal targets.

    score is the number of words present in text and target.
    """
    a = F.regexp_extract_all(F.col(html), F.lit(r'(?is)<a\s[^>]*?href\s*=\s*"[^"]*"[^>]*>.*?</a>'), 0)
    l = pages.select(page, F.posexplode(a).alias("pos", "a"))
    l = l.select(page, "pos", F.regexp_extract("a", r'(?is)href\s*=\s*"([^"]*)"', 1).alias("href"), F.lower("a").alias("low"))
    score = sum((F.contains("low", F.lit(w)).cast("int") for w in words), F.lit(0))
    l = l.withColumn("score", score).where((F.col("score") > 0) | F.lower("href").endswith(ending))
    w = Window.partitionBy(page, "href").orderBy("pos")
    return l.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").select(page, "pos", "href", "score")


def best_links(found: DataFrame, page: str, n: int) -> DataFrame:
    """The n best links of each page by score, then by target descending (a top-k report)."""
    w = Window.partitionBy(page).orderBy(F.desc("score"), F.desc("href"))
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


# ---- sinks -------------------------------------------------------------------------------------


def write_partitioned(df: DataFrame, path: str, company: str, year: str) -> None:
    """One folder a company slug and year, replaced as a whole by Spark's committer."""
    df.withColumns({"slug": slug(company), "fy": F.col(year)}).write.mode("overwrite").partitionBy("slug", "fy").parquet(path)


#: Old column names and the names the query side knows (fixed values); each is a copy where the target is absent.
RENAMES = {"name": "full_name", "mobile": "contact_number", "contact": "contact_number", "pan_number": "pan", "total_dividend": "dividend", "current_holding": "shares", "parsed_at": "processed_at"}


def with_legacy_names(df: DataFrame) -> DataFrame:
    out = df
    for old, new in RENAMES.items():
        if old in out.columns and new not in out.columns:
            out = out.withColumn(new, F.col(old))
    return out


def swap_table(df: DataFrame, path: str) -> None:
    """Replaces a table: written beside it, then moved in its place by the file system."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(path + "__new")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    new, old, keep = (jvm.org.apache.hadoop.fs.Path(path + s) for s in ("__new", "", "__old"))
    fs = new.getFileSystem(conf)
    fs.delete(keep, True)
    if fs.exists(old):
        fs.rename(old, keep)
    fs.rename(new, old)
    fs.delete(keep, True)
