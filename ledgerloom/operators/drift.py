"""Schemas that drift between files: tagged-union inference over the columns of yearly files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.registers import fy_start
from ledgerloom.session import checkpointed

#: Texts that stand for an empty cell (fixed values).
FILLERS = ("", "-", "--", "na", "n/a", "n.a.", "nil", "none", "null", "unknown", "not available")
#: Written booleans (fixed values).
TRUE, FALSE = ("true", "t", "yes", "y"), ("false", "f", "no", "n")
#: Smallest share of like content for two columns to be the same under different headers.
SAME = 0.5
#: Numbers of one row that differ by no more than this share are nearly equal.
NEAR = 0.05
#: Words that mark a column of one year's dividend.
DIVIDEND = r"(?i)div"


def cells(records: DataFrame) -> DataFrame:
    """(file_id, row_no, header, kind, text): every cell of the JSON payloads, with its JSON type.

    kind is number, string or boolean, null for an empty cell. Repeated lines count once.
    Unreadable payloads and non-objects have no cells.
    """
    r = records.select("file_id", "row_no", "payload").where("file_id is not null").dropDuplicates()
    v = F.try_parse_json("payload")
    ok = F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))
    # One plan node per step: a generator cannot be nested in other expressions.
    r = r.select("file_id", "row_no", F.when(ok, v).alias("v")).where("v is not null")
    r = r.select("file_id", "row_no", F.explode(F.expr("cast(v as map<string, variant>)")).alias("header", "cell"))
    t = F.schema_of_variant("cell")
    kind = F.when(t == "STRING", "string").when(t == "BOOLEAN", "boolean").when(t == "VOID", None)
    kind = F.when(t.isNull() | (t == "VOID"), None).otherwise(F.coalesce(kind, F.when(t.rlike("^(OBJECT|ARRAY)"), "string").otherwise("number")))
    return r.select("file_id", "row_no", "header", kind.alias("kind"), F.expr("try_cast(cell as string)").alias("text"))


def header_key(header: Column) -> Column:
    """The same for headers that differ only in letter case or white space; a dividend column by its year."""
    return F.lower(F.trim(F.regexp_replace(header, r"\s+", " ")))


def dividend_year(header: Column) -> Column:
    """The year a dividend column names; null for every other column."""
    flat = F.regexp_replace(header, r"\s+", " ")
    return F.when(flat.rlike(DIVIDEND), fy_start(flat))


def canonical(text: Column) -> Column:
    """Canonical conversion of the typed branches: a value reads the same as number or text."""
    low = F.lower(F.trim(text))
    bare = F.regexp_replace(low, r"^(rs\.?|inr|₹)\s*|[,\s]", "")
    num = F.when(bare.rlike(r"^[+-]?\d+(\.\d+)?$"), F.round(bare.try_cast("double"), 2).cast("string"))
    word = F.when(low.isin(*TRUE), "true").when(low.isin(*FALSE), "false")
    return F.when(low.isin(*FILLERS), None).otherwise(F.coalesce(num, word, F.regexp_replace(low, r"[^\p{L}\p{N}]+", "")))


def shape(text: Column) -> Column:
    """Digits as 9, letters as a, runs of letters as one."""
    s = F.regexp_replace(F.lower(F.trim(text)), r"\p{L}+", "a")
    # Long texts by their hash: a shape is only compared for being equal.
    s = F.regexp_replace(s, r"\d", "9")
    return F.when(F.length(s) > 40, F.hex(F.xxhash64(s))).otherwise(s)


def file_pairs(files: DataFrame) -> DataFrame:
    """(file_id, before_id): each file of a register with that of the year before in raw_files.

    Of several files for one register and year the last delivered (then the largest id) stands.
    """
    f = files.select("file_id", "register_id", fy_start("financial_year").alias("y"), "delivered_at").where("file_id is not null and register_id is not null and y is not null")
    f = f.groupBy("register_id", "y").agg(F.max(F.struct("delivered_at", "file_id")).alias("m")).select("register_id", "y", "m.file_id")
    w = Window.partitionBy("register_id").orderBy("y")  # one row per year: at most 201
    return f.select("register_id", "y", "file_id", F.lag("file_id").over(w).alias("before_id"))


def column_links(files: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The typed columns of every file and which columns of consecutive files are the same.

    Tagged-union inference: each column keeps the alternative JSON types of its cells with their
    counts; the schemas of consecutive files are fused column by column. Columns are the same if
    their headers are (apart from case and white space; a dividend column by the year it names),
    or if their content is: cells compared in canonical form over rows aligned on values that are
    unique in a column of the same header in both files. Alike is: equal in at least half of the
    aligned rows; or numbers that run in parallel (nearly equal, or one constant step, in most aligned rows); or three
    quarters of all values shared wherever they stand (serial numbers); or, where values are new each year, dates of one format or words of one small vocabulary. Each column
    takes part in one link: pairs must be mutual best.

    All work is joins and aggregates on (file, column, value) or (file, row): a file with a third
    of all rows is spread over all tasks.

    Returns (pairs, cells, columns, links); links has (file_id, before_id, old, new) by header key.
    """
    pairs = checkpointed(file_pairs(files))
    c = cells(records).withColumns({"key": header_key(F.col("header")), "div": dividend_year(F.col("header"))})
    # Read many times below: cells, columns and open pairs are written once to the shared folder.
    c = checkpointed(c.withColumns({"canon": canonical(F.col("text")), "shape": shape(F.col("text"))}))
    # Counted by value first, so that distinct values are exact and a large column is no task of its own.
    values = c.groupBy("file_id", "key", "canon", "kind").agg(F.min("header").alias("header"), F.first("div").alias("div"), F.count(F.lit(1)).alias("n"))
    kinds = lambda k: F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"k_{k}")
    values = values.groupBy("file_id", "key", "canon").agg(F.min("header").alias("header"), F.first("div").alias("div"), kinds("number"), kinds("string"), kinds("boolean"), F.sum(F.when(F.col("canon").isNotNull(), F.col("n")).otherwise(0)).alias("n_c"))
    n = lambda k: F.sum(f"k_{k}")
    columns = (
        values.groupBy("file_id", "key")
        .agg(F.min("header").alias("header"), F.first("div").alias("div"), n("number").alias("n_number"), n("string").alias("n_string"), n("boolean").alias("n_boolean"),
             F.sum("n_c").alias("n_canon"), F.count("canon").alias("n_values"))
        .withColumn("kind", F.when(F.greatest("n_number", "n_string", "n_boolean") == 0, None)
                    .when((F.col("n_number") >= F.col("n_string")) & (F.col("n_number") >= F.col("n_boolean")), "number")
                    .when(F.col("n_string") >= F.col("n_boolean"), "string").otherwise("boolean"))
    )
    columns = checkpointed(columns)
    two = pairs.where("before_id is not null").select("file_id", "before_id")
    side = lambda df, s, *keep: df.select(F.col("file_id").alias("before_id" if s == "o" else "file_id"), *[F.col(k).alias(f"{s}_{k}") for k in keep])
    meta = ("key", "div", "n_canon", "n_values")
    both = two.join(side(columns, "o", *meta), "before_id").join(side(columns, "n", *meta), "file_id")
    same_header = both.where("o_key = n_key").select("file_id", "before_id", F.col("o_key").alias("old"), F.col("n_key").alias("new"))

    # Columns left over on both sides; a dividend column can only be one of the same year.
    left = (
        both.join(same_header.select("file_id", F.col("old").alias("o_key")), ["file_id", "o_key"], "left_anti")
        .join(same_header.select("file_id", F.col("new").alias("n_key")), ["file_id", "n_key"], "left_anti")
        .where("o_div <=> n_div")
    )
    left = checkpointed(left)
    # Rows aligned on unique values under equal headers: one vote per column, the row with most votes wins.
    lone = c.where("canon is not null and length(canon) >= 4").groupBy("file_id", "key", "canon").agg(F.min("row_no").alias("row"), F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")
    votes = (
        same_header.select("file_id", "before_id", F.col("old").alias("key"))
        .join(lone.select(F.col("file_id").alias("before_id"), "key", "canon", F.col("row").alias("o_row")), ["before_id", "key"])
        .join(lone.select("file_id", "key", "canon", F.col("row").alias("n_row")), ["file_id", "key", "canon"])
        .groupBy("file_id", "before_id", "o_row", "n_row").agg(F.count(F.lit(1)).alias("v"))
    )
    best = votes.groupBy("file_id", "before_id", "n_row").agg(F.max_by("o_row", F.struct("v", -F.col("o_row"))).alias("o_row"))
    best = best.groupBy("file_id", "before_id", "o_row").agg(F.min("n_row").alias("n_row"))
    cell = c.select("file_id", "row_no", "key", "canon", "shape")
    old = cell.select(F.col("file_id").alias("before_id"), F.col("row_no").alias("o_row"), F.col("key").alias("o_key"), F.col("canon").alias("o_canon"))
    new = cell.select("file_id", F.col("row_no").alias("n_row"), F.col("key").alias("n_key"), F.col("canon").alias("n_canon"))
    need = left.select("file_id", "before_id", "o_key", "n_key")
    a, b = F.col("o_canon").try_cast("double"), F.col("n_canon").try_cast("double")
    aligned = (
        best.join(need, ["file_id", "before_id"])
        .join(old, ["before_id", "o_row", "o_key"])
        .join(new, ["file_id", "n_row", "n_key"])
        .where("o_canon is not null and n_canon is not null")
        .groupBy("file_id", "o_key", "n_key", F.round(b - a, 2).alias("step"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("o_canon") == F.col("n_canon")).cast("int")).alias("eq"), F.sum((F.abs(b - a) <= F.abs(a) * NEAR).cast("int")).alias("near"))
        .groupBy("file_id", "o_key", "n_key")
        .agg(F.sum("n").alias("rows"), F.sum("near").alias("near"), (F.sum("eq") / F.sum("n")).alias("agree"), F.max(F.when(F.col("step").isNotNull() & (F.col("step") != 0), F.col("n"))).alias("in_step"))
    )
    # Content as a whole: shared values and shared shapes, as shares of the smaller column.
    def shared(what: str, name: str) -> DataFrame:
        g = c.where(f"{what} is not null and canon is not null").groupBy("file_id", "key", what).agg(F.count(F.lit(1)).alias("n"))
        o = g.select(F.col("file_id").alias("before_id"), F.col("key").alias("o_key"), what, F.col("n").alias("a"))
        w = g.select("file_id", F.col("key").alias("n_key"), what, F.col("n").alias("b"))
        return need.join(o, ["before_id", "o_key"]).join(w, ["file_id", "n_key", what]).groupBy("file_id", "o_key", "n_key").agg(F.sum(F.least("a", "b")).alias(name))

    k = ["file_id", "o_key", "n_key"]
    s = left.join(aligned, k, "left").join(shared("canon", "c_same"), k, "left").join(shared("shape", "s_same"), k, "left")
    least = F.greatest(F.least("o_n_canon", "n_n_canon"), F.lit(1))
    overlap = F.coalesce(F.col("c_same"), F.lit(0)) / least
    form = F.coalesce(F.col("s_same"), F.lit(0)) / least
    enough = F.coalesce(F.col("rows") >= 3, F.lit(False))
    agree = F.when(enough, F.coalesce("agree", F.lit(0.0))).otherwise(overlap)
    parallel = enough & (F.greatest("in_step", "near") >= 0.6 * F.col("rows"))
    dated = (form >= 0.8) & F.col("o_date") & F.col("n_date")
    words = (F.greatest("o_n_values", "n_n_values") <= 12) & (F.greatest("o_n_values", "n_n_values") * 1.5 <= least) & (overlap >= 0.5)
    share = (
        c.where("canon is not null").groupBy("file_id", "key").agg((F.avg(F.col("text").rlike(r"^\s*\d{1,4}[-/.]\d{1,2}[-/.]\d{1,4}").cast("int")) >= 0.5).alias("date"))
    )
    s = s.join(share.select(F.col("file_id").alias("before_id"), F.col("key").alias("o_key"), F.col("date").alias("o_date")), ["before_id", "o_key"], "left").join(
        share.select("file_id", F.col("key").alias("n_key"), F.col("date").alias("n_date")), ["file_id", "n_key"], "left"
    )
    by_year = F.col("o_div").isNotNull()
    score = F.when(by_year, 2.0 + agree).when(agree >= SAME, 1.0 + agree + overlap / 10).when(parallel, 1.2).when(overlap >= 0.75, 1.0 + overlap / 10).when(words | dated, 0.5 + overlap / 2)
    s = s.select("file_id", "before_id", "o_key", "n_key", score.alias("score")).where("score is not null")
    rank = lambda by, other: F.row_number().over(Window.partitionBy("file_id", by).orderBy(F.desc("score"), other))
    renamed = s.withColumns({"r1": rank("o_key", "n_key"), "r2": rank("n_key", "o_key")}).where("r1 = 1 and r2 = 1")
    links = same_header.unionByName(renamed.select("file_id", "before_id", F.col("o_key").alias("old"), F.col("n_key").alias("new")))
    return pairs, c, columns, checkpointed(links)


def drift_report(files: DataFrame, records: DataFrame) -> DataFrame:
    """p7_found: (file_id, change_kind, old_column, new_column) of each file against the year before.

    added, removed, renamed and type_changed (the JSON type of most non-null values differs; a
    renamed column can have both). Headers appear as printed; of several spellings in one file the
    smallest. A column whose cells are all null has no type. A file without rows has no columns.
    """
    pairs, _, columns, links = column_links(files, records)
    two = pairs.where("before_id is not null").select("file_id", "before_id")
    o = columns.select(F.col("file_id").alias("before_id"), F.col("key").alias("old"), F.col("header").alias("o_header"), F.col("kind").alias("o_kind"))
    n = columns.select("file_id", F.col("key").alias("new"), F.col("header").alias("n_header"), F.col("kind").alias("n_kind"))
    blank, out = F.lit(""), ["file_id", "change_kind", "old_column", "new_column"]
    row = lambda df, kind, a, b: df.select("file_id", F.lit(kind).alias("change_kind"), a.alias("old_column"), b.alias("new_column"))
    added = two.join(n, "file_id").join(links, ["file_id", "new"], "left_anti")
    removed = two.join(o, "before_id").join(links, ["file_id", "old"], "left_anti")
    both = links.join(o, ["before_id", "old"]).join(n, ["file_id", "new"])
    H = F.col
    return (
        row(added, "added", blank, H("n_header"))
        .unionByName(row(removed, "removed", H("o_header"), blank))
        .unionByName(row(both.where("old <> new"), "renamed", H("o_header"), H("n_header")))
        .unionByName(row(both.where("o_kind <> n_kind"), "type_changed", H("o_header"), H("n_header")))
        .select(*out)
    )


def consistent_cells(files: DataFrame, records: DataFrame) -> DataFrame:
    """All files read into one table: one row per cell under the first header its column ever had.

    Conflicting types are kept as typed branches (as_number, as_string, as_boolean) beside the
    canonical value. Chains of renames are followed by pointer doubling over the columns (not the
    cells): eight doublings cover the 201 years a register can have.
    """
    pairs, c, columns, links = column_links(files, records)
    up = links.select(F.col("file_id").alias("f"), F.col("new").alias("k"), F.col("before_id").alias("pf"), F.col("old").alias("pk"))
    at = columns.select(F.col("file_id").alias("f"), F.col("key").alias("k")).join(up, ["f", "k"], "left")
    at = at.select("f", "k", F.coalesce("pf", "f").alias("pf"), F.when(F.col("pf").isNull(), F.col("k")).otherwise(F.col("pk")).alias("pk"))
    for _ in range(8):
        at = checkpointed(at)
        far = at.select(F.col("f").alias("pf"), F.col("k").alias("pk"), F.col("pf").alias("qf"), F.col("pk").alias("qk"))
        at = at.join(far, ["pf", "pk"]).select("f", "k", F.col("qf").alias("pf"), F.col("qk").alias("pk"))
    root = at.join(columns.select(F.col("file_id").alias("pf"), F.col("key").alias("pk"), F.col("header").alias("first_header")), ["pf", "pk"])
    root = root.select(F.col("f").alias("file_id"), F.col("k").alias("key"), F.regexp_replace("first_header", r"\s+", " ").alias("column_name"))
    is_ = lambda k: F.when(F.col("kind") == k, F.col("text"))
    return (
        c.join(root, ["file_id", "key"])
        .join(pairs.select("file_id", "register_id"), "file_id", "left")
        .select("register_id", "file_id", "row_no", "column_name", is_("number").try_cast("double").alias("as_number"), is_("string").alias("as_string"), is_("boolean").alias("as_boolean"), F.col("canon").alias("canonical"))
    )
