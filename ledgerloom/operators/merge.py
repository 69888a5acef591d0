"""Merging loosely structured tables into one canonical table."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import text as T

FY_COLUMN = re.compile(r"^dividend_(?:(final|interim|special)_)?fy_(\d{4})_(\d{2})(?:_\d+)?$")


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union all by column name; a column a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def scrub(df: DataFrame) -> DataFrame:
    """The register tools' "no nulls" edge: text null, nan and <NA> to '', numbers null to 0."""
    out = []
    for c, t in df.dtypes:
        col = F.col(f"`{c}`")
        if t == "string":
            out.append(F.when(col.isin("nan", "<NA>"), "").otherwise(F.coalesce(col, F.lit(""))).alias(c))
        elif t in ("int", "bigint", "double", "float", "smallint") or t.startswith("decimal"):
            out.append(F.coalesce(col, F.lit(0).cast(t)).alias(c))
        else:
            out.append(col)
    return df.select(*out)


def fy_columns(df: DataFrame) -> dict[str, list[str]]:
    """Base name dividend_fy_YYYY_YY of each year with its variants (base, final_, interim_, special_, numbered)."""
    by: dict[str, list[str]] = {}
    for c in df.columns:
        if m := FY_COLUMN.match(c):
            by.setdefault(f"dividend_fy_{m[2]}_{m[3]}", []).append(c)
    return {k: sorted(v, key=lambda c: ["", "final", "interim", "special"].index(FY_COLUMN.match(c)[1] or "")) for k, v in sorted(by.items())}


def consolidate(df: DataFrame) -> DataFrame:
    """One column a financial year, the greatest of its variants (exact base only); base_N dropped where base exists."""
    years = fy_columns(df)
    variants = {c for v in years.values() for c in v}
    numbered = {c for c in df.columns if (m := re.match(r"^(.*)_\d+$", c)) and m[1] in df.columns and c not in variants}
    keep = [F.col(c) for c in df.columns if c not in variants and c not in numbered]
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return df.select(*keep, *[(F.greatest(*map(zero, v)) if len(v) > 1 else zero(v[0])).alias(k) for k, v in years.items()])


def total_dividend(df: DataFrame, whole: bool = False) -> DataFrame:
    """total_dividend as the sum of all years; whole truncates to rupees as the register tool does."""
    years = list(fy_columns(df))
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in years]) if years else F.lit(0.0)
    return df.withColumn("total_dividend", total.cast("long") if whole else total)


def first_positive(cols: list[Column]) -> Column:
    """The first value above zero, else 0: base before final before interim."""
    return F.coalesce(*[F.when(c > 0, c) for c in cols], F.lit(0.0))


def ordered_columns(cols: list[str], groups: list[list[str]]) -> list[str]:
    """Columns in the order of the groups, financial years sorted, the rest as they stand."""
    named = [c for g in groups for c in g if c in cols]
    years = sorted(c for c in cols if FY_COLUMN.match(c) and c not in named)
    return [*named, *years, *[c for c in cols if c not in named and c not in years]]


def numbered(df: DataFrame, order: list[str], within: list[str] | None = None, name: str = "sr_no") -> DataFrame:
    """Numbers rows 1..n in order, in each group of within.

    Without groups the rows are numbered by range: they are sorted in many tasks and each task's
    rows are numbered from the count of those before, so no single task sees all rows.
    """
    if within:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*within).orderBy(*order)))
    n = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    part = df.repartitionByRange(int(n), *order).sortWithinPartitions(*order)
    from ledgerloom.session import checkpointed

    part = checkpointed(part.withColumn("__p", F.spark_partition_id()))
    sizes = part.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))  # one row a task
    before = sizes.withColumn("__b", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    local = F.row_number().over(Window.partitionBy("__p").orderBy(*order))
    return part.withColumn("__r", local).join(F.broadcast(before.select("__p", "__b")), "__p").withColumn(name, F.col("__b") + F.col("__r")).drop("__p", "__b", "__r")


def merge_continuations(df: DataFrame, file: str, row: str, key: str, address: str, texts: list[str]) -> DataFrame:
    """Rows without a key are parts of the address of the row above them in their file.

    All their non-blank cells are joined to it; rows before the first one with a key are dropped.
    A running count of key rows names the group; the parts are sorted by row before joining.
    """
    head = F.coalesce(~F.lower(F.trim(F.col(key))).isin("", "nan", "none"), F.lit(False))
    w = Window.partitionBy(file).orderBy(row).rowsBetween(Window.unboundedPreceding, 0)
    g = df.withColumn("__head", head).withColumn("__g", F.sum(F.col("__head").cast("int")).over(w)).where("__g > 0")
    cells = F.array_join(F.filter(F.transform(F.array(*[F.col(c).cast("string") for c in texts]), lambda x: F.trim(F.coalesce(x, F.lit("")))), lambda x: (x != "") & ~F.lower(x).isin("nan", "none")), " ")
    piece = F.when(F.col("__head"), F.trim(F.coalesce(F.col(address), F.lit("")))).otherwise(cells)
    return (
        g.withColumn("__t", piece).groupBy(file, "__g")
        .agg(F.min(row).alias(row), F.max(F.when(F.col("__head"), F.col(key))).alias(key),
             F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct(row, "__t"))), lambda s: s["__t"]), lambda x: x != ""), " ").alias(address),
             (F.count(F.lit(1)) - 1).alias("continued"))
        .drop("__g")
    )


#: First cells by which a repeated header line is known (fixed values).
HEADER_ECHO = ("folio no", "folio no.", "folio", "folio number", "sr no", "s.no")


def normalize(df: DataFrame, numbers: list[str], texts: list[str]) -> DataFrame:
    """Header echoes and rows with neither folio nor name dropped, texts cleaned, numbers read from text, nulls filled."""
    ok = ~F.lower(F.trim(F.coalesce(F.col("folio_no"), F.lit("")))).isin(*HEADER_ECHO)
    some = (F.trim(F.coalesce(F.col("folio_no"), F.lit(""))) != "") | (F.trim(F.coalesce(F.col("name"), F.lit(""))) != "")
    cols = []
    for c, _ in df.dtypes:
        if c in numbers:
            cols.append(T.to_float(F.col(c).cast("string")).alias(c))
        elif c == "folio_no":
            cols.append(T.clean_folio(c).alias(c))
        elif c in texts:
            cols.append(T.clean_text(c).alias(c))
        else:
            cols.append(F.col(c))
    return df.where(ok & some).select(*cols)


def append_keep_last(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Union of both; of rows with equal keys the last stays, new rows counting after old ones."""
    both = union_by_name([old.withColumn("__gen", F.lit(0)), new.withColumn("__gen", F.lit(1))])
    rest = [c for c in both.columns if c not in keys]
    # By an aggregate with map-side combine; the other fields settle equal orders.
    m = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("__gen", order, *[c for c in rest if c not in ("__gen", order)])).alias("m"))
    return m.select(*keys, "m.*").select(*both.columns).drop("__gen")


def chosen_name(df: DataFrame, file: str, parts: list[str], holder: str, name: str) -> DataFrame:
    """The name of each row as its whole file prints it: from parts if any row of the file has the first
    part, else from the holder column if any row has that, else the name column."""
    any_ = lambda c: F.max((F.trim(F.coalesce(F.col(c), F.lit(""))) != "").cast("int"))
    has = df.groupBy(file).agg(any_(parts[0]).alias("__p"), any_(holder).alias("__h"))
    joined = F.concat_ws(" ", *[F.nullif(F.trim(F.col(c)), F.lit("")) for c in parts])
    pick = F.when(F.col("__p") == 1, joined).when(F.col("__h") == 1, F.trim(F.coalesce(F.col(holder), F.lit("")))).otherwise(F.trim(F.coalesce(F.col(name), F.lit(""))))
    return df.join(has, file, "left").withColumn("chosen_name", pick).drop("__p", "__h")
