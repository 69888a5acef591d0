"""Tables that are kept: upsert, insert-if-absent, star load, page and facet queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.dedup import keep_best


def upsert(old: DataFrame, batch: DataFrame, keys: list[str], order: str, created: str) -> DataFrame:
    """The table after the batch: the last row of each key in the batch wins, creation times are kept.

    Rows of the batch with a null or blank key do not enter; action tells kept, updated or inserted.
    """
    ok = reduce(lambda a, b: a & b, [F.coalesce(F.trim(F.col(k).cast("string")) != "", F.lit(False)) for k in keys])
    rest = [c for c in batch.columns if c not in keys]
    # The last row by an aggregate with map-side combine; the other fields settle equal orders.
    new = latest_by_key(batch.where(ok), keys, [order, *[c for c in rest if c != order]], rest).select(*batch.columns)
    was = old.select(*keys, F.col(created).alias("__created"), F.lit(True).alias("__was"))
    new = new.join(was, keys, "left").withColumn(created, F.coalesce("__created", created)).withColumn("action", F.when(F.col("__was"), "updated").otherwise("inserted")).drop("__created", "__was")
    kept = old.join(new, keys, "left_anti").withColumn("action", F.lit("kept"))
    return kept.unionByName(new.select(*kept.columns))


def insert_absent(old: DataFrame, batch: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows of the batch that agree with no row of the table in any of the keys, the first of each first key."""
    new = batch
    for k in keys:
        new = new.join(old.select(k).where(f"{k} is not null").distinct(), k, "left_anti")
    return keep_best(new, F.col(keys[0]), order)


def page(df: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """One page of a fully ordered table; the limit reaches the sort as a top-n."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def page_info(df: DataFrame, size: int) -> DataFrame:
    """total rows and pages, one page at least."""
    return df.agg(F.count(F.lit(1)).alias("total")).select("total", F.greatest(F.lit(1), F.ceil(F.col("total") / size)).cast("long").alias("pages"))


def free_text(df: DataFrame, cols: list[str], needle: str) -> DataFrame:
    """Rows of which any of the columns holds the text, letter case aside (values only, no labels)."""
    hay = F.lower(F.concat_ws(" ", *[F.col(c).cast("string") for c in cols]))
    return df.where(hay.contains(needle.lower()))


def sort_key(df: DataFrame, column: str) -> tuple[Column, Column]:
    """Numeric order if more than half of the non-null values read as numbers, else text without case: (number, text)."""
    n = F.regexp_replace(F.col(column).cast("string"), ",", "").try_cast("double")
    share = df.where(F.col(column).isNotNull()).agg(F.avg(n.isNotNull().cast("int"))).first()[0] or 0.0
    return (n, F.lower(F.col(column).cast("string"))) if share > 0.5 else (F.lit(0.0), F.lower(F.col(column).cast("string")))


def latest_by_key(df: DataFrame, keys: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """The last row of each key by an aggregate with map-side combine (no window, no sort of groups)."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("m")).select(*keys, "m.*")


def upsert_counts(old: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """One row: inserted, updated and failed rows of a batch. A row with a blank key fails; of equal keys each row counts."""
    ok = reduce(lambda a, b: a & b, [F.coalesce(F.trim(F.col(k).cast("string")) != "", F.lit(False)) for k in keys])
    per = batch.withColumn("__ok", ok).groupBy(*keys, "__ok").agg(F.count(F.lit(1)).alias("__n"))
    per = per.join(old.select(*keys).distinct().withColumn("__was", F.lit(True)), keys, "left")
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    was = F.col("__was").isNotNull()
    # The first row of a new key is inserted, later ones of the same batch update it.
    return per.agg(
        n(F.when(F.col("__ok") & ~was, 1)).alias("inserted"), n(F.when(F.col("__ok"), F.when(was, F.col("__n")).otherwise(F.col("__n") - 1))).alias("updated"), n(F.when(~F.col("__ok"), F.col("__n"))).alias("failed")
    )


def replaced(new: DataFrame, key: str, order: str) -> DataFrame:
    """What a kept table holds after it was replaced by new: the last row of each key that is not blank."""
    rest = [c for c in new.columns if c != key]
    some = new.where(F.coalesce(F.trim(F.col(key).cast("string")) != "", F.lit(False)))
    return latest_by_key(some, [key], [order, *[c for c in rest if c != order]], rest).select(*new.columns)


def star(flat: DataFrame, order: str) -> dict[str, DataFrame]:
    """Flat register lines as five frames: persons, companies, holdings, snapshots and dividends.

    flat has name, company, folio, year, shares and amount. Lines without a name or company are left
    out. A person is known by the name's identity, a holding by person, company and folio, a
    snapshot and a dividend by holding and year, where the last line in order counts; a dividend
    needs a year and an amount other than zero.
    """
    blank = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    f = flat.where(blank("name").isNotNull() & blank("company").isNotNull())
    f = f.withColumns({"person": F.sha2(F.lower(F.trim("name")), 256), "company_key": F.lower(F.trim("company")), "folio_key": F.upper(F.coalesce(blank("folio"), F.lit("")))})
    holding = ["person", "company_key", "folio_key"]
    return {
        "persons": f.groupBy("person").agg(F.min_by("name", order).alias("name")),
        "companies": f.groupBy("company_key").agg(F.min_by("company", order).alias("company")),
        "holdings": f.select(*holding).distinct(),
        "snapshots": latest_by_key(f.where(blank("year").isNotNull()), [*holding, "year"], [order], ["shares"]),
        "dividends": latest_by_key(f.where(blank("year").isNotNull() & (F.coalesce("amount", F.lit(0.0)) != 0)), [*holding, "year"], [order], ["amount"]),
    }


def search(df: DataFrame, company: str | None, needle: str | None, cols: list[str], wealth: str, least: str | None, order: list[Column], number: int, size: int) -> DataFrame:
    """One page of rows by company (case aside), free text and least wealth, with total and pages of the whole result.

    A least wealth that is no number counts as 0, as the register's list does.
    """
    hit = df
    if company:
        hit = hit.where(F.lower(F.trim("company_name")) == company.strip().lower())
    if needle:
        hit = free_text(hit, cols, needle)
    try:
        hit = hit.where(F.coalesce(F.col(wealth), F.lit(0.0)) >= float(least)) if least is not None else hit
    except ValueError:
        pass
    return page(hit, order, number, size).crossJoin(F.broadcast(page_info(hit, size)))  # one row on the right
