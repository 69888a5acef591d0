"""Layered look-ups: exact, then fuzzy, then ordered providers; flags with an audit of what matched."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.similarity import sorted_tokens
from ledgerloom.operators.dedup import numbered_texts
from ledgerloom.operators.fuzzy import alike, alike_rows
from ledgerloom.session import checkpointed


def exact_then_fuzzy(rows: DataFrame, contacts: DataFrame, least: float = 85.0) -> DataFrame:
    """(row_id, contact_id, match_type, score): by account number, else the most similar name and address.

    rows: row_id, name, address, account; contacts: contact_id, name, address, account. The score
    is the mean of the token-sort ratios of name and address, or of the name alone where an
    address is missing; ties go to the smallest contact_id. The fuzzy step only sees rows that the
    exact one left, over distinct texts. A mean of least needs a name or an address that reaches
    it, by which an exact similarity join (fuzzy.alike_rows) finds all pairs there can be.
    """
    acc = lambda c: F.nullif(F.upper(F.regexp_replace(F.col(c), r"[^A-Za-z0-9]", "")), F.lit(""))
    c1 = contacts.select(acc("account").alias("k"), "contact_id").where("k is not null").groupBy("k").agg(F.min("contact_id").alias("contact_id"))
    r1 = rows.withColumn("k", acc("account"))
    hit = r1.join(c1, "k").select("row_id", "contact_id", F.lit("account_exact").alias("match_type"), F.lit(100.0).alias("score"))
    rest = r1.join(hit, "row_id", "left_anti")
    norm = lambda c: sorted_tokens(F.lower(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"[\s,;]+", " ")))
    a = checkpointed(rest.select("row_id", norm("name").alias("n1"), norm("address").alias("a1")).where("n1 <> ''"))
    b = contacts.select("contact_id", norm("name").alias("n2"), norm("address").alias("a2")).where("n2 <> ''").groupBy("n2", "a2").agg(F.min("contact_id").alias("contact_id"))
    texts = checkpointed(a.select("n1", "a1").distinct().withColumn("l", F.monotonically_increasing_id()))
    sides = ((texts, "l", "n1", "a1"), (b, "contact_id", "n2", "a2"))
    l, r = (df.select(F.col(i).alias("id"), F.col(n).alias("text"), F.col(m).alias("more"), F.lit("").alias("block")) for df, i, n, m in sides)
    p = alike_rows(l, r, least, "mean")
    p = p.select("l", F.col("r").alias("contact_id"), F.when(F.col("more_score").isNotNull(), (F.col("score") + F.col("more_score")) / 2).otherwise(F.col("score")).alias("score"))
    p = p.where(F.col("score") >= least).join(texts, "l")
    best = p.groupBy("n1", "a1").agg(F.max_by(F.struct("contact_id", "score"), F.struct("score", -F.col("contact_id"))).alias("m"))
    fuzzy = a.join(best, ["n1", "a1"]).select("row_id", "m.contact_id", F.lit("name_address_fuzzy").alias("match_type"), F.col("m.score").alias("score"))
    return hit.unionByName(fuzzy)


def best_dimension(keys: DataFrame, dim: DataFrame, key: str, name: str, least: float = 80.0) -> DataFrame:
    """(key, name, score): the dimension row with the same normal form, else the most similar above least.

    Only distinct keys are looked up, by one exact similarity join whatever the sizes.
    """
    norm = lambda c: sorted_tokens(F.lower(F.regexp_replace(F.col(c), r"[^A-Za-z0-9 ]", " ")))
    k = keys.select(F.col(key).alias("key"), norm(key).alias("kn")).where("kn <> ''").distinct()
    d = dim.select(F.col(name).alias("name"), norm(name).alias("dn")).where("dn <> ''").groupBy("dn").agg(F.min("name").alias("name"))
    exact = k.join(d, k["kn"] == d["dn"]).select("key", "name", F.lit(100.0).alias("score"))
    rest = checkpointed(k.join(exact, "key", "left_anti"))
    l, r = numbered_texts(rest, "kn"), numbered_texts(d, "dn")
    p = alike(l, r, least).where(F.col("score") > least).join(l.select(F.col("id").alias("l"), F.col("text").alias("kn")), "l")
    p = p.join(r.select(F.col("id").alias("r"), F.col("text").alias("dn")), "r").join(d, "dn")
    best = p.groupBy("kn").agg(F.min_by(F.struct("name", "score"), F.struct(-F.col("score"), "name")).alias("m"))
    return exact.unionByName(rest.join(best, "kn").select("key", "m.name", "m.score"))


def first_provider(rows: DataFrame, providers: DataFrame, key: str, usable: Column) -> DataFrame:
    """Per key the usable provider row of least priority, and how many providers were tried until it."""
    p = providers.withColumn("__ok", usable)
    got = p.groupBy(key).agg(F.min_by(F.struct("source", "phone", "email", "priority"), F.when(F.col("__ok"), F.col("priority"))).alias("m"), F.max("priority").alias("__n"), F.bool_or("__ok").alias("__any"))
    got = got.select(key, F.when(F.col("__any"), F.col("m")).alias("m"), F.when(F.col("__any"), F.col("m.priority")).otherwise(F.col("__n")).alias("attempts"))
    return rows.join(got, key, "left").select(rows["*"], F.col("m.source").alias("source"), F.col("m.phone").alias("phone"), F.col("m.email").alias("email"), F.coalesce("attempts", F.lit(0)).alias("attempts"))


def flag(df: DataFrame, criteria: dict[str, Column], mode: str = "or") -> DataFrame:
    """Rows with is_flagged and matched_criteria (the names of what held, by comma, for flagged rows only).

    mode joins the criteria; no criterion at all flags nothing. Null counts as not held.
    """
    held = {k: F.coalesce(v, F.lit(False)) for k, v in criteria.items()}
    if not held:
        return df.withColumns({"is_flagged": F.lit(False), "matched_criteria": F.lit("")})
    join = (lambda a, b: a & b) if mode == "and" else (lambda a, b: a | b)
    ok = reduce(join, held.values())
    audit = F.concat_ws(",", *[F.when(v, F.lit(k)) for k, v in held.items()])
    return df.withColumns({"is_flagged": ok, "matched_criteria": F.when(ok, audit).otherwise("")})


#: Named selections (values are fixed): least holding, least dividend in all, least dividend in one year, investor type, logic.
PRESETS = {
    "high_value": {"holding": 500, "total": 10_000, "single_year": 0, "investor_type": None, "logic": "or"},
    "ultra_high_value": {"holding": 5_000, "total": 100_000, "single_year": 0, "investor_type": None, "logic": "and"},
    "custom": {"holding": 0, "total": 0, "single_year": 0, "investor_type": None, "logic": "or"},
}
#: A column of one year's amounts.
YEAR_AMOUNT = re.compile(r"(?=.*(dividend|amount)).*20[0-2]\d", re.I)


def flag_preset(df: DataFrame, preset: str, **changes) -> DataFrame:
    """Rows flagged by a named preset, some of its values changed; all rows stay.

    A criterion counts if its value is above zero, or not blank, and its column is there:
    current_holding, total_dividend, the largest of the columns of one year's amounts, and
    investor_type without regard to case. If none counts, nothing is flagged. Unknown presets
    and values raise.
    """
    if preset not in PRESETS:
        raise ValueError(f"unknown preset {preset!r}; known are {', '.join(sorted(PRESETS))}")
    if unknown := set(changes) - set(PRESETS[preset]):
        raise ValueError(f"unknown values {sorted(unknown)}")
    v = PRESETS[preset] | changes
    years = [F.col(c) for c in df.columns if YEAR_AMOUNT.match(c)]
    criteria = {}
    if v["holding"] > 0 and "current_holding" in df.columns:
        criteria["current_holding"] = F.col("current_holding") >= v["holding"]
    if v["total"] > 0 and "total_dividend" in df.columns:
        criteria["total_dividend"] = F.col("total_dividend") >= v["total"]
    if v["single_year"] > 0 and years:
        criteria["single_year_dividend"] = (F.greatest(*years) if len(years) > 1 else years[0]) >= v["single_year"]
    if v["investor_type"] and "investor_type" in df.columns:
        criteria["investor_type"] = F.lower(F.trim("investor_type")) == v["investor_type"].strip().lower()
    return flag(df, criteria, v["logic"])


def layered(rows: DataFrame, key: str, layers: list[DataFrame]) -> DataFrame:
    """Rows with what the first layer that knows their key says, and contact_layer: its number from 1, or 0 if none does.

    Each layer has the key once and the same other columns. Every layer is only asked for the rows
    that the ones before left, so a dear layer sees few of them.
    """
    left, out = rows, None
    for n, layer in enumerate(layers, 1):
        hit = left.join(layer, key).withColumn("contact_layer", F.lit(n))
        out = hit if out is None else out.unionByName(hit)
        left = left.join(layer.select(key), key, "left_anti")
    return out.unionByName(left.withColumn("contact_layer", F.lit(0)), allowMissingColumns=True)
