"""Best representative of each duplicate group: accounts in dividend registers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.registers import company_key, demat_client, demat_digits, folio_key, fy_label, fy_start

#: Columns of a register line that make it complete.
FIELDS = (
    "folio_no", "company_name", "demat_account", "full_name", "father_husband_name", "address", "city", "state",
    "pincode", "current_holding", "total_dividend", "pdf_financial_year", "mobile_number", "email_id",
)
#: Texts that fill a cell but say nothing (fixed values).
FILLERS = ("", "-", "--", "na", "n/a", "n.a.", "nil", "none", "null", "unknown", "not available", "not known", "nan")


def present(c: str, kind: str) -> Column:
    """True where a cell says something."""
    if kind == "string":
        return F.coalesce(~F.lower(F.trim(F.col(c))).isin(*FILLERS), F.lit(False))
    return F.col(c).isNotNull()


def account_lines(lines: DataFrame) -> DataFrame:
    """Adds __co and __acct: the account (a folio in a company) each line reports.

    A line without folio belongs to the account of its company that its demat number shows: first
    by all digits of the number, else by its client part where that shows one account only. If no
    line with a folio shows the number, lines without folio are grouped by it; a line with
    neither is an account of its own. Only lines without a folio take part in the look-ups.
    """
    known = lines.withColumns(
        {"__co": F.coalesce(company_key("company_name"), F.lit("")), "__folio": folio_key("folio_no"),
         "__full": demat_digits("demat_account"), "__cli": demat_client("demat_account")}
    )
    have = known.where("__folio is not null").withColumn("__acct", F.concat(F.lit("f:"), "__folio"))
    lack = known.where("__folio is null")
    # Only the accounts of numbers that a line without folio shows are looked up: a small part.
    sought = lack.where("__cli is not null").select("__co", "__cli").distinct()
    shown = known.where("__folio is not null and __cli is not null").select("__co", "__folio", "__full", "__cli").join(sought, ["__co", "__cli"], "left_semi")

    def lookup(key: str, name: str) -> DataFrame:
        g = shown.groupBy("__co", key).agg(F.min("__folio").alias("a"), F.max("__folio").alias("b"))
        return g.where("a = b").select("__co", key, F.col("a").alias(name))

    lack = (
        lack.join(lookup("__full", "__by_full"), ["__co", "__full"], "left")
        .join(lookup("__cli", "__by_cli"), ["__co", "__cli"], "left")
        .withColumn(
            "__acct",
            F.coalesce(
                F.concat(F.lit("f:"), F.coalesce("__by_full", "__by_cli")),
                F.concat(F.lit("d:"), F.col("__cli")),
                F.concat(F.lit("r:"), F.col("id").cast("string")),
            ),
        )
    )
    return have.unionByName(lack.select(*have.columns)).drop("__folio", "__full", "__cli")


def tops(lines: DataFrame, group: list[str], orders: dict[str, list[Column]], carry: list[Column], salts: int = 16) -> DataFrame:
    """Per group the first row under each of several orderings, each kept whole in a struct column.

    Ranks are window row numbers, taken in two levels: within (group, salt) first, so that a group
    with a third of all rows is ranked by many tasks, then among the at most salts * len(orders)
    rows left of each group. The last term of every ordering must be unique: ties are settled.
    Small groups pay for the second level only with the rows they have.
    """
    names = list(orders)

    def ranked(df: DataFrame, keys: list[str]) -> DataFrame:
        for n in names:
            df = df.withColumn(f"__rn_{n}", F.row_number().over(Window.partitionBy(*keys).orderBy(*orders[n])))
        return df.where(reduce(lambda a, b: a | b, [F.col(f"__rn_{n}") == 1 for n in names]))

    salted = lines.withColumn("__salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    first = ranked(salted, [*group, "__salt"])
    second = ranked(first, group)
    row = F.struct(*carry)
    return second.groupBy(*group).agg(*[F.max(F.when(F.col(f"__rn_{n}") == 1, row)).alias(n) for n in names])


def _year(lines: DataFrame) -> DataFrame:
    return lines.withColumn("__yr", F.coalesce(fy_start("pdf_financial_year"), F.lit(0)))


def account_rows(lines: DataFrame) -> DataFrame:
    """p1_found: first_row, year_row and holding_row of each account with at least two lines.

    Lines whose id is null are left out. Lines without a readable year rank before all years,
    among equal years the largest id counts; holding_row is null where no line has a holding.
    """
    src = lines.select("id", "folio_no", "company_name", "demat_account", "pdf_financial_year", "current_holding").where("id is not null")
    a = _year(account_lines(src)).select("__co", "__acct", "id", "__yr", F.col("current_holding").isNotNull().alias("__held"))
    orders = {
        "year": [F.desc("__yr"), F.desc("id")],
        "holding": [F.desc("__held"), F.desc("__yr"), F.desc("id")],
        "first": [F.asc("id")],
        "last": [F.desc("id")],
    }
    t = tops(a, ["__co", "__acct"], orders, [F.col("id"), F.col("__held")])
    return t.where(F.col("first.id") < F.col("last.id")).select(
        F.col("first.id").alias("first_row"),
        F.col("year.id").alias("year_row"),
        F.when(F.col("holding.__held"), F.col("holding.id")).alias("holding_row"),
    )


#: Fields built into the survivor, each from the best line that has it.
BUILT = ("folio_no", "current_holding", "pdf_financial_year", "demat_account", "full_name", "address", "pincode")


def survivors(lines: DataFrame) -> DataFrame:
    """One surviving record per account, built field by field.

    For each field the best line is the one that has it, then by trust (a text in mixed case was
    typed from the page, not from a capital-only printer file; a demat or folio counts as trusted
    when not masked), then recency (financial year), completeness (cells that say something),
    created_at, and the largest id. best_row is the best line as a whole, built_* are the fields,
    from_* their lines, n_fields the number of fields filled.
    """
    kinds = dict(lines.dtypes)
    use = [c for c in FIELDS if c in kinds]
    src = lines.select("id", *use, *(["created_at"] if "created_at" in kinds else [])).where("id is not null")
    a = _year(account_lines(src))
    full = reduce(lambda x, y: x + y, [present(c, kinds[c]).cast("int") for c in use])
    trust = F.when(F.coalesce(F.col("demat_account").rlike("[Xx]{4}"), F.lit(False)), 0).otherwise(1) + F.when(
        F.coalesce(F.upper("full_name") == F.col("full_name"), F.lit(True)), 0
    ).otherwise(1)
    a = a.withColumns({"__full": full, "__trust": trust, "__at": F.col("created_at") if "created_at" in kinds else F.lit(None).cast("timestamp")})
    rank = [F.desc("__trust"), F.desc("__yr"), F.desc("__full"), F.desc_nulls_last("__at"), F.desc("id")]
    orders = {"whole": [F.desc("__full"), *rank]}
    for c in BUILT:
        ok = (fy_start(c).isNotNull() if c == "pdf_financial_year" else folio_key(c).isNotNull() if c == "folio_no" else present(c, kinds[c]))
        a = a.withColumn(f"__has_{c}", ok)
        first = [F.desc("__yr")] if c == "pdf_financial_year" else []
        orders[c] = [F.desc(f"__has_{c}"), *first, *rank]
    carry = [F.col("id"), F.col("company_name"), *[F.col(c) for c in BUILT], *[F.col(f"__has_{c}") for c in BUILT]]
    t = tops(a, ["__co", "__acct"], orders, carry)
    out = [F.col("__co").alias("company_key"), F.col("__acct").alias("account_key"), F.col("whole.id").alias("best_row")]
    filled = F.lit(0)
    for c in BUILT:
        has, v = F.col(f"{c}.__has_{c}"), F.col(f"{c}.{c}")
        if c == "pdf_financial_year":
            v = fy_label(fy_start(v))
        out += [F.when(has, v).alias(f"built_{c}"), F.when(has, F.col(f"{c}.id")).alias(f"from_{c}")]
        filled = filled + has.cast("int")
    return t.select(*out, filled.alias("n_fields"))
