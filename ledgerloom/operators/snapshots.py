"""What changed between consecutive full snapshots of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.registers import fy_label, fy_start


def snapshot_changes(
    rows: DataFrame,
    key: str = "holding_id",
    year: str = "financial_year",
    value: str = "shares",
    recorded: str = "recorded_at",
    tie: str = "id",
    tolerance: float = 0.001,
) -> DataFrame:
    """Keys added, removed or changed in each delivered year against the one delivered before.

    Every row is emitted once for each comparison it takes part in, tagged by side (as the new
    side of its own year, as the old side of the next delivered one); one aggregation by (key,
    comparison) picks the last recorded row of each side and classifies the pair from the
    per-side hashes. So there is a single shuffle of the data, with map-side combine, and no
    group is ever collected: a key with a third of all rows costs nothing extra.

    The delivered years are a distinct list bounded by the 201 years the label reader accepts,
    which is why that side alone is broadcast.

    Defined results: rows with a null key or an unreadable year belong to no snapshot; of equal
    times the largest id counts, null times rank first; a value that is null on one side only is
    a change, null on both is none; NaN counts as null; an empty table gives an empty result.
    Returns (holding_id, financial_year, change_kind).
    """
    v = F.col(value).cast("double")
    src = rows.select(
        F.col(key).alias("__k"),
        fy_start(year).alias("__y"),
        F.when(~F.isnan(v), v).alias("__v"),
        F.struct(F.col(recorded).alias("t"), F.col(tie).alias("i")).alias("__at"),
    ).where("__k is not null and __y is not null")

    years = src.select("__y").distinct()
    order = Window.orderBy("__y")  # at most 201 rows: one per calendar year
    sides = years.select(
        "__y",
        F.array(
            F.struct(F.col("__y").alias("cmp"), F.lit(True).alias("new")),
            F.struct(F.lead("__y").over(order).alias("cmp"), F.lit(False).alias("new")),
        ).alias("__sides"),
        F.lag("__y").over(order).alias("__before"),
    )
    tagged = (
        src.join(F.broadcast(sides), "__y")
        .select("*", F.inline("__sides"))
        .where("cmp is not null and not (new and __before is null)")
    )
    side = lambda new: F.max_by(
        F.struct(F.col("__v").alias("v"), F.xxhash64("__v").alias("h")), F.when(F.col("new") == new, F.col("__at"))
    )
    pairs = tagged.groupBy("__k", "cmp").agg(
        side(True).alias("n"),
        side(False).alias("o"),
        F.bool_or("new").alias("in_new"),
        F.bool_or(~F.col("new")).alias("in_old"),
    )
    same = (F.col("n.h") == F.col("o.h")) | F.coalesce(F.abs(F.col("n.v") - F.col("o.v")) <= tolerance, F.lit(False))
    kind = F.when(~F.col("in_old"), "added").when(~F.col("in_new"), "removed").when(~same, "changed")
    return (
        pairs.select(F.col("__k").alias(key), fy_label(F.col("cmp")).alias("financial_year"), kind.alias("change_kind"))
        .where("change_kind is not null")
    )
