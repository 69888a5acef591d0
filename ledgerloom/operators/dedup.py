"""Exact and fuzzy de-duplication by the register tools' rules, as joins, windows and aggregates."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.similarity import sorted_tokens
from ledgerloom.operators.fuzzy import alike_rows
from ledgerloom.session import checkpointed, release


def keep_best(df: DataFrame, key: Column, best: list[Column]) -> DataFrame:
    """The row of each group of equal keys that comes first in the order best; rows without a key all stay. best must settle every tie.

    An order of several columns is kept by rank in two levels: first in salted parts of a group,
    then among the survivors of the parts, so that a key with a third of all rows is no task of its own.
    """
    k = df.withColumn("__k", key).withColumn("__s", F.pmod(F.xxhash64(*df.columns), F.lit(64)))
    some = k.where("__k is not null")
    for by in (["__k", "__s"], ["__k"]):
        some = some.withColumn("__rn", F.row_number().over(Window.partitionBy(*by).orderBy(*best))).where("__rn = 1").drop("__rn")
    return some.unionByName(k.where("__k is null")).drop("__k", "__s")


def keep_last(df: DataFrame, keys: list[Column], order: str) -> DataFrame:
    """The last row of equal keys; rows with a null or blank key are exempt."""
    t = F.struct(*keys)
    ok = F.lit(True)
    for c in keys:
        ok = ok & F.coalesce(F.trim(c) != "", F.lit(False))
    return keep_best(df, F.when(ok, t), [F.desc(order)])


def account_pairs(df: DataFrame, key: Column, order: str) -> DataFrame:
    """Pairs (first_row, later_row) of equal keys: each later row with the first of its group.

    The chain of all pairs of a group says nothing more than this star and its size, and a group
    with a third of all rows would have too many of them; the group's size is group_rows.
    """
    k = df.select(F.col(order).alias("r"), key.alias("k")).where("k is not null")
    g = k.groupBy("k").agg(F.min("r").alias("first_row"), F.count(F.lit(1)).alias("group_rows")).where("group_rows > 1")
    return k.join(g, "k").where("r > first_row").select("first_row", F.col("r").alias("later_row"), "group_rows")


def _compared(c: str) -> Column:
    return sorted_tokens(F.lower(F.regexp_replace(F.col(c), r"[\s,;]+", " ")))


def similar_pairs(df: DataFrame, order: str, name: str, address: str, least: float = 85.0, prefix: int = 3) -> DataFrame:
    """Pairs i < j of rows whose printed names begin alike and whose names and addresses both reach least.

    The scores are token-sort ratios. Distinct pairs of name and address are compared by an exact
    similarity join (fuzzy.alike_rows) in blocks of the first letters of the name as it is printed; a
    common beginning is cut into parts there, so it is no task of its own. Copies of one
    text in a block are told by text_rows; rows stand for them by their smallest number.
    """
    t = df.select(F.col(order).alias("r"), _compared(name).alias("n"), _compared(address).alias("a"), F.substring(F.lower(F.trim(F.col(name))), 1, prefix).alias("b"))
    t = checkpointed(t.where("n <> '' and a <> ''").groupBy("b", "n", "a").agg(F.min("r").alias("r"), F.count(F.lit(1)).alias("text_rows")))
    t = t.select(F.col("r").alias("id"), F.col("n").alias("text"), F.col("a").alias("more"), F.col("b").alias("block"), "text_rows")
    p = alike_rows(t.drop("text_rows"), None, least, "both")
    x, y = (t.select(F.col("id").alias(f"row_{i}"), F.col("text_rows").alias(f"copies_{i}")) for i in ("a", "b"))
    p = p.select(F.col("l").alias("row_a"), F.col("r").alias("row_b"), F.col("score").alias("name_score"), F.col("more_score").alias("address_score"))
    return p.join(x, "row_a").join(y, "row_b").select("row_a", "row_b", "name_score", "address_score", "copies_a", "copies_b")


def numbered_texts(df: DataFrame, text: str) -> DataFrame:
    """(id, text): the distinct texts of a column with a number each, fixed by a checkpoint."""
    return checkpointed(df.select(F.col(text).alias("text")).where("text <> ''").distinct().withColumn("id", F.monotonically_increasing_id()).select("id", "text"))


def set_similar_pairs(df: DataFrame, order: str, name: str, address: str, least: float = 85.0) -> DataFrame:
    """Pairs whose names and addresses both reach least by token-set ratio, without a block on how they begin.

    No pair is missed: distinct pairs of name and address are compared by an exact similarity join
    (fuzzy.alike_rows), in which one name may be a part of the other.
    """
    t = df.select(F.col(order).alias("r"), F.lower(F.col(name)).alias("n"), F.lower(F.regexp_replace(F.col(address), r"[\s,;]+", " ")).alias("a"))
    t = checkpointed(t.where("trim(n) <> '' and trim(a) <> ''").groupBy("n", "a").agg(F.min("r").alias("r")))
    t = t.select(F.col("r").alias("id"), F.col("n").alias("text"), F.col("a").alias("more"), F.lit("").alias("block"))
    p = alike_rows(t, None, least, "both", sets=True)
    return p.select(F.col("l").alias("row_a"), F.col("r").alias("row_b"), F.col("score").alias("name_score"), F.col("more_score").alias("address_score"))


def removal_audit(pairs: DataFrame) -> DataFrame:
    """(removed_row, kept_row, match_type, score) of pairs (row_a, row_b, match_type, score): for each later row the first pair that names it."""
    best = F.min_by(F.struct("row_a", "match_type", "score"), F.struct("row_a", "match_type"))
    return pairs.groupBy(F.col("row_b").alias("removed_row")).agg(best.alias("m")).select("removed_row", F.col("m.row_a").alias("kept_row"), "m.match_type", "m.score")


def drop_earlier(pairs: DataFrame) -> DataFrame:
    """Removed rows: the earlier of each pair, with the smallest later row that it matches (which may itself go)."""
    return pairs.groupBy(F.col("row_a").alias("removed_row")).agg(F.min("row_b").alias("kept_row"))


def greedy_removals(pairs: DataFrame, block: str = "block") -> DataFrame:
    """Removals of a greedy pass over pairs in order (i, then j), skipping pairs of which a row is gone.

    The result depends on the order, so each block is one sequential pass; blocks are independent.
    Columns: block, row_a, row_b, best_row (the one of both that stays). A block holds only pairs
    at the threshold. Blocks are streamed sorted through one task each, without collecting them.
    """
    n = pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    s = pairs.repartition(int(n), block).sortWithinPartitions(block, "row_a", "row_b").select(block, "row_a", "row_b", "best_row")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, gone = None, set()
        for pdf in it:
            out = []
            for b, i, j, best in pdf.itertuples(index=False):
                if b != now:
                    now, gone = b, set()
                if i in gone or j in gone:
                    continue
                lost = j if best == i else i
                gone.add(lost)
                out.append((lost, best))
            yield pd.DataFrame(out, columns=["removed_row", "kept_row"]).astype("int64")

    return s.mapInPandas(run, "removed_row long, kept_row long")


def greedy_similar(df: DataFrame, order: str, name: str, address: str, least: float = 85.0) -> DataFrame:
    """(removed_row, kept_row): a greedy pass over all pairs of rows whose names and addresses both reach least by token-sort ratio.

    The pass goes by i, then j, and skips pairs of which a row is gone; of two rows the one with more
    text stays, else the first. Names need not begin alike, and rows of equal texts are pairs as others are.

    Distinct texts are compared by an exact similarity join (fuzzy.alike_rows). Rows whose texts are
    linked, directly or not, are one sequential pass in one task, which holds a row as two numbers and asks for
    the next row that is still there: a step removes a row, so copies of one text cost no more than their number.
    """
    size = F.length(F.concat_ws("", name, address))
    rows = df.select(F.col(order).cast("long").alias("r"), _compared(name).alias("n"), _compared(address).alias("a"), size.cast("long").alias("size"))
    rows = checkpointed(rows.where("r is not null and n <> '' and a <> ''"))
    texts = checkpointed(rows.groupBy("n", "a").agg(F.min("r").alias("id"), F.count(F.lit(1)).alias("copies")))
    t = texts.select("id", F.col("n").alias("text"), F.col("a").alias("more"), F.lit("").alias("block"))
    links = checkpointed(alike_rows(t, None, least, "both").select(F.col("l").alias("x"), F.col("r").alias("y")))
    group = checkpointed(linked(links))
    # Texts alone are groups of their own, of interest only if they have copies.
    of = texts.join(group, texts["id"] == group["v"], "left").where("g is not null or copies > 1").select("n", "a", "id", F.coalesce("g", "id").alias("g"))
    held = rows.join(of, ["n", "a"]).select("g", F.lit(1).alias("side"), F.col("r").alias("a"), F.col("id").alias("b"), "size")
    near = links.join(group, links["x"] == group["v"]).select("g", F.lit(0).alias("side"), F.col("x").alias("a"), F.col("y").alias("b"), F.lit(0).cast("long").alias("size"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, near, ids, text, sizes = None, {}, array("q"), array("q"), array("q")
        for b in batches:
            lost, kept = [], []
            for g, side, x, y, n in zip(*(b.column(k).to_pylist() for k in range(5))):
                if g != now:
                    _pass(near, ids, text, sizes, lost, kept)
                    now, near, ids, text, sizes = g, {}, array("q"), array("q"), array("q")
                if side == 0:
                    near.setdefault(x, []).append(y)
                    near.setdefault(y, []).append(x)
                else:
                    ids.append(x)
                    text.append(y)
                    sizes.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(lost, pa.int64()), pa.array(kept, pa.int64())], ["removed_row", "kept_row"])
        lost, kept = [], []
        _pass(near, ids, text, sizes, lost, kept)
        yield pa.RecordBatch.from_arrays([pa.array(lost, pa.int64()), pa.array(kept, pa.int64())], ["removed_row", "kept_row"])

    all_rows = near.unionByName(held).repartition("g").sortWithinPartitions("g", "side", "a", "b")
    return all_rows.mapInArrow(run, "removed_row long, kept_row long")


def _pass(near: dict[int, list[int]], ids: array, text: array, sizes: array, lost: list[int], kept: list[int]) -> None:
    """The greedy pass of greedy_similar over rows in ascending order of ids; near tells the texts alike."""
    of: dict[int, array] = {}
    for at, t in enumerate(text):
        of.setdefault(t, array("q")).append(at)
    head, gone = dict.fromkeys(of, 0), bytearray(len(ids))

    def first(t: int, after: int) -> int:
        """The first row of a text after that one that is still there, or -1."""
        rows, k = of[t], head[t]
        while k < len(rows) and (rows[k] <= after or gone[rows[k]]):
            k += 1
        head[t] = k
        return rows[k] if k < len(rows) else -1

    for i in range(len(ids)):
        if gone[i]:
            continue
        ahead = [(j, t) for t in (text[i], *near.get(text[i], ())) if (j := first(t, i)) >= 0]
        heapify(ahead)
        while ahead:
            j, t = heappop(ahead)
            out, best = (i, j) if sizes[j] > sizes[i] else (j, i)
            gone[out] = 1
            lost.append(ids[out])
            kept.append(ids[best])
            if out == i:
                break
            if (j := first(t, i)) >= 0:
                heappush(ahead, (j, t))


def linked(pairs: DataFrame) -> DataFrame:
    """(v, g): every end of pairs (x, y) of numbers with the smallest one it is linked to, directly or not.

    Large and small stars in turn until nothing changes: each vertex hands its larger, then its
    smaller neighbours over to the least of them.
    """
    known = checkpointed(pairs.where("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct())
    while True:
        both = known.unionByName(known.select(F.col("y").alias("x"), F.col("x").alias("y")))
        low = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("g"))
        star = checkpointed(both.join(low, "x").where("y > x").select(F.col("y").alias("x"), F.col("g").alias("y")).distinct())
        low = star.groupBy("x").agg(F.min("y").alias("g"))
        over = star.join(low, "x").where("y <> g").select(F.col("y").alias("x"), F.col("g").alias("y"))
        new = checkpointed(over.unionByName(low.select("x", F.col("g").alias("y"))).distinct())
        release(star)
        if known.count() == new.count() and new.exceptAll(known).isEmpty():
            release(known)
            return new.select(F.col("x").alias("v"), F.col("y").alias("g")).unionByName(new.select(F.col("y").alias("v"), F.col("y").alias("g")).distinct())
        release(known)
        known = new
