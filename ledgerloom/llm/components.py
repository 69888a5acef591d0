"""Consolidating pairwise matches into groups: hash-to-min."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import checkpointed


def hash_to_min(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 200) -> DataFrame:
    """(record_key, group_key): every vertex with the smallest vertex it is linked to, directly or not.

    Hash-to-min over a flat relation (v, u): "u is in the cluster set of v". In each round every
    vertex sends its set to its minimum member and that minimum to all members; rounds repeat
    until the relation no longer changes, about log2 of the longest path. Sets are never
    collected into arrays: the minimum is a map-side combined aggregate joined back, and the
    union of the messages is a distinct on the whole pair, so a component with a third of all
    rows is spread over all tasks (the join back splits a hot vertex under AQE).

    Text keys are numbered in their order once, so that rounds move numbers, not texts; and each
    task first contracts the links it holds to stars, as a map-side combine of the sets.

    Each round is cut by checkpoint() in the shared folder, so a lost executor costs one round.

    Defined results: pairs with a null end are no link; loops give a group of one, which is not
    reported unless the vertex has other links; repeated pairs count once; comparison of keys is
    by bytes, of whole numbers by value; keys keep their type; empty input gives an empty result. Raises if the
    rounds do not suffice.
    """
    numeric = all(dict(edges.dtypes)[c] in ("bigint", "int") for c in (a, b))
    kind = "long" if numeric else "string"
    e = edges.select(F.col(a).cast(kind).alias("x"), F.col(b).cast(kind).alias("y"))
    e = e.where("x is not null and y is not null and x <> y")
    if numeric:
        return _rounds(e, max_rounds).select(F.col("v").alias("record_key"), F.col("g").alias("group_key"))
    e = checkpointed(e.distinct())
    keys = e.select(F.explode(F.array("x", "y")).alias("key")).distinct()
    # Range partitions in order, sorted inside: the running numbers grow with the keys.
    keys = checkpointed(keys.repartitionByRange("key").sortWithinPartitions("key").withColumn("id", F.monotonically_increasing_id()))
    end = lambda c, i: keys.select(F.col("key").alias(c), F.col("id").alias(i))
    numbered = e.join(end("x", "i"), "x").join(end("y", "j"), "y").select(F.col("i").alias("x"), F.col("j").alias("y"))
    found = _rounds(numbered, max_rounds)
    return found.join(end("record_key", "v"), "v").join(end("group_key", "g"), "g").select("record_key", "group_key")


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task contracted: each vertex with the smallest one it reaches there."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        r = x
        while up[r] != r:
            r = up[r]
        while up[x] != r:
            up[x], x = r, up[x]
        return r

    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            up.setdefault(x, x)
            up.setdefault(y, y)
            x, y = root(x), root(y)
            if x != y:
                up[max(x, y)] = min(x, y)
    v = [x for x in up if up[x] != x]
    for i in range(0, len(v), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(v[i : i + 100_000], pa.int64()), pa.array([root(x) for x in v[i : i + 100_000]], pa.int64())], ["x", "y"])


def _rounds(e: DataFrame, max_rounds: int) -> DataFrame:
    """(v, g) of links (x, y) between whole numbers."""
    e = e.mapInArrow(_stars, "x long, y long")
    # The initial set of a vertex: itself and its neighbours.
    c = e.select(
        F.explode(
            F.array(
                F.struct(F.col("x").alias("v"), F.col("y").alias("u")),
                F.struct(F.col("y").alias("v"), F.col("x").alias("u")),
                F.struct(F.col("x").alias("v"), F.col("x").alias("u")),
                F.struct(F.col("y").alias("v"), F.col("y").alias("u")),
            )
        ).alias("p")
    ).select("p.v", "p.u").distinct()
    c = checkpointed(c)
    before = None
    for _ in range(max_rounds):
        low = c.groupBy("v").agg(F.min("u").alias("m"))
        sent = c.join(low, "v").select(
            F.explode(
                F.array(
                    F.struct(F.col("m").alias("v"), F.col("u").alias("u")),
                    F.struct(F.col("u").alias("v"), F.col("m").alias("u")),
                )
            ).alias("p")
        )
        c = checkpointed(sent.select("p.v", "p.u").distinct())
        s = c.agg(
            F.count(F.lit(1)).alias("n"),
            F.expr("bit_xor(xxhash64(v, u))").alias("x"),
            F.sum(F.xxhash64("u", "v") % 1000003).alias("s"),
        ).first()
        if before == (s["n"], s["x"], s["s"]):
            return c.groupBy("v").agg(F.min("u").alias("g"))
        before = (s["n"], s["x"], s["s"])
    raise RuntimeError(f"hash-to-min is not stable after {max_rounds} rounds")


def search_result_groups(results: DataFrame) -> DataFrame:
    """Groups of shareholders and persons tied by search results (contact_results).

    A row with match_found true and a readable shareholder_id and identity_hash ties both.
    shareholder_id is a plain number without padding zeros or blanks, identity_hash lower case
    without blanks; rows where either is empty tie nothing.
    """
    sid = F.regexp_replace(F.regexp_replace(F.col("shareholder_id").cast("string"), r"\s", ""), r"^0+(?=\d)", "")
    ih = F.lower(F.regexp_replace(F.col("identity_hash").cast("string"), r"\s", ""))
    pairs = results.where(F.col("match_found")).select(F.nullif(sid, F.lit("")).alias("a"), F.nullif(ih, F.lit("")).alias("b"))
    return hash_to_min(pairs)
