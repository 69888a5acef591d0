"""Average-linkage clustering of vectors: the mean of all cosines between two groups is the dot product of their mean vectors."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.names import dot
from ledgerloom.session import checkpointed

#: Vectors of a group that one task clusters, or compares, at once.
HELD = 1_000
#: Vectors up to which a group is clustered without matrices, whose making would cost most.
FEW = 6
#: Decimals to which similarities are equal.
DIGITS = 9


def _dense(vectors: list[dict[int, float]]) -> np.ndarray:
    """Rows of vectors over the features they have."""
    at: dict[int, int] = {}
    rows, cols, w = [], [], []
    for i, v in enumerate(vectors):
        for f, x in v.items():
            rows.append(i)
            cols.append(at.setdefault(f, len(at)))
            w.append(x)
    x = np.zeros((len(vectors), max(len(at), 1)))
    x[rows, cols] = w
    return x


def merged(vectors: list[dict[int, float]], sizes: list[int], least: float) -> list[int]:
    """For each vector the first member of its cluster; a vector stands for as many equal nodes as its size.

    Average linkage over all pairs: clusters that are each other's nearest merge in rounds, which for
    this linkage gives the tree that merging the nearest pair again and again would. Ties go to
    the pair that comes first.
    """
    if len(vectors) <= FEW:
        return _few(vectors, sizes, least)
    label = np.arange(len(vectors))
    size = np.array(sizes, float)
    x = _dense(vectors) * size[:, None]
    d, live = x @ x.T, label.copy()
    while len(live) > 1:
        s = np.round(d / np.outer(size, size), DIGITS)
        np.fill_diagonal(s, -np.inf)
        near = s.argmax(axis=1)
        pos = np.arange(len(live))
        pair = np.flatnonzero((near[near] == pos) & (pos < near) & (s[pos, near] >= least))
        if not len(pair):
            break
        other = near[pair]
        for a, b in zip(live[pair], live[other]):
            label[label == b] = a
        d[pair] += d[other]
        d[:, pair] += d[:, other]
        size[pair] += size[other]
        keep = np.setdiff1d(pos, other)
        live, d, size = live[keep], d[np.ix_(keep, keep)], size[keep]
    return label.tolist()


def _few(vectors: list[dict[int, float]], sizes: list[int], least: float) -> list[int]:
    """merged of a few vectors: the same rounds in plain numbers."""
    n = len(vectors)
    label, live, size = list(range(n)), list(range(n)), list(sizes)
    d = [[0.0] * n for _ in range(n)]
    for i in range(n):
        for j in range(i):
            d[i][j] = d[j][i] = dot(vectors[i], vectors[j]) * size[i] * size[j]
    to = 10.0**DIGITS
    while len(live) > 1:
        near, sim = {}, {}
        for a in live:
            best, at = -math.inf, -1
            for b in live:
                if a != b and (s := round(d[a][b] / (size[a] * size[b]) * to) / to) > best:
                    best, at = s, b
            near[a], sim[a] = at, best
        pairs = [(near[b], b) for b in live if near[b] < b and near[near[b]] == b and sim[b] >= least]
        if not pairs:
            break
        for a, b in pairs:
            label = [a if x == b else x for x in label]
            size[a] += size[b]
            for x in live:
                d[a][x] += d[b][x]
            for x in live:
                d[x][a] += d[x][b]
            live.remove(b)
    return label


def average_linkage(nodes: DataFrame, vector: Callable[[list[str] | str], dict[int, float]], least: float, held: int = HELD, wanted: Callable[[list[int]], bool] | None = None) -> DataFrame:
    """(node, cluster) of nodes (c, node, names): clusters within each group c of nodes, named by one of their nodes.

    vector makes the vector of a node from its names (an array, or a text of them). The linkage of two clusters is the mean of the
    dot products of all pairs between them, whether anybody compared them before or not. Nodes with
    equal names begin as one cluster, so a group's cost depends on its different spellings only. A
    group of up to held nodes is clustered in one task; of larger ones, nodes of equal names are
    gathered first, and what has more than held spellings still is clustered by rounds over the tasks
    (by_rounds), with the same result. wanted tells by the nodes of a group of up to held nodes
    whether anybody needs its clusters; without it all are.

    Defined results: a node alone is a cluster of its own; a node given twice in a group counts
    once; a node without names is like no other.
    """
    nodes = checkpointed(nodes.select("c", "node", "names"))
    grown = checkpointed(nodes.groupBy("c").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > held).select("c"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, cluster = [], []

        def out(group: list[tuple[int, list[str] | str]]) -> None:
            if wanted and not wanted([x for x, _ in group]):
                return
            of: dict[tuple | str, tuple[list[str] | str, list[int]]] = {}
            before = None
            for x, ns in group:
                if x != before:
                    of.setdefault(ns if isinstance(ns, str) else tuple(ns), (ns, []))[1].append(x)
                before = x
            leaf = [x for _, x in of.values()]
            label = merged([vector(ns) for ns, _ in of.values()], [len(x) for x in leaf], least) if len(leaf) > 1 else [0]
            for x, to in zip(leaf, label):
                node.extend(x)
                cluster.extend([leaf[to][0]] * len(x))

        now, group = None, []
        for b in batches:
            for c, *rest in zip(*(b.column(i).to_pylist() for i in range(3))):
                if c != now and group:
                    out(group)
                    group = []
                now = c
                group.append(tuple(rest))
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(cluster, pa.int64())], ["node", "cluster"])
            node.clear()
            cluster.clear()
        if group:
            out(group)
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(cluster, pa.int64())], ["node", "cluster"])

    at_once = lambda df: df.repartition("c").sortWithinPartitions("c", "node").mapInArrow(whole, "node long, cluster long")
    if grown.isEmpty():
        return at_once(nodes)
    rest = nodes.join(grown, "c", "left_semi").dropDuplicates(["c", "node"])
    return at_once(nodes.join(grown, "c", "left_anti")).unionByName(_gathered(checkpointed(rest), vector, least, held))


def _gathered(nodes: DataFrame, vector: Callable[[list[str] | str], dict[int, float]], least: float, held: int) -> DataFrame:
    """average_linkage of groups of many different nodes."""
    leaf = checkpointed(nodes.groupBy("c", "names").agg(F.min("node").alias("leaf"), F.count(F.lit(1)).alias("n")))
    large = checkpointed(leaf.groupBy("c").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > held).select("c"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(group: list[tuple[int, int, list[str]]]) -> tuple[list[int], list[int]]:
            ids = [x for x, _, _ in group]
            return ids, [ids[i] for i in merged([vector(v) for _, _, v in group], [n for _, n, _ in group], least)] if len(ids) > 1 else ids

        now, group = None, []
        for b in batches:
            node, cluster = [], []
            for c, *rest in zip(*(b.column(i).to_pylist() for i in range(4))):
                if c != now and group:
                    x, y = out(group)
                    node += x
                    cluster += y
                    group = []
                now = c
                group.append(tuple(rest))
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(cluster, pa.int64())], ["leaf", "cluster"])
        if group:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out(group)], ["leaf", "cluster"])

    def weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(2).to_pylist()
            v = [vector(x) for x in b.column(3).to_pylist()]
            f, w = pa.array([list(x) for x in v], pa.list_(pa.int64())), pa.array([[y * k for y in x.values()] for x, k in zip(v, n)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), f, w], ["c", "node", "n", "f", "w"])

    leaf_rows = leaf.select("c", "leaf", "n", "names")
    if large.isEmpty():
        found = leaf_rows.repartition("c").sortWithinPartitions("c", "leaf").mapInArrow(run, "leaf long, cluster long")
    else:
        small = leaf_rows.join(large, "c", "left_anti").repartition("c").sortWithinPartitions("c", "leaf").mapInArrow(run, "leaf long, cluster long")
        sums = leaf_rows.join(large, "c", "left_semi").mapInArrow(weighted, "c long, node long, n long, f array<long>, w array<double>")
        found = small.unionByName(by_rounds(sums, least, held).withColumnRenamed("node", "leaf"))
    return nodes.join(leaf, ["c", "names"]).select("node", "leaf").join(checkpointed(found), "leaf").select("node", "cluster")


def by_rounds(nodes: DataFrame, least: float, held: int = HELD) -> DataFrame:
    """average_linkage of sum vectors (c, node, n, f, w) in large groups: rounds of mutual nearest clusters, as many as it takes.

    A round compares the sum vectors of a group's clusters in blocks of about held times held; a
    task puts out the nearest of each cluster only, so no pair but these is ever written. Clusters
    are never collected; each round is cut by checkpoints.
    """
    cl = checkpointed(nodes.select("c", "node", "f", "w", "n"))
    label = checkpointed(cl.select("c", "node", F.col("node").alias("cluster")))
    while True:
        k = cl.groupBy("c").agg(F.ceil(F.count(F.lit(1)) / held).cast("int").alias("k"))
        part = cl.join(k, "c").withColumn("own", F.pmod(F.xxhash64("node"), "k").cast("int"))
        each = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
        rows = part.withColumn("x", each).select("c", F.col("own").alias("p"), F.col("x").alias("q"), F.lit(0).alias("side"), "node", "f", "w", "n")
        cols = part.withColumn("x", each).select("c", F.col("x").alias("p"), F.col("own").alias("q"), F.lit(1).alias("side"), "node", "f", "w", "n")

        def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def out(group: list[tuple]) -> pa.RecordBatch:
                x = _dense([dict(zip(f, w)) for _, _, f, w, _ in group])
                side = np.array([g[0] for g in group])
                ids, n = np.array([g[1] for g in group], np.int64), np.array([g[4] for g in group], float)
                left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                if not len(left) or not len(right):
                    return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2 + [pa.array([], pa.float64())], ["a", "b", "s"])
                s = np.round(x[left] @ x[right].T / np.outer(n[left], n[right]), DIGITS)
                s[ids[left][:, None] == ids[right][None, :]] = -np.inf
                best = s.argmax(axis=1)
                ok = np.flatnonzero(s[np.arange(len(left)), best] >= least)
                return pa.RecordBatch.from_arrays([pa.array(ids[left][ok]), pa.array(ids[right][best[ok]]), pa.array(s[ok, best[ok]])], ["a", "b", "s"])

            now, group = None, []
            for b in batches:
                for c, p, q, *rest in zip(*(b.column(i).to_pylist() for i in range(8))):
                    if (c, p, q) != now and group:
                        yield out(group)
                        group = []
                    now = (c, p, q)
                    group.append(tuple(rest))
            if group:
                yield out(group)

        found = rows.unionByName(cols).repartition("c", "p", "q").sortWithinPartitions("c", "p", "q", "side", "node").mapInArrow(nearest, "a long, b long, s double")
        best = checkpointed(found.groupBy("a").agg(F.max(F.struct("s", (-F.col("b")).alias("nb"))).alias("r")).select("a", (-F.col("r.nb")).alias("b")))
        pair = best.join(best.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"]).where("a < b")
        pair = checkpointed(pair.select(F.col("b").alias("old"), F.col("a").alias("new")))
        if pair.isEmpty():
            return label.select("node", "cluster")
        to = lambda x: F.coalesce("new", x)
        label = checkpointed(label.join(pair, label["cluster"] == pair["old"], "left").select("c", "node", to("cluster").alias("cluster")))
        moved = cl.join(pair, cl["node"] == pair["old"], "left").select("c", to("node").alias("node"), "f", "w", "n", (F.col("old").isNotNull() | F.lit(False)).alias("gone"))
        touched = moved.where("gone").select("node").distinct()
        same = cl.join(pair, cl["node"] == pair["old"], "left_anti").join(touched, "node", "left_anti").select("c", "node", "f", "w", "n")
        grown = moved.join(touched, "node", "left_semi")
        n = grown.groupBy("c", "node").agg(F.sum("n").alias("n"))
        w = grown.select("c", "node", F.explode(F.arrays_zip("f", "w")).alias("e")).groupBy("c", "node", F.col("e.f").alias("f")).agg(F.sum("e.w").alias("w"))
        w = w.groupBy("c", "node").agg(F.collect_list(F.struct("f", "w")).alias("e")).select("c", "node", F.col("e.f").alias("f"), F.col("e.w").alias("w"))
        cl = checkpointed(same.unionByName(w.join(n, ["c", "node"]).select("c", "node", "f", "w", "n")))
