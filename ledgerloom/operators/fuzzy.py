"""Exact joins of texts by insert/delete similarity: all pairs are bounded by bit counts of their letters and letter pairs, what is left is scored."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.similarity import plain, token_set
from ledgerloom.session import checkpointed

#: Rows of each side that one task compares at once; blocks with more are compared in parts.
HELD = 65_536
#: Parts of a block are no smaller than this if there are fewer than four.
SMALL = 4_000
#: Words of 64 bits that tell the letter pairs of a text (a fixed number; where two pairs share a bit, only the bound is looser).
WORDS = 4
#: Rows and columns of the matrix of bit counts that is held at once.
TILE = (32, 2_048)


def letter_pairs(text: str) -> list[str]:
    """The numbered letter pairs of a text with a blank at both ends: the same for every order of its words."""
    p = f" {text} "
    seen: Counter[str] = Counter()
    out = []
    for i in range(len(p) - 1):
        g = p[i : i + 2]
        out.append(f"{g}{seen[g]}")
        seen[g] += 1
    return out


def numbered_letters(text: str) -> list[str]:
    seen: Counter[str] = Counter()
    out = []
    for c in text:
        out.append(f"{c}{seen[c]}")
        seen[c] += 1
    return out


@lru_cache(1 << 16)
def _slot(g: str) -> int:
    return 1 << crc32(g.encode()) % (64 * WORDS)


def _least_letters(n, m, tau: float, sets: bool):
    """Letters any two texts of n and m characters share at least (a bound on the LCS, or on the common words)."""
    need = np.ceil(tau * (n + m) / 2 - 1e-9)
    return np.minimum(need, np.ceil(np.minimum(n, m) * tau / (2 - tau) - 1e-9)) if sets else need


def _least_pairs(n, m, tau: float):
    """The same of letter pairs, with sets: a letter left out spoils two pairs, one put in spoils one, so 3 LCS + 1 - n - m are shared; common words keep all of theirs."""
    return np.minimum(np.ceil((1.5 * tau - 1) * (n + m) + 1 - 1e-9), np.ceil(np.minimum(n, m) * tau / (2 - tau) + 1 - 1e-9))


class Texts:
    """Lengths and bits of one text of many rows, as arrays."""

    def __init__(self, n: np.ndarray, letters: np.ndarray, pairs: np.ndarray):
        self.n, self.letters, self.pairs = n, letters, pairs

    def shared(self, i: np.ndarray, other: Texts, j: np.ndarray, pairs: bool) -> np.ndarray:
        """At most so many letters (or letter pairs) rows i here share with rows j there."""
        x, y = (self.pairs[i], other.pairs[j]) if pairs else (self.letters[i, None], other.letters[j, None])
        count = lambda a: np.bitwise_count(a).sum(axis=1, dtype=np.int64)
        return np.minimum(self.n[i] + pairs - count(x & ~y), other.n[j] + pairs - count(y & ~x))

    def best(self, i: np.ndarray, other: Texts, j: np.ndarray) -> np.ndarray:
        """At most this insert/delete ratio."""
        n = self.n[i] + other.n[j]
        most = np.minimum(self.shared(i, other, j, False), (self.shared(i, other, j, True) + n - 1) / 3)
        return 200.0 * most / np.maximum(n, 1)


def _met(x: Texts, y: Texts, tau: float, sets: bool, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows i of x and j of y, in portions, of which the shorter lacks no more bits than a similarity of tau allows.

    Every pair is looked at; texts of no characters are in none. Where x and y are the same rows, a pair comes once.
    """
    by = np.argsort(y.n, kind="stable")
    by = by[np.searchsorted(y.n[by], 1) :]
    m = y.n[by]
    # With sets the folded letter pairs tell more than the letters.
    bits = (lambda t: np.bitwise_or.reduce(t.pairs, axis=1)) if sets else (lambda t: t.letters)
    bx, by_bits = bits(x), bits(y)[by]
    not_y = ~by_bits
    buf, cnt, hit = np.empty(TILE[0] * TILE[1], np.uint64), np.empty(TILE[0] * TILE[1], np.uint8), np.empty(TILE[0] * TILE[1], bool)
    order = np.argsort(x.n, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(x.n[order]) != 0]) if len(order) else []
    for s, e in zip(starts, [*starts[1:], len(order)]):
        n = int(x.n[order[s]])
        if n == 0:
            continue
        lo = 0 if sets else np.searchsorted(m, tau / (2 - tau) * n - 1e-9)
        mid = np.searchsorted(m, n, side="right")
        hi = mid if same else len(m) if sets else np.searchsorted(m, (2 - tau) / tau * n + 1e-9, side="right")
        least = _least_pairs(n, m[lo:hi], tau) - 1 if sets else _least_letters(n, m[lo:hi], tau, False)
        room = np.clip(np.minimum(n, m[lo:hi]) - least + 1, 0, 255).astype(np.uint8)
        for u in range(s, e, TILE[0]):
            rows = order[u : min(u + TILE[0], e)]
            mine = bx[rows][:, None]
            for first, last, a, b in ((lo, mid, ~mine, by_bits), (mid, hi, mine, not_y)):
                for v in range(first, last, TILE[1]):
                    w = min(v + TILE[1], last)
                    k, shape = len(rows) * (w - v), (len(rows), w - v)
                    np.bitwise_and(a, b[None, v:w], out=buf[:k].reshape(shape))
                    np.bitwise_count(buf[:k], out=cnt[:k])
                    np.less(cnt[:k].reshape(shape), room[None, v - lo : w - lo], out=hit[:k].reshape(shape))
                    f = np.flatnonzero(hit[:k])
                    if len(f):
                        i, j = rows[f // (w - v)], by[v + f % (w - v)]
                        if same:  # of one length, each pair is seen twice
                            keep = (x.n[i] > y.n[j]) | (i > j)
                            i, j = i[keep], j[keep]
                        yield i, j


def alike(left: DataFrame, right: DataFrame | None, least: float, sets: bool = False, held: int = HELD) -> DataFrame:
    """(l, r, score): all pairs of texts (id long, text) with a score of at least least; l < r where right is None.

    The score is the insert/delete ratio, or with sets the token-set ratio. Defined results: null and
    empty texts are in no pair; least must be above 66.7.
    """
    if least / 100 <= 2 / 3 + 1e-9:
        raise ValueError("least must be above 66.7")
    t = lambda df: None if df is None else df.select("id", "text", F.lit("").alias("more"), F.lit("").alias("block"))
    return alike_rows(t(left), t(right), least, "one", sets, held).select("l", "r", "score")


def alike_rows(left: DataFrame, right: DataFrame | None, least: float, rule: str, sets: bool = False, held: int = HELD) -> DataFrame:
    """(l, r, score, more_score): all pairs of rows (id long, text, more, block) of equal blocks that keep the rule; l < r where right is None.

    Rules: one: the texts reach least; both: more does, too; mean: the mean of both scores does, or
    that of text alone where a side has no more. The score is the insert/delete ratio, or with sets
    the token-set ratio.

    No pair is missed, as every pair of a block is looked at: the letters and the letter pairs of a
    text stand in bits, and bits of the shorter text that the other lacks bound the score. The first
    bound is one bit count a pair, in matrices; only pairs that pass the bounds of both texts are
    scored. Large blocks are cut into parts of held rows, and each task compares two of them.
    """
    tau, one = least / 100, right is None
    rows = left.select(F.lit(0).alias("side"), F.col("id").cast("long").alias("id"), "block", "text", "more")
    if not one:
        rows = rows.unionByName(right.select(F.lit(1).alias("side"), F.col("id").cast("long").alias("id"), "block", "text", "more"))
    rows = rows.where("id is not null and block is not null and trim(text) <> ''").withColumn("more", F.coalesce("more", F.lit("")))
    rows = checkpointed(rows.where("trim(more) <> ''") if rule == "both" else rows)
    own = lambda t: " ".join(sorted(set(t.split()))) if sets else t

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter[tuple[int, str]] = Counter()
        for b in batches:
            for k in (0, 1):
                for t in b.column(k).to_pylist():
                    c.update((k, g) for g in numbered_letters(own(t)))
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in c], pa.int32()), pa.array([g for _, g in c], pa.string()), pa.array(list(c.values()), pa.int64())], ["k", "g", "n"])

    # The 64 letters of a text that tell most: those nearest to standing in half of the rows.
    total = rows.count()
    g = rows.select("text", "more").mapInArrow(counted, "k int, g string, n long").groupBy("k", "g").agg(F.sum("n").alias("n"))
    chosen = [{r["g"]: 1 << i for i, r in enumerate(g.where(F.col("k") == k).orderBy(F.abs(F.col("n") * 2 - total), "g").limit(64).collect())} for k in (0, 1)]
    longs = [f"{t}_{c}" for t in ("text", "more") for c in ("n", "letters", *(f"pairs{w}" for w in range(WORDS)))]

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = (1 << 64) - 1
        for b in batches:
            cols = []
            for k, name in enumerate(("text", "more")):
                n, letters, pairs = [], [], []
                for t in b.column(b.schema.get_field_index(name)).to_pylist():
                    w = own(t)
                    n.append(len(w))
                    letters.append(sum(chosen[k].get(g, 0) for g in numbered_letters(w)))
                    s = 0
                    for g in letter_pairs(w) if w else ():
                        s |= _slot(g)
                    pairs.append(s)
                words = [n, letters, *([s >> 64 * w & full for s in pairs] for w in range(WORDS))]
                cols += [pa.array(np.array(x, np.uint64).view(np.int64)) for x in words]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], [*b.schema.names, *longs])

    score = token_set if sets else plain

    def compare(x: tuple, y: tuple, same: bool) -> Iterator[tuple[int, int, float, float | None]]:
        (xi, xt, xm, xa, xb), (yi, yt, ym, ya, yb) = x, y

        def bounded(a: Texts, b: Texts, i: np.ndarray, j: np.ndarray) -> np.ndarray:
            if not sets:
                return a.best(i, b, j) >= least - 1e-6
            n, m = a.n[i], b.n[j]
            return (a.shared(i, b, j, False) >= _least_letters(n, m, tau, True)) & (a.shared(i, b, j, True) >= _least_pairs(n, m, tau))

        def left_over() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for i, j in _met(xa, ya, tau, sets, same):
                k = bounded(xa, ya, i, j)
                i, j = i[k], j[k]
                if rule == "both":
                    k = bounded(xb, yb, i, j)
                elif rule == "mean":
                    k = (xb.n[i] == 0) | (yb.n[j] == 0) | (xa.best(i, ya, j) + xb.best(i, yb, j) >= 2 * least - 1e-6)
                else:
                    k = slice(None)
                yield i[k], j[k]
            if rule == "mean":  # the others need a more that reaches least
                for i, j in _met(xb, yb, tau, sets, same):
                    k = xb.best(i, yb, j) >= least - 1e-6
                    i, j = i[k], j[k]
                    name = xa.best(i, ya, j)
                    k = name + xb.best(i, yb, j) >= 2 * least - 1e-6
                    i, j = i[k], j[k]
                    k = ~_passes(i, j)
                    yield i[k], j[k]

        def _passes(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            """Whether the pair has come by its text already."""
            n, m = xa.n[i], ya.n[j]
            lack = np.where(m <= n, np.bitwise_count(ya.letters[j] & ~xa.letters[i]), np.bitwise_count(xa.letters[i] & ~ya.letters[j]))
            near = (np.minimum(n, m) >= tau / (2 - tau) * np.maximum(n, m) - 1e-9) & (lack <= np.minimum(n, m) - _least_letters(n, m, tau, False))
            return near & (xa.best(i, ya, j) >= least - 1e-6)

        for i, j in left_over():
            for a, b in zip(i.tolist(), j.tolist()):
                l, r = xi[a], yi[b]
                if one and l == r:
                    continue
                s = score(xt[a], yt[b])
                u = None
                if rule == "one" or rule == "mean" and not (xm[a] and ym[b]):
                    if s < least - 1e-9:
                        continue
                elif rule == "both":
                    if s < least - 1e-9 or (u := score(xm[a], ym[b])) < least:
                        continue
                elif s < 2 * least - 100 or (s + (u := score(xm[a], ym[b]))) / 2 < least:
                    continue
                yield (min(l, r), max(l, r), s, u) if one else (l, r, s, u)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key: tuple, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(parts)
            side = t["half"].to_numpy()
            sides = []
            for h in (0, 1):
                s = t.filter(pa.array(side == h))
                v = [s[c].to_numpy() for c in longs]
                of = lambda k: Texts(v[k], v[k + 1].view(np.uint64), np.stack([x.view(np.uint64) for x in v[k + 2 : k + 2 + WORDS]], axis=1))  # noqa: B023, E731
                sides.append((s["id"].to_pylist(), s["text"].to_pylist(), s["more"].to_pylist(), of(0), of(2 + WORDS)))
            same = one and key[1] == key[2]
            got = list(compare(sides[0], sides[0] if same else sides[1], same))
            cols = list(zip(*got)) if got else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.float64()))], ["l", "r", "score", "more_score"])

        now, parts = None, []
        for b in batches:
            if not b.num_rows:
                continue
            keys = list(zip(*(b.column(k).to_pylist() for k in range(3))))
            starts = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1])]
            for s, e in zip(starts, [*starts[1:], len(keys)]):
                if keys[s] != now:
                    if now is not None:
                        yield from out(now, parts)
                    now, parts = keys[s], []
                parts.append(b.slice(s, e - s))
        if now is not None:
            yield from out(now, parts)

    schema = "side int, id long, block string, text string, more string, " + ", ".join(f"{c} long" for c in longs)
    signs = checkpointed(rows.mapInArrow(signed, schema))
    n = F.count(F.lit(1))
    sizes = signs.groupBy("block").agg(F.greatest(F.ceil(n / held), F.least(F.lit(4), F.ceil(n / SMALL))).cast("int").alias("n"), F.countDistinct("side").alias("sides"), n.alias("all"))
    sizes = sizes.where("all > 1" if one else "sides = 2").select("block", "n")
    cut = signs.join(sizes, "block").withColumn("own", F.pmod(F.xxhash64("side", "id"), "n").cast("int")).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    first = F.least("own", "x") if one else F.when(F.col("side") == 0, F.col("own")).otherwise(F.col("x"))
    last = F.greatest("own", "x") if one else F.when(F.col("side") == 0, F.col("x")).otherwise(F.col("own"))
    cut = cut.select("block", first.alias("p"), last.alias("q"), ((F.col("own") > F.col("x")).cast("int") if one else F.col("side")).alias("half"), "id", "text", "more", *longs)
    # Tasks by number of pairs of parts, as far as the cluster's own partitioning would put several into one.
    tasks = sizes.agg(F.sum(F.col("n") * F.col("n"))).first()[0] or 1
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(int(tasks), 1_000))
    return cut.repartition(tasks, "block", "p", "q").sortWithinPartitions("block", "p", "q").mapInArrow(judge, "l long, r long, score double, more_score double")


def containing(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """Rows of left and right where one of the texts a and b contains the other, by an equi-join on heads.

    The head of the contained text (its first three characters, or all of a shorter one) is one of
    the pieces of the other, so only rows with such a piece meet.
    """

    def pieces(c: str) -> Column:
        n = F.length(c)

        def of(k: int) -> Column:
            return F.transform(F.sequence(F.lit(1), F.greatest(n - k + 1, F.lit(1))), lambda i: F.substring(F.col(c), i, F.lit(k)))

        return F.array_distinct(F.filter(F.concat(of(1), of(2), of(3)), lambda x: x != ""))

    head = lambda c: F.substring(c, 1, 3)
    x, y = left.where(f"{a} <> ''"), right.where(f"{b} <> ''")
    inside = x.withColumn("__k", head(a)).join(y.withColumn("__k", F.explode(pieces(b))), "__k").where(F.col(b).contains(F.col(a)))
    around = x.withColumn("__k", F.explode(pieces(a))).join(y.withColumn("__k", head(b)), "__k").where(F.col(a).contains(F.col(b)))
    return inside.unionByName(around.select(inside.columns)).drop("__k").distinct()
