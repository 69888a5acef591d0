"""Filling fixed-capacity containers with documents: lexical retrieval packing."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import checkpointed

#: BM25's constants.
K1, B = 1.2, 0.75
#: Documents in one shard of the index, about. A shard is packed by one task; shards grow in number only.
SHARD = 4000
#: Open containers repacked together when shards are closed.
CLOSE = 64
#: While more of a container than this is free its seed's nearest neighbours are taken whatever their
#: size; then the nearest of those that fill it to within SLACK of the best fit.
FREE, SLACK = 0.5, 0.05
#: Terms in more than this share of a shard's documents are kept as rows over all documents, which add up faster than postings.
COMMON = 0.25

_WORD = re.compile(r"\w+")
_SPACELESS = re.compile("[぀-ヿ㐀-鿿฀-๿]")


def terms(text: str) -> Counter[str]:
    """Words of a text; pairs of characters where words are not spaced."""
    low = text.lower()
    if low.isascii() or not _SPACELESS.search(low):
        return Counter(_WORD.findall(low))
    c: Counter[str] = Counter()
    for w in _WORD.findall(low):
        if _SPACELESS.search(w):
            c.update(w[i : i + 2] for i in range(max(1, len(w) - 1)))
        else:
            c[w] += 1
    return c


class Index:
    """BM25 inverted index of one shard."""

    def __init__(self, texts: list[str | None]):
        ids: dict[str, int] = {}
        docs, tids, tfs, self.queries, lens = [], [], [], [], []
        for d, text in enumerate(texts):
            c = terms(text or "")
            q = [ids.setdefault(t, len(ids)) for t in c]
            self.queries.append(np.array(q, np.int32))
            lens.append(sum(c.values()))
            docs.append(np.full(len(q), d, np.int32))
            tids.append(self.queries[-1])
            tfs.append(np.fromiter(c.values(), np.float32, len(q)))
        n = len(texts)
        self.n = n
        doc, tid, tf = (np.concatenate(x) if x else np.zeros(0, np.int32) for x in (docs, tids, tfs))
        order = np.argsort(tid, kind="stable")
        # In the types that bincount adds up without a copy.
        self.doc = doc[order].astype(np.intp)
        self.terms, self.from_ = tid, np.r_[0, np.cumsum([len(q) for q in self.queries])].astype(np.int64)
        self.asked = np.zeros(len(ids), bool)
        self.kept: dict[int, np.ndarray] = {}
        df = np.bincount(tid, minlength=len(ids)) if len(tid) else np.zeros(0, int)
        self.at = np.r_[0, np.cumsum(df)]
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        length = np.array(lens, np.float32)
        norm = K1 * (1 - B + B * length / max(1.0, length.mean() if n else 1.0))
        self.forward = (idf[tid] * tf * (K1 + 1) / (tf + norm[doc])).astype(np.float32) if len(tid) else np.zeros(0, np.float32)
        self.weight = self.forward[order].astype(np.float64)
        self.useful = df > 1 if len(df) else np.zeros(0, bool)
        common = np.flatnonzero(self.useful & (df > COMMON * n)) if len(df) else np.zeros(0, int)
        self.row = np.full(len(ids), -1, np.int32)
        self.row[common] = np.arange(len(common))
        self.dense = np.zeros((len(common), n), np.float32)
        for k, t in enumerate(common):
            span = slice(self.at[t], self.at[t + 1])
            self.dense[k, self.doc[span]] = self.weight[span]

    def scores(self, d: int) -> np.ndarray:
        """BM25 of every document for document d as the query; kept, as every capacity asks for much the same seeds."""
        if d not in self.kept:
            self.kept[d] = self._scores(d)
        return self.kept[d]

    def _scores(self, d: int) -> np.ndarray:
        q = self.queries[d]
        q = q[self.useful[q]] if len(q) else q
        if not len(q):
            return np.zeros(self.n, np.float32)
        row = self.row[q]
        of = np.zeros(len(self.dense), np.float32)
        of[row[row >= 0]] = 1
        out = of @ self.dense
        spans = [slice(self.at[t], self.at[t + 1]) for t in q[row < 0]]
        if spans:
            out = out + np.bincount(np.concatenate([self.doc[s] for s in spans]), np.concatenate([self.weight[s] for s in spans]), self.n)
        return out.astype(np.float32)

    def scores_of(self, d: int, docs: np.ndarray) -> np.ndarray:
        """The same for a few documents only, from their own terms."""
        q = self.queries[d]
        q = q[self.useful[q]] if len(q) else q
        a, b = self.from_[docs], self.from_[docs + 1]
        n = b - a
        out = np.zeros(len(docs), np.float32)
        if not len(q) or not n.sum():
            return out
        at = np.repeat(a - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        self.asked[q] = True
        v = np.where(self.asked[self.terms[at]], self.forward[at], np.float32(0))
        self.asked[q] = False
        full = n > 0
        out[full] = np.add.reduceat(v, np.r_[0, np.cumsum(n)[:-1]][full])
        return out


#: Up to so many candidates are scored one by one, more by the inverted index.
FEW = 150


def pack(sizes: np.ndarray, capacity: int, scores, scores_of=None) -> list[list[int]]:
    """Containers of at most capacity, as lists of item numbers; every item is put into one, whole.

    Seeds are taken from the largest item down. A seed's window is filled with the unused items
    its retrieval scores rank highest: any that fit while more than FREE of it is empty, then those
    within SLACK of the best fit, until nothing unused fits.
    """
    n = len(sizes)
    order = np.argsort(-sizes, kind="stable")
    rank = sizes[order]
    alive = np.ones(n + 1, bool)
    alive[n] = False
    nxt = list(range(n + 1))  # the next unused place at or after a place

    def first(i: int) -> int:
        root = i
        while nxt[root] != root:
            root = nxt[root]
        while nxt[i] != root:
            nxt[i], i = root, nxt[i]
        return root

    def use(place: int) -> None:
        alive[place] = False
        nxt[place] = place + 1

    down = -rank
    slack = max(1, int(SLACK * capacity))
    out = []
    seed = first(0)
    while seed < n:
        use(seed)
        box, free = [int(order[seed])], capacity - int(rank[seed])
        near = None
        while free >= 0:
            top = first(int(np.searchsorted(down, -free)))
            if top >= n:
                break
            if free > FREE * capacity:
                end = n
            else:
                end = int(np.searchsorted(down, -(int(rank[top]) - slack), side="right"))
            places = np.flatnonzero(alive[top:end]) + top if end - top > 1 else np.array([top])
            if len(places) > 1:
                if near is None and scores_of is not None and end < n and len(places) <= FEW:
                    s = scores_of(box[0], order[places])
                else:
                    near = scores(box[0]) if near is None else near
                    s = near[order[places]]
                if end == n:
                    # Take as many of the nearest as fit in one go, best first.
                    k = min(len(places), 64)
                    best = places[np.argpartition(-s, k - 1)[:k]]
                    best = best[np.argsort(-near[order[best]], kind="stable")]
                    took = False
                    for p in best:
                        if rank[p] <= free and free > FREE * capacity and near[order[p]] > 0:
                            use(int(p))
                            box.append(int(order[p]))
                            free -= int(rank[p])
                            took = True
                    if took:
                        continue
                    pick = top
                else:
                    pick = int(places[int(np.argmax(s))])
            else:
                pick = int(places[0])
            use(pick)
            box.append(int(order[pick]))
            free -= int(rank[pick])
        out.append(box)
        seed = first(seed)
    return out


SCHEMA = "container_kind string, container_no long, doc_id long, part_no int, part_start long, part_tokens long, open boolean"


def _rows(kind, number, doc, part, start, size, opened) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.string()), pa.array(number, pa.int64()), pa.array(doc, pa.int64()), pa.array(part, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(opened, pa.bool_())],
        ["container_kind", "container_no", "doc_id", "part_no", "part_start", "part_tokens", "open"],
    )


def sign(text: Column) -> Column:
    """Neighbours by a cheap sign: the smallest hash of the longer words (texts with much in common share it often)."""
    return F.array_min(F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}{6,}"), F.lit(0)), lambda w: F.xxhash64(w)))


def packed(documents: DataFrame, containers: DataFrame) -> DataFrame:
    """(container_kind, container_no, doc_id, part_no, part_start, part_tokens): every document of every kind
    of container, whole, but those larger than the capacity, which are cut into full containers and a rest.

    The documents are ordered by language and by their rarest frequent word and cut into shards of
    about SHARD neighbours (the document number is the last term of the order, so a language or
    word with a third of all rows is cut like the rest). Each shard builds its BM25 index once and
    packs every capacity from it. Then the least full container of each shard is opened, and CLOSE
    of them at a time are repacked by best fit, round by round until one task remains, so that
    sharding costs at most one container in all.

    Sizes are n_tokens, or the UTF-8 bytes of the text where it is null.

    Defined results: null and empty texts have size 0 and are put into containers like all; a
    repeated doc_id counts once; kinds without a positive capacity are left out.
    """
    spark = documents.sparkSession
    kinds = [(r[0], int(r[1])) for r in containers.where("capacity_tokens > 0 and container_kind is not null").select("container_kind", "capacity_tokens").distinct().orderBy("capacity_tokens", "container_kind").limit(1001).collect()]
    if len(kinds) > 1000:
        raise ValueError("more than 1000 kinds of containers")
    docs = documents.where("doc_id is not null").select(
        "doc_id", "text", F.coalesce(F.col("n_tokens").cast("long"), F.octet_length("text").cast("long"), F.lit(0).cast("long")).alias("size"), F.lower(F.substring(F.coalesce("lang", F.lit("")), 1, 2)).alias("__lang")
    )
    n = docs.count()
    if not n:
        return spark.createDataFrame([], SCHEMA).drop("open")
    shards = max(1, math.ceil(n / SHARD))
    ordered = docs.withColumn("__sign", sign(F.col("text"))).repartitionByRange(shards, "__lang", "__sign", "doc_id").select("doc_id", "text", "size")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: dict[int, int] = {}
        texts, sizes = [], []
        for b in batches:
            for d, t, s in zip(*(b.column(i).to_pylist() for i in range(3))):
                if d not in ids:
                    ids[d] = len(ids)
                    texts.append(t)
                    sizes.append(max(0, s))
        if not ids:
            return
        base = (TaskContext.get().partitionId() + 1) << 32
        index = Index(texts)
        del texts
        doc, size = list(ids), np.array(sizes, np.int64)
        for kind, capacity in kinds:
            cols: tuple[list, ...] = ([], [], [], [], [])
            whole, rest = size // capacity, size % capacity
            cut = (size > capacity) & (rest > 0) | (size > 0) & (rest == 0)
            number = base
            for i in np.flatnonzero(whole):
                for p in range(int(whole[i])):
                    for c, v in zip(cols, (number, doc[i], p, p * capacity, capacity)):
                        c.append(v)
                    number += 1
            items = np.flatnonzero(~((rest == 0) & (size > 0)))
            del cut
            boxes = pack(rest[items], capacity, lambda k: index.scores(int(items[k]))[items], lambda k, some: index.scores_of(int(items[k]), items[some]))
            fill = [sum(int(rest[items[k]]) for k in box) for box in boxes]
            least = min(range(len(boxes)), key=lambda k: fill[k]) if boxes else -1
            opened = [False] * len(cols[0])
            for k, box in enumerate(boxes):
                for x in box:
                    i = items[x]
                    for c, v in zip(cols, (number, doc[i], int(whole[i]), int(whole[i]) * capacity, int(rest[i]))):
                        c.append(v)
                    opened.append(k == least)
                number += 1
            yield _rows([kind] * len(opened), *cols, opened)

    out = checkpointed(ordered.mapInArrow(shard, SCHEMA))
    done, left, groups, step = [out.where("not open")], out.where("open"), shards, 1
    caps = dict(kinds)
    while groups > 1:
        groups = math.ceil(groups / CLOSE)
        step += 1

        def close(batches: Iterator[pa.RecordBatch], last: bool = groups == 1, mark: int = step) -> Iterator[pa.RecordBatch]:
            by: dict[str, list[tuple]] = {}
            for b in batches:
                for r in zip(*(b.column(i).to_pylist() for i in range(6))):
                    by.setdefault(r[0], []).append(r)
            base = (TaskContext.get().partitionId() + 1 << 32) + (mark << 58)
            for kind, rows in by.items():
                size = np.array([r[5] for r in rows], np.int64)
                boxes = pack(size, caps[kind], lambda k: np.zeros(len(size), np.float32))
                least = min(range(len(boxes)), key=lambda k: int(size[boxes[k]].sum()))
                got = [(base + k, *rows[i][2:6], not last and k == least) for k, box in enumerate(boxes) for i in box]
                yield _rows([kind] * len(got), *map(list, zip(*got)))

        left = checkpointed(left.repartition(groups, F.col("container_no") % groups).mapInArrow(close, SCHEMA))
        done.append(left.where("not open"))
        left = left.where("open")
    done.append(left)
    every = done[0]
    for d in done[1:]:
        every = every.unionByName(d)
    return every.drop("open")


def fill_report(assigned: DataFrame, containers: DataFrame) -> DataFrame:
    """Per kind: containers used, tokens, the least number of containers any packing needs, and the share filled."""
    per = assigned.groupBy("container_kind", "container_no").agg(F.sum("part_tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    a = per.groupBy("container_kind").agg(F.count(F.lit(1)).alias("containers"), F.sum("t").alias("tokens"), F.max("t").alias("fullest"), F.sum("n").alias("parts"))
    cap = containers.select("container_kind", F.col("capacity_tokens").cast("long").alias("capacity"))
    return a.join(F.broadcast(cap), "container_kind").select("container_kind", "capacity", "containers", "tokens", F.ceil(F.col("tokens") / F.col("capacity")).alias("least_containers"), "fullest", "parts", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity")), 4).alias("filled"))
