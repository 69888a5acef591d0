"""Evaluation texts leaking into training text: pigeonhole edit matching."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edits allowed within one window; a window is cut into one piece more.
BUDGET = 2
#: A running stretch: about eight words, or fourteen characters where words are not spaced.
STRETCH_WORDS, STRETCH_CHARS = 8, 14
#: Share of the passage that must be repeated.
COVER = 0.5
#: Characters of test passages searched for at once; larger test sets are searched in blocks.
BLOCK_CHARS = 8_000_000

_NOT_TEXT = re.compile(r"[\W_]+")


def squeeze(text: str) -> str:
    """Letters and digits only, without case, punctuation and spacing."""
    return _NOT_TEXT.sub("", text.casefold())


def piece_length(passage: str, squeezed: str) -> int:
    """Length of a piece: a stretch divided by the pieces it is cut into."""
    words = len(passage.split())
    if words and len(squeezed) / words <= 12:
        stretch = STRETCH_WORDS * len(squeezed) / words
    else:
        stretch = STRETCH_CHARS
    return max(3, min(round(stretch / (BUDGET + 1)), max(1, len(squeezed) // (BUDGET + 1))))


def masks(pattern: str) -> dict[str, int]:
    """Where each character stands in the pattern, as bits."""
    peq: dict[str, int] = {}
    for i, ch in enumerate(pattern):
        peq[ch] = peq.get(ch, 0) | 1 << i
    return peq


def myers(m: int, peq: dict[str, int], text: str, most: int) -> tuple[int, int]:
    """Least edit distance of a pattern of length m to any substring of text, and where it ends; (most + 1, -1) if above most.

    Myers' bit-parallel algorithm in its searching form; integers are as wide as the pattern.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, most + 1, -1
    for j, ch in enumerate(text):
        eq = peq.get(ch, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph <<= 1
        pv = (mh << 1 | ~(xv | ph)) & full
        mv = ph & xv & full
        if score < best:
            best, end = score, j
    return best, end


class Passages:
    """The pieces of all passages in one automaton."""

    def __init__(self, items: list[tuple[int, str]]):
        import ahocorasick

        self.items, self.windows, self.halves, self.auto, at = [], [], [], ahocorasick.Automaton(), {}
        for item, passage in items:
            s = squeeze(passage)
            if not s:
                continue
            q = piece_length(passage, s)
            k = len(self.items)
            n = max(1, len(s) // q)
            self.items.append((item, s, q, n))
            for j in range(n):
                at.setdefault(s[j * q : (j + 1) * q], []).append((k, j))
            h = max(1, q // 2)
            self.halves.append([(s[i : i + h], s[i + q - h : i + q]) for i in range(0, n * q, q)])
            self.windows.append([self._window(s, q, w) for w in range(max(1, n - BUDGET))])
        for piece, where in at.items():
            self.auto.add_word(piece, where)
        self.least = [(n * COVER - (BUDGET + 1)) / (BUDGET + 1) for _, _, _, n in self.items]
        self.empty = not at
        if at:
            self.auto.make_automaton()

    @staticmethod
    def _window(s: str, q: int, w: int) -> tuple[int, int, dict[str, int]]:
        """A window's place and its pattern masks for Myers' algorithm."""
        a, b = w * q, min(len(s), (w + BUDGET + 1) * q)
        return a, b, masks(s[a:b])

    def found(self, text: str) -> list[int]:
        """Items of which the text repeats enough."""
        if self.empty:
            return []
        t = squeeze(text)
        found = list(self.auto.iter(t))
        count: dict[int, int] = {}
        for _, where in found:
            for k, _ in where:
                count[k] = count.get(k, 0) + 1
        # A covered half holds at least one exact piece in each window: fewer hits cannot be enough.
        least = self.least
        hits: dict[int, dict[int, list[int]]] = {k: {} for k, n in count.items() if n >= least[k]}
        if not hits:
            return []
        for end, where in found:
            for k, j in where:
                if k in hits:
                    hits[k].setdefault(j, []).append(end)
        out = []
        for k, by in hits.items():
            if len(by) >= least[k] and self.covered(k, by, t) >= COVER:
                out.append(self.items[k][0])
        return out

    def covered(self, k: int, by: dict[int, list[int]], t: str) -> float:
        """Share of the passage in verified windows, lengthened at their ends as far as the texts agree."""
        _, s, q, n = self.items[k]
        size, size_t = len(s), len(t)
        mask = bytearray(size)
        tried: set[int] = set()
        slack = BUDGET + 1
        windows, halves, width = self.windows[k], self.halves[k], BUDGET + 1
        todo: list[tuple[int, int]] = []
        last_w, last_j = len(windows) - 1, len(halves) - 1
        for j, ends in by.items():
            for end in ends:
                zero = end - q + 1 - j * q  # where the passage would begin
                near = (zero // (slack + 1)) * (n + 1)
                # The pigeonhole again: each edit spoils one half of a piece at most, so a window with
                # more than BUDGET halves missing near the hit is out. Missing halves of the two
                # pieces before and behind:
                lo = end - 3 * q - slack
                around = t[lo if lo > 0 else 0 : end + 2 * q + slack + 1]
                l1 = l2 = r1 = r2 = 0
                if j > 0:
                    x, y = halves[j - 1]
                    l1 = (x not in around) + (y not in around)
                if j < last_j:
                    x, y = halves[j + 1]
                    r1 = (x not in around) + (y not in around)
                if j > 1:
                    x, y = halves[j - 2]
                    l2 = (x not in around) + (y not in around) if l1 <= BUDGET else 2
                if j + 1 < last_j:
                    x, y = halves[j + 2]
                    r2 = (x not in around) + (y not in around) if r1 <= BUDGET else 2
                for w, missing in ((j - 2, l2 + l1), (j - 1, l1 + r1), (j, r1 + r2)):
                    if missing <= BUDGET and 0 <= w <= last_w and near + w not in tried:
                        tried.add(near + w)
                        todo.append((w, zero))
        # All of these windows, and a piece more at each side of each, may not be enough: then it is no case.
        may = {w + d for w, _ in todo for d in range(-1, width + 1)}
        if (len(may) + 1) * q < COVER * size:
            return 0.0
        for w, zero in todo:
            a, b, peq = windows[w]
            place = zero + a
            lo = place - slack if place > slack else 0
            region = t[lo : place + b - a + slack]
            if place >= 0 and t[place : place + b - a] == s[a:b]:
                dist, last = 0, place - lo + b - a - 1
            else:
                dist, last = myers(b - a, peq, region, BUDGET)
            if dist > BUDGET:
                continue
            mask[a:b] = b"\1" * (b - a)
            # Lengthen to the right from the found end, to the left from the expected start.
            x, y = b, lo + last + 1
            while x < size and y < size_t and s[x] == t[y]:
                mask[x] = 1
                x, y = x + 1, y + 1
            x, y = a - 1, place - 1
            while dist == 0 and x >= 0 and y >= 0 and s[x] == t[y]:
                mask[x] = 1
                x, y = x - 1, y - 1
        return sum(mask) / size


def leaked_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id): documents that repeat at least half of an item's passage in running stretches.

    Pigeonhole: a passage is read in windows of about eight words (or fourteen characters) with an
    error budget of two edits, cut into three pieces each. A window within budget has an exact
    piece; all pieces are searched in one pass of an automaton over the whole squeezed text, each
    hit's windows are verified with Myers' bit-parallel distance, and the verified windows,
    lengthened while the texts agree, are the stretches. A document is read once per block of
    items; nothing is shuffled but the result, and hot sources need no care.

    The test set is the stated query set: it is sent to the tasks in blocks of bounded size
    (BLOCK_CHARS), as many as it takes.

    Defined results: null or empty texts and passages match nothing; a repeated row counts once;
    an item shorter than a window is one window.
    """
    spark = documents.sparkSession
    docs = documents.select("doc_id", "text").where("doc_id is not null and text is not null and text <> ''")
    src = items.select("item_id", "passage").where("item_id is not null and passage is not null and passage <> ''").dropDuplicates()

    def search(block: list[tuple[int, str]]) -> DataFrame:
        held = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            p = Passages(held.value)
            for b in batches:
                d, i = [], []
                for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    for item in p.found(text):
                        d.append(doc)
                        i.append(item)
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(i, pa.int64())], ["doc_id", "item_id"])

        return docs.mapInArrow(run, "doc_id long, item_id long")

    found, block, size = None, [], 0
    for row in src.toLocalIterator():
        block.append((row[0], row[1]))
        size += len(row[1])
        if size >= BLOCK_CHARS:
            found = search(block) if found is None else found.unionByName(search(block))
            block, size = [], 0
    if block or found is None:
        found = search(block) if found is None else found.unionByName(search(block))
    return found.distinct()
