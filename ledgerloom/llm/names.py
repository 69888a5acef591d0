"""Variant spellings of names typed by people: n-gram vectors, sparse cosine joins, average-linkage groups."""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache

from ledgerloom.llm.addresses import fold, within

# Words that are no part of a name, and legal forms and trades with their short forms.
TITLES = {
    "mr", "mrs", "ms", "shri", "sri", "smt", "kum", "kumari", "dr", "prof", "late", "m", "s", "jr", "sr", "adv", "col", "decd", "deceased",
    "minor", "nri", "first", "holder", "joint", "second", "the",
}
FORMS = {
    "pvt": "private", "ltd": "limited", "lmtd": "limited", "co": "company", "huf": "huf", "tex": "textiles", "txtls": "textiles", "ent": "enterprises",
    "entp": "enterprises", "trdrs": "traders", "jewlrs": "jewellers", "chem": "chemicals", "ind": "industries", "inds": "industries", "inv": "investments",
    "invt": "investments", "char": "charitable", "n": "and",
}
ORGANISATION = {
    "private", "limited", "llp", "huf", "trust", "sons", "brothers", "company", "enterprises", "traders", "textiles", "jewellers", "chemicals", "industries",
    "investments", "finvest", "agro", "charitable", "and",
}
#: Words by which "n" between two words is known to be "and".
_LONG = (ORGANISATION | set(FORMS)) - {"n", "co"}
#: Length of the n-grams, and the number of hashed features (which bounds the weights sent to the tasks).
GRAM, FEATURES = 2, 1 << 18

_WORD = re.compile(r"[^\W\d_]+", re.U)
_BRACKET = re.compile(r"\([^)]*\)|-\s*first holder", re.I)


@lru_cache(maxsize=100_000)
def words(name: str) -> tuple[tuple[str, ...], bool]:
    """Folded words of a name without titles and additions, the family name last; and whether it is an organisation."""
    low = name.lower().replace("\xa0", " ")
    if "(" in low or "holder" in low:
        low = _BRACKET.sub(" ", low)
    low = low.replace("hindu undivided family", "huf").replace("h.u.f", "huf").replace("m/s", " ").replace("&", " and ")
    comma = low.find(",")
    parts = [_WORD.findall(low)] if comma < 0 else [_WORD.findall(low[comma:]), _WORD.findall(low[:comma])]
    out = []
    for part in parts:
        out += [FORMS.get(w, w) if len(w) > 1 else w for w in part] if _LONG.isdisjoint(part) else [FORMS.get(w, w) for w in part]
    single = [w for w in out if w not in TITLES or (len(w) == 1)]
    out = single or out
    return tuple([fold(w) if len(w) > 1 else w for w in out]), not ORGANISATION.isdisjoint(out)


_ORG = {fold(w) for w in ORGANISATION}


def key(name: str) -> str:
    """Words in one order: names that differ only in it are the same."""
    return " ".join(sorted(words(name)[0]))


def grams(k: str, aliases: dict[str, frozenset[str]]) -> dict[int, float]:
    """Hashed character n-grams of a key's words with their ends; of an initial, its beginning only.

    A short name also has the n-grams of the names it is short for, weighted less the more these are.
    """
    c: dict[int, float] = {}
    ws = k.split()
    for w in ws:
        for f, n in _word_grams(w).items():
            c[f] = c.get(f, 0) + n
    for w in ws:
        given = aliases.get(w, ()) if len(w) > 1 else ()
        for g in sorted(given):
            for f, n in _word_grams(g).items():
                if f not in c:
                    c[f] = n / math.sqrt(len(given))
    return c


@lru_cache(maxsize=100_000)
def _word_grams(w: str) -> dict[int, int]:
    p = f"^{w}$" if len(w) > 1 else f"^{w}"
    return dict(Counter([_h(p[i : i + GRAM]) for i in range(len(p) - GRAM + 1)]))


@lru_cache(maxsize=1_000_000)
def _h(s: str) -> int:
    h = 2166136261
    for b in s.encode():
        h = ((h ^ b) * 16777619) & 0xFFFFFFFF
    return h % FEATURES


#: Cosine from which two names alone may mean the same; three whole words must be equal too.
NAME_ALONE = 0.85
#: Least cosine of names that share a demat number, a telephone or mail, a house with street and place, three whole words.
LEAST = (0.4, 0.4, 0.5, NAME_ALONE)
#: Cosine from which names at one address need no agreement word by word.
SURE = 0.8
#: Weight of an n-gram that all names have.
BASE = 2.0
#: Mean cosine from which two groups are merged.
MERGE = 0.45
#: Words without an equal partner from which on two names are no variants of each other.
LOOSE = 8


class Vectors:
    """n-gram vectors of unit length, weighted by the inverse document frequency of hashed features, a fixed number of them."""

    def __init__(self, n: int, df: dict[int, int], aliases: dict[str, frozenset[str]]):
        self.n = max(n, 2)
        self.df = df
        self.aliases = aliases
        self.memo: dict[str, dict[int, float]] = {}
        self.squares: dict[str, dict[int, float]] = {}

    def weight(self, f: int) -> float:
        # The constant keeps what all names share from weighing nothing, in small tables above all.
        return BASE + math.log(1 + self.n / self.df.get(f, 1))

    def _squared(self, w: str) -> dict[int, float]:
        """Squares of the weights of a word's n-grams: these, not the weights, add up over the words of a name."""
        s = self.squares.get(w)
        if s is None:
            if len(self.squares) > 60_000:
                self.squares.clear()
            s = self.squares[w] = {f: c * self.weight(f) ** 2 for f, c in _word_grams(w).items()}
        return s

    def of(self, k: str) -> dict[int, float]:
        v = self.memo.get(k)
        if v is None:
            if len(self.memo) > 60_000:
                self.memo.clear()
            ws = k.split()
            if any(w in self.aliases for w in ws):
                v = {f: c * self.weight(f) ** 2 for f, c in grams(k, self.aliases).items()}
            else:
                v = {}
                for w in ws:
                    if v:
                        for f, x in self._squared(w).items():
                            v[f] = v[f] + x if f in v else x
                    else:
                        v = self._squared(w).copy()
            norm = sum(v.values()) or 1.0
            v = {f: math.sqrt(x / norm) for f, x in v.items()}
            self.memo[k] = v
        return v

    def mean(self, spellings: list[str]) -> dict[int, float]:
        """Mean vector of the spellings of one node: its dot product with another's is the mean of all their cosines."""
        return self.joined("|".join(spellings))

    def joined(self, spellings: str) -> dict[int, float]:
        """mean of spellings that stand between bars."""
        m = self.memo.get(spellings)
        if m is not None:
            return m
        ks = spellings.split("|")
        if len(ks) == 1:
            return self.of(spellings)
        m = {}
        for k in ks:
            for f, x in self.of(k).items():
                m[f] = m.get(f, 0.0) + x / len(ks)
        self.memo[spellings] = m
        return m

    def prefix(self, v: dict[int, float], least: float) -> list[int]:
        """The rarest features, as few as leave a rest shorter than least: vectors of length 1 or less
        that share none of these have a dot product below least. Every vector has them in the same order."""
        rest, out = sum(x * x for x in v.values()), []
        for f in sorted(v, key=lambda f: (self.df.get(f, 1), f)):
            if rest < least * least - 1e-12:
                break
            out.append(f)
            rest -= v[f] * v[f]
        return out


def dot(x: dict[int, float], y: dict[int, float]) -> float:
    s = 0.0
    for f in x.keys() & y.keys():
        s += x[f] * y[f]
    return s


def triples(k: str) -> list[str]:
    """Neighbouring triples of a person's whole words in order: what names alone must share. None for organisations."""
    w = {x for x in k.split() if len(x) > 2}
    if len(w) < 3 or not _ORG.isdisjoint(k.split()):
        return []
    w = sorted(w)
    return [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]


def compatible(a: str, b: str, aliases: dict[str, frozenset[str]]) -> float:
    """How well two names can be one: 1 all words alike, less for initials, short names, cut words; 0 if words contradict.

    Words of the shorter name are given each its own word of the longer (optimal assignment);
    words of the longer may be missing, words of the shorter may not, and at least one full word
    must agree.
    """
    if a == b:
        return 1.0
    x, y = a.split(), b.split()
    ox, oy = [w for w in x if w in _ORG], [w for w in y if w in _ORG]
    if ox and oy or (ox or oy) and min(len(x), len(y)) > 1:
        cx, cy = [w for w in x if w not in _ORG], [w for w in y if w not in _ORG]
        if not cx or not cy:
            return 0.0
        core = _assign(cx, cy, aliases)
        loose = {fold(w) for w in ("private", "limited", "and", "company")}
        tx, ty = set(ox) - loose, set(oy) - loose
        if tx and ty and not (tx & ty) and not any(within(p, q, 2) for p in tx for q in ty):
            return 0.0
        return core
    if len(x) != len(y):
        sx, sy = "".join(sorted(x)), "".join(sorted(y))
        if abs(len(sx) - len(sy)) <= 1 and sum((Counter(sx) - Counter(sy)).values()) <= 1 and len(sx) > 8:
            return 0.95
    return _assign(x, y, aliases)


def _assign(x: list[str], y: list[str], aliases: dict[str, frozenset[str]]) -> float:
    """Mean agreement of the best assignment of the shorter side's words; 0 where one of them finds none."""
    if len(x) > len(y):
        x, y = y, x
    both = Counter(x) & Counter(y)
    p, q = list((Counter(x) - both).elements()), list((Counter(y) - both).elements())
    total, full = float(sum(both.values())), any(len(w) > 2 for w in both)
    if len(p) > LOOSE:
        return 0.0
    if p:
        cost = [[-_word(a, b, aliases) for b in q] for a in p]
        # A whole word that agrees wins a tie.
        cost = [[c - 1e-4 if -c >= 0.9 and len(a) > 2 else c for c in row] for a, row in zip(p, cost)]
        for i, j in enumerate(_best(cost)):
            v = -cost[i][j]
            if v <= 0:
                return 0.0
            full = full or v > 0.9 and len(p[i]) > 2
            total += min(v, 1.0)
    return total / len(x) if full else 0.0


def _best(cost: list[list[float]]) -> list[int]:
    """Column of each row in the cheapest assignment (shortest augmenting paths; at most as many rows as columns)."""
    n, m = len(cost), len(cost[0])
    if n == 1:
        return [min(range(m), key=cost[0].__getitem__)]
    u, v, owner = [0.0] * n, [0.0] * m, [-1] * m
    for i in range(n):
        dist, seen, back = [math.inf] * m, [False] * m, [-1] * m
        row, at = i, -1
        while True:
            best, nxt = math.inf, -1
            for j in range(m):
                if seen[j]:
                    continue
                d = (dist[at] if at >= 0 else 0.0) + cost[row][j] - u[row] - v[j]
                if d < dist[j]:
                    dist[j], back[j] = d, at
                if dist[j] < best:
                    best, nxt = dist[j], j
            at, seen[nxt] = nxt, True
            if owner[at] < 0:
                break
            row = owner[at]
        far = dist[at]
        for j in range(m):
            if seen[j] and owner[j] >= 0:
                u[owner[j]] += far - dist[j]
            if seen[j]:
                v[j] -= far - dist[j]
        u[i] += far
        while at >= 0:
            owner[at] = i if back[at] < 0 else owner[back[at]]
            at = back[at]
    out = [0] * n
    for j, i in enumerate(owner):
        if i >= 0:
            out[i] = j
    return out


def _word(p: str, q: str, aliases: dict[str, frozenset[str]]) -> float:
    if p == q:
        return 1.0
    lp, lq = len(p), len(q)
    if lp == 1 or lq == 1:
        return 0.6 if p[0] == q[0] else 0.0
    m = min(lp, lq)
    if m >= 4 and within(p, q, 2 if m >= 7 else 1):
        return 0.95
    if q in aliases.get(p, ()) or p in aliases.get(q, ()):
        return 0.85
    for s, t in ((p, q), (q, p)):
        for g in aliases.get(s, ()):
            if len(g) >= 5 and within(g, t, 1):
                return 0.8
    if m >= 2 and lp != lq and (q.startswith(p) or p.startswith(q)):
        return 0.6
    return 0.0
