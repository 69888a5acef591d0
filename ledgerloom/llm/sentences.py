"""Sentence boundaries across languages and scripts: unsupervised learning, then classification of each mark."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Marks that end sentences, and what may close behind them.
HARD = "!?。！？।॥؟።"
CLOSERS = "\"'”’»›)]）】」』＂"
ELLIPSIS = "…"
#: Line widths between which a text counts as wrapped, and how full a line must be to be wrapped at its end.
WRAP_LEAST, WRAP_MOST, WRAP_FULL = 40, 100, 0.85
#: A type is kept in the model if it makes up this share of its language's tokens (so 100,000 at most a language).
KEEP_SHARE, KEEP_LEAST = 1e-5, 3
#: Likelihood ratio above which a collocation is believed (7.88 is chi-squared at 0.005).
COLLOCATION = 7.88

#: Scripts of their own by first and last code point of their letters (fixed values).
_SCRIPTS = (
    ("hi", 0x0900, 0x097F), ("ar", 0x0600, 0x06FF), ("ta", 0x0B80, 0x0BFF), ("th", 0x0E00, 0x0E7F),
    ("ja", 0x3040, 0x30FF), ("zh", 0x4E00, 0x9FFF), ("ko", 0xAC00, 0xD7AF), ("ru", 0x0400, 0x04FF), ("el", 0x0370, 0x03FF),
)
_FOREIGN = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for _, a, b in _SCRIPTS) + "]+")
UNCASED = {"hi", "ar", "ta", "th", "ja", "zh", "ko"}
SPACELESS = {"ja", "zh"}

_ITEM = re.compile(r"\s*(?:(?:\d{1,3}|[ivxlcIVXLC]{1,5}|[A-Za-z])[.)]|[-–•·・*▪◦])\s+|\s*[・•]|\s*[一二三四五六七八九十]+、")
_SPAN = (
    r"\"[^\"]*\"|“[^”]*”|„[^“”]*[“”]|«[^»]*»|「[^」]*」|『[^』]*』|‘[^’]*’(?!\w)"
    r"|(?<![\w'])'(?=\w)(?:[^'\n]|'(?=\w)|\n(?!\n))*?(?<=[.!?,।])'(?!\w)|\([^()]*\)|（[^（）]*）|\[[^\[\]]*\]"
)
_MARK = re.compile(rf"[\"“„«「『‘'(（\[.…{HARD}]")
_TOKEN = re.compile(rf"(?P<span>{_SPAN})|(?P<dots>\.{{2,}}|…+)|(?P<hard>[{HARD}]+)|(?P<dot>\.)", re.S)
_ENDS = re.compile(rf"(?:[{HARD}]|\.|…)\s*$")
_STRIP = "\"'“”‘’„«»‹›()[]（）「」『』¿¡,;:،؛-–—"
_DIGITS = re.compile(r"\d+")
_NEXT = re.compile(r"\s*(\S*)")
_AFTER = re.compile(rf"[{HARD}]+\s*(\S+|$)")


def language(label: str | None) -> str:
    """en-IN, EN, en -> en; unknown or no label -> empty."""
    low = (label or "").strip().lower()[:2]
    return low if low in ("en", "fr", "de", "es", "it", "pt", "nl") else ""


@lru_cache(maxsize=70_000)
def _script_of(ch: str) -> str:
    c = ord(ch)
    return next(n for n, a, b in _SCRIPTS if a <= c <= b)


def script(text: str, latin: str) -> str:
    """Key of a paragraph's statistics: its script's language, or for the Latin script the document's."""
    if text.isascii():
        return latin
    counts: Counter[str] = Counter()
    for run in _FOREIGN.findall(text):
        counts[_script_of(run[0])] += len(run)
        if "\u3040" <= max(run) <= "\u9fff" and min(run) < "\u3100":
            counts["ja"] += 1
    if not counts:
        return latin
    top, n = counts.most_common(1)[0]
    if n * 3 < len(text):
        letters = sum(1 for ch in text if ch.isalpha())
        if n * 5 < letters * 2:
            return latin
    if top == "zh" and counts["ja"]:
        return "ja"
    return top


def paragraphs(text: str) -> Iterator[tuple[int, int]]:
    """Slices of the text between breaks; a line break inside a sentence is wrapping, not a break.

    A text is wrapped if its longest line is of a printed width; then a line runs on if the next
    word would not have fitted, and neither line looks like an item or a table row.
    """
    lines, at = [], 0
    for line in text.split("\n"):
        lines.append((at, at + len(line), line))
        at += len(line) + 1
    widest = max(len(x[2]) for x in lines)
    wrapped = WRAP_LEAST <= widest <= WRAP_MOST and len(lines) > 1
    start = None
    for k, (a, b, line) in enumerate(lines):
        if not line.strip():
            continue
        if start is None:
            start = a
        runs_on = False
        if wrapped and k + 1 < len(lines):
            nxt = lines[k + 1][2]
            word = nxt.split(None, 1)[0] if nxt.strip() else ""
            runs_on = bool(word) and len(line) + 1 + len(word) > WRAP_FULL * widest and " | " not in line and " | " not in nxt
            if runs_on and _ITEM.match(nxt) and (not nxt[:1].isalnum() or _ENDS.search(line)):
                runs_on = False
        if not runs_on:
            yield start, b
            start = None


@lru_cache(maxsize=100_000)
def norm_dot(token: str) -> str:
    """Type of a token before a period: no case, digits by length."""
    t = token.lstrip(_STRIP).lower()
    return _DIGITS.sub(lambda m: "9" if len(m[0]) <= 2 else "99", t)


@lru_cache(maxsize=100_000)
def norm_word(token: str, lang: str) -> str:
    """Type of a token that may start a sentence."""
    t = token.strip(_STRIP + ".!?।")
    if lang in SPACELESS:
        return t[:2]
    return _DIGITS.sub("9", t)


@lru_cache(maxsize=100_000)
def word_class(word: str) -> str:
    """Class a rare word backs off to."""
    if not word:
        return "*p"
    c = word[0]
    if c.isdigit():
        return "*9"
    if c.isupper():
        return "*AA" if len(word) > 1 and word.isupper() else "*Aa"
    return "*aa" if c.islower() else "*x" if c.isalpha() else "*p"


@lru_cache(maxsize=100_000)
def dot_class(t: str) -> str:
    """Class a rare type before a period backs off to."""
    if not t:
        return "*p"
    if t[-1].isdigit():
        return "*" + t[-2:] if t in ("9", "99") else "*9x"
    if "." in t:
        return "*a.a"
    n = sum(ch.isalpha() for ch in t)
    return "*1" if n <= 1 else "*s" if n <= 3 else "*l"


def count(texts: list[str | None], langs: list[str | None], into: dict[tuple[str, str], Counter]) -> None:
    """Adds the counts of some documents to one counter per (language, kind).

    Kinds: a all tokens, s sentence starts (after a mark that needs no judging, or at the head of
    a paragraph that ends like a sentence), d before a period, e before a period at a paragraph's
    end, f after a period, m and n such marks and those at a paragraph's end, c period and next
    word, l line heads (for scripts whose sentences end in a space).
    """
    for text, label in zip(texts, langs):
        if not text or not text.strip():
            continue
        latin = language(label)
        for a, b in paragraphs(text):
            p = text[a:b]
            if " | " in p:
                continue
            lang = script(p, latin)
            tokens = p.split()
            if lang in SPACELESS:
                into[lang, "a"].update(m[i : i + 2] for m in re.findall(r"\w+", p) for i in range(len(m) - 1))
            else:
                into[lang, "a"].update(tokens)
            if lang == "th":
                into[lang, "l"][tokens[0]] += 1
                continue
            item = _ITEM.match(p)
            if not item and _ENDS.search(p[-8:]):
                into[lang, "s"][norm_word(tokens[0], lang)] += 1
            for m in _AFTER.finditer(p):
                nxt = m[1]
                if not nxt:
                    into[lang, "m"][""] += 1
                    into[lang, "n"][""] += 1
                elif nxt[0] not in CLOSERS:
                    into[lang, "m"][""] += 1
                    into[lang, "s"][norm_word(nxt, lang)] += 1
            if "." not in p:
                continue
            last = len(tokens) - 1
            for i in [i for i, tok in enumerate(tokens) if tok[-1] == "."]:
                tok = tokens[i]
                if item and i == 0:
                    continue
                t = norm_dot(tok[:-1])
                if not t or t[-1] == ".":
                    continue
                into[lang, "d"][t] += 1
                if i == last:
                    into[lang, "e"][t] += 1
                else:
                    w = norm_word(tokens[i + 1], lang)
                    into[lang, "f"][w] += 1
                    if dot_class(t) != "*l":
                        into[lang, "c"][t + " " + w] += 1


def log_likelihood_ratio(k1: float, n1: float, k2: float, n2: float) -> float:
    """Dunning's ratio of two binomial samples, signed: positive where the first has the higher rate."""

    def ll(k: float, n: float, p: float) -> float:
        p = min(max(p, 1e-12), 1 - 1e-12)
        return k * math.log(p) + (n - k) * math.log(1 - p)

    p1, p2, p = k1 / max(n1, 1), k2 / max(n2, 1), (k1 + k2) / max(n1 + n2, 1)
    r = 2 * (ll(k1, n1, p1) + ll(k2, n2, p2) - ll(k1, n1, p) - ll(k2, n2, p))
    return r if p1 >= p2 else -r


class Model:
    """What is known of each language: chances that a period ends a sentence, and of words to start one.

    final[t] is the share of periods after type t that end a sentence. It is learned from line
    ends: marks that need no judging stand at a paragraph's end at a known rate, and an
    abbreviation's periods stand there more rarely. A type whose line-end rate is significantly
    below (log-likelihood ratio) is an abbreviation; in between, the rates' quotient is the share.
    start[w] is the log ratio of w's share among sentence starts to its share inside sentences.
    bound holds collocations across a period, by log-likelihood ratio.
    """

    def __init__(self, rows: list[tuple[str, str, str, int]]):
        table: dict[str, dict[str, Counter]] = {}
        for lang, kind, typ, n in rows:
            table.setdefault(lang, {}).setdefault(kind, Counter())[typ] += n
        self.final, self.start, self.bound, self.words, self.folded = {}, {}, {}, {}, {}
        marks = sum((t.get("m", Counter())[""] for t in table.values()), 0)
        ends = sum((t.get("n", Counter())[""] for t in table.values()), 0)
        base_rate = (ends + 1) / (marks + 4)
        for lang, k in table.items():
            get = lambda x: k.get(x, Counter())  # noqa: E731, B023
            # Words inside sentences: all occurrences but those at starts and after periods.
            every: Counter[str] = Counter()
            plain: Counter[str] = Counter()
            for raw, n in get("a").items():
                every[norm_word(raw, lang)] += n
                if not raw.endswith("."):
                    plain[norm_dot(raw.rstrip(_STRIP + "!?।"))] += n
            s = get("s") if lang != "th" else Counter({norm_word(w, lang): n for w, n in get("l").items()})
            mid = Counter({w: max(0, n - s[w] - get("f")[w]) for w, n in every.items()})
            if lang == "th":
                for c in (s, mid):
                    heads: Counter[str] = Counter()
                    for w, n in c.items():
                        heads["^" + w[:4]] += n
                    c.update(heads)
            self.start[lang] = self._ratios(s, mid)
            if lang == "th":
                self.start[lang] = {w: v for w, v in self.start[lang].items() if s[w] * 20 >= mid[w] and s[w]}
            low_s, low_m = Counter(), Counter()
            for w, n in s.items():
                low_s[w.lower()] += n
            for w, n in mid.items():
                low_m[w.lower()] += n
            self.folded[lang] = self._ratios(low_s, low_m)
            total = sum(every.values()) or 1
            self.words[lang] = {w: math.log(n / total) for w, n in every.most_common(400)}
            rate = (get("n")[""] + 20 * base_rate) / (get("m")[""] + 20)
            d, e = get("d"), get("e")
            cd, ce = Counter(), Counter()
            for t, n in d.items():
                cd[dot_class(t)] += n
                ce[dot_class(t)] += e[t]
            prior = {c: min(1.0, (ce[c] / cd[c]) / rate) if cd[c] else 0.5 for c in cd}
            final = {c: min(max(prior[c], 0.01), 0.99) for c in prior}
            final["*1"] = 0.02
            for t, n in d.items():
                pr = final[dot_class(t)]
                f = min(1.0, (e[t] + 4 * pr * rate) / (n + 4) / rate)
                # A word that mostly stands without a period ends a sentence where it has one.
                bare = plain[t]
                binding = log_likelihood_ratio(n, n + bare, sum(d.values()) - n, total - n - bare)
                fewer = log_likelihood_ratio(e[t], n, rate * 1e6, 1e6)
                if dot_class(t) == "*1" and t.isalpha():
                    f = 0.01  # an initial
                elif bare > n and not t[-1].isdigit():
                    f = max(f, 0.9)
                elif binding > 0 and fewer < -COLLOCATION and f < 0.1:
                    f = min(f, 0.02) if len(t) > 1 else 0.01
                elif fewer > -2 and dot_class(t) == "*l":
                    f = max(f, 0.9)
                final[t] = min(max(f, 0.003), 0.997)
            self.final[lang] = final
            n_f = sum(get("f").values()) or 1
            self.bound[lang] = {
                pair for pair, n in get("c").items()
                if n >= KEEP_LEAST and final.get(pair.split(" ")[0], 1) < 0.6
                and log_likelihood_ratio(n, d[pair.split(" ")[0]], every[pair.split(" ")[1]] - n, total - n_f) > COLLOCATION
                and s[pair.split(" ")[1]] * 20 < every[pair.split(" ")[1]]
            }

    @staticmethod
    def _ratios(s: Counter, mid: Counter) -> dict[str, float]:
        ns, nm = sum(s.values()) + 1, sum(mid.values()) + 1
        cs, cm = Counter(), Counter()
        for w in s.keys() | mid.keys():
            c = word_class(w)
            cs[c] += s[w]
            cm[c] += mid[w]
        out = {c: math.log((cs[c] + 0.5) / ns) - math.log((cm[c] + 0.5) / nm) for c in cs.keys() | cm.keys()}
        for w in s.keys() | mid.keys():
            n = s[w] + mid[w]
            if n >= KEEP_LEAST:
                c = word_class(w)
                # Shrunk towards the class by the weight of four occurrences.
                ps = (s[w] + 4 * cs[c] / max(1, cs[c] + cm[c])) / ns
                pm = (mid[w] + 4 * cm[c] / max(1, cs[c] + cm[c])) / nm
                out[w] = math.log(max(ps, 1e-9)) - math.log(max(pm, 1e-9))
        return out

    def guess(self, text: str) -> str:
        """The Latin-script language whose frequent words explain the text best."""
        best, score = "", -1e18
        low = [norm_word(x, "") for x in text.split()]
        for lang, words in self.words.items():
            if lang and lang not in UNCASED:
                v = sum(words.get(w, -12.0) for w in low)
                if v > score:
                    best, score = lang, v
        return best

    def starts(self, lang: str, word: str, shout: bool = False) -> float:
        r = (self.folded if shout else self.start).get(lang)
        if r is None:
            return {"*Aa": 2.0, "*AA": 0.5, "*aa": -6.0, "*9": -2.0}.get(word_class(word), 0.0)
        w = word.lower() if shout else word
        v = r.get(w)
        return v if v is not None else r.get(word_class(w), 0.0)

    def opens(self, chunk: str) -> bool:
        """Whether a chunk after a space opens a sentence where spaces end them: it, or else its head, is known from line heads."""
        r = self.start.get("th", {})
        v = r.get(chunk)
        return (v if v is not None else r.get("^" + chunk[:4], -9.0)) > -1.0

    def ends(self, lang: str, t: str) -> float:
        f = self.final.get(lang)
        if f is None:
            return 0.02 if dot_class(t) == "*1" else 0.7
        v = f.get(t)
        return v if v is not None else f.get(dot_class(t), 0.7)


def cut(p: str, lang: str, model: Model) -> list[int]:
    """Ends of the sentences in one paragraph (the paragraph's end not among them)."""
    if " | " in p:
        return []
    if lang == "th":
        return [m.start() for m in re.finditer(r"[ \t\n]+(?=(\S+))", p) if model.opens(norm_word(m[1], "th")) and not _ITEM.fullmatch(p[: m.end()])]
    item = _ITEM.match(p)
    at = item.end() if item else 0
    out, begin, size = [], at, len(p)
    shout = lang not in UNCASED and p.isupper()
    cased = lang not in UNCASED and not shout

    def after(i: int) -> tuple[int, str, bool]:
        """Position and text of the next token, and whether white space comes before it."""
        m = _NEXT.match(p, i)
        j = m.start(1)
        return j, m[1] if lang not in SPACELESS else p[j : j + 3], j > i

    mark = _MARK.search(p, at)
    while mark:
        i = mark.end()
        if mark[0] == "." and p[i : i + 1].isdigit():
            mark = _MARK.search(p, i)
            continue
        m = _TOKEN.match(p, mark.start())
        if m is None:
            mark = _MARK.search(p, i)
            continue
        i = m.end()
        mark = _MARK.search(p, i)
        kind = m.lastgroup
        if kind == "span":
            inner = p[m.start() + 1 : i - 1].rstrip()
            if not inner or inner[-1] not in HARD + "." + ELLIPSIS:
                continue
            j, tok, gap = after(i)
            if j >= size:
                continue
            first = not p[begin : m.start()].strip()
            w = norm_word(tok, lang)
            round_ = p[m.start()] in "(（["
            if round_ and not first:
                continue
            if tok[0] in ",;:،؛、，；：.।。»)":
                continue
            if cased:
                end = not w[:1].islower() and not (w[:1].isdigit() and not first)
            elif round_:
                end = gap or lang in SPACELESS
            elif first:
                # Followed up by its sentence, unless what comes next opens a sentence or a quotation.
                end = tok[0] in "\"“«「„" or (gap and model.starts(lang, w, shout) > 1.5)
            else:
                end = tok[0] in "\"“«「„" or model.starts(lang, w, shout) > 0
            if end:
                out.append(i)
                begin = i
            continue
        while i < size and p[i] in CLOSERS and p[i] not in "\"'":
            i += 1
        j, tok, gap = after(i)
        if j >= size:
            continue
        w = norm_word(tok, lang)
        if kind == "hard":
            wide = m[0][-1] in "。！？।॥"
            if not (gap or wide) and (i > m.end() or not w or w[:1].islower() or model.starts(lang, w, shout) <= 0.5):
                continue
            if cased and w[:1].islower():
                continue
            end = True
        elif kind == "dots":
            if not gap and lang not in SPACELESS:
                continue
            end = (not cased or not w[:1].islower()) and model.starts(lang, w, shout) > (0.7 if cased or shout else 0)
        else:
            k = m.start()
            if not gap:
                # A forgotten blank: a plain word, then a word that opens sentences.
                x = re.match(r"[^\W\d_]+", tok)
                y = re.search(r"(?<![\w./@-])([^\W\d_]\S+|\d+)$", p[max(begin, k - 30) : k])
                if not (x and y and "." not in y[0] and "@" not in y[0] and "/" not in y[0]) or cased and not x[0].istitle():
                    continue
                if shout or model.starts(lang, x[0]) <= 0.5 or model.ends(lang, norm_dot(y[0])) < 0.3:
                    continue
                out.append(i)
                begin = i
                continue
            while k > begin and not p[k - 1].isspace():
                k -= 1
            t = norm_dot(p[k : m.start()])
            if not t:
                end = p[m.start() - 1 : m.start()] in CLOSERS and p[m.start() - 1 : m.start()] != ""
                end = end and (not cased or not w[:1].islower())
            else:
                if t[-1] in CLOSERS:
                    f = 0.97
                else:
                    f = model.ends(lang, t)
                if cased and w[:1].islower():
                    end = False
                elif t + " " + w in model.bound.get(lang, ()):
                    end = False
                else:
                    end = math.log(f / (1 - f)) + model.starts(lang, w, shout) > 0
        if end:
            out.append(i)
            begin = i
    return out


def units(text: str, label: str | None, model: Model) -> list[tuple[int, int]]:
    """(start, end) of every unit of a text, in code points, without white space around it."""
    if not text or not text.strip():
        return []
    latin = language(label)
    out = []
    for a, b in paragraphs(text):
        p = text[a:b]
        lang = script(p, latin)
        if not lang:
            lang = latin = model.guess(text)
        last = 0
        for e in [*cut(p, lang, model), len(p)]:
            piece = p[last:e]
            left = len(piece) - len(piece.lstrip())
            body = len(piece.strip())
            if body:
                out.append((a + last + left, a + last + left + body))
            last = e
    return out


#: Counters are sent on when they hold this many types, so that a task's memory is bounded.
FLUSH = 400_000


def statistics(documents: DataFrame) -> DataFrame:
    """(lang, kind, typ, n): the counts of all documents, combined in each task before the one shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: dict[tuple[str, str], Counter] = defaultdict(Counter)

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, kind), types in c.items():
                n = len(types)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * n, pa.string()), pa.array([kind] * n, pa.string()), pa.array(list(types), pa.string()), pa.array(list(types.values()), pa.int64())],
                    ["lang", "kind", "typ", "n"],
                )
            c.clear()

        for b in batches:
            count(b.column(0).to_pylist(), b.column(1).to_pylist(), c)
            if sum(map(len, c.values())) > FLUSH:
                yield from out()
        yield from out()

    rows = documents.select("text", "lang").where("text is not null").mapInArrow(run, "lang string, kind string, typ string, n long")
    return rows.groupBy("lang", "kind", "typ").agg(F.sum("n").alias("n"))


def learn(documents: DataFrame) -> Model:
    """The model of all documents. Only types with a fixed least share of their language and kind leave
    the cluster, which bounds the model whatever the corpus; the rest reach it as totals by class."""
    from ledgerloom.session import checkpointed

    s = checkpointed(statistics(documents))
    total = s.groupBy("lang", "kind").agg(F.sum("n").alias("total"))
    big = s.join(F.broadcast(total), ["lang", "kind"])
    kept = F.col("n") >= F.greatest(F.lit(KEEP_LEAST), F.col("total") * KEEP_SHARE)
    rare = {
        "word": F.when(F.col("typ").rlike(r"^\P{L}*\d"), "9").when(F.col("typ").rlike(r"^\P{L}*\p{Lu}{2}"), "ZQ").when(F.col("typ").rlike(r"^\P{L}*\p{Lu}"), "Zq").when(F.col("typ").rlike(r"^\P{L}*\p{Ll}"), "zq").when(F.col("typ").rlike(r"\p{L}"), "ʬ").otherwise("~"),
    }
    dotty = F.col("kind").isin("d", "e")
    dot = F.when(F.col("typ").rlike(r"\d$"), "9x9").when(F.col("typ").contains("."), "z.q").when(F.length("typ") <= 3, "zqz").otherwise("zqzqzq")
    typ = F.when(kept, F.col("typ")).when(F.col("kind") == "c", F.lit(None)).when(dotty, dot).otherwise(rare["word"])
    rows = big.select("lang", "kind", typ.alias("typ"), "n").where("typ is not null").groupBy("lang", "kind", "typ").agg(F.sum("n").alias("n"))
    return Model([tuple(r) for r in rows.toPandas().itertuples(index=False)])


def sentence_units(documents: DataFrame) -> DataFrame:
    """p10_found: (doc_id, unit_start, unit_end), one row per sentence, heading, item, row or signature line.

    The statistics are learned from all documents without supervision, in one pass with one small
    shuffle; the texts are then read once more and cut, without any shuffle. Nothing depends on
    sources or sizes of groups. See Model for what is learned and cut for the classification.

    Defined results: null, empty and blank texts have no unit; a text without any mark is one unit
    a line; repeated rows give repeated units once.
    """
    model = learn(documents)
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in batches:
            d, s, e = [], [], []
            for doc, text, label in zip(*(b.column(i).to_pylist() for i in range(3))):
                seen = set()
                for x in units(text, label, m):
                    if x not in seen:
                        seen.add(x)
                        d.append(doc)
                        s.append(x[0])
                        e.append(x[1])
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(s, pa.int32()), pa.array(e, pa.int32())], ["doc_id", "unit_start", "unit_end"])

    return documents.select("doc_id", "text", "lang").where("doc_id is not null and text is not null").mapInArrow(run, "doc_id long, unit_start int, unit_end int")
