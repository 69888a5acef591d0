"""Holders named differently in registers and address books: the p2 operator."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import names
from ledgerloom.llm.addresses import fold, parse
from ledgerloom.llm.components import hash_to_min
from ledgerloom.llm.linkage import average_linkage
from ledgerloom.session import checkpointed

#: Most alias rows that are sent to the tasks; the list of short names is a small fixed table, and this is checked.
ALIAS_BOUND = 200_000

_NOT_DIGIT = re.compile(r"\D+")


def _number(kind: str, value: str) -> int:
    return int.from_bytes(blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "big", signed=True)


def _spread(number: int, kind: int) -> int:
    """A number below 2^61 times an odd one: still one for each, but its upper bits differ."""
    return (number * 0x9E3779B97F4A7C15 & (1 << 61) - 1) << 2 | kind


#: Bits of an address number that tell its place (with all else) and kind; those above, house or flat and street alone.
PLACE = 34


@lru_cache(maxsize=100_000)
def _place(word: str) -> int:
    return _number("w", word) & (1 << PLACE) - 1


def evidence(address: str | None, demat: str | None, phone: str | None, mail: str | None) -> list[int]:
    """Numbers of what else tells a holder: demat client part, telephone, mail, and house or flat with street and place.

    The street counts by its head; each of postcode, locality and city makes a number of its own, so
    that one that is missing or mistyped leaves the others. The lowest two bits tell the kind: 0
    demat, 1 telephone or mail, 2 address. Address numbers of one house or flat and street are alike
    above their lowest PLACE bits.
    """
    out = []
    if demat:
        d = _NOT_DIGIT.sub("", demat)
        if len(d) >= 8:
            out.append(_spread(int(d[-8:]), 0))
    if phone:
        d = _NOT_DIGIT.sub("", phone)
        if len(d) >= 10:
            out.append(_spread(int(d[-10:]), 1))
    if mail and "@" in mail:
        out.append(_number("m", mail.strip().lower()) & ~3 | 1)
    p = parse(address)
    if p and p[3] and (p[0] or p[1]):
        at = _number("a", f"{p[0] or 'n' + p[1]}|{p[3][:5]}")
        places = {_place(w) for w in p[6].split()}
        if p[5] or not places:
            places.add(_place(p[5]))
        out += [(at ^ x) & ~3 | 2 for x in places]
    return out


# The forms of folios, companies and demat numbers of functions/registers.py (a test compares them): as expressions
# they would be computed anew in each scan, which cost more than all else here that runs in the JVM.
_NOT_FOLIO, _NOT_DEMAT = re.compile(r"[^A-Z0-9]+"), re.compile(r"[^0-9]+")
_FOLIO_LABEL = re.compile(r"(FOLIO(NO)?|(NA|NIL|NONE|NULL)\Z)")
_O_AMONG_DIGITS = re.compile(r"[0-9O]*[0-9][0-9O]*\Z")
_TRAILING_O = re.compile(r"O+\Z")
_PADDED = re.compile(r"([A-Z]*)0+(?=[0-9]+\Z)")


def folio_form(folio: str | None) -> str | None:
    if folio is None:
        return None
    s = _NOT_FOLIO.sub("", folio.upper())
    if s[:1] in ("F", "N") and (m := _FOLIO_LABEL.match(s)):
        s = s[m.end() :]
    if "O" in s and (m := _O_AMONG_DIGITS.search(s)):
        # Of the last digit's followers the first nine.
        end = _TRAILING_O.search(s)
        cut = len(s) if end is None else min(end.start() + 9, len(s))
        s = s[: m.start()] + s[m.start() : cut].replace("O", "0") + s[cut:]
    if "0" in s and (m := _PADDED.match(s)):
        s = m[1] + s[m.end() :]
    return s or None


@lru_cache(maxsize=100_000)
def company_form(company: str | None) -> str:
    if company is None:
        return ""
    s = re.sub(r"\([^)]*\)", " ", company.lower())
    s = re.sub(r"[\W_]+", " ", s).strip(" ")
    return re.sub(r"( (private|pvt|co|company|limited|ltd|lmtd))+\Z", "", s)


@lru_cache(maxsize=100_000)
def _company(company: str | None) -> tuple[str, int]:
    co = company_form(company)
    return co, _number("c", co) >> 27 << 27


def account(row: int, company: str | None, folio: str | None, demat: str | None) -> tuple[int, int | None, int | None, bool]:
    """(node, client, full, lack) of a line: its account, company with client part and with all digits of its demat number, and whether it has no folio.

    The node of a line without a folio holds as long as no line with a folio shows its demat number.
    """
    co, high = _company(company)
    d = _NOT_DEMAT.sub("", demat) if demat else ""
    client = full = None
    if len(d) >= 8:
        client, full = high | int(d[-8:]), _number("u", f"{co}|{d}")
    f = folio_form(folio)
    own = f"f:{f}" if f else f"d:{d[-8:]}" if client is not None else f"r:{row}"
    return _number("n", f"{co}|{own}") | 1, client, full, f is None


def described(df: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    """(node, row, name, keys, client, full, lack): rows with their account and the key of their name (null where there is none).

    cols are name, address, demat number, telephone and mail and, where rows are lines, company and
    folio; other rows have a node, whose last bit, which tells accounts, is 0. keys are the numbers of the
    blocks the row stands in: its pieces of evidence and, kind 3, the triples of whole words of its name.
    """
    c = [F.col(x).cast("string").alias(f"__{i}") for i, x in enumerate(cols)]
    lines = len(cols) == 7

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = [b.column(i).to_pylist() for i in range(b.num_columns)]
            name, keys, ends = [], [], [0]
            for x, address, demat, phone, mail in zip(*v[1:6]):
                k = (names.key(x) or None) if x else None
                name.append(k)
                keys += evidence(address, demat, phone, mail)
                if k:
                    keys += [_number("t", t) | 3 for t in names.triples(k)]
                ends.append(len(keys))
            if lines:
                acc = list(zip(*map(account, v[0], v[6], v[7], v[3])))
            else:
                none = [None] * b.num_rows
                acc = [[_number("o", str(x)) & ~1 for x in v[0]], none, none, [False] * b.num_rows]
            node, client, full, lack = (pa.array(x, t) for x, t in zip(acc or ([],) * 4, (pa.int64(), pa.int64(), pa.int64(), pa.bool_())))
            cut = [node, b.column(0), pa.array(name, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys, pa.int64())), client, full, lack]
            yield pa.RecordBatch.from_arrays(cut, ["node", "row", "name", "keys", "client", "full", "lack"])

    return df.select(F.col("id").cast("long").alias("row"), *c).mapInArrow(run, "node long, row long, name string, keys array<long>, client long, full long, lack boolean")


def settled(rows: DataFrame) -> DataFrame:
    """(node, row, name, keys) of described rows: lines without a folio in the account that their demat number shows.

    As survivors.account_lines: first by all digits, else by the client part where that shows one account only.
    """
    lack = rows.where("lack and client is not null")
    shown = rows.where("not lack and client is not null").join(lack.select("client").distinct(), "client", "left_semi")
    shown = checkpointed(shown.select("node", "client", "full"))

    def lookup(key: str, name: str) -> DataFrame:
        return shown.groupBy(key).agg(F.min("node").alias(name), F.max("node").alias("b")).where(f"{name} = b").drop("b")

    cols = ["row", "name", "keys"]
    found = lack.join(lookup("full", "by_full"), "full", "left").join(lookup("client", "by_client"), "client", "left")
    found = checkpointed(found.select(F.coalesce("by_full", "by_client", "node").alias("node"), *cols))
    return rows.where("not lack or client is null").select("node", *cols).unionByName(found)


def alias_map(aliases: DataFrame) -> dict[str, frozenset[str]]:
    rows = aliases.select("alias_name", "given_name").where("alias_name is not null and given_name is not null").distinct().limit(ALIAS_BOUND + 1).collect()
    if len(rows) > ALIAS_BOUND:
        raise ValueError(f"more than {ALIAS_BOUND} short names")
    out: dict[str, set[str]] = {}
    for a, g in rows:
        out.setdefault(fold(a.lower()), set()).add(fold(g.lower()))
    return {a: frozenset(g) for a, g in out.items()}


def vectors(spellings: DataFrame, aliases: dict[str, frozenset[str]]) -> names.Vectors:
    """Document frequencies of the hashed n-grams of all spellings (names, parted by bars) of all nodes: at most names.FEATURES numbers."""
    held = spellings.sparkSession.sparkContext.broadcast(aliases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter[int] = Counter()
        n = 0
        for b in batches:
            for ks in b.column(0).to_pylist():
                for k in ks.split("|"):
                    n += 1
                    df.update(names.grams(k, held.value).keys())
        df[-1] = n
        yield pa.RecordBatch.from_arrays([pa.array(list(df), pa.int64()), pa.array(list(df.values()), pa.int64())], ["f", "n"])

    rows = spellings.select("names").mapInArrow(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).collect()
    df = {r[0]: r[1] for r in rows}
    return names.Vectors(df.pop(-1, 0), df, aliases)


#: Members of a block that one task joins at once; up to FEW names are compared without an index.
HELD, FEW = 2_000, 8


def cosine_links(members: DataFrame, v: names.Vectors, held: int = HELD) -> DataFrame:
    """(i, j): pairs of members (k, node, names) of a block k whose names have a cosine of at least names.LEAST of its kind.

    Sparse cosine join, spread by block: a task lays out a block's vectors as an inverted index of
    their rarest n-grams (as many as the least cosine needs, so that none is missed) and streams the
    members past it; only links come out, never candidates. The kind of a block (the lowest two bits
    of k) is the evidence both share: it sets the least cosine and, at one address, where relatives
    live, words that contradict each other veto a cosine below names.SURE. The top n of a node
    are its first n links by cosine; n is unlimited here, as no link may be lost.

    Blocks with more than held members are joined with the same result by block and n-gram, in parts
    of held members; their members of equal names are linked to one of them, not to each other.
    """
    sent = members.sparkSession.sparkContext.broadcast(v)
    members = members.select("k", "node", F.array_join("names", "|").alias("names") if dict(members.dtypes)["names"] != "string" else "names")

    def link(m: names.Vectors, k: int, a: str, b: str, x: dict[int, float], y: dict[int, float]) -> bool:
        c = names.dot(x, y)
        if c < names.LEAST[k & 3]:
            return False
        # In one order, whichever comes first: the agreement of two names is not the same both ways.
        return k & 3 != 2 or c >= names.SURE or any(names.compatible(max(p, q), min(p, q), m.aliases) > 0 for p in a.split("|") for q in b.split("|"))

    def ends(i: list[int], j: list[int]) -> pa.RecordBatch:
        done = pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(j, pa.int64())], ["i", "j"])
        i.clear()
        j.clear()
        return done

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        i, j = [], []
        # Blocks of one house or flat and street follow each other: what two names are to each other is found once for all its places.
        at, known = None, {}

        def judged(k: int, a: str, b: str, x: dict[int, float], y: dict[int, float]) -> bool:
            if k & 3 != 2:
                return link(m, k, a, b, x, y)
            pair = (a, b) if a < b else (b, a)
            yes = known.get(pair)
            if yes is None:
                if len(known) > 100_000:
                    known.clear()
                yes = known[pair] = link(m, k, a, b, x, y)
            return yes

        def out(k: int, group: list[tuple[int, str]]) -> None:
            least = names.LEAST[k & 3]
            same: dict[str, int] = {}
            for node, ns in group:
                first = same.setdefault(ns, node)
                if first != node:
                    # One spelling has the cosine 1 with itself, the mean of several one that may be too low.
                    x = m.joined(ns) if "|" in ns else None
                    if x is None or judged(k, ns, ns, x, x):
                        i.append(first)
                        j.append(node)
            if len(same) < 2:
                return
            reps = [(node, ns, m.joined(ns)) for ns, node in same.items()]
            if len(reps) <= FEW:
                for n, (node, ns, x) in enumerate(reps):
                    for other, os, y in reps[:n]:
                        if judged(k, ns, os, x, y):
                            i.append(other)
                            j.append(node)
                return
            post: dict[int, list[tuple]] = {}
            for entry in reps:
                node, ns, x = entry
                head = m.prefix(x, least)
                met: set[int] = set()
                for g in head:
                    for other, os, y in post.get(g, ()):
                        if other not in met:
                            met.add(other)
                            if judged(k, ns, os, x, y):
                                i.append(other)
                                j.append(node)
                for g in head:
                    post.setdefault(g, []).append(entry)

        now, group = None, []
        for b in batches:
            for k, *rest in zip(*(b.column(c).to_pylist() for c in range(3))):
                if k != now:
                    if len(group) > 1:
                        if now >> PLACE != at:
                            at = now >> PLACE
                            known.clear()
                        out(now, group)
                    now, group = k, []
                group.append(rest)
            yield ends(i, j)
        if len(group) > 1:
            known.clear()
            out(now, group)
        yield ends(i, j)

    def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        i, j = [], []

        def out(now: tuple, group: list[tuple[int, int, str]]) -> None:
            k, f, p, q = now
            post: list[tuple] = []
            for own, node, ns in group:
                x = m.joined(ns)
                head = m.prefix(x, names.LEAST[k & 3])
                for other in post:
                    # A pair is judged under its first common n-gram only.
                    if (p == q or other[0] != own) and next(h for h in head if h in other[4]) == f and link(m, k, ns, other[2], x, other[3]):
                        i.append(other[1])
                        j.append(node)
                post.append((own, node, ns, x, set(head)))

        now, group = None, []
        for b in batches:
            for k, f, p, q, *rest in zip(*(b.column(c).to_pylist() for c in range(7))):
                if (k, f, p, q) != now:
                    if len(group) > 1:
                        out(now, group)
                    now, group = (k, f, p, q), []
                group.append(tuple(rest))
            yield ends(i, j)
        if len(group) > 1:
            out(now, group)
        yield ends(i, j)

    # Blocks alike above their lowest PLACE bits go to one task, unless these are many; only among those a block can be hot.
    at = F.shiftright("k", PLACE)
    near = lambda df, by: df.repartition(by).sortWithinPartitions("k", "node").mapInArrow(whole, "i long, j long")
    busy = checkpointed(members.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > held).select("at"))
    if busy.isEmpty():
        return near(members, at)
    calm = near(members.join(busy, at == busy["at"], "left_anti").select("k", "node", "names"), at)
    members = checkpointed(members.join(busy, at == busy["at"], "left_semi").select("k", "node", "names"))
    hot = checkpointed(members.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > held).select("k"))
    few = calm.unionByName(near(members.join(hot, "k", "left_anti").select("k", "node", "names"), F.col("k")))
    if hot.isEmpty():
        return few
    many = members.join(hot, "k", "left_semi")
    one = checkpointed(many.groupBy("k", "names").agg(F.min("node").alias("one")))

    def prefixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            f = [m.prefix(m.joined(ns), names.LEAST[k & 3]) for k, ns in zip(b.column(0).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(f, pa.list_(pa.int64()))], ["k", "node", "names", "fs"])

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            keep = []
            for k, ns in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                x = m.joined(ns)
                keep.append(names.dot(x, x) >= names.LEAST[k & 3])
            yield b.select(["i", "j"]).filter(pa.array(keep, pa.bool_()))

    grams = one.select("k", F.col("one").alias("node"), "names").mapInArrow(prefixed, "k long, node long, names string, fs array<long>")
    grams = checkpointed(grams.select("k", F.explode("fs").alias("f"), "node", "names"))
    parts = grams.groupBy("k", "f").agg(F.ceil(F.count(F.lit(1)) / held).cast("int").alias("n")).where(F.col("n") >= 1)
    cut = grams.join(parts, ["k", "f"]).withColumn("own", F.pmod(F.xxhash64("node"), "n").cast("int"))
    cut = cut.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select("k", "f", F.least("own", "x").alias("p"), F.greatest("own", "x").alias("q"), "own", "node", "names")
    star = many.join(one, ["k", "names"]).where("node <> one").select(F.col("one").alias("i"), F.col("node").alias("j"), "k", "names").mapInArrow(alike, "i long, j long")
    cut = cut.repartition("k", "f", "p", "q").sortWithinPartitions("k", "f", "p", "q", "node").mapInArrow(parts_of, "i long, j long")
    return few.unionByName(cut).unionByName(star)


def same_holders(lines: DataFrame, contacts: DataFrame, aliases: DataFrame) -> DataFrame:
    """p2_found: (shareholder_row, contact_id) of rows whose names mean the same person or organisation.

    Nodes are accounts (the lines of one folio, whose holder is one) and contacts, with the mean of
    the character n-gram vectors of their spellings. A sparse cosine join in blocks (cosine_links)
    links them: at a low cosine where a demat number, telephone or mail is shared, so that initials
    and short names are found, at a higher one at the same house or flat, and at a high one where
    only the name speaks, in blocks of three whole words. Inside a connected group
    average-linkage clustering by all pairs of names, compared in a block or not, forms the
    holders, so that relatives who share an initialled spelling stay apart. No rule depends
    on the size of the tables.

    Of an account its different spellings are held together in one task, not its lines.

    Defined results: rows without a name are in no pair, but their other fields tell their account;
    repeated rows count once; columns but the needed ones are ignored.
    """
    need = ["id", "folio_no", "company_name", "demat_account", "full_name", "address", "mobile_number", "email_id"]
    # City and postcode columns, where there are any, are part of a line's address.
    more = [c for c in ("city", "pincode") if c in lines.columns]
    src = lines.where("id is not null").select(*[c for c in need if c != "address"], F.when(F.col("address").isNotNull(), F.concat_ws(", ", "address", *more)).alias("address"))
    con = contacts.where("id is not null and name is not null")
    rows = described(src, ("full_name", "address", "demat_account", "mobile_number", "email_id", "company_name", "folio_no"))
    rows = checkpointed(rows.unionByName(described(con, ("name", "address", "demat_no", "contact", "email"))))
    rows = settled(rows)
    nodes = rows.groupBy("node").agg(F.array_join(F.sort_array(F.collect_set("name")), "|").alias("names"), F.array_distinct(F.flatten(F.collect_set("keys"))).alias("keys"))
    nodes = checkpointed(nodes.where("names <> ''"))
    v = vectors(nodes.select("names"), alias_map(aliases))
    links = cosine_links(nodes.select(F.explode("keys").alias("k"), "node", "names"), v)
    group = hash_to_min(links, "i", "j").select(F.col("record_key").alias("node"), F.col("group_key").alias("c"))
    sent = lines.sparkSession.sparkContext.broadcast(v)
    members = group.join(nodes.select("node", "names"), "node")
    # The last bit of a node tells accounts (1) from contacts (0); a group of one side has no pairs.
    mixed = lambda ns: len({n & 1 for n in ns}) == 2
    label = average_linkage(members, lambda ns: sent.value.joined(ns), names.MERGE, wanted=mixed)
    # A row counts once in its node.
    named = rows.where("name is not null").select("node", "row").repartition("node").join(checkpointed(label), "node").distinct()
    side = F.col("node").bitwiseAND(F.lit(1))
    have = named.where(side == 1).select("cluster", F.col("row").alias("shareholder_row"))
    want = named.where(side == 0).select("cluster", F.col("row").alias("contact_id"))
    # A row has one node and a node one cluster, so no pair comes twice.
    return have.join(want, "cluster").select("shareholder_row", "contact_id")
