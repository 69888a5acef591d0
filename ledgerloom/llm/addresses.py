"""Same postal address written differently: typed components, deletion-neighbourhood blocks, optimal assignment."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import checkpointed, release

# How the parts of an address are introduced or ended.
UNIT = {"flat", "flt", "apt", "unit"}
HOUSE = {"house", "h", "door", "plot", "d", "p"}
LANDMARK = {"near", "nr", "opp", "opposite", "behind", "beside", "bh"}
STREET = {
    "road": "road", "rd": "road", "raod": "road", "marg": "marg", "mg": "marg", "lane": "lane", "ln": "lane", "la": "lane",
    "gali": "gali", "galli": "gali", "gl": "gali", "street": "street", "st": "street", "str": "street",
    "avenue": "avenue", "ave": "avenue", "av": "avenue", "avn": "avenue",
}
STREET_HEAD = {"cross": "cross ", "cr": "cross ", "x": "cross ", "main": "main ", "mn": "main ", "m": "main "}
BUILDING = {
    "residency", "resi", "resdy", "heights", "hgts", "hts", "bhavan", "bhawan", "bhvn", "niwas", "nivas", "niw", "kunj", "kunja",
    "tower", "towers", "twrs", "apartments", "apartment", "apts", "aptmts", "enclave", "encl", "enclv",
}
FILLER = re.compile(r"\s*(-*|n\.?a\.?|nil|none|null|not (available|known)|same as above|unknown)\s*", re.I)

#: Words of letters that do not stand for themselves alone.
_TERMS = UNIT | HOUSE | LANDMARK | set(STREET) | set(STREET_HEAD) | BUILDING | {"f", "no", "pin", "pincode", "pinkode"}

# What most tokens are, words of two letters or more, is tried first.
_TOKEN = re.compile(r"[a-z]{2,}|\d{6}(?!\d)|\d{3} \d{3}(?!\d)|[a-z]-?\d{1,4}(?![a-z\d])|\d+[a-z]?(?![a-z])|\d+|[a-z]+|#")
_PIN = re.compile(r"\d{6}|\d{3} \d{3}")
_UNIT = re.compile(r"[a-z]?-?\d{1,4}[a-z]?")

_FOLD = ((re.compile(r"([a-z])\1+"), r"\1"),)


@lru_cache(maxsize=200_000)
def fold(word: str) -> str:
    """Spelling by sound: long vowels short, w as v, z as j, c as k, y as i, no doubled letters."""
    w = word.replace("ee", "i").replace("oo", "u").replace("w", "v").replace("z", "j").replace("y", "i").replace("ph", "f")
    w = w.replace("ch", "\1").replace("ck", "k").replace("c", "k").replace("\1", "ch")
    for rx, to in _FOLD:
        w = rx.sub(to, w)
    return w


def parse(address: str | None) -> tuple[str, str, str, str, str, str, str] | None:
    """(unit, number, building, street, street kind, pin, rest) of an address; None for blanks and fillers.

    Names are folded by sound; rest are the words left over (locality, city, state), sorted.
    """
    if address is None or FILLER.fullmatch(address):
        return None
    t = _TOKEN.findall(" ".join(address.lower().split()))
    unit = number = building = street = kind = pin = ""
    rest: list[str] = []
    i, n = 0, len(t)
    while i < n:
        w = t[i]
        c = w[0]
        if "a" <= c <= "z" and "a" <= w[-1] <= "z" and w not in _TERMS:
            if len(w) > 2:
                rest.append(fold(w))
        elif c.isdigit():
            if len(w) >= 6 and _PIN.fullmatch(w):
                pin = w.replace(" ", "")
            elif not number and w.isdigit() and len(w) <= 5:
                number = w.lstrip("0") or "0"
        elif w == "#":
            if i + 1 < n and t[i + 1][0].isdigit() and len(t[i + 1]) < 6:
                i += 1
                number = t[i].lstrip("0")
        elif len(w) > 1 and w[-1].isdigit() or len(w) == 2 and w[1].isdigit():
            unit = unit or w.replace("-", "")
        elif w == "apt" and unit and rest and not building:
            building = rest.pop()
        elif w in UNIT or (w == "f" and i + 1 < n and t[i + 1] == "no"):
            j = i + 1
            while j < n and t[j] in ("no", "number"):
                j += 1
            if j < n and len(t[j]) == 7 and t[j][3] == " ":
                # Not a postcode in two halves but flat and house.
                t[j : j + 1] = t[j].split(" ")
                n += 1
            if j < n and _UNIT.fullmatch(t[j]) and len(t[j]) < 6:
                unit = t[j].replace("-", "")
                i = j
        elif w == "no" or (w in HOUSE and i + 1 < n and t[i + 1] == "no"):
            j = i + 1
            while j < n and t[j] in ("no", "number"):
                j += 1
            if j < n and t[j][0].isdigit() and len(t[j]) < 6:
                number = t[j].lstrip("0")
                i = j
            elif j < n and len(t[j]) > 1 and t[j][-1].isdigit():
                unit = unit or t[j].replace("-", "")
                i = j
        elif w in LANDMARK:
            j = i
            while j + 1 < n and j - i < 2 and t[j + 1][0].isalpha() and t[j + 1] not in STREET:
                j += 1
            i = j
        elif w in STREET or (w in STREET_HEAD and i + 1 < n and t[i + 1] in STREET):
            head = ""
            if w in STREET_HEAD:
                head, i = STREET_HEAD[w], i + 1
                w = t[i]
            if rest and not street:
                street, kind = rest.pop(), head + STREET[w]
        elif w in BUILDING:
            if rest and not building:
                building = rest.pop()
        elif w in ("pin", "pincode", "pinkode"):
            pass
        elif len(w) > 2:
            rest.append(fold(w))
        i += 1
    if not street and number and rest and not unit:
        street = rest.pop(0)
    return unit, number, building, street, kind, pin, " ".join(sorted(set(rest)))


FIELDS = ("unit", "number", "building", "street", "kind", "pin", "rest")


def parsed(df: DataFrame, address: str = "address", keep: tuple[str, ...] = ("id",), extra: tuple[str, ...] = ()) -> DataFrame:
    """keep columns, aid (a number that is the same for the same components) and parts (the components between bars).

    extra names further text columns (city, postcode) whose words count as part of the address.
    Rows without a readable address are left out.
    """
    src = df.select(*keep, F.col(address).cast("string").alias("__a"), F.concat_ws(" ", *[F.col(x) for x in extra]).alias("__x"))
    src = src.where("__a is not null")
    schema = src.select(*keep).schema.add("aid", "long").add("parts", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        for b in batches:
            n = b.num_columns
            rows, aids, parts = [], [], []
            for k, (a, x) in enumerate(zip(b.column(n - 2).to_pylist(), b.column(n - 1).to_pylist())):
                p = parse(a)
                if p is None or not (p[3] or p[2]):
                    continue
                if x:
                    pin = p[5]
                    words = set(p[6].split())
                    for w in _TOKEN.findall(x.lower()):
                        if w[0].isdigit():
                            pin = pin or (w.replace(" ", "") if _PIN.fullmatch(w) else "")
                        elif len(w) > 2:
                            words.add(fold(w))
                    p = (*p[:5], pin, " ".join(sorted(words)))
                packed = "|".join(p)
                rows.append(k)
                aids.append(int.from_bytes(blake2b(packed.encode(), digest_size=8).digest(), "big", signed=True))
                parts.append(packed)
            kept = b.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(kept.column(j) for j in range(n - 2)), pa.array(aids, pa.int64()), pa.array(parts, pa.string())], [*(b.schema.names[: n - 2]), "aid", "parts"]
            )

    return src.mapInArrow(run, schema)


def part(name: str) -> Column:
    return F.element_at(F.split("parts", r"\|"), FIELDS.index(name) + 1)


def within(a: str, b: str, most: int) -> bool:
    """Whether two words are within so many insertions, deletions, replacements or swaps of neighbours."""
    if a == b:
        return True
    la, lb = len(a), len(b)
    if abs(la - lb) > most:
        return False
    before, row = None, list(range(lb + 1))
    for i in range(1, la + 1):
        new = [i] + [0] * lb
        ca = a[i - 1]
        low = i
        for j in range(1, lb + 1):
            v = row[j - 1] if ca == b[j - 1] else 1 + min(row[j - 1], row[j], new[j - 1])
            if before is not None and j > 1 and ca == b[j - 2] and a[i - 2] == b[j - 1]:
                v = min(v, before[j - 2] + 1)
            new[j] = v
            low = min(low, v)
        if low > most:
            return False
        before, row = row, new
    return row[lb] <= most


def alike(a: str, b: str) -> bool:
    """Whether two folded names are one name but for typing slips: one edit, two from eight letters on."""
    return within(a, b, 2 if min(len(a), len(b)) >= 8 else 1 if min(len(a), len(b)) >= 4 else 0)


def assignment(a: list[str], b: list[str]) -> int:
    """Most words of a that can be given each its own alike word of b (optimal assignment by augmenting paths)."""
    of: dict[int, int] = {}

    def give(i: int, seen: set[int]) -> bool:
        for j in range(len(b)):
            if j not in seen and alike(a[i], b[j]):
                seen.add(j)
                if j not in of or give(of[j], seen):
                    of[j] = i
                    return True
        return False

    return sum(give(i, set()) for i in range(len(a)))


def same_place(x: tuple, y: tuple, states: frozenset[str] = frozenset(), street_known: bool = True) -> bool:
    """Decides on two parsed addresses by (unit, number, building, street, kind, pin, rest).

    Hard vetoes: a unit against another or against none; two different house numbers; a house
    without a number on either side. Then the named parts are assigned: streets must be alike, a
    missing house number must be made good by the building, and the place must agree: equal pins,
    or a shared locality or city where a pin is missing or mistyped.
    """
    ux, nx, bx, sx, kx, px, rx = x
    uy, ny, by, sy, ky, py, ry = y
    if ux != uy:
        return False
    if nx and ny and nx != ny:
        return False
    if not ux and not (nx and ny):
        return False
    building = bool(bx and by) and alike(bx, by)
    if sx and sy:
        if not alike(sx, sy):
            return False
        if kx and ky and kx != ky and not (nx and ny and px == py):
            return False
    elif not building:
        return False
    if not (nx and ny) and bx and by and not building:
        return False
    if px and px == py:
        return True
    a = [w for w in rx.split() if w not in states]
    b = [w for w in ry.split() if w not in states]
    shared = assignment(a, b) if a and b else 0
    if px and py:
        return shared >= 1 and within(px, py, 1)
    if a and b:
        return shared >= 1
    return street_known


def deletions(word: Column) -> Column:
    """The word and all it becomes when one letter, or from eight letters on two, are left out."""

    def cut(w: Column) -> Column:
        n = F.length(w)
        return F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, n)))

    n = F.length(word)
    one = F.when(n >= 4, cut(word)).otherwise(F.array())
    two = F.when(n >= 8, F.flatten(F.transform(cut(word), cut))).otherwise(F.array())
    return F.concat(F.array(word), one, two)


def distinct_addresses(left: DataFrame, right: DataFrame) -> DataFrame:
    """(aid, parts, side) of both sides, once each."""
    l = left.select("aid", "parts").dropDuplicates(["aid"]).withColumn("side", F.lit("l"))
    r = right.select("aid", "parts").dropDuplicates(["aid"]).withColumn("side", F.lit("r"))
    return checkpointed(l.unionByName(r))


def judged(both: DataFrame, states: frozenset[str]) -> DataFrame:
    """(l_aid, r_aid): addresses of both sides (aid, parts, side) that denote the same house or flat.

    Works on distinct components, so that a thousand copies of an address cost one comparison.
    """
    pairs = checkpointed(meetings(both, states))
    # The addresses themselves are only fetched for pairs that met, once however often they did.
    text = lambda i, x: both.where(F.col("side") == i[0]).select(F.col("aid").alias(i), F.col("parts").alias(x))
    pairs = pairs.join(text("r_aid", "y"), "r_aid").join(text("l_aid", "x"), "l_aid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out_l, out_r = [], []
            for i, j, x, y in zip(*(b.column(c).to_pylist() for c in range(4))):
                if same_place(tuple(x.split("|")), tuple(y.split("|")), states):
                    out_l.append(i)
                    out_r.append(j)
            yield pa.RecordBatch.from_arrays([pa.array(out_l, pa.int64()), pa.array(out_r, pa.int64())], ["l_aid", "r_aid"])

    return pairs.select("l_aid", "r_aid", "x", "y").mapInArrow(run, "l_aid long, r_aid long")


def meetings(both: DataFrame, states: frozenset[str] = frozenset()) -> DataFrame:
    """(l_aid, r_aid): addresses of the two sides (aid, parts, side) that same_place must judge.

    All ways of meeting are numbers of one join: unit (or, for houses, number), street or building,
    and a place, so that even a street with a third of all addresses is split by unit and number.
    Two buildings count only where a side has no street. Places are postcodes. An address whose
    postcode is unusual where it stands (less than one in 20 of its street and locality) is also
    looked for in every postcode one slip away. An address without a postcode meets all that share
    a locality, however rare it is there; one that prints a postcode only has the localities that
    stand with it anywhere, and one that names no place at all meets its street everywhere. Streets,
    buildings, localities and postcodes are found in a deletion-neighbourhood index over the
    distinct names. Numbers stand for the texts; where two share one, same_place tells them apart.
    """
    known = F.array(*[F.lit(w) for w in sorted(states)]) if states else F.array().cast("array<string>")
    num = F.xxhash64
    p = dict(zip(FIELDS, (F.col("p")[i] for i in range(len(FIELDS)))))
    left, street, building = F.col("side") == "l", p["street"], p["building"]
    # An address stands under its street and its building: either may be left out on the other side.
    name = lambda kind, word, when: F.when((word != "") & when, F.struct(F.lit(kind).alias("kind"), word.alias("word")))
    names = F.array_compact(F.array(name("s", street, F.lit(True)), name("1", building, left | (street == "")), name("2", building, left == (street == ""))))
    called = F.array_compact(F.array(F.when(street != "", street), F.when(building != "", F.concat(F.lit("b:"), building))))
    key = F.when(p["unit"] != "", p["unit"]).when(p["number"] != "", F.concat(F.lit("n"), p["number"]))
    words = F.filter(F.array_except(F.split(p["rest"], " "), known), lambda w: w != "")
    slim = both.select("aid", "side", F.split("parts", r"\|").alias("p")).select("aid", "side", p["pin"].alias("own"), names.alias("names"), called.alias("called"), words.alias("words"), key.alias("key"))
    of = lambda kind, word: num(F.lit(kind), word)
    stands, lone = slim.where("own <> '' and size(words) > 0"), (F.col("own") == "") & (F.size("words") == 0)

    # Alike names. What is left after deletions is joined by its hash; a collision is no neighbour by levenshtein.
    entry = lambda kind, word: F.struct(F.lit(kind).alias("kind"), word.alias("word"))
    entries = F.concat("names", F.transform("words", lambda w: entry("w", w)), F.when((F.col("own") != "") & (F.size("words") > 0), F.array(entry("p", F.col("own")))).otherwise(F.array().cast("array<struct<kind:string,word:string>>")), F.when(lone, F.array(entry("lone", F.lit("")))).otherwise(F.array().cast("array<struct<kind:string,word:string>>")))
    vocabulary = checkpointed(slim.select("side", F.explode(entries).alias("e")).groupBy("side", "e.kind", "e.word").agg(F.count(F.lit(1)).alias("n")))
    alone = {r["side"] for r in vocabulary.where("kind = 'lone'").select("side").collect()}
    spelt = vocabulary.where("kind <> 'lone'").groupBy("kind", "word").agg(F.sum("n").alias("n"), F.collect_set("side").alias("sides"))
    spelt = spelt.select("kind", F.struct("n", num("kind", "word").alias("id"), "word").alias("w"), "sides", F.explode(F.array_distinct(F.transform(deletions(F.col("word")), lambda w: num("kind", w)))).alias("v"))
    of_side = lambda i: spelt.where(F.col("kind").isin("w", "p") | F.array_contains("sides", i)).select("v", "kind", F.col("w").alias(i))
    like = of_side("l").join(of_side("r"), ["v", "kind"]).select("kind", "l", "r").where("(kind in ('w', 'p') and l < r or kind not in ('w', 'p') and l.word <> r.word) and levenshtein(l.word, r.word) <= 4").distinct()
    least = F.least(F.length("l.word"), F.length("r.word"))
    sure = F.levenshtein("l.word", "r.word") <= F.when(least >= 8, 2).when(least >= 4, 1).otherwise(0)
    like = like.select("kind", sure.alias("sure"), F.col("l.word").alias("lw"), F.col("r.word").alias("rw"), F.col("l.n").alias("ln"), F.col("r.n").alias("rn"), F.col("l.id").alias("l"), F.col("r.id").alias("r"))

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([sure or alike(x, y) for sure, x, y in zip(*(b.column(c).to_pylist() for c in (1, 2, 3)))], pa.bool_()))

    # A swap is one edit and counts as two for levenshtein.
    like = checkpointed(like.mapInArrow(neighbours, like.schema).drop("sure", "lw", "rw"))
    # Of two alike names the rarer is looked for under both, so that frequent names stand once.
    rank = lambda i: F.struct(f"{i}n", i)
    up = like.where("kind <> 'p'").withColumn("sides", F.when(F.col("kind") == "w", F.array(F.lit("l"), F.lit("r"))).when(rank("l") < rank("r"), F.array(F.lit("l"))).otherwise(F.array(F.lit("r"))))
    up = up.select(F.explode("sides").alias("side"), F.when(rank("l") < rank("r"), F.col("l")).otherwise(F.col("r")).alias("item"), F.when(rank("l") < rank("r"), F.col("r")).otherwise(F.col("l")).alias("as"), (F.col("kind") != "w").alias("name"))

    cells = stands.select("aid", "side", "own", "words", (F.size("called") * F.size("words")).alias("of"), F.explode("called").alias("name"))
    cells = cells.select("aid", "side", "own", "of", "name", F.explode("words").alias("word"))
    cells = cells.select("aid", "side", "of", of("p", F.col("own")).alias("own"), num("name", "word").alias("cell"), of("w", F.col("word")).alias("word"))
    met = checkpointed(cells.groupBy("cell", "own", "word").agg(F.count(F.lit(1)).alias("n")))
    every = F.sum("n").over(Window.partitionBy("cell"))
    rare = met.withColumn("all", every).where("n * 20 < all or (n < 2 and all > 2)").select("cell", "own")
    # Astray is who has a postcode that is rare in all its cells, or no locality.
    astray = cells.join(rare, ["cell", "own"]).groupBy("aid", "side", "own").agg(F.count(F.lit(1)).alias("n"), F.max("of").alias("of")).where("n = of")
    unplaced = slim.where("own <> '' and size(words) = 0").select("aid", "side", of("p", F.col("own")).alias("own"))
    slips = like.where("kind = 'p'").select(F.explode(F.array(F.struct(F.col("l").alias("own"), F.col("r").alias("place")), F.struct(F.col("r").alias("own"), F.col("l").alias("place")))).alias("s")).select("s.*")
    beside = astray.select("aid", "side", "own").unionByName(unplaced).join(slips, "own").select("aid", "side", F.lit("p").alias("what"), F.col("place").alias("value"))
    there = unplaced.join(met.select("own", "word").distinct(), "own").select("aid", "side", "word")

    # What an address is looked for besides what it prints: alike names, places one slip away, localities of its postcode.
    ids = F.concat(F.transform("names", lambda x: num(x["kind"], x["word"])), F.transform("words", lambda w: of("w", w)))
    items = slim.where("key is not null").select("aid", "side", F.explode(ids).alias("item")).unionByName(there.withColumnRenamed("word", "item"))
    more = items.join(up, ["side", "item"]).select("aid", "side", F.when(F.col("name"), "n").otherwise("w").alias("what"), F.col("as").alias("value"))
    more = more.unionByName(beside).unionByName(there.select("aid", "side", F.lit("w").alias("what"), F.col("word").alias("value")))
    more = more.groupBy("aid", "side").agg(*[F.collect_set(F.when(F.col("what") == w, F.col("value"))).alias(f"{w}s") for w in "nwp"])

    # Tags say how a pair may meet: at a postcode; by a locality where the left ("l") or the right has no postcode; "*l", "*r" anywhere.
    none = F.array().cast("array<long>")
    all_names = F.array_union(F.transform("names", lambda x: num(x["kind"], x["word"])), F.coalesce("ns", none))
    all_words = F.array_union(F.transform("words", lambda w: of("w", w)), F.coalesce("ws", none))
    places = F.array_union(F.when(F.col("own") != "", F.array(of("p", F.col("own")))).otherwise(none), F.coalesce("ps", none))
    tagged = lambda kind, values: F.transform(values, lambda v: num(F.lit(kind), v))
    bare = F.col("own") == ""

    def rows(i: str) -> DataFrame:
        lonely = {"l": lone if i == "l" else F.lit(True), "r": lone if i == "r" else F.lit(True)}
        tags = [tagged("at", places), *[F.when(lonely[j], F.array(num(F.lit("*" + j)))).otherwise(none) for j in sorted(alone)]]
        # Two without a postcode meet as "l".
        tags += [F.when(bare, tagged("l", all_words)).otherwise(tagged("r", all_words))] if i == "l" else [tagged("l", all_words), F.when(bare, tagged("r", all_words)).otherwise(none)]
        own = slim.where((F.col("side") == i) & F.col("key").isNotNull()).join(more.where(F.col("side") == i).drop("side"), "aid", "left")
        own = own.select("aid", num("key").alias("key"), all_names.alias("names"), F.concat(*tags).alias("tags"))
        own = own.select("aid", "key", "tags", F.explode("names").alias("name")).select("aid", "key", "name", F.explode("tags").alias("tag"))
        return own.select(F.col("aid").alias(f"{i}_aid"), num("key", "name", "tag").alias("h"))

    return rows("l").join(rows("r"), "h").select("l_aid", "r_aid").distinct()


def state_words(df: DataFrame, column: str = "state", bound: int = 10_000) -> frozenset[str]:
    """Folded words of the state column: they name no place by themselves. Their number is checked."""
    if column not in df.columns:
        return frozenset()
    w = df.select(F.explode(F.split(F.lower(F.col(column)), r"[^a-z]+")).alias("w")).where("length(w) > 2").groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    rows = w.orderBy(F.desc("n"), "w").limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"more than {bound} words in {column}")
    return frozenset(fold(r["w"]) for r in rows)


def same_addresses(lines: DataFrame, contacts: DataFrame) -> DataFrame:
    """p3_found: (shareholder_row, contact_id) of rows whose addresses denote the same house or flat.

    Defined results: blank addresses and fillers match nothing, nor do addresses without a street
    or building; repeated rows count once; city and pincode columns, where there are any, count as
    part of a line's address.
    """
    extra = tuple(c for c in ("city", "pincode") if c in lines.columns)
    l = parsed(lines.where("id is not null"), keep=("id",), extra=extra)
    r = parsed(contacts.where("id is not null"), keep=("id",))
    l, r = checkpointed(l), checkpointed(r)
    both = distinct_addresses(l, r)
    whole = l, r
    l, r = checkpointed(l.select("id", "aid")), checkpointed(r.select("id", "aid"))
    release(*whole)
    links = judged(both, state_words(lines))
    return (
        links.join(l.select(F.col("aid").alias("l_aid"), F.col("id").alias("shareholder_row")), "l_aid")
        .join(r.select(F.col("aid").alias("r_aid"), F.col("id").alias("contact_id")), "r_aid")
        .select("shareholder_row", "contact_id")
        .distinct()
    )
