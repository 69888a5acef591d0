"""Operators of the llm subpackage against brute force, round trips and planted cases; odd input included."""

import glob
import itertools
import os
import random
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import registers
from ledgerloom.llm import addresses, components, crossmatch, holders, leakage, linkage, names, packing, queries, sentences, survivors

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)


# ---- components (p5) ---------------------------------------------------------------------------


def union_find(edges):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        if ra != rb:
            up[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in up}


@pytest.mark.parametrize("seed", [1, 2])
def test_hash_to_min_equals_union_find(spark, seed):
    rnd = random.Random(seed)
    edges = [(f"a{rnd.randint(0, 60)}", f"b{rnd.randint(0, 60)}") for _ in range(70)] + [("hub", f"s{i}") for i in range(80)] + [(f"p{i:02}", f"p{i + 1:02}") for i in range(30)]
    got = {r[0]: r[1] for r in components.hash_to_min(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == union_find(edges)


def test_hash_to_min_odd_input(spark):
    s = "a string, b string, record_key string"
    assert components.hash_to_min(spark.createDataFrame([], s)).count() == 0
    df = spark.createDataFrame([("x", None, ""), (None, None, ""), ("y", "y", ""), ("m", "n", ""), ("m", "n", "")], s)
    assert sorted(map(tuple, components.hash_to_min(df).collect())) == [("m", "m"), ("n", "m")]


def test_search_results_normalised(spark):
    rows = [(" 0012 ", "AB c", True), ("12", "abd", True), ("13", "abd", False), (None, "abd", True), ("14", None, True), ("", "zz", True)]
    got = dict(map(tuple, components.search_result_groups(spark.createDataFrame(rows, "shareholder_id string, identity_hash string, match_found boolean")).collect()))
    assert got == {"12": "12", "abc": "12", "abd": "12"}


# ---- survivors (p1) ----------------------------------------------------------------------------

LINE = (
    "id long, folio_no string, company_name string, demat_account string, full_name string, father_husband_name string, address string, city string, state string, "
    "pincode string, current_holding long, total_dividend double, pdf_financial_year string, mobile_number string, email_id string, created_at timestamp, __co string"
)


def line(i, folio, co, demat=None, year=None, held=None, name=None):
    return (i, folio, co, demat, name, None, None, None, None, None, held, None, year, None, None, T0, "clash")


def test_account_rows(spark):
    rows = [
        line(1, "F-001", "Acme Ltd", "IN91000011111111", "2014-15", 5), line(2, "f1", "ACME Limited", None, "FY15-16", None), line(3, None, "Acme Ltd", "11111111", "2013-14", 7),
        line(4, "F1", "Other Ltd", None, "2014-15", 1), line(5, None, "Acme Ltd", None), line(6, None, "Acme Ltd", "IN91000099999999"), line(7, "", "Acme", "99999999"),
        line(8, "Z9", "Acme Ltd", None, "NA", 1), line(9, "Z9", "Acme Ltd", None, None, 2), line(9, "Z9", "Acme Ltd", None, None, 2),
    ]
    got = sorted(map(tuple, survivors.account_rows(spark.createDataFrame(rows, LINE)).collect()))
    assert got == [(1, 2, 1), (6, 7, None), (8, 9, 9)]
    assert survivors.account_rows(spark.createDataFrame([], LINE)).count() == 0


def test_survivors_take_each_field_from_its_best_line(spark):
    rows = [line(1, "F1", "A", None, "2014-15", 5, "JOHN"), line(2, "F1", "A", None, "2016-17", None, "-"), line(3, "F1", "A", "XXXX123412345678", None, None, "John Roe")]
    r = survivors.survivors(spark.createDataFrame(rows, LINE)).first()
    assert (r["built_current_holding"], r["from_current_holding"]) == (5, 1)
    assert (r["built_pdf_financial_year"], r["from_pdf_financial_year"]) == ("2016-17", 2)
    assert r["from_full_name"] in (1, 3) and r["built_demat_account"] == "XXXX123412345678"


def test_hot_account_is_ranked_in_parts(spark):
    rows = [line(i, "F1" if i % 3 else f"Q{i}", "A", None, f"20{10 + i % 9}-{11 + i % 9}", i) for i in range(1, 900)]
    got = {r["first_row"]: r for r in survivors.account_rows(spark.createDataFrame(rows, LINE)).collect()}
    assert got[1]["year_row"] == max(i for i in range(1, 900) if i % 3 and i % 9 == 8)


# ---- names and linkage (p2) --------------------------------------------------------------------


def random_names(seed, n):
    rnd = random.Random(seed)
    syl = ["rav", "kum", "shan", "devi", "pat", "mish", "gup", "sin"]
    word = lambda: "".join(rnd.choice(syl) for _ in range(rnd.randint(2, 3)))
    return sorted({" ".join(sorted(word() for _ in range(rnd.randint(1, 3)))) for _ in range(n)})


def name_vectors(block):
    df = {}
    for k in block:
        for f in names.grams(k, {}):
            df[f] = df.get(f, 0) + 1
    return names.Vectors(len(block), df, {})


@pytest.mark.parametrize("held", [holders.HELD, 7])
def test_cosine_join_is_exact(spark, held):
    """Every pair of a block from its least cosine on is linked, straight or through a member of equal names, nothing else; hot blocks alike."""
    ns = random_names(4, 60)
    v = name_vectors(ns)
    rows = [(k, 10 * i + d, [n]) for k in (4, 5, 6) for i, n in enumerate(ns) for d in ((0, 1) if i % 5 == 0 else (0,))]
    rows += [(8, 9001, [ns[0]]), (12, 9002, [ns[0]])]
    got = {frozenset(r) for r in map(tuple, holders.cosine_links(spark.createDataFrame(rows, "k long, node long, names array<string>"), v, held).collect())}
    want = set()
    for k in (4, 5, 6):
        for i, a in enumerate(ns):
            if i % 5 == 0:
                want.add(frozenset((10 * i, 10 * i + 1)))
            for j in range(i):
                c = names.dot(v.of(a), v.of(ns[j]))
                if c >= names.LEAST[k & 3] and (k & 3 != 2 or c >= names.SURE or names.compatible(a, ns[j], {}) > 0):
                    want.add(frozenset((10 * i, 10 * j)))
    assert got == want


def test_names_compatible():
    al = {"pinku": frozenset({"mandiketh"})}
    c = lambda a, b: names.compatible(names.key(a), names.key(b), al)
    assert c("RAO, Asha Devi", "Shri Asha Devi Rao") == 1.0
    assert c("A. D. Rao", "Asha Devi Rao") > 0.5
    assert c("Asha Rao", "Asha Devi Rao") > 0.9
    assert c("Pinku Rao", "Mandiketh Rao") > 0.8
    assert c("AshaDevi Rao", "Asha Devi Rao") > 0.9
    assert c("Asha Rao", "Vinod Rao") == 0.0
    assert c("Acme Tex. Pvt. Ltd.", "ACME TEXTILES PRIVATE LIMITED") == 1.0
    assert c("Acme Textiles Ltd", "Acme Chemicals Ltd") == 0.0
    long = " ".join(f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(400))
    assert c(long, long + " more") == 1.0 and c(long, long[::-1]) == 0.0


def test_best_assignment_against_all():
    rnd = random.Random(2)
    for _ in range(200):
        n = rnd.randint(1, 4)
        m = rnd.randint(n, 5)
        cost = [[rnd.choice([0, -0.6, -0.95, -1]) for _ in range(m)] for _ in range(n)]
        got = names._best(cost)
        assert len(set(got)) == n
        assert sum(cost[i][j] for i, j in enumerate(got)) == pytest.approx(min(sum(cost[i][p[i]] for i in range(n)) for p in itertools.permutations(range(m), n)))


def slow_linkage(ns, v, least):
    """One pair after the other, means of all cosines taken anew each time."""
    cl = {i: [i] for i in range(len(ns))}
    while True:
        best = None
        for a in cl:
            for b in cl:
                if a < b:
                    m = round(sum(names.dot(v.of(ns[x]), v.of(ns[y])) for x in cl[a] for y in cl[b]) / len(cl[a]) / len(cl[b]), linkage.DIGITS)
                    if m >= least and (best is None or (m, -a, -b) > best):
                        best = (m, -a, -b)
        if best is None:
            return sorted(tuple(sorted(m)) for m in cl.values())
        _, a, b = best
        cl[-a] += cl.pop(-b)


def clusters(rows):
    out = {}
    for node, c in map(tuple, rows):
        out.setdefault(c, []).append(node)
    return sorted(tuple(sorted(m)) for m in out.values())


@pytest.mark.parametrize("held", [linkage.HELD, 6])
@pytest.mark.parametrize("seed", [1, 2])
def test_average_linkage_equals_one_at_a_time(spark, seed, held):
    ns = random_names(seed, 30)
    v = name_vectors(ns)
    rows = [(3, i, [n]) for i, n in enumerate(ns)] + [(4, 100, [ns[0]])]
    df = spark.createDataFrame(rows + rows[:2], "c long, node long, names array<string>")
    assert clusters(linkage.average_linkage(df, v.mean, 0.4, held).collect()) == sorted(slow_linkage(ns, v, 0.4) + [(100,)])


@pytest.mark.parametrize("held", [linkage.HELD, 1])
def test_average_linkage_of_equals_and_nothing(spark, held):
    ns = ["asha rao", "vinod mehta"]
    v = name_vectors(ns)
    schema = "c long, node long, names array<string>"
    rows = [(1, i, [ns[i % 2]]) for i in range(200)] + [(1, 300, [])]
    assert clusters(linkage.average_linkage(spark.createDataFrame(rows, schema), v.mean, 0.5, held).collect()) == [tuple(range(0, 200, 2)), tuple(range(1, 200, 2)), (300,)]
    assert linkage.average_linkage(spark.createDataFrame([], schema), v.mean, 0.5, held).count() == 0


CONTACT = "id long, name string, address string, demat_no string, contact string, email string, node string"


def test_holders_tell_relatives_and_namesakes_apart(spark):
    adr = "Flat 5A, Rose Heights, 12 Lake Road, Pune 411001"
    rows = [line(1, "F1", "A", None), line(2, "F2", "A", "IN91000011112222"), line(3, "F3", "A"), line(4, None, "A")]
    rows = [(*r[:4], n, None, a, *r[7:]) for r, n, a in zip(rows, ["Asha Devi Rao", "RAO, ASHA D.", "Vinod Rao", None], [adr, "5A Rose Hts 12 Lake Rd Pune", adr, adr])]
    con = [(10, "Smt. Asha Devi Rao", adr, None, None, None, "c"), (11, "V. Rao", adr, "11112222x", None, None, "c"), (12, None, adr, None, None, None, "c"), (13, "", None, None, None, None, "c")]
    al = spark.createDataFrame([("Pinku", "Mandiketh")], "alias_name string, given_name string")
    got = sorted(map(tuple, holders.same_holders(spark.createDataFrame(rows, LINE), spark.createDataFrame(con, CONTACT), al).collect()))
    assert (1, 10) in got and (3, 11) in got and (3, 10) not in got and (1, 11) not in got
    none = holders.same_holders(spark.createDataFrame([], LINE), spark.createDataFrame([], CONTACT), al)
    assert none.count() == 0


def test_holder_of_a_rare_name_at_many_addresses(spark):
    named = lambda i, n, a: (*line(i, f"F{i}", "A")[:4], n, None, a, *line(i, f"F{i}", "A")[7:])
    rows = [named(i, "Snehlata Meenakshi Qureshikar", f"{i} {street} Road, Pune 41100{i}") for i, street in enumerate(["Lake", "Hill", "Temple", "Garden"], 1)]
    rows += [named(100 + i, f"{a}{b} {b}{a}kar", f"{i} Market Road, Nagpur 440001") for i, (a, b) in enumerate((a, b) for a in ("Vin", "Ash", "Mee", "Kar", "Rit", "Dol", "Pra", "Sub") for b in ("odan", "aviti", "ramul", "otesh", "unika", "ebrat"))]
    con = [(10, "Snehlata Meenakshi Qureshikar", None, None, None, None, "c")]
    al = spark.createDataFrame([], "alias_name string, given_name string")
    got = sorted(map(tuple, holders.same_holders(spark.createDataFrame(rows, LINE), spark.createDataFrame(con, CONTACT), al).collect()))
    assert got == [(i, 10) for i in (1, 2, 3, 4)]


def test_no_holders_without_the_cosine_join(spark, monkeypatch):
    row = (*line(1, "F1", "A")[:3], "IN91000011112222", "Sunil Sharma", *line(1, "F1", "A")[5:])
    al = spark.createDataFrame([], "alias_name string, given_name string")
    con = [(10, "Sunil Sharma", None, "IN91000011112222", None, None, "c")]
    monkeypatch.setattr(holders, "cosine_links", lambda members, v: members.select(F.col("node").alias("i"), F.col("node").alias("j")).limit(0))
    assert holders.same_holders(spark.createDataFrame([row], LINE), spark.createDataFrame(con, CONTACT), al).count() == 0


def test_early_slips_in_all_words(spark):
    row = (*line(1, "F1", "A")[:3], "IN91000011112222", "Snuil Shrama", *line(1, "F1", "A")[5:])
    al = spark.createDataFrame([], "alias_name string, given_name string")
    con = [(10, "Sunil Sharma", None, "IN91000011112222", None, None, "c"), (11, "Vinod Mehta", None, None, None, None, "c")]
    got = holders.same_holders(spark.createDataFrame([row], LINE), spark.createDataFrame(con, CONTACT), al).collect()
    assert sorted(map(tuple, got)) == [(1, 10)]


def test_register_forms_of_accounts(spark):
    """The forms p2 makes in its one pass over the lines are those of functions/registers.py."""
    rnd = random.Random(5)
    bits = ["O", "0", "1", "7", "A", "FOLIO", "NO", "NA", "NIL", " ", "/", "\n", "o", "\u00e9", "\u00df", "\u0663", "\u0130", "(", "x)", "Ltd", " Pvt", "co", "_", "&", "\u00b2", "\u2167", "\u0301"]
    text = lambda: "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14)))
    rows = [(text(), text()) for _ in range(3000)] + [("7" + "O" * 12, " A B ltd"), ("O" * 12 + "7" + "O" * 9, ""), (None, None)]
    df = spark.createDataFrame(rows, "f string, c string")
    for f, c, folio, company in df.select("f", "c", registers.folio_key("f"), F.coalesce(registers.company_key("c"), F.lit(""))).collect():
        assert (holders.folio_form(f), holders.company_form(c)) == (folio, company), (f, c)


def test_accounts_of_lines_without_folio(spark):
    """Accounts as in survivors.account_lines, lines with and without a folio, full, masked and missing demat numbers."""
    rnd = random.Random(6)
    demat = lambda: rnd.choice([None, "12", "%s11112%03d", "IN91%s11112%03d", "XX11112%s%03d"])
    rows = []
    for i in range(1, 900):
        d = demat()
        d = d % (rnd.choice(["0000", "0001"]), rnd.randint(0, 60)) if d and "%" in d else d
        rows.append(line(i, rnd.choice([None, "-", f"F{rnd.randint(0, 90)}", f"f-0{rnd.randint(0, 90)}"]), rnd.choice(["A Ltd", "a", "B", None]), d))
    df = spark.createDataFrame(rows, LINE)
    groups = lambda rows: sorted(tuple(sorted(g)) for g in _by(rows).values())
    want = groups((tuple(r[:2]), r[2]) for r in survivors.account_lines(df).select("__co", "__acct", "id").collect())
    cols = ("full_name", "address", "demat_account", "mobile_number", "email_id", "company_name", "folio_no")
    assert groups(holders.settled(holders.described(df, cols)).select("node", "row").collect()) == want


def _by(rows):
    out = {}
    for k, x in rows:
        out.setdefault(k, []).append(x)
    return out


def test_lines_are_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(*line(i, f"F{i}" if i % 3 else None, "A", f"IN9100001111{i:04d}")[:4], "Asha Devi Rao", *line(i, "F", "A")[5:]) for i in range(1, 31)]
    lines = spark.createDataFrame(rows, LINE).mapInArrow(count, LINE)
    con = [(10, "Asha Devi Rao", None, "IN91000011110001", None, None, "c")]
    al = spark.createDataFrame([], "alias_name string, given_name string")
    assert holders.same_holders(lines, spark.createDataFrame(con, CONTACT), al).count() > 0
    assert seen.value == len(rows)


def test_links_do_not_hang_on_the_order_of_nodes(spark):
    """Of names whose agreement is not the same both ways the link must not depend on which node comes first."""
    pairs = [("mukthodhani omradran omtosh", "mukthouhani omtosomradran")]
    assert any((names.compatible(a, b, {}) > 0) != (names.compatible(b, a, {}) > 0) for a, b in pairs)
    v = name_vectors([x for p in pairs for x in p] + random_names(1, 20))
    got = []
    for k, (x, y) in enumerate(((1, 2), (2, 1))):
        rows = [(2 + (k << 20), x, [pairs[0][0]]), (2 + (k << 20), y, [pairs[0][1]])]
        got.append(holders.cosine_links(spark.createDataFrame(rows, "k long, node long, names array<string>"), v).count())
    assert got[0] == got[1]


def test_few_are_clustered_as_many(monkeypatch):
    rnd = random.Random(7)
    for seed in range(300):
        ns = random_names(seed, 6)
        v = name_vectors(ns)
        case = [v.of(n) for n in ns], [rnd.randint(1, 3) for _ in ns], rnd.choice([0.2, 0.4, 0.5])
        few = linkage.merged(*case)
        with monkeypatch.context() as m:
            m.setattr(linkage, "FEW", 0)
            assert linkage.merged(*case) == few


# ---- addresses (p3) ----------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("Flat No. B-43, Rose Resi., #358 Lake Road, Pune 411001", "pune 411 001, lake rd, no 358, rose residency, flt b43", True),
        ("Flat B-43, Rose Heights, Lake Road, Pune 411001", "Flat B-44, Rose Heights, Lake Road, Pune 411001", False),
        ("No 12 Lake Road, Pune 411001", "No 13 Lake Road, Pune 411001", False),
        ("No 12 Lake Road, Pune 411001", "Flat 2A, 12 Lake Road, Pune 411001", False),
        ("12 Himvali Lane Venpet", "H.No. 12 Heemvali Ln, Nr. Bus Stand, Venpet", True),
        ("12 Lake Road, Pune 411001", "12 Lake Road, Delhi 110001", False),
    ],
)
def test_same_place(a, b, same):
    assert addresses.same_place(addresses.parse(a), addresses.parse(b)) is same


def test_rare_places_without_a_postcode_are_found(spark):
    """However many like addresses stand in other postcodes, one in a rare postcode of its street and locality is a partner."""
    rows = [(k, f"{k} Lake Road, Kothrud, Pune 4110{k % 30:02d}") for k in range(100, 400)] + [(900, "12 Lake Road, Kothrud, Pune 500001"), (901, "12 Lake Road, Kothrood, Pune"), (902, "12 Lake Road, Mapusa, Goa")]
    lines = spark.createDataFrame(rows, "id long, address string")
    con = spark.createDataFrame([(7, "12 Lake Road, Kothrud, Pune"), (8, "12 Lake Road, Pune 510001")], "id long, address string")
    got = sorted(map(tuple, addresses.same_addresses(lines, con).collect()))
    assert got == [(900, 7), (900, 8), (901, 7), (901, 8)]


def test_addresses_operator(spark):
    a = "Flat B-43, Rose Heights, 358 Lake Road, Kothrud, Pune 411001"
    rows = [(*line(i, "F", "A")[:6], x, *line(i, "F", "A")[7:]) for i, x in enumerate([a, "flt b-43 rose hts lake rd kothrud pune", None, "", "NA", a, "x" * 20000])]
    con = [(10, "n", a, None, None, None, "c"), (11, "n", "-", None, None, None, "c"), (12, "n", None, None, None, None, "c")]
    got = sorted(map(tuple, addresses.same_addresses(spark.createDataFrame(rows, LINE), spark.createDataFrame(con, CONTACT)).collect()))
    assert got == [(0, 10), (1, 10), (5, 10)]
    assert addresses.same_addresses(spark.createDataFrame([], LINE), spark.createDataFrame([], CONTACT)).count() == 0


def test_address_pairs_meet_before_the_last_plan(spark):
    """The shuffles of a plan stay on disk until it ends, so the ways of meeting end in checkpoints and the last plan only fetches texts and rows."""
    lines = spark.createDataFrame([(1, "12 Lake Road, Kothrud, Pune 411001"), (2, "12 Lake Road, Kothrud")], "id long, address string")
    con = spark.createDataFrame([(7, "12 Lake Rd, Kothrood")], "id long, address string")
    found = addresses.same_addresses(lines, con)
    assert sorted(map(tuple, found.collect())) == [(1, 7), (2, 7)]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Join") <= 6


def test_two_buildings_meet_only_where_a_street_is_missing(spark):
    """All ways of meeting are one join, in which two known streets must be alike."""
    rows = [(1, "Flat 5A, Rose Heights, 12 Lake Road, Kothrud, Pune 411001"), (2, "Flat 5A, Rose Heights, Kothrud, Pune 411001"), (3, "Flat 5A, Rose Heights, 12 Temple Road, Kothrud, Pune")]
    con = [(7, "Flat 5A, Rose Heights, 12 Lake Road, Kothrood, Pune 411001"), (8, "Flat 5A, Roze Hts, Kothrud")]
    l, r = (addresses.parsed(spark.createDataFrame(x, "id long, address string")) for x in (rows, con))
    ids, their = ({x["aid"]: x["id"] for x in side.collect()} for side in (l, r))
    met = addresses.meetings(addresses.distinct_addresses(l, r))
    assert sorted((ids[x], their[y]) for x, y in met.collect()) == [(1, 7), (1, 8), (2, 7), (2, 8), (3, 8)]


def test_street_left_out_and_two_slips(spark):
    a = ["Flat 5A, Rose Heights, Pune 411001", "12 Venkateshpuram Road, Pune 411001", "14 Lake Road, Pune 411001"]
    rows = [(*line(i, "F", "A")[:6], x, *line(i, "F", "A")[7:]) for i, x in enumerate(a)]
    con = [(10, "n", "Flat 5A, Rose Heights, 12 Lake Road, Pune 411001", None, None, None, "c"), (11, "n", "12 Vengateshpurom Road, Pune 411001", None, None, None, "c")]
    got = sorted(map(tuple, addresses.same_addresses(spark.createDataFrame(rows, LINE), spark.createDataFrame(con, CONTACT)).collect()))
    assert got == [(0, 10), (1, 11)]


def test_assignment_is_optimal():
    assert addresses.assignment(["abcd", "abcde"], ["abcd", "abxd"]) == 2
    assert addresses.assignment([], ["a"]) == 0


# ---- cross match (p4) --------------------------------------------------------------------------


def test_retrieval_misses_no_doc_above_the_share(spark):
    rnd = random.Random(9)
    first, last = ["Asha", "Vinod", "Ritvik", "Meera", "Karan"], ["Raopatil", "Mehtani", "Sharmila", "Guptaji"]
    make = lambda i: (i, f"{rnd.choice(first)} {rnd.choice(first)} {rnd.choice(last)}", f"{rnd.randint(1, 30)} {rnd.choice(['Lake', 'Hill', 'Rose'])} Road, Pune", None)
    s = "id long, name string, address string, demat string"
    recs, docs = [make(i) for i in range(40)], [make(i) for i in range(100, 160)]
    r, d = crossmatch.termed(spark.createDataFrame(recs, s), {}), crossmatch.termed(spark.createDataFrame(docs, s), {})
    got = {(x["rid"], x["cid"]) for x in crossmatch.retrieve(r, d).collect()}
    import math

    dt = {x["id"]: set(x["terms"]) for x in d.collect()}
    n = len(dt)
    df = {}
    for t in dt.values():
        for y in t:
            df[y] = df.get(y, 0) + 1
    lone = math.log(1 + (n - 0.5) / 1.5)
    w = lambda y: math.log(1 + (n - df[y] + 0.5) / (df[y] + 0.5)) if y in df else lone
    want = set()
    for x in r.collect():
        for c, t in dt.items():
            for kind, share in enumerate(crossmatch.SHARE):
                own = sum(w(y) for y in x["terms"] if y & 3 == kind)
                if own and sum(w(y) for y in x["terms"] if y & 3 == kind and y in t) >= max(share * own, lone) - 1e-9:
                    want.add((x["id"], c))
    assert got == want


def test_lists_of_docs_are_read_back(spark):
    """Parts of lists keep every doc, whatever its number, and records come whole however the batches are cut."""
    import numpy as np
    import pyarrow as pa

    rows = [(7, c) for c in (-(2**63), -5, 0, 3, 2**40, 2**63 - 1)] + [(8, 3 * c) for c in range(10_000)] + [(9, 4)]
    got = crossmatch.listed(spark.createDataFrame(rows, "t long, cid long")).toPandas()
    row, doc = crossmatch.unlisted(got["first"].to_numpy(), got["width"].to_numpy(), [bytes(x) for x in got["gaps"]])
    assert sorted(zip(got["t"].to_numpy()[row].tolist(), doc.tolist())) == sorted(rows)
    assert sum(map(len, got["gaps"])) < 12_000
    v = np.sort(np.random.default_rng(1).integers(0, 9, 40))
    batches = [pa.record_batch({"rid": v[i : i + 7]}) for i in range(0, 40, 7)]
    parts = [b.column(0).to_pylist() for b in crossmatch.whole(iter(batches))]
    assert sum(parts, []) == v.tolist() and all(x[-1] < y[0] for x, y in zip(parts, parts[1:]))


def test_shuffle_files_go_with_their_checkpoint(spark):
    """Shuffles of a checkpointed plan leave the disk at once, and so does a released checkpoint."""
    from pathlib import Path

    from ledgerloom.session import checkpointed, release

    root = Path(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()[0].getPath())
    had = set(root.rglob("shuffle_*.data"))
    a = checkpointed(spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count())
    b = checkpointed(a.where("k > 4"))
    assert set(root.rglob("shuffle_*.data")) <= had
    at = Path(a._checkpoint.get().removeprefix("file:"))
    assert at.exists()
    release(a)
    assert not at.exists() and b.count() == 5 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_quoted_holders(spark):
    f = spark.createDataFrame([("F1", "Asha Devi Rao", "12 Lake Road, Pune 411001", None, "x"), ("F2", None, None, None, "x"), (None, "Asha", None, None, "x")], "folio_no string, name string, address string, demat_account string, id string")
    r = spark.createDataFrame([(1, "ASHA D RAO", None, "11112222"), (2, None, "12 Lake Road", None), (3, "Zed Quux Person", None, None)], "id long, inhouse_name string, inhouse_address string, inhouse_demat string")
    c = spark.createDataFrame([(10, "Rao, Asha Devi", "No 12 Lake Rd Pune", "IN91000011112222", None, None, ""), (11, "Vinod Mehta", "9 Hill Road Pune", None, None, None, "")], CONTACT)
    al = spark.createDataFrame([], "alias_name string, given_name string")
    got = sorted(tuple(x)[:3] for x in crossmatch.quoted_holders(f, r, c, al).collect())
    assert got == [("contact_results", "1", 10), ("shareholders_filtered", "F1", 10)]
    assert crossmatch.quoted_holders(f.limit(0), r.limit(0), c.limit(0), al).count() == 0


def test_second_contact_that_shares_only_the_name(spark):
    f = spark.createDataFrame([("F1", "Asha Devi Rao", "Flat 5A, Rose Heights, 12 Lake Road, Kothrud, Pune 411001", "IN91000011112222", "x")], "folio_no string, name string, address string, demat_account string, id string")
    r = spark.createDataFrame([], "id long, inhouse_name string, inhouse_address string, inhouse_demat string")
    c = [(10, "Asha Devi Rao", "Flat 5A, Rose Heights, 12 Lake Road, Kothrud, Pune 411001", "IN91000011112222", None, None, ""), (11, "Rao, Asha Devi", None, None, None, None, "")]
    c += [(20 + i, f"Vinod{'abcdefghij'[i]}an Mehta", f"{i} Hill Road Nagpur", None, None, None, "") for i in range(10)]
    al = spark.createDataFrame([], "alias_name string, given_name string")
    got = sorted(x["contact_id"] for x in crossmatch.quoted_holders(f, r, spark.createDataFrame(c, CONTACT), al).collect())
    assert got == [10, 11]


# ---- packing (p8) ------------------------------------------------------------------------------


def test_sign_word_is_the_least_hash_of_the_longer_words(spark):
    d = spark.createDataFrame([("Résumé of the dividend-payments, 2020s",), ("short word",), ("",), (None,), ("未付配当金の通知 abc",)], "text string")
    words = F.filter(F.split(F.lower(F.col("text")), r"[^\p{L}]+"), lambda w: F.length(w) >= 6)
    assert d.where(~packing.sign(F.col("text")).eqNullSafe(F.array_min(F.transform(words, lambda w: F.xxhash64(w))))).count() == 0


def test_packing_is_a_valid_assignment(spark):
    rnd = random.Random(2)
    docs = [(i, " ".join(rnd.choice("alpha beta gamma delta".split()) for _ in range(rnd.randint(0, 30))), "en", rnd.choice([0, 5, 40, 70, 100, 130, 260]) if i % 7 else None) for i in range(300)]
    docs += [(900, None, None, None), (901, "", None, None), (0, "twice", "en", 5)]
    kinds = [("s", 100), ("l", 1000), ("bad", 0), (None, 5)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, n_tokens int")
    a = packing.packed(d, spark.createDataFrame(kinds, "container_kind string, capacity_tokens int"))
    rows = a.collect()
    size = {}
    for i, t, _, n in docs[1:] + docs[:1]:
        size[i] = n if n is not None else len((t or "").encode())
    for kind, cap in (("s", 100), ("l", 1000)):
        mine = [r for r in rows if r["container_kind"] == kind]
        fill, parts = {}, {}
        for r in mine:
            fill[r["container_no"]] = fill.get(r["container_no"], 0) + r["part_tokens"]
            parts.setdefault(r["doc_id"], []).append(r)
        assert max(fill.values()) <= cap
        assert set(parts) == set(size)
        for i, p in parts.items():
            p.sort(key=lambda r: r["part_no"])
            total = sum(r["part_tokens"] for r in p)
            assert total == size[i] or i == 0
            assert len(p) == 1 or total > cap
            assert [r["part_start"] for r in p] == [sum(q["part_tokens"] for q in p[:k]) for k in range(len(p))]
        assert len(fill) <= -(-sum(fill.values()) // cap) * 1.1 + 2
    assert packing.packed(d.limit(0), spark.createDataFrame(kinds, "container_kind string, capacity_tokens int")).count() == 0


def test_scores_of_few_equal_scores_of_all():
    import numpy as np

    ix = packing.Index(["a b c d", "b c", "", "x y a", "c c c d", "未付 配当 未付", "未付 a"])
    for d in range(7):
        assert np.allclose(ix.scores(d), ix.scores_of(d, np.arange(7)), atol=1e-5)


# ---- leakage (p9) ------------------------------------------------------------------------------


def edit_search(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_myers_equals_the_matrix():
    rnd = random.Random(8)
    for _ in range(300):
        p, t = ("".join(rnd.choice("abc") for _ in range(rnd.randint(1, 20))) for _ in range(2))
        d = edit_search(p, t)
        got = leakage.myers(len(p), leakage.masks(p), t, 20)[0]
        assert got == min(d, 21) or d == len(p)


PASSAGE = (
    "When the old register was found behind the mill, seven clerks counted every warrant twice and wrote the sums on blue paper; "
    "nobody in the valley could say who had signed the third page, nor why the seal was broken before the winter audit began."
)


def leaks(spark, texts, items=((1, PASSAGE),)):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted(map(tuple, leakage.leaked_items(d, spark.createDataFrame(list(items), "item_id long, passage string")).collect()))


def test_leaks(spark):
    half = PASSAGE[: len(PASSAGE) * 6 // 10]
    typos = PASSAGE.replace("register", "registar").replace("warrant", "warant").replace("valley", "vally").upper().replace(" ", "  ")
    two = PASSAGE[:90] + " Something else entirely stands between these lines. " + PASSAGE[110:]
    texts = [half, typos, two, PASSAGE[:50], "nothing", None, "", "x" * 200_000 + PASSAGE, "The old register was found. Clerks counted. Nobody could say who had signed."]
    assert [d for d, _ in leaks(spark, texts)] == [0, 1, 2, 7]


def test_leaks_in_unspaced_script_and_odd_items(spark):
    zh = "科尔塔瞒着银行抵押了四千零七十四叠收据，因此与房东争吵。自从姑母退回十四个信袋，两位受托人捐出卢比。"
    got = leaks(spark, [zh[5:40], zh[:8], "ab"], [(1, zh), (2, None), (3, ""), (4, "..."), (5, "ab"), (1, zh)])
    assert (0, 1) in got and (1, 1) not in got
    assert leaks(spark, [], [(1, PASSAGE)]) == [] and leaks(spark, ["a"], []) == []


# ---- sentences (p10) ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model(spark):
    return sentences.learn(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


@pytest.mark.parametrize(
    ("lang", "text", "want"),
    [
        ("en", 'Mr. Rao asked, "Who signed? And why?" and left. The list is final. It cost Rs. 5.50 at 9 a.m. Is it true?', 4),
        ("en", "The letter ended: \"Pay me. Or return my shares!\" Nobody replied.", 2),
        ("en", "Dear Investor,\n\n1. Signed claim form\nSd/- M. P. Rao", 3),
        ("de", "Die 2. Zahlung folgt am 9. Dezember 2023. Niemand antwortete.", 2),
        ("hi", "कुल 5 रु. में से आधी राशि ही बाँटी गई। कोई उत्तर नहीं मिला।", 2),
        ("zh", "登记员说：“名单已经定了。请不要再寄。”没有人答复。材料包括收据等……缺一不可。", 3),
        ("ja", "担当者は「名簿は確定しました。二度送らないでください。」と述べた。返事はなかった。", 2),
        ("th", "ไม่มีผู้ใดตอบกลับ จดหมายยังมาไม่ถึง", 2),
        (None, "", 0),
        ("en", "   \n ", 0),
    ],
)
def test_units(model, lang, text, want):
    got = sentences.units(text, lang, model)
    assert len(got) == want, [text[a:b] for a, b in got]


def test_units_cover_the_text(model):
    rnd = random.Random(6)
    bits = ["Mr. ", "“", "”", "。", "! ", "? ", "(", ")", "\n", "\n\n", "abc ", "Rs. 5 ", "... ", "未付", '"', "' ", "1. ", " | "]
    for _ in range(300):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40)))
        u = sentences.units(text, "en", model)
        assert all(a < b for a, b in u) and all(x[1] <= y[0] for x, y in zip(u, u[1:]))
        left = "".join(text[b:a] for b, a in zip([0, *[x[1] for x in u]], [*[x[0] for x in u], len(text)]))
        assert not left.strip()


def test_sentence_operator_odd_rows(spark):
    d = spark.createDataFrame([(1, "One. Two.", "en", 0), (2, None, None, 0), (3, "", "xx", 0), (4, "word " * 50_000, None, 0)], "doc_id long, text string, lang string, unit_start int")
    got = sentences.sentence_units(d).collect()
    assert {r["doc_id"] for r in got} <= {1, 4}
    assert sentences.sentence_units(d.limit(0)).count() == 0


# ---- queries -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(SF + "/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)
    assert got
    if name in queries.SQL:
        r = con.execute(queries.SQL[name])
        n = [d[0] for d in r.description]
        assert sorted((tuple(x[n.index(c)] for c in cols) for x in r.fetchall()), key=repr) == got


def test_edges_of_clashing_columns(spark):
    df = spark.createDataFrame([("a", "b", 1, 2)], "a string, b string, v int, u int")
    assert components.hash_to_min(df).count() == 2
    assert F.lit(1) is not None


def test_p4_looks_up_namesakes_in_slices(spark, monkeypatch):
    """Namesakes by the square are looked up in slices with the same rows as all at once; and pairs stand packed."""
    s = "id long, name string, address string, demat string"
    recs = [(i, "Ramesh Kumar Patil", f"{i} Lake Road, Pune 411001", f"IN300{i:011d}") for i in range(120)]
    docs = [(1000 + i, "Ramesh Kumar Patil", f"{i} Lake Road, Pune 411001", f"IN300{i:011d}" if i % 2 else None) for i in range(120)]
    docs += [(5000 + i, f"Q{'abcdefghijklmnopqrstuvwxyz'[i % 26]}x{'abcdefghijklmnopqrstuvwxyz'[i // 26]}", f"{i} Hill Road, Nashik 422001", None) for i in range(600)]
    terms = lambda rows: holders.checkpointed(crossmatch.termed(spark.createDataFrame(rows, s), {}))

    def matched(slice_):
        monkeypatch.setattr(crossmatch, "SLICE", slice_)
        got = crossmatch.compared(terms(recs), terms(docs), {})
        return sorted(tuple(round(x, 5) for x in r) for r in got.collect())

    monkeypatch.setattr(crossmatch, "SLICE", 20)
    *_, n, slices = crossmatch.indexed(terms(recs), terms(docs))
    assert n == 720 and slices > 3
    once, parts = matched(10**9), matched(20)
    assert once == parts and len(once) == 120 * 120
    assert {r[:2] for r in once if r[5]} >= {(i, 1000 + i) for i in range(120)}  # mutual
