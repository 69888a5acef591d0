"""Merge, de-duplication, look-up, store, snapshots and drift on small tables, odd cases included."""

import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import dedup, lookup, merge, store
from ledgerloom.operators.drift import consistent_cells, drift_report
from ledgerloom.operators.snapshots import snapshot_changes

T0 = datetime(2020, 1, 1)


def at(d):
    return datetime(2020, 1, d)


def snap(spark, rows):
    df = spark.createDataFrame(rows, "id long, holding_id long, financial_year string, shares double, recorded_at timestamp")
    return sorted(map(tuple, snapshot_changes(df).collect()))


def test_snapshot_changes(spark):
    rows = [
        (1, 1, "2014-15", 5.0, at(1)), (2, 1, "FY15-16", 5.0005, at(1)), (3, 1, "2017/18", 6.0, at(1)),
        (4, 2, "2014-15", 1.0, at(1)), (5, 3, "2015-16", None, at(1)), (6, 3, "2017-18", None, at(1)),
        (7, 4, "2014-15", 1.0, at(1)), (8, 4, "2015-16", None, at(1)), (9, 4, "2015-16", 2.0, at(3)), (10, 4, "2015-16", 1.0, at(2)),
        (11, 5, "2014-15", 1.0, at(1)), (12, 5, "2015-16", 1.0, at(1)), (13, 5, "2017-18", None, at(1)),
        (14, None, "2014-15", 1.0, at(1)), (15, 9, "unknown", 1.0, at(1)), (1, 1, "2014-15", 5.0, at(1)),
    ]
    assert snap(spark, rows) == [
        (1, "2017-18", "changed"), (2, "2015-16", "removed"), (3, "2015-16", "added"), (4, "2015-16", "changed"), (4, "2017-18", "removed"), (5, "2017-18", "changed"),
    ]


def test_snapshot_changes_ties_and_empty(spark):
    assert snap(spark, []) == []
    tie = [(1, 1, "2014-15", 1.0, at(1)), (2, 1, "2015-16", 1.0, at(2)), (3, 1, "2015-16", 9.0, at(2))]
    assert snap(spark, tie) == [(1, "2015-16", "changed")]
    null_time = [(1, 1, "2014-15", 1.0, None), (2, 1, "2014-15", 2.0, at(1)), (3, 1, "2015-16", 2.0, at(1))]
    assert snap(spark, null_time) == []


def test_snapshot_changes_against_brute_force(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.randint(1, 12), f"20{y}-{y + 1}", rnd.choice([None, 1.0, 1.0004, 2.0]), at(rnd.randint(1, 9))) for i in range(300) for y in [rnd.choice([10, 11, 14])]]
    last = {}
    for i, h, y, s, t in rows:
        last.setdefault(y, {})
        if h not in last[y] or (t, i) > last[y][h][1]:
            last[y][h] = (s, (t, i))
    want, years = [], sorted(last)
    for a, b in zip(years, years[1:]):
        for h in {*last[a], *last[b]}:
            if h not in last[a]:
                want.append((h, b, "added"))
            elif h not in last[b]:
                want.append((h, b, "removed"))
            else:
                x, y = last[a][h][0], last[b][h][0]
                if (x is None) != (y is None) or (x is not None and abs(x - y) > 0.001):
                    want.append((h, b, "changed"))
    assert snap(spark, rows) == sorted(want)


FILES = "file_id long, register_id long, company_name string, financial_year string, delivered_at timestamp, extra string"
RECORDS = "file_id long, row_no int, payload string, company_name string"


def drift(spark, files, records):
    f = spark.createDataFrame([(i, r, "x", y, T0, "e") for i, r, y in files], FILES)
    r = spark.createDataFrame([(i, n, p, "x") for i, n, p in records], RECORDS)
    return sorted(map(tuple, drift_report(f, r).collect()))


def lines(file, make, n=8):
    return [(file, k, make(k)) for k in range(1, n + 1)]


def test_drift_kinds(spark):
    a = lines(1, lambda k: f'{{"Folio No": "F{1000 + k * 37}", "Holder": "Name{k * 77}", "Units": {k * 113}, "Div 2019-20": {k}.5, "Old": "gone{k}"}}')
    b = lines(2, lambda k: f'{{"folio  no": "F{1000 + k * 37}", "Investor": "Name{k * 77}", "Units": "{k * 113}", "Div 2020-21": {k}.5, "New": {k * 999983}}}')
    assert drift(spark, [(1, 1, "2019-20"), (2, 1, "2020-21")], a + b) == [
        (2, "added", "", "Div 2020-21"), (2, "added", "", "New"), (2, "removed", "Div 2019-20", ""), (2, "removed", "Old", ""),
        (2, "renamed", "Holder", "Investor"), (2, "type_changed", "Units", "Units"),
    ]


def test_drift_odd_input(spark):
    assert drift(spark, [], []) == []
    a = [(1, 1, '{"A": null, "B": "-"}'), (1, 1, '{"A": null, "B": "-"}'), (1, 2, "broken"), (1, 3, None), (1, 4, "[1]")]
    b = [(2, 1, '{"A": 1, "B": "x"}')]
    assert drift(spark, [(1, 1, "2019-20"), (2, 1, "2020-21"), (3, 2, "bad year"), (4, 1, "2021-22")], a + b) == [(4, "removed", "A", ""), (4, "removed", "B", "")]


def test_consistent_cells_follow_renames(spark):
    files = spark.createDataFrame([(i, 1, "x", f"20{18 + i}-{19 + i}", T0, "") for i in (1, 2, 3)], FILES)
    rows = [r for i, h in ((1, "Holder"), (2, "Investor"), (3, "Member")) for r in lines(i, lambda k, h=h: f'{{"Folio": "F{5000 + k * 31}", "{h}": "Name{k * 77}"}}')]
    got = consistent_cells(files, spark.createDataFrame([(*r, "x") for r in rows], RECORDS))
    assert {r[0] for r in got.select("column_name").distinct().collect()} == {"Folio", "Holder"}
    assert got.count() == 48


def test_continuations(spark):
    rows = [("f", 1, "", "orphan"), ("f", 2, "A1", "1 Road"), ("f", 3, None, "Pune"), ("f", 4, "nan", "411001"), ("f", 5, "B2", "2 Road"), ("g", 1, "C", None)]
    df = spark.createDataFrame(rows, "file string, row int, folio string, address string")
    got = sorted((r["file"], r["folio"], r["address"], r["continued"]) for r in merge.merge_continuations(df, "file", "row", "folio", "address", ["address"]).collect())
    assert got == [("f", "A1", "1 Road Pune 411001", 2), ("f", "B2", "2 Road", 0), ("g", "C", "", 0)]


def test_consolidate_and_order(spark):
    df = spark.createDataFrame([("x", 1.0, 3.0, None, 7.0, "n2")], "name string, dividend_fy_2017_18 double, dividend_final_fy_2017_18 double, dividend_interim_fy_2017_18 double, dividend_fy_2018_19 double, name_1 string")
    got = merge.total_dividend(merge.consolidate(df)).first().asDict()
    assert got == {"name": "x", "dividend_fy_2017_18": 3.0, "dividend_fy_2018_19": 7.0, "total_dividend": 10.0}
    assert merge.ordered_columns(["z", "dividend_fy_2018_19", "a", "dividend_fy_2017_18"], [["a"]]) == ["a", "dividend_fy_2017_18", "dividend_fy_2018_19", "z"]


def test_numbering_is_the_global_order(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = {r["k"]: r["sr_no"] for r in merge.numbered(df, ["k"]).collect()}
    assert got == {k: k + 1 for k in range(1000)}


def test_append_is_idempotent(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, k string")
    once = merge.append_keep_last(a, a, ["k"], "id")
    assert sorted(map(tuple, once.collect())) == [(1, "x"), (2, "y")]


def greedy(pairs):
    gone, out = set(), []
    for i, j, best in sorted(pairs):
        if i in gone or j in gone:
            continue
        lost = j if best == i else i
        gone.add(lost)
        out.append((lost, best))
    return sorted(out)


def test_greedy_removals(spark):
    rnd = random.Random(1)
    pairs = [(i, j, rnd.choice([i, j])) for i in range(30) for j in range(i + 1, 30) if rnd.random() < 0.1]
    df = spark.createDataFrame([("b", *p) for p in pairs] + [("c", 100, 101, 101)], "block string, row_a long, row_b long, best_row long")
    assert sorted(map(tuple, dedup.greedy_removals(df).collect())) == sorted([*greedy(pairs), (100, 101)])


def test_set_pairs_against_all_pairs(spark):
    from ledgerloom.functions.similarity import token_set

    names = ["asha rao patil", "asha patil rao", "asha rao", "vinod mehta", "vinod k mehta", "zed alpha", ""]
    rows = [(i, n, f"{i % 2} mg road pune") for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "id int, name string, address string")
    got = {(r["row_a"], r["row_b"]) for r in dedup.set_similar_pairs(df, "id", "name", "address").collect()}
    want = {(a, b) for a, n, x in rows for b, m, y in rows if a < b and n and m and token_set(n, m) >= 85 and token_set(x, y) >= 85}
    assert got == want


def test_lookup_layers(spark):
    rows = spark.createDataFrame([("r1", "Asha Rao", "1 Road", "IN-1"), ("r2", "Rao Asha", "1 Road", None), ("r3", "Nobody", None, ""), ("r4", None, None, None)], "row_id string, name string, address string, account string")
    contacts = spark.createDataFrame([(7, "Zed", "x", "in 1"), (8, "Asha Rao", "1 Road", None), (9, "Asha Rao", "1 Road", None)], "contact_id long, name string, address string, account string")
    got = sorted(map(tuple, lookup.exact_then_fuzzy(rows, contacts).collect()))
    assert got == [("r1", 7, "account_exact", 100.0), ("r2", 8, "name_address_fuzzy", 100.0)]


def test_flags(spark):
    df = spark.createDataFrame([(600, 1.0), (1, 20000.0), (600, 20000.0), (None, None)], "h int, d double")
    c = {"h": F.col("h") >= 500, "d": F.col("d") >= 10000}
    assert [(r["is_flagged"], r["matched_criteria"]) for r in lookup.flag(df, c).collect()] == [(True, "h"), (True, "d"), (True, "h,d"), (False, "")]
    assert [r["is_flagged"] for r in lookup.flag(df, c, "and").collect()] == [False, False, True, False]
    assert not any(r["is_flagged"] for r in lookup.flag(df, {}).collect())


def test_upsert_and_absent(spark):
    old = spark.createDataFrame([("a", "x", 1, T0)], "folio string, co string, ord int, created timestamp")
    new = spark.createDataFrame([("a", "x", 2, at(5)), ("a", "x", 3, at(6)), ("", "x", 4, at(6)), ("b", "x", 5, at(7))], old.schema)
    got = sorted((r["folio"], r["ord"], r["created"], r["action"]) for r in store.upsert(old, new, ["folio", "co"], "ord", "created").collect())
    assert got == [("a", 3, T0, "updated"), ("b", 5, at(7), "inserted")]


@pytest.mark.parametrize(("values", "first"), [(["10", "9", "x"], "10"), (["b", "a", "1"], "b")])
def test_sort_key_by_majority(spark, values, first):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    n, t = store.sort_key(df, "v")
    assert df.orderBy(n.desc_nulls_last(), t.desc()).first()[0] == first


# ---- exact similarity joins --------------------------------------------------------------------


def slipped(rnd, n):
    syl = ["rav", "kum", "shan", "devi", "pat", "mish", "gup", "sin", "o"]
    out = set()
    while len(out) < n:
        t = " ".join("".join(rnd.choice(syl) for _ in range(rnd.randint(1, 3))) for _ in range(rnd.randint(1, 4)))
        out.add(t)
        i = rnd.randrange(len(t))
        out.add((t[:i] + rnd.choice(["", "x", " "]) + t[i + rnd.randint(0, 1) :]).strip() or "a")
    return [" ".join(sorted(t.split())) for t in sorted(out)]


@pytest.mark.parametrize(("sets", "least", "held"), [(False, 85.0, 2000), (False, 70.0, 2000), (True, 85.0, 2000), (False, 85.0, 5), (True, 80.0, 5)])
def test_alike_finds_every_pair(spark, sets, least, held):
    from ledgerloom.functions.similarity import plain, token_set
    from ledgerloom.operators.fuzzy import alike

    ts = sorted(set(slipped(random.Random(9), 90)))
    score = token_set if sets else plain
    df = spark.createDataFrame(list(enumerate(ts)) + [(900, None), (901, ""), (902, " ")], "id long, text string")
    got = {(r["l"], r["r"]): r["score"] for r in alike(df, None, least, sets, held).collect()}
    want = {(i, j): score(ts[i], ts[j]) for i in range(len(ts)) for j in range(i + 1, len(ts)) if score(ts[i], ts[j]) >= least}
    assert got == pytest.approx(want) and want
    other = spark.createDataFrame([(5, ts[0]), (6, ts[7] + "x")], "id long, text string")
    got = {(r["l"], r["r"]) for r in alike(df, other, least, sets, held).collect()}
    assert got == {(i, k) for i, t in enumerate(ts) for k, u in ((5, ts[0]), (6, ts[7] + "x")) if score(t, u) >= least}


@pytest.mark.parametrize(("rule", "sets", "held"), [("both", False, 65_536), ("both", True, 7), ("mean", False, 65_536), ("mean", False, 7)])
def test_joined_rows_keep_the_rule(spark, rule, sets, held):
    """Both texts bound a pair before it is scored, in blocks; against all pairs, with missing and odd texts."""
    from ledgerloom.functions.similarity import plain, token_set
    from ledgerloom.operators.fuzzy import alike_rows

    rnd = random.Random(4)
    ts, us = slipped(rnd, 40), slipped(rnd, 12)
    rows = [(i, ts[i % len(ts)] if i % 9 else ts[0] + "\u0939\U0001f600", rnd.choice([*us, "", None, " "][: len(us) + 3]), "ab"[i % 2]) for i in range(120)]
    rows += [(900, None, us[0], "a"), (901, " ", us[0], "a"), (902, ts[0], us[0], None)]
    score = token_set if sets else plain

    def keeps(t, m, u, w):
        s = score(t, u)
        if rule == "both":
            return bool(m and m.strip() and w and w.strip()) and s >= 85 and score(m, w) >= 85
        return (s + score(m, w)) / 2 >= 85 if m and w else s >= 85

    ok = [r for r in rows if r[1] and r[1].strip() and r[3]]
    df = spark.createDataFrame(rows, "id long, text string, more string, block string")
    got = sorted((r["l"], r["r"]) for r in alike_rows(df, None, 85.0, rule, sets, held).distinct().collect())
    assert got == sorted((x[0], y[0]) for x in ok for y in ok if x[0] < y[0] and x[3] == y[3] and keeps(*x[1:3], *y[1:3])) and got
    got = sorted((r["l"], r["r"]) for r in alike_rows(df.where("id % 3 = 0"), df.where("id % 4 = 0"), 85.0, rule, sets, held).distinct().collect())
    assert got == sorted((x[0], y[0]) for x in ok for y in ok if x[0] % 3 == 0 and y[0] % 4 == 0 and x[3] == y[3] and keeps(*x[1:3], *y[1:3]))


def test_pairs_of_many_alike_names_are_bounded_by_their_addresses(spark):
    """Names of which each is like each other are not scored pair by pair when their addresses rule them out."""
    from ledgerloom.operators import dedup, fuzzy

    scored = spark.sparkContext.accumulator(0)
    plain = fuzzy.plain

    def counting(a, b):
        scored.add(1)
        return plain(a, b)

    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(40))
    rows = [(i, f"shantaram kumar {i % 100:02d}", word()) for i in range(400)]
    rows.append((400, rows[5][1], rows[5][2][:-1] + "0"))
    fuzzy.plain = counting
    try:
        got = [tuple(r)[:2] for r in dedup.similar_pairs(spark.createDataFrame(rows, "id long, name string, address string"), "id", "name", "address").collect()]
    finally:
        fuzzy.plain = plain
    assert got == [(5, 400)]
    assert scored.value < 4_000  # of 80,200 pairs


def test_containing_either_way(spark):
    from ledgerloom.operators.fuzzy import containing

    a = spark.createDataFrame([("abc",), ("b",), ("xyzab",), ("",), (None,)], "a string")
    b = spark.createDataFrame([("ab",), ("zabcx",), ("q",), ("",)], "b string")
    assert sorted(map(tuple, containing(a, b, "a", "b").collect())) == [("abc", "ab"), ("abc", "zabcx"), ("b", "ab"), ("b", "zabcx"), ("xyzab", "ab")]


def test_fuzzy_queries_miss_nothing_on_whole_tables(spark):
    """Recall 1 of the fuzzy look-up and of the token-set pairs against all pairs of the smallest data."""
    import pandas as pd

    from ledgerloom.functions.similarity import plain, token_set
    from ledgerloom.plans import relational

    sf = "/root/testdata/sf0.001"
    got = {(r["row_a"], r["row_b"]) for r in relational.j05_set_pairs(spark, sf).collect()}
    p = pd.read_parquet(f"{sf}/persons.parquet")[["id", "name_raw", "address"]].dropna()
    first = {}
    for i, n, a in p.itertuples(index=False):
        k = (n.replace("\xa0", " ").lower(), re.sub(r"[\s,;]+", " ", a.replace("\xa0", " ")).lower())
        first[k] = min(i, first.get(k, i))
    rows = sorted((i, *k) for k, i in first.items())
    want = {(x[0], y[0]) for n, y in enumerate(rows) for x in rows[:n] if token_set(x[1], y[1]) >= 85 and token_set(x[2], y[2]) >= 85}
    assert got == want
    f = pd.read_parquet(f"{sf}/shareholders_filtered.parquet")
    c = pd.read_parquet(f"{sf}/inhouse_contacts.parquet")
    norm = lambda s: " ".join(sorted(re.sub(r"[\s,;]+", " ", s.replace("\xa0", " ")).lower().split())) if isinstance(s, str) else ""
    acc = lambda s: re.sub(r"[^A-Za-z0-9]", "", s).upper() if isinstance(s, str) else ""
    known = {acc(x) for x in c.demat_no if acc(x)}
    cs = [(i, norm(n), norm(a)) for i, n, a in zip(c.id, c.name, c.address) if norm(n)]
    best = {}
    for k, n, a, d in zip(f.folio_no, f.name, f.address, f.demat_account):
        n, a = norm(n), norm(a)
        if acc(d) in known or not n:
            continue
        scored = [((plain(n, m) + plain(a, b)) / 2 if a and b else plain(n, m), -i) for i, m, b in cs]
        s, i = max(scored)
        if s >= 85:
            best[k] = -i
    got = {r["row_id"]: r["contact_id"] for r in relational.j02_exact_then_fuzzy(spark, sf).where("match_type = 'name_address_fuzzy'").collect()}
    assert got == best


# ---- presets, layers, star, search -------------------------------------------------------------


def test_presets(spark):
    df = spark.createDataFrame([(1, 600, 5.0, None, 3.0), (2, 5000, 200000.0, " hni ", None), (3, None, None, "Public", 900.0)], "id long, current_holding long, total_dividend double, investor_type string, dividend_2014_15 double")
    got = lambda *a, **k: {r["id"]: r["matched_criteria"] for r in lookup.flag_preset(df, *a, **k).where("is_flagged").collect()}
    assert got("high_value") == {1: "current_holding", 2: "current_holding,total_dividend"}
    assert got("ultra_high_value") == {2: "current_holding,total_dividend"}
    assert got("custom") == {}
    assert got("custom", investor_type="HNI") == {2: "investor_type"}
    assert got("custom", single_year=100) == {3: "single_year_dividend"}
    assert lookup.flag_preset(df, "custom").count() == 3
    for bad in (lambda: lookup.flag_preset(df, "nosuch"), lambda: lookup.flag_preset(df, "custom", nosuch=1)):
        with pytest.raises(ValueError):
            bad()


def test_layers_stop_at_the_first_hit(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    layer = lambda *x: spark.createDataFrame(list(x), "k string, phone string")
    got = sorted(map(tuple, lookup.layered(rows, "k", [layer(("a", "1")), layer(("a", "2"), ("b", "3"))]).fillna("-", ["k", "phone"]).select("k", "phone", "contact_layer").collect()))
    assert got == [("-", "-", 0), ("a", "1", 1), ("b", "3", 2), ("c", "-", 0)]


def test_star_and_counts_of_odd_lines(spark):
    s = "id long, name string, company string, folio string, year string, shares long, amount double"
    rows = [(1, "A B", "X", "f1", "2014", 5, 1.0), (2, "a b", "x ", "F1", "2014", 6, 2.0), (3, "A B", "X", None, None, 7, 3.0), (4, " ", "X", "f", "2014", 1, 1.0), (5, "C", None, "f", "2014", 1, 1.0), (6, "D", "X", "f2", "2015", None, 0.0)]
    n = {k: df.count() for k, df in store.star(spark.createDataFrame(rows, s), "id").items()}
    assert n == {"persons": 2, "companies": 1, "holdings": 3, "snapshots": 2, "dividends": 1}
    assert all(df.count() == 0 for df in store.star(spark.createDataFrame([], s), "id").values())
    old = spark.createDataFrame([("1", "x")], "k string, v string")
    new = spark.createDataFrame([("1", "y"), ("1", "z"), ("2", "a"), ("2", "b"), (" ", "c"), (None, "d")], "k string, v string")
    assert tuple(store.upsert_counts(old, new, ["k"]).first()) == (1, 3, 2)
    assert tuple(store.upsert_counts(old, new.limit(0), ["k"]).first()) == (0, 0, 0)
    assert sorted(map(tuple, store.replaced(spark.createDataFrame([("1", 1), ("1", 2), ("", 3), (None, 4)], "k string, o long"), "k", "o").collect())) == [("1", 2)]


def test_search_with_a_bad_amount_and_beyond_the_end(spark):
    df = spark.createDataFrame([(i, "Acme", f"name {i}", float(i)) for i in range(10)], "id long, company_name string, name string, w double")
    got = store.search(df, " ACME", "NAME", ["name"], "w", "plenty", [F.asc("id")], 2, 4).collect()
    assert [r["id"] for r in got] == [4, 5, 6, 7] and got[0]["total"] == 10 and got[0]["pages"] == 3
    assert store.search(df, "none", None, ["name"], "w", None, [F.asc("id")], 1, 4).count() == 0


def test_best_row_of_a_hot_key(spark):
    df = spark.createDataFrame([(i, "k" if i % 3 else None, i % 7) for i in range(300)], "id long, k string, v long")
    got = sorted(r["id"] for r in dedup.keep_best(df, F.col("k"), [F.desc("v"), F.asc("id")]).collect())
    assert got == sorted([13] + [i for i in range(0, 300, 3)])


def test_sql_functions(spark):
    from ledgerloom.functions import sql
    from ledgerloom.functions import text as T

    names = sql.register(spark)
    df = spark.createDataFrame([(x,) for x in ("  o'neil  D.K. ", None, "", "₹ 1,234.50", "AB 12 c", "list-2014_15.pdf", "ÅSA é")], "s string")
    same = {"ll_squeeze": T.squeeze, "ll_title_case": T.title_case, "ll_slug": T.slug, "ll_clean_folio": T.clean_folio, "ll_to_float": T.to_float, "ll_identity_name": T.identity_name, "ll_upload_year": T.upload_year}
    assert sorted(same) == names
    df.createOrReplaceTempView("odd_texts")
    for n, f in same.items():
        assert [r[0] for r in spark.sql(f"SELECT {n}(s) FROM odd_texts").collect()] == [r[0] for r in df.select(f("s")).collect()], n


def test_file_and_link_names(spark):
    from ledgerloom.functions import text as T

    df = spark.createDataFrame([("Acme_Steel_IEPF_2019.pdf", "https://a.example/x/Acme list 2018.pdf?y=1"), ("ab_2011.pdf", "https://a.example/"), (".pdf", "nothing"), (None, None)], "f string, u string")
    got = [tuple(r) for r in df.select(T.upload_company("f"), T.upload_year("f"), T.link_year("u"), T.download_name("u", F.lit("c"), F.lit("y"))).collect()]
    assert got[0] == ("acme-steel", "2019", "2018", "c_y_Acme_list_2018.pdf")
    assert got[1] == ("unknown", "2011", "unknown", "c_y_document.pdf")
    assert got[2][:3] == ("unknown", "unknown", "unknown") and got[3][1] == "unknown"


def test_greedy_removals_of_all_similar_pairs(spark):
    """d02 against all pairs: names that begin differently, copies of one text, and chains across beginnings are in it."""
    from ledgerloom.functions.similarity import plain

    rnd = random.Random(3)
    street = ["12 lake road pune 411001", "12 lake road, pune 411001", "12 lake raod pune 411001", "9 hill street nashik 422001"]
    rows = [(1, "Shantaram Kulkarni", street[0]), (2, "Hsantaram Kulkarni", street[1]), (3, "Asha Rao", street[3]), (4, "asha  rao", street[3]), (5, "Asha Rao", street[3]), (6, "Kulkarni Shantaram", street[2]), (7, "", street[0]), (8, "Asha Rao", None)]
    for i in range(10, 150):
        name = list(rnd.choice(["shantaram kulkarni", "asha vinod rao", "vinod rao patil"]))
        for _ in range(rnd.randrange(3)):
            name[rnd.randrange(len(name))] = rnd.choice("abcdefgh ")
        rows.append((i, "".join(name), rnd.choice(street)))
    df = spark.createDataFrame(rows, "id long, name string, address string")
    text = lambda x: " ".join(sorted(re.sub(r"[\s,;]+", " ", x).lower().split()))
    whole = [(i, text(n), text(a), len(n) + len(a)) for i, n, a in rows if n and a]
    pairs = [(x[0], y[0], y[0] if y[3] > x[3] else x[0]) for x in whole for y in whole if x[0] < y[0] and plain(x[1], y[1]) >= 85 and plain(x[2], y[2]) >= 85]
    got = sorted(map(tuple, dedup.greedy_similar(df, "id", "name", "address").collect()))
    assert got == greedy(pairs)
    assert {2, 4, 5} <= {lost for lost, _ in got} | {kept for _, kept in got}
