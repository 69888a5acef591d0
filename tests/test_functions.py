"""Vectors for the scalar functions, and random equivalence with plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import registers as R
from ledgerloom.functions import similarity as S
from ledgerloom.functions import text as T


def one(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in sorted(rows.select("i", f(F.col("v")).alias("r")).collect())]


def loop_clean(s):
    """The loop the closed form stands for."""
    words = (s or "").upper().split()
    for _ in range(4):
        if not words or not re.search("[0-9]", words[0]):
            break
        tail = re.search("([^0-9]*)$", words[0])[1]
        if len(tail) >= 2:
            words[0] = tail
            break
        words.pop(0)
    return "".join(w[:1].upper() + w[1:].lower() for w in re.findall("[^\\W\\d_]+|[\\W\\d_]+", " ".join(words)))


def test_clean_name_equals_the_loop(spark):
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("ab1 2x") for _ in range(rnd.randint(1, 5)))
    values = [None, "", "   ", "12 34 56 78 9", *[" ".join(word() for _ in range(rnd.randint(1, 7))) for _ in range(300)]]
    assert one(spark, values, T.clean_name) == [loop_clean(v) for v in values]


@pytest.mark.parametrize(
    ("f", "pairs"),
    [
        (T.title_case, [("d.k. o'neil mc2donald", "D.K. O'Neil Mc2Donald"), ("", "")]),
        (T.parse_amount, [("1,23,456.78", 123456.78), ("₹750.00", 750.0), ("3 9 2 . 0 0", 392.0), ("", 0.0), (None, 0.0), ("5d", 0.0), ("n/a", 0.0)]),
        (T.to_int, [("1,000", 1000), (" 2 500 ", 2500), ("-7.9", -7), ("x", 0), (None, 0)]),
        (T.iso_date, [("2020-04-03", "2020-04-03"), ("03-04-2020", "2020-04-03"), ("03/04/2020", "2020-03-04"), ("25/04/2020", "2020-04-25"), ("2020-02-31", ""), ("", ""), (None, "")]),
        (T.slug, [("  A & B Ltd. ", "a-b-ltd"), (None, "")]),
        (T.file_year, [("x_2017-18.pdf", "2017-18"), ("x_2017-2018.pdf", "2017-18"), ("IEPF_2022_X.pdf", "2022"), ("none.pdf", "unknown")]),
        (T.file_company, [("acme_2017-18.pdf", "Acme"), ("iepf_2020_zz.pdf", "Iepf 2020 Zz"), ("2020_x.pdf", "2020 X")]),
        (T.sheet_name, [("A/B: C", "A_B__C"), ("", "Sheet"), (None, "Sheet"), ("x" * 40, "x" * 31)]),
        (R.folio_key, [("Folio No. E180351094", "E180351094"), ("0005053031", "5053031"), ("6OO128172", "600128172"), ("d-328505854", "D328505854"), ("N.A.", None), ("", None), (None, None)]),
        (R.company_key, [(" ACME Power Ltd.", "acme power"), ("Acme  Power Limited (Unit: Registry)", "acme power"), (None, None), ("  ", None)]),
        (R.demat_client, [("DPID: IN910001 CLID: 66169519", "66169519"), ("XXXXXXXX00162235", "00162235"), ("12", None), (None, None)]),
        (R.fy_start, [("FY14-15", 2014), ("F.Y. 2014-2015", 2014), ("2014–15", 2014), ("2014_15", 2014), ("2014-17", None), ("NA", None), (None, None)]),
    ],
)
def test_vectors(spark, f, pairs):
    assert one(spark, [a for a, _ in pairs], f) == [b for _, b in pairs]


def test_phones(spark):
    got = one(spark, ["+91-98765-43210", "9876543210", "0091 9876543210", "091-9876543210", "09876543210", "12345", "5123456789", None], T.phone)
    assert [g["number"] for g in got] == ["+919876543210"] * 5 + ["", "", ""]
    assert [g["status"] for g in got][5:] == ["invalid_format", "not_mobile", "invalid_format"]


def test_name_parts_and_address(spark):
    got = one(spark, ["A", "A B", "A B C D", "", None], T.name_parts)
    assert [tuple(g) for g in got] == [("A", "", ""), ("A", "", "B"), ("A", "B C", "D"), ("", "", ""), ("", "", "")]
    row = spark.createDataFrame([("1 x ", None, " y  z", "")], "a string, b string, c string, d string").select(T.join_address(["a", "b", "c", "d"])).first()[0]
    assert row == "1 x, y z"
    assert tuple(one(spark, ["1 Road, Pune , MH"], T.city_state)[0]) == ("Pune", "MH")


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_bit_parallel_lcs_is_lcs(spark):
    rnd = random.Random(3)
    pairs = [("".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 90))), "".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 90)))) for _ in range(200)]
    assert all(S.lcs(a, b) == slow_lcs(a, b) for a, b in pairs)
    few = [(a[:12], b[:12]) for a, b in pairs[:20]]
    df = spark.createDataFrame(few, "a string, b string").select(S.lcs_native(F.col("a"), F.col("b")).alias("n"), "a", "b").collect()
    assert all(r["n"] == slow_lcs(r["a"], r["b"]) for r in df)


def test_scores():
    assert S.token_sort("b a", "a b") == 100.0
    assert S.token_set("a b c", "a b") == 100.0
    assert S.token_set("", "a") == 0.0
    assert S.plain("", "") == 100.0
    assert round(S.plain("abcd", "abxd"), 4) == 75.0
