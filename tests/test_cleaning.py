import datetime as dt

import pytest

from stratamart import fixed_values as V
from stratamart.functions import cleaning as C

DAY = dt.date


def apply(spark, values, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r.o for r in df.select("i", make("c").alias("o")).orderBy("i").collect()]


def test_trim_strings_takes_spaces_only_and_leaves_other_types(spark):
    df = spark.createDataFrame([("  a b ", "\tx\r", 1)], "s string, t string, n int")
    out = C.trim_strings(df)
    assert tuple(out.first()) == ("a b", "\tx\r", 1)
    assert out.columns == ["s", "t", "n"]


def test_rename_ignores_case_and_missing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "CID int, other int")
    assert C.rename_columns(df, V.RENAME_LOCATION).columns == ["customer_number", "other"]


@pytest.mark.parametrize("codes, given, expected", [
    (V.MARITAL_STATUS, ["S", "s", "M", "m", "", None, "X"],
     ["Single", "Single", "Married", "Married", "n/a", "n/a", "n/a"]),
    (V.GENDER_CODES, ["M", "f", "FEMALE", None], ["Male", "Female", "n/a", "n/a"]),
    (V.GENDER_SYNONYMS, ["F", "female", "Male", "m", "", None],
     ["Female", "Female", "Male", "Male", "n/a", "n/a"]),
    (V.PRODUCT_LINES, ["M", "r", "S", "t", "", None, "Q"],
     ["Mountain", "Road", "Other Sales", "Touring", "n/a", "n/a", "n/a"]),
])
def test_map_codes(spark, codes, given, expected):
    assert apply(spark, given, "string", lambda c: C.map_codes(c, codes)) == expected


def test_country_codes_keep_case_and_pass_names_through(spark):
    given = ["DE", "US", "USA", "de", "", None, "France"]
    expected = ["Germany", "United States", "United States", "de", "n/a", "n/a", "France"]
    got = apply(spark, given, "string", lambda c: C.map_codes(
        c, V.COUNTRIES, ignore_case=False, passthrough=True))
    assert got == expected


def test_literals_are_quoted(spark):
    codes = {"it's": "a\\b", "x": "it's"}
    assert apply(spark, ["it's", "X", "x"], "string", lambda c: C.map_codes(
        c, codes, ignore_case=False)) == ["a\\b", "n/a", "it's"]


def test_yes_no(spark):
    assert apply(spark, ["Yes", "NO", "", None, "maybe"], "string", C.yes_no) == [
        True, False, None, None, None]


def test_product_key_parts(spark):
    given = ["CO-RF-FR-R92B-58", "AC-HE-HL", "AB", None]
    assert apply(spark, given, "string", C.category_of) == ["CO_RF", "AC_HE", "AB", None]
    assert apply(spark, given, "string", C.number_of) == ["FR-R92B-58", "HL", "", None]


def test_key_repairs(spark):
    assert apply(spark, ["NASAW1", "AW1", "NAS", None], "string",
                 lambda c: C.strip_prefix(c, "NAS")) == ["AW1", "AW1", "", None]
    assert apply(spark, ["AW-1-2", "x", None], "string",
                 lambda c: C.remove_chars(c, "-")) == ["AW12", "x", None]
    assert apply(spark, [None, 0, 7], "int", C.default_zero) == [0, 0, 7]


def test_date_code(spark):
    given = [20101229, 0, 32154, 20101332, 20110229, 20120229, -2010101, None, 201012290]
    expected = [DAY(2010, 12, 29), None, None, None, None, DAY(2012, 2, 29), None, None, None]
    assert apply(spark, given, "int", C.date_code) == expected


def test_date_code_from_text(spark):
    given = ["20101229", "0", "", "abc", "2010-1-1", None]
    assert apply(spark, given, "string", C.date_code) == [DAY(2010, 12, 29)] + [None] * 5


def test_as_date(spark):
    assert apply(spark, ["2013-07-01", "nope", None], "string", C.as_date) == [
        DAY(2013, 7, 1), None, None]


def test_ordered_range_swaps_only_inverted_closed_ranges(spark):
    early, late = DAY(2007, 12, 28), DAY(2011, 7, 1)
    df = spark.createDataFrame(
        [(1, late, early), (2, early, late), (3, late, None), (4, early, early), (5, None, early)],
        "i int, s date, e date")
    start, end = C.ordered_range("s", "e")
    got = [(r.a, r.b) for r in df.select("i", start.alias("a"), end.alias("b"))
           .orderBy("i").collect()]
    assert got == [(early, late), (early, late), (late, None), (early, early), (None, early)]


def test_null_future_keeps_the_day_itself(spark):
    as_of = DAY(2020, 1, 1)
    given = [DAY(2020, 1, 1), DAY(2020, 1, 2), DAY(1950, 1, 1), None]
    assert apply(spark, given, "date", lambda c: C.null_future(c, as_of)) == [
        DAY(2020, 1, 1), None, DAY(1950, 1, 1), None]
    assert apply(spark, [DAY(2999, 1, 1)], "date", C.null_future) == [None]


def test_repaired_price(spark):
    cases = [  # price, sales, quantity → price
        (10, 100, 2, 10.0), (None, 100, 4, 25.0), (0, 9, 2, 4.5), (-5, 9, 3, 3.0),
        (None, 100, 0, None), (None, 100, None, None), (None, None, 2, None), (-1, -8, 2, -4.0),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)],
                               "i int, p int, s int, q int, want double")
    out = df.select("i", C.repaired_price("p", "s", "q").alias("o"))
    assert dict(out.dtypes)["o"] == "double"
    assert [r.o for r in out.orderBy("i").collect()] == [c[3] for c in cases]


def test_prefer(spark):
    df = spark.createDataFrame(
        [(1, "Male", "Female"), (2, "n/a", "Female"), (3, "n/a", None), (4, None, "Male"),
         (5, None, None)], "i int, p string, f string")
    out = df.select("i", C.prefer("p", "f").alias("o")).orderBy("i")
    assert [r.o for r in out.collect()] == ["Male", "Female", "n/a", "Male", "n/a"]
