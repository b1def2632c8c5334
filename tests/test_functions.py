"""Column expressions, above all the places where missing values behave unexpectedly."""

import math

import pytest
from pyspark.sql import functions as F

from weftable import classification as c
from weftable.functions import recode
from weftable.functions.aggregates import null_sum, row_total, zero_sum
from weftable.functions.labels import finite_or_null, lenient_double, split_id, unite_id
from weftable.operators.fold import fold_countries, kept_countries


def one(df):
    return [r[0] for r in df.collect()]


def test_null_sum_propagates_and_zero_sum_does_not(spark, rows):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("b", 1.0), ("b", None), ("c", None)], "k string, v double"
    )
    assert rows(df.groupBy("k").agg(null_sum("v").alias("v"))) == [("a", 3.0), ("b", None), ("c", None)]
    assert rows(df.groupBy("k").agg(zero_sum("v").alias("v"))) == [("a", 3.0), ("b", 1.0), ("c", 0.0)]


def test_null_sum_survives_two_stages(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 2, None), ("b", 1, 2.0), ("b", 2, 3.0)], "k string, j int, v double"
    )
    staged = df.groupBy("k", "j").agg(null_sum("v").alias("v")).groupBy("k").agg(null_sum("v").alias("v"))
    assert rows(staged) == [("a", None), ("b", 5.0)]


def test_null_sum_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert one(empty.agg(null_sum("v"))) == [None]
    assert one(empty.agg(zero_sum("v"))) == [0.0]


def test_row_total(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (1.0, None, 3.0)], "a double, b double, c double")
    assert one(df.select(row_total("a", "b", "c"))) == [6.0, None]


def test_unite_writes_missing_parts(spark):
    df = spark.createDataFrame([("AT", "X"), ("AT", None), (None, None)], "a string, b string")
    assert one(df.select(unite_id("a", "b"))) == ["AT_X", "AT_NA", "NA_NA"]
    assert one(df.select(unite_id("a", "b", sep="@"))) == ["AT@X", "AT@NA", "NA@NA"]


def test_split_at_first_separator(spark):
    df = spark.createDataFrame([("AT_C31_32",), ("AT",), (None,)], "id string")
    head, rest = split_id("id")
    assert [tuple(r) for r in df.select(head, rest).collect()] == [
        ("AT", "C31_32"),
        ("AT", None),
        (None, None),
    ]


def test_split_takes_separator_literally(spark):
    df = spark.createDataFrame([("a.b.c",)], "id string")
    head, rest = split_id("id", sep=".")
    assert tuple(df.select(head, rest).first()) == ("a", "b.c")


def test_lenient_double(spark):
    df = spark.createDataFrame([(" 1.5 ",), ("-2e3",), ("x",), ("",), (None,)], "t string")
    assert one(df.select(lenient_double("t"))) == [1.5, -2000.0, None, None, None]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,), (None,)], "v double")
    assert one(df.select(finite_or_null("v"))) == [1.0, None, None]


@pytest.mark.parametrize("as_table", [True, False])
def test_fold_sends_unknown_and_null_to_rest(spark, as_table):
    df = spark.createDataFrame([("AT",), ("XX",), (None,), ("AT",)], "country string")
    kept = spark.createDataFrame([("AT",), ("AT",), ("ROW",)], "country string") if as_table else ["AT"]
    folded = fold_countries(df, kept, ["country"])
    assert sorted(one(folded)) == ["AT", "AT", "ROW", "ROW"]


def test_kept_countries(spark):
    df = spark.createDataFrame([("AT",), ("WA",), ("TW",), ("AT",)], "Pays string")
    assert sorted(one(kept_countries(df))) == ["AT", "ROW"]


def test_section_recode(spark):
    codes = {
        "B05_06": "BZ",
        "T": "TZ",
        "GGFC": "GZ",
        "A01_02": "A01T02",
        "A01T02": "A01T02",
        "A03": "A03",
        "C17_18": "C17T18",
        "C31T33": "CM",
        "D": "D35",
        "J58T60": "JA",
        "J61": "J61",
        "J62_63": "JC",
        "J62T63": "JC",
        "H49": "H49",
    }
    df = spark.createDataFrame([(k,) for k in codes], "code string")
    assert one(df.select(recode.section_recode("code"))) == list(codes.values())


def test_section_recode_compat_knows_listed_spelling_only(spark):
    df = spark.createDataFrame([("J62_63",), ("J62T63",), ("A01T02",), ("D",)], "code string")
    assert one(df.select(recode.section_recode("code", compat=True))) == ["JC", "J62T63", "A01T02", "D35"]


def test_every_wide_code_ends_in_the_classification(spark):
    wide = ["A01_02", "A03", "B05_06", "C10T12", "C17_18", "C31T33", "D", "E", "F", "G", "H49", "I"]
    wide += ["J58T60", "J61", "J62_63", "K", "L", "M", "N", "O", "P", "Q", "R", "S", "T"]
    df = spark.createDataFrame([(k,) for k in wide], "code string")
    assert set(one(df.select(recode.section_recode("code")))) <= set(c.INDUSTRIES)


def test_iso2(spark):
    df = spark.createDataFrame([("AUT",), ("GRC",), ("GBR",), ("XXX",), (None,)], "code string")
    assert one(df.select(recode.iso2("code"))) == ["AT", "GR", "GB", None, None]


def test_demand_components(spark):
    wide = spark.createDataFrame([(k,) for k in c.WIDE_DEMAND_CODES], "code string")
    assert one(wide.select(recode.wide_demand_component("code"))) == [
        "P3_S14", "P3_S15", "P3_S13", "P51G", "P5M", "P5M",
    ]
    matrix = spark.createDataFrame(
        [("Changes in valuables",), ("Exports: Total (fob)",), (None,)], "label string"
    )
    assert one(matrix.select(recode.matrix_demand_component("label"))) == ["P5M", None, None]


def test_value_added_components(spark):
    matrix = spark.createDataFrame([(c.MATRIX_TAX_LABEL,), ("Compensation",)], "label string")
    assert one(matrix.select(recode.matrix_value_added_component("label"))) == ["TLS", "VA"]
    flat = spark.createDataFrame([("D21X31",), ("D1",)], "code string")
    assert one(flat.select(recode.flat_value_added_component("code"))) == ["TLS", "VA"]


def test_warming_potential_first_rule_wins(spark):
    df = spark.createDataFrame(
        [
            ("HFC - air", "kg CO2-eq"),
            ("CH4 - as CO2", "kg"),
            ("CH4 - air", "kg"),
            ("N2O - air", "kg"),
            ("SF6 - air", "kg"),
            ("NOx - air", "kg"),
            ("CH4 - air", None),
        ],
        "stressor string, unit string",
    )
    assert one(df.select(recode.warming_potential("stressor", "unit"))) == [1, 1, 28, 265, 23500, 0, 28]


def test_fixed_values_are_consistent():
    assert len(c.COUNTRIES) == len(set(c.COUNTRIES)) == 44
    assert len(c.INDUSTRIES) == len(set(c.INDUSTRIES)) == 44
    assert {industry for _, industry, _ in c.INDUSTRY_MAP} == set(c.INDUSTRIES)
    by_code = {}
    for _, industry, codes in c.INDUSTRY_MAP:
        for code in codes:
            assert by_code.setdefault(code, industry) == industry
    table = recode.iso3_to_iso2()
    assert set(table.values()) >= set(c.COUNTRIES) - {c.REST_OF_WORLD}
    assert len(table) >= 249 and (table["SAU"], table["TWN"], table["KEN"]) == ("SA", "TW", "KE")


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "v double")
    assert one(df.select(F.bround("v"))) == [0.0, 2.0, 2.0]
