"""Operators that are not part of the worked example."""

import pytest
from pyspark.sql import functions as F

from weftable.operators import checks, compare, convert, lookup, reshape
from weftable.operators.crosswalk import build_crosswalk, code_industries, grid, hybrid_grid, source_industries


def test_build_crosswalk(spark, rows):
    one_hot = spark.createDataFrame(
        [
            ("AT", "Austria", "i1", "Farm", "x", 1, 0, 0, 0, 0),
            ("DE", "Germany", "i1", "Farm", "x", 1, 0, 0, 0, 0),
            ("AT", "Austria", "i2", "Mine", "x", 0, 1, 1, 0, 0),
            ("AT", "Austria", "i3", "Extra-territorial organizations and bodies", "x", 0, 0, 0, 1, 0),
            ("AT", "Austria", "i4", "None", "x", 0, 0, 0, 0, None),
            ("AT", "Austria", "i5", "Odd", "x", 0, 0, 0, 0, 1),
        ],
        "Pays string, PaysLib string, ExioCode string, Lib string, vrai_code string, "
        "D01T02 int, D05T06 int, D07T08 int, D84 int, D00 int",
    )
    crosswalk = build_crosswalk(one_hot)
    extra = "Extra-territorial organizations and bodies"
    assert rows(crosswalk, "src", "raw_industry", "industry", "code") == sorted(
        [
            (extra, "D99", "UZ", "U"),
            ("Farm", "D01T02", "A01T02", "A01"),
            ("Farm", "D01T02", "A01T02", "A02"),
            ("Mine", "D05T06", "BZ", "B"),
            ("Mine", "D07T08", "BZ", "B"),
        ],
        key=str,
    )
    assert rows(source_industries(crosswalk)) == [(extra, "UZ"), ("Farm", "A01T02"), ("Mine", "BZ")]
    assert rows(code_industries(crosswalk)) == [("A01", "A01T02"), ("A02", "A01T02"), ("B", "BZ"), ("U", "UZ")]


def test_grid_has_no_join(spark, rows):
    df = spark.createDataFrame([("p",), ("q",)], "src string")
    values = spark.createDataFrame([("b",), ("a",), ("a",)], "v string")
    assert rows(grid(df, "k", values)) == [("p", "a"), ("p", "b"), ("q", "a"), ("q", "b")]
    assert rows(grid(df, "k", ["a"])) == [("p", "a"), ("q", "a")]
    plan = grid(df, "k", values)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_hybrid_grid_is_ordered(spark):
    countries = spark.createDataFrame([("DE",), ("AT",)], "country string")
    industries = spark.createDataFrame([("X",), ("A",), ("X",)], "industry string")
    assert [tuple(r) for r in hybrid_grid(countries, industries).collect()] == [
        ("AT", "A"), ("AT", "X"), ("DE", "A"), ("DE", "X"),
    ]


def test_compare_joins_all_and_fills(spark, rows):
    schema = "id string, component string, value double"
    a = spark.createDataFrame([("x", "VA", 1.0), (None, "VA", 5.0)], schema)
    b = spark.createDataFrame([("x", "VA", 2.0), ("y", "VA", 3.0), (None, "VA", None)], schema)
    c = spark.createDataFrame([("z", "TLS", 4.0)], schema)
    compared = compare.compare_sources({"A": a, "B": b, "C": c}, ["id", "component"])
    assert rows(compared, "id", "component", "A", "B", "C") == [
        (None, "VA", 5.0, 0.0, 0.0),
        ("x", "VA", 1.0, 2.0, 0.0),
        ("y", "VA", 0.0, 3.0, 0.0),
        ("z", "TLS", 0.0, 0.0, 4.0),
    ]


def test_compare_equals_chained_full_joins(spark, rows):
    schema = "id string, value double"
    parts = {
        name: spark.createDataFrame([(f"k{i}", float(i)) for i in range(0, 30, step)], schema)
        for name, step in (("A", 2), ("B", 3), ("C", 5))
    }
    joined = None
    for name, df in parts.items():
        named = df.withColumnRenamed("value", name)
        joined = named if joined is None else joined.join(named, "id", "full")
    expected = joined.na.fill(0.0, list(parts))
    assert rows(compare.compare_sources(parts, ["id"])) == rows(expected)


def test_single_source_is_left_as_it_is(spark, rows):
    df = spark.createDataFrame([("x", None), ("y", 1.0)], "id string, value double")
    assert rows(compare.compare_sources({"A": df}, ["id"])) == [("x", None), ("y", 1.0)]
    with pytest.raises(ValueError):
        compare.compare_sources({}, ["id"])


def rates(spark, *rows_):
    return spark.createDataFrame(list(rows_), "TIME_PERIOD int, LOCATION string, OBS_VALUE double")


def test_convert_matching_columns(spark):
    df = spark.createDataFrame([(2.0, 4.0, 8.0)], "value double, my_VALUE double, other double")
    table = rates(spark, (2020, "EU27_2020", 0.5), (2019, "EU27_2020", 9.0), (2020, "GBR", 7.0))
    assert tuple(convert.convert_currency(df, convert.rate_of(table, 2020)).first()) == (1.0, 2.0, 8.0)
    assert tuple(convert.convert_currency(df, 0.25, "^other$").first()) == (2.0, 4.0, 2.0)


@pytest.mark.parametrize("table", [[], [(2020, "EU27_2020", 0.5), (2020, "EU27_2020", 0.6)]])
def test_rate_must_be_unique(spark, table):
    df = spark.createDataFrame([(2.0,)], "value double")
    found = rates(spark, *table) if table else spark.createDataFrame([], rates(spark, (1, "x", 1.0)).schema)
    with pytest.raises(Exception, match="one exchange rate"):
        convert.convert_currency(df, convert.rate_of(found, 2020)).collect()


def test_gas_factors(spark, rows):
    units = spark.createDataFrame(
        [("CO2 - air", "kg"), ("CO2 - air", "kg"), ("PFC", "kg CO2-eq"), ("Pb", "kg")], "stressor string, unit string"
    )
    assert rows(convert.gas_factors(units)) == [("CO2 - air", 1), ("PFC", 1), ("Pb", 0)]


def test_lookup_takes_the_first_and_keeps_the_facts(spark, rows):
    facts = spark.createDataFrame([("a", 1), ("a", 2), ("z", 3)], "k string, n int")
    dimension = spark.createDataFrame([("a", "late", 9), ("a", "early", 1), ("b", "x", 1)], "k string, v string, o int")
    assert rows(lookup.lookup(facts, dimension, ["k"], "o"), "k", "n", "v") == [
        ("a", 1, "early"), ("a", 2, "early"), ("z", 3, None),
    ]


def test_membership(spark, rows):
    facts = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    listed = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(lookup.keep_listed(facts, listed, ["k"])) == [("a",)]
    assert rows(lookup.drop_listed(facts, listed, ["k"])) == [(None,), ("b",)]


def test_reshape(spark, rows):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", None, 3.0)], "k string, x double, y double")
    assert rows(reshape.to_long(df, ["k"])) == [
        ("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", None), ("b", "y", 3.0),
    ]
    assert rows(reshape.with_row_total(df, ["k"], "t"), "k", "t") == [("a", 3.0), ("b", None)]
    long = spark.createDataFrame([("r", "c", 1.0)], "row string, col string, value double")
    assert rows(reshape.transpose(long, "row", "col")) == [("c", "r", 1.0)]
    assert rows(reshape.append(df, df.select("y", "x", "k"))) == rows(df.union(df))


def test_repeated_keys_and_require(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "k string, j int")
    repeated = checks.repeated_keys(df, ["k", "j"])
    assert rows(repeated) == [("a", 1, 2)]
    with pytest.raises(checks.CheckFailed, match="repeated"):
        checks.require(repeated, "repeated")
    checks.require(repeated.where("n > 2"), "fine")


def test_conservation_sees_missing_sides(spark):
    raw = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("n", None)], "k string, value double")
    aligned = spark.createDataFrame([("a", 0.5), ("a", 0.5), ("c", 1.0), ("n", 1.0)], "k string, value double")
    found = {r.k: r.conserved for r in checks.conservation(raw, aligned, ["k"]).collect()}
    assert found == {"a": True, "b": False, "c": False, "n": False}


def test_coverage_counts_nan_as_missing(spark, rows):
    key = spark.createDataFrame(
        [("AT", "p", float("nan")), ("AT", "q", 1.0)], "country string, src string, weight double"
    )
    labels = spark.createDataFrame([("AT", "p"), ("AT", "q")], "country string, src string")
    assert rows(checks.coverage_gaps(labels, key)) == [("AT", "p", "no_weight")]


def test_hot_key_stays_whole(spark):
    """A third of all cells under one producer: nothing is lost, nothing is capped."""
    from weftable.operators.spread import spread_two_sided

    n = 30000
    cells = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "AT").otherwise(F.concat(F.lit("C"), F.col("id") % 50)).alias("resource_country"),
        F.lit("p").alias("resource_src"),
        F.lit("AT").alias("use_country"),
        F.lit("p").alias("use_src"),
        F.lit(1.0).alias("value"),
    )
    countries = ["AT"] + [f"C{i}" for i in range(50)]
    key = spark.createDataFrame(
        [(k, "p", x, 0.5) for k in countries for x in "XY"],
        "country string, src string, industry string, weight double",
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (before, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            z = spread_two_sided(cells, key)
            assert z.agg(F.sum("value")).first()[0] == float(n)
            assert z.where("resource_country = 'AT'").agg(F.sum("value")).first()[0] == n / 3
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
