"""The worked example: two sources, two industries, one folded region, one negative flow."""

import pytest
from pyspark.sql import functions as F

from weftable.operators.checks import CheckFailed, conservation, coverage_gaps, key_conservation, require
from weftable.operators.spread import spread_dense, spread_matrix, spread_one_sided, spread_two_sided
from weftable.operators.weights import repartition_keys
from weftable.plans.weighted import placed_flows
from weftable.sources.tables import read_flow_matrix

CROSSWALK = [("p", "X"), ("q", "X"), ("q", "Y")]
VA = [("AT", "X", 30.0), ("AT", "Y", 10.0), ("ROW", "X", 20.0), ("ROW", "Y", 20.0)]
RAW = [
    ("AT", "p", "AT", "p", 10.0),
    ("AT", "p", "AT", "q", 4.0),
    ("AT", "p", "WA", "q", 2.0),
    ("AT", "p", "TW", "q", 6.0),
    ("AT", "q", "AT", "q", -8.0),
    ("WA", "p", "AT", "p", 5.0),
    ("TW", "q", "AT", "p", 7.0),
]
HYBRID = {
    ("AT", "X", "AT", "X"): 8.5,
    ("AT", "X", "AT", "Y"): -0.5,
    ("AT", "X", "ROW", "X"): 4.0,
    ("AT", "X", "ROW", "Y"): 4.0,
    ("AT", "Y", "AT", "X"): -1.5,
    ("AT", "Y", "AT", "Y"): -0.5,
    ("ROW", "X", "AT", "X"): 8.5,
    ("ROW", "Y", "AT", "X"): 3.5,
}
COUNTRIES = ["AT", "ROW"]
CELLS = "resource_country string, resource_src string, use_country string, use_src string, value double"


@pytest.fixture(scope="module")
def example(spark):
    crosswalk = spark.createDataFrame(CROSSWALK, "src string, industry string")
    va = spark.createDataFrame(VA, "country string, industry string, value double")
    folded = [
        (a if a == "AT" else "ROW", b, u if u == "AT" else "ROW", w, v) for a, b, u, w, v in RAW
    ]
    return crosswalk, va, spark.createDataFrame(folded, CELLS)


def weights(df):
    return {(r.country, r.src, r.industry): r.weight for r in df.collect()}


def matrix_cells(df):
    return {tuple(r)[:4]: r.value for r in df.collect()}


def test_weights(example):
    crosswalk, va, _ = example
    assert weights(repartition_keys(crosswalk, va, COUNTRIES)) == {
        ("AT", "p", "X"): 1.0,
        ("AT", "q", "X"): 0.75,
        ("AT", "q", "Y"): 0.25,
        ("ROW", "p", "X"): 1.0,
        ("ROW", "q", "X"): 0.5,
        ("ROW", "q", "Y"): 0.5,
    }


def test_countries_may_come_as_a_table(spark, example):
    crosswalk, va, _ = example
    table = spark.createDataFrame([("AT",), ("ROW",), ("AT",)], "country string")
    assert weights(repartition_keys(crosswalk, va, table)) == weights(
        repartition_keys(crosswalk, va, COUNTRIES)
    )


def test_two_sided(example):
    crosswalk, va, cells = example
    z = spread_two_sided(cells, repartition_keys(crosswalk, va, COUNTRIES))
    assert matrix_cells(z) == pytest.approx(HYBRID)
    assert sum(HYBRID.values()) == sum(row[4] for row in RAW)


def write_matrix(path):
    """The raw example as a dense labelled matrix; the folded regions stay raw."""
    regions = ["AT", "WA", "TW"]
    labels = [(r, s) for r in regions for s in "pq"]
    value = {(a, b, u, w): v for a, b, u, w, v in RAW}
    lines = [
        ["region", ""] + [r for r, _ in labels],
        ["sector", ""] + [s for _, s in labels],
        ["region", "sector"] + ["" for _ in labels],
    ]
    for row in labels:
        lines.append([*row] + [str(value.get(row + col, 0)) for col in labels])
    path.write_text("\n".join("\t".join(line) for line in lines) + "\n")


def test_matrix_route_gives_the_same(spark, example, tmp_path):
    crosswalk, va, _ = example
    write_matrix(tmp_path / "Z.txt")
    kept = spark.createDataFrame([("AT",), ("ROW",)], "country string")
    flows = placed_flows(read_flow_matrix(spark, str(tmp_path / "Z.txt")), kept)
    z = matrix_cells(spread_matrix(flows, repartition_keys(crosswalk, va, COUNTRIES)).z)
    assert {k: v for k, v in z.items() if v} == pytest.approx(HYBRID)
    assert len(z) == 16


def test_weights_do_not_count_repeated_pairs(spark, example):
    _, va, _ = example
    repeated = spark.createDataFrame(
        [("p", "X"), ("p", "X"), ("q", "X"), ("q", "X"), ("q", "Y")], "src string, industry string"
    )
    crosswalk, _, _ = example
    assert weights(repartition_keys(repeated, va, COUNTRIES)) == weights(
        repartition_keys(crosswalk, va, COUNTRIES)
    )


def test_missing_value_added_makes_weights_null_but_not_of_single_industry(spark, example):
    crosswalk, _, cells = example
    va = spark.createDataFrame(
        [("AT", "X", 30.0), ("ROW", "X", 20.0), ("ROW", "Y", 20.0)],
        "country string, industry string, value double",
    )
    key = repartition_keys(crosswalk, va, COUNTRIES)
    found = weights(key)
    assert found["AT", "q", "X"] is None and found["AT", "q", "Y"] is None
    assert found["AT", "p", "X"] == 1.0
    labels = cells.select(F.col("resource_country").alias("country"), F.col("resource_src").alias("src"))
    gaps = {tuple(r) for r in coverage_gaps(labels, key).collect()}
    assert ("AT", "q", "no_weight") in gaps
    checked = conservation(cells, spread_two_sided(cells, key), ["resource_country"])
    assert {r.resource_country: r.conserved for r in checked.collect()} == {"AT": False, "ROW": True}
    with pytest.raises(CheckFailed):
        require(checked.where("NOT conserved"), "lost")


def test_zero_value_added_gives_null_and_no_error(spark, example):
    crosswalk, _, _ = example
    va = spark.createDataFrame(
        [("AT", "X", 0.0), ("AT", "Y", 0.0), ("ROW", "X", 1.0), ("ROW", "Y", 0.0)],
        "country string, industry string, value double",
    )
    found = weights(repartition_keys(crosswalk, va, COUNTRIES))
    assert found["AT", "q", "X"] is None
    assert found["ROW", "q", "Y"] == 0.0
    split = weights(repartition_keys(crosswalk, va, COUNTRIES, equal_if_zero=True))
    assert split["AT", "q", "X"] == split["AT", "q", "Y"] == 0.5
    assert split["ROW", "q", "X"] == 1.0


def test_zero_null_and_nan_weights_move_nothing(spark, example):
    _, _, cells = example
    key = spark.createDataFrame(
        [
            ("AT", "p", "X", 1.0),
            ("AT", "p", "Y", 0.0),
            ("AT", "q", "X", float("nan")),
            ("AT", "q", "Y", None),
        ],
        "country string, src string, industry string, weight double",
    )
    assert matrix_cells(spread_two_sided(cells, key)) == {("AT", "X", "AT", "X"): 10.0}


def test_negative_value_added_is_kept_and_conserved(spark, example):
    crosswalk, _, cells = example
    va = spark.createDataFrame(
        [("AT", "X", 30.0), ("AT", "Y", -10.0), ("ROW", "X", 20.0), ("ROW", "Y", 20.0)],
        "country string, industry string, value double",
    )
    key = repartition_keys(crosswalk, va, COUNTRIES)
    assert weights(key)["AT", "q", "X"] == 1.5 and weights(key)["AT", "q", "Y"] == -0.5
    checked = conservation(cells, spread_two_sided(cells, key), ["resource_country"])
    assert all(r.conserved for r in checked.collect())


def test_missing_sector_shows_in_checks(spark, example):
    _, va, cells = example
    crosswalk = spark.createDataFrame([("p", "X"), ("z", "Y")], "src string, industry string")
    key = repartition_keys(crosswalk, va, COUNTRIES)
    labels = cells.select(F.col("resource_country").alias("country"), F.col("resource_src").alias("src"))
    gaps = {tuple(r) for r in coverage_gaps(labels, key).collect()}
    assert {("AT", "q", "unmapped"), ("ROW", "q", "unmapped"), ("AT", "z", "unused")} <= gaps
    checked = conservation(cells, spread_two_sided(cells, key), ["resource_country"])
    assert not any(r.conserved for r in checked.where("resource_country = 'AT'").collect())


def test_missing_flow_value_poisons_its_cells_only(spark, example):
    crosswalk, va, cells = example
    gappy = cells.withColumn("value", F.when(F.col("value") != -8.0, F.col("value")))
    z = matrix_cells(spread_two_sided(gappy, repartition_keys(crosswalk, va, COUNTRIES)))
    assert z["AT", "X", "AT", "X"] is None and z["AT", "Y", "AT", "Y"] is None
    assert z["ROW", "X", "AT", "X"] == 8.5


def test_one_sided_expects_every_total(spark, example):
    crosswalk, va, _ = example
    key = repartition_keys(crosswalk, va, COUNTRIES)
    account = spark.createDataFrame(
        [("AT", "p", 4.0), ("AT", "q", 8.0), ("ROW", "p", 1.0)], "country string, src string, value double"
    )
    spread = {(r.country, r.industry): r.value for r in spread_one_sided(account, key).collect()}
    assert spread == {("AT", "X"): 10.0, ("AT", "Y"): 2.0, ("ROW", "X"): None, ("ROW", "Y"): None}


def test_dense_spread_fills_with_zero(spark, example):
    crosswalk, va, _ = example
    key = repartition_keys(crosswalk, va, COUNTRIES)
    account = spark.createDataFrame(
        [("AT", "q", "c", 8.0), ("ROW", "p", "c", None)],
        "country string, src string, component string, value double",
    )
    index = spark.createDataFrame(
        [(a, b, k) for a in COUNTRIES for b in "XY" for k in "cd"],
        "country string, industry string, component string",
    )
    dense = spread_dense(account, key, index, ["component"])
    found = {(r.country, r.industry, r.component): r.value for r in dense.collect()}
    assert len(found) == 8
    assert found["AT", "X", "c"] == 6.0 and found["AT", "Y", "c"] == 2.0
    assert all(v == 0.0 for k, v in found.items() if k not in {("AT", "X", "c"), ("AT", "Y", "c")})


def test_key_conservation(spark, example):
    crosswalk, va, _ = example
    key = repartition_keys(crosswalk, va, COUNTRIES)
    totals = spark.createDataFrame(
        [("AT", "p", 4.0), ("AT", "q", 8.0), ("ROW", "x", 1.0)], "country string, src string, value double"
    )
    checked = {r.country: (r.raw_total, r.conserved) for r in key_conservation(totals, key).collect()}
    assert checked == {"AT": (12.0, True), "ROW": (1.0, False)}


def test_identity_crosswalk_changes_nothing(spark, example):
    _, va, cells = example
    identity = spark.createDataFrame([("p", "p"), ("q", "q")], "src string, industry string")
    z = matrix_cells(spread_two_sided(cells, repartition_keys(identity, va, COUNTRIES)))
    totals = {}
    for row in cells.collect():
        totals[tuple(row)[:4]] = totals.get(tuple(row)[:4], 0.0) + row.value
    assert z == pytest.approx(totals)
