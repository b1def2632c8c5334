"""One-pass spreading, order-free sums, dense numbers, as-of join, published tables, lines in file order."""

import bisect
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from weftable.classification import UNWEIGHTED
from weftable.functions.aggregates import exact_null_sum, exact_sum
from weftable.operators.asof import asof_join
from weftable.operators.checks import conserved
from weftable.operators.convert import gas_factors
from weftable.operators.numbering import dense_numbers
from weftable.operators.spread import spread_matrix, spread_two_sided, spread_whole
from weftable.sources import sinks, tables
from weftable.sources.matrix import read_matrix

KEY = [("AT", "p", "X", 0.25), ("AT", "p", "Y", 0.75), ("AT", "q", "X", 1.0), ("WA", "p", "Z", 1.0), ("WA", "n", "X", None), ("WA", "0", "X", 0.0)]
LABELS = [("AT", "p"), ("AT", "q"), ("AT", "lost"), ("WA", "p"), ("WA", "n"), ("WA", "0"), ("XX", "p")]


def key_of(spark):
    return spark.createDataFrame(KEY, "country string, src string, industry string, weight double")


def raw_cells():
    return [(*a, *b, float((7 * i + 3 * j) % 11 - 4)) for i, a in enumerate(LABELS) for j, b in enumerate(LABELS)]


def plain_spread(cells):
    weights = {}
    for country, src, industry, w in KEY:
        if w:
            weights.setdefault((country, src), []).append((industry, w))
    out, left = {}, {}
    for rc, rs, uc, us, v in cells:
        r, u = weights.get((rc, rs)), weights.get((uc, us))
        if r and u:
            for ri, rw in r:
                for ui, uw in u:
                    out[rc, ri, uc, ui] = out.get((rc, ri, uc, ui), 0.0) + v * rw * uw
        else:
            left[rc, UNWEIGHTED, uc, UNWEIGHTED] = left.get((rc, UNWEIGHTED, uc, UNWEIGHTED), 0.0) + v
    return out, left


def as_dict(df):
    return {tuple(r)[:4]: r.value for r in df.select("resource_country", "resource_industry", "use_country", "use_industry", "value").collect()}


def test_one_pass_over_cells(spark):
    cells = spark.createDataFrame(raw_cells(), "resource_country string, resource_src string, use_country string, use_src string, value double")
    whole = spread_whole(cells, key_of(spark))
    out, left = plain_spread(raw_cells())
    assert as_dict(whole) == pytest.approx(out | left)
    assert as_dict(spread_two_sided(cells, key_of(spark))) == pytest.approx(out)
    raw, scale, value = whole.agg(F.sum("raw"), F.sum("scale"), F.sum("value")).first()
    total, sizes = sum(c[4] for c in raw_cells()), sum(abs(c[4]) for c in raw_cells())
    assert (raw, scale, value) == pytest.approx((total, sizes, total))
    assert {r.resource_country: r.conserved for r in conserved(whole, ["resource_country"]).collect()} == {"AT": False, "WA": False, "XX": False}
    known = cells.where("resource_src in ('p', 'q') and use_src in ('p', 'q') and resource_country <> 'XX' and use_country <> 'XX'")
    assert {r.conserved for r in conserved(spread_whole(known, key_of(spark)), ["resource_country"]).collect()} == {True}


def test_missing_values_poison_their_sums_only(spark):
    rows = [("AT", "q", "AT", "q", None), ("AT", "q", "WA", "p", 1.0), ("AT", "lost", "WA", "p", None), ("AT", "lost", "AT", "p", 2.0)]
    cells = spark.createDataFrame(rows, "resource_country string, resource_src string, use_country string, use_src string, value double")
    found = as_dict(spread_whole(cells, key_of(spark)))
    assert found == {("AT", "X", "AT", "X"): None, ("AT", "X", "WA", "Z"): 1.0, ("AT", UNWEIGHTED, "WA", UNWEIGHTED): None, ("AT", UNWEIGHTED, "AT", UNWEIGHTED): 2.0}


def matrix_file(tmp_path, name="Z.txt"):
    lines = [["region", "", *[b[0] for b in LABELS]], ["sector", "", *[b[1] for b in LABELS]]]
    cells = {c[:4]: c[4] for c in raw_cells()}
    lines += [[*a, *[str(cells[(*a, *b)]) for b in LABELS]] for a in LABELS]
    path = tmp_path / name
    path.write_text("\n".join("\t".join(line) for line in lines) + "\n")
    return str(path)


def flows_of(spark, tmp_path):
    return read_matrix(spark, matrix_file(tmp_path), ["resource_country", "resource_src"], ["use_country", "use_src"])


def test_one_pass_over_a_matrix(spark, tmp_path, rows):
    spread = spread_matrix(flows_of(spark, tmp_path), key_of(spark))
    out, left = plain_spread(raw_cells())
    assert as_dict(spread.z) == pytest.approx(out) and as_dict(spread.unweighted) == pytest.approx(left)
    sums = {}
    for rc, rs, _, _, v in raw_cells():
        old = sums.get((rc, rs), (0.0, 0.0))
        sums[rc, rs] = (old[0] + v, old[1] + abs(v))
    assert {(r.resource_country, r.resource_src): (r.value, r.scale) for r in spread.lines.collect()} == sums


def test_the_matrix_is_read_once(spark, tmp_path):
    """After the pass, no part of the result reads the text again; within it, lines are unfolded once."""
    path = matrix_file(tmp_path)
    spread = spread_matrix(flows_of(spark, tmp_path), key_of(spark))
    for df in (spread.z, spread.unweighted, spread.lines):
        assert not any(path in f for f in df.inputFiles())
        assert "Generate" not in df._jdf.queryExecution().executedPlan().toString()


def test_sums_of_lines_know_of_no_column(spark, tmp_path):
    """A column that gets lost is missed: the lines' own sums still have it."""
    flows = flows_of(spark, tmp_path)
    less = flows.with_columns(lambda k: k.where("use_src <> 'q'"))
    spread = spread_matrix(less, key_of(spark))
    whole = spread_matrix(flows, key_of(spark))
    assert sorted(map(tuple, spread.lines.collect())) == sorted(map(tuple, whole.lines.collect()))
    assert as_dict(spread.z) != as_dict(whole.z)


# --- order-free sums ---------------------------------------------------------------


FINITE = st.floats(-1e12, 1e12, allow_nan=False).map(lambda x: math.ldexp(round(math.ldexp(x, 40)), -40))


@settings(max_examples=15, deadline=None)
@given(st.lists(FINITE, min_size=1, max_size=200))
def test_exact_sum(spark, values):
    found = [
        spark.createDataFrame([(v,) for v in order], "v double").repartition(n).agg(exact_sum("v")).first()[0]
        for order, n in ((values, 1), (sorted(values), 3))
    ]
    assert found == [math.fsum(values)] * 2


def test_exact_sum_of_odd_values(spark):
    def of(*values):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(exact_sum("v"), exact_null_sum("v")).first()

    assert tuple(of(1e17, 1.0, -1e17)) == (1.0, 1.0)
    assert tuple(of(None, 1.5)) == (1.5, None) and tuple(of(None)) == (None, None)
    assert of(float("inf"), 1.0)[0] == math.inf and of(1e300, 1.0)[0] == 1e300
    assert of(*[1e18] * 200)[0] == pytest.approx(2e20)
    assert of(-0.1, -0.2, 0.3)[0] == math.fsum([-0.1, -0.2, 0.3])
    by = Window.partitionBy("k")
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("b", None)], "k string, v double")
    assert {r.k: r.s for r in df.select("k", exact_sum("v", by).alias("s")).collect()} == {"a": 0.1 + 0.2, "b": None}


def test_equal_bits_for_every_partitioning(spark):
    random.seed(5)
    labels = [x for x in LABELS if x[1] in ("p", "q") and x[0] != "XX"]
    rows = [(*random.choice(labels), *random.choice(labels), random.lognormvariate(0, 8)) for _ in range(3000)]
    cells = spark.createDataFrame(rows, "resource_country string, resource_src string, use_country string, use_src string, value double")
    key = key_of(spark).withColumn("weight", F.col("weight") / 3)
    found = [as_dict(spread_whole(cells.orderBy(F.rand(n)).repartition(n), key)) for n in (1, 8, 64)]
    assert found[0] == found[1] == found[2]


# --- dense numbers, as-of join ---------------------------------------------------------


def test_dense_numbers(spark):
    pairs = [(f"k{i % 37:02}", i % 11) for i in range(2000)]
    df = spark.createDataFrame(pairs, "a string, b int").repartition(16)
    found = dense_numbers(df, ["a", "b"]).collect()
    assert [(r.a, r.b) for r in sorted(found, key=lambda r: r.number)] == sorted(set(pairs))
    assert sorted(r.number for r in found) == list(range(len(set(pairs))))
    assert dense_numbers(df.limit(0), ["a"]).collect() == []


@pytest.mark.parametrize("partitions", ["1", "8", "40"])
def test_asof_join(spark, partitions):
    random.seed(int(partitions))
    keys = ["hot"] * 6 + ["a", "b", "c", None]
    releases = [(random.choice(keys), random.choice([None, *range(50)]), i) for i in range(300)]
    facts = [(i, random.choice([*keys, "never"]), random.choice([None, *range(-3, 60)])) for i in range(1500)]
    known = {}
    for k, t, v in releases:
        if k is not None and t is not None:
            known.setdefault(k, []).append((t, v))
    expected = []
    for i, k, t in facts:
        have = sorted(known.get(k, [])) if t is not None else []
        at = bisect.bisect_right(have, (t, math.inf)) if have else 0
        expected.append((i, k, t, have[at - 1][1] if at else None))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        f = spark.createDataFrame(facts, "id int, k string, t int")
        r = spark.createDataFrame(releases, "k string, t int, v int")
        found = asof_join(f, r, ["k"], "t", ["v"])
        assert found.columns == ["id", "k", "t", "v"] and sorted(map(tuple, found.collect())) == sorted(expected)
        assert asof_join(f, r.limit(0), ["k"], "t", ["v"]).where("v is not null").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_asof_without_key(spark):
    f = spark.createDataFrame([(1,), (5,), (9,)], "t int")
    r = spark.createDataFrame([(2, "x", 1), (5, "y", 2), (5, "z", 1)], "t int, v string, n int")
    assert sorted(map(tuple, asof_join(f, r, [], "t", ["v", "n"]).collect()), key=str) == [(1, None, None), (5, "z", 1), (9, "z", 1)]


# --- published tables, order of lines ----------------------------------------------------


BY = "resource_country string, value double"


def test_published_table_forgets(spark, tmp_path, rows):
    path = str(tmp_path / "by")
    with pytest.raises(FileNotFoundError):
        sinks.read_published(spark, path)
    sinks.publish_by_country(spark.createDataFrame([("AT", 1.0), ("ROW", 2.0), (None, 5.0)], BY), path)
    earlier = sinks.read_published(spark, path)
    sinks.publish_by_country(spark.createDataFrame([("ROW", 3.0)], BY), path)
    assert rows(sinks.read_published(spark, path), "resource_country", "value") == [("ROW", 3.0)]
    assert rows(earlier, "resource_country", "value") == [(None, 5.0), ("AT", 1.0), ("ROW", 2.0)]
    for i in range(3):
        sinks.publish_by_country(sinks.read_published(spark, path).withColumn("value", F.col("value") + 1), path)
    assert rows(sinks.read_published(spark, path, BY), "resource_country", "value") == [("ROW", 6.0)]
    assert len([p for p in (tmp_path / "by").iterdir() if p.name.startswith("version-")]) == 2


def test_a_failed_run_leaves_the_published_table(spark, tmp_path, rows):
    path = str(tmp_path / "by")
    sinks.publish_by_country(spark.createDataFrame([("AT", 1.0)], BY), path)
    bad = spark.createDataFrame([("AT", 1.0), ("DE", 2.0)], BY).withColumn(
        "value", F.when(F.col("value") > 1, F.raise_error(F.lit("broken")).cast("double")).otherwise(9.0)
    )
    with pytest.raises(Exception, match="broken"):
        sinks.publish_by_country(bad, path)
    assert rows(sinks.read_published(spark, path), "resource_country", "value") == [("AT", 1.0)]


def test_first_line_in_file_order(spark, tmp_path):
    """Twenty files of unlike size, packed into tasks by size: the first line of the first file counts."""
    for i in range(20):
        later = "".join(f"x{j}\tkg\n" for j in range((i * 37) % 11 * 50))
        (tmp_path / "u").mkdir(exist_ok=True)
        (tmp_path / "u" / f"{i:02}.txt").write_text(f"stressor\tunit\nCH4 - a\t{'kg CO2-eq' if i == 0 else 'kg'}\n{later}SF6\tkg\n")
    found = {r.stressor: r.gwp for r in gas_factors(tables.read_units(spark, str(tmp_path / "u"), ordered=True)).collect()}
    assert found["CH4 - a"] == 1 and found["SF6"] == 23500


# --- matrices: lines without numbers, quoted separators ----------------------------------------


def lines_of(path, lines, sep="\t"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(sep.join(line) for line in lines) + "\n")
    return str(path)


HEAD = [["region", "", "AT", "DE"], ["sector", "", "p", "q"]]


def found_cells(matrix):
    return sorted((tuple(r) for r in matrix.cells().collect()), key=str)


@pytest.mark.parametrize("blank", [["", ""], ["n/a", ""], ["x", "y"]])
def test_first_line_of_data_without_a_number(spark, tmp_path, blank):
    names = ["region", "sector", "", ""]
    data = [["AT", "p", *blank], ["DE", "q", "1", "2"]]
    expected = sorted([("AT", "p", "AT", "p", None), ("AT", "p", "DE", "q", None), ("DE", "q", "AT", "p", 1.0), ("DE", "q", "DE", "q", 2.0)], key=str)
    for i, lines in enumerate([HEAD + data, [*HEAD, names, *data], [*HEAD, ["", "", "M.EUR", "M.EUR"], *data]]):
        assert found_cells(tables.read_flow_matrix(spark, lines_of(tmp_path / f"{i}.txt", lines))) == expected
    none = [*HEAD, data[0]]
    assert len(found_cells(tables.read_flow_matrix(spark, lines_of(tmp_path / "none.txt", none)))) == 2


def test_lines_that_only_other_parts_tell(spark, tmp_path):
    head, odd = [["region", "AT", "WA"], ["sector", "p", "q"]], ["Aggregate", "", ""]
    one, two = ["Taxes", "1", "2"], ["Wages", "3", "4"]
    lines_of(tmp_path / "repeated" / "a.txt", [*head, odd, one])
    lines_of(tmp_path / "repeated" / "b.txt", [*head, odd, two])
    assert {r[0] for r in found_cells(tables.read_factor_matrix(spark, str(tmp_path / "repeated")))} == {"Taxes", "Wages"}
    lines_of(tmp_path / "single" / "a.txt", [*head, odd, one])
    lines_of(tmp_path / "single" / "b.txt", [*head, two])
    found = found_cells(tables.read_factor_matrix(spark, str(tmp_path / "single")))
    assert {r[0] for r in found} == {"Taxes", "Wages", "Aggregate"} and len(found) == 6
    alone = lines_of(tmp_path / "alone.txt", [*head, odd, one])
    with pytest.raises(ValueError, match="label_lines"):
        tables.read_factor_matrix(spark, alone)
    assert len(found_cells(read_matrix(spark, alone, ["component"], ["region", "sector"], label_lines=2))) == 4
    assert len(found_cells(read_matrix(spark, alone, ["component"], ["region", "sector"], label_lines=3))) == 2


def test_quoted_separators(spark, tmp_path):
    lines = [["", '"p, other"', "q", '"say ""x"", y"'], ['"p, other"', "1", '"2.5"', ""], ["q", '"3"', "4", '"5"'], ['"say ""x"", y"', "6", "7", "8"]]
    matrix = read_matrix(spark, lines_of(tmp_path / "q.csv", lines, ","), ["row"], ["column"], sep=",", quote='"')
    p, s = "p, other", 'say "x", y'
    assert found_cells(matrix) == sorted(
        [(p, p, 1.0), (p, "q", 2.5), (p, s, None), ("q", p, 3.0), ("q", "q", 4.0), ("q", s, 5.0), (s, p, 6.0), (s, "q", 7.0), (s, s, 8.0)], key=str
    )


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("a,\" b", max_size=6), min_size=1, max_size=6))
def test_split_like_a_csv_reader(fields):
    import csv
    import io

    from weftable.sources.matrix import _fields_of, _unquoted

    out = io.StringIO()
    csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="").writerow(fields)
    found = _fields_of(out.getvalue(), ",", '"')
    assert [f[1:-1].replace('""', '"') for f in found] == fields and len(found) == len(fields)
    assert [_unquoted(f, '"') for f in found] == fields
