"""Readers, writers and file choice, on small files written by the tests."""

import pytest
from pyspark.sql import functions as F

from weftable.schemas import FLAT_FILE
from weftable.sources import locate, sinks, tables, vintages
from weftable.sources.matrix import read_matrix
from weftable.sources.staging import new_folder, shared_folder, stage, staged_tables


def write(path, lines, sep="\t", end="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes((end.join(sep.join(line) for line in lines) + end).encode("utf-8"))
    return str(path)


def cells(matrix):
    names = matrix.cells().columns
    return names, sorted((tuple(r) for r in matrix.cells().collect()), key=str)


Z_LINES = [
    ["region", "", "AT", "AT", "WA"],
    ["sector", "", "p", "q r", "p"],
    ["region", "sector", "", "", ""],
    ["AT", "p", "1.5", "-2", "0"],
    ["WA", "p", "x", "", "3e2"],
]
Z_CELLS = [
    ("AT", "p", "AT", "p", 1.5),
    ("AT", "p", "AT", "q r", -2.0),
    ("AT", "p", "WA", "p", 0.0),
    ("WA", "p", "AT", "p", None),
    ("WA", "p", "AT", "q r", None),
    ("WA", "p", "WA", "p", 300.0),
]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_flow_matrix(spark, tmp_path, end):
    path = write(tmp_path / "Z.txt", Z_LINES, end=end)
    names, found = cells(tables.read_flow_matrix(spark, path))
    assert names == ["resource_region", "resource_sector", "use_region", "use_sector", "value"]
    assert found == sorted(Z_CELLS, key=str)


def test_demand_matrix(spark, tmp_path):
    lines = [
        ["region", "", "AT", "WA"],
        ["category", "", "Gross fixed capital formation", "Changes in inventories"],
        ["region", "sector", "", ""],
        ["AT", "p", "1", "2"],
    ]
    names, found = cells(tables.read_demand_matrix(spark, write(tmp_path / "Y.txt", lines)))
    assert names == ["region", "sector", "use_region", "component", "value"]
    assert found == [
        ("AT", "p", "AT", "Gross fixed capital formation", 1.0),
        ("AT", "p", "WA", "Changes in inventories", 2.0),
    ]


@pytest.mark.parametrize("reader, name", [("read_factor_matrix", "component"), ("read_emissions_matrix", "stressor")])
def test_one_label_column(spark, tmp_path, reader, name):
    lines = [["region", "AT", "WA"], ["sector", "p", "q"], ["stressor", "", ""], ["Taxes", "1", "2"]]
    names, found = cells(getattr(tables, reader)(spark, write(tmp_path / "F.txt", lines)))
    assert names == [name, "region", "sector", "value"]
    assert found == [("Taxes", "AT", "p", 1.0), ("Taxes", "WA", "q", 2.0)]


def test_wide_table_with_quotes(spark, tmp_path):
    lines = [['"V1"', '"AUT_A01_02"', '"OUT"'], ['"AUT_D"', "1.25", "2"], ['"VA"', "3", "4"]]
    names, found = cells(tables.read_wide_table(spark, write(tmp_path / "2020_SML.csv", lines, sep=",")))
    assert names == ["resource_id", "use_id", "value"]
    assert found == [
        ("AUT_D", "AUT_A01_02", 1.25),
        ("AUT_D", "OUT", 2.0),
        ("VA", "AUT_A01_02", 3.0),
        ("VA", "OUT", 4.0),
    ]


def test_matrix_in_parts_repeats_its_label_lines(spark, tmp_path):
    write(tmp_path / "Z" / "a.txt", Z_LINES[:4])
    write(tmp_path / "Z" / "b.txt", Z_LINES[:3] + Z_LINES[4:])
    assert cells(tables.read_flow_matrix(spark, str(tmp_path / "Z")))[1] == sorted(Z_CELLS, key=str)


def test_parts_with_other_labels_are_an_error(spark, tmp_path):
    write(tmp_path / "Z" / "a.txt", Z_LINES[:4])
    other = [Z_LINES[0], ["sector", "", "q r", "p", "p"], *Z_LINES[2:3], Z_LINES[4]]
    write(tmp_path / "Z" / "b.txt", other)
    with pytest.raises(Exception, match="label lines differ"):
        tables.read_flow_matrix(spark, str(tmp_path / "Z")).cells().collect()


def test_matrix_split_over_many_tasks(spark, tmp_path):
    n = 400
    lines = [["region", ""] + ["AT"] * n, ["sector", ""] + [f"s{i}" for i in range(n)], ["region", "sector"] + [""] * n]
    lines += [["AT", f"s{i}"] + [str(i * n + j) for j in range(n)] for i in range(n)]
    path = write(tmp_path / "Z.txt", lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        matrix = tables.read_flow_matrix(spark, path)
        assert matrix.rows.rdd.getNumPartitions() > 4
        total = matrix.cells().agg(F.count("*"), F.sum("value"), F.countDistinct("value")).first()
        assert tuple(total) == (n * n, float(sum(range(n * n))), n * n)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_too_few_label_lines(spark, tmp_path):
    path = write(tmp_path / "Z.txt", Z_LINES[:1])
    with pytest.raises(ValueError, match="label lines"):
        read_matrix(spark, path, ["a", "b"], ["c", "d"])


def test_label_work_happens_before_cells(spark, tmp_path):
    matrix = tables.read_flow_matrix(spark, write(tmp_path / "Z.txt", Z_LINES))
    part = matrix.with_rows(lambda r: r.where("resource_region = 'AT'")).with_columns(
        lambda k: k.where("use_region = 'WA'").withColumn("folded", F.lit("ROW"))
    )
    assert [tuple(r) for r in part.cells().collect()] == [("AT", "p", "WA", "p", "ROW", 0.0)]


def test_two_label_lines(spark, tmp_path):
    path = write(tmp_path / "Z.txt", Z_LINES[:2] + Z_LINES[3:])
    assert cells(tables.read_flow_matrix(spark, path))[1] == sorted(Z_CELLS, key=str)
    assert cells(read_matrix(spark, path, ["a", "b"], ["c", "d"], label_lines=2))[1] == sorted(Z_CELLS, key=str)
    with pytest.raises(ValueError, match="more than|fewer than"):
        read_matrix(spark, path, ["a", "b"], ["c", "d"], label_lines=1)


def test_label_lines_are_checked_against_the_file(spark, tmp_path):
    path = write(tmp_path / "Z.txt", Z_LINES)
    with pytest.raises(ValueError, match="more than 2"):
        read_matrix(spark, path, ["a", "b"], ["c", "d"], label_lines=2)


@pytest.mark.parametrize("line", [["AT", "q", "1"], ["AT", "q", "1", "2", "3", "99"]])
def test_a_line_of_another_size_is_an_error(spark, tmp_path, line):
    path = write(tmp_path / "Z.txt", [*Z_LINES, line])
    with pytest.raises(Exception, match="another size"):
        tables.read_flow_matrix(spark, path).cells().collect()


def test_encoding_of_a_matrix(spark, tmp_path):
    path = tmp_path / "Z.txt"
    lines = [["region", "", "CÔ"], ["sector", "", "é"], ["CÔ", "é", "1"]]
    path.write_bytes("\n".join("\t".join(line) for line in lines).encode("latin-1"))
    matrix = read_matrix(spark, str(path), ["a", "b"], ["c", "d"], encoding="ISO-8859-1")
    assert cells(matrix)[1] == [("CÔ", "é", "CÔ", "é", 1.0)]


def test_nan_cells_are_missing(spark, tmp_path):
    path = write(tmp_path / "Z.txt", [*Z_LINES[:2], ["AT", "p", "NaN", "2", "3"], ["WA", "p", "1", "-2", "3"]])
    matrix = tables.read_flow_matrix(spark, path)
    assert [r["value"] for r in matrix.cells().where("resource_region = 'AT'").orderBy("value").collect()] == [None, 2.0, 3.0]
    assert sorted((tuple(r) for r in matrix.line_totals().collect()), key=str) == [("AT", "p", None, None), ("WA", "p", 2.0, 6.0)]


def test_flat_file_by_name_with_bad_numbers(spark, tmp_path):
    lines = [
        ["icsup", "refArea", "rowIi", "counterpartArea", "colIi", "obsValue"],
        ["x", "AT", "A01", "DE", "B", "1.5"],
        ["x", "AT", "A01", "DE", "B", "n/a"],
    ]
    df = tables.read_flat_file(spark, write(tmp_path / "flat.csv", lines, sep=","))
    assert [f"{n} {t}" for n, t in df.dtypes] == [x.strip() for x in FLAT_FILE.split(",")]
    assert [r.obsValue for r in df.collect()] == [1.5, None]


def test_other_tables(spark, tmp_path):
    units = write(tmp_path / "unit.txt", [["stressor", "unit"], ["CO2 - air", "kg"]])
    assert [tuple(r) for r in tables.read_units(spark, units).collect()] == [("CO2 - air", "kg")]
    rates = write(tmp_path / "r.csv", [["LOCATION", "TIME_PERIOD", "OBS_VALUE"], ["EU27_2020", "2020", "0.8"]], ",")
    assert [tuple(r) for r in tables.read_rates(spark, rates).collect()] == [(2020, "EU27_2020", 0.8)]
    ghg = write(tmp_path / "g.csv", [["industry", "ref_area", "obs_value", "z"], ["B", "AT", "3", "z"]], ",")
    assert [tuple(r) for r in tables.read_flat_emissions(spark, ghg).collect()] == [("B", "AT", 3.0)]
    scope = write(
        tmp_path / "DF_SCOPE.csv",
        [
            ["TIME_PERIOD", "EMISSIONS_SCOPE", "EMISSIONS_ORIGIN_AREA", "ACTIVITY", "OBS_VALUE"],
            ["2020", "S1", "AUT", "D", "2"],
        ],
        ",",
    )
    assert [tuple(r) for r in tables.read_wide_emissions(spark, scope).collect()] == [(2020, "S1", "AUT", "D", 2.0)]


def test_crosswalk_scan(spark, tmp_path):
    path = write(
        tmp_path / "x.csv",
        [["Pays", "PaysLib", "ExioCode", "Lib", "vrai_code", "D03"], ["AT", "Austria", "i", "Fish, fresh", "v", "1"]],
        ";",
    )
    row = tables.read_crosswalk(spark, path, sep=";").first()
    assert row.Lib == "Fish, fresh" and row.D03 == 1


def test_find_file(spark, tmp_path):
    names = [
        "flatfile_eu-ic-io_ind-by-ind_24ed_2020.csv",
        "flatfile_eu-ic-io_ind-by-ind_24ed_2019.csv",
        "greenhouse-gas-footprints_2020.csv",
        "2020_SML.csv",
        "DF_SCOPE.csv",
    ]
    for name in names:
        write(tmp_path / "in" / name, [["a"]])
    folder = str(tmp_path / "in")
    assert locate.reference_flat_file(spark, folder, 2020).endswith(names[0])
    assert locate.flat_emissions_file(spark, folder).endswith(names[2])
    assert locate.wide_table_file(spark, folder).endswith(names[3])
    assert locate.wide_emissions_file(spark, folder).endswith(names[4])
    with pytest.raises(FileNotFoundError, match="more than one"):
        locate.flat_file(spark, folder)
    with pytest.raises(FileNotFoundError, match="no file"):
        locate.find_file(spark, folder, ["nothing"])


def test_entries_however_the_folder_is_written(spark, tmp_path, monkeypatch):
    for name in ("layout/out/A/Z.csv/part-0", "layout/out/B/Z.csv/part-0", "layout/out/B/Z.csv/part-1"):
        write(tmp_path / name, [["x"]])
    root = str(tmp_path / "layout")
    for folder in (f"{root}//out", f"{root}/../layout/out", f"{root}/out/", f"file:{root}/out"):
        assert locate.list_sources(spark, folder) == ["A", "B"]
    assert [name for name, _ in locate.list_entries(spark, root)] == ["out"]
    with pytest.raises(FileNotFoundError):
        locate.list_sources(spark, f"{root}/nothing")


def test_edition_of_the_reference_file(spark, tmp_path):
    for edition in ("24ed", "25ed"):
        write(tmp_path / "in" / f"flatfile_eu-ic-io_ind-by-ind_{edition}_2020.csv", [["a"]])
    found = locate.reference_flat_file(spark, str(tmp_path / "in"), 2020, edition="25ed")
    assert "25ed" in found and "24ed" in locate.reference_flat_file(spark, str(tmp_path / "in"), 2020)


def test_list_sources_leaves_out_the_comparison(spark, tmp_path):
    for name in ("B/Z.csv/part-0", "A/Z.csv/part-0", "COMPARISON/Z.csv/part-0"):
        write(tmp_path / "out" / name, [["x"]])
    assert locate.list_sources(spark, str(tmp_path / "out")) == ["A", "B"]


def test_account_csv_keeps_accents_nulls_and_precision(spark, tmp_path, rows):
    df = spark.createDataFrame(
        [("AT", "é;\"x", 0.1 + 0.2), ("AT", "B", None)], "country string, industry string, value double"
    )
    sinks.write_account_csv(df, str(tmp_path / "S"), "emissions")
    back = tables.read_account_csv(spark, str(tmp_path / "S" / "emissions.csv"), "emissions", "S")
    assert rows(back, "id", "S") == [("AT_B", None), ("AT_é;\"x", 0.1 + 0.2)]
    text = b"".join(p.read_bytes() for p in (tmp_path / "S" / "emissions.csv").glob("part-*"))
    assert "é".encode("latin-1") in text and b'"country";"industry";"value";"id"' in text


def test_rescan_accepts_prefixed_ids(spark, tmp_path, rows):
    df = spark.createDataFrame([("u", "r", 1.0)], "hybrid_use_id string, hybrid_resource_id string, value double")
    sinks.write_csv(df, str(tmp_path / "Z.csv"))
    back = tables.read_account_csv(spark, str(tmp_path / "Z.csv"), "Z", "S")
    assert back.columns == ["use_id", "resource_id", "S"] and rows(back) == [("u", "r", 1.0)]


def test_select_by_pattern_needs_exactly_one(spark):
    df = spark.createDataFrame([(1, 2)], "use_id int, other_use_id int")
    with pytest.raises(ValueError):
        tables.select_by_pattern(df, {"use_id": "use_id"})
    with pytest.raises(ValueError):
        tables.select_by_pattern(df, {"x": "nothing"})


def test_write_by_country_replaces_only_what_it_has(spark, tmp_path, rows):
    path = str(tmp_path / "by")
    schema = "resource_country string, use_country string, value double"
    sinks.write_by_country(spark.createDataFrame([("AT", "x", 1.0), ("ROW", "x", 2.0)], schema), path)
    sinks.write_by_country(spark.createDataFrame([("ROW", "y", 3.0)], schema), path)
    back = spark.read.schema(schema).parquet(path)
    assert rows(back, "resource_country", "use_country", "value") == [("AT", "x", 1.0), ("ROW", "y", 3.0)]


def test_vintages(spark, rows):
    links = {"1995": "a", "2001": "b", "FPT": "ghg", "2016": "c"}
    assert [vintages.resolve_vintage(links, y) for y in (1995, 2000, 2001, 2030)] == ["a", "a", "b", "c"]
    with pytest.raises(ValueError):
        vintages.resolve_vintage(links, 1990)
    releases = spark.createDataFrame([(2001, "b"), (1995, "a"), (2016, "c")], "start_year int, location string")
    years = spark.createDataFrame([(1990,), (1995,), (2015,), (2016,)], "year int")
    assert rows(vintages.with_vintage(years, "year", releases)) == [
        (1990, None), (1995, "a"), (2015, "b"), (2016, "c"),
    ]


def test_staged_tables_have_an_end(spark, tmp_path):
    import os

    with staged_tables(spark):
        path = stage(spark.range(3), "x").inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)


def test_stage_uses_the_shared_folder(spark, rows):
    df = spark.createDataFrame([("a", None), (None, 1.0)], "k string, v double")
    staged = stage(df, "x")
    assert staged.schema == df.schema and rows(staged) == rows(df)
    assert all(shared_folder(spark) in path for path in staged.inputFiles())
    assert new_folder(spark, "x") != new_folder(spark, "x")
    by = stage(df.withColumn("part", F.lit("p")), "y", ["part"])
    assert rows(by, "k", "v", "part") == [(None, 1.0, "p"), ("a", None, "p")]
