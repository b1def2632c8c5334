"""Whole alignments on small releases, against plain Python doing the same by hand."""

import random
from collections import defaultdict

import pytest

from weftable import classification as c
from weftable import (
    align_flat_folder,
    align_weighted,
    align_wide_folder,
    compare_accounts,
    compare_folder,
    read_release,
    reference_value_added,
    write_source,
)
from weftable.operators.checks import CheckFailed
from weftable.operators.convert import rate_of
from weftable.operators.crosswalk import build_crosswalk, industry_map
from weftable.operators.fold import kept_countries
from weftable.plans.flat import align_flat
from weftable.plans.weighted import emission_totals
from weftable.sources.tables import read_crosswalk, read_flat_file

REGIONS = ["AT", "DE", "WA", "TW"]
KEPT = {"AT", "DE"}


def fold(region):
    return region if region in KEPT else "ROW"


def put(path, lines, sep):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(sep.join(str(x) for x in line) for line in lines) + "\n")


def by_key(df):
    keys = [name for name in df.columns if name != "value"]
    found = {tuple(r[k] for k in keys): r.value for r in df.collect()}
    assert len(found) == df.count()
    return found


# --- crosswalk -------------------------------------------------------------------------

SECTORS = {"Farming": ["D01T02"], "Mining": ["D05T06", "D07T08"], "Power": ["D35", "D36T39"], "Trade": ["D45T47", "D35"]}
INDUSTRY = {raw: industry for raw, industry, _ in c.INDUSTRY_MAP}
CODES = {raw: codes for raw, _, codes in c.INDUSTRY_MAP}
PAIRS = {(s, INDUSTRY[raw]) for s, raws in SECTORS.items() for raw in raws}


@pytest.fixture(scope="module")
def setting(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("cross") / "crosswalk.csv"
    raws = sorted({raw for listed in SECTORS.values() for raw in listed})
    lines = [["Pays", "PaysLib", "ExioCode", "Lib", "vrai_code", *raws]]
    for region in REGIONS:
        for sector, listed in SECTORS.items():
            lines.append([region, "n", "i", sector, "v", *[int(raw in listed) for raw in raws]])
    put(path, lines, ",")
    one_hot = read_crosswalk(spark, str(path))
    return build_crosswalk(one_hot), kept_countries(one_hot)


# --- flat file -------------------------------------------------------------------------

CODE_INDUSTRY = {code: INDUSTRY[raw] for listed in SECTORS.values() for raw in listed for code in CODES[raw]}


def flat_rows(seed=1):
    draw = random.Random(seed)
    industries = [*CODE_INDUSTRY, "Z99"]
    countries = ["AT", "DE", "FR", "TW"]
    demand = ["P3_S13", "P3_S14", "P51G", "P5M"]
    rows = []
    for a in countries:
        for r in industries + list(c.FLAT_VALUE_ADDED_ROWS) + ["XX"]:
            for u in countries:
                for k in industries + demand:
                    if r in c.FLAT_VALUE_ADDED_ROWS and a != "AT":
                        continue
                    rows.append((a, r, u, k, draw.randint(-20, 100)))
    return rows


def expected_flat(rows):
    z, va, d = defaultdict(float), defaultdict(float), defaultdict(float)
    for a, r, u, k, v in rows:
        if r in CODE_INDUSTRY and k in CODE_INDUSTRY:
            z[fold(a), CODE_INDUSTRY[r], fold(u), CODE_INDUSTRY[k]] += v
        if r in c.FLAT_VALUE_ADDED_ROWS and k in CODE_INDUSTRY:
            va[fold(u), CODE_INDUSTRY[k], "TLS" if r == "D21X31" else "VA"] += v
        if r in CODE_INDUSTRY and ("P3" in k or "P5" in k):
            d[fold(a), CODE_INDUSTRY[r], fold(u), k] += v
    return dict(z), dict(va), dict(d)


FLAT_HEADER = ["icsup", "refArea", "rowIi", "counterpartArea", "colIi", "obsValue"]


@pytest.fixture(scope="module")
def flat_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("flat")
    put(folder / "flatfile_eu-ic-io_ind-by-ind_24ed_2020.csv", [FLAT_HEADER] + [["x", *r] for r in flat_rows()], ",")
    ghg = [["industry", "ref_area", "obs_value"], ["B", "AT", "1.5"], ["B", "FR", "2"], ["B", "TW", "3"], ["Z99", "AT", "9"]]
    put(folder / "greenhouse-gas-footprints_2024-edition_2020-data.csv", ghg, ",")
    return folder


def test_flat_alignment(spark, setting, flat_folder):
    crosswalk, kept = setting
    accounts = align_flat_folder(spark, str(flat_folder), crosswalk, kept)
    z, va, d = expected_flat(flat_rows())
    assert by_key(accounts.z) == z
    assert by_key(accounts.va) == va
    assert by_key(accounts.d) == d
    assert by_key(accounts.emissions) == {("AT", "BZ"): 1500.0, ("ROW", "BZ"): 5000.0}


def test_flat_missing_value_poisons_one_cell(spark, setting, flat_folder):
    crosswalk, kept = setting
    path = str(flat_folder / "flatfile_eu-ic-io_ind-by-ind_24ed_2020.csv")
    flat = read_flat_file(spark, path)
    extra = spark.createDataFrame([("AT", "A01", "DE", "A02", None)], flat.schema)
    z, va, d = expected_flat(flat_rows())
    z["AT", "A01T02", "DE", "A01T02"] = None
    accounts = align_flat(flat.unionByName(extra), crosswalk, kept)
    assert by_key(accounts.z) == z and by_key(accounts.va) == va and by_key(accounts.d) == d
    assert accounts.emissions is None and set(accounts.by_name()) == {"Z", "VA", "D"}


def test_flat_emissions_file_is_required(spark, setting, tmp_path):
    put(tmp_path / "flatfile_ind-by-ind.csv", [FLAT_HEADER], ",")
    with pytest.raises(FileNotFoundError):
        align_flat_folder(spark, str(tmp_path), *setting)


def test_a_row_may_serve_two_accounts(spark, setting):
    """A code that is both an industry and matches the demand pattern counts in both."""
    _, kept = setting
    crosswalk = spark.createDataFrame(
        [("s", "D01", "X", "A01"), ("s", "P3x", "Y", "P3x")], "src string, raw_industry string, industry string, code string"
    )
    flat = spark.createDataFrame(
        [("AT", "A01", "DE", "P3x", 2.0)],
        "refArea string, rowIi string, counterpartArea string, colIi string, obsValue double",
    )
    accounts = align_flat(flat, crosswalk, kept)
    assert by_key(accounts.z) == {("AT", "X", "DE", "Y"): 2.0}
    assert by_key(accounts.d) == {("AT", "X", "DE", "P3x"): 2.0}


# --- wide table -------------------------------------------------------------------------

WIDE_INDUSTRY = {"A01_02": "A01T02", "B05_06": "BZ", "C17_18": "C17T18", "D": "D35", "J62_63": "JC", "T": "TZ"}


def wide_lines():
    draw = random.Random(2)
    countries = ["AUT", "DEU", "USA", "XXX"]
    labels = [f"{k}_{i}" for k in countries for i in WIDE_INDUSTRY]
    demand = [f"{k}_{i}" for k in countries for i in c.WIDE_DEMAND_CODES]
    columns = labels + demand + ["OUT"]
    lines = [["V1", *columns]]
    for row in labels + ["TLS", "VA", "OUT"]:
        lines.append([row, *[draw.randint(-5, 50) for _ in columns]])
    return lines


def expected_wide(lines, jc="JC"):
    iso = {"AUT": "AT", "DEU": "DE"}
    industry = {**WIDE_INDUSTRY, "J62_63": jc}
    component = {"GGFC": "P3_S13", "HFCE": "P3_S14", "NPISH": "P3_S15", "GFCF": "P51G"}
    z, va, d = defaultdict(float), defaultdict(float), defaultdict(float)
    for row in lines[1:]:
        for label, v in zip(lines[0][1:], row[1:]):
            if row[0] == "OUT" or label == "OUT":
                continue
            use, code = iso.get(label[:3], "ROW"), label[4:]
            if row[0] in ("VA", "TLS"):
                if code not in c.WIDE_DEMAND_CODES:
                    va[use, industry[code], row[0]] += v
                continue
            producer = (iso.get(row[0][:3], "ROW"), industry[row[0][4:]])
            if code in c.WIDE_DEMAND_CODES:
                d[(*producer, use, component.get(code, "P5M"))] += v
            else:
                z[(*producer, use, industry[code])] += v
    return dict(z), dict(va), dict(d)


@pytest.fixture(scope="module")
def wide_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("wide")
    put(folder / "2020_SML.csv", wide_lines(), ",")
    ghg = [
        ["TIME_PERIOD", "EMISSIONS_SCOPE", "EMISSIONS_ORIGIN_AREA", "ACTIVITY", "OBS_VALUE"],
        [2020, "S1", "AUT", "J62_63", 1.5],
        [2020, "S1", "XXX", "B05_06", 2],
        [2020, "S1", "USA", "B07_08", 3],
        [2020, "S2", "AUT", "J62_63", 100],
        [2019, "S1", "AUT", "J62_63", 100],
    ]
    put(folder / "DF_SCOPE.csv", ghg, ",")
    return folder


@pytest.mark.parametrize("compat, jc", [(False, "JC"), (True, "J62T63")])
def test_wide_alignment(spark, setting, wide_folder, compat, jc):
    _, kept = setting
    accounts = align_wide_folder(spark, str(wide_folder), kept, 2020, compat=compat)
    z, va, d = expected_wide(wide_lines(), jc)
    assert by_key(accounts.z) == z
    assert by_key(accounts.va) == va
    assert by_key(accounts.d) == d
    assert by_key(accounts.emissions) == {("AT", "JC"): 1500000.0, ("ROW", "BZ"): 5000000.0}


def test_wide_emissions_file_is_required(spark, setting, tmp_path):
    put(tmp_path / "2020_SML.csv", wide_lines(), ",")
    with pytest.raises(FileNotFoundError):
        align_wide_folder(spark, str(tmp_path), setting[1], 2020)


# --- weighted matrices ---------------------------------------------------------------------

LABELS = [(r, s) for r in REGIONS for s in SECTORS]
STRESSORS = [("CO2 - air", "kg", 1), ("CH4 - air", "kg", 28), ("PFC - air", "kg CO2-eq", 1), ("NOx - air", "kg", 0)]
DEMAND = [*c.MATRIX_DEMAND_COMPONENTS, "Exports: Total (fob)"]
FACTORS = [c.MATRIX_TAX_LABEL, "Compensation of employees", "Operating surplus"]


def release_numbers():
    draw = random.Random(3)
    return {
        "z": {(a, b): draw.randint(-9, 99) for a in LABELS for b in LABELS},
        "y": {(a, (r, k)): draw.randint(-30, 60) for a in LABELS for r in REGIONS for k in DEMAND},
        "f": {(k, b): draw.randint(1, 50) for k in FACTORS for b in LABELS},
        "e": {(s, b): draw.randint(0, 5000) for s, _, _ in STRESSORS for b in LABELS},
    }


def write_release(folder, n):
    blank = [""] * len(LABELS)
    top = [["region", "", *[r for r, _ in LABELS]], ["sector", "", *[s for _, s in LABELS]], ["region", "sector", *blank]]
    put(folder / "Z.txt", top + [[*a, *[n["z"][a, b] for b in LABELS]] for a in LABELS], "\t")
    y = [(r, k) for r in REGIONS for k in DEMAND]
    top = [["region", "", *[r for r, _ in y]], ["", "", *[k for _, k in y]], ["region", "sector", *[""] * len(y)]]
    put(folder / "Y.txt", top + [[*a, *[n["y"][a, b] for b in y]] for a in LABELS], "\t")
    top = [["region", *[r for r, _ in LABELS]], ["sector", *[s for _, s in LABELS]], ["stressor", *blank]]
    put(folder / "factor_inputs" / "F.txt", top + [[k, *[n["f"][k, b] for b in LABELS]] for k in FACTORS], "\t")
    gases = [[s, *[n["e"][s, b] for b in LABELS]] for s, _, _ in STRESSORS]
    put(folder / "air_emissions" / "F.txt", top + gases, "\t")
    put(folder / "air_emissions" / "unit.txt", [["stressor", "unit"]] + [[s, u] for s, u, _ in STRESSORS], "\t")


def reference_numbers():
    draw = random.Random(4)
    industries = sorted({i for _, i in PAIRS})
    return {(k, i): float(draw.randint(5, 90)) for k in ["AT", "DE", "ROW"] for i in industries}


def expected_weighted(n, reference):
    weight = {}
    for country in ["AT", "DE", "ROW"]:
        for sector in SECTORS:
            industries = sorted(i for s, i in PAIRS if s == sector)
            total = sum(reference[country, i] for i in industries)
            for i in industries:
                weight[country, sector, i] = 1.0 if len(industries) == 1 else reference[country, i] / total

    def targets(label):
        country = fold(label[0])
        return [(country, i, w) for (k, s, i), w in weight.items() if (k, s) == (country, label[1])]

    z, va, e = defaultdict(float), defaultdict(float), defaultdict(float)
    d = {
        (country, i, area, part): 0.0
        for country in ["AT", "DE", "ROW"] for i in {i for _, i in PAIRS}
        for area in ["AT", "DE", "ROW"] for part in c.DEMAND_COMPONENTS
    }
    for (a, b), v in n["z"].items():
        for ca, ia, wa in targets(a):
            for cb, ib, wb in targets(b):
                z[ca, ia, cb, ib] += v * wa * wb
    for (k, b), v in n["f"].items():
        for cb, ib, wb in targets(b):
            va[cb, ib, "TLS" if k == c.MATRIX_TAX_LABEL else "VA"] += v * wb
    for (s, b), v in n["e"].items():
        gwp = {name: g for name, _, g in STRESSORS}[s]
        for cb, ib, wb in targets(b):
            e[cb, ib] += v * gwp * wb / 1000
    for (a, (region, label)), v in n["y"].items():
        part = c.MATRIX_DEMAND_COMPONENTS.get(label)
        if v > 0 and part:
            for ca, ia, wa in targets(a):
                d[ca, ia, fold(region), part] += v * wa
    return weight, dict(z), dict(va), d, dict(e)


@pytest.fixture(scope="module")
def weighted(spark, setting, tmp_path_factory):
    folder = tmp_path_factory.mktemp("release")
    write_release(folder, release_numbers())
    crosswalk, kept = setting
    va = spark.createDataFrame(
        [(*k, v) for k, v in reference_numbers().items()], "country string, industry string, value double"
    )
    return align_weighted(read_release(spark, str(folder)), crosswalk, kept, va)


def test_weighted_alignment(weighted):
    weight, z, va, d, e = expected_weighted(release_numbers(), reference_numbers())
    assert {(r.country, r.src, r.industry): r.weight for r in weighted.key.collect()} == pytest.approx(weight)
    assert by_key(weighted.accounts.z) == pytest.approx(z)
    assert by_key(weighted.accounts.va) == pytest.approx(va)
    assert by_key(weighted.accounts.d) == pytest.approx(d)
    assert by_key(weighted.accounts.emissions) == pytest.approx(e)


def test_weighted_checks_pass(weighted):
    assert weighted.require_sound() is weighted
    assert weighted.gaps.count() == 0
    assert sum(v for v in by_key(weighted.accounts.z).values()) == pytest.approx(
        sum(release_numbers()["z"].values())
    )


def test_unknown_stressor_is_null_or_nothing(spark, setting, tmp_path):
    write_release(tmp_path, release_numbers())
    release, kept = read_release(spark, str(tmp_path)), setting[1]
    known = release.units.where("stressor <> 'CH4 - air'")
    totals = emission_totals(release.emissions, known, kept)
    assert totals.where("value IS NOT NULL").count() == 0
    zeroed = by_key(emission_totals(release.emissions, known, kept, unknown_as_zero=True))
    expected = defaultdict(float)
    for (s, (region, sector)), v in release_numbers()["e"].items():
        expected[fold(region), sector] += v * {n: 0 if n.startswith("CH4") else g for n, _, g in STRESSORS}[s]
    assert zeroed == dict(expected)


def test_rest_of_world_need_not_be_listed(spark, setting, weighted, tmp_path):
    write_release(tmp_path, release_numbers())
    crosswalk, kept = setting
    va = spark.createDataFrame(
        [(*k, v) for k, v in reference_numbers().items()], "country string, industry string, value double"
    )
    listed = kept.where("country <> 'ROW'")
    aligned = align_weighted(read_release(spark, str(tmp_path)), crosswalk, listed, va, strict=True)
    assert by_key(aligned.accounts.z) == pytest.approx(by_key(weighted.accounts.z))


def test_strict_alignment_reports_lost_sectors(spark, setting, tmp_path):
    write_release(tmp_path, release_numbers())
    crosswalk, kept = setting
    va = spark.createDataFrame(
        [(*k, v) for k, v in reference_numbers().items()], "country string, industry string, value double"
    )
    fewer = crosswalk.where("src <> 'Trade'")
    with pytest.raises(CheckFailed, match="Trade"):
        align_weighted(read_release(spark, str(tmp_path)), fewer, kept, va, strict=True)


def test_sparse_and_signed_demand(spark, setting, tmp_path):
    write_release(tmp_path, release_numbers())
    crosswalk, kept = setting
    va = spark.createDataFrame(
        [(*k, v) for k, v in reference_numbers().items()], "country string, industry string, value double"
    )
    aligned = align_weighted(
        read_release(spark, str(tmp_path)), crosswalk, kept, va, positive_demand_only=False, dense_demand=False
    )
    found = by_key(aligned.accounts.d)
    total = sum(v for (_, (_, k)), v in release_numbers()["y"].items() if k in c.MATRIX_DEMAND_COMPONENTS)
    assert sum(found.values()) == pytest.approx(total)
    assert not any(key[3] == "P3_S15" and v == 0.0 for key, v in found.items())


def test_reference_value_added(spark, setting, flat_folder):
    crosswalk, kept = setting
    flat = read_flat_file(spark, str(flat_folder / "flatfile_eu-ic-io_ind-by-ind_24ed_2020.csv"))
    expected = defaultdict(float)
    for (country, industry, _), v in expected_flat(flat_rows())[1].items():
        expected[country, industry] += v
    assert by_key(reference_value_added(flat, crosswalk, kept)) == dict(expected)


# --- comparison -------------------------------------------------------------------------------


def test_written_and_direct_comparison_agree(spark, setting, weighted, flat_folder, wide_folder, tmp_path, rows):
    crosswalk, kept = setting
    sources = {
        "FLAT": align_flat_folder(spark, str(flat_folder), crosswalk, kept),
        "MATRIX": weighted.accounts,
        "WIDE": align_wide_folder(spark, str(wide_folder), kept, 2020),
    }
    table = spark.createDataFrame([(2020, "EU27_2020", 0.5)], "TIME_PERIOD int, LOCATION string, OBS_VALUE double")
    rates = {"MATRIX": rate_of(table, 2020)}
    direct = compare_accounts(sources, rates)
    for name, accounts in sources.items():
        write_source(accounts, str(tmp_path / "out"), name)
    written = compare_folder(spark, str(tmp_path / "out"), rates)
    again = compare_folder(spark, str(tmp_path / "out"), rates, write=False)
    names = list(sources)
    for account, df in direct.items():
        keys = [k for k in df.columns if k not in names]
        assert rows(written[account], *keys, *names) == rows(df, *keys, *names)
        assert rows(again[account], *keys, *names) == rows(df, *keys, *names)

    z, _, _, e = expected_weighted(release_numbers(), reference_numbers())[1:]
    row = direct["Z"].where("use_id = 'AT_BZ' AND resource_id = 'DE_BZ'").first()
    assert row.MATRIX == pytest.approx(0.5 * z["DE", "BZ", "AT", "BZ"])
    row = direct["emissions"].where("id = 'AT_BZ'").first()
    assert (row.MATRIX, row.FLAT, row.WIDE) == (pytest.approx(e["AT", "BZ"]), 1500.0, 0.0)
    unions = set()
    for accounts in sources.values():
        unions |= {(f"{u}_{k}", f"{a}_{b}") for a, b, u, k in by_key(accounts.z)}
    assert {(r.use_id, r.resource_id) for r in direct["Z"].collect()} == unions


def test_industry_map_table(spark):
    assert industry_map(spark).count() == len(c.INDUSTRY_MAP)


# --- what must not happen unseen ------------------------------------------------------------------


def plain_va(spark):
    rows = [(*k, v) for k, v in reference_numbers().items()]
    return spark.createDataFrame(rows, "country string, industry string, value double")


def test_two_label_lines_give_the_same_transactions(spark, setting, weighted, tmp_path):
    write_release(tmp_path, release_numbers())
    lines = (tmp_path / "Z.txt").read_text().splitlines()
    (tmp_path / "Z.txt").write_text("\n".join(lines[:2] + lines[3:]) + "\n")
    aligned = align_weighted(read_release(spark, str(tmp_path)), *setting, plain_va(spark))
    assert by_key(aligned.accounts.z) == pytest.approx(by_key(weighted.accounts.z))


def test_a_sector_missing_from_the_matrix_is_an_error(spark, setting, tmp_path):
    write_release(tmp_path, release_numbers())
    lines = (tmp_path / "Z.txt").read_text().splitlines()
    at = next(i for i, label in enumerate(LABELS) if label == ("AT", "Trade"))
    cut = [line.split("\t") for line in lines if line.split("\t")[:2] != ["AT", "Trade"]]
    put(tmp_path / "Z.txt", [row[: 2 + at] + row[3 + at :] for row in cut], "\t")
    with pytest.raises(CheckFailed, match="Trade"):
        align_weighted(read_release(spark, str(tmp_path)), *setting, plain_va(spark))


def test_value_without_weights_is_kept_apart(spark, setting, tmp_path):
    write_release(tmp_path, release_numbers())
    crosswalk, kept = setting
    fewer = crosswalk.where("src <> 'Trade'")
    aligned = align_weighted(read_release(spark, str(tmp_path)), fewer, kept, plain_va(spark), strict=False)
    left = by_key(aligned.unweighted)
    assert {k[1] for k in left} == {c.UNWEIGHTED}
    total = sum(by_key(aligned.accounts.z).values()) + sum(left.values())
    assert total == pytest.approx(sum(release_numbers()["z"].values()))


def test_flat_facts_are_not_shuffled_for_their_codes(spark, setting, flat_folder, tmp_path):
    from weftable.plans.flat import classify_flat, flat_emissions
    from weftable.sources.tables import read_flat_emissions

    crosswalk, kept = setting
    flat = read_flat_file(spark, str(flat_folder / "flatfile_eu-ic-io_ind-by-ind_24ed_2020.csv"))
    ghg = read_flat_emissions(spark, str(flat_folder / "greenhouse-gas-footprints_2024-edition_2020-data.csv"))
    for df in (classify_flat(flat, crosswalk, kept), reference_value_added(flat, crosswalk, kept), flat_emissions(ghg, crosswalk, kept)):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan
        assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(rowIi" in x or "Exchange hashpartitioning(colIi" in x]


def test_a_code_of_two_industries_is_an_error(spark, setting):
    from weftable.operators.crosswalk import code_industries

    crosswalk, _ = setting
    wrong = crosswalk.unionByName(crosswalk.where("code = 'B'").selectExpr("src", "raw_industry", "'DZ' industry", "code"))
    with pytest.raises(CheckFailed, match="several industries"):
        code_industries(wrong)


def test_a_total_of_nothing_is_conserved(spark):
    from weftable.operators.checks import conservation

    raw = spark.createDataFrame([("AT", 0.1), ("AT", 0.2), ("AT", -0.3)], "k string, value double")
    aligned = spark.createDataFrame([("AT", -0.3), ("AT", 0.2), ("AT", 0.1), ("AT", 1e-13)], "k string, value double")
    assert conservation(raw, aligned, ["k"]).first().conserved
    lost = spark.createDataFrame([("AT", -0.3), ("AT", 0.2)], "k string, value double")
    assert not conservation(raw, lost, ["k"]).first().conserved


def test_first_unit_of_a_stressor_counts(spark, tmp_path, rows):
    from weftable.operators.convert import gas_factors
    from weftable.sources.tables import read_units

    put(tmp_path / "u.txt", [["stressor", "unit"], ["CH4 - air", "kg CO2-eq"], ["CH4 - air", "kg"], ["SF6", "kg"], ["SF6", "kg CO2-eq"]], "\t")
    assert rows(gas_factors(read_units(spark, str(tmp_path / "u.txt"))), "stressor", "gwp") == [("CH4 - air", 1), ("SF6", 23500)]
