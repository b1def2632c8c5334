"""The registered queries: each takes a session and a folder of tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftable import classification as c
from weftable.bindings import tables as t
from weftable.bindings.text import write_wide_text
from weftable.functions import recode
from weftable.functions.aggregates import null_sum, zero_sum
from weftable.functions.labels import split_id, unite_id
from weftable.operators import checks, convert, lookup, reshape, spread
from weftable.operators.asof import asof_join
from weftable.operators.crosswalk import (
    build_crosswalk,
    code_industries,
    hybrid_grid,
    industry_map,
    source_industries,
)
from weftable.operators.fold import fold_countries, kept_countries
from weftable.operators.weights import repartition_keys
from weftable.plans import flat, weighted, wide
from weftable.plans.comparison import compare_accounts, compare_folder, write_source
from weftable.schemas import Accounts
from weftable.sources import sinks, tables, vintages
from weftable.sources.matrix import read_matrix
from weftable.sources.staging import new_folder, stage

PRODUCER = ["resource_country", "resource_src"]
PRODUCER_AS_KEY = {"resource_country": "country", "resource_src": "src"}
RATE = 0.9

# Demand label of a matrix played by each order priority; one has no component.
DEMAND_LABELS = {
    "1-URGENT": "Final consumption expenditure by government",
    "2-HIGH": "Final consumption expenditure by households",
    "3-MEDIUM": "Gross fixed capital formation",
    "4-NOT SPECIFIED": "Exports: Total (fob)",
    "5-LOW": "Changes in inventories",
}


def _double(name: str = "value") -> Column:
    return F.col(name).cast("double").alias(name)


def _rounded(name: str = "value") -> Column:
    return F.round(F.col(name), 3).alias(name)


# --- weights and weighted accounts ----------------------------------------------


def repartition_key(spark: SparkSession, folder: str) -> DataFrame:
    key = t.key(spark, folder)
    return key.select("country", "src", "industry", F.round("weight", 9).alias("weight"))


def z_two_sided(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions between common industries; what has no weights in rows of its own."""
    cells = t.cells(spark, folder)
    flows = cells.select(
        "resource_country", "resource_src", "use_country", "use_src", _double()
    )
    z = spread.spread_whole(flows, t.key(spark, folder, cells))
    return sinks.with_ids(z, "Z").select("resource_id", "use_id", _rounded())


def key_conservation(spark: SparkSession, folder: str) -> DataFrame:
    sums = t.producer_sums(spark, folder)
    totals = (
        sums.withColumnsRenamed(PRODUCER_AS_KEY)
        .groupBy("country", "src")
        .agg(null_sum("value").cast("double").alias("value"))
    )
    checked = checks.key_conservation(totals, t.key(spark, folder, sums))
    return checked.select("country", F.round("raw_total", 2).alias("raw_total"), "conserved")


def z_conservation(spark: SparkSession, folder: str) -> DataFrame:
    cells = t.cells(spark, folder)
    flows = cells.withColumn("value", _double())
    whole = spread.spread_whole(flows, t.key(spark, folder, cells))
    checked = checks.conserved(whole, ["resource_country"])
    return checked.select(
        F.col("resource_country").alias("country"),
        F.round("raw_total", 2).alias("raw_total"),
        "conserved",
    )


def global_total(spark: SparkSession, folder: str) -> DataFrame:
    """Total of the transactions before and after alignment, as whole numbers."""
    cells = t.cells(spark, folder)
    flows = cells.withColumn("value", _double())
    whole = spread.spread_whole(flows, t.key(spark, folder, cells))
    aligned = F.when(F.col("resource_industry") != c.UNWEIGHTED, F.col("value"))
    sides = F.array(
        F.struct(F.lit("raw").alias("side"), F.bround(F.sum("raw")).alias("total")),
        F.struct(F.lit("aligned").alias("side"), F.bround(F.sum(aligned)).alias("total")),
    )
    return whole.agg(sides.alias("sides")).select(F.inline("sides"))


def coverage_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of the flows against a crosswalk that lacks two brands and has one too many."""
    sums = t.producer_sums(spark, folder)
    pairs = t.crosswalk(spark, folder)
    changed = pairs.where(~F.col("src").isin("Brand#7", "Brand#14")).unionByName(
        pairs.where(F.col("src") == "Brand#1").withColumn("src", F.lit("Brand#99"))
    )
    key = stage(repartition_keys(changed, t.reference_va(sums), t.countries(spark, folder)), "key")
    labels = sums.withColumnsRenamed(PRODUCER_AS_KEY).select("country", "src")
    return checks.coverage_gaps(labels, key)


def va_weighted(spark: SparkSession, folder: str) -> DataFrame:
    sums = t.producer_sums(spark, folder)
    key = t.key(spark, folder, sums)
    components = (
        sums.withColumnsRenamed(PRODUCER_AS_KEY)
        .select("country", "src", F.col("tls").alias("TLS"), F.col("value").alias("VA"))
        .unpivot(["country", "src"], list(c.VALUE_ADDED_COMPONENTS), "component", "value")
    )
    totals = components.groupBy("country", "src", "component").agg(
        null_sum("value").cast("double").alias("value")
    )
    return weighted.weighted_va(totals, key).withColumn("value", _rounded())


def d_weighted_dense(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["resource_country", "resource_src", "resource_type", "use_country", "priority"]
    sums = stage(
        t.flows(spark, folder)
        .groupBy(*keys)
        .agg(
            null_sum("v").alias("value"),
            F.sum(F.when(F.col("dv") > 0, F.col("dv"))).alias("demand"),
        ),
        "demand",
    )
    key = t.key(spark, folder, sums)
    totals = (
        sums.withColumnsRenamed(
            {**PRODUCER_AS_KEY, "use_country": "counterpartarea", "priority": "component"}
        )
        .where("component <> '4-NOT SPECIFIED' AND demand IS NOT NULL")
        .groupBy("country", "src", "component", "counterpartarea")
        .agg(null_sum("demand").cast("double").alias("value"))
    )
    components = stage(totals.select("component").distinct(), "components")
    index = weighted.demand_index(key, t.countries(spark, folder), components)
    dense = spread.spread_dense(totals, key, index, ["component", "counterpartarea"])
    return dense.withColumn("value", _rounded())


def emissions_weighted(spark: SparkSession, folder: str) -> DataFrame:
    events = t.emissions(spark, folder)
    stressors = recode.map_values("event", {k: v[0] for k, v in t.EVENT_STRESSORS.items()})
    gwp = recode.warming_potential(stressors, F.lit("kg"))
    totals = (
        events.groupBy("country", "src")
        .agg(null_sum(F.col("v") * gwp).cast("double").alias("value"))
    )
    key = t.key(spark, folder)
    return weighted.weighted_emissions(totals, key).withColumn("value", F.round("value", 5))


# --- recoded accounts ---------------------------------------------------------------


def z_recode(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["resource_country", "resource_type", "use_country", "use_src"]
    return (
        t.flows(spark, folder)
        .groupBy(*keys)
        .agg(null_sum("v").cast("double").alias("value"))
    )


def va_recode(spark: SparkSession, folder: str) -> DataFrame:
    rows = t.flows(spark, folder).withColumn("code", t.pick(t.VALUE_ADDED_CODES, F.col("line") - 1))
    component = recode.flat_value_added_component("code").alias("component")
    return (
        rows.where(F.col("code").isin(*c.FLAT_VALUE_ADDED_ROWS))
        .groupBy(
            F.col("use_country").alias("country"), F.col("resource_type").alias("industry"), component
        )
        .agg(null_sum("v").cast("double").alias("value"))
    )


def d_recode(spark: SparkSession, folder: str) -> DataFrame:
    rows = t.flows(spark, folder).withColumn(
        "code",
        F.when(F.col("line") == 1, F.lit("NPISH")).otherwise(
            recode.map_values("priority", t.PRIORITY_DEMAND)
        ),
    )
    return (
        rows.where(F.col("code").isin(*c.WIDE_DEMAND_CODES))
        .groupBy(
            F.col("resource_country").alias("country"),
            F.col("resource_type").alias("industry"),
            F.col("use_country").alias("counterpartarea"),
            recode.wide_demand_component("code").alias("component"),
        )
        .agg(null_sum("dv").cast("double").alias("value"))
    )


def _wide_ghg(spark: SparkSession, folder: str) -> DataFrame:
    """Events as the emissions table of the wide source."""
    return t.emissions(spark, folder).select(
        F.col("year").alias("TIME_PERIOD"),
        F.when(F.col("event").isin("click", "view"), F.lit("S1")).otherwise(F.lit("S2")).alias(
            "EMISSIONS_SCOPE"
        ),
        t.pick(t.NATION_ISO3, F.col("nation")).alias("EMISSIONS_ORIGIN_AREA"),
        t.pick(t.WIDE_CODES, F.col("sector")).alias("ACTIVITY"),
        F.col("v").alias("OBS_VALUE"),
    )


def emissions_recode(spark: SparkSession, folder: str) -> DataFrame:
    ghg, kept = _wide_ghg(spark, folder), _kept_iso2(spark, folder)
    return wide.wide_emissions(ghg, kept, 2024).withColumn("value", _double())


def _kept_iso2(spark: SparkSession, folder: str) -> DataFrame:
    """Kept countries of the nation table by the alpha-2 code their nation plays."""
    nation = t.table(spark, folder, "nation").withColumnRenamed("n_name", "country")
    return nation.join(t.kept_nations(spark, folder), "country", "left_semi").select(
        F.coalesce(
            recode.iso2(t.pick(t.NATION_ISO3, F.col("n_nationkey"))), F.lit(c.REST_OF_WORLD)
        ).alias("country")
    )


# --- whole alignments -----------------------------------------------------------------


def _account_rows(accounts: Accounts, places: int = 3) -> DataFrame:
    """All accounts as one table: account, four labels, value."""
    no = F.lit(None).cast("string")
    z = accounts.z.select(
        F.lit("Z").alias("account"),
        F.col("resource_country").alias("a"),
        F.col("resource_industry").alias("b"),
        F.col("use_country").alias("c"),
        F.col("use_industry").alias("d"),
        "value",
    )
    va = accounts.va.select(
        F.lit("VA").alias("account"),
        F.col("country").alias("a"),
        F.col("industry").alias("b"),
        no.alias("c"),
        F.col("component").alias("d"),
        "value",
    )
    d = accounts.d.select(
        F.lit("D").alias("account"),
        F.col("country").alias("a"),
        F.col("industry").alias("b"),
        F.col("counterpartarea").alias("c"),
        F.col("component").alias("d"),
        "value",
    )
    rows = z.unionByName(va).unionByName(d)
    if accounts.emissions is not None:
        e = accounts.emissions.select(
            F.lit("emissions").alias("account"),
            F.col("country").alias("a"),
            F.col("industry").alias("b"),
            no.alias("c"),
            no.alias("d"),
            "value",
        )
        rows = rows.unionByName(e)
    return rows.withColumn("value", F.round(F.col("value").cast("double"), places))


def _flat_source(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as a long flat file: lines 1-3 transactions, 4-5 value added, 6-7 demand."""
    line = F.col("line")
    producer = t.pick(t.FLAT_CODES, F.col("resource_sector"))
    user = t.pick(t.FLAT_CODES, F.col("use_sector"))
    row_code = t.pick(t.VALUE_ADDED_CODES, F.col("use_sector") % 7)
    return t.flows(spark, folder).select(
        F.col("resource_country").alias("refArea"),
        F.when(line.isin(4, 5), row_code).otherwise(producer).alias("rowIi"),
        F.col("use_country").alias("counterpartArea"),
        F.when(line.isin(6, 7), recode.map_values("priority", t.PRIORITY_COMPONENT))
        .otherwise(F.when(line.isin(4, 5), producer).otherwise(user))
        .alias("colIi"),
        F.col("dv").alias("obsValue"),
    )


def _one_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as a one-hot crosswalk: brand and size class by six industry columns."""
    flags = {
        "D01T02": "STANDARD",
        "D05T06": "MEDIUM",
        "D07T08": "ECONOMY",
        "D45T47": "PROMO",
        "D69T75": "SMALL",
        "D61": "LARGE",
    }
    label = F.when(F.col("p_brand") == "Brand#25", F.lit(c.EXTRATERRITORIAL_LABEL)).otherwise(
        F.col("p_brand")
    )
    hit = {
        code: F.max(F.when(F.col("p_type") == kind, 1).otherwise(0))
        for code, kind in flags.items()
    }
    return (
        t.table(spark, folder, "part")
        .groupBy((F.col("p_size") % 4).cast("string").alias(c.CROSSWALK_COUNTRY), label.alias(c.CROSSWALK_SOURCE))
        .agg(
            F.first(F.lit("x")).alias("PaysLib"),
            F.first(F.lit("x")).alias("ExioCode"),
            F.first(F.lit("x")).alias("vrai_code"),
            *[value.alias(code) for code, value in hit.items()],
        )
    )


def _full_crosswalk(spark: SparkSession) -> DataFrame:
    """The fixed industry map as a crosswalk of its own raw industries."""
    return industry_map(spark).select(
        F.col("raw_industry").alias("src"), "raw_industry", "industry", F.explode("codes").alias("code")
    )


def _full_one_hot(spark: SparkSession) -> DataFrame:
    """The same as a one-hot table: each raw industry marks its own column."""
    raw = [name for name, _, _ in c.INDUSTRY_MAP]
    labels = [c.CROSSWALK_COUNTRY, *c.CROSSWALK_UNUSED]
    return industry_map(spark).select(
        *[F.lit("x").alias(name) for name in labels],
        F.col("raw_industry").alias(c.CROSSWALK_SOURCE),
        *[(F.col("raw_industry") == name).cast("int").alias(name) for name in dict.fromkeys(raw)],
    )


def _flat_kept(spark: SparkSession, folder: str) -> DataFrame:
    return t.countries(spark, folder)


def flat_accounts(spark: SparkSession, folder: str) -> DataFrame:
    source = _flat_source(spark, folder)
    ghg = t.emissions(spark, folder).select(
        t.pick(t.FLAT_CODES, F.col("sector")).alias("industry"),
        F.col("country").alias("ref_area"),
        F.col("v").alias("obs_value"),
    )
    accounts = flat.align_flat(source, _full_crosswalk(spark), _flat_kept(spark, folder), ghg)
    return _account_rows(accounts)


def _write_table(df: DataFrame, path: str, sep: str = ",") -> None:
    """A delimited table with a header, as releases have it."""
    df.write.option("header", True).option("sep", sep).csv(path)


def flat_release(spark: SparkSession, folder: str) -> DataFrame:
    """The same accounts from a release folder: its files and a crosswalk written, chosen by name and read."""
    root = new_folder(spark, "flat_release")
    _write_table(_flat_source(spark, folder), f"{root}/flatfile_eu-ic-io_ind-by-ind_24ed_2020.csv")
    ghg = t.emissions(spark, folder).select(
        t.pick(t.FLAT_CODES, F.col("sector")).alias("industry"),
        F.col("country").alias("ref_area"),
        F.col("v").alias("obs_value"),
    )
    _write_table(ghg, f"{root}/greenhouse-gas-footprints_2020-data.csv")
    _write_table(_full_one_hot(spark), f"{root}/crosswalk.csv")
    crosswalk = build_crosswalk(tables.read_crosswalk(spark, f"{root}/crosswalk.csv"))
    return _account_rows(flat.align_flat_folder(spark, root, crosswalk, _flat_kept(spark, folder)))


def reference_value_added(spark: SparkSession, folder: str) -> DataFrame:
    source = _flat_source(spark, folder)
    return flat.reference_value_added(
        source, _full_crosswalk(spark), _flat_kept(spark, folder)
    ).withColumn("value", _double())


def _write_wide_source(spark: SparkSession, folder: str, path: str) -> str:
    """Order lines as a published wide table: lines 1-4 transactions, 5-7 demand."""
    iso = lambda nation: t.pick(t.NATION_ISO3, F.col(nation))
    row = unite_id(iso("resource_nation"), t.pick(t.WIDE_CODES, F.col("resource_sector")))
    is_demand = F.col("line") >= 5
    use_code = F.when(is_demand, recode.map_values("priority", t.PRIORITY_DEMAND)).otherwise(
        t.pick(t.WIDE_CODES, F.col("use_sector"))
    )
    column = unite_id(iso("use_nation"), use_code)
    flows = t.flows(spark, folder).select(
        row.alias("row"), column.alias("col"), "dv", "tls", is_demand.alias("is_demand")
    )

    def cell(row: Column, col: Column, value: Column) -> Column:
        return F.struct(row.alias("V1"), col.alias("use"), value.alias("value"))

    cells = flows.select(
        F.explode(
            F.array(
                cell(F.col("row"), F.col("col"), F.col("dv")),
                cell(F.lit("VA"), F.col("col"), F.col("dv")),
                cell(F.lit("TLS"), F.col("col"), F.col("tls")),
                cell(F.col("row"), F.lit("OUT"), F.col("dv")),
                cell(F.lit("OUT"), F.col("col"), F.col("dv")),
            )
        ).alias("cell")
    ).select("cell.*")
    return write_wide_text(cells, ["V1"], ["use"], path, [["V1"]], sep=",")


def wide_release(spark: SparkSession, folder: str) -> DataFrame:
    """The same accounts and emissions from a release folder, files chosen by name."""
    root = new_folder(spark, "wide_release")
    _write_wide_source(spark, folder, f"{root}/2024_SML.csv")
    _write_table(_wide_ghg(spark, folder), f"{root}/{c.WIDE_EMISSIONS_FILE}")
    return _account_rows(wide.align_wide_folder(spark, root, _kept_iso2(spark, folder), 2024))


def wide_accounts(spark: SparkSession, folder: str) -> DataFrame:
    path = _write_wide_source(spark, folder, new_folder(spark, "wide"))
    kept = _kept_iso2(spark, folder)
    return _account_rows(wide.align_wide(tables.read_wide_table(spark, path), kept))


def weighted_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """A release of four matrices and a unit table written as text, read back and aligned by weights."""
    keys = [
        "resource_country", "resource_src", "resource_type", "use_country", "use_src", "priority",
    ]
    sums = stage(
        t.flows(spark, folder)
        .groupBy(*keys)
        .agg(
            null_sum("v").alias("value"),
            null_sum("dv").alias("dv"),
            null_sum("tls").alias("tls"),
        ),
        "sums",
    )
    root = new_folder(spark, "release")
    two = [["region", ""], ["sector", ""], ["region", "sector"]]
    one = [["region"], ["sector"], ["stressor"]]
    use = ["use_country", "use_src"]
    write_wide_text(sums, PRODUCER, use, f"{root}/Z.txt", two)

    label = recode.map_values("priority", DEMAND_LABELS)
    demand = sums.select(*PRODUCER, "use_country", label.alias("label"), F.col("dv").alias("value"))
    write_wide_text(demand, PRODUCER, ["use_country", "label"], f"{root}/Y.txt", two)

    factors = sums.select(
        *PRODUCER,
        F.explode(
            F.array(
                F.struct(F.lit(c.MATRIX_TAX_LABEL).alias("component"), F.col("tls").alias("value")),
                F.struct(F.lit("Compensation of employees").alias("component"), F.col("value")),
                F.struct(F.lit("Operating surplus").alias("component"), F.col("dv").alias("value")),
            )
        ).alias("f"),
    ).select(*PRODUCER, "f.component", "f.value")
    write_wide_text(factors, ["component"], PRODUCER, f"{root}/factor_inputs/F.txt", one)

    events = t.emissions(spark, folder)
    stressor = recode.map_values("event", {k: v[0] for k, v in t.EVENT_STRESSORS.items()})
    gases = events.select(stressor.alias("stressor"), "country", "src", F.col("v").alias("value"))
    write_wide_text(gases, ["stressor"], ["country", "src"], f"{root}/air_emissions/F.txt", one)
    units = events.select(stressor.alias("stressor"), F.lit("kg").alias("unit")).distinct()
    _write_table(units, f"{root}/air_emissions/unit.txt", sep="\t")

    pairs = stage(t.crosswalk(spark, folder), "crosswalk")
    release = weighted.read_release(spark, root)
    aligned = weighted.align_weighted(
        release, pairs, t.countries(spark, folder), t.reference_va(sums), strict=False
    )
    whole = aligned.accounts.z.unionByName(aligned.unweighted)
    return _account_rows(replace(aligned.accounts, z=whole))


# --- comparison ---------------------------------------------------------------------------


FLAGS = ("A", "N", "R")


def _rate() -> dict[str, Column]:
    return {"A": F.lit("0.9").cast("decimal(3,1)")}


def _by_flag(df: DataFrame) -> dict[str, DataFrame]:
    return {flag: df.where(F.col("flag") == flag).drop("flag") for flag in FLAGS}


def _compared(sums: DataFrame, account: str) -> DataFrame:
    """Comparison of the three return flags as sources, from sums that carry the flag."""
    staged = stage(sums, "sums")
    parts = _by_flag(staged)
    accounts = {
        flag: Accounts(
            z=df if account == "Z" else None,
            va=df if account == "VA" else None,
            d=df if account == "D" else None,
            emissions=df if account == "emissions" else None,
        )
        for flag, df in parts.items()
    }
    compared = compare_accounts(accounts, _rate())[account]
    named = compared.withColumnsRenamed({flag: f"src_{flag.lower()}" for flag in FLAGS})
    return named.withColumns({f"src_{flag.lower()}": _double(f"src_{flag.lower()}") for flag in FLAGS})


def compare_z(spark: SparkSession, folder: str) -> DataFrame:
    sums = (
        t.flows(spark, folder)
        .withColumnsRenamed({"resource_type": "resource_industry", "use_src": "use_industry"})
        .groupBy("flag", *spread.Z_KEYS)
        .agg(null_sum("v").alias("value"))
    )
    return _compared(sums, "Z")


def compare_va(spark: SparkSession, folder: str) -> DataFrame:
    component = F.when(F.col("line") == 1, F.lit("TLS")).otherwise(F.lit("VA"))
    sums = (
        t.flows(spark, folder)
        .withColumns({"country": F.col("use_country"), "industry": F.col("use_src"), "component": component})
        .groupBy("flag", "country", "industry", "component")
        .agg(null_sum("v").alias("value"))
    )
    return _compared(sums, "VA")


def compare_d(spark: SparkSession, folder: str) -> DataFrame:
    sums = (
        t.flows(spark, folder)
        .withColumnsRenamed(
            {
                "resource_country": "country",
                "resource_src": "industry",
                "use_country": "counterpartarea",
                "priority": "component",
            }
        )
        .groupBy("flag", "country", "industry", "counterpartarea", "component")
        .agg(null_sum("dv").alias("value"))
    )
    return _compared(sums, "D")


def compare_emissions(spark: SparkSession, folder: str) -> DataFrame:
    sources = {"click": "A", "view": "N", "purchase": "R", "error": "A", "signup": "N"}
    sums = (
        t.emissions(spark, folder)
        .withColumn("flag", recode.map_values("event", sources))
        .groupBy("flag", "country", F.col("src").alias("industry"))
        .agg(null_sum("v").alias("value"))
    )
    return _compared(sums, "emissions")


def compare_written(spark: SparkSession, folder: str) -> DataFrame:
    """Three sources written as account files, found again and compared from the files."""
    keys = [
        "flag", "resource_country", "resource_type", "use_country", "use_src", "priority",
    ]
    sums = stage(t.flows(spark, folder).groupBy(*keys).agg(null_sum("v").alias("value")), "sums")
    root = new_folder(spark, "hybrid")
    for flag, df in _by_flag(sums).items():
        placed = df.withColumnsRenamed({"resource_country": "country", "resource_type": "industry"})

        def total(*names: str) -> DataFrame:
            return placed.groupBy(*names).agg(null_sum("value").cast("double").alias("value"))

        z = df.withColumnsRenamed({"resource_type": "resource_industry", "use_src": "use_industry"})
        accounts = Accounts(
            z=z.groupBy(*spread.Z_KEYS).agg(null_sum("value").cast("double").alias("value")),
            va=total("country", "industry", F.col("priority").alias("component")),
            d=total(
                "country",
                "industry",
                F.col("use_country").alias("counterpartarea"),
                F.col("priority").alias("component"),
            ),
            emissions=total("country", "industry"),
        )
        write_source(accounts, root, f"SRC_{flag}")
    compared = compare_folder(spark, root, {"SRC_A": RATE})
    no = F.lit(None).cast("string")
    sources = [f"SRC_{flag}" for flag in FLAGS]
    parts = []
    for account, df in compared.items():
        first = "resource_id" if account == "Z" else "id"
        second = {"Z": "use_id", "VA": "component", "D": "component"}.get(account)
        parts.append(
            df.select(
                F.lit(account).alias("account"),
                F.col(first).alias("a"),
                (F.col(second) if second else no).alias("b"),
                (F.col("counterpartarea") if account == "D" else no).alias("c"),
                *[F.round(F.col(s), 3).alias(s.lower()) for s in sources],
            )
        )
    return reshape.append(*parts)


def currency_convert(spark: SparkSession, folder: str) -> DataFrame:
    """Columns named value_* of a wide table at the rate of one year; others stay."""
    rates = spark.createDataFrame(
        pa.table(
            {
                "TIME_PERIOD": pa.array([2019, 2020, 2020], pa.int32()),
                "LOCATION": [c.RATE_LOCATION, c.RATE_LOCATION, "GBR"],
                "OBS_VALUE": [0.5, 0.75, 0.25],
            }
        )
    )
    amount = lambda flag: F.sum(F.when(F.col("flag") == flag, F.col("v"))).cast("double")
    totals = t.producer_lines(spark, folder).groupBy("resource_country", "resource_type").agg(
        amount("A").alias("value_a"),
        amount("N").alias("value_n"),
        F.sum("tls").cast("double").alias("quantity"),
    )
    converted = convert.convert_currency(totals, convert.rate_of(rates, 2020), "^value")
    return converted.withColumns({"value_a": F.round("value_a", 5), "value_n": F.round("value_n", 5)})


def rate_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A rate per year written and read as a rate table, one of them applied.

    The rate of a year is its number of orders in thousands.
    """
    rates = (
        t.table(spark, folder, "orders")
        .groupBy(F.year("o_orderdate").alias("TIME_PERIOD"))
        .agg((F.count(F.lit(1)) / 1000).alias("OBS_VALUE"))
        .select("TIME_PERIOD", F.lit(c.RATE_LOCATION).alias("LOCATION"), "OBS_VALUE")
    )
    path = f"{new_folder(spark, 'rates')}/rates.csv"
    _write_table(rates, path)
    totals = t.producer_lines(spark, folder).groupBy("resource_country").agg(
        null_sum("v").cast("double").alias("value")
    )
    rate = convert.rate_of(tables.read_rates(spark, path), 2000)
    return convert.convert_currency(totals, rate).withColumn("value", F.round("value", 6))


# --- crosswalk, countries, lookups ----------------------------------------------------------


def crosswalk_build(spark: SparkSession, folder: str) -> DataFrame:
    return build_crosswalk(_one_hot(spark, folder))


def crosswalk_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The same crosswalk from a written one-hot file."""
    path = f"{new_folder(spark, 'crosswalk')}/crosswalk.csv"
    _write_table(_one_hot(spark, folder), path)
    return build_crosswalk(tables.read_crosswalk(spark, path))


def crosswalk_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct pairs and codes: how many industries a label and labels an industry has."""
    crosswalk = build_crosswalk(_one_hot(spark, folder))
    pairs = source_industries(crosswalk).groupBy("industry").agg(
        F.count(F.lit(1)).alias("sources")
    )
    codes = code_industries(crosswalk).groupBy("industry").agg(F.count(F.lit(1)).alias("codes"))
    return pairs.join(codes, "industry")


def country_fold(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct kept countries of the customers; listed nations are folded."""
    nation = t.table(spark, folder, "nation")
    customer = t.table(spark, folder, "customer")
    named = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rest = [f"NATION_{k}" for k in range(len(t.NATION_ISO3)) if k % 5 in (0, 4)]
    return kept_countries(named, "n_name", rest)


def fold_unlisted(spark: SparkSession, folder: str) -> DataFrame:
    """Account balance by folded country; missing and unlisted codes go to the rest."""
    nation = t.table(spark, folder, "nation")
    customer = t.table(spark, folder, "customer")
    named = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("n_name")).alias("country"),
        t.money("c_acctbal").alias("balance"),
    )
    folded = fold_countries(named, t.kept_nations(spark, folder), ["country"])
    return folded.groupBy("country").agg(
        F.sum("balance").cast("double").alias("balance"), F.count(F.lit(1)).alias("n")
    )


def hybrid_index(spark: SparkSession, folder: str) -> DataFrame:
    industries = t.table(spark, folder, "part").select(F.col("p_type").alias("industry"))
    return hybrid_grid(t.countries(spark, folder), industries)


def semi_join_filter(spark: SparkSession, folder: str) -> DataFrame:
    listed = _listed_parts(spark, folder)
    return _line_totals(lookup.keep_listed(_lines(spark, folder), listed, ["partkey"]))


def anti_join_filter(spark: SparkSession, folder: str) -> DataFrame:
    listed = _listed_parts(spark, folder)
    return _line_totals(lookup.drop_listed(_lines(spark, folder), listed, ["partkey"]))


def _listed_parts(spark: SparkSession, folder: str) -> DataFrame:
    part = t.table(spark, folder, "part")
    return part.where("p_type IN ('PROMO', 'SMALL')").select(F.col("p_partkey").alias("partkey"))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return t.table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("partkey"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linenumber").alias("line"),
        t.money("l_extendedprice").alias("v"),
    )


def _line_totals(lines: DataFrame) -> DataFrame:
    return lines.groupBy("flag", "line").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").cast("double").alias("value")
    )


def lookup_first_match(spark: SparkSession, folder: str) -> DataFrame:
    """Industry of each line's brand; a brand with several keeps its first, lines stay single."""
    dimension = t.crosswalk(spark, folder).select(F.col("src"), "industry", F.col("industry").alias("rank"))
    brands = t.table(spark, folder, "part").select(
        F.col("p_partkey").alias("partkey"), F.col("p_brand").alias("src")
    )
    lines = _lines(spark, folder).join(brands, "partkey")
    found = lookup.lookup(lines, dimension, ["src"], "rank")
    return found.groupBy("industry", "flag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").cast("double").alias("value")
    )


# --- sums, shapes, ids ------------------------------------------------------------------------


def _gappy(spark: SparkSession, folder: str) -> DataFrame:
    missing = (F.col("flag") == "A") & (F.col("line") == 7)
    return _lines(spark, folder).withColumn("v", F.when(~missing, F.col("v")))


def null_propagating_sum(spark: SparkSession, folder: str) -> DataFrame:
    return _gappy(spark, folder).groupBy("flag").agg(null_sum("v").cast("double").alias("value"))


def null_as_zero_sum(spark: SparkSession, folder: str) -> DataFrame:
    return _gappy(spark, folder).groupBy("flag", "line").agg(
        zero_sum("v").cast("double").alias("value")
    )


def _flag_columns(spark: SparkSession, folder: str) -> DataFrame:
    of = lambda flag: F.sum(F.when(F.col("flag") == flag, F.col("v")))
    return _lines(spark, folder).groupBy("partkey").agg(*[of(f).alias(f"flag_{f.lower()}") for f in FLAGS])


def row_total_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Total of three columns per part; a part that lacks one of them has none."""
    totals = reshape.with_row_total(_flag_columns(spark, folder), ["partkey"], "total")
    return totals.select("partkey", _double("total"))


def unpivot_wide(spark: SparkSession, folder: str) -> DataFrame:
    long = reshape.to_long(_flag_columns(spark, folder), ["partkey"], "flag", "value")
    return long.select("partkey", "flag", _double())


def transpose_labels(spark: SparkSession, folder: str) -> DataFrame:
    sums = t.flows(spark, folder).groupBy("resource_country", "use_country").agg(null_sum("v").alias("value"))
    return reshape.transpose(sums, "resource_country", "use_country").select(
        "resource_country", "use_country", _double()
    )


def append_union(spark: SparkSession, folder: str) -> DataFrame:
    """Three parts appended, one of them twice, and counted."""
    lines = _lines(spark, folder)
    parts = [lines.where(F.col("flag") == flag) for flag in FLAGS]
    return _line_totals(reshape.append(*parts, parts[0]))


def unite_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Country and type as one id; a missing part is written out."""
    flows = t.producer_lines(spark, folder).withColumn(
        "industry", F.when(F.col("resource_type") != "PROMO", F.col("resource_type"))
    )
    united = unite_id("resource_country", "industry").alias("id")
    return flows.groupBy(united).agg(null_sum("v").cast("double").alias("value"))


def split_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of nation key and country taken apart at the first underscore only."""
    joined = t.producer_lines(spark, folder).select(
        unite_id(F.col("resource_nation"), F.col("resource_country"), F.col("resource_type")).alias("id"), "v"
    )
    head, rest = split_id("id")
    return (
        joined.select(head.alias("nation"), rest.alias("rest"), "v")
        .groupBy("nation", "rest")
        .agg(null_sum("v").cast("double").alias("value"))
    )


def section_recode(spark: SparkSession, folder: str) -> DataFrame:
    """Wide-table codes by the section rules, in both of their readings."""
    flows = t.producer_lines(spark, folder).withColumn("code", t.pick(t.WIDE_CODES, F.col("resource_sector")))
    return flows.groupBy(
        recode.section_recode("code").alias("industry"),
        recode.section_recode(recode.wide_code("code"), compat=True).alias("compat_industry"),
    ).agg(null_sum("v").cast("double").alias("value"))


def iso_map(spark: SparkSession, folder: str) -> DataFrame:
    """Customers by the alpha-2 code of their nation; codes not kept go to the rest.

    Countries outside the common classification are kept, too.
    """
    customers = t.table(spark, folder, "customer").select(
        recode.iso2(t.pick(t.NATION_ISO3, F.col("c_nationkey"))).alias("country")
    )
    return fold_countries(customers, [*c.COUNTRIES, "SA", "KE"], ["country"]).groupBy("country").agg(
        F.count(F.lit(1)).alias("n")
    )


def regex_component_filter(spark: SparkSession, folder: str) -> DataFrame:
    """A pattern, its negation, a list and a prefix as filters of one scan."""
    flows = t.flows(spark, folder).withColumn("code", recode.map_values("priority", t.PRIORITY_COMPONENT))
    demand = F.col("code").rlike(c.FLAT_DEMAND_PATTERN)
    row_code = t.pick(t.VALUE_ADDED_CODES, F.col("line") - 1)
    kind = (
        F.when(demand, F.lit("demand"))
        .when(row_code.isin(*c.FLAT_VALUE_ADDED_ROWS), F.lit("value added"))
        .otherwise(F.lit("other"))
    )
    return (
        flows.where(F.substring("resource_type", 1, 2).isin("ST", "SM", "ME", "PR"))
        .groupBy(kind.alias("kind"), "code")
        .agg(null_sum("v").cast("double").alias("value"))
    )


def gas_factors(spark: SparkSession, folder: str) -> DataFrame:
    """Emissions by gas with the factor each stressor gets."""
    stressor = recode.map_values("event", {k: v[0] for k, v in t.EVENT_STRESSORS.items()})
    events = t.emissions(spark, folder).select(
        stressor.alias("stressor"),
        F.when(F.col("event") == "signup", F.lit(c.CO2_EQUIVALENT_UNIT)).otherwise(F.lit("kg")).alias("unit"),
        "v",
    )
    factors = convert.gas_factors(events.select("stressor", "unit").distinct())
    return (
        events.join(factors, "stressor")
        .groupBy("stressor", "gwp")
        .agg(null_sum(F.col("v") * F.col("gwp")).cast("double").alias("value"))
    )


def vintage_asof(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by the release that covers their year; earlier years have none."""
    releases = spark.createDataFrame(
        pa.table(
            {
                "start_year": pa.array([1996, 1998, 2000], pa.int32()),
                "location": ["first", "second", "third"],
            }
        )
    )
    orders = t.table(spark, folder, "orders").select(
        F.year("o_orderdate").alias("year"), t.money("o_totalprice").alias("v")
    )
    by_year = orders.groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("v").cast("double").alias("value")
    )
    return vintages.with_vintage(by_year, "year", releases)


def asof_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item with the last order of its key until it was shipped: as many releases as orders."""
    orders = t.table(spark, folder, "orders").groupBy(
        (F.col("o_custkey") % 50).alias("key"), F.col("o_orderdate").alias("day")
    ).agg(F.max("o_orderkey").alias("release"))
    items = t.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_suppkey") % 50).alias("key"), F.col("l_shipdate").alias("day")
    )
    return asof_join(items, orders, ["key"], "day", ["release"]).select("l_orderkey", "l_linenumber", "release")


# --- readers and writers -------------------------------------------------------------------------


def matrix_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Flows written as a labelled text matrix and read back, empty cells as zero."""
    sums = t.flows(spark, folder).select(
        "resource_country", "resource_src", "use_country", "use_src", F.col("dv").alias("value")
    )
    path = write_wide_text(
        sums,
        PRODUCER,
        ["use_country", "use_src"],
        new_folder(spark, "matrix"),
        [["region", ""], ["sector", ""], ["region", "sector"]],
    )
    matrix = read_matrix(
        spark, path, ["resource_country", "resource_src"], ["use_country", "use_src"]
    )
    return matrix.cells()


def matrix_two_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The same with two label lines and quantities, and the sums of its lines beside the cells."""
    sums = t.flows(spark, folder).select(
        "resource_country", "resource_src", "use_country", "use_src", F.col("tls").alias("value")
    )
    path = new_folder(spark, "matrix")
    write_wide_text(sums, PRODUCER, ["use_country", "use_src"], path, [["region", ""], ["sector", ""]])
    matrix = read_matrix(spark, path, PRODUCER, ["use_country", "use_src"])
    no = F.lit(None).cast("string")
    lines = matrix.line_totals().select(*PRODUCER, no.alias("use_country"), no.alias("use_src"), "value")
    return matrix.cells().unionByName(lines)


def matrix_blank_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A matrix whose first lines of data hold no number: their cells come back without a value."""
    sums = t.flows(spark, folder).select(*PRODUCER, "use_country", "use_src", F.col("v").alias("value"))
    path = new_folder(spark, "matrix")
    blank = F.col("resource_country") < "G"
    write_wide_text(sums, PRODUCER, ["use_country", "use_src"], path, [["region", ""], ["sector", ""]], blank=blank)
    return read_matrix(spark, path, PRODUCER, ["use_country", "use_src"]).cells()


def matrix_quoted(spark: SparkSession, folder: str) -> DataFrame:
    """A comma table whose labels hold commas and quotes."""
    label = {side: F.concat(F.col(f"{side}_src"), F.lit(', of "'), F.col(f"{side}_country"), F.lit('"')) for side in ("resource", "use")}
    quoted = {f"{side}_src": F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"')) for side, x in label.items()}
    sums = t.flows(spark, folder).select(*PRODUCER, "use_country", "use_src", F.col("dv").alias("value")).withColumns(quoted)
    path = new_folder(spark, "matrix")
    write_wide_text(sums, PRODUCER, ["use_country", "use_src"], path, [["region", ""], ["sector", ""]], sep=",")
    return read_matrix(spark, path, PRODUCER, ["use_country", "use_src"], sep=",", quote='"').cells()


def units_in_files(spark: SparkSession, folder: str) -> DataFrame:
    """A unit table of as many lines as events, in twenty files of unlike size: the first line in the files counts."""
    events = t.table(spark, folder, "events")
    stressor = F.concat(F.when(F.col("event_type") == "view", "CH4 - ").otherwise("CO2 - "), F.col("user_id").cast("string"))
    place = F.col("event_id") % 1000
    part = F.call_function("div", 20 * place * place * place, F.lit(1_000_000_000))
    unit = F.when(F.col("event_id") % 3 == 0, c.CO2_EQUIVALENT_UNIT).otherwise("kg")
    lines = events.select(F.lpad(part.cast("string"), 2, "0").alias("part"), "event_id", stressor.alias("stressor"), unit.alias("unit"))
    path = new_folder(spark, "units")
    (
        lines.repartition("part")
        .sortWithinPartitions("part", "event_id")
        .select("part", "stressor", "unit")
        .write.partitionBy("part")
        .option("header", True)
        .option("sep", "\t")
        .csv(path)
    )
    return convert.gas_factors(tables.read_units(spark, path, ordered=True))


def nan_demand(spark: SparkSession, folder: str) -> DataFrame:
    """Final demand from a matrix whose cells for one component of the rest are not a number."""
    gap = (F.col("use_country") == c.REST_OF_WORLD) & (F.col("priority") == "5-LOW")
    demand = t.flows(spark, folder).groupBy(*PRODUCER, "use_country", "priority").agg(
        F.sum("dv").cast("double").alias("value")
    )
    demand = demand.select(
        *PRODUCER,
        "use_country",
        recode.map_values("priority", DEMAND_LABELS).alias("label"),
        F.when(gap, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
    )
    marks = [["region", ""], ["sector", ""], ["region", "sector"]]
    path = write_wide_text(demand, PRODUCER, ["use_country", "label"], new_folder(spark, "demand"), marks)
    kept = t.countries(spark, folder)
    return weighted.demand_totals(tables.read_demand_matrix(spark, path), kept).withColumn("value", _rounded())


def gas_factors_first(spark: SparkSession, folder: str) -> DataFrame:
    """Emissions by stressor, each listed under two units, of which the first counts."""
    stressor = recode.map_values("event", {k: v[0] for k, v in t.EVENT_STRESSORS.items()})
    events = t.emissions(spark, folder).select("event", stressor.alias("stressor"), "v")
    plain, done = F.lit("kg"), F.lit(c.CO2_EQUIVALENT_UNIT)
    units = F.when(F.col("event") == "view", F.array(done, plain)).otherwise(F.array(plain, done))
    listed = events.select("stressor", units.alias("units")).distinct()
    lines = listed.select("stressor", F.posexplode("units").alias("place", "unit")).orderBy("stressor", "place")
    path = f"{new_folder(spark, 'units')}/unit.txt"
    _write_table(lines.select("stressor", "unit").coalesce(1), path, sep="\t")
    factors = convert.gas_factors(tables.read_units(spark, path))
    return (
        events.join(factors, "stressor")
        .groupBy("stressor", "gwp")
        .agg(null_sum(F.col("v") * F.col("gwp")).cast("double").alias("value"))
    )


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions written as an account file and read back by column patterns."""
    sums = (
        t.flows(spark, folder)
        .withColumnsRenamed({"resource_type": "resource_industry", "use_src": "use_industry"})
        .groupBy(*spread.Z_KEYS)
        .agg(null_sum("dv").cast("double").alias("value"))
    )
    root = new_folder(spark, "account")
    sinks.write_account_csv(sums, root, "Z")
    return tables.read_account_csv(spark, f"{root}/Z.csv", "Z")


def partitioned_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions written by country, one country written again, and read back."""
    sums = stage(
        t.flows(spark, folder)
        .groupBy("resource_country", "resource_type", "use_country")
        .agg(null_sum("dv").cast("double").alias("value")),
        "sums",
    )
    path = new_folder(spark, "by_country")
    sinks.write_by_country(sums, path)
    sinks.write_by_country(
        sums.where(F.col("resource_country") == c.REST_OF_WORLD).withColumn("value", -F.col("value")), path
    )
    return spark.read.schema(sums.schema).parquet(path)


def replaced_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions published by country, and again without one country and with other values."""
    sums = stage(
        t.flows(spark, folder)
        .groupBy("resource_country", "resource_type", "use_country")
        .agg(null_sum("dv").cast("double").alias("value")),
        "sums",
    )
    path = new_folder(spark, "published")
    sinks.publish_by_country(sums, path)
    again = sinks.read_published(spark, path, sums.schema).where(F.col("resource_country") != c.REST_OF_WORLD)
    sinks.publish_by_country(again.withColumn("value", -F.col("value")), path)
    return sinks.read_published(spark, path, sums.schema)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "z_two_sided": z_two_sided,
        "matrix_blank_lines": matrix_blank_lines,
        "matrix_quoted": matrix_quoted,
        "units_in_files": units_in_files,
        "asof_orders": asof_orders,
        "replaced_sink": replaced_sink,
        "repartition_key": repartition_key,
        "key_conservation": key_conservation,
        "z_conservation": z_conservation,
        "global_total": global_total,
        "coverage_gaps": coverage_gaps,
        "va_weighted": va_weighted,
        "d_weighted_dense": d_weighted_dense,
        "emissions_weighted": emissions_weighted,
        "z_recode": z_recode,
        "va_recode": va_recode,
        "d_recode": d_recode,
        "emissions_recode": emissions_recode,
        "weighted_accounts": weighted_accounts,
        "wide_accounts": wide_accounts,
        "wide_release": wide_release,
        "flat_accounts": flat_accounts,
        "flat_release": flat_release,
        "reference_value_added": reference_value_added,
        "compare_z": compare_z,
        "compare_va": compare_va,
        "compare_d": compare_d,
        "compare_emissions": compare_emissions,
        "compare_written": compare_written,
        "currency_convert": currency_convert,
        "rate_scan": rate_scan,
        "crosswalk_build": crosswalk_build,
        "crosswalk_scan": crosswalk_scan,
        "crosswalk_pairs": crosswalk_pairs,
        "country_fold": country_fold,
        "fold_unlisted": fold_unlisted,
        "hybrid_grid": hybrid_index,
        "semi_join_filter": semi_join_filter,
        "anti_join_filter": anti_join_filter,
        "lookup_first_match": lookup_first_match,
        "null_propagating_sum": null_propagating_sum,
        "null_as_zero_sum": null_as_zero_sum,
        "row_total_wide": row_total_wide,
        "unpivot_wide": unpivot_wide,
        "transpose_labels": transpose_labels,
        "append_union": append_union,
        "unite_id": unite_ids,
        "split_id": split_ids,
        "section_recode": section_recode,
        "iso_map": iso_map,
        "regex_component_filter": regex_component_filter,
        "gas_factors": gas_factors,
        "vintage_asof": vintage_asof,
        "matrix_roundtrip": matrix_roundtrip,
        "matrix_two_labels": matrix_two_labels,
        "nan_demand": nan_demand,
        "gas_factors_first": gas_factors_first,
        "csv_roundtrip": csv_roundtrip,
        "partitioned_sink": partitioned_sink,
    }
