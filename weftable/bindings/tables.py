"""The star schema as flows, countries, crosswalk and emissions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftable.classification import REST_OF_WORLD
from weftable.functions.aggregates import null_sum
from weftable.operators.weights import repartition_keys
from weftable.sources.staging import stage

KEPT_REGIONS = ("EUROPE", "ASIA", "AMERICA")
SECTORS = 25
MONEY = "decimal(18,2)"

# ISO alpha-3 code played by each nation key, some of them not kept or unknown.
NATION_ISO3 = (
    "ZAF", "USA", "CHN", "AUT", "SAU", "NGA", "CAN", "IND", "DEU", "ISR",
    "EGY", "MEX", "IDN", "FRA", "TUR", "MAR", "BRA", "JPN", "GRC", "ARE",
    "KEN", "ARG", "KOR", "GBR", "QAT",
)

# Wide-table industry code played by each of the 25 sectors.
WIDE_CODES = (
    "A01_02", "A03", "B05_06", "B07_08", "C10T12", "C13T15", "C17_18", "C19",
    "C20", "C31T33", "D", "E", "F", "G", "H49", "H50", "I", "J58T60", "J61",
    "J62_63", "K", "L", "M", "N", "T",
)

# Flat-file code played by each of the 25 sectors; the last one is unmapped.
FLAT_CODES = (
    "A01", "A02", "A03", "B", "C10T12", "C17", "C18", "C31_32", "C33", "D35",
    "E36", "E37T39", "F", "G45", "G46", "H49", "I", "J58", "J62_63", "K64",
    "L", "M71", "O84", "T", "X99",
)

# Flat-file row code played by each line number when a line stands for value
# added; the last one is none.
VALUE_ADDED_CODES = ("D21X31", "OP_RES", "OP_NRES", "D1", "D29X39", "B2A3G", "ZZ")

# Wide-table demand code played by each order priority.
PRIORITY_DEMAND = {
    "1-URGENT": "HFCE",
    "2-HIGH": "GGFC",
    "3-MEDIUM": "GFCF",
    "4-NOT SPECIFIED": "DPABR",
    "5-LOW": "INVNT",
}

# Flat-file demand code played by each order priority.
PRIORITY_COMPONENT = {
    "1-URGENT": "P3_S14",
    "2-HIGH": "P3_S13",
    "3-MEDIUM": "P51G",
    "4-NOT SPECIFIED": "X_NONE",
    "5-LOW": "P5M",
}

# Stressor and unit played by each event type.
EVENT_STRESSORS = {
    "click": ("CO2 - combustion - air", "kg"),
    "view": ("CH4 - agriculture - air", "kg"),
    "purchase": ("N2O - combustion - air", "kg"),
    "error": ("SF6 - air", "kg"),
    "signup": ("NOx - combustion - air", "kg"),
}


# The columns in use. A stated schema saves a job per table that reads footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_brand string, p_type string, p_size int",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def pick(values: tuple[str, ...], index: Column) -> Column:
    """The value at a zero-based index that is known to be in range."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def money(value: Column | str) -> Column:
    """Exact amount, so that sums do not depend on their order."""
    return (F.col(value) if isinstance(value, str) else value).cast(MONEY)


def kept_nations(spark: SparkSession, folder: str) -> DataFrame:
    region = table(spark, folder, "region").where(F.col("r_name").isin(*KEPT_REGIONS))
    nation = table(spark, folder, "nation")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi").select(
        F.col("n_name").alias("country")
    )


def nations(spark: SparkSession, folder: str) -> DataFrame:
    """(nationkey, country) with the folded country."""
    region = table(spark, folder, "region")
    nation = table(spark, folder, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    country = F.when(F.col("r_name").isin(*KEPT_REGIONS), F.col("n_name")).otherwise(
        F.lit(REST_OF_WORLD)
    )
    return nation.select(F.col("n_nationkey").alias("nationkey"), country.alias("country"))


def country_of(nations_: DataFrame, nationkey: Column) -> Column:
    """Folded country of a nation key, null for an unknown one.

    The nation table is one small map that a row looks up by itself. A join
    would do the same, but Catalyst estimates a joined dimension far too large
    and would then no longer broadcast it to the facts.
    """
    pairs = F.collect_list(F.struct("nationkey", "country"))
    return F.try_element_at(nations_.agg(F.map_from_entries(pairs)).scalar(), nationkey)


def countries(spark: SparkSession, folder: str) -> DataFrame:
    return nations(spark, folder).select("country").distinct()


def crosswalk(spark: SparkSession, folder: str) -> DataFrame:
    """Brands to part types: type number brand mod 6, every fifth brand also the next one."""
    part = table(spark, folder, "part")
    types = part.agg(F.sort_array(F.collect_set("p_type"))).scalar()
    b = F.substring("src", 7, 10).cast("int")
    targets = F.when(b % 5 == 0, F.array(b % 6, (b + 1) % 6)).otherwise(F.array(b % 6))
    return (
        part.select(F.col("p_brand").alias("src"))
        .distinct()
        .select("src", F.explode(targets).alias("i"))
        .select("src", F.get(types, F.col("i")).alias("industry"))
        .where("industry IS NOT NULL")
    )


def use_sector(custkey: Column) -> Column:
    return F.concat(F.lit("Brand#"), (custkey % SECTORS + 1).cast("string"))


def producer_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line with its producer and amounts, for what needs no user.

    No join carries a hint: dimension files below the broadcast threshold are
    broadcast, larger ones are shuffled and split by AQE where a key is hot.
    """
    producers = table(spark, folder, "supplier").select(
        "s_suppkey",
        F.col("s_nationkey").alias("resource_nation"),
        country_of(nations(spark, folder), F.col("s_nationkey")).alias("resource_country"),
    )
    products = table(spark, folder, "part").select(
        "p_partkey", F.col("p_brand").alias("resource_src"), F.col("p_type").alias("resource_type")
    )
    signed = F.when(F.col("l_linenumber") == 7, -F.col("l_extendedprice")).otherwise(
        F.col("l_extendedprice")
    )
    return (
        table(spark, folder, "lineitem")
        .join(producers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(products, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "l_orderkey",
            "resource_nation",
            "resource_country",
            "resource_src",
            "resource_type",
            (F.substring("resource_src", 7, 10).cast("int") - 1).alias("resource_sector"),
            F.col("l_linenumber").alias("line"),
            F.col("l_returnflag").alias("flag"),
            money("l_extendedprice").alias("v"),
            money(signed).alias("dv"),
            money("l_quantity").alias("tls"),
        )
    )


def flows(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line with producer, user and amounts."""
    users = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "o_orderkey",
            F.col("c_nationkey").alias("use_nation"),
            country_of(nations(spark, folder), F.col("c_nationkey")).alias("use_country"),
            use_sector(F.col("o_custkey")).alias("use_src"),
            (F.col("o_custkey") % SECTORS).alias("use_sector"),
            F.col("o_orderpriority").alias("priority"),
        )
    )
    lines = producer_lines(spark, folder)
    return lines.join(users, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey", "o_orderkey")


def producer_sums(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts by producer, staged: the base of the weights, without orders or customers."""
    keys = ["resource_country", "resource_src", "resource_type"]
    sums = producer_lines(spark, folder).groupBy(*keys).agg(
        null_sum("v").alias("value"), null_sum("tls").alias("tls")
    )
    return stage(sums, "producers")


def cells(spark: SparkSession, folder: str) -> DataFrame:
    """Flows summed by everything the weighted transactions and their weights need.

    Staged: the large tables are joined once, and all later steps start from a
    table bounded by the classification.
    """
    keys = ["resource_country", "resource_src", "resource_type", "use_country", "use_src"]
    return stage(flows(spark, folder).groupBy(*keys).agg(null_sum("v").alias("value")), "cells")


def reference_va(sums: DataFrame) -> DataFrame:
    """Value added by producer country and part type, from any table of flows with ``value``."""
    return sums.groupBy(
        F.col("resource_country").alias("country"), F.col("resource_type").alias("industry")
    ).agg(null_sum("value").cast("double").alias("value"))


def key(spark: SparkSession, folder: str, sums: DataFrame | None = None) -> DataFrame:
    """Weights of the binding; staged because every use of them is a join."""
    sums = producer_sums(spark, folder) if sums is None else sums
    weights = repartition_keys(
        crosswalk(spark, folder), reference_va(sums), countries(spark, folder)
    )
    return stage(weights, "key")


def emissions(spark: SparkSession, folder: str) -> DataFrame:
    """One row per event with the emitting country, sector and stressor."""
    users = table(spark, folder, "customer").select(
        "c_custkey",
        F.col("c_nationkey").alias("nation"),
        country_of(nations(spark, folder), F.col("c_nationkey")).alias("country"),
    )
    return (
        table(spark, folder, "events")
        .join(users, F.col("user_id") == F.col("c_custkey"))
        .select(
            "nation",
            "country",
            use_sector(F.col("user_id")).alias("src"),
            (F.col("user_id") % SECTORS).alias("sector"),
            F.col("event_type").alias("event"),
            F.year("ts").alias("year"),
            money("value").alias("v"),
        )
    )
