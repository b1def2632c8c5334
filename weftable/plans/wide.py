"""Aligning a source that comes as one wide table, by direct recoding."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftable import classification as c
from weftable.functions.aggregates import null_sum
from weftable.functions.recode import iso2, section_recode, wide_code, wide_demand_component
from weftable.operators.fold import fold_countries
from weftable.plans.accounts import take_d, take_va, take_z, total_by_cell
from weftable.schemas import Accounts
from weftable.sources.locate import wide_emissions_file, wide_table_file
from weftable.sources.matrix import LabelledMatrix
from weftable.sources.tables import read_wide_emissions, read_wide_table


def _decoded(
    labels: DataFrame, label: str, side: str, kept: DataFrame, iso: Mapping[str, str] | None, compat: bool
) -> DataFrame:
    """Country and industry of labels such as ``AUT_C17_18``, one row per label."""
    code = wide_code(F.substr(F.col(label), F.lit(5)))
    decoded = labels.withColumns(
        {
            f"{side}_country": iso2(F.substring(label, 1, 3), iso),
            f"_{side}_code": code,
            f"{side}_industry": section_recode(code, compat),
        }
    )
    return fold_countries(decoded, kept, [f"{side}_country"])


def classify_wide(
    table: LabelledMatrix,
    kept: DataFrame,
    iso: Mapping[str, str] | None = None,
    compat: bool = False,
) -> DataFrame:
    """Cells of the wide table as classified cells.

    All recoding is done on the labels: once per line, once per column. Demand
    columns are recognised before any recode, since their codes begin with
    letters of sections.
    """

    def rows(df: DataFrame) -> DataFrame:
        named = df.where(F.col("resource_id") != c.WIDE_TOTAL)
        return _decoded(named, "resource_id", "resource", kept, iso, compat).withColumn(
            "_is_va", F.col("resource_id").isin(*c.WIDE_VALUE_ADDED_ROWS)
        )

    def columns(df: DataFrame) -> DataFrame:
        named = df.where(F.col("use_id") != c.WIDE_TOTAL)
        decoded = _decoded(named, "use_id", "use", kept, iso, compat)
        is_demand = F.col("_use_code").isin(*c.WIDE_DEMAND_CODES)
        return decoded.select(
            "_pos",
            "use_country",
            is_demand.alias("_is_demand"),
            F.when(is_demand, wide_demand_component("_use_code"))
            .otherwise(F.col("use_industry"))
            .alias("use_item"),
        )

    cells = table.with_rows(rows).with_columns(columns).cells()
    is_va = F.col("_is_va")
    return cells.where(~(is_va & F.col("_is_demand"))).select(
        F.when(is_va, F.lit("VA"))
        .when(F.col("_is_demand"), F.lit("D"))
        .otherwise(F.lit("Z"))
        .alias("account"),
        F.when(is_va, F.col("use_country")).otherwise(F.col("resource_country")).alias("country"),
        F.when(is_va, F.col("use_item")).otherwise(F.col("resource_industry")).alias("industry"),
        F.when(~is_va, F.col("use_country")).alias("other_country"),
        F.when(is_va, F.col("resource_id")).otherwise(F.col("use_item")).alias("other_item"),
        "value",
    )


def wide_emissions(
    ghg: DataFrame,
    kept: DataFrame,
    year: int,
    iso: Mapping[str, str] | None = None,
    compat: bool = False,
) -> DataFrame:
    """Emissions in tonnes of one year and of direct scope."""
    chosen = ghg.where(
        (F.col("TIME_PERIOD") == year) & (F.col("EMISSIONS_SCOPE") == c.WIDE_EMISSIONS_SCOPE)
    ).select(
        iso2("EMISSIONS_ORIGIN_AREA", iso).alias("country"),
        section_recode("ACTIVITY", compat).alias("industry"),
        "OBS_VALUE",
    )
    total = null_sum("OBS_VALUE") * F.lit(c.WIDE_EMISSIONS_FACTOR)
    return fold_countries(chosen, kept, ["country"]).groupBy("country", "industry").agg(
        total.alias("value")
    )


def align_wide(
    table: LabelledMatrix,
    kept: DataFrame,
    ghg: DataFrame | None = None,
    year: int | None = None,
    iso: Mapping[str, str] | None = None,
    compat: bool = False,
) -> Accounts:
    totals = total_by_cell(classify_wide(table, kept, iso, compat), "wide")
    emissions = None if ghg is None else wide_emissions(ghg, kept, year, iso, compat)
    return Accounts(take_z(totals), take_va(totals), take_d(totals), emissions)


def align_wide_folder(
    spark: SparkSession,
    folder: str,
    kept: DataFrame,
    year: int,
    iso: Mapping[str, str] | None = None,
    compat: bool = False,
) -> Accounts:
    """The same from a release folder; both of its files must be there."""
    ghg = read_wide_emissions(spark, wide_emissions_file(spark, folder))
    table = read_wide_table(spark, wide_table_file(spark, folder))
    return align_wide(table, kept, ghg, year, iso, compat)
