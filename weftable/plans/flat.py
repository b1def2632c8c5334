"""Aligning a source that comes as a long flat file, by direct recoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftable import classification as c
from weftable.functions.aggregates import null_sum
from weftable.functions.recode import flat_value_added_component
from weftable.operators.crosswalk import code_industries
from weftable.operators.fold import fold_countries
from weftable.plans.accounts import take_d, take_va, take_z, total_by_cell
from weftable.schemas import Accounts
from weftable.sources.locate import flat_emissions_file, flat_file
from weftable.sources.tables import read_flat_emissions, read_flat_file


def _codes(crosswalk: DataFrame) -> DataFrame:
    return crosswalk if crosswalk.columns == ["code", "industry"] else code_industries(crosswalk)


def classify_flat(flat: DataFrame, crosswalk: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of the flat file as classified cells; a row may serve several accounts.

    ``crosswalk`` is a crosswalk or the lookup of codes already made from one.
    """
    codes = _codes(crosswalk)
    rows = codes.select(F.col("code").alias("rowIi"), F.col("industry").alias("_row_industry"))
    cols = codes.select(F.col("code").alias("colIi"), F.col("industry").alias("_col_industry"))
    coded = flat.join(rows, "rowIi", "left").join(cols, "colIi", "left")
    folded = fold_countries(coded, kept, ["refArea", "counterpartArea"])

    def cell(account: str, applies, country, industry, other_country, other_item):
        fields = F.struct(
            F.lit(account).alias("account"),
            country.alias("country"),
            industry.alias("industry"),
            other_country.alias("other_country"),
            other_item.alias("other_item"),
        )
        return F.when(applies, fields)

    is_row, is_col = F.col("_row_industry").isNotNull(), F.col("_col_industry").isNotNull()
    producer, user = F.col("refArea"), F.col("counterpartArea")
    cells = F.array(
        cell("Z", is_row & is_col, producer, F.col("_row_industry"), user, F.col("_col_industry")),
        cell(
            "VA",
            is_col & F.col("rowIi").isin(*c.FLAT_VALUE_ADDED_ROWS),
            user,
            F.col("_col_industry"),
            F.lit(None).cast("string"),
            flat_value_added_component("rowIi"),
        ),
        cell(
            "D",
            is_row & F.col("colIi").rlike(c.FLAT_DEMAND_PATTERN),
            producer,
            F.col("_row_industry"),
            user,
            F.col("colIi"),
        ),
    )
    return folded.select(F.inline(cells), F.col("obsValue").alias("value")).where(
        "account IS NOT NULL"
    )


def reference_value_added(flat: DataFrame, crosswalk: DataFrame, kept: DataFrame) -> DataFrame:
    """Value added (country, industry, value) of the flat file, the base of the weights."""
    codes = _codes(crosswalk).withColumnRenamed("code", "colIi")
    rows = flat.where(
        F.col("rowIi").isin(*c.FLAT_VALUE_ADDED_ROWS) & ~F.col("colIi").rlike(c.FLAT_DEMAND_PATTERN)
    )
    folded = fold_countries(rows.join(codes, "colIi"), kept, ["counterpartArea"])
    return folded.groupBy(F.col("counterpartArea").alias("country"), "industry").agg(
        null_sum("obsValue").alias("value")
    )


def flat_emissions(ghg: DataFrame, crosswalk: DataFrame, kept: DataFrame) -> DataFrame:
    """Emissions in tonnes of the listed industries."""
    codes = _codes(crosswalk).select(
        F.col("code").alias("industry"), F.col("industry").alias("_industry")
    )
    folded = fold_countries(ghg.join(codes, "industry"), kept, ["ref_area"])
    total = null_sum("obs_value") * F.lit(c.FLAT_EMISSIONS_FACTOR)
    return folded.groupBy(F.col("ref_area").alias("country"), F.col("_industry").alias("industry")).agg(
        total.alias("value")
    )


def align_flat(
    flat: DataFrame, crosswalk: DataFrame, kept: DataFrame, ghg: DataFrame | None = None
) -> Accounts:
    codes = _codes(crosswalk)
    totals = total_by_cell(classify_flat(flat, codes, kept), "flat")
    emissions = None if ghg is None else flat_emissions(ghg, codes, kept)
    return Accounts(take_z(totals), take_va(totals), take_d(totals), emissions)


def align_flat_folder(
    spark: SparkSession, folder: str, crosswalk: DataFrame, kept: DataFrame
) -> Accounts:
    """The same from a release folder; both of its files must be there."""
    ghg = read_flat_emissions(spark, flat_emissions_file(spark, folder))
    return align_flat(read_flat_file(spark, flat_file(spark, folder)), crosswalk, kept, ghg)
