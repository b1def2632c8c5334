"""Aligning a source whose sectors map many-to-many, by value-added weights."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftable import classification as c
from weftable.functions.aggregates import null_sum
from weftable.functions.recode import matrix_demand_component, matrix_value_added_component
from weftable.operators.checks import conservation, coverage_gaps, key_conservation, require
from weftable.operators.convert import gas_factors
from weftable.operators.crosswalk import grid
from weftable.operators.fold import fold_countries
from weftable.operators.spread import spread_dense, spread_matrix, spread_one_sided
from weftable.operators.weights import repartition_keys
from weftable.schemas import Accounts
from weftable.sources.matrix import LabelledMatrix
from weftable.sources.staging import stage
from weftable.sources.tables import (
    read_demand_matrix,
    read_emissions_matrix,
    read_factor_matrix,
    read_flow_matrix,
    read_units,
)


@dataclass(frozen=True)
class MatrixRelease:
    """The matrices of one release."""

    flows: LabelledMatrix
    demand: LabelledMatrix
    factors: LabelledMatrix
    emissions: LabelledMatrix
    units: DataFrame


def read_release(spark: SparkSession, folder: str) -> MatrixRelease:
    at = {name: f"{folder.rstrip('/')}/{file}" for name, file in c.MATRIX_FILES.items()}
    return MatrixRelease(
        flows=read_flow_matrix(spark, at["flows"]),
        demand=read_demand_matrix(spark, at["demand"]),
        factors=read_factor_matrix(spark, at["factors"]),
        emissions=read_emissions_matrix(spark, at["emissions"]),
        units=read_units(spark, at["units"], ordered=True),
    )


def _place(labels: DataFrame, kept: DataFrame, region: str, sector: str, country: str, src: str) -> DataFrame:
    """Folded country and source sector of labels."""
    placed = labels.withColumnsRenamed({region: country, sector: src})
    return fold_countries(placed, kept, [country])


def placed_flows(flows: LabelledMatrix, kept: DataFrame) -> LabelledMatrix:
    """The transactions matrix with folded countries on both of its sides."""
    return flows.with_rows(
        lambda r: _place(r, kept, "resource_region", "resource_sector", "resource_country", "resource_src")
    ).with_columns(lambda k: _place(k, kept, "use_region", "use_sector", "use_country", "use_src"))


def factor_totals(factors: LabelledMatrix, kept: DataFrame) -> DataFrame:
    """Value added by (country, src, component) with the two common components."""
    placed = factors.with_rows(
        lambda r: r.withColumn("component", matrix_value_added_component("component"))
    ).with_columns(lambda k: _place(k, kept, "region", "sector", "country", "src"))
    return placed.cells().groupBy("country", "src", "component").agg(null_sum("value").alias("value"))


def demand_totals(demand: LabelledMatrix, kept: DataFrame, positive_only: bool = True) -> DataFrame:
    """Final demand by (country, src, component, counterpartarea).

    Columns without a common component meet no cell: the join on position drops theirs.
    """
    placed = demand.with_rows(
        lambda r: _place(r, kept, "region", "sector", "country", "src")
    ).with_columns(
        lambda k: fold_countries(
            k.withColumn("component", matrix_demand_component("component"))
            .where(F.col("component").isNotNull())
            .withColumnRenamed("use_region", "counterpartarea"),
            kept,
            ["counterpartarea"],
        )
    )
    cells = placed.cells()
    if positive_only:
        cells = cells.where("value > 0")
    return cells.groupBy("country", "src", "component", "counterpartarea").agg(
        null_sum("value").alias("value")
    )


def emission_totals(
    emissions: LabelledMatrix, units: DataFrame, kept: DataFrame, unknown_as_zero: bool = False
) -> DataFrame:
    """CO2-equivalent emissions by (country, src), in the unit of the matrix.

    A stressor without a unit row has no factor and makes its totals null, or
    counts nothing with ``unknown_as_zero``.
    """
    gwp = F.coalesce("gwp", F.lit(0)) if unknown_as_zero else F.col("gwp")
    placed = emissions.with_rows(
        lambda r: r.join(gas_factors(units), "stressor", "left").withColumn("gwp", gwp)
    ).with_columns(lambda k: _place(k, kept, "region", "sector", "country", "src"))
    return placed.cells().groupBy("country", "src").agg(
        null_sum(F.col("value") * F.col("gwp")).alias("value")
    )


def weighted_va(totals: DataFrame, key: DataFrame) -> DataFrame:
    return spread_one_sided(
        totals, grid(key, "component", c.VALUE_ADDED_COMPONENTS), ["component"]
    ).select("country", "industry", "component", "value")


def demand_index(key: DataFrame, countries: DataFrame, components=c.DEMAND_COMPONENTS) -> DataFrame:
    """Every (country, industry, component, counterpartarea) a dense account lists."""
    cells = key.select("country", "industry").distinct()
    return grid(grid(cells, "component", components), "counterpartarea", countries)


def weighted_demand(totals: DataFrame, key: DataFrame, countries: DataFrame, dense: bool = True) -> DataFrame:
    """Final demand by the producer's weights, listing empty cells as zero if ``dense``."""
    extra = ["component", "counterpartarea"]
    if dense:
        return spread_dense(totals, key, demand_index(key, countries), extra).select(
            "country", "industry", "counterpartarea", "component", "value"
        )
    value = F.col("value") * F.col("weight")
    return totals.join(key, ["country", "src"]).groupBy(
        "country", "industry", "counterpartarea", "component"
    ).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias("value"))


def weighted_emissions(totals: DataFrame, key: DataFrame) -> DataFrame:
    """Emissions in tonnes by the producer's weights."""
    spread = spread_one_sided(totals, key)
    return spread.withColumn("value", F.col("value") / F.lit(c.MATRIX_EMISSIONS_DIVISOR))


@dataclass(frozen=True)
class WeightedAlignment:
    """Aligned accounts, the key used, and the checks that belong to them.

    ``unweighted`` has the transactions that found no weights, by pair of
    countries; it is empty if no label lacks one.
    """

    accounts: Accounts
    unweighted: DataFrame
    key: DataFrame
    key_check: DataFrame
    z_check: DataFrame
    gaps: DataFrame

    def require_sound(self) -> "WeightedAlignment":
        """Raise unless all totals are handed on and every label is covered."""
        require(self.gaps, "labels without counterpart or weight")
        require(self.key_check.where("NOT conserved"), "weights lose value added")
        require(self.z_check.where("NOT conserved"), "alignment loses transactions")
        return self


def align_weighted(
    release: MatrixRelease,
    crosswalk: DataFrame,
    kept: DataFrame,
    reference_va: DataFrame,
    positive_demand_only: bool = True,
    dense_demand: bool = True,
    strict: bool = True,
) -> WeightedAlignment:
    """Align one release. Every matrix is scanned once.

    Weights cover the kept countries and whatever the release folds to besides.
    The key serves all accounts and both sides of the transactions, so it is
    staged. One pass over the transactions gives the aligned cells, those without
    weights, and the sums that each line forms of its own cells: both sides of
    the check, and the labels that occur. A failed check is an error, unless
    ``strict`` is off.
    """
    listed = kept.select("country").distinct()
    present = fold_countries(
        release.factors.columns.select(F.col("region").alias("country")), listed, ["country"]
    )
    countries = stage(listed.unionByName(present).distinct(), "countries")
    key = stage(repartition_keys(crosswalk, reference_va, countries), "key")
    va_totals = stage(factor_totals(release.factors, countries), "factors")

    flows = placed_flows(release.flows, countries)
    spread = spread_matrix(flows, key)

    labels = spread.lines.select(
        F.col("resource_country").alias("country"), F.col("resource_src").alias("src")
    ).unionByName(
        flows.columns.select(F.col("use_country").alias("country"), F.col("use_src").alias("src"))
    )
    sector_va = va_totals.groupBy("country", "src").agg(null_sum("value").alias("value"))

    aligned = WeightedAlignment(
        accounts=Accounts(
            z=spread.z,
            va=weighted_va(va_totals, key),
            d=weighted_demand(
                demand_totals(release.demand, countries, positive_demand_only),
                key,
                countries,
                dense_demand,
            ),
            emissions=weighted_emissions(
                emission_totals(release.emissions, release.units, countries), key
            ),
        ),
        unweighted=spread.unweighted,
        key=key,
        key_check=key_conservation(sector_va, key),
        z_check=conservation(spread.lines, spread.z, ["resource_country"]),
        gaps=coverage_gaps(labels, key),
    )
    return aligned.require_sound() if strict else aligned
