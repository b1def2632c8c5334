"""Currency and gas conversions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftable import classification as c
from weftable.functions.recode import warming_potential
from weftable.operators.lookup import first_match
from weftable.sources.tables import LINE


def rate_of(rates: DataFrame, year: int, location: str = c.RATE_LOCATION) -> Column:
    """The one exchange rate of a year, as a scalar; none or several is an error."""
    chosen = rates.where((F.col("TIME_PERIOD") == year) & (F.col("LOCATION") == location))
    n = F.count(F.lit(1))
    rate = F.when(n == 1, F.first("OBS_VALUE")).otherwise(
        F.raise_error(F.lit(f"expected one exchange rate for {location} in {year}")).cast("double")
    )
    return chosen.agg(rate).scalar()


def convert_currency(df: DataFrame, rate: Column | float, columns: str = "value") -> DataFrame:
    """Multiply every column whose name matches the pattern ``columns`` by the rate."""
    rate = rate if isinstance(rate, Column) else F.lit(rate)
    matched = [name for name in df.columns if re.search(columns, name, re.IGNORECASE)]
    return df.withColumns({name: F.col(name) * rate for name in matched})


def gas_factors(units: DataFrame) -> DataFrame:
    """(stressor, gwp): the CO2-equivalent factor of every stressor of a unit table.

    Of a stressor listed under several units the first line counts: the first in
    the files if the table was read in their order, else in the plan's.
    """
    line = F.col(LINE) if LINE in units.columns else F.monotonically_increasing_id()
    listed = units.select("stressor", warming_potential("stressor", "unit").alias("gwp"), line.alias(LINE))
    return first_match(listed, ["stressor"], LINE).select("stressor", "gwp")
