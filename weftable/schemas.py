"""Explicit schemas. Nothing in this package infers a schema from data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

FLOWS = (
    "resource_country string, resource_industry string, "
    "use_country string, use_industry string, value double"
)
DEMAND = (
    "country string, industry string, counterpartarea string, "
    "component string, value double"
)
VALUE_ADDED = "country string, industry string, component string, value double"
EMISSIONS = "country string, industry string, value double"

KEY = "country string, src string, industry string, weight double"
CROSSWALK = "src string, raw_industry string, industry string, code string"

FLAT_FILE = (
    "refArea string, rowIi string, counterpartArea string, colIi string, "
    "obsValue double"
)
FLAT_EMISSIONS = "industry string, ref_area string, obs_value double"
WIDE_EMISSIONS = (
    "TIME_PERIOD int, EMISSIONS_SCOPE string, EMISSIONS_ORIGIN_AREA string, "
    "ACTIVITY string, OBS_VALUE double"
)
UNITS = "stressor string, unit string"
RATES = "TIME_PERIOD int, LOCATION string, OBS_VALUE double"

# Key columns of each account, in output order.
ACCOUNT_KEYS = {
    "Z": ("resource_country", "resource_industry", "use_country", "use_industry"),
    "VA": ("country", "industry", "component"),
    "D": ("country", "industry", "counterpartarea", "component"),
    "emissions": ("country", "industry"),
}

# Key columns of each account once composite ids are in place.
COMPARISON_KEYS = {
    "Z": ("use_id", "resource_id"),
    "VA": ("id", "component"),
    "D": ("id", "counterpartarea", "component"),
    "emissions": ("id",),
}


@dataclass(frozen=True)
class Accounts:
    """The four aligned accounts of one source."""

    z: DataFrame
    va: DataFrame
    d: DataFrame
    emissions: DataFrame | None = None

    def by_name(self) -> dict[str, DataFrame]:
        named = {"Z": self.z, "VA": self.va, "D": self.d, "emissions": self.emissions}
        return {name: df for name, df in named.items() if df is not None}
