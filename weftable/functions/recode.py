"""Recodes from source labels to the common classification, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cache

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from weftable import classification as c


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def map_values(value: Column | str, mapping: Mapping[str, str], default: Column | None = None) -> Column:
    """Exact-match recode; unmatched and null values take ``default`` (null if absent)."""
    value = _column(value)
    entries = [F.lit(text) for entry in mapping.items() for text in entry]
    found = F.try_element_at(F.create_map(*entries), value)
    return found if default is None else F.coalesce(found, default)


def wide_code(code: Column | str) -> Column:
    """Spelling of a wide-table code with ``T`` as range sign."""
    return F.replace(_column(code), F.lit("_"), F.lit("T"))


def section_recode(code: Column | str, compat: bool = False) -> Column:
    """Wide-table industry code to common industry.

    By default a code is recognised in either spelling (``J62_63`` or
    ``J62T63``). With ``compat`` only the spelling listed in the fixed values
    is, so that a code whose spelling was changed beforehand stays as it is.
    """
    code = _column(code)
    spelled = code if compat else wide_code(code)
    codes = {
        (raw if compat else raw.replace("_", "T")): target
        for raw, target in c.WIDE_INDUSTRY_CODES.items()
    }
    letter = F.substring(code, 1, 1)
    return F.when(letter.isin(*c.COLLAPSED_SECTIONS), F.concat(letter, F.lit("Z"))).otherwise(
        map_values(spelled, codes, default=spelled)
    )


@cache
def iso3_to_iso2() -> Mapping[str, str]:
    """ISO 3166 alpha-3 to alpha-2 of every country, as the Java runtime has them."""
    locale = SparkContext.getOrCreate()._jvm.java.util.Locale
    return {locale("", code).getISO3Country(): code for code in locale.getISOCountries()}


def iso2(code: Column | str, table: Mapping[str, str] | None = None) -> Column:
    """ISO alpha-3 to alpha-2; an unknown code is null."""
    return map_values(code, iso3_to_iso2() if table is None else table)


def wide_demand_component(code: Column | str) -> Column:
    """Wide-table demand code to component; codes not listed fall to the last one."""
    return map_values(code, c.WIDE_DEMAND_COMPONENTS, default=F.lit(c.WIDE_DEMAND_OTHER))


def matrix_demand_component(label: Column | str) -> Column:
    """Matrix demand label to component; a label not listed has none (null)."""
    return map_values(label, c.MATRIX_DEMAND_COMPONENTS)


def _tax_or_value_added(value: Column | str, tax: str) -> Column:
    return F.when(_column(value) == tax, F.lit("TLS")).otherwise(F.lit("VA"))


def matrix_value_added_component(label: Column | str) -> Column:
    return _tax_or_value_added(label, c.MATRIX_TAX_LABEL)


def flat_value_added_component(code: Column | str) -> Column:
    return _tax_or_value_added(code, c.FLAT_TAX_ROW)


def warming_potential(stressor: Column | str, unit: Column | str) -> Column:
    """CO2-equivalent factor of a stressor; the first rule that holds wins."""
    stressor = _column(stressor)
    factor = F.when(_column(unit) == c.CO2_EQUIVALENT_UNIT, F.lit(1))
    for gas, potential in c.GWP_BY_GAS:
        factor = factor.when(stressor.contains(gas), F.lit(potential))
    return factor.otherwise(F.lit(0))
