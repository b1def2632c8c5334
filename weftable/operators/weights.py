"""Value-added shares that split a source sector over common industries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftable.functions.aggregates import exact_sum
from weftable.operators.crosswalk import grid


def repartition_keys(
    crosswalk: DataFrame,
    reference_va: DataFrame,
    countries: DataFrame | Sequence[str],
    equal_if_zero: bool = False,
) -> DataFrame:
    """One row (country, src, industry, weight) per country and crosswalk pair.

    A sector with one industry has weight 1, known value added or not. Else the
    weight is the share of the industry in the value added of the sector's
    industries. It is null if one of them is missing or if they sum to zero,
    which the coverage check reports; ``equal_if_zero`` splits a known zero total
    equally instead. Negative shares are kept.
    """
    pairs = crosswalk.select("src", "industry").distinct()
    candidates = grid(pairs, "country", countries).join(
        reference_va.select("country", "industry", F.col("value").alias("_va")),
        ["country", "industry"],
        "left",
    )
    sector = Window.partitionBy("country", "src")
    n = F.count(F.lit(1)).over(sector)
    known = F.count("_va").over(sector)
    total = exact_sum("_va", sector)
    share = F.try_divide(F.col("_va"), total)
    if equal_if_zero:
        share = F.when(total == 0, 1 / n).otherwise(share)
    weight = F.when(n == 1, F.lit(1.0)).when(known == n, share)
    return candidates.select("country", "src", "industry", weight.cast("double").alias("weight"))


def usable(key: DataFrame) -> DataFrame:
    """Key rows that move anything: weight known, a number and not zero."""
    w = F.col("weight")
    return key.where(w.isNotNull() & ~F.isnan(w) & (w != 0))
