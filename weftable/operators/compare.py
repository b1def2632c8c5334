"""Putting several sources side by side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compare_sources(sources: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row per key that any source has, one value column per source.

    Each source has the keys and a ``value``, with one row per key. The full
    outer join of all sources is written as a union and one aggregation: one
    shuffle for any number of sources, and null keys meet each other. A cell
    that a source lacks is zero; a single source is left as it is.
    """
    stacked = None
    for name, df in sources.items():
        part = df.select(*keys, F.lit(name).alias("_source"), "value")
        stacked = part if stacked is None else stacked.unionByName(part)
    if stacked is None:
        raise ValueError("no source to compare")

    def of(name: str):
        value = F.sum(F.when(F.col("_source") == name, F.col("value")))
        if len(sources) > 1:
            value = F.coalesce(value, F.lit(0))
        return value.alias(name)

    return stacked.groupBy(*keys).agg(*[of(name) for name in sources])
