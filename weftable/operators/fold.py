"""Folding countries into the kept set."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftable import classification as c


def kept_countries(
    df: DataFrame, column: str = c.CROSSWALK_COUNTRY, rest: Sequence[str] = c.REST_REGIONS
) -> DataFrame:
    """Distinct countries of ``column`` with the aggregate regions folded into one."""
    folded = F.when(F.col(column).isin(*rest), F.lit(c.REST_OF_WORLD)).otherwise(F.col(column))
    return df.select(folded.alias("country")).distinct()


def fold_countries(
    df: DataFrame, kept: DataFrame | Iterable[str], columns: Sequence[str]
) -> DataFrame:
    """Replace every code of ``columns`` that is not kept, null included, by the rest code.

    A listed kept set is tested in place. A kept table is joined, by broadcast
    as long as Catalyst sees that it is small.
    """
    if not isinstance(kept, DataFrame):
        codes = list(kept)
        return df.withColumns(
            {
                name: F.when(F.col(name).isin(*codes), F.col(name)).otherwise(F.lit(c.REST_OF_WORLD))
                for name in columns
            }
        )
    for name in columns:
        known = kept.select(F.col("country").alias("_kept")).distinct()
        df = (
            df.join(known, F.col(name) == F.col("_kept"), "left")
            .withColumn(name, F.coalesce("_kept", F.lit(c.REST_OF_WORLD)))
            .drop("_kept")
        )
    return df
