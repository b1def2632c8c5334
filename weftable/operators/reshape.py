"""Between wide and long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftable.functions.aggregates import row_total


def to_long(df: DataFrame, ids: Sequence[str], name: str = "name", value: str = "value") -> DataFrame:
    """One row per id and remaining column."""
    return df.unpivot(list(ids), [x for x in df.columns if x not in ids], name, value)


def with_row_total(df: DataFrame, ids: Sequence[str], name: str) -> DataFrame:
    """Total of all columns but the ids; null as soon as one of them is null."""
    return df.withColumn(name, row_total(*[x for x in df.columns if x not in ids]))


def transpose(long: DataFrame, row: str, column: str) -> DataFrame:
    """Swap the row and column labels of a long matrix; no data moves."""
    return long.withColumns({row: F.col(column), column: F.col(row)})


def append(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, by column name; repeats stay."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
