"""Lookups and membership tests against small tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_match(dimension: DataFrame, on: Sequence[str], order: str) -> DataFrame:
    """One row per key: the first in ``order``. Ready for a left join without fan-out."""
    rest = [name for name in dimension.columns if name not in on]
    first = F.min_by(F.struct(*rest), F.col(order)).alias("_first")
    return dimension.groupBy(*on).agg(first).select(*on, *[F.col(f"_first.{x}").alias(x) for x in rest])


def lookup(facts: DataFrame, dimension: DataFrame, on: Sequence[str], order: str) -> DataFrame:
    """Left lookup that keeps the number of facts, whatever repeats in the dimension."""
    return facts.join(first_match(dimension, on, order), list(on), "left")


def keep_listed(facts: DataFrame, listed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Facts whose key is in the list; repeats in the list do not matter."""
    return facts.join(listed.select(*on), list(on), "left_semi")


def drop_listed(facts: DataFrame, listed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Facts whose key is not in the list; a null key is not in any list."""
    return facts.join(listed.select(*on), list(on), "left_anti")
