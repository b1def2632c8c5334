"""The common last step of the recoded sources: one aggregation, then one account each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftable.functions.aggregates import null_sum
from weftable.sources.staging import stage

# Generic columns of a classified cell. An account without the last two leaves
# them null.
CELL = ("country", "industry", "other_country", "other_item")


def total_by_cell(classified: DataFrame, name: str) -> DataFrame:
    """Sum classified cells (account, CELL..., value) and stage them by account.

    The source is scanned and shuffled once for all its accounts. Null labels
    are kept out of the partition folder only by the account name, which is
    never null.
    """
    totals = classified.groupBy("account", *CELL).agg(null_sum("value").alias("value"))
    return stage(totals, name, partition_by=["account"])


def take_z(totals: DataFrame) -> DataFrame:
    return totals.where("account = 'Z'").select(
        F.col("country").alias("resource_country"),
        F.col("industry").alias("resource_industry"),
        F.col("other_country").alias("use_country"),
        F.col("other_item").alias("use_industry"),
        "value",
    )


def take_va(totals: DataFrame) -> DataFrame:
    return totals.where("account = 'VA'").select(
        "country", "industry", F.col("other_item").alias("component"), "value"
    )


def take_d(totals: DataFrame) -> DataFrame:
    return totals.where("account = 'D'").select(
        "country",
        "industry",
        F.col("other_country").alias("counterpartarea"),
        F.col("other_item").alias("component"),
        "value",
    )
