"""Dense numbers for the distinct rows of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftable.sources.staging import stage


def dense_numbers(df: DataFrame, columns: Sequence[str], name: str = "number") -> DataFrame:
    """The distinct ``columns``, numbered from 0 in their order.

    Ranges of the order are numbered by themselves and add the rows of the
    ranges before; only the counts of the ranges, one row each, meet in one task.
    The ranges are staged, as their number must not change under a rerun.
    """
    columns = list(columns)
    ranged = stage(
        df.select(*columns).distinct().repartitionByRange(*columns).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*columns)) - 1
    return ranged.join(before, "_range").select(*columns, (F.col("_before") + place).cast("int").alias(name))
