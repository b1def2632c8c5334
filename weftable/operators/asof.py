"""As-of join of two large tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftable.sources.staging import stage


def asof_join(facts: DataFrame, releases: DataFrame, by: Sequence[str], on: str, values: Sequence[str]) -> DataFrame:
    """Each fact with the ``values`` of the last release of its key that is not after it; nulls if there is none.

    Both tables have the columns ``by`` (which may be none) and ``on``. They are
    sorted together by ranges of (by, on), so a key with a third of all rows is
    cut like any other. The last release seen is carried forward within a range,
    and from one range to the next where the key goes on; the borders, one row
    per range, are all that meets in one task. Of releases at the same time the
    one with the largest values counts. A fact whose key or time is null has no
    release; null keys equal none.
    """
    by, values = list(by), list(values)
    release = F.struct(*[F.col(v).alias(v) for v in values])
    empty = F.lit(None).cast(releases.select(release.alias("r")).schema["r"].dataType)
    known = releases.where(" and ".join(f"`{x}` is not null" for x in [*by, on]))
    fact = F.struct(*[F.col(f"`{x}`").alias(x) for x in facts.columns])
    no_fact = F.lit(None).cast(facts.select(fact.alias("f")).schema["f"].dataType)
    both = known.select(*by, on, F.lit(0).alias("_side"), release.alias("_release"), no_fact.alias("_fact")).unionByName(
        facts.select(*by, on, F.lit(1).alias("_side"), empty.alias("_release"), fact.alias("_fact"))
    )
    order = [*by, on, "_side"]
    ranged = stage(both.repartitionByRange(*order, "_release").withColumn("_range", F.spark_partition_id()), "ranges")

    key = F.struct(F.lit(0).alias("_"), *[F.col(x) for x in by])
    newest = ranged.where("_side = 0").groupBy("_range").agg(
        F.max_by(F.struct(key.alias("key"), F.col("_release").alias("release")), F.struct(*order, "_release")).alias("_last")
    )
    ranges = ranged.select("_range").distinct().join(newest, "_range", "left")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    borders = ranges.select("_range", F.last("_last", ignorenulls=True).over(earlier).alias("_before"))

    so_far = Window.partitionBy("_range", *by).orderBy(on, "_side", "_release").rowsBetween(Window.unboundedPreceding, 0)
    carried = ranged.withColumn("_seen", F.last("_release", ignorenulls=True).over(so_far)).where("_side = 1")
    met = carried.join(borders, "_range").withColumn(
        "_seen", F.coalesce("_seen", F.when(F.col("_before.key") == key, F.col("_before.release")))
    )
    present = F.lit(True)
    for x in [*by, on]:
        present &= F.col(f"_fact.{x}").isNotNull()
    return met.select(
        *[F.col("_fact").getField(x).alias(x) for x in facts.columns],
        *[F.when(present, F.col("_seen").getField(v)).alias(v) for v in values],
    )
