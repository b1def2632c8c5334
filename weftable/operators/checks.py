"""Integrity checks. Each is a DataFrame; ``require`` turns a failed one into an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftable.classification import UNWEIGHTED
from weftable.functions.aggregates import null_sum, zero_sum


class CheckFailed(ValueError):
    """A check found rows that break it."""


def conservation(
    raw: DataFrame,
    aligned: DataFrame,
    keys: Sequence[str],
    value: str = "value",
    tolerance: float = 1e-9,
) -> DataFrame:
    """Totals of both sides per key: (keys, raw_total, aligned_total, conserved).

    A total that is missing on a side, or is poisoned by a missing value, is
    not conserved. The tolerance is relative to the sum of the raw values' sizes
    (of column ``scale``, if the raw rows are sums themselves), so that a total
    that nets to zero can be conserved.
    """
    size = F.col("scale") if "scale" in raw.columns else F.abs(value)
    before = raw.groupBy(*keys).agg(
        null_sum(value).cast("double").alias("raw_total"), F.sum(size).cast("double").alias("_scale")
    )
    after = aligned.groupBy(*keys).agg(null_sum(value).cast("double").alias("aligned_total"))
    difference = F.abs(F.col("raw_total") - F.col("aligned_total"))
    conserved = F.coalesce(difference <= F.lit(tolerance) * F.col("_scale"), F.lit(False))
    return before.join(after, list(keys), "full").withColumn("conserved", conserved).drop("_scale")


def conserved(whole: DataFrame, keys: Sequence[str], tolerance: float = 1e-9) -> DataFrame:
    """The same check on the result of ``spread_whole``, which carries both of its sides."""
    aligned = F.col("resource_industry") != UNWEIGHTED
    totals = whole.groupBy(*keys).agg(
        null_sum("raw").cast("double").alias("raw_total"),
        F.sum("scale").cast("double").alias("_scale"),
        F.when(
            F.count(F.when(aligned, 1)) == F.count(F.when(aligned, F.col("value"))), F.sum(F.when(aligned, F.col("value")))
        )
        .cast("double")
        .alias("aligned_total"),
    )
    difference = F.abs(F.col("raw_total") - F.col("aligned_total"))
    kept = F.coalesce(difference <= F.lit(tolerance) * F.col("_scale"), F.lit(False))
    return totals.withColumn("conserved", kept).drop("_scale")


def key_conservation(totals: DataFrame, key: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Per country: do the weights hand on all of the totals (country, src, value)?

    Missing weights and totals count as zero on the distributed side.
    """
    before = totals.groupBy("country").agg(
        null_sum("value").cast("double").alias("raw_total"), F.sum(F.abs("value")).cast("double").alias("_scale")
    )
    after = (
        totals.join(key, ["country", "src"])
        .groupBy("country")
        .agg(zero_sum(F.col("value") * F.col("weight")).cast("double").alias("aligned_total"))
    )
    difference = F.abs(F.col("raw_total") - F.col("aligned_total"))
    conserved = F.coalesce(difference <= F.lit(tolerance) * F.col("_scale"), F.lit(False))
    return before.join(after, "country", "left").withColumn("conserved", conserved).drop("_scale")


def coverage_gaps(labels: DataFrame, key: DataFrame, on: Sequence[str] = ("country", "src")) -> DataFrame:
    """Labels without a usable counterpart on the other side: (on..., gap).

    ``unmapped``: the data has the label, the key does not. ``unused``: the
    reverse. ``no_weight``: the key has the label but a weight is missing.
    """
    on = list(on)
    seen = labels.select(*on).distinct()
    known = key.select(*on).distinct()
    weightless = key.where(F.col("weight").isNull() | F.isnan("weight")).select(*on).distinct()
    return (
        seen.join(known, on, "left_anti")
        .withColumn("gap", F.lit("unmapped"))
        .unionByName(known.join(seen, on, "left_anti").withColumn("gap", F.lit("unused")))
        .unionByName(weightless.withColumn("gap", F.lit("no_weight")))
    )


def repeated_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that occur more than once in a table that must have each once."""
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require(failures: DataFrame, message: str) -> None:
    """Raise if there is any row in ``failures``; names a few of them."""
    found = failures.limit(5).collect()
    if found:
        raise CheckFailed(f"{message}: " + "; ".join(str(row.asDict()) for row in found))
