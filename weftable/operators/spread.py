"""Applying weights to accounts: on one side, or on both sides of a matrix."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftable import classification as c
from weftable.functions.aggregates import exact_null_sum, null_sum, zero_sum
from weftable.operators.numbering import dense_numbers
from weftable.operators.weights import usable
from weftable.sources.matrix import CELL, LINE_SIZE, LINE_SUM, LabelledMatrix
from weftable.sources.staging import stage

Z_KEYS = ("resource_country", "resource_industry", "use_country", "use_industry")


def _side(key: DataFrame, side: str) -> DataFrame:
    return usable(key).select(
        F.col("country").alias(f"{side}_country"),
        F.col("src").alias(f"{side}_src"),
        F.col("industry").alias(f"{side}_industry"),
        F.col("weight").alias(f"_{side}_weight"),
    )


def _product():
    return F.col("value") * F.col("_resource_weight") * F.col("_use_weight")


def spread_two_sided(cells: DataFrame, key: DataFrame) -> DataFrame:
    """Cells (resource_country, resource_src, use_country, use_src, value) to common industries.

    The double crosswalk is bilinear, so each side is joined with the key by
    itself and one aggregation sums the products; pairs of key rows are never
    formed. Partial aggregation runs before the only shuffle of the cells.
    """
    weighted = cells.join(_side(key, "resource"), ["resource_country", "resource_src"]).join(
        _side(key, "use"), ["use_country", "use_src"]
    )
    return weighted.groupBy(*Z_KEYS).agg(null_sum(_product()).alias("value"))


def _both_first() -> Column:
    """True in one of the rows that a cell has become by its joins with the key."""
    return F.coalesce("_resource_first", F.lit(True)) & F.coalesce("_use_first", F.lit(True))


def _sum_of_first(value: Column) -> Column:
    """Sum, null as soon as a value is, over the first row of each cell; zero if there is none in the group."""
    first = F.col("_first")
    n, known = F.count(F.when(first, 1)), F.count(F.when(first, value))
    return F.when(n == 0, F.lit(0.0)).when(n == known, F.sum(F.when(first, value)))


def spread_whole(cells: DataFrame, key: DataFrame) -> DataFrame:
    """``spread_two_sided``, what it leaves out for want of a weight, and the raw value: one pass and one sum.

    Cells without a weight on either side are summed by pair of countries, with
    ``UNWEIGHTED`` for both industries; together the values hold the whole of
    the cells. ``raw`` and ``scale`` add up to the sum of the cells and of their
    sizes as they were before any weight: each cell counts once there, in
    whichever group its first row lands.
    """
    flagged = cells.join(_flagged_side(key, "resource"), ["resource_country", "resource_src"], "left").join(
        _flagged_side(key, "use"), ["use_country", "use_src"], "left"
    )
    weighted = F.col("_resource_weight").isNotNull() & F.col("_use_weight").isNotNull()
    rows = flagged.withColumn("_first", _both_first()).where(weighted | F.col("_first"))
    rows = rows.select(
        "resource_country",
        "use_country",
        *[F.when(weighted, F.col(f"{s}_industry")).otherwise(c.UNWEIGHTED).alias(f"{s}_industry") for s in ("resource", "use")],
        F.when(weighted, _product()).otherwise(F.col("value")).alias("_part"),
        F.col("value").alias("_value"),
        "_first",
    )
    return rows.groupBy(*Z_KEYS).agg(
        exact_null_sum("_part").alias("value"),
        _sum_of_first(F.col("_value")).alias("raw"),
        _sum_of_first(F.abs("_value")).alias("scale"),
    )


def _flagged_side(key: DataFrame, side: str, *more: str) -> DataFrame:
    """One side of the usable key; ``_first`` marks one row of each label."""
    first = F.row_number().over(Window.partitionBy("country", "src").orderBy("industry")) == 1
    return usable(key).select(
        F.col("country").alias(f"{side}_country"),
        F.col("src").alias(f"{side}_src"),
        F.col("industry").alias(f"{side}_industry"),
        F.col("weight").alias(f"_{side}_weight"),
        first.alias(f"_{side}_first"),
        *[F.col(name).alias(f"_{side}_{name}") for name in more],
    )


@dataclass(frozen=True)
class MatrixSpread:
    """One pass over a labelled matrix: the common cells, what has no weights, and the lines' own sums."""

    z: DataFrame
    unweighted: DataFrame
    lines: DataFrame


_WEIGHTED, _UNWEIGHTED, _LINE, _LINE_SIZE = range(4)


def spread_matrix(matrix: LabelledMatrix, key: DataFrame) -> MatrixSpread:
    """A labelled matrix to common industries, without any join on its cells but that on position.

    Rows carry resource_country and resource_src, columns use_country and
    use_src. The key meets the line labels before a line is unfolded and the
    column labels before the column dimension is broadcast. Weighted cells are
    shuffled by two integers, the numbers of their targets; labels return by
    joins with the sums. In the same unfolding, cells without a weight on either
    side are summed by pair of countries, and each line hands on the sums that
    it formed of its own cells, which know of no key and no column. All sums are
    staged together, so the matrix is read once.

    ``lines`` has one row per line label: resource_country, resource_src, the
    sum ``value`` and the sum of sizes ``scale``.
    """
    targets = stage(dense_numbers(usable(key), ["country", "industry"], "target"), "targets")
    placed = stage(usable(key).join(targets, ["country", "industry"]), "placed")

    def side(name: str) -> DataFrame:
        return _flagged_side(placed, name, "target").drop(f"{name}_industry")

    keyed = matrix.with_rows(
        lambda rows: rows.join(side("resource"), ["resource_country", "resource_src"], "left")
    ).with_columns(lambda columns: columns.join(side("use"), ["use_country", "use_src"], "left"))
    entry = F.col("_entry")
    weighted = (entry == CELL) & F.col("_resource_target").isNotNull() & F.col("_use_target").isNotNull()
    kind = (
        F.when(entry == LINE_SUM, _LINE)
        .when(entry == LINE_SIZE, _LINE_SIZE)
        .when(weighted, _WEIGHTED)
        .otherwise(_UNWEIGHTED)
    )
    rows = keyed.cells_and_sums().where(weighted | _both_first())
    sums = (
        rows.select(
            kind.alias("_kind"),
            F.when(weighted, F.col("_resource_target")).alias("_resource"),
            F.when(weighted, F.col("_use_target")).alias("_use"),
            F.when(~weighted, F.col("resource_country")).alias("resource_country"),
            F.when(entry != CELL, F.col("resource_src")).alias("resource_src"),
            F.when(~weighted, F.col("use_country")).alias("use_country"),
            F.when(weighted, _product()).otherwise(F.col("value")).alias("value"),
        )
        .groupBy("_kind", "_resource", "_use", "resource_country", "resource_src", "use_country")
        .agg(exact_null_sum("value").alias("value"))
    )
    staged = stage(sums, "spread")

    def labels(name: str) -> DataFrame:
        return targets.select(
            F.col("target").alias(f"_{name}"),
            F.col("country").alias(f"{name}_country"),
            F.col("industry").alias(f"{name}_industry"),
        )

    numbered = staged.where(F.col("_kind") == _WEIGHTED).select("_resource", "_use", "value")
    own = {k: F.max(F.when(F.col("_kind") == k, F.col("value"))) for k in (_LINE, _LINE_SIZE)}
    return MatrixSpread(
        z=numbered.join(labels("resource"), "_resource").join(labels("use"), "_use").select(*Z_KEYS, "value"),
        unweighted=staged.where(F.col("_kind") == _UNWEIGHTED).select(
            "resource_country",
            F.lit(c.UNWEIGHTED).alias("resource_industry"),
            "use_country",
            F.lit(c.UNWEIGHTED).alias("use_industry"),
            "value",
        ),
        lines=staged.where(F.col("_kind").isin(_LINE, _LINE_SIZE))
        .groupBy("resource_country", "resource_src")
        .agg(own[_LINE].alias("value"), own[_LINE_SIZE].alias("scale")),
    )


def spread_one_sided(account: DataFrame, key: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Totals (country, src, extra..., value) to common industries by the producer's weights.

    Every key row expects its total; a total that is missing makes the cells it
    should have fed null. ``account`` has one row per (country, src, extra).
    """
    expected = key.join(account, ["country", "src", *extra], "left")
    value = F.col("value") * F.col("weight")
    return expected.groupBy("country", "industry", *extra).agg(null_sum(value).alias("value"))


def spread_dense(
    account: DataFrame, key: DataFrame, index: DataFrame, extra: Sequence[str]
) -> DataFrame:
    """Like ``spread_one_sided`` with missing totals as zero, over a full index.

    ``index`` lists every cell of the result. Totals are weighted and summed
    first; only the result, which is no larger than the index, meets the index.
    """
    value = F.col("value") * F.col("weight")
    cells = [F.col("country"), F.col("industry"), *[F.col(x) for x in extra]]
    sparse = (
        account.join(key, ["country", "src"]).groupBy(*cells).agg(zero_sum(value).alias("value"))
    )
    names = ["country", "industry", *extra]
    return index.join(sparse, names, "left").select(
        *names, F.coalesce("value", F.lit(0.0)).alias("value")
    )
