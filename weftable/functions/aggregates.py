"""Sums that keep the two missing-value rules apart."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from weftable.functions.labels import finite_or_null


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def null_sum(value: Column | str) -> Column:
    """Sum that is null as soon as one summand is null.

    Both parts are partial aggregates, so the rule costs no extra shuffle and
    it survives summing in several stages.
    """
    value = _column(value)
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))


# A double as whole multiples of 2**30, 1, 2**-30 and 2**-60. Each but the first is below 2**30, so that the sum of eight
# thousand million of them fits 64 bits.
_STEP = 30
_PARTS = (30, 0, -30, -60)
_LARGEST = 2.0**60


def exact_sum(value: Column | str, over: WindowSpec | None = None) -> Column:
    """Sum of doubles that does not depend on their order: equal for every partitioning, bit by bit.

    Each summand is cut without rounding into whole multiples of four powers of
    two, which are summed as integers; only their total is rounded to a double.
    Digits below 2**-60, some 1e-18, are cut off each summand. Summands of 2**60
    and more, or that are infinite, make it a plain sum; a total of more than
    some 8e19 is rounded part by part, still the same in any order. Null summands
    are left out, as in a plain sum.
    """
    value = _column(value).cast("double")
    of = (lambda x: x) if over is None else (lambda x: x.over(over))
    sums, rest = [], value
    small = F.abs(value) < _LARGEST
    for power in _PARTS:
        # towards zero, and without rounding: both sides of the difference are multiples of the summand's last digit
        part = F.when(small, (rest / F.lit(2.0**power)).cast("long"))
        sums.append(of(F.sum(part)))
        rest = rest - part * F.lit(2.0**power)
    whole, rough = None, F.lit(0.0)
    for total, power in zip(sums, _PARTS):
        rough = rough + total * F.lit(2.0**power)
        total = total.cast("decimal(20,0)")
        whole = total if whole is None else F.try_add(F.try_multiply(whole, F.lit(1 << _STEP).cast("decimal(10,0)")), total)
    exact = whole.cast("double") / F.lit(2.0 ** -_PARTS[-1])
    others = of(F.count(F.when(~small, 1)))
    return F.when(others == 0, F.coalesce(exact, rough)).otherwise(of(F.sum(value)))


def exact_null_sum(value: Column | str) -> Column:
    """``exact_sum`` that is null as soon as one summand is null."""
    value = _column(value)
    return F.when(F.count(value) == F.count(F.lit(1)), exact_sum(value))


def zero_sum(value: Column | str) -> Column:
    """Sum that counts missing values, NaN among them, as zero, also when all are missing."""
    return F.coalesce(F.sum(finite_or_null(value)), F.lit(0))


def row_total(*values: Column | str) -> Column:
    """Total across columns of one row; null as soon as one of them is null."""
    columns = [_column(v) for v in values]
    total = columns[0]
    for column in columns[1:]:
        total = total + column
    return total
