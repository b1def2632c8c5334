"""Composite ids and lenient parsing of text cells."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def unite_id(*parts: Column | str, sep: str = "_", null_text: str = "NA") -> Column:
    """Join label parts into one id; a missing part is written as ``null_text``."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit(null_text)) for c in columns])


def split_id(value: Column | str, sep: str = "_") -> tuple[Column, Column]:
    """Split an id at its first separator; the rest stays whole.

    An id without separator has a null second part.
    """
    value = F.col(value) if isinstance(value, str) else value
    parts = F.split(value, re.escape(sep), 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def lenient_double(value: Column | str) -> Column:
    """Text to double, blanks around it aside; text that is no number becomes null."""
    value = F.col(value) if isinstance(value, str) else value
    return value.try_cast("double")


def finite_or_null(value: Column | str) -> Column:
    """NaN to null, so that both kinds of missing follow one rule."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(~F.isnan(value), value)
