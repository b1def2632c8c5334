"""Choosing the release that is valid for a year."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_vintage(vintages: Mapping[int | str, str], year: int) -> str:
    """Location of the last release whose start year is not after ``year``.

    Entries whose name is not a year are releases of another kind and skipped.
    """
    starts = {int(k): v for k, v in vintages.items() if str(k).isdigit()}
    valid = [start for start in starts if start <= year]
    if not valid:
        raise ValueError(f"no release covers {year}")
    return starts[max(valid)]


def with_vintage(df: DataFrame, year: str, vintages: DataFrame, name: str = "location") -> DataFrame:
    """The same choice for every row; a year before the first release has none.

    ``vintages`` has ``start_year`` and ``location``. The release table (a
    handful of rows) becomes one array that each row looks through by itself:
    no range join, no shuffle of the facts.
    """
    releases = vintages.agg(F.collect_list(F.struct("start_year", "location"))).scalar()
    valid = F.filter("_releases", lambda r: r["start_year"] <= F.col(year))
    return (
        df.withColumn("_releases", releases)
        .withColumn(name, F.array_max(valid)["location"])
        .drop("_releases")
    )
