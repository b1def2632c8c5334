"""Written tables in the shared folder, and the tables of a folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from weftable.sources.staging import new_folder, stage, staged_tables

__all__ = ["bounded_batches", "new_path", "staged_tables", "table", "written"]

#: Bytes of a batch of rows on its way to Python. Whole texts and arrays come in thousands of bytes a row, so that Spark's own bounds
#: hold some 60 MB at once on either side of each task; batches of narrow rows are bounded by their rows.
BATCH_BYTES = 1 << 22
_MOST_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def new_path(spark: SparkSession, name: str) -> str:
    return new_folder(spark, f"llm-{name}")


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs begun within it send Python batches of some ``BATCH_BYTES`` at most, unless the session sets a bound of its own."""
    before = spark.conf.get(_MOST_BYTES, None)
    if before is None:
        spark.conf.set(_MOST_BYTES, str(BATCH_BYTES))
        try:
            yield
        finally:
            spark.conf.unset(_MOST_BYTES)
    else:
        yield


def written(df: DataFrame, name: str, outer: int = 0) -> DataFrame:
    """``df`` written once and read back: later jobs neither recompute it nor depend on executors that ran it.

    ``with staged_tables(spark):`` deletes what was written within it, or ``outer`` levels further in.
    """
    with bounded_batches(df.sparkSession):
        return stage(df, f"llm-{name}", outer=outer)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
