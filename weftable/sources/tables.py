"""Scans of delimited tables and of one-label wide tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftable import classification as c
from weftable import schemas
from weftable.functions.labels import finite_or_null, lenient_double
from weftable.sources.matrix import LabelledMatrix, read_matrix


def read_text_columns(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """All columns of a delimited file as text, named by its header line.

    Parts of one table must agree on the header; a part that does not is an error.
    """
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("enforceSchema", False)
        .csv(path)
    )


#: Column with the place of a row in the files it was read from.
LINE = "_line"


def in_file_order() -> Column:
    """Place of a row in the files of a scan: file, block, place within the block.

    A task may read blocks of several files, in the order of their sizes, so the
    number that a task gives its rows orders them within a block only.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )


def read_typed(
    spark: SparkSession, path: str, schema: str, sep: str = ",", encoding: str = "UTF-8", line: str | None = None
) -> DataFrame:
    """The columns of ``schema``, taken by name; unreadable numbers become null.

    With ``line``, a column of that name orders the rows as the files have them.
    """
    text = read_text_columns(spark, path, sep, encoding)
    return text.select(
        *([in_file_order().alias(line)] if line else []),
        *[
            F.col(field.name)
            if isinstance(field.dataType, T.StringType)
            else F.trim(field.name).try_cast(field.dataType).alias(field.name)
            for field in T.StructType.fromDDL(schema).fields
        ]
    )


def read_flat_file(spark: SparkSession, path: str) -> DataFrame:
    return read_typed(spark, path, schemas.FLAT_FILE)


def read_flat_emissions(spark: SparkSession, path: str) -> DataFrame:
    return read_typed(spark, path, schemas.FLAT_EMISSIONS)


def read_wide_emissions(spark: SparkSession, path: str) -> DataFrame:
    return read_typed(spark, path, schemas.WIDE_EMISSIONS)


def read_units(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    return read_typed(spark, path, schemas.UNITS, sep="\t", line=LINE if ordered else None)


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    return read_typed(spark, path, schemas.RATES)


def read_crosswalk(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """The one-hot crosswalk as it is: label columns and one 0/1 column per industry."""
    text = read_text_columns(spark, path, sep)
    labels = {c.CROSSWALK_COUNTRY, c.CROSSWALK_SOURCE, *c.CROSSWALK_UNUSED}
    return text.select(
        *[n if n in labels else F.trim(n).try_cast("int").alias(n) for n in text.columns]
    )


def read_wide_table(spark: SparkSession, path: str) -> LabelledMatrix:
    """Comma table with row labels in its first column and one column per use."""
    return read_matrix(spark, path, ["resource_id"], ["use_id"], sep=",", quote='"')


# The three shapes of the matrix source: transactions, demand, and factor inputs
# or emissions. Two label lines count; a third one may follow.


def read_flow_matrix(spark: SparkSession, path: str) -> LabelledMatrix:
    return read_matrix(
        spark, path, ["resource_region", "resource_sector"], ["use_region", "use_sector"]
    )


def read_demand_matrix(spark: SparkSession, path: str) -> LabelledMatrix:
    return read_matrix(spark, path, ["region", "sector"], ["use_region", "component"])


def read_factor_matrix(spark: SparkSession, path: str) -> LabelledMatrix:
    return read_matrix(spark, path, ["component"], ["region", "sector"])


def read_emissions_matrix(spark: SparkSession, path: str) -> LabelledMatrix:
    return read_matrix(spark, path, ["stressor"], ["region", "sector"])


def select_by_pattern(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """Pick one column per pattern (case-insensitive) and give it the new name."""
    picked = []
    for name, pattern in patterns.items():
        found = [col for col in df.columns if re.search(pattern, col, re.IGNORECASE)]
        if len(found) != 1:
            raise ValueError(f"pattern {pattern!r} matches {found}, expected one column")
        picked.append(F.col(found[0]).alias(name))
    return df.select(*picked)


# Which columns of a written account make up its key, by pattern.
_ACCOUNT_PATTERNS: dict[str, Sequence[tuple[str, str]]] = {
    "Z": (("use_id", "use_id"), ("resource_id", "resource_id")),
    "VA": (("id", "id"), ("component", "component")),
    "D": (("id", "id"), ("counterpartarea", "counterpartarea"), ("component", "component")),
    "emissions": (("id", "id|emissions"),),
}


def read_account_csv(spark: SparkSession, path: str, account: str, source: str = "value") -> DataFrame:
    """A written account: its key columns, and its value named after the source."""
    text = (
        spark.read.option("header", True)
        .option("sep", c.ACCOUNT_SEPARATOR)
        .option("encoding", c.ACCOUNT_ENCODING)
        .option("nullValue", c.ACCOUNT_NULL)
        .option("enforceSchema", False)
        .csv(path)
    )
    keys = select_by_pattern(text, {**dict(_ACCOUNT_PATTERNS[account]), "value": "^value$"})
    return keys.withColumn("value", finite_or_null(lenient_double("value"))).withColumnRenamed("value", source)
