"""Building the many-to-many crosswalk from its one-hot table."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftable import classification as c
from weftable.operators.checks import repeated_keys, require
from weftable.sources.staging import stage


def industry_map(spark: SparkSession) -> DataFrame:
    """The fixed map (raw industry, common industry, flat-file codes) as a local table."""
    raw, industry, codes = zip(*c.INDUSTRY_MAP)
    return spark.createDataFrame(
        pa.table({"raw_industry": raw, "industry": industry, "codes": [list(x) for x in codes]})
    )


def build_crosswalk(one_hot: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """One-hot table to rows (src, raw_industry, industry, code).

    A source label may lead to several industries and an industry may come
    from several labels. Countries of the table play no part in the result.
    """
    mapping = industry_map(one_hot.sparkSession) if mapping is None else mapping
    labels = {c.CROSSWALK_COUNTRY, c.CROSSWALK_SOURCE, *c.CROSSWALK_UNUSED}
    industries = [name for name in one_hot.columns if name not in labels]
    marked = (
        one_hot.select(F.col(c.CROSSWALK_SOURCE).alias("src"), *industries)
        .unpivot("src", industries, "raw_industry", "marked")
        .where("marked = 1")
        .withColumn(
            "raw_industry",
            F.when(F.col("src") == c.EXTRATERRITORIAL_LABEL, F.lit(c.EXTRATERRITORIAL_CODE)).otherwise(
                F.col("raw_industry")
            ),
        )
    )
    return (
        marked.select("src", "raw_industry")
        .distinct()
        .join(mapping, "raw_industry")
        .select("src", "raw_industry", "industry", F.explode("codes").alias("code"))
    )


def code_industries(crosswalk: DataFrame) -> DataFrame:
    """One row per flat-file code with its industry, for use as a lookup.

    Several raw industries may share a code, but must agree on the industry.
    The table, some sixty rows, is staged: what it is built from is not built
    again, and Catalyst sees how small it is.
    """
    codes = stage(crosswalk.select("code", "industry").distinct(), "codes")
    require(repeated_keys(codes, ["code"]), "codes with several industries")
    return codes


def source_industries(crosswalk: DataFrame) -> DataFrame:
    """Distinct (src, industry) pairs: repeated raw columns must not count twice."""
    return crosswalk.select("src", "industry").distinct()


def grid(df: DataFrame, column: str, values: DataFrame | Sequence[str]) -> DataFrame:
    """Every row of a dimension with every value of a code list.

    The code list (countries, components) is one array that each row unfolds,
    so the dimension is neither shuffled nor joined.
    """
    if isinstance(values, DataFrame):
        name = values.columns[0]
        listed = values.agg(F.sort_array(F.collect_set(name))).scalar()
    else:
        listed = F.array(*[F.lit(v) for v in values])
    return df.withColumn(column, F.explode(listed))


def hybrid_grid(countries: DataFrame, industries: DataFrame) -> DataFrame:
    """The full country x industry index of the common classification, in order."""
    index = grid(industries.select("industry").distinct(), "country", countries.select("country"))
    return index.select("country", "industry").orderBy("country", "industry")
