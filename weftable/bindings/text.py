"""Writing cells as wide text, the form in which sources publish their matrices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftable.sources.staging import stage


def write_wide_text(
    cells: DataFrame,
    rows: Sequence[str],
    columns: Sequence[str],
    path: str,
    marks: Sequence[Sequence[str]],
    sep: str = "\t",
    parts: int | None = None,
    blank: Column | None = None,
) -> str:
    """Write cells (rows..., columns..., value) as a dense matrix of delimited text.

    ``marks`` gives the leading fields of each label line; label lines beyond
    the number of ``columns`` are empty. Lines are spread over ``parts`` files (as
    many as shuffle partitions) and each starts with the label lines. A line holds as many cells as the
    matrix has columns; lines for which ``blank`` holds have empty cells.
    """
    rows, columns = list(rows), list(columns)
    parts = parts or int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    totals = stage(cells.groupBy(*rows, *columns).agg(F.sum("value").alias("value")), "cells")
    labels = stage(
        totals.agg(F.sort_array(F.collect_set(F.struct(*columns))).alias("all")), "labels"
    )
    width = labels.select("all").scalar()

    dense = (
        totals.select(*rows)
        .distinct()
        .select(*rows, F.posexplode(width).alias("pos", "label"))
        .select(*rows, "pos", *[F.col(f"label.{x}").alias(x) for x in columns])
        .join(totals, [*rows, *columns], "left")
    )
    text = F.coalesce(F.col("value").cast("string"), F.lit("0"))
    if blank is not None:
        text = F.when(blank, F.lit("")).otherwise(text)
    ordered = F.sort_array(F.collect_list(F.struct("pos", text.alias("text"))))
    part = F.pmod(F.xxhash64(*rows), F.lit(parts)).alias("part")
    data = dense.groupBy(*rows).agg(ordered.alias("line")).select(
        part,
        F.lit(len(marks)).alias("number"),
        F.concat_ws(sep, *rows, F.col("line.text")).alias("value"),
    )

    def label_line(number: int):
        fields = (
            F.col("all").getField(columns[number])
            if number < len(columns)
            else F.transform("all", lambda _: F.lit(""))
        )
        return F.struct(
            F.lit(number).alias("number"),
            F.concat_ws(sep, *[F.lit(m) for m in marks[number]], fields).alias("value"),
        )

    header = F.array(*[label_line(number) for number in range(len(marks))])
    lines = labels.select(F.explode(header).alias("h")).agg(F.collect_list("h")).scalar()
    heads = (
        totals.select(part)
        .distinct()
        .select("part", F.explode(lines).alias("h"))
        .select("part", "h.number", "h.value")
    )
    (
        data.unionByName(heads)
        .repartition("part")
        .sortWithinPartitions("part", "number", "value")
        .select("part", "value")
        .write.partitionBy("part")
        .text(path)
    )
    return path
