"""Documents that are hard on every operator."""

from __future__ import annotations

LONG = " ".join(f"w{i % 5000}" for i in range(40_000))
#: Ids that are null or repeat, texts that are null, empty, blank, very long or equal.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "the same words here once more"), (6, "the same words here once more"),
    (6, "the same words here once more"), (None, "a text without any id at all"), (7, LONG), (8, "x" * 50_000),
    (9, "é😀▁ 梦\x00  ok"), (10, "A b C d"), (11, "a B c D"),
]
#: Columns named like those the operators use inside.
CLASHING = ("key", "id", "sid", "n", "line", "host", "words", "sketch", "row", "bucket", "score", "label", "__row", "__keys", "__text_hash", "hash", "__gone")


def frame(spark, rows=ODD, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if not extra:
        return df
    from pyspark.sql import functions as F

    return df.withColumn("source", F.lit("s")).withColumns({c: F.lit("other") for c in CLASHING})


def texts(rows=ODD):
    return [(i, t or "") for i, t in rows]
