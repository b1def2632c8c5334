"""Document fingerprints: bottom-k sketches of the hashes of five-word shingles.

A sketch is the ascending array of the ``k`` smallest distinct 64-bit shingle hashes. Sketches of parts
merge into the sketch of the whole, and two sketches estimate resemblance, containment and the number of
distinct shingles. Only built-in functions are used.

Defined cases: words are separated by white space and lower-cased; a text of one to four words is one
shingle; a null, empty or blank text has an empty sketch, which resembles another empty one by 1 and any
other by 0; a table's order is ascending id, nulls first, equal ids by text, so repeated rows follow each
other; the last document is followed by the first, a single one by itself; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

K = 128
WORDS = 5
BUCKET = 256
OUTER = 1024


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+", -1), lambda w: w != "")


def sketch_of(words: Column, k: int = K, n: int = WORDS) -> Column:
    """Bottom-k sketch of a column of word arrays; ``words`` must be a plain column, as it is read for each shingle.

    Places after the last word are null and leave the hash as it is, so few words are one shingle.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0)))
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(n)]))
    return F.when(F.size(words) > 0, F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)).otherwise(
        F.array().cast("array<bigint>")
    )


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two parts."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity, exact while both parts have at most ``k`` shingles together."""
    return _shared(merge(a, b, k), a, b)


def _shared(union: Column, a: Column, b: Column) -> Column:
    """Share of the sketch of the union that both parts have."""
    shared = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(shared / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles, exact below ``k``."""
    share = (F.element_at(a, k).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too."""
    whole = distinct_shingles(merge(a, b, k), k)
    share = resemblance(a, b, k) * whole / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), share))


def merge_sketches(df: DataFrame, by: list[str], sketch: str, k: int = K) -> DataFrame:
    """One sketch per group from the sketches of its parts; rows shuffled are single hashes, pre-reduced per task."""
    hashes = df.select(*by, F.explode(sketch).alias("__h")).groupBy(*by, "__h").agg(F.lit(1).alias("__n"))
    ranked = hashes.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy("__h")))
    return ranked.filter(F.col("__r") <= k).groupBy(*by).agg(F.sort_array(F.collect_list("__h")).alias(sketch))


def as_text(sketch: Column) -> Column:
    """Fixed-width hexadecimal form."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_next(docs: DataFrame, key: str, *, bucket: int = BUCKET) -> tuple[DataFrame, Window]:
    """Rows ``id, text, bucket, extra`` and a window in which ``lead`` sees the next document.

    Keys are cut into ranges of about ``bucket`` rows. The first rows of each range also go, as
    ``extra`` rows, to the end of the range before, so one shuffle of the texts by range is enough.
    """
    own = docs.select(F.col(key).alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    low, high, count = own.agg(F.min("id"), F.max("id"), F.count("id")).first()
    low, high = low or 0, high or 0
    width = max(1, math.ceil((high - low + 1) * bucket / max(count, 1)))
    place = F.expr(f"cast((cast(id as decimal(20,0)) - {low}) div {width} as bigint)")
    ranged = own.withColumn("bucket", F.coalesce(place, F.lit(-1)))
    firsts = ranged.groupBy("bucket").agg(F.min("id").alias("first"))
    outer = F.floor(F.col("bucket") / OUTER)
    inside = firsts.withColumn("outer", outer).withColumn(
        "before", F.lag("bucket").over(Window.partitionBy("outer").orderBy("bucket"))
    )
    ends = firsts.groupBy(outer.alias("outer")).agg(F.max("bucket").alias("last"))
    # one row for about a quarter of a million documents
    around = ends.withColumn("into", F.lag("last").over(Window.orderBy("outer")))
    end = ends.agg(F.max("last")).first()[0]
    to = F.coalesce("before", "into", F.lit(end).cast("bigint")).alias("to")
    links = written(inside.join(around, "outer").select("first", to), "ranges")
    copies = ranged.join(links, ranged["id"].eqNullSafe(links["first"])).select("id", "text", F.col("to").alias("bucket"))
    rows = ranged.withColumn("extra", F.lit(False)).unionByName(copies.withColumn("extra", F.lit(True)))
    return rows, Window.partitionBy("bucket").orderBy("extra", "id", "text")


def fingerprints(docs: DataFrame, key: str = "doc_id", k: int = K) -> DataFrame:
    """Sketches of each document, of its edited text, and their likeness to each other and to the next document's.

    The edited text has its last quarter of code points replaced by the beginning of the next document.
    """
    rows, ordered = with_next(docs, key)
    spread = rows.repartition("bucket")
    own = spread.withColumn("words", words_of(F.col("text"))).withColumn("sketch", sketch_of(F.col("words"), k)).drop("words")
    follow = own.select(
        "id",
        "text",
        "sketch",
        "extra",
        F.lead("text").over(ordered).alias("next_text"),
        F.lead("sketch").over(ordered).alias("next_sketch"),
    ).filter(~F.col("extra"))
    n = F.length("text")
    take = F.floor(n / 4).cast("int")
    edited = follow.select(
        F.col("id"),
        n.cast("long").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), n - take), F.substring("next_text", F.lit(1), take)).alias("edited"),
        "sketch",
        "next_sketch",
    )
    both = edited.withColumn("edited_words", words_of(F.col("edited"))).withColumn(
        "edited_sketch", sketch_of(F.col("edited_words"), k)
    )
    both = both.withColumn("union", merge(F.col("sketch"), F.col("edited_sketch"), k))
    both = both.withColumn("union_next", merge(F.col("sketch"), F.col("next_sketch"), k))
    return both.select(
        F.col("id").alias(key),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        _shared(F.col("union"), F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        _shared(F.col("union_next"), F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        distinct_shingles(F.col("sketch"), k).alias("shingles"),
    )
