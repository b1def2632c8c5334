"""Finding input files on any storage that Hadoop's file system layer knows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import SparkSession

from weftable import classification as c


def list_entries(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """(name, path) of what lies directly in a folder: files, and tables written as folders.

    One listing of one level by the storage itself; names are those it gives,
    however the folder is written. Hidden entries are left out.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    storage = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not storage.exists(path):
        raise FileNotFoundError(f"no folder {folder}")
    entries = [(x.getPath().getName(), x.getPath().toString()) for x in storage.listStatus(path)]
    return sorted(x for x in entries if not x[0].startswith((".", "_")))


def find_file(spark: SparkSession, folder: str, patterns: Sequence[str]) -> str:
    """The one entry of a folder whose name matches every pattern.

    No match, or more than one, is an error: a scan must not guess its input.
    """
    entries = list_entries(spark, folder)
    paths = [path for name, path in entries if all(re.search(p, name) for p in patterns)]
    if len(paths) != 1:
        raise FileNotFoundError(
            f"{'no' if not paths else 'more than one'} file matching {list(patterns)} in {folder}"
        )
    return paths[0]


def reference_flat_file(
    spark: SparkSession, folder: str, year: int, edition: str = c.REFERENCE_EDITION
) -> str:
    return find_file(spark, folder, [f"{c.REFERENCE_FLAT_PATTERN}_{re.escape(edition)}", str(year)])


def flat_file(spark: SparkSession, folder: str) -> str:
    return find_file(spark, folder, [re.escape(p) for p in c.FLAT_FILE_PATTERNS])


def flat_emissions_file(spark: SparkSession, folder: str) -> str:
    return find_file(spark, folder, [c.FLAT_EMISSIONS_PATTERN])


def wide_table_file(spark: SparkSession, folder: str) -> str:
    return find_file(spark, folder, [c.WIDE_FILE_PATTERN])


def wide_emissions_file(spark: SparkSession, folder: str) -> str:
    return find_file(spark, folder, [f"^{re.escape(c.WIDE_EMISSIONS_FILE)}$"])


def list_sources(spark: SparkSession, folder: str) -> list[str]:
    """Names of the source folders below an output folder, in order.

    The folder of earlier comparisons is not a source.
    """
    return [name for name, _ in list_entries(spark, folder) if name != c.COMPARISON_FOLDER]
