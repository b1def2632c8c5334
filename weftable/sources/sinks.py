"""Writers for aligned accounts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from weftable import classification as c
from weftable.functions.labels import unite_id


def with_ids(df: DataFrame, account: str) -> DataFrame:
    """Add the composite ids of an account; its own key columns stay."""
    if account == "Z":
        return df.withColumns(
            {
                "use_id": unite_id("use_country", "use_industry"),
                "resource_id": unite_id("resource_country", "resource_industry"),
            }
        )
    return df.withColumn("id", unite_id("country", "industry"))


def write_csv(df: DataFrame, path: str) -> None:
    """Semicolon text in Latin-1 with a header; written in parallel as parts."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", c.ACCOUNT_SEPARATOR)
        .option("encoding", c.ACCOUNT_ENCODING)
        .option("nullValue", c.ACCOUNT_NULL)
        .option("quoteAll", True)
        .csv(path)
    )


def write_account_csv(df: DataFrame, folder: str, account: str) -> None:
    write_csv(with_ids(df, account), f"{folder.rstrip('/')}/{account}.csv")


def write_by_country(df: DataFrame, path: str, column: str = "resource_country") -> None:
    """Parquet with one folder per country; a rerun replaces only the countries it has.

    One country may hold a third of all rows, so its rows are spread over as many
    tasks as their bytes ask for.
    """
    (
        df.hint("rebalance", column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


# --- tables that are replaced as a whole -------------------------------------------------------

_CURRENT = "current"


def _storage(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the version that the manifest of a published table names; none if nothing was published."""
    _, folder, storage = _storage(spark, path)
    if not storage.exists(folder.suffix(f"/{_CURRENT}")):
        return None
    name = spark.read.text(f"{path.rstrip('/')}/{_CURRENT}").first()[0]
    return f"{path.rstrip('/')}/{name}"


def publish_by_country(df: DataFrame, path: str, column: str = "resource_country") -> str:
    """Replace a table with one folder per country by ``df``; a country that ``df`` lacks is gone.

    The rows are written aside, under a name of their own. Only when all of them
    are there the manifest is made to name them, in one rename; a run that fails
    before leaves the table as it was. ``df`` may read the version it replaces.
    That version stays for those who read it, the ones before it are deleted.
    Two runs at a time leave the version of the later.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    jvm, folder, storage = _storage(spark, root)
    before = current_version(spark, root)
    name = f"version-{uuid.uuid4().hex}"
    df.hint("rebalance", column).write.partitionBy(column).parquet(f"{root}/{name}")

    aside = folder.suffix(f"/_{name}")
    out = storage.create(aside, True)
    out.write(bytearray(name.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(storage.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    files.rename(aside, folder.suffix(f"/{_CURRENT}"), options)

    for entry in storage.listStatus(folder):
        version = entry.getPath().getName()
        if version.startswith("version-") and version != name and f"{root}/{version}" != before:
            storage.delete(entry.getPath(), True)
    return f"{root}/{name}"


def read_published(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The version of a table that was published last."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing was published in {path}")
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(version)
