"""Written tables that cut lineage and give Catalyst real sizes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


_own: dict[str, str] = {}
_scopes: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Where none is named, a local session, whose tasks share its machine, gets
    a folder of its own; on any other master that is an error.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError(f"set {_SETTING} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="weftable-")
    return _own[app]


def new_folder(spark: SparkSession, name: str, outer: int = 0) -> str:
    """Path of a folder that does not exist yet, below the shared folder.

    It belongs to the innermost ``staged_tables``, or to the one ``outer`` levels
    around it; a folder made outside of all of them stays.
    """
    root = f"{shared_folder(spark).rstrip('/')}/weftable/{uuid.uuid4().hex}"
    if len(_scopes) > outer:
        _scopes[-1 - outer].append(root)
    return f"{root}/{name}"


@contextmanager
def staged_tables(spark: SparkSession) -> Iterator[None]:
    """Owner of the folders made within it: they are deleted when it ends.

    Results that read them must have been written or collected by then.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for root in _scopes.pop():
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = (), outer: int = 0) -> DataFrame:
    """Write ``df`` once and continue from the written table, which belongs to an owner as in ``new_folder``.

    The table survives lost executors and is read by any number of later jobs
    without recomputing. Catalyst plans joins against it by the bytes of its
    files, which are compressed, some three bytes for a row of a key: raise
    ``spark.sql.sources.fileCompressionFactor`` where tables near the broadcast
    threshold must be judged by their size in memory.
    """
    spark = df.sparkSession
    path = new_folder(spark, name, outer)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
