"""Written intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}
_staged: list[str] = []
_bucketed: list[str] = []  # their names in the session's catalogue


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the session; a local one only for local masters that name none."""
    folder = spark.conf.get(SHARED_FOLDER, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {SHARED_FOLDER} to a folder that every executor can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="rallymart-")
    return _local_folders[context.applicationId]


def stage(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write `df` once as Parquet and read it back, with the session's compression or the one named.

    Cuts the lineage, so a lost executor costs no recomputation of what came before, and
    later readers still get column pruning and pushed filters.
    """
    path = staging_path(df.sparkSession, name)
    _staged.append(path)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, key: str, buckets: int, sort: tuple[str, ...], name: str) -> DataFrame:
    """As `stage`, with one file for each bucket of `key`: work grouped by it needs no exchange."""
    spark, path = df.sparkSession, staging_path(df.sparkSession, name)
    table = os.path.basename(path).replace("-", "_")
    _staged.append(path)
    _bucketed.append(table)
    placed = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key, *sort)
    placed.option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def discard_staged(spark: SparkSession) -> None:
    """Delete what `stage` has written so far, once no frame that reads it is needed any more."""
    while _bucketed:
        spark.sql(f"DROP TABLE IF EXISTS {_bucketed.pop()}")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _staged:
        path = jvm.org.apache.hadoop.fs.Path(_staged.pop())
        path.getFileSystem(conf).delete(path, True)
