"""Materialized intermediate results in the folder all executors share.

A staged table cuts lineage in a way that survives the loss of executors, and its
file sizes give Catalyst a measured size to choose the join strategy by.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _LOCAL_FOLDERS.setdefault(
        context.applicationId, tempfile.mkdtemp(prefix="parcelsight-")
    )


def run_folder(spark: SparkSession) -> str:
    """The part of the shared folder that holds this application's intermediate results."""
    return f"{shared_folder(spark)}/parcelsight-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the run's folder that no earlier stage has used."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete the run's folder. Frames that read staged tables cannot be used any more: call it
    before the session is stopped."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing will read again: whatever was computed from them has been
    written. Frames that are no table of the run's folder are left alone."""
    for table in tables:
        spark = table.sparkSession
        folders = {name.rpartition("/")[0] for name in table.inputFiles()}
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            if path.getParent().getName() == run_folder(spark).rpartition("/")[2]:
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, name: str, records: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written.

    With ``records`` a file holds at most so many rows: few large tasks then leave a table that
    many tasks can read, without a shuffle.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("maxRecordsPerFile", records).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
