"""Sinks: CSV, stage results, versioned table replacement, models."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelsight.sources.readers import EMPTY, POINTER, current_number


def write_delimited(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """CSV with a header; text with quotes, blanks and line breaks survives a round trip."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def _foldered(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> DataFrame:
    """Store the schema beside the folder, and rebalance rows by the columns that name folders."""
    spark = df.sparkSession
    schema = spark.range(1).select(F.lit(df.schema.json()).alias("schema"))
    schema.coalesce(1).write.mode("overwrite").text(f"{path}.schema")
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    for column in partition_by:
        if isinstance(df.schema[column].dataType, T.StringType):
            df = df.withColumn(column, F.when(F.col(column) == "", EMPTY).otherwise(F.col(column)))
    return df


def write_stage(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    """Parquet result of one stage, replacing an earlier run of the same stage.

    With partition columns the rows are rebalanced first: one writer per folder for small
    values, several for a value that holds a large share of the rows. The schema is stored
    beside the folder, since a folder's name keeps neither the type of a value nor the empty
    string; :func:`parcelsight.sources.readers.read_stage` gives both back.
    """
    rows = _foldered(df, path, partition_by)
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def replace_folders(df: DataFrame, path: str, *partition_by: str) -> str:
    """Replace only those folders of a partitioned stage that ``df`` has rows of.

    The other folders keep their files. ``df`` must have the columns of the stage and not read
    from it; a stage that is not there yet is created.
    """
    rows = _foldered(df, path, partition_by).write.option("partitionOverwriteMode", "dynamic")
    rows.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def append_stage(df: DataFrame, path: str, *partition_by: str) -> str:
    """Add the rows of ``df`` to a stage with the same columns and folders."""
    _foldered(df, path, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)
    return path


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def stored(spark: SparkSession, path: str) -> bool:
    """Whether a stage was written in this place. (Replaced folders leave no mark of success.)"""
    files, place = _file_system(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def replace_table(
    df: DataFrame, root: str, name: str, based_on: int | None = None
) -> tuple[DataFrame, str]:
    """Replace table ``name`` by ``df``, which may itself read the present version.

    Spark cannot overwrite files it is reading, so every version has a folder of its own. Once
    it is complete, a pointer to it is added, and the view ``name`` of this session points at
    it; other sessions find it with :func:`parcelsight.sources.readers.read_current`. Readers
    of an older version are not disturbed until ``drop_superseded``.

    Pointers are numbered from the version that was read: ``based_on``
    (:func:`parcelsight.sources.readers.current_number`, asked before reading), or the newest one
    when the call starts. If another writer has taken the next number meanwhile, nothing is
    replaced and ``RuntimeError`` is raised. Two writers are told apart by the file system, which
    creates a file only once.
    """
    spark, base = df.sparkSession, f"{root.rstrip('/')}/{name}"
    number = (current_number(spark, root, name) if based_on is None else based_on) + 1
    version = uuid.uuid4().hex
    path = f"{base}.versions/{version}"
    df.write.parquet(path)
    pointer = {"number": number, "version": version, "schema": df.schema.json()}
    files, place = _file_system(spark, f"{base}.current/{number:012d}.json")
    if current_number(spark, root, name) >= number:
        raise RuntimeError(f"{name} was replaced by another writer since version {number - 1}")
    try:
        out = files.create(place, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error.java_exception):
            raise
        raise RuntimeError(
            f"another writer has taken version {number} of {name}; if it has died, delete {place}"
        ) from error
    out.write(bytearray(json.dumps(pointer).encode()))
    out.close()
    fresh = spark.read.schema(df.schema).parquet(path)
    fresh.createOrReplaceTempView(name)
    return fresh, path


def drop_superseded(spark: SparkSession, root: str, name: str) -> None:
    """Delete all versions of a table but the current one; no one may be reading them."""
    base = f"{root.rstrip('/')}/{name}"
    rows = spark.read.schema(POINTER).json(f"{base}.current").orderBy("number").collect()
    for row in rows[:-1]:
        remove(spark, f"{base}.versions/{row['version']}")


def save_models(
    models: Mapping[str, PipelineModel], accuracies: DataFrame, root: str
) -> dict[str, str]:
    """Store fitted pipelines and their accuracy table side by side."""
    paths = {name: f"{root}/model_{name}" for name in models}
    for name, model in models.items():
        model.write().overwrite().save(paths[name])
    paths["accuracies"] = write_stage(accuracies, f"{root}/accuracies")
    return paths


def load_models(
    spark: SparkSession, paths: Mapping[str, str]
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Counterpart of :func:`save_models`."""
    models = {k: PipelineModel.load(p) for k, p in paths.items() if k != "accuracies"}
    return models, spark.read.parquet(paths["accuracies"])
