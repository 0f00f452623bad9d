"""Sources: text files with a header, stored tables, SQL strings, saved stages."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelsight.sources.schemas import RAW_REVIEW

# Folder name that stands for the empty string; Spark would read it back as NULL.
EMPTY = "__EMPTY_STRING__"
# A replaced table's pointers: the one with the largest number is the current version.
POINTER = "number long, version string, schema string"


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multiline: bool = False,
    trim: bool = True,
    missing: str = "",
) -> DataFrame:
    """CSV with a header row and an explicit schema.

    ``multiline`` is needed when a quoted field may hold a line break. Such files
    cannot be split, so keep the single files small; many files still read in parallel.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("ignoreLeadingWhiteSpace", trim)
        .option("ignoreTrailingWhiteSpace", trim)
        .option("nullValue", missing)
        .csv(path)
    )


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """The raw agent review file; blank cells and the mark NA are missing values."""
    return read_delimited(spark, path, RAW_REVIEW, multiline=True, missing="NA")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Whole stored table; Catalyst prunes the columns the caller does not use."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def run_sql(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """SQL text over DataFrames named in braces: ``run_sql(spark, "... FROM {t}", t=df)``."""
    return spark.sql(sql, **tables)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """A stored stage with the types and values it was written with, partition columns too."""
    stored = spark.read.text(f"{path}.schema").first()[0]
    schema = T.StructType.fromJson(json.loads(stored))
    rows = spark.read.schema(schema).parquet(path)
    # Only a partition column can hold the stand-in; a filter on it still prunes folders.
    return rows.select(
        *[
            F.when(F.col(f.name) == EMPTY, "").otherwise(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else f.name
            for f in schema.fields
        ]
    )


def _pointers(spark: SparkSession, base: str) -> DataFrame | None:
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{base}.current")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    return spark.read.schema(POINTER).json(f"{base}.current")


def current_number(spark: SparkSession, root: str, name: str) -> int:
    """The number of a replaced table's current version; 0 if there is none."""
    found = _pointers(spark, f"{root.rstrip('/')}/{name}")
    return 0 if found is None else found.agg(F.max("number")).first()[0] or 0


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The version of a replaced table that its newest pointer names, in any session."""
    base = f"{root.rstrip('/')}/{name}"
    newest = spark.read.schema(POINTER).json(f"{base}.current").orderBy(F.desc("number")).first()
    schema = T.StructType.fromJson(json.loads(newest["schema"]))
    return spark.read.schema(schema).parquet(f"{base}.versions/{newest['version']}")
