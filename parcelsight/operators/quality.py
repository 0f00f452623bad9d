"""Input gates, schema conformance and the warehouse summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def require_path(spark: SparkSession, path: str) -> DataFrame:
    """Open a stored table or stop with a plain message if it is missing."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        raise FileNotFoundError(f"input not found: {path}; run the earlier stage first") from missing


def require_rows(df: DataFrame, at_least: int = 1, what: str = "input") -> DataFrame:
    """Pass ``df`` on, or stop if it has fewer rows; reads no more than it has to."""
    found = df.limit(at_least).count()
    if found < at_least:
        raise ValueError(f"{what} has {found} rows, need at least {at_least}")
    return df


def conform(
    df: DataFrame,
    wanted: Sequence[str],
    lookups: Mapping[str, tuple[DataFrame, str]] | None = None,
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Add the wanted columns a frame lacks and keep them all in the wanted order.

    A missing column comes from a lookup table (table, key) when the frame has the key,
    else from its default. A column with neither is an error: values are never made up.
    """
    lookups, defaults = lookups or {}, defaults or {}
    for name in wanted:
        if name in df.columns:
            continue
        table, key = lookups.get(name, (None, None))
        if table is not None and key in df.columns:
            df = df.join(table.select(key, name), key, "left")
        elif name in defaults:
            default = defaults[name]
            df = df.withColumn(name, default if isinstance(default, Column) else F.lit(default))
        else:
            raise ValueError(f"column {name} is missing and has neither lookup nor default")
    return df.select(*wanted)


def warehouse_summary(tables: Mapping[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """Row count and mean of one measure per table: (table_name, total, average)."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("total"),
            (F.avg(measure) if measure else F.lit(None).cast("double")).alias("average"),
        ).select(F.lit(name).alias("table_name"), "total", "average")
        for name, (df, measure) in tables.items()
    ]
    summary = parts[0]
    for part in parts[1:]:
        summary = summary.unionByName(part)
    return summary
