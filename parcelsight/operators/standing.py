"""Reports that follow the facts: additive parts stored per month, renewed where a month changed.

Facts lie in month folders. Each report keeps its parts (sums and counts per key) in folders of the
same months, and with them a mark of the fact files that they were summed from. A refresh lists
the fact files, compares marks, and reads the facts of those months only whose files are others
now; the reports are merged from the parts of all months, which are few.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelsight.operators.olap import measure_parts
from parcelsight.sources.readers import read_stage
from parcelsight.sources.scratch import staged
from parcelsight.sources.writers import remove, replace_folders, stored

MONTH, MARK = "month_id", "_mark"
#: Keys of the parts that each kind of report is merged from.
REPORTS = {
    "days": ("time_id", "city_id"),
    "places": ("city_id", "agent_id"),
    "cells": ("city_id", "traffic_level", "weather"),
}


def month_marks(spark: SparkSession, facts: str) -> DataFrame:
    """A mark of the files of every month folder: one that differs when a file was added, taken
    away or written anew. Only the listing is read, not the files."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("basePath", facts)
        .load(f"{facts}/{MONTH}=*")
    )
    mark = F.bit_xor(F.xxhash64("path", "length", "modificationTime"))
    return files.groupBy(F.col(MONTH).cast("int").alias(MONTH)).agg(
        F.xxhash64(mark, F.count(F.lit(1))).alias(MARK)
    )


def _marks(frame: DataFrame) -> dict[int | None, int]:
    # One row for each month.
    return {r[MONTH]: r[MARK] for r in frame.collect()}


def facts_of(spark: SparkSession, facts: str, months: Sequence[int | None]) -> DataFrame:
    """The facts of some months; no other folder is read."""
    known = [m for m in months if m is not None]
    wanted = F.col(MONTH).isin(known) if known else F.lit(False)
    if None in months:
        wanted = wanted | F.col(MONTH).isNull()
    return read_stage(spark, facts).where(wanted)


def refresh(
    spark: SparkSession,
    facts: str,
    root: str,
    reports: Mapping[str, Sequence[str]] = REPORTS,
) -> dict[str, list[int | None]]:
    """Bring the stored parts of every report up to date; the months that were summed anew.

    ``facts`` is a stage partitioned by ``month_id`` (rows without a date have a folder of their
    own). A month's parts and its mark are replaced together, so a run that fails leaves months
    either as they were or renewed, and the next one does the rest. Months whose folder is gone,
    or has no row any more, lose their parts. Facts must not be written meanwhile: files that
    appear after the listing are found by the next refresh.
    """
    now = _marks(staged(month_marks(spark, facts), "month-marks"))
    done = {}
    for name, keys in reports.items():
        path = f"{root.rstrip('/')}/{name}"
        before = {}
        if stored(spark, path):
            before = _marks(read_stage(spark, path).select(MONTH, MARK).distinct())
        changed = [m for m, mark in now.items() if before.get(m) != mark]
        if changed or not stored(spark, path):
            known = staged(
                spark.createDataFrame([(m, now[m]) for m in changed], f"{MONTH} int, {MARK} long"),
                "changed-months",
            )
            parts = measure_parts(facts_of(spark, facts, changed), [MONTH, *keys])
            # A month has one mark, so the join on months is one with a table of few rows.
            marked = parts.join(known, parts[MONTH].eqNullSafe(known[MONTH])).drop(known[MONTH])
            replace_folders(marked, path, MONTH)
        after = _marks(read_stage(spark, path).select(MONTH, MARK).distinct())
        for month in after:
            if after[month] != now.get(month):
                folder = "__HIVE_DEFAULT_PARTITION__" if month is None else month
                remove(spark, f"{path}/{MONTH}={folder}")
        done[name] = sorted(changed, key=lambda m: (m is not None, m))
    return done


def parts_of(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The stored parts of a report over all months, as ``olap`` takes them."""
    return read_stage(spark, f"{root.rstrip('/')}/{name}").drop(MARK)
