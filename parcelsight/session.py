"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Without a number of shuffle partitions (on a cluster), shuffles start with so many that a
# partition of 100 TB is a few GB; the adaptive engine joins them to ones of a useful size.
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
FIRST_PARTITIONS = "20000"
SETTINGS = {
    # Re-plan at run time: coalesce small shuffles, split skewed join partitions,
    # turn a join into a broadcast once the real size of a side is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app_name: str = "parcelsight",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """Session with the settings above; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    else:
        builder = builder.config(INITIAL_PARTITIONS, FIRST_PARTITIONS)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
