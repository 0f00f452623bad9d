"""Standard scores: delay anomalies and outlier flags.

The producing steps are known by their result only; standard scores with a threshold of 3
are an assumption, and the threshold is a parameter.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def z_scores(
    columns: Sequence[str], population: DataFrame
) -> dict[str, Column]:
    """Standard score per column, with the moments of ``population`` as one scalar subquery."""
    moments = population.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in columns],
            *[F.nullif(F.stddev_samp(c), F.lit(0.0)).alias(f"s_{c}") for c in columns],
        ).alias("moments")
    ).scalar()
    return {c: (F.col(c) - moments[f"m_{c}"]) / moments[f"s_{c}"] for c in columns}


def _with_difference(facts: DataFrame) -> DataFrame:
    return facts.withColumn("delay_diff", F.col("delivery_time_min") - F.col("sla_min"))


def delay_anomalies(
    facts: DataFrame, threshold: float = 3.0, population: DataFrame | None = None
) -> DataFrame:
    """Deliveries whose time over the agreement is unusual.

    ``population`` may give the same deliveries with the two time columns only, so that
    the moments do not repeat the joins the other columns need.
    """
    diffs = _with_difference(facts)
    everyone = diffs if population is None else _with_difference(population)
    scored = diffs.withColumn("z_delay", z_scores(["delay_diff"], everyone)["delay_diff"])
    return scored.filter(F.abs("z_delay") > threshold).select(
        "delivery_id",
        "city_id",
        "distance_km",
        "delivery_time_min",
        "sla_min",
        "delay_diff",
        "z_delay",
    )


def flag_outliers(df: DataFrame, columns: Sequence[str], threshold: float = 3.0) -> DataFrame:
    """Add is_outlier: any of the columns is further than the threshold from its mean."""
    far = [F.abs(z) > threshold for z in z_scores(columns, df).values()]
    either = reduce(lambda a, b: a | b, far)
    return df.withColumn("is_outlier", F.coalesce(either, F.lit(False)))
