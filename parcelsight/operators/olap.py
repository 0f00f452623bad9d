"""Star joins, grouped measures, roll-up, cube, slices and key figures.

Grouped measures are additive parts first (sums and counts per key), merged after the
dimension lookup: the big fact table is reduced on its own keys, map-side, and only the
reduced rows meet the dimension. A hot key therefore costs one row per map task. No join
is hinted: a dimension read from files has a known size, and Catalyst broadcasts it only
when that size is under the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelsight.functions.columns import date_id, percent, ratio

PART_COLUMNS = ("time_sum", "time_count", "delayed_sum", "row_count")
METRICS = ("delivery_time_min", "order_value", "distance_km")
LEVELS = ("region", "city", "agent_name")


def measure_parts(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Additive parts of mean delivery time and delay rate per key.

    A frame that already holds parts, by finer or other keys, is summed up further.
    """
    if set(PART_COLUMNS) <= set(facts.columns):
        return facts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in PART_COLUMNS])
    return facts.groupBy(*keys).agg(
        F.sum("delivery_time_min").alias("time_sum"),
        F.count("delivery_time_min").alias("time_count"),
        F.sum("delayed_flag").alias("delayed_sum"),
        F.count(F.lit(1)).alias("row_count"),
    )


def merged_measures() -> list[Column]:
    """Measures from parts. Rows with an unknown flag stay in the denominator."""
    return [
        ratio(F.sum("time_sum"), F.sum("time_count")).alias("avg_delivery_time"),
        ratio(F.sum("delayed_sum"), F.sum("row_count")).alias("delay_rate"),
    ]


def city_traffic(facts: DataFrame, dim_city: DataFrame) -> DataFrame:
    """Mean delivery time and delay rate by city and traffic level."""
    parts = measure_parts(facts, ["city_id", "traffic_level"])
    named = parts.join(dim_city.select("city_id", "city"), "city_id")
    return named.groupBy("city", "traffic_level").agg(*merged_measures())


def city_month(facts: DataFrame, dim_city: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Mean delivery time and delay rate by city, year and month."""
    parts = measure_parts(facts, ["city_id", "time_id"])
    named = parts.join(dim_city.select("city_id", "city"), "city_id").join(
        dim_time.select("time_id", "year", "month"), "time_id"
    )
    return named.groupBy("city", "year", "month").agg(*merged_measures())


def star_frame(
    facts: DataFrame,
    dim_time: DataFrame | None = None,
    dim_city: DataFrame | None = None,
    dim_agent: DataFrame | None = None,
) -> DataFrame:
    """Deliveries with date, city and agent name from the given dimensions.

    Date and city must be known, the agent need not be. A dimension nobody asks for is
    left out, which spares its join.
    """
    frame, added = facts, []
    if dim_time is not None:
        frame = frame.join(dim_time.select("time_id", "order_date"), "time_id")
        added.append("order_date")
    if dim_city is not None:
        frame = frame.join(dim_city.select("city_id", "city"), "city_id")
        added.append("city")
    if dim_agent is not None:
        frame = frame.join(dim_agent.select("agent_id", "agent_name"), "agent_id", "left")
        added.append("agent_name")
    return frame.select(*facts.columns, *added)


def agent_performance(dim_agent: DataFrame, deliveries: DataFrame, reviews: DataFrame) -> DataFrame:
    """Mean time, delay rate and mean rating per agent that has deliveries.

    ``deliveries`` may be rows or their parts.

    Joining an agent's deliveries with its reviews first would multiply their numbers.
    Each side is reduced to one row per agent instead; the means are the same.
    """
    work = measure_parts(deliveries, ["agent_id"])
    rated = reviews.groupBy("agent_key").agg(
        F.sum("rating").alias("rating_sum"), F.count("rating").alias("rating_count")
    )
    return (
        dim_agent.select("agent_key", "agent_id", "agent_name")
        .join(work, "agent_id")
        .join(rated, "agent_key", "left")
        .select(
            "agent_key",
            "agent_id",
            "agent_name",
            ratio(F.col("time_sum"), F.col("time_count")).alias("avg_delivery_time"),
            ratio(F.col("delayed_sum"), F.col("row_count")).alias("delay_rate"),
            ratio(F.col("rating_sum"), F.col("rating_count")).alias("avg_rating"),
        )
    )


def dice(
    frame: DataFrame,
    cities: Sequence[str] | None,
    start: date | str,
    end: date | str,
    dated_ids: bool = False,
) -> DataFrame:
    """Rows of the chosen cities (None: all) within an inclusive date range.

    ``dated_ids`` tells that time_id is yyyymmdd: the range then also filters the fact
    table itself, before any join.
    """
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    inside = F.col("order_date").between(first, last)
    if dated_ids:
        inside = inside & F.col("time_id").between(date_id(first), date_id(last))
    return frame.filter(inside if cities is None else inside & F.col("city").isin(list(cities)))


def chosen(name: str, allowed: Sequence[str]) -> str:
    """A column name picked at run time, checked against what may be picked."""
    if name not in allowed:
        raise ValueError(f"{name} is not one of {', '.join(allowed)}")
    return name


def slice_and_pick(frame: DataFrame, traffic_levels: Sequence[str], metric: str) -> DataFrame:
    """Date, city and one picked metric of the rows with the chosen traffic levels."""
    metric = chosen(metric, METRICS)
    return frame.filter(F.col("traffic_level").isin(list(traffic_levels))).select(
        "order_date", "city", "traffic_level", F.col(metric).alias("picked")
    )


def drill(frame: DataFrame, level: str) -> DataFrame:
    """Mean delivery time at one level of the hierarchy, from rows or their parts."""
    level = chosen(level, LEVELS)
    mean = ratio(F.col("time_sum"), F.col("time_count"))
    return measure_parts(frame, [level]).select(
        F.col(level).alias("label"), mean.alias("avg_delivery_time")
    )


def _levels_of(parts: DataFrame, grouped, dims: Sequence[str]) -> DataFrame:
    return grouped.agg(
        F.grouping_id(*dims).cast("bigint").alias("level_id"),
        F.sum("row_count").alias("deliveries"),
        *merged_measures(),
    )


def hierarchy_rollup(parts: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Measures at every prefix of a hierarchy, from parts per finest level."""
    return _levels_of(parts, parts.rollup(*dims), dims)


def dimension_cube(parts: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Measures for every combination of dimensions, from parts per finest cell."""
    return _levels_of(parts, parts.cube(*dims), dims)


def daily_orders(facts: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Orders per calendar day, from rows or their parts."""
    counted = F.sum("row_count") if "row_count" in facts.columns else F.count(F.lit(1))
    per_id = facts.groupBy("time_id").agg(counted.alias("orders"))
    return (
        per_id.join(dim_time.select("time_id", "order_date"), "time_id")
        .groupBy("order_date")
        .agg(F.sum("orders").alias("orders"))
    )


def key_figures(frame: DataFrame) -> DataFrame:
    """One row: orders, delay rate and complaint rate in percent. NULL flags are skipped."""
    return frame.agg(
        F.count(F.lit(1)).alias("orders"),
        percent(F.avg("delayed_flag")).alias("delay_pct"),
        percent(F.avg("customer_complaint")).alias("complaint_pct"),
    )


def average_rating(reviews: DataFrame) -> DataFrame:
    """Mean rating of the (filtered) reviews to one digit, and how many were rated."""
    return reviews.agg(
        F.round(F.avg("rating"), 1).alias("avg_rating"), F.count("rating").alias("rated")
    )


def global_measure(facts: DataFrame, measure: str, total: str, average: str) -> DataFrame:
    """Row count and mean of one measure over a whole table."""
    return facts.agg(F.count(F.lit(1)).alias(total), F.avg(measure).alias(average))


def source_summary(reviews: DataFrame) -> DataFrame:
    """Mean rating and number of reviews per source."""
    return reviews.groupBy("source").agg(
        F.avg("rating").alias("avg_rating"), F.count(F.lit(1)).alias("reviews")
    )


def count_by(frame: DataFrame, *columns: str) -> DataFrame:
    """Rows per value combination."""
    return frame.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def volume_by(frame: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Summed volume per key combination."""
    return frame.groupBy(*keys).agg(F.sum(value).alias("volume"))


def choices(frame: DataFrame, column: str) -> DataFrame:
    """Distinct values a filter can offer."""
    return frame.select(column).distinct()


def keep_known(frame: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Those of the wanted columns the frame has, in the wanted order."""
    return frame.select(*[c for c in wanted if c in frame.columns])


def natural_left_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on all columns the two frames share."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the frames share no column")
    return left.join(right, shared, "left")


def executive_summary(
    facts: DataFrame, accuracies: DataFrame, outliers: DataFrame
) -> DataFrame:
    """One row: records, mean model accuracy, number of outliers."""
    return facts.agg(F.count(F.lit(1)).alias("total_records")).select(
        "total_records",
        accuracies.agg(F.avg("accuracy").alias("a")).scalar().alias("avg_accuracy"),
        outliers.agg(F.count(F.lit(1)).alias("n")).scalar().alias("outlier_count"),
    )
