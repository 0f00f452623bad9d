"""Star schema from raw deliveries and cleaned reviews.

The step that builds the warehouse is known by its result only: the keys are given in
lexical (agents, cities) and calendar order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelsight.functions.columns import date_id
from parcelsight.operators.numbering import dense_ids, level_table


def date_parts(day: Column) -> dict[str, Column]:
    return {
        "time_id": date_id(day),
        "order_date": day,
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "year_month": F.date_format(day, "yyyy-MM"),
        "weekday": F.date_format(day, "EEEE"),
    }


def time_dimension(*frames: DataFrame, column: str = "order_date") -> DataFrame:
    """One row per calendar day that occurs in any of the frames."""
    days = frames[0].select(column)
    for frame in frames[1:]:
        days = days.unionByName(frame.select(column))
    days = days.filter(F.col(column).isNotNull()).distinct()
    return days.select(*[c.alias(n) for n, c in date_parts(F.col(column)).items()])


def _all_values(column: str, *frames: DataFrame) -> DataFrame:
    values = frames[0].select(column).distinct()
    for frame in frames[1:]:
        values = values.unionByName(frame.select(column).distinct())
    return values


def city_dimension(*frames: DataFrame) -> DataFrame:
    """Cities with a surrogate key in lexical order."""
    levels = level_table(_all_values("city", *frames), "city", "city_id")
    return levels.select(F.col("city_id").cast("int").alias("city_id"), "city")


def agent_dimension(*frames: DataFrame) -> DataFrame:
    """Agents with a surrogate key in lexical order; the name is the natural key too."""
    levels = level_table(_all_values("agent_name", *frames), "agent_name", "agent_key")
    return levels.select(
        F.col("agent_key").cast("int").alias("agent_key"),
        F.col("agent_name").alias("agent_id"),
        "agent_name",
    )


def delivery_facts(
    raw: DataFrame, dim_city: DataFrame, order_by: list[str], keep: list[str]
) -> DataFrame:
    """Deliveries with an id, a date key, a city key and the natural agent key; one without a
    city stays, with a missing key."""
    numbered = dense_ids(raw, order_by, "delivery_id")
    return numbered.join(dim_city, "city", "left").select(
        "delivery_id",
        date_id(F.col("order_date")).alias("time_id"),
        "city_id",
        F.col("agent_name").alias("agent_id"),
        *keep,
    )


def review_facts(
    cleaned: DataFrame, dim_city: DataFrame, dim_agent: DataFrame, keep: list[str]
) -> DataFrame:
    """Reviews with date, city and surrogate agent keys; an unknown city or agent stays NULL."""
    agents = dim_agent.select("agent_key", "agent_name")
    return (
        cleaned.join(dim_city, "city", "left")
        .join(agents, "agent_name", "left")
        .select(
            "review_id",
            date_id(F.col("order_date")).alias("time_id"),
            "city_id",
            "agent_key",
            *keep,
        )
    )
