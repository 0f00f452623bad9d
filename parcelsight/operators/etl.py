"""Cleaning of raw reviews and deliveries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelsight.functions.columns import (
    cut_right,
    days_before,
    is_yes,
    to_number,
    uniform,
)
from parcelsight.operators.numbering import dense_ids

# Order dates are spread over this many days up to the reference date.
DATE_SPREAD = 61
REQUIRED = ("review_id", "order_date", "rating", "city")


def spread_dates(df: DataFrame, key: str, reference_date: str) -> DataFrame:
    """Add an order date 0 to 60 days before the reference date, fixed by the row key."""
    days = F.floor(uniform([key], "order_date") * DATE_SPREAD).cast("int")
    return df.withColumn("order_date", days_before(reference_date, days))


def clean_fields(raw: DataFrame) -> DataFrame:
    """Typed review fields next to the raw columns; unreadable numbers become NULL."""
    return raw.withColumns(
        {
            "rating": to_number("Rating"),
            "order_accuracy": to_number("Order Accuracy"),
            "product_availability": to_number("Product Availability"),
            "discount_applied": is_yes("Discount Applied"),
            "price_range": F.col("Price Range").cast("string"),
            "city": F.col("Location").cast("string"),
            "agent_name": F.col("Agent Name").cast("string"),
            "agent_id": F.col("Agent Name").cast("string"),
            "review_text": F.col("Review Text").cast("string"),
        }
    )


def complete(df: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """Rows in which every required field is known."""
    return df.na.drop("any", subset=list(required))


def clean_reviews(
    raw: DataFrame, order_by: Sequence[str], reference_date: str, unique: bool = False
) -> DataFrame:
    """Raw review rows to cleaned reviews: number, date, type, then drop incomplete rows.

    Ids are given before incomplete rows are dropped, so a dropped row leaves a gap. Column
    names ignore case in Spark: the typed ``rating`` takes the place of the raw ``Rating``.
    ``unique`` promises that ``order_by`` identifies a row, which spares a pass over the texts.
    """
    typed = clean_fields(dense_ids(raw, order_by, "review_id", unique=unique))
    return complete(spread_dates(typed, "review_id", reference_date))


def delay_flags(deliveries: DataFrame) -> DataFrame:
    """delayed_flag = 1 when the delivery took longer than agreed; NULL if unknown.

    The producing step is not documented; the rule is inferred from the columns.
    """
    return deliveries.withColumn(
        "delayed_flag", (F.col("delivery_time_min") > F.col("sla_min")).cast("int")
    )


def traffic_levels(
    deliveries: DataFrame, measure: str = "traffic_density_index", breaks=(1 / 3, 2 / 3)
) -> DataFrame:
    """Low, Medium or High traffic by thirds of a density in [0, 1] (inferred rule)."""
    return deliveries.withColumn("traffic_level", cut_right(measure, breaks, ("Low", "Medium", "High")))
