"""Reproducible enrichment: every drawn value is a function of the row key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelsight.functions.columns import case_when, col, if_else, uniform

# Value ranges, shares and phrases of the enrichment: fixed values.
RANGES = {
    "order_value": (5.0, 100.0, 2),
    "agent_experience_years": (0.5, 5.0, 1),
    "traffic_density_index": (0.0, 1.0, 2),
}
JITTER = (0.9, 1.2)
SEVERITY = {"Clear": (0.0, 3.0), "Rainy": (4.0, 7.0), "Stormy": (8.0, 10.0)}
OTHER_SEVERITY = (0.0, 5.0)
COMPLAINT_ABOVE = 0.4
SOURCES = {"Web": 0.2, "Android": 0.4, "iOS": 0.4}
PHRASES = (
    "The delivery was fast!",
    "Driver was polite",
    "Food was cold",
    "Great service",
    "Awful delay",
    "Highly recommend",
)


def within(u: Column, low: float, high: float) -> Column:
    """Stretch a number in [0, 1) to [low, high)."""
    return F.lit(low) + F.lit(high - low) * u


def uniform_feature(keys: Sequence[str], salt: str, low: float, high: float, digits: int) -> Column:
    return F.round(within(uniform(keys, salt), low, high), digits)


def jittered(value: str | Column, keys: Sequence[str], salt: str = "actual_distance") -> Column:
    return col(value) * within(uniform(keys, salt), *JITTER)


def severity(
    category: str | Column,
    keys: Sequence[str],
    ranges: Mapping[str, tuple[float, float]] = SEVERITY,
    salt: str = "weather_severity",
) -> Column:
    """Number from the range of a category; other and missing categories share a range."""
    u = uniform(keys, salt)
    cases = [(col(category) == F.lit(k), within(u, *r)) for k, r in ranges.items()]
    return case_when(cases, within(u, *OTHER_SEVERITY))


def complaint(delayed: str | Column, keys: Sequence[str], salt: str = "complaint") -> Column:
    """1 for a delayed delivery with a high draw, else 0; NULL if the flag decides and is unknown."""
    upset = (col(delayed) == 1) & (uniform(keys, salt) > COMPLAINT_ABOVE)
    return if_else(upset, F.lit(1), F.lit(0))


def weighted_choice(
    keys: Sequence[str], weights: Mapping[str, float] = SOURCES, salt: str = "source"
) -> Column:
    """One of the values, each with its share of the rows."""
    u, reached, cases = uniform(keys, salt), 0.0, []
    *names, last = weights
    for name in names:
        reached += weights[name]
        cases.append((u < F.lit(reached), F.lit(name)))
    return case_when(cases, F.lit(last))


def with_phrase(
    text: str | Column,
    keys: Sequence[str],
    phrases: Sequence[str] = PHRASES,
    salt: str = "phrase",
) -> Column:
    """Text and one of the phrases; a missing text leaves the phrase alone."""
    pick = F.floor(uniform(keys, salt) * len(phrases)).cast("int") + 1
    return F.concat_ws(" ", col(text), F.element_at(F.array(*map(F.lit, phrases)), pick))


def enrich_deliveries(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Order value, experience, traffic density, actual distance, severity, complaint."""
    added = {
        name: uniform_feature(keys, name, low, high, digits)
        for name, (low, high, digits) in RANGES.items()
    }
    added["actual_distance"] = jittered("distance_km", keys)
    added["weather_severity"] = severity("weather", keys)
    added["customer_complaint"] = complaint("delayed_flag", keys)
    return facts.withColumns(added)


def enrich_reviews(reviews: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Review source and a phrase appended to the text."""
    return reviews.withColumns(
        {"source": weighted_choice(keys), "review_text": with_phrase("review_text", keys)}
    )
