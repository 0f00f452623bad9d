"""Registration of queries with the survey rows they cover and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelsight.plans.star import DeliveryStar, with_views


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Callable[[DeliveryStar], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a function of the star views; ``sql`` may name the views in ``star``."""

    def register(build: Callable[[DeliveryStar], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, tuple(covers.split()), build, with_views(sql) if sql else None)
        return build

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round columns whose last bits depend on the order of a floating-point sum."""
    return df.withColumns({c: F.round(c, digits) for c in columns})
