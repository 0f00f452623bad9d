"""Column expressions with the missing-value rules of the delivery workflow."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a yes in the raw discount column: fixed values.
YES_WORDS = ("yes", "1", "true")


def col(c: str | Column) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def to_number(c: str | Column) -> Column:
    """Text to double; anything that is not a number becomes NULL.

    The JVM also parses a trailing type letter ("3f", "1d"): not a number here.
    """
    text = col(c).cast("string")
    return F.when(text.rlike(r"[0-9.][dDfF]\s*$"), F.lit(None)).otherwise(text.try_cast("double"))


def to_day(c: str | Column) -> Column:
    """Text, date or timestamp to a date; unreadable text becomes NULL."""
    return col(c).try_cast("date")


def is_yes(c: str | Column) -> Column:
    """1 for a spelling of yes, else 0; a missing value is not a yes."""
    said = F.lower(col(c).cast("string")).isin(*YES_WORDS)
    return F.coalesce(said, F.lit(False)).cast("int")


def if_else(condition: Column, then: Column, other: Column) -> Column:
    """Two-way choice; an unknown condition gives NULL instead of ``other``."""
    return F.when(condition, then).when(~condition, other)


def case_when(cases: Sequence[tuple[Column, Column]], default: Column) -> Column:
    """First case that holds; an unknown condition counts as not holding."""
    first, *rest = cases
    return reduce(lambda acc, c: acc.when(*c), rest, F.when(*first)).otherwise(default)


def cut_right(c: str | Column, breaks: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (lower, upper] a value falls in; the last one is open."""
    if len(labels) != len(breaks) + 1:
        raise ValueError("need one label more than inner breaks")
    value = col(c)
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    for upper, label in zip(breaks, labels):
        chain = chain.when(value <= F.lit(float(upper)), F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def at_least(c: str | Column, threshold: float, high: str, low: str) -> Column:
    """Two labels split at a threshold; NULL gets the low label, as in SQL CASE ... ELSE."""
    return F.when(col(c) >= F.lit(threshold), F.lit(high)).otherwise(F.lit(low))


def floor_at_zero(c: str | Column) -> Column:
    """Negative values become 0; NULL stays NULL."""
    value = col(c)
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def recode(c: str | Column, mapping: dict) -> Column:
    """Map listed values to labels; any other value becomes NULL."""
    value = col(c)
    return reduce(
        lambda acc, kv: acc.when(value == F.lit(kv[0]), F.lit(kv[1])),
        list(mapping.items())[1:],
        F.when(value == F.lit(next(iter(mapping))), F.lit(next(iter(mapping.values())))),
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(c: Column, digits: int = 1) -> Column:
    return F.round(c * F.lit(100.0), digits)


def percent_label(c: Column) -> Column:
    """"43.8%"; a whole number prints without decimals."""
    return F.concat(F.regexp_replace(c.cast("string"), r"\.0$", ""), F.lit("%"))


def days_before(reference: str | Column, days: Column) -> Column:
    """Calendar date a number of days before a reference date."""
    start = F.to_date(F.lit(reference)) if isinstance(reference, str) else reference
    return F.date_sub(start, days)


def date_id(day: Column) -> Column:
    """yyyymmdd as an int."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def uniform(keys: Sequence[str | Column], salt: str) -> Column:
    """Reproducible number in [0, 1) from a row key.

    52 bits of an MD5 digest: it depends on the key only and not on the order or
    partitioning of the rows, so retried and re-partitioned tasks agree.
    """
    digest = F.md5(F.concat_ws("|", *[col(k).cast("string") for k in keys], F.lit(salt)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))
