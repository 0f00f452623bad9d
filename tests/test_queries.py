"""Every registered query on the smallest tables, against its SQL twin where it has one."""

import duckdb
import oracle
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from parcelsight.plans.registry import QUERIES

FOLDER = entry.FLAGSHIP_DATA


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert oracle.compare(spark, duck, name, FOLDER) == []


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry_has_rows(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {
        "city", "traffic_level", "avg_delivery_time", "delay_rate",
    }


def test_comparison_notices_differences(spark, duck, monkeypatch):
    """The check itself must fail on a wrong value, a lost row and a wrong type."""
    right = QUERIES["city_traffic_delays"].build
    make = entry.queries()["city_traffic_delays"]
    assert right is not None

    def altered(change):
        monkeypatch.setattr(
            entry, "queries", lambda: {"city_traffic_delays": lambda s, f: change(make(s, f))}
        )
        return oracle.compare(spark, duck, "city_traffic_delays", FOLDER)

    assert altered(lambda df: df) == []
    assert altered(lambda df: df.withColumn("delay_rate", F.col("delay_rate") + 1e-9))
    assert altered(lambda df: df.limit(3))
    assert altered(lambda df: df.withColumn("delay_rate", F.col("delay_rate").cast("float")))
    assert altered(lambda df: df.withColumnRenamed("city", "town"))


def test_sql_twins_name_only_given_tables():
    con = duckdb.connect()
    for name, sql in entry.oracle_sql().items():
        assert con.extract_statements(sql), name
