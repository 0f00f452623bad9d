"""Reports kept up to date by months: equal to a full run, and only changed months are read."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from parcelsight.operators import olap, standing
from parcelsight.sources import readers, writers

CITIES = "city_id int, city string"


def facts_frame(spark, rows):
    columns = (
        "delivery_id long, time_id int, city_id int, agent_id string, traffic_level string,"
        " weather string, delivery_time_min double, delayed_flag int"
    )
    return spark.createDataFrame(rows, columns).withColumn(
        "month_id", (F.col("time_id") / 100).cast("int")
    )


def some(first, count, months):
    return [
        (
            i, months[i % len(months)] * 100 + 1 + i % 28 if months[i % len(months)] else None, i % 4,
            f"a{i % 5}", ["High", "Low", None][i % 3], ["Clear", "Rainy"][i % 2],
            None if i % 11 == 0 else float(i % 37), None if i % 13 == 0 else i % 2,
        )
        for i in range(first, first + count)
    ]


def reports(spark, parts, cities):
    """All reports from a function that gives the parts of one of them."""
    places = parts("places").join(cities, "city_id")
    cells = parts("cells").join(cities, "city_id")
    frames = {
        "daily": olap.daily_orders(
            parts("days"),
            parts("days").select("time_id").distinct().withColumn("order_date", F.col("time_id")),
        ),
        "city": olap.drill(places, "city"),
        "rollup": olap.hierarchy_rollup(places, ["city", "agent_id"]),
        "cube": olap.dimension_cube(cells, ["city", "traffic_level", "weather"]),
    }
    return {
        name: sorted(
            (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in f.collect()),
            key=str,
        )
        for name, f in frames.items()
    }


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "facts"), str(tmp_path / "parts")


def check(spark, facts, parts):
    cities = spark.createDataFrame([(i, f"c{i}") for i in range(4)], CITIES)
    whole = readers.read_stage(spark, facts)
    kept = reports(spark, lambda n: standing.parts_of(spark, parts, n), cities)
    full = reports(
        spark, lambda n: olap.measure_parts(whole, list(standing.REPORTS[n])), cities
    )
    assert kept == full
    assert sum(n for _, n in kept["daily"]) == whole.where("time_id IS NOT NULL").count()


def months_of(done):
    assert len({tuple(v) for v in done.values()}) == 1
    return done["days"]


def test_reports_follow_appended_replaced_and_removed_months(spark, place):
    facts, parts = place
    writers.write_stage(facts_frame(spark, some(0, 300, [202401, 202402, None])), facts, ("month_id",))
    assert months_of(standing.refresh(spark, facts, parts)) == [None, 202401, 202402]
    check(spark, facts, parts)
    assert months_of(standing.refresh(spark, facts, parts)) == []
    # A new day in an old month, and a new month.
    writers.append_stage(facts_frame(spark, some(300, 40, [202402, 202403])), facts, "month_id")
    assert months_of(standing.refresh(spark, facts, parts)) == [202402, 202403]
    check(spark, facts, parts)
    # A corrected month, and late rows without a date.
    writers.replace_folders(facts_frame(spark, some(500, 25, [202401])), facts, "month_id")
    writers.append_stage(facts_frame(spark, some(600, 5, [None])), facts, "month_id")
    assert months_of(standing.refresh(spark, facts, parts)) == [None, 202401]
    check(spark, facts, parts)
    writers.remove(spark, f"{facts}/month_id=202402")
    assert months_of(standing.refresh(spark, facts, parts)) == []
    check(spark, facts, parts)


def test_a_refresh_reads_changed_months_only(spark, place):
    facts, _ = place
    writers.write_stage(facts_frame(spark, some(0, 90, [202401, 202402, None])), facts, ("month_id",))
    for file in Path(facts).glob("month_id=*/*.parquet"):
        if "202402" not in str(file):
            file.write_bytes(b"not to be read")
    read = standing.facts_of(spark, facts, [202402])
    summed = olap.measure_parts(read, ["month_id", "time_id"])
    assert summed.agg(F.sum("row_count")).first()[0] == 30
    with pytest.raises(Exception):
        readers.read_stage(spark, facts).agg(F.sum("delayed_flag")).collect()
    # Fact files are listed, their content is not read.
    marks = standing.month_marks(spark, facts)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in marks.split("ReadSchema: ")[1].split(">")[0]


def test_a_run_that_failed_is_finished_by_the_next(spark, place):
    facts, parts = place
    writers.write_stage(facts_frame(spark, some(0, 60, [202401, 202402])), facts, ("month_id",))
    standing.refresh(spark, facts, parts, {"days": standing.REPORTS["days"]})
    done = standing.refresh(spark, facts, parts)
    assert done["days"] == [] and done["cells"] == done["places"] == [202401, 202402]
    check(spark, facts, parts)


def test_empty_facts(spark, place):
    facts, parts = place
    rows = facts_frame(spark, some(0, 10, [202401]))
    writers.write_stage(rows, facts, ("month_id",))
    writers.remove(spark, f"{facts}/month_id=202401")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        standing.refresh(spark, facts, parts)


def test_the_second_of_two_writers_fails(spark, tmp_path):
    root = str(tmp_path)
    writers.replace_table(spark.range(5).toDF("v"), root, "numbers")
    seen = readers.current_number(spark, root, "numbers")
    rows = readers.read_current(spark, root, "numbers")
    assert seen == 1
    writers.replace_table(rows.where("v > 1"), root, "numbers", based_on=seen)
    with pytest.raises(RuntimeError, match="another writer"):
        writers.replace_table(rows.where("v > 2"), root, "numbers", based_on=seen)
    assert readers.read_current(spark, root, "numbers").count() == 3
    assert readers.current_number(spark, root, "numbers") == 2
    # A writer that took the number and died before its pointer was complete.
    (tmp_path / "numbers.current" / "000000000003.json").touch()
    with pytest.raises(RuntimeError, match="has taken version 3"):
        writers.replace_table(rows, root, "numbers")
    assert readers.read_current(spark, root, "numbers").count() == 3
