"""Files written and read back, table replacement, the shared folder."""

import pytest
from pyspark.sql import functions as F

from parcelsight.operators import etl, quality, warehouse
from parcelsight.sources import readers, scratch, writers
from parcelsight.sources.schemas import DIM_AGENT, DIM_CITY, DIM_TIME, RAW_REVIEW


def _raw(spark, rows):
    filled = [(r + (None,) * 12)[:12] for r in rows]
    return spark.createDataFrame(filled, RAW_REVIEW)


ROWS = [
    ("Ann", "4.5", 'Said "fast",\nthen left', "10", "Pune", "Food", "Good", "Low", "Yes", "5", "4", "3"),
    ("Bo", "x", "ok", "10", "Pune", "Food", "Good", "High", "no", "5", "4", "NA"),
    ("Cy", "2", None, "10", None, "Food", "Good", "Low", None, "5", "4", "3"),
    ("Di", " 3 ", "late", "10", "Goa", "Food", "Good", None, "TRUE", "bad", "4", ""),
]


def test_review_file_and_cleaning(spark, tmp_path):
    path = writers.write_delimited(_raw(spark, ROWS), str(tmp_path / "reviews"))
    raw = readers.read_reviews(spark, path)
    assert raw.schema == RAW_REVIEW and raw.count() == 4
    assert raw.filter(F.col("Agent Name") == "Ann").first()["Review Text"] == ROWS[0][2]
    assert raw.filter(F.col("Agent Name") == "Bo").first()["Order Accuracy"] is None
    clean = etl.clean_reviews(raw, ["Agent Name"], "2024-03-10").orderBy("review_id").collect()
    assert [(r["review_id"], r["agent_id"], r["rating"], r["discount_applied"]) for r in clean] == [
        (1, "Ann", 4.5, 1), (4, "Di", 3.0, 1),
    ]
    assert clean[1]["product_availability"] is None and clean[1]["order_accuracy"] is None
    assert all("2024-01-10" <= str(r["order_date"]) <= "2024-03-10" for r in clean)


def test_text_survives_csv(spark, tmp_path):
    texts = [" lead", "trail ", 'a "q" b', "x,y", "line\nbreak", "back\\slash", "é", "'", '"']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    path = writers.write_delimited(df, str(tmp_path / "t"))
    back = readers.read_delimited(spark, path, df.schema, multiline=True, trim=False)
    assert [r["t"] for r in back.orderBy("i").collect()] == texts


def test_replacing_a_table_that_is_being_read(spark, tmp_path):
    one, _ = writers.replace_table(spark.range(5).toDF("v"), str(tmp_path), "numbers_t")
    two, path = writers.replace_table(one.withColumn("v", F.col("v") + 10), str(tmp_path), "numbers_t")
    assert sorted(r["v"] for r in spark.table("numbers_t").collect()) == list(range(10, 15))
    assert one.count() == two.count() == readers.read_table(spark, path).count() == 5


def test_stage_is_replaced(spark, tmp_path):
    path = str(tmp_path / "stage")
    writers.write_stage(spark.range(5), path)
    writers.write_stage(spark.range(3), path)
    assert readers.read_table(spark, path).count() == 3


def test_staged_tables_go_to_the_shared_folder(spark):
    folder = scratch.shared_folder(spark)
    back = scratch.staged(spark.range(4), "numbers")
    assert back.count() == 4 and back.inputFiles()[0].split(":", 1)[1].lstrip("/").startswith(
        folder.split(":", 1)[-1].lstrip("/")
    )


def test_a_cluster_needs_the_setting(spark, monkeypatch):
    class Context:
        master, applicationId = "yarn", "app"

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default):
            assert key == "spark.checkpoint.dir"
            return self.value

    class Session:
        sparkContext = Context()

    session = Session()
    session.conf = Conf(None)
    with pytest.raises(RuntimeError):
        scratch.shared_folder(session)
    session.conf = Conf("hdfs:///shared/")
    assert scratch.shared_folder(session) == "hdfs:///shared"


def test_conform_prefers_lookup_to_default(spark):
    df = spark.createDataFrame([(1, 2.0), (9, 3.0)], "city_id int, v double")
    cities = spark.createDataFrame([(1, "A")], "city_id int, city string")
    got = quality.conform(
        df, ["city", "v", "w"], {"city": (cities, "city_id")}, {"city": "?", "w": 0}
    )
    assert sorted(map(tuple, got.collect()), key=str) == [("A", 2.0, 0), (None, 3.0, 0)]
    got = quality.conform(df.drop("city_id"), ["city"], {"city": (cities, "city_id")}, {"city": "?"})
    assert {r["city"] for r in got.collect()} == {"?"}


def test_warehouse_from_raw_frames(spark):
    raw = spark.createDataFrame(
        [("k2", "B", "bo", "2024-02-29", 5.0), ("k1", "A", "ann", "2023-12-31", 6.0),
         ("k3", "A", "bo", "2024-02-29", 7.0)],
        "key string, city string, agent_name string, day string, t double",
    ).withColumn("order_date", F.to_date("day"))
    reviews = spark.createDataFrame(
        [(1, "C", "ann"), (2, "A", None)], "review_id long, city string, agent_name string"
    ).withColumn("order_date", F.to_date(F.lit("2024-01-01")))
    cities = warehouse.city_dimension(raw, reviews)
    agents = warehouse.agent_dimension(raw, reviews)
    days = warehouse.time_dimension(raw, reviews)
    assert sorted(map(tuple, cities.collect())) == [(1, "A"), (2, "B"), (3, "C")]
    assert sorted(map(tuple, agents.collect())) == [(1, "ann", "ann"), (2, "bo", "bo")]
    assert [r["weekday"] for r in days.orderBy("time_id").collect()] == [
        "Sunday", "Monday", "Thursday",
    ]
    for frame, schema in ((cities, DIM_CITY), (agents, DIM_AGENT), (days, DIM_TIME)):
        assert dict(frame.dtypes) == {f.name: f.dataType.simpleString() for f in schema}
    facts = warehouse.delivery_facts(raw, cities, ["key"], ["t"])
    assert sorted(map(tuple, facts.collect())) == [
        (1, 20231231, 1, "ann", 6.0), (2, 20240229, 2, "bo", 5.0), (3, 20240229, 1, "bo", 7.0),
    ]
    rated = warehouse.review_facts(reviews, cities, agents, [])
    assert sorted(map(tuple, rated.collect())) == [(1, 20240101, 3, 1), (2, 20240101, 1, None)]


def test_facts_without_a_city_stay(spark):
    raw = spark.createDataFrame(
        [("k1", "A", "ann", 5.0), ("k2", None, "bo", 6.0)], "key string, city string, agent_name string, t double"
    ).withColumn("order_date", F.to_date(F.lit("2024-01-01")))
    cities = warehouse.city_dimension(raw)
    facts = warehouse.delivery_facts(raw, cities, ["key"], ["t"]).collect()
    assert sorted((r["t"], r["city_id"]) for r in facts) == [(5.0, 1), (6.0, None)]
    reviews = raw.withColumn("review_id", F.col("t").cast("long"))
    agents = warehouse.agent_dimension(raw)
    assert warehouse.review_facts(reviews, cities, agents, []).count() == 2


def test_partition_values_keep_type_and_empty_string(spark, tmp_path):
    rows = [("01", 1, 20240101), ("02", 2, 20240102), ("", 3, 20240101), (None, 4, 20240101)]
    df = spark.createDataFrame(rows, "code string, v long, day int")
    path = writers.write_stage(df, str(tmp_path / "stage"), ("code", "day"))
    back = readers.read_stage(spark, path)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    assert [r["v"] for r in back.where("code = ''").collect()] == [3]
    plan = back.where("code = '01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "code" in plan.split("PartitionFilters: [")[1][:80]


def test_other_sessions_find_the_current_version(spark, tmp_path):
    root = str(tmp_path)
    writers.replace_table(spark.range(5).toDF("v"), root, "numbers")
    first = readers.read_current(spark, root, "numbers")
    writers.replace_table(first.where("v > 1"), root, "numbers")
    other = spark.newSession()
    assert readers.read_current(other, root, "numbers").count() == 3
    writers.drop_superseded(spark, root, "numbers")
    assert readers.read_current(other, root, "numbers").count() == 3
    assert len(list((tmp_path / "numbers.versions").iterdir())) == 1


def test_the_run_folder_is_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "shared_folder", lambda s: str(tmp_path))
    scratch.staged(spark.range(3), "numbers")
    assert len(list(tmp_path.iterdir())) == 1
    scratch.release(spark)
    assert list(tmp_path.iterdir()) == []
