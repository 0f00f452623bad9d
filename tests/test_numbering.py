"""Dense ids and exact order statistics against brute force, small limits included."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from parcelsight.operators import numbering


def test_ids_follow_the_key(spark):
    rows = [(k, f"r{k}") for k in random.Random(1).sample(range(10_000), 3_000)]
    df = spark.createDataFrame(rows, "k int, name string").repartition(7)
    got = numbering.dense_ids(df, ["k"], "id", unique=True).collect()
    assert [(r["id"], r["k"]) for r in sorted(got)] == [
        (i + 1, k) for i, k in enumerate(sorted(k for k, _ in rows))
    ]


@pytest.mark.parametrize("block", [100_000, 40])
def test_copies_each_get_an_id(spark, monkeypatch, block):
    """A third of the rows are one row's copies; expansion in blocks changes nothing."""
    monkeypatch.setattr(numbering, "COPIES_PER_TASK", block)
    rows = [(5, "same")] * 500 + [(i % 40, f"x{i % 25}") for i in range(1_000)] + [(None, "n")] * 3
    df = spark.createDataFrame(rows, "k int, name string").repartition(5)
    got = sorted(numbering.dense_ids(df, ["k"], "id", start=0).collect())
    assert [r["id"] for r in got] == list(range(len(rows)))
    order = [(r["k"] is not None, r["k"] or 0, r["name"]) for r in got]
    assert order == sorted(order)
    assert sorted((r["k"] or -1, r["name"]) for r in got) == sorted((k or -1, n) for k, n in rows)


def test_level_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "v string")
    got = numbering.level_codes(df, "v", "code").collect()
    assert sorted((r["v"] or "", r["code"]) for r in got) == [
        ("", None), ("a", 1), ("a", 1), ("b", 2), ("c", 3),
    ]


CASES = {
    "smooth": [random.Random(3).gauss(0, 1) for _ in range(4_001)],
    "even": [random.Random(4).uniform(0, 9) for _ in range(4_000)],
    "one value holds a third": [7.0] * 2_000 + [float(i) for i in range(4_000)],
    "two hot values": [1.0] * 2_000 + [2.0] * 2_000,
    "middle between hot values": [1.0] * 1_500 + [1.5, 1.25] + [2.0] * 1_500,
    "far outliers": [10.0**i for i in range(-150, 150)] + [0.0] * 31,
    "constant": [3.0] * 500,
    "single": [4.5],
}


@pytest.mark.parametrize("small", [50_000, 20])
@pytest.mark.parametrize("case", CASES)
def test_exact_median(spark, case, small):
    data = CASES[case]
    rows = [(v,) for v in data] + [(None,)] * 9
    df = spark.createDataFrame(rows, "v double").repartition(6).cache()
    assert numbering.exact_median(df, "v", small) == statistics.median(data)
    df.unpersist()


def test_median_of_nothing(spark):
    assert numbering.exact_median(spark.createDataFrame([(None,)], "v double"), "v") is None


@pytest.mark.parametrize("buckets", [4_096, 5])
def test_thresholds_per_group(spark, buckets):
    rows = [(g, random.Random(i).random()) for i, g in enumerate("aaab" * 700 + "c")]
    df = spark.createDataFrame(rows, "g string, u double").cache()
    found = numbering.rank_thresholds(df, "g", "u", 0.8, buckets)
    got = {r["g"]: r["threshold"] for r in found.collect()}
    for g, threshold in got.items():
        mine = sorted(u for k, u in rows if k == g)
        assert sum(u <= threshold for u in mine) == -(-len(mine) * 8 // 10)
    assert set(got) == {"a", "b", "c"}
    df.unpersist()


def test_sketch_that_misses_is_widened(spark, monkeypatch):
    """A coarse sketch may bracket the wrong ranks; exact counts notice and look wider."""
    monkeypatch.setattr(numbering, "SKETCH", 3)
    data = [random.Random(9).expovariate(1) for _ in range(3_000)]
    df = spark.createDataFrame([(v,) for v in data], "v double").repartition(6).cache()
    targets = [(F.lit(True), r, len(data)) for r in (0, 17, 1_500, 2_998, 2_999)]
    assert numbering.order_statistics(df, "v", targets, small=10) == [
        sorted(data)[r] for r in (0, 17, 1_500, 2_998, 2_999)
    ]
    df.unpersist()


def test_thresholds_of_drawn_numbers(spark):
    drawn = random.Random(3)
    rows = [(g, drawn.random()) for g in ("a", None) for _ in range(700)] + [("b", 0.25)] * 9 + [("c", 0.999999)]
    df = spark.createDataFrame(rows, "g string, u double").repartition(5)
    for share in (0.8, 0.0, 1.0):
        for buckets in (4, 1 << 16):
            got = {r["g"]: r["threshold"] for r in numbering.drawn_thresholds(df, "g", "u", share, buckets).collect()}
            for g in ("a", "b", "c", None):
                values = sorted(u for name, u in rows if name == g)
                assert got[g] == values[max(1, math.ceil(share * len(values))) - 1]


def test_ids_are_the_line_numbers_of_files_in_many_splits(spark, tmp_path):
    lines, folder = [], tmp_path / "lines"
    folder.mkdir()
    for part in range(4):
        mine = [f"{part},{i},{'x' * (i * 7 % 90)}" for i in range(0 if part == 2 else 900 + 50 * part)]
        lines += mine
        (folder / f"part-{part}.csv").write_text("".join(x + "\n" for x in ["part,i,text", *mine]))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "512")
        df = spark.read.csv(str(folder), header=True, schema="part int, i int, text string")
        assert df.rdd.getNumPartitions() > 20
        got = numbering.file_order_ids(df, "id").collect()
        odd = numbering.file_order_ids(df.where("i % 2 = 1").withColumn("j", F.col("i") + 1), "id", 0).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((r.id, f"{r.part},{r.i},{r.text or ''}") for r in got) == list(enumerate(lines, 1))
    wanted = [x for x in lines if int(x.split(",")[1]) % 2]
    assert sorted((r.id, f"{r.part},{r.i},{r.text or ''}") for r in odd) == list(enumerate(wanted))
    assert all(r.j == r.i + 1 for r in odd)


def test_file_order_needs_no_exchange_of_rows(spark, tmp_path, monkeypatch):
    spark.range(50).withColumn("t", F.lit("x")).write.csv(str(tmp_path / "in"))
    plans = []
    plain = numbering.staged
    monkeypatch.setattr(numbering, "staged", lambda df, n: plans.append(df._jdf.queryExecution().toString()) or plain(df, n))
    out = numbering.file_order_ids(spark.read.csv(str(tmp_path / "in"), schema="k long, t string"))
    assert out.agg(F.min("row_id"), F.max("row_id"), F.count_distinct("row_id")).first()[:] == (1, 50, 50)
    assert "Exchange" not in plans[0] and "Sort" not in plans[0]
    none = numbering.file_order_ids(spark.read.csv(str(tmp_path / "in"), schema="k long, t string").where("k < 0"))
    assert none.count() == 0
