"""One small case per rule in which Spark's default differs from the wanted behaviour."""

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from parcelsight.functions import columns as C
from parcelsight.functions.words import words_of
from parcelsight.operators import cluster, enrich, etl, olap, outliers, prep, quality, rules, text


def values(df, *columns):
    return [tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()]


def test_cut_is_right_closed(spark):
    df = spark.createDataFrame(
        [(1, 25.0), (2, 25.01), (3, 60.0), (4, 60.01), (5, None)], "i int, order_value double"
    )
    got = prep.segment_orders(df).orderBy("i")
    assert values(got, "order_segment") == [
        "Low Value", "Medium Value", "Medium Value", "High Value", None,
    ]


def test_mean_skips_null_but_count_does_not(spark):
    df = spark.createDataFrame([("Web", 4.0), ("Web", None)], "source string, rating double")
    assert values(olap.source_summary(df), "source", "avg_rating", "reviews") == [("Web", 4.0, 2)]


def test_null_flag_stays_in_the_denominator(spark):
    facts = spark.createDataFrame(
        [(1, "Low", 10.0, 1), (1, "Low", 20.0, 0), (1, "Low", None, None)],
        "city_id int, traffic_level string, delivery_time_min double, delayed_flag int",
    )
    cities = spark.createDataFrame([(1, "A")], "city_id int, city string")
    [(time, rate)] = values(olap.city_traffic(facts, cities), "avg_delivery_time", "delay_rate")
    assert time == 15.0 and rate == pytest.approx(1 / 3)


def test_null_keys_do_not_match(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "k int, a string")
    b = spark.createDataFrame([(1, "p"), (None, "q")], "k int, b string")
    assert sorted(values(olap.natural_left_join(a, b), "a", "b")) == [("x", "p"), ("y", None)]


def test_unknown_condition_gives_null(spark):
    df = spark.range(1).select(
        C.if_else(F.lit(None).cast("boolean"), F.lit(1), F.lit(0)).alias("v"),
        C.if_else(F.lit(False), F.lit(1), F.lit(0)).alias("w"),
    )
    assert values(df, "v", "w") == [(None, 0)]


def test_complaint_needs_a_known_flag_only_when_it_decides(spark):
    df = spark.range(200).select(
        "id", F.lit(None).cast("int").alias("flag"), C.uniform(["id"], "complaint").alias("u")
    )
    got = df.withColumn("c", enrich.complaint("flag", ["id"])).collect()
    assert {(r["u"] > 0.4, r["c"]) for r in got} == {(True, None), (False, 0)}


def test_discount_words(spark):
    df = spark.createDataFrame([("Yes",), ("TRUE",), ("1",), ("no",), (None,)], "d string")
    assert values(df.select(C.is_yes("d").alias("f")), "f") == [1, 1, 1, 0, 0]


def test_case_sends_null_to_the_low_label(spark):
    df = spark.createDataFrame(
        [(None, 4.0, 1, 4.5), (5.0, None, 0, None)],
        "order_accuracy double, product_availability double, discount_applied int, rating double",
    )
    assert [tuple(r) for r in rules.review_labels(df).collect()] == [
        ("LowAccuracy", "GoodAvailability", "Discount", "HighRating"),
        ("HighAccuracy", "LowAvailability", "NoDiscount", "LowRating"),
    ]


def test_required_fields_drop_rows(spark):
    df = spark.createDataFrame(
        [(1, date(2020, 1, 1), None, "A"), (2, date(2020, 1, 1), 3.0, "A")],
        "review_id long, order_date date, rating double, city string",
    )
    assert values(etl.complete(df), "review_id") == [2]


def test_scaling_divides_by_n_minus_1(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (5.0,)], "x double")
    moments = prep.fit_moments(df, ["x"])
    assert moments.sd[0] == pytest.approx(2.081665999466133, abs=1e-15)
    once = prep.standardize(df, ["x"])
    twice = prep.standardize(once, ["x"])
    assert values(twice, "x") == pytest.approx(values(once, "x"))


def test_constant_column_scales_to_null(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert values(prep.standardize(df, ["x"]), "x") == [None, None]


def test_tf_idf_of_two_small_texts(spark):
    df = spark.createDataFrame([(1, "a a b"), (2, "b")], "review_id int, review_text string")
    scored = text.tf_idf(text.term_counts(df, stop=()))
    got = {(r["review_id"], r["word"]): (r["tf"], r["idf"]) for r in scored.collect()}
    assert got[1, "a"] == (pytest.approx(2 / 3), pytest.approx(math.log(2)))
    assert got[1, "b"] == (pytest.approx(1 / 3), 0.0) and got[2, "b"] == (1.0, 0.0)


def test_documents_without_kept_words_do_not_count(spark):
    df = spark.createDataFrame(
        [(1, "cold food"), (2, "the of"), (3, None), (4, "!!!")],
        "review_id int, review_text string",
    )
    scored = text.tf_idf(text.term_counts(df))
    assert {r["idf"] for r in scored.collect()} == {0.0}


def test_ties_are_in_key_order(spark):
    df = spark.createDataFrame(
        [(2, "b a"), (1, "b a c")], "review_id int, review_text string"
    )
    scored = text.tf_idf(text.term_counts(df, stop=()))
    assert values(text.first_terms(scored, 4), "review_id", "word") == [
        (1, "a"), (1, "b"), (1, "c"), (2, "a"),
    ]
    assert values(text.top_words(text.word_counts(df, stop=()), 2), "word") == ["a", "b"]


def test_missing_text_gives_no_token_and_only_the_phrase(spark):
    df = spark.createDataFrame([(1, None), (2, "ok")], "review_id int, review_text string")
    assert values(text.tokens(df, keep=["review_id"]), "review_id", "word") == [(2, "ok")]
    added = enrich.enrich_reviews(df, ["review_id"]).orderBy("review_id")
    first, second = values(added, "review_text")
    assert first in enrich.PHRASES and second.startswith("ok ")


def test_words(spark):
    df = spark.createDataFrame([("Don't STOP café 3.5 the-end",)], "t string")
    assert df.select(words_of("t").alias("w")).first()["w"] == [
        "don't", "stop", "café", "3.5", "the", "end",
    ]


def test_rounding_is_half_up(spark):
    df = spark.range(1).select(C.percent(F.lit(0.0025), 1).alias("r"), F.round(F.lit(0.25), 1).alias("q"))
    assert values(df, "r", "q") == [(0.3, 0.3)]


def test_percent_label(spark):
    df = spark.createDataFrame([(43.8,), (44.0,), (100.0,)], "p double")
    assert values(df.select(C.percent_label(F.col("p")).alias("l")), "l") == ["43.8%", "44%", "100%"]


def test_word_in_two_classes(spark):
    df = spark.createDataFrame(
        [(1, "fine fine bad"), (2, "odd"), (3, "good odd"), (4, None)],
        "review_id int, review_text string",
    )
    entries = [("fine", "positive"), ("bad", "negative"), ("good", "positive"),
               ("odd", "positive"), ("odd", "negative")]
    frame = spark.createDataFrame(entries, "word string, sentiment string")
    for lexicon in (entries, frame):
        scored = text.sentiment_scores(df, lexicon=lexicon).orderBy("review_id")
        assert values(scored, "sentiment_score") == [1, 0, 1, 0]
    totals = text.sentiment_totals(df, lexicon=entries)
    assert dict(values(totals, "sentiment", "n")) == {"positive": 5, "negative": 3}


def test_long_word_lists_give_the_same_result(spark, monkeypatch):
    df = spark.createDataFrame(
        [(1, "the food was cold and late"), (2, "great fast driver"), (3, "the"), (4, None)],
        "review_id int, review_text string",
    )
    def results():
        return (
            sorted(map(tuple, text.word_counts(df).collect())),
            sorted(map(tuple, text.term_counts(df).collect())),
            sorted(values(text.sentiment_scores(df), "review_id", "sentiment_score")),
            sorted(map(tuple, text.sentiment_totals(df).collect())),
            sorted(map(tuple, text.tokens(df, stop=text.STOP_WORDS).collect())),
        )

    short = results()
    monkeypatch.setattr(text, "LITERAL_WORDS", 3)
    assert results() == short


def test_repeated_review_ids(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a")], "review_id int, review_text string")
    counts = text.term_counts(df, stop=())
    assert sorted(map(tuple, counts.collect())) == [(1, "a", 2, 3), (1, "b", 1, 3)]


def test_the_size_of_a_list_does_not_change_scores_per_id(spark):
    df = spark.createDataFrame(
        [(1, "good fast"), (1, "bad"), (2, "good"), (None, "good"), (None, "fine good")],
        "review_id int, review_text string",
    )
    lexicon = [("good", "positive"), ("fast", "positive"), ("bad", "negative")]
    for method in ("literal", "join", "auto"):
        scored = text.sentiment_scores(df, lexicon=lexicon, method=method)
        assert sorted(values(scored, "review_text", "sentiment_score")) == [
            ("bad", 1), ("fine good", 2), ("good", 1), ("good", 2), ("good fast", 1),
        ]
        counts = text.term_counts(df, stop=["fast"], method=method)
        assert {r["total"] for r in counts.filter("review_id = 1").collect()} == {2}


def test_marks_and_underscores_stay_in_words(spark):
    df = spark.createDataFrame([("हिन्दी foo_bar cafe\u0301 a-b",)], "t string")
    assert df.select(words_of("t").alias("w")).first()["w"] == [
        "हिन्दी", "foo_bar", "cafe\u0301", "a", "b",
    ]


def test_junk_numbers(spark):
    df = spark.createDataFrame(
        [("x",), ("3.5",), (" 4 ",), ("3f",), ("1d",), ("",), (None,), ("1e2",)], "s string"
    )
    assert values(df.select(C.to_number("s").alias("n")), "n") == [
        None, 3.5, 4.0, None, None, None, None, 100.0,
    ]


def test_bad_dates(spark):
    df = spark.createDataFrame([("2024-02-30",), ("2024-02-29",), ("soon",)], "s string")
    assert values(df.select(C.to_day("s").alias("d")), "d") == [None, date(2024, 2, 29), None]


def test_recode_unknown_values(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "c int")
    got = df.select(C.recode("c", prep.COMPLAINT_NAMES).alias("l"))
    assert values(got, "l") == ["No_Complaint", "Complaint", None, None]


def test_agent_without_reviews_is_kept_without_cluster(spark):
    perf = spark.createDataFrame(
        [("a", 1.0, 0.1, 3.0), ("b", 5.0, 0.5, 4.0), ("c", 9.0, 0.9, 5.0), ("d", 2.0, 0.2, None)],
        "agent_id string, avg_delivery_time double, delay_rate double, avg_rating double",
    )
    for got in (cluster.kmeans(perf), cluster.bisecting(perf, name="cluster")):
        found = dict(values(got, "agent_id", "cluster"))
        assert found["d"] is None and len({found["a"], found["b"], found["c"]}) == 3


def test_gates(spark, tmp_path):
    few = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(ValueError):
        quality.require_rows(few, 3)
    with pytest.raises(ValueError):
        quality.require_rows(few.filter("x > 1"))
    assert quality.require_rows(few) is few
    with pytest.raises(FileNotFoundError):
        quality.require_path(spark, str(tmp_path / "nothing"))
    with pytest.raises(ValueError):
        cluster.kmeans(few.selectExpr("x avg_delivery_time", "x delay_rate", "x avg_rating"))
    with pytest.raises(ValueError):
        olap.drill(few, "x")
    with pytest.raises(ValueError):
        olap.slice_and_pick(few, ["Low"], "x")
    with pytest.raises(ValueError):
        quality.conform(few, ["x", "y"])


def test_z_scores_of_a_constant_are_no_outliers(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert values(outliers.flag_outliers(df, ["v"]), "is_outlier") == [False, False]


def test_empty_tables_have_no_division_error(spark):
    empty = spark.createDataFrame([], "delayed_flag int, customer_complaint int")
    assert [tuple(r) for r in olap.key_figures(empty).collect()] == [(0, None, None)]


def test_fan_out_free_agent_means(spark):
    agents = spark.createDataFrame(
        [(1, "a", "a"), (2, "b", "b"), (3, "c", "c")],
        "agent_key int, agent_id string, agent_name string",
    )
    work = spark.createDataFrame(
        [("a", 10.0, 1), ("a", 20.0, 0), ("a", 60.0, None), ("b", 5.0, 0)],
        "agent_id string, delivery_time_min double, delayed_flag int",
    )
    seen = spark.createDataFrame([(1, 4.0), (1, 2.0), (1, None)], "agent_key int, rating double")
    naive = spark.sql(
        """SELECT a.agent_key, avg(f.delivery_time_min) t, sum(f.delayed_flag) * 1.0D / count(*) d,
            avg(r.rating) r FROM {a} a JOIN {f} f ON a.agent_id = f.agent_id
            LEFT JOIN {r} r ON a.agent_key = r.agent_key GROUP BY 1""",
        a=agents, f=work, r=seen,
    )
    ours = olap.agent_performance(agents, work, seen).select(
        "agent_key", "avg_delivery_time", "delay_rate", "avg_rating"
    )
    assert sorted(map(tuple, ours.collect())) == [
        pytest.approx(tuple(r)) for r in sorted(naive.collect())
    ]


def test_drill_from_rows_and_from_parts(spark):
    rows = spark.createDataFrame(
        [("A", "x", 10.0, 1), ("A", "y", 20.0, 0), ("A", "y", None, 0), ("B", "y", 7.0, 0)],
        "city string, agent_name string, delivery_time_min double, delayed_flag int",
    )
    parts = olap.measure_parts(rows, ["city", "agent_name"])
    for frame in (rows, parts):
        assert sorted(map(tuple, olap.drill(frame, "city").collect())) == [("A", 15.0), ("B", 7.0)]


def test_dice_bounds_are_inclusive(spark):
    frame = spark.createDataFrame(
        [("A", 20240101), ("A", 20240131), ("A", 20240201), ("B", 20240115)],
        "city string, time_id int",
    ).withColumn("order_date", F.to_date(F.col("time_id").cast("string"), "yyyyMMdd"))
    for dated in (False, True):
        kept = olap.dice(frame, ["A"], "2024-01-01", "2024-01-31", dated)
        assert sorted(values(kept, "time_id")) == [20240101, 20240131]
        assert olap.dice(frame, None, "2024-01-01", "2024-01-31", dated).count() == 3


def test_rare_words_are_scored_like_frequent_ones(spark):
    """Splitting the vocabulary must not change a score, whatever the number of hot words."""
    long_word = "x" * 200
    rows = [(i, "the " * 5 + f"cold cold food{i % 7} u{i} {long_word if i % 3 else ''}") for i in range(60)]
    df = spark.createDataFrame(rows, "review_id int, review_text string")
    whole = sorted(map(tuple, text.review_tf_idf(df).collect()))
    assert len(whole) == 60 * 3 + 40
    for hot in (1, 3, 20):
        assert sorted(map(tuple, text.review_tf_idf(df, hot_words=hot).collect())) == whole
        scored = text.review_tf_idf(df, hot_words=hot, unique_ids=True, method="join")
        assert sorted(map(tuple, scored.collect())) == whole
        assert sorted(map(tuple, text.tf_idf(text.term_counts(df), hot_words=hot).collect())) == whole
