"""The whole run on the smallest tables, its stages checked against each other."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from parcelsight.operators import enrich
from parcelsight.plans.star import LINE_KEY, DeliveryStar
from parcelsight.plans.workflow import Workflow
from parcelsight.sources import schemas
from parcelsight.sources.scratch import staged


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    star = DeliveryStar(spark, entry.FLAGSHIP_DATA)
    flow = Workflow(spark, str(tmp_path_factory.mktemp("run")))
    flow.run(star.raw_reviews, ["Row Key"], star.raw_deliveries, list(LINE_KEY), "2001-08-01")
    return flow, star


def test_no_delivery_is_lost(run):
    flow, star = run
    lines = star.table("lineitem").count()
    facts = flow.read("fact_delivery")
    assert facts.count() == lines == facts.select("delivery_id").distinct().count()
    assert flow.read("preprocessed_data").count() == lines
    assert flow.read("clustering_results").count() == lines
    assert facts.agg(F.min("delivery_id"), F.max("delivery_id")).first()[:] == (1, lines)


def test_tables_have_their_schema(run):
    flow, _ = run
    for name, schema in {
        "dim_time": schemas.DIM_TIME,
        "dim_city": schemas.DIM_CITY,
        "dim_agent": schemas.DIM_AGENT,
        "fact_delivery": schemas.FACT_DELIVERY,
        "fact_review": schemas.FACT_REVIEW,
    }.items():
        found = dict(flow.read(name).dtypes)
        assert {f.name: found.get(f.name) for f in schema} == {
            f.name: f.dataType.simpleString() for f in schema
        }, name


def test_keys_meet_their_dimensions(run):
    flow, _ = run
    facts, reviews = flow.read("fact_delivery"), flow.read("fact_review")
    for fact, dim, key in (
        (facts, "dim_city", "city_id"),
        (facts, "dim_time", "time_id"),
        (facts, "dim_agent", "agent_id"),
        (reviews, "dim_city", "city_id"),
        (reviews, "dim_time", "time_id"),
        (reviews.filter("agent_key IS NOT NULL"), "dim_agent", "agent_key"),
    ):
        assert fact.join(flow.read(dim), key, "left_anti").count() == 0


def test_reviews_are_enriched(run):
    flow, _ = run
    reviews = flow.read("fact_review")
    assert {r["source"] for r in reviews.select("source").distinct().collect()} == set(enrich.SOURCES)
    assert reviews.filter(
        ~F.regexp_extract("review_text", "(" + "|".join(enrich.PHRASES) + ")$", 1).isin(*enrich.PHRASES)
    ).count() == 0


def test_models_are_compared(run):
    flow, _ = run
    table = flow.read("classification/accuracies").collect()
    assert {r["model"] for r in table} == {"decision_tree", "svm", "random_forest", "naive_bayes"}
    assert all(0.5 < r["accuracy"] <= 1 for r in table)


def test_reports(run, spark):
    flow, _ = run
    totals = {r["table_name"]: r["total"] for r in flow.read("warehouse_summary").collect()}
    assert totals["fact_delivery"] == flow.read("fact_delivery").count()
    summary = flow.read("executive_summary").first()
    assert summary["total_records"] == totals["fact_delivery"]
    assert summary["outlier_count"] == totals["delivery_anomalies"]
    clusters = spark.read.option("header", True).csv(flow.path("agent_clusters_csv"))
    assert clusters.columns[-1] == "cluster" and clusters.count() == totals["dim_agent"]
    assert flow.read("tf_idf").count() == 100
    assert flow.read("association_rules").filter("confidence < 0.6").count() == 0
    marked = flow.read("clustering_results")
    assert marked.select("cluster_kmeans").distinct().count() == 3
    assert marked.select("cluster_hierarchical").distinct().count() == 3
    # The phrases hold words of the built-in lexicon.
    sentiments = spark.read.option("header", True).csv(flow.path("review_sentiment_summary_csv"))
    assert {r["sentiment"] for r in sentiments.collect()} == {"positive", "negative"}


def test_reports_follow_a_replaced_month(run):
    flow, star = run
    plain = flow.read("fact_delivery_plain")
    month = plain.agg(F.max("month_id")).first()[0]
    rows = staged(plain.where(F.col("month_id") == month), "month")
    lines, gone = star.table("lineitem").count(), rows.where("delayed_flag = 1").count()

    def counted():
        return (
            flow.read("cube").where("level_id = 7").first()["deliveries"],
            flow.read("daily_orders").agg(F.sum("orders")).first()[0],
            flow.read("place_rollup").where("level_id = 3").first()["deliveries"],
        )

    assert gone and counted() == (lines,) * 3
    before = sorted(map(str, flow.read("fact_delivery").collect()))
    flow.replace_months(rows.where("NOT delayed_flag <=> 1"))
    assert counted() == (lines - gone,) * 3
    flow.replace_months(rows)
    assert counted() == (lines,) * 3
    assert sorted(map(str, flow.read("fact_delivery").collect())) == before
