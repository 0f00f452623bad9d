"""The whole mining run: cleaning, warehouse, enrichment, preparation, models, reports.

One function per stage, stored tables in between: a stage reads what the earlier ones have
written, so a failed run continues from its last complete stage and no plan spans the run.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelsight.functions.words import LEXICON, STOP_WORDS
from parcelsight.operators import (
    bayes,
    classify,
    cluster,
    enrich,
    etl,
    evaluate,
    olap,
    outliers,
    prep,
    quality,
    rules,
    standing,
    text,
    warehouse,
)
from parcelsight.sources.readers import read_stage
from parcelsight.sources.scratch import staged
from parcelsight.sources.writers import (
    replace_folders,
    save_models,
    write_delimited,
    write_stage,
)

DELIVERY_FIELDS = (
    "distance_km", "delivery_time_min", "sla_min", "delayed_flag", "traffic_level", "weather",
    "vehicle_type", "is_festival",
)
REVIEW_FIELDS = (
    "rating", "order_accuracy", "product_availability", "discount_applied", "price_range",
    "review_text",
)
POSITIVE = "No_Complaint"


@dataclass(frozen=True)
class Workflow:
    """Stages over one output folder."""

    spark: SparkSession
    root: str
    stop: text.WordList = tuple(STOP_WORDS)
    lexicon: text.Lexicon = tuple(LEXICON)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame:
        return read_stage(self.spark, self.path(name))

    def _keep(self, name: str, df: DataFrame, *partition_by: str) -> None:
        write_stage(df, self.path(name), partition_by)

    def clean(
        self, raw_reviews: DataFrame, order_by: Sequence[str], reference_date: str,
        unique: bool = False,
    ) -> None:
        """``unique`` promises that ``order_by`` identifies a raw row: its other columns, the text
        among them, then need not break ties."""
        raw = quality.require_rows(raw_reviews, 1, "raw reviews")
        cleaned = etl.clean_reviews(raw, order_by, reference_date, unique=unique)
        fields = ("review_id", "order_date", "city", "agent_name", "agent_id", *REVIEW_FIELDS)
        self._keep("reviews_clean", cleaned.select(*fields))

    def build_warehouse(self, raw_deliveries: DataFrame, order_by: Sequence[str]) -> None:
        reviews = self.read("reviews_clean")
        # Read four times below: the caller's joins run once.
        self._keep("deliveries_raw", raw_deliveries)
        work = etl.traffic_levels(etl.delay_flags(self.read("deliveries_raw")))
        self._keep("dim_time", warehouse.time_dimension(work, reviews))
        self._keep("dim_city", warehouse.city_dimension(work, reviews))
        self._keep("dim_agent", warehouse.agent_dimension(work, reviews))
        cities, agents = self.read("dim_city"), self.read("dim_agent")
        facts = warehouse.delivery_facts(work, cities, list(order_by), list(DELIVERY_FIELDS))
        # Months as folders: a date range reads only its own.
        month = (F.col("time_id") / 100).cast("int")
        self._keep("fact_delivery_plain", facts.withColumn("month_id", month), "month_id")
        rated = warehouse.review_facts(reviews, cities, agents, list(REVIEW_FIELDS))
        self._keep("fact_review_plain", rated)

    def enrich(self) -> None:
        facts = enrich.enrich_deliveries(self.read("fact_delivery_plain"), ["delivery_id"])
        self._keep("fact_delivery", facts, "month_id")
        reviews = enrich.enrich_reviews(self.read("fact_review_plain"), ["review_id"])
        self._keep("fact_review", reviews)

    def prepare(self) -> None:
        """Fit the preparation, store it for later deliveries, and apply it to these."""
        facts = self.read("fact_delivery")
        path = prep.fit_preparation(facts).save(self.spark, self.path("preparation"))
        self._keep("preprocessed_data", prep.Preparation.load(self.spark, path).apply(facts))

    def report_measures(self) -> None:
        """Grouped reports from parts of the months; only months whose facts changed are read."""
        standing.refresh(self.spark, self.path("fact_delivery"), self.path("measure_parts"))
        facts, cities = self.read("fact_delivery"), self.read("dim_city")
        days, places, cells = (
            standing.parts_of(self.spark, self.path("measure_parts"), name)
            for name in ("days", "places", "cells")
        )
        self._keep("city_traffic", olap.city_traffic(cells, cities))
        self._keep("city_month", olap.city_month(days, cities, self.read("dim_time")))
        self._keep("daily_orders", olap.daily_orders(days, self.read("dim_time")))
        named = places.join(cities, "city_id", "left").withColumnRenamed("agent_id", "agent_name")
        for level in ("city", "agent_name"):
            self._keep(f"drill_{level}", olap.drill(named, level))
        self._keep("place_rollup", olap.hierarchy_rollup(named, ["city", "agent_name"]))
        kept = ["city", "traffic_level", "weather"]
        self._keep("cube", olap.dimension_cube(cells.join(cities, "city_id", "left"), kept))
        self._keep("key_figures", olap.key_figures(facts))

    def replace_months(self, facts: DataFrame) -> None:
        """Put plain delivery facts in place of all those of their months, and renew the reports.

        ``facts`` have the columns of the stored ones and ids and keys of the same dimensions.
        """
        facts = staged(facts, "month-facts")
        replace_folders(facts, self.path("fact_delivery_plain"), "month_id")
        rich = enrich.enrich_deliveries(facts, ["delivery_id"])
        replace_folders(rich, self.path("fact_delivery"), "month_id")
        self.report_measures()

    def classify(self) -> None:
        """Fit and compare the tree, naive Bayes and SVM, and a forest beside them."""
        frame = prep.model_frame(self.read("preprocessed_data"), ["delivery_id"])
        self._keep("model_rows", prep.stratified_split(frame, "label", ["delivery_id"]))
        rows = self.read("model_rows")
        train, test = rows.filter("is_train"), rows.filter("NOT is_train")
        models = {
            "decision_tree": classify.fit_tree(train),
            "svm": classify.fit_svm(train),
            "random_forest": classify.fit_forest(train),
        }
        scored = {name: classify.predictions(m, test) for name, m in models.items()}
        mixed = bayes.fit(train, "label", classify.NUMERIC, classify.CATEGORICAL)
        mixed.save(self.spark, self.path("classification/model_naive_bayes"))
        scored["naive_bayes"] = bayes.predict(mixed, test)
        save_models(models, evaluate.compare(scored, POSITIVE), self.path("classification"))

    def segment_agents(self) -> None:
        facts, reviews = self.read("fact_delivery"), self.read("fact_review")
        performance = olap.agent_performance(self.read("dim_agent"), facts, reviews)
        self._keep("agent_performance", performance)
        clusters = cluster.kmeans(self.read("agent_performance"))
        write_delimited(clusters, self.path("agent_clusters_csv"), "overwrite")

    def segment_deliveries(self) -> None:
        """Both clusterings and outlier flags next to the components."""
        rows = self.read("preprocessed_data").select(
            "delivery_id", "city_id", "distance_km", "order_value", "PC1", "PC2"
        )
        flagged = outliers.flag_outliers(rows, ["distance_km", "order_value"])
        self._keep("flagged_deliveries", flagged)
        flat = cluster.kmeans(
            self.read("flagged_deliveries"), ["PC1", "PC2"], seeds=[123], name="cluster_kmeans"
        )
        named = quality.conform(
            cluster.bisecting(flat, ["PC1", "PC2"]),
            ["delivery_id", "city", "distance_km", "order_value", "PC1", "PC2", "is_outlier",
             "cluster_kmeans", "cluster_hierarchical"],
            lookups={"city": (self.read("dim_city"), "city_id")},
        )
        self._keep("clustering_results", named)

    def find_rules(self) -> None:
        reviews = quality.require_rows(self.read("fact_review"), 1, "reviews")
        mined = rules.mine_rules(rules.review_labels(reviews))
        self._keep("association_rules", mined.orderBy(F.desc("lift"), "rules"))

    def mine_texts(self) -> None:
        reviews = quality.require_rows(self.read("fact_review"), 1, "reviews")
        self._keep("word_counts", text.word_counts(reviews, stop=self.stop))
        scored = text.sentiment_scores(
            reviews.select("review_id", "review_text", "rating"),
            stop=self.stop,
            lexicon=self.lexicon,
            unique_ids=True,
        )
        write_delimited(scored, self.path("reviews_with_sentiment_csv"), "overwrite")
        totals = text.sentiment_totals(reviews, stop=self.stop, lexicon=self.lexicon)
        write_delimited(totals, self.path("review_sentiment_summary_csv"), "overwrite")
        terms = text.review_tf_idf(reviews, stop=self.stop, unique_ids=True)
        self._keep("tf_idf", text.first_terms(terms, 100))
        self._keep("source_summary", olap.source_summary(reviews))

    def report_anomalies(self) -> None:
        found = outliers.delay_anomalies(self.read("fact_delivery"))
        self._keep("delivery_anomalies", found)
        write_delimited(found, self.path("delivery_anomalies_csv"), "overwrite")

    def summarize(self) -> None:
        tables = {
            "dim_agent": (self.read("dim_agent"), None),
            "dim_city": (self.read("dim_city"), None),
            "dim_time": (self.read("dim_time"), None),
            "fact_delivery": (self.read("fact_delivery"), "delivery_time_min"),
            "fact_review": (self.read("fact_review"), "rating"),
            "delivery_anomalies": (self.read("delivery_anomalies"), "z_delay"),
        }
        self._keep("warehouse_summary", quality.warehouse_summary(tables))
        figures = olap.executive_summary(
            self.read("fact_delivery"),
            self.read("classification/accuracies"),
            self.read("delivery_anomalies"),
        )
        self._keep("executive_summary", figures)

    def run(
        self,
        raw_reviews: DataFrame,
        review_order: Sequence[str],
        raw_deliveries: DataFrame,
        delivery_order: Sequence[str],
        reference_date: str,
        unique_reviews: bool = False,
    ) -> None:
        self.clean(raw_reviews, review_order, reference_date, unique_reviews)
        self.build_warehouse(raw_deliveries, delivery_order)
        self.enrich()
        self.prepare()
        self.report_measures()
        self.classify()
        self.segment_agents()
        self.segment_deliveries()
        self.find_rules()
        self.mine_texts()
        self.report_anomalies()
        self.summarize()
