"""From raw documents to packed sequences: rate, deduplicate, redact, mix, pack.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept; its
result is written as Parquet and read again by the next. All but the last return the columns of
documents. Missing values, empty texts, repeated rows and empty tables are handled as the
operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelsight.llm import mixing, odd_sketch, ordinal, packing, secrets
from parcelsight.llm.common import table
from parcelsight.sources.scratch import staged


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier selects; the rejected ones go."""
    model = ordinal.train(docs, table(spark, sf_dir, "labels"))
    return ordinal.rate(docs, model).where("selected").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8).

    Documents without doc_id all stay; rows equal in doc_id and text stay once. A repeated doc_id
    with another text is judged for itself.
    """
    return odd_sketch.without_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret and ``n_chars`` of what is left."""
    model = secrets.model_for(docs, table(spark, sf_dir, "labels"))
    clean = secrets.redact(docs, model)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their fitted rate says; domains that are rare come more often.

    The targets ask for no less of any domain than there is, so every document stays.
    """
    model = mixing.train(mixing.labelled_rows(docs, table(spark, sf_dir, "labels")))
    rows = mixing.with_posteriors(docs, model)
    mix = mixing.fit_rates(staged(rows.select("n_tokens", "posteriors"), "posteriors"), model)
    rated = mixing.with_rates(rows, mix).withColumn("_copies", mixing.copies(least=1))
    copied = rated.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_copies"))))
    return copied.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", select_quality),
    ("near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Classifiers, sketches, models and tokenizers are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each over the stored result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
