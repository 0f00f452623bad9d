"""Registered queries of the corpus operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelsight.llm import (
    cross_polytope,
    kneser_ney,
    language_filters,
    mixing,
    odd_sketch,
    orc_tokens,
    ordinal,
    packing,
    quality_ledger,
    reversed_search,
    secrets,
    skip_list,
    url_cascade,
)
from parcelsight.llm.common import table
from parcelsight.sources.scratch import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under its name, with its SQL twin where there is one."""

    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return add


@query("op1_kneser_ney")
def kneser_ney_scores(spark: SparkSession, folder: str) -> DataFrame:
    return kneser_ney.score_documents(table(spark, folder, "documents"))


@query("op2_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query("op3_cross_polytope")
def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return cross_polytope.search(vectors.where("vec_id % 50 = 0"), vectors)


@query("op4_orc_tokens")
def stored_tokens(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "orc_tokens")
    orc_tokens.write_tokens(table(spark, folder, "documents"), path)
    return orc_tokens.summarize(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op5_ordinal_quality")
def rated_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = ordinal.train(documents, table(spark, folder, "labels"))
    rows = ordinal.rate(documents.select("doc_id", "text"), model)
    return rows.select(
        "doc_id", "expected_grade", "tail_probability", F.col("selected").alias("kept")
    )


@query("op6_secrets")
def secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = secrets.model_for(documents, table(spark, folder, "labels"))
    return secrets.digest(secrets.find(documents.select("doc_id", "text"), model))


@query("op7_url_cascade")
def judged_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = url_cascade.judge(pages, url_cascade.fixed_rules(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op8_odd_sketch")
def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return odd_sketch.near_duplicates(table(spark, folder, "documents"), width=2, percent=80)


_QUALITY_SQL = r"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), numbered AS (
  SELECT row_number() OVER () AS r, * FROM split
), windows AS (
  SELECT r, i, ws[i:i + 2] AS w
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM numbered)
), twice AS (
  SELECT r, w FROM windows GROUP BY r, w HAVING count(*) > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n
  FROM (SELECT * FROM windows SEMI JOIN twice USING (r, w)) CROSS JOIN (VALUES (0), (1), (2)) AS s(k)
  GROUP BY r
), measured AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(length(regexp_replace(t, '\P{Lu}', '', 'g')) AS BIGINT) AS n_capitals,
         CAST(len(list_filter(ws, lambda w: w IN ('|', '-', '*', '#'))) AS BIGINT) AS n_lone_marks
  FROM numbered LEFT JOIN covered USING (r)
), ledger AS (
  SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
       + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
       + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
       + (CASE WHEN 100 * n_dup_lines > 75 * n_lines THEN 8 ELSE 0 END)
       + (CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END)
       + (CASE WHEN 2 * n_capitals > word_chars THEN 32 ELSE 0 END)
       + (CASE WHEN 10 * n_lone_marks > 3 * n_words THEN 64 ELSE 0 END) AS BIGINT) AS failed_bits
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed_bits & 3 <> 0 AS base_failed, failed_bits & 127 = 0 AS kept, failed_bits
FROM ledger
"""


@query("op9_quality_ledger", _QUALITY_SQL)
def ruled_documents(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality_ledger.ledger(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        *quality_ledger.MEASURES[:5],
        (~quality_ledger.passes(quality_ledger.POLICIES["base"])).alias("base_failed"),
        quality_ledger.passes(quality_ledger.POLICIES[quality_ledger.CURRENT]).alias("kept"),
        "failed_bits",
    )


@query("op10_soft_mixing")
def mixed_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = (table(spark, folder, t) for t in ("documents", "labels"))
    rows, model, _ = mixing.mixed(documents, labels)
    best = F.array_max("posteriors")
    names = F.array(*[F.lit(d) for d in model.domains])
    return rows.select(
        "doc_id",
        "n_tokens",
        F.element_at(names, F.array_position("posteriors", best).cast("int")).alias("domain"),
        best.alias("posterior"),
        "rate",
        mixing.copies().alias("copies"),
    )


_SEARCH_SQL = r"""
WITH letters(a, b) AS (VALUES ('ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')),
words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, a, b), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents CROSS JOIN letters
), lengths AS (
  SELECT r, doc_id, len(ws) AS n FROM words WHERE len(ws) > 0
), corpus AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths
), counts AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM words) GROUP BY r, term
), asked AS (
  SELECT i, item_id, term, count(*) AS repeats FROM (
    SELECT row_number() OVER () AS i, item_id,
           unnest(regexp_extract_all(translate(text, a, b), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark CROSS JOIN letters) GROUP BY i, item_id, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts CROSS JOIN corpus GROUP BY term
), scored AS (
  SELECT i, item_id, r, doc_id,
         CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // total)))) AS BIGINT) AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (r) CROSS JOIN corpus
  GROUP BY i, item_id, r, doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
         doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@query("op11_reversed_search", _SEARCH_SQL)
def ranked_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents, items = (table(spark, folder, t) for t in ("documents", "benchmark"))
    return reversed_search.search(documents, items.select("item_id", "text")).select(
        "item_id", "rank", "doc_id", "score"
    )


_MIDDLE_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines
  FROM documents
), drawn AS (
  SELECT doc_id, t, lines, CAST(len(lines) AS BIGINT) AS n,
         CAST('0x' || h[1:8] AS BIGINT) % (len(lines) + 1) AS r1, CAST('0x' || h[9:16] AS BIGINT) % (len(lines) + 1) AS r2,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
), parts AS (
  SELECT doc_id, t, n, form, array_to_string(lines[1:least(r1, r2)], '') AS prefix,
         array_to_string(lines[least(r1, r2) + 1:greatest(r1, r2)], '') AS middle,
         array_to_string(lines[greatest(r1, r2) + 1:], '') AS suffix
  FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""


@query("op12_skip_list", _MIDDLE_SQL)
def middle_texts(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return skip_list.digest(skip_list.fill_in_middle(documents))


@query("op13_language_filters")
def predicted_languages(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held = language_filters.held_out()
    model = language_filters.learn(documents.where(~held))
    rows = language_filters.predict(documents.select("doc_id", "text"), model)
    return rows.select("doc_id", held.alias("held_out"), "lang_pred", "score")
