"""Queries over review texts, and association rules among review attributes."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelsight.functions.words import STOP_WORDS, word_pattern
from parcelsight.operators import olap, rules, text
from parcelsight.plans.registry import query, rounded
from parcelsight.plans.star import DeliveryStar

# The given texts are invented words, which no real lexicon knows: this small one is made
# of words that occur in them, one of them in both classes.
TEXT_LEXICON = (
    ("rewh", "positive"),
    ("orre", "positive"),
    ("inoran", "positive"),
    ("thatin", "positive"),
    ("thatin", "negative"),
    ("ononst", "negative"),
    ("hehely", "negative"),
    ("orantion", "negative"),
)

_STOP = ", ".join(f"('{w}')" for w in STOP_WORDS)
_ENTRIES = ", ".join(f"('{w}', '{s}')" for w, s in TEXT_LEXICON)
_WORDS = f"regexp_extract_all(lower(review_text), '{word_pattern('', '').replace(chr(39), chr(39) * 2)}')"
_TOKENS = f"""all_words AS (SELECT review_id, unnest({_WORDS}) AS word FROM fact_review
        WHERE review_text IS NOT NULL),
    tokens AS (SELECT review_id, word FROM all_words
        WHERE word NOT IN (SELECT w FROM (VALUES {_STOP}) AS stop_list(w)))"""
_COUNTS = _TOKENS + """,
    counts AS (SELECT review_id, word, count(*) AS n FROM tokens GROUP BY review_id, word),
    totals AS (SELECT review_id, sum(n)::BIGINT AS total FROM counts GROUP BY review_id)"""
_TF_IDF = _COUNTS + """,
    frequency AS (SELECT word, count(*) AS df FROM counts GROUP BY word),
    scored AS (SELECT review_id, word, n, total, n::DOUBLE / total AS tf,
        ln((SELECT count(DISTINCT review_id) FROM counts)::DOUBLE / df) AS idf
        FROM counts JOIN totals USING (review_id) JOIN frequency USING (word)),
    tf_idf AS (SELECT review_id, word, n, total, round(tf, 9) AS tf, round(idf, 9) AS idf,
        round(tf * idf, 9) AS tf_idf FROM scored)"""
_LEXICON = f"lexicon(word, sentiment) AS (VALUES {_ENTRIES})"


def _reviews(star: DeliveryStar):
    return star.plain_reviews.select("review_id", "rating", "review_text")


@query(
    "review_tokens",
    "TXT-01 TXT-02",
    f"""WITH {_TOKENS} SELECT review_id, count(*) AS tokens, count(DISTINCT word) AS words,
        min(word) AS first_word, max(word) AS last_word FROM tokens GROUP BY review_id""",
)
def review_tokens(star: DeliveryStar):
    words = text.tokens(_reviews(star), stop=STOP_WORDS, keep=["review_id"])
    return words.groupBy("review_id").agg(
        F.count(F.lit(1)).alias("tokens"),
        F.count_distinct("word").alias("words"),
        F.min("word").alias("first_word"),
        F.max("word").alias("last_word"),
    )


@query(
    "review_tokens_joined",
    "TXT-01 TXT-02 JOIN-05",
    f"""WITH {_TOKENS} SELECT review_id, count(*) AS tokens, count(DISTINCT word) AS words,
        min(word) AS first_word, max(word) AS last_word FROM tokens GROUP BY review_id""",
)
def review_tokens_joined(star: DeliveryStar):
    """The same tokens with the stop words taken out by an anti-join."""
    words = text.tokens(_reviews(star), stop=STOP_WORDS, keep=["review_id"], method="join")
    return words.groupBy("review_id").agg(
        F.count(F.lit(1)).alias("tokens"),
        F.count_distinct("word").alias("words"),
        F.min("word").alias("first_word"),
        F.max("word").alias("last_word"),
    )


@query(
    "word_counts",
    "TXT-03 AGG-06",
    f"WITH {_TOKENS} SELECT word, count(*) AS n FROM tokens GROUP BY word",
)
def word_counts(star: DeliveryStar):
    return text.word_counts(_reviews(star))


@query(
    "word_counts_stop_table",
    "TXT-02 TXT-03 JOIN-05",
    f"""WITH all_words AS (SELECT unnest({_WORDS}) AS word FROM fact_review),
        stop_list AS (SELECT DISTINCT word FROM (SELECT unnest(regexp_extract_all(lower(text),
            '[\\p{{L}}\\p{{M}}\\p{{N}}_]+(?:[''’][\\p{{L}}\\p{{M}}\\p{{N}}_]+)*')) AS word FROM benchmark))
    SELECT word, count(*) AS n FROM all_words WHERE word NOT IN (SELECT word FROM stop_list)
    GROUP BY word""",
)
def word_counts_stop_table(star: DeliveryStar):
    """Stop words from a table of its own: every word of the benchmark texts."""
    stop = text.tokens(star.table("benchmark"), "text").distinct()
    return text.word_counts(_reviews(star), stop=stop, method="join")


@query(
    "top_words",
    "TOP-01 TOP-06 TXT-03",
    f"""WITH {_TOKENS} SELECT word, count(*) AS n FROM tokens GROUP BY word
    ORDER BY n DESC, word LIMIT 20""",
)
def top_words(star: DeliveryStar):
    return text.top_words(text.word_counts(_reviews(star)), 20)


@query(
    "term_counts",
    "TXT-04 AGG-07 AGG-08 JOIN-08",
    f"""WITH {_COUNTS} SELECT review_id, word, n, total FROM counts
    JOIN totals USING (review_id)""",
)
def term_counts(star: DeliveryStar):
    return text.term_counts(_reviews(star), unique_ids=True)


@query(
    "term_totals_joined",
    "AGG-07 AGG-08 JOIN-08",
    f"""WITH {_COUNTS} SELECT review_id, word, n, total FROM counts
    JOIN totals USING (review_id)""",
)
def term_totals_joined(star: DeliveryStar):
    """The same counts with the totals summed per review and joined back on shared columns."""
    counts = text.term_counts(_reviews(star), unique_ids=True).drop("total")
    totals = counts.groupBy("review_id").agg(F.sum("n").alias("total"))
    return olap.natural_left_join(counts, totals).select("review_id", "word", "n", "total")


def _scored(star: DeliveryStar):
    return text.review_tf_idf(_reviews(star), unique_ids=True)


def _nine(df):
    return rounded(df, 9, "tf", "idf", "tf_idf")


@query("tf_idf", "TXT-05 FN-14 JOIN-08", f"WITH {_TF_IDF} SELECT * FROM tf_idf")
def tf_idf(star: DeliveryStar):
    return _nine(_scored(star))


@query("tf_idf_rare_words", "TXT-05 FN-14 JOIN-08", f"WITH {_TF_IDF} SELECT * FROM tf_idf")
def tf_idf_rare_words(star: DeliveryStar):
    """The same scores with 500 words broadcast and all others joined by a shuffle."""
    return _nine(text.review_tf_idf(_reviews(star), method="join", hot_words=500))


@query("tf_idf_of_counts", "TXT-05 TXT-04 FN-14", f"WITH {_TF_IDF} SELECT * FROM tf_idf")
def tf_idf_of_counts(star: DeliveryStar):
    """The same scores from a table of term counts."""
    return _nine(text.tf_idf(text.term_counts(_reviews(star))))


@query(
    "first_tf_idf_terms",
    "TOP-03 TXT-05",
    f"WITH {_TF_IDF} SELECT * FROM tf_idf ORDER BY n DESC, review_id, word LIMIT 100",
)
def first_tf_idf_terms(star: DeliveryStar):
    return _nine(text.first_terms(_scored(star), 100))


@query(
    "shown_tf_idf_terms",
    "TOP-04 TOP-06",
    f"""WITH {_TF_IDF} SELECT word, review_id, tf_idf FROM (SELECT * FROM tf_idf
        ORDER BY n DESC, review_id, word LIMIT 15) ORDER BY tf_idf, word""",
)
def shown_tf_idf_terms(star: DeliveryStar):
    shown = _nine(text.first_terms(_scored(star), 15))
    return shown.select("word", "review_id", "tf_idf").orderBy("tf_idf", "word")


@query(
    "best_tf_idf_terms",
    "TOP-03 TXT-05",
    f"WITH {_TF_IDF} SELECT * FROM tf_idf ORDER BY tf_idf DESC, review_id, word LIMIT 100",
)
def best_tf_idf_terms(star: DeliveryStar):
    return text.best_terms(_nine(_scored(star)), 100)


@query(
    "review_sentiment",
    "TXT-06 AGG-08 FN-06 FN-07",
    f"""WITH {_TOKENS}, {_LEXICON},
        scores AS (SELECT review_id, sum(CASE WHEN sentiment = 'positive' THEN 1 ELSE -1 END)::BIGINT
            AS score FROM tokens JOIN lexicon USING (word) GROUP BY review_id)
    SELECT review_id, rating, review_text, coalesce(score, 0) AS sentiment_score
    FROM fact_review LEFT JOIN scores USING (review_id)""",
)
def review_sentiment(star: DeliveryStar):
    return text.sentiment_scores(_reviews(star), lexicon=TEXT_LEXICON, unique_ids=True)


_SENTIMENT = f"""WITH {_TOKENS}, {_LEXICON},
        scores AS (SELECT review_id, sum(CASE WHEN sentiment = 'positive' THEN 1 ELSE -1 END)::BIGINT
            AS score FROM tokens JOIN lexicon USING (word) GROUP BY review_id)
    SELECT review_id, rating, review_text, coalesce(score, 0) AS sentiment_score
    FROM fact_review LEFT JOIN scores USING (review_id)"""


@query("review_sentiment_joined", "TXT-06 JOIN-05 JOIN-06 JOIN-07 AGG-08 FN-06", _SENTIMENT)
def review_sentiment_joined(star: DeliveryStar):
    """The same scores by joins: stop words taken out, the lexicon and the scores joined."""
    return text.sentiment_scores(_reviews(star), lexicon=TEXT_LEXICON, method="join")


@query("sentiment_per_review_id", "TXT-06 JOIN-07 AGG-08", _SENTIMENT)
def sentiment_per_review_id(star: DeliveryStar):
    """The same scores from literal lists, summed per id and joined back."""
    return text.sentiment_scores(_reviews(star), lexicon=TEXT_LEXICON, method="literal")


@query(
    "sentiment_totals",
    "TXT-07 JOIN-06",
    f"""WITH {_TOKENS}, {_LEXICON} SELECT sentiment, count(*) AS n FROM tokens
    JOIN lexicon USING (word) GROUP BY sentiment""",
)
def sentiment_totals(star: DeliveryStar):
    return text.sentiment_totals(_reviews(star), lexicon=TEXT_LEXICON)


_LABELS = """labels4 AS (SELECT
    CASE WHEN order_accuracy >= 4 THEN 'HighAccuracy' ELSE 'LowAccuracy' END AS accuracy_cat,
    CASE WHEN product_availability >= 4 THEN 'GoodAvailability' ELSE 'LowAvailability' END
        AS availability_cat,
    CASE WHEN discount_applied = 1 THEN 'Discount' ELSE 'NoDiscount' END AS discount_cat,
    CASE WHEN rating >= 4 THEN 'HighRating' ELSE 'LowRating' END AS rating_cat FROM fact_review)"""
_ITEMS = ", ".join(
    f"CASE WHEN grouping({c}) = 0 THEN '{c}=' || {c} END"
    for c in ("accuracy_cat", "availability_cat", "discount_cat", "rating_cat")
)
_SETS = _LABELS + f""",
    cells AS (SELECT list_sort(list_filter([{_ITEMS}], lambda x: x IS NOT NULL)) AS items,
        count(*) AS freq FROM labels4
        GROUP BY CUBE (accuracy_cat, availability_cat, discount_cat, rating_cat)),
    sets AS (SELECT items, freq, (SELECT count(*) FROM labels4) AS total FROM cells
        WHERE len(items) > 0 AND freq >= 0.05 * (SELECT count(*) FROM labels4))"""
_RULES = _SETS + """,
    sided AS (SELECT items, freq, total, unnest(items) AS consequent FROM sets WHERE len(items) > 1),
    split AS (SELECT *, list_filter(items, lambda x: x <> consequent) AS antecedent FROM sided),
    rules AS (SELECT '{' || array_to_string(antecedent, ',') || '} => {' || consequent || '}' AS rules,
        round(s.freq::DOUBLE / s.total, 9) AS support, round(s.freq::DOUBLE / a.freq, 9) AS confidence,
        round(a.freq::DOUBLE / s.total, 9) AS coverage,
        round((s.freq::DOUBLE / a.freq) / (c.freq::DOUBLE / s.total), 9) AS lift, s.freq AS count
        FROM split s JOIN sets a ON s.antecedent = a.items JOIN sets c ON c.items = [s.consequent]
        WHERE s.freq::DOUBLE / a.freq >= 0.6)"""


def _labels(star: DeliveryStar):
    return rules.review_labels(star.reviews)


def _rounded_rules(df):
    return rounded(df, 9, "support", "confidence", "coverage", "lift")


@query("review_labels", "RUL-01 FN-09", f"WITH {_LABELS} SELECT *, count(*) AS n FROM labels4 GROUP BY ALL")
def review_labels(star: DeliveryStar):
    labels = _labels(star)
    return olap.count_by(labels, *labels.columns)


@query(
    "review_transactions",
    "RUL-02",
    f"""WITH {_LABELS} SELECT array_to_string(['accuracy_cat=' || accuracy_cat,
        'availability_cat=' || availability_cat, 'discount_cat=' || discount_cat,
        'rating_cat=' || rating_cat], ';') AS items FROM labels4""",
)
def review_transactions(star: DeliveryStar):
    return rules.transactions(_labels(star)).select(F.array_join("items", ";").alias("items"))


@query(
    "frequent_itemsets",
    "RUL-03",
    f"WITH {_SETS} SELECT array_to_string(items, ';') AS items, freq, total FROM sets",
)
def frequent_itemsets(star: DeliveryStar):
    sets = rules.frequent_itemsets(_labels(star), 0.05)
    return sets.select(F.array_join("items", ";").alias("items"), "freq", "total")


@query("association_rules", "RUL-04 RUL-05", f"WITH {_RULES} SELECT * FROM rules")
def association_rules(star: DeliveryStar):
    return _rounded_rules(rules.mine_rules(_labels(star), 0.05, 0.6))


@query("association_rules_fpgrowth", "RUL-03 RUL-04", f"WITH {_RULES} SELECT * FROM rules")
def association_rules_fpgrowth(star: DeliveryStar):
    """The same rules by FP-growth, the way for frames with many label columns."""
    return _rounded_rules(rules.mine_rules(_labels(star), 0.05, 0.6, method="fpgrowth"))


@query(
    "strongest_rules",
    "TOP-02 RUL-05",
    f"""WITH {_RULES} SELECT * FROM rules
    ORDER BY lift DESC, confidence DESC, support DESC, rules LIMIT 20""",
)
def strongest_rules(star: DeliveryStar):
    return rules.strongest_rules(_rounded_rules(rules.mine_rules(_labels(star))), 20)
