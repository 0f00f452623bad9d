"""Review text: tokens, stop words, counts, TF-IDF and lexicon sentiment.

Word lists may be given as Python sequences or as DataFrames. A list proven small becomes
a literal set that is probed inside the scan, without a join; a bigger one is joined after
the tokens have been counted, so a frequent word is one row per map task or per review
when it reaches the shuffle. Results are the same either way: ``method`` ("literal" or
"join") forces one of them. What a review is, its id says; ``unique_ids`` promises that no
two rows share one, which saves the sums over ids.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelsight.functions.columns import case_when, if_else, ratio
from parcelsight.functions.words import LEXICON, STOP_WORDS, words_of
from parcelsight.sources.scratch import staged

# Longest word list turned into a literal set.
LITERAL_WORDS = 2_000
# Frequent words whose weights are broadcast; longer ones than this go by their digest.
HOT_WORDS = 200_000
HOT_LENGTH = 64

WordList = Sequence[str] | DataFrame
Lexicon = Sequence[tuple[str, str]] | DataFrame


def _small_list(words: WordList, method: str = "auto") -> list[str] | None:
    """The words themselves if there are few, None if they must be joined."""
    if method == "join":
        return None
    if method == "literal":
        if not isinstance(words, DataFrame):
            return list(words)
        return [r["word"] for r in words.select("word").filter("word IS NOT NULL").collect()]
    if not isinstance(words, DataFrame):
        return list(words) if len(words) <= LITERAL_WORDS else None
    rows = words.select("word").filter("word IS NOT NULL").limit(LITERAL_WORDS + 1).collect()
    return [r["word"] for r in rows] if len(rows) <= LITERAL_WORDS else None


def _word_frame(like: DataFrame, words: WordList) -> DataFrame:
    if isinstance(words, DataFrame):
        # Staged, so that the join is chosen by the list's measured size.
        return staged(words.select("word").distinct(), "words")
    # From Arrow: a local relation, whose size Catalyst knows.
    return like.sparkSession.createDataFrame(pa.table({"word": pa.array(words, pa.string())}))


def _kept_words(text: str | Column, stop: Sequence[str]) -> Column:
    words = words_of(text)
    return F.filter(words, lambda w: ~w.isin(*stop)) if stop else words


def tokens(
    reviews: DataFrame, text: str = "review_text", stop: WordList = (),
    keep: Sequence[str] = (), method: str = "auto",
) -> DataFrame:
    """One row per word of every review with a text, stop words removed."""
    small = _small_list(stop, method)
    rows = reviews.filter(F.col(text).isNotNull())
    words = rows.select(*keep, F.explode(_kept_words(text, small or ())).alias("word"))
    if small is None:
        words = words.join(_word_frame(reviews, stop), "word", "left_anti")
    return words


def word_counts(
    reviews: DataFrame, text: str = "review_text", stop: WordList = STOP_WORDS,
    method: str = "auto",
) -> DataFrame:
    """Occurrences of each word over all reviews."""
    small = _small_list(stop, method)
    counts = (
        tokens(reviews, text, small or ()).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    )
    if small is None:
        counts = counts.join(_word_frame(reviews, stop), "word", "left_anti")
    return counts


def top_words(counts: DataFrame, k: int = 20) -> DataFrame:
    """The k most frequent words; equal counts in word order."""
    return counts.orderBy(F.desc("n"), "word").limit(k)


def term_counts(
    reviews: DataFrame,
    review_id: str = "review_id",
    text: str = "review_text",
    stop: WordList = STOP_WORDS,
    unique_ids: bool = False,
    method: str = "auto",
) -> DataFrame:
    """Occurrences of each word in each review, with the review's number of words.

    If ``review_id`` is promised to be the key of the reviews, the total is counted in the row
    the words come from and rides along; else it is summed per id and joined back. Rows with a
    missing id are one review.
    """
    counts = _counted(reviews, review_id, text, stop, unique_ids, method)
    return counts.select(review_id, "word", "n", "total")


def _counted(
    reviews: DataFrame, review_id: str, text: str, stop: WordList, unique_ids: bool, method: str
) -> DataFrame:
    """Term counts and totals; ``_lead`` marks one row per review where that is known."""
    small = _small_list(stop, method)
    rows = reviews.filter(F.col(text).isNotNull()).select(
        review_id, _kept_words(text, small or ()).alias("_words")
    )
    counts = (
        rows.select(
            review_id,
            F.size("_words").cast("bigint").alias("_size"),
            F.posexplode("_words").alias("_at", "word"),
        )
        .groupBy(review_id, "word")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("_size").alias("total"),
            (F.min("_at") == 0).alias("_lead"),
        )
    )
    if small is None:
        counts = counts.join(_word_frame(reviews, stop), "word", "left_anti")
    if small is None or not unique_ids:
        # Words have gone, or a review has several rows: sum up what is there.
        counts = counts.drop("total", "_lead")
        totals = counts.groupBy(F.col(review_id).alias("_id")).agg(F.sum("n").alias("total"))
        counts = counts.join(totals, F.col(review_id).eqNullSafe(F.col("_id"))).drop("_id")
    return counts


def tf_idf(
    counts: DataFrame, review_id: str = "review_id", hot_words: int | None = None
) -> DataFrame:
    """Add tf = n / total, idf = ln(reviews / reviews with the word) and their product.

    ``hot_words`` bounds the words whose weights are broadcast; the result is the same.
    """
    return _scored(staged(counts, "term-counts"), review_id, hot_words)


def review_tf_idf(
    reviews: DataFrame,
    review_id: str = "review_id",
    text: str = "review_text",
    stop: WordList = STOP_WORDS,
    unique_ids: bool = False,
    method: str = "auto",
    hot_words: int | None = None,
) -> DataFrame:
    """The same from the texts; of unique ids, the reviews are counted by their lead rows."""
    counts = _counted(reviews, review_id, text, stop, unique_ids, method)
    return _scored(staged(counts, "term-counts"), review_id, hot_words)


def _scored(counts: DataFrame, review_id: str, hot_words: int | None) -> DataFrame:
    """Scores of staged term counts.

    The counts are read several times, which is why they are staged, and so is the
    vocabulary, whose number of words is then known.
    """
    if "_lead" in counts.columns:
        reviews = counts.agg(F.count_if("_lead").alias("n")).scalar()
    else:
        reviews = counts.agg(F.count_distinct(review_id).alias("n")).scalar()
    frequency = counts.groupBy("word").agg(F.count(F.lit(1)).alias("_df"))
    idf = F.log(reviews.cast("double") / F.col("_df")).alias("idf")
    vocabulary = staged(frequency.select("word", "_df", idf), "vocabulary")
    return _with_idf(counts, vocabulary, hot_words or HOT_WORDS).select(
        review_id,
        "word",
        "n",
        "total",
        ratio(F.col("n"), F.col("total")).alias("tf"),
        "idf",
        (ratio(F.col("n"), F.col("total")) * F.col("idf")).alias("tf_idf"),
    )


def _short(word: str) -> Column:
    """A word, or for a long one a digest behind a character that no word holds."""
    return F.when(F.length(word) <= HOT_LENGTH, F.col(word)).otherwise(
        F.concat(F.lit(" "), F.sha2(word, 256))
    )


def _with_idf(counts: DataFrame, vocabulary: DataFrame, hot_words: int) -> DataFrame:
    """Term counts with the weight of their word.

    A big vocabulary is split. Fewer than ``hot_words`` words can each hold more than
    1 / ``hot_words`` of all rows: these are broadcast, which settles most rows in place. Only
    rows of rare words are shuffled, and no rare word can fill a partition.
    """
    rows = counts.count()
    hot_above = rows // hot_words if vocabulary.count() > hot_words else 0
    is_hot = F.col("_df") > hot_above
    hot = vocabulary.filter(is_hot).select(_short("word").alias("_short"), "idf")
    rare = vocabulary.filter(~is_hot).select("word", F.col("idf").alias("_idf"))
    marked = counts.withColumn("_short", _short("word"))
    marked = marked.join(F.broadcast(hot), "_short", "left").drop("_short")
    settled = marked.filter(F.col("idf").isNotNull())
    rest = marked.filter(F.col("idf").isNull()).drop("idf").join(rare, "word")
    return settled.unionByName(rest.withColumnRenamed("_idf", "idf"))


def first_terms(scored: DataFrame, k: int = 100, review_id: str = "review_id") -> DataFrame:
    """First k rows by term count (not by tf_idf); ties by review and word."""
    return scored.orderBy(F.desc("n"), review_id, "word").limit(k)


def best_terms(scored: DataFrame, k: int = 100, review_id: str = "review_id") -> DataFrame:
    """First k rows by tf_idf; ties by review and word."""
    return scored.orderBy(F.desc("tf_idf"), review_id, "word").limit(k)


def _word_weights(lexicon: Lexicon, method: str = "auto") -> dict[str, int] | None:
    """Net weight per word, +1 for each positive entry and -1 for each other one."""
    if method == "join":
        return None
    if isinstance(lexicon, DataFrame) and method == "literal":
        entries = lexicon.select("word", "sentiment").collect()
    elif isinstance(lexicon, DataFrame):
        entries = lexicon.select("word", "sentiment").limit(LITERAL_WORDS + 1).collect()
    else:
        entries = list(lexicon)
    if len(entries) > LITERAL_WORDS and method != "literal":
        return None
    weights: dict[str, int] = defaultdict(int)
    for word, sentiment in entries:
        if word is not None and sentiment is not None:
            weights[word] += 1 if sentiment == "positive" else -1
    return weights


def _lexicon_frame(like: DataFrame, lexicon: Lexicon) -> DataFrame:
    if isinstance(lexicon, DataFrame):
        return staged(lexicon.select("word", "sentiment"), "lexicon")
    columns = {
        "word": pa.array([w for w, _ in lexicon], pa.string()),
        "sentiment": pa.array([s for _, s in lexicon], pa.string()),
    }
    return like.sparkSession.createDataFrame(pa.table(columns))


def sentiment_scores(
    reviews: DataFrame,
    review_id: str = "review_id",
    text: str = "review_text",
    stop: WordList = STOP_WORDS,
    lexicon: Lexicon = tuple(LEXICON),
    unique_ids: bool = False,
    method: str = "auto",
) -> DataFrame:
    """Add the sum of word weights over all rows of a review's id; 0 without any known word.

    With small lists a row's sum goes over its own words: the texts are neither exploded nor
    shuffled. With big ones the counted words are joined and scored. Rows with a missing id
    are one review.
    """
    weights, small = _word_weights(lexicon, method), _small_list(stop, method)
    if weights is not None and small is not None:
        stopped = set(small)
        by_weight: dict[int, list[str]] = defaultdict(list)
        for word, weight in weights.items():
            if weight and word not in stopped:
                by_weight[weight].append(word)

        def weight_of(word: Column) -> Column:
            cases = [(word.isin(*w), F.lit(v)) for v, w in sorted(by_weight.items())]
            return case_when(cases, F.lit(0)) if cases else F.lit(0)

        score = F.aggregate(words_of(text), F.lit(0), lambda acc, w: acc + weight_of(w))
        score = F.coalesce(score, F.lit(0)).cast("bigint")
        if unique_ids:
            return reviews.withColumn("sentiment_score", score)
        scores = reviews.groupBy(F.col(review_id).alias("_id")).agg(
            F.sum(score).alias("sentiment_score")
        )
    else:
        counts = term_counts(reviews, review_id, text, stop, unique_ids, method).drop("total")
        value = if_else(F.col("sentiment") == "positive", F.lit(1), F.lit(-1))
        scores = (
            counts.join(_lexicon_frame(reviews, lexicon), "word")
            .groupBy(F.col(review_id).alias("_id"))
            .agg(F.sum(F.col("n") * value).alias("sentiment_score"))
        )
    joined = reviews.join(scores, F.col(review_id).eqNullSafe(F.col("_id")), "left").drop("_id")
    return joined.fillna(0, ["sentiment_score"])


def sentiment_totals(
    reviews: DataFrame,
    text: str = "review_text",
    stop: WordList = STOP_WORDS,
    lexicon: Lexicon = tuple(LEXICON),
    method: str = "auto",
) -> DataFrame:
    """Word occurrences per sentiment class; a word in two classes counts in both.

    Only the classes' total is stated by the known results; that occurrences and not
    reviews are counted is an assumption.
    """
    weights, small = _word_weights(lexicon, method), _small_list(stop, method)
    if weights is not None and small is not None:
        # Only known words leave the row they stand in.
        known = [w for w in weights if w not in set(small)]
        hits = F.filter(words_of(text), lambda w: w.isin(*known))
        words = reviews.select(F.explode(hits).alias("word"))
        counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    else:
        counts = word_counts(reviews, text, stop, method)
    return (
        counts.join(_lexicon_frame(reviews, lexicon), "word")
        .groupBy("sentiment")
        .agg(F.sum("n").alias("n"))
    )
