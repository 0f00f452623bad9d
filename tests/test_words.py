"""Words by Unicode's rules, against another implementation of them."""

import duckdb
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelsight.functions.words import word_pattern, words_of

BOUNDARY = regex.compile(r"(?V1w)\b")
CASES = {
    "3.5 km": ["3.5", "km"],
    "1,000 or 1.000,5; 12": ["1,000", "or", "1.000,5", "12"],
    "e.g. this, i.e. that.": ["e.g", "this", "i.e", "that"],
    "can't won’t 'quoted' o'": ["can't", "won’t", "quoted", "o"],
    "東京に行く": ["東", "京", "に", "行", "く"],
    "カタカナとabc": ["カタカナ", "と", "abc"],
    "snake_case _x_ __ a__b": ["snake_case", "_x_", "a__b"],
    "3a a3 3.a a.3 3,a a,b 1:2 a:b": ["3a", "a3", "3", "a", "a", "3", "3", "a", "a", "b", "1", "2", "a:b"],
    "naïve café zero‍width so­ft": ["naïve", "café", "zero‍width", "so­ft"],
    "can.t.stop 1.2.3 1..2 a..b": ["can.t.stop", "1.2.3", "1", "2", "a", "b"],
    "½ ² € — !": [],
    "ไทย": ["ไ", "ท", "ย"],
    "Ⅷ x-y a/b": ["ⅷ", "x", "y", "a", "b"],
}


def spark_words(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return [r.w for r in df.select("id", words_of("text").alias("w")).orderBy("id").collect()]


def duck_words(texts):
    pattern = word_pattern("", "").replace("'", "''")
    sql = f"SELECT regexp_extract_all(lower(t), '{pattern}') FROM (SELECT unnest(?::VARCHAR[]) AS t)"
    return [r[0] for r in duckdb.connect().execute(sql, [list(texts)]).fetchall()]


def test_cases_of_the_rules(spark):
    assert spark_words(spark, CASES) == list(CASES.values())
    assert duck_words(CASES) == list(CASES.values())


def other(text):
    """Pieces between the boundaries of another implementation, those with a letter or digit."""
    return [p for p in BOUNDARY.split(text) if regex.search(r"[\p{L}\p{Nd}\p{Nl}]", p)]


KINDS = {
    **dict.fromkeys("abzßeé", "letter"), **dict.fromkeys("019٣", "digit"), **dict.fromkeys("_‿", "join"),
    **dict.fromkeys(":·", "midletter"), **dict.fromkeys(".'’", "midboth"), **dict.fromkeys(",;", "midnumber"),
    **dict.fromkeys("カナー", "kana"), **dict.fromkeys("漢字ひ", "single"), **dict.fromkeys("\u0301\u200d", "extend"),
}


def by_rules(text):
    """The rules one by one: marks belong to what they follow, then each pair is looked at."""
    parts = []
    for c in text:
        kind = KINDS.get(c, "other")
        if kind == "extend" and parts:
            parts[-1][1] += c
        else:
            parts.append([kind, c])
    words = []
    for i, (kind, piece) in enumerate(parts):
        before = parts[i - 1][0] if i else "start"
        earlier = parts[i - 2][0] if i > 1 else "start"
        after = parts[i + 1][0] if i + 1 < len(parts) else "end"
        joined = (
            {before, kind} <= {"letter", "digit"}
            or before == "letter" == after and kind in ("midletter", "midboth")
            or earlier == "letter" == kind and before in ("midletter", "midboth")
            or before == "digit" == after and kind in ("midnumber", "midboth")
            or earlier == "digit" == kind and before in ("midnumber", "midboth")
            or before == kind == "kana"
            or kind == "join" and before in ("letter", "digit", "kana", "join")
            or before == "join" and kind in ("letter", "digit", "kana")
        )
        if joined:
            words[-1].append((kind, piece))
        else:
            words.append([(kind, piece)])
    kept = {"letter", "digit", "kana", "single"}
    return ["".join(p for _, p in w) for w in words if any(k in kept for k, _ in w)]


UNITS = [*"abzß019_.,:;'’ \n-カナー漢字ひ·٣‿€", "e\u0301", "9\u0301", "a\u200d", "カ\u200d", "漢\u0301", ".\u0301"]


@pytest.fixture(scope="module")
def many():
    import random

    drawn = random.Random(7)
    return ["".join(drawn.choice(UNITS) for _ in range(drawn.choice((4, 8, 40)))) for _ in range(4000)]


def test_equal_to_another_implementation(spark, many):
    texts = [t.lower() for t in many]
    wanted = [by_rules(t) for t in texts]
    # The other implementation has rules of its own for apostrophes, and for marks before joiners.
    bare = [t for t in texts if not any(KINDS.get(c) == "extend" or c in "'’" for c in t)]
    assert len(bare) > 100 and [by_rules(t) for t in bare] == [other(t) for t in bare]
    got = spark_words(spark, texts)
    wrong = [(t, g, w) for t, g, w in zip(texts, got, wanted) if g != w]
    assert not wrong, wrong[:3]
    assert duck_words(texts) == wanted


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([*"ab1.,'_ 漢", "e\u0301"]), max_size=30))
def test_sql_pattern_on_short_texts(units):
    text = "".join(units)
    assert duck_words([text])[0] == by_rules(text)


def test_very_long_words_and_missing_texts(spark):
    n = 300_000
    texts = [None, "", "a" * n, "1," * n + "1", "a." * n, "_" * n, "_a" * n, "á" * n, "漢" * n, "x1" * n]
    got = spark_words(spark, texts)
    assert got[0] is None and got[1] == []
    sizes = [(len(g), len(g[0]) if g else 0) for g in got[2:]]
    assert sizes == [(1, n), (1, 2 * n + 1), (1, 2 * n - 1), (0, 0), (1, 2 * n), (1, 2 * n), (n, 1), (1, 2 * n)]


def test_no_python_worker_in_the_plan(spark):
    df = spark.range(1).select(words_of(F.lit("a b")).alias("w"))
    assert "Python" not in df._jdf.queryExecution().toString()
