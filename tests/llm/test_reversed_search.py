import math
import re
from collections import Counter

import numpy as np
import pytest
from helpers import clashing, empty_documents, odd_documents, prose
from pyspark.sql import functions as F

from parcelsight.llm import reversed_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall(text.translate(LOWER)) if text else []


def brute(documents, items, size):
    held = [(i, Counter(terms(t))) for i, t in documents]
    held = [(i, c) for i, c in held if c]
    total = sum(sum(c.values()) for _, c in held)
    has = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, counts in held:
            m = 75 + (25 * sum(counts.values()) * len(held)) // total
            score = 0
            for t in terms(text):
                if counts[t]:
                    w = math.floor(1000 * math.log((2 * len(held) + 2) / (2 * has[t] + 1)))
                    score += w * ((10**9 * counts[t]) // (1000 * counts[t] + 12 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(found)[:size], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=str)


def search(documents, items, **more):
    rows = rs.search(documents, items.select("item_id", "text"), **more)
    return sorted((tuple(r) for r in rows.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def frames(spark, n=300, items=12):
    documents = [(i, prose(5 + i % 60, i // 2), "en", "a", 0) for i in range(n)]
    asked = [(i, prose(3 + 4 * i, 1000 + i) + " W1 w1 é") for i in range(items)] + [(99, None), (98, ""), (97, "--")]
    return (
        spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").repartition(4),
        spark.createDataFrame(asked, "item_id long, text string"),
        [(r[0], r[1]) for r in documents],
        asked,
    )


@pytest.mark.parametrize("block", [1, 40, rs.POSTINGS])
def test_equal_to_brute_force_in_any_blocks(spark, block):
    documents, items, rows, asked = frames(spark)
    assert search(documents, items, block=block, size=7) == brute(rows, asked, 7)


def test_ties_and_repeated_rows(spark):
    rows = [(i % 40, "same words here" if i % 2 else "other words") for i in range(200)] + [(None, "same words here")] * 3
    asked = [(1, "same here same"), (1, "same here same"), (None, "other")]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame(asked, "item_id long, text string")
    assert search(documents, items) == brute(rows, asked, 20)


def test_small_slices_give_the_same(spark, monkeypatch):
    documents, items, rows, asked = frames(spark, n=40)
    monkeypatch.setattr(rs, "CELLS", 30)
    heaps = rs._Heaps(2, 3)
    drawn = np.random.default_rng(1).integers(0, 6, (50, 2))
    for a in range(0, 50, 7):
        heaps.push(drawn[a : a + 7], np.arange(a, min(a + 7, 50)), np.zeros(min(7, 50 - a), bool))
    item, score, _, doc = heaps.held
    for i in range(2):
        best = sorted((-int(s), d) for d, s in enumerate(drawn[:, i]) if s)[:3]
        assert [(-int(s), int(d)) for s, d in zip(score[item == i], doc[item == i])] == best
    assert list(rs._slices(np.array([5, 10, 16, 90, 2]))) == [(0, 2), (2, 3), (3, 4), (4, 5)]
    assert search(documents, items) == brute(rows, asked, 20)


def test_odd_documents_and_clashing_columns(spark):
    documents = odd_documents(spark)
    asked = [(1, "the cat same text"), (2, "wörds naïve password"), (3, "w1 w2 w1")]
    items = spark.createDataFrame(asked, "item_id long, text string")
    expected = brute([(r.doc_id, r.text) for r in documents.collect()], asked, 20)
    assert search(documents, items) == expected
    assert search(clashing(documents).withColumn("n", F.lit("y")), items) == expected
    more = items.withColumns({"_item": F.lit("x"), "terms": F.lit("y"), "block": F.lit(None)})
    rows = rs.search(documents, more)
    assert rows.columns == [*more.columns, "rank", "doc_id", "score"]
    assert rows.count() == len(expected)


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "the cat")], "item_id long, text string")
    assert search(empty_documents(spark), items) == []
    assert search(odd_documents(spark), items.limit(0)) == []
    none = rs.search(odd_documents(spark), items.where("item_id = 2"))
    assert none.columns == ["item_id", "text", "rank", "doc_id", "score"] and none.count() == 0
