import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import clashing, empty_documents, odd_documents
from pyspark.sql import functions as F

import __spark_entry__ as entry
from parcelsight.llm import language_filters as lf
from parcelsight.llm.common import table

SYLLABLES = {
    "xa": "ba be bi bo bu da de di",
    "xb": "kra kre kri pla ple pli",
    "xc": "мо на ко ла ти во",
    "xd": "东西南北中山水",
}


def text_of(lang, seed, n=40):
    drawn = random.Random(f"{lang}{seed}")
    parts = SYLLABLES[lang].split() if " " in SYLLABLES[lang] else list(SYLLABLES[lang])
    return " ".join("".join(drawn.choice(parts) for _ in range(drawn.randint(1, 4))) for _ in range(n))


def learned(spark, langs=tuple(SYLLABLES), n=30):
    rows = [(i, text_of(x, i), x) for x in langs for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)


def plain_grams(text):
    letters = [c if c.isalpha() else " " for c in (text or "").lower()]
    padded = [" "] * 2 + letters + [" "] * 2
    out = []
    for at in range(2, len(padded) - 2):
        if padded[at] != " ":
            out += ["".join(padded[at - half : at + half + 1]) for half in (1, 2)]
    return out


def test_grams_are_those_around_each_letter():
    texts = ["The cat, the CAT.", None, "", "123 --", "é", "x" * 5000, "a b", "ab", "Ω東京 a"]
    found, sizes = lf.grams(texts)
    named = [plain_grams(t) for t in texts]
    assert sizes.tolist() == [len(x) for x in named]
    names, hashes = [g for x in named for g in x], found.tolist()
    assert len(set(zip(names, hashes))) == len(set(names)) == len(set(hashes))


def test_counts_are_those_of_all_learned_texts(spark, monkeypatch):
    documents = learned(spark).unionByName(
        spark.createDataFrame([(1, None, "xa"), (2, "ba", None), (3, "", "xa")], "doc_id long, text string, lang string")
    )
    expected = Counter((r.lang, g) for r in documents.collect() if r.lang for g in plain_grams(r.text))
    for held in (lf.HELD, 64):
        monkeypatch.setattr(lf, "HELD", held)
        got = lf.gram_counts(documents).collect()
        assert sorted((r.lang, r.n) for r in got) == sorted((lang, n) for (lang, _), n in expected.items())


def test_filters_hold_their_languages_and_few_others(spark):
    model = lf.learn(learned(spark))
    (one,) = model.filters
    assert one.languages == tuple(SYLLABLES) and one.cells.dtype == np.uint8
    assert (one.mistakes() < 0.05).all()
    for i, lang in enumerate(one.languages):
        found, _ = lf.grams([text_of(lang, 3)])
        assert (one.holders(found) >> np.uint8(i) & 1).all()
    drawn = np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64)
    shares = one.shares(drawn, np.array([20_000]), np.zeros(4))
    assert np.allclose(shares[0], one.mistakes(), atol=0.01)
    assert (one.shares(drawn, np.array([20_000]), one.mistakes()) < 0.01).all()


def test_only_common_grams_are_held(spark):
    documents = learned(spark, ("xa",)).unionByName(
        spark.createDataFrame([(9, "zyxwv", "xa")], "doc_id long, text string, lang string")
    )
    found, _ = lf.grams(["zyxwv"])
    assert lf.learn(documents).filters[0].holders(found).all()
    assert not lf.learn(documents, share=0.001).filters[0].holders(found).all()


def test_held_out_texts_of_many_languages_in_several_filters(spark, monkeypatch):
    documents = learned(spark)
    fresh = spark.createDataFrame(
        [(i, text_of(x, 500 + i, 6), x) for x in SYLLABLES for i in range(20)],
        "doc_id long, text string, lang string",
    )
    answers = []
    for bits, filters in ((lf.BITS, lf.FILTERS), (2, 1), (1, 3)):
        monkeypatch.setattr(lf, "BITS", bits)
        monkeypatch.setattr(lf, "FILTERS", filters)
        model = lf.learn(documents)
        assert len(model.filters) == -(-4 // bits)
        rows = lf.predict(fresh, model).collect()
        assert all(r.lang == r.lang_pred and 0.5 < r.score <= 1 for r in rows)
        answers.append([(r.doc_id, r.lang_pred) for r in rows])
    assert answers[0] == answers[1] == answers[2]


def test_odd_documents_and_clashing_columns(spark):
    documents = odd_documents(spark)
    model = lf.learn(documents)
    rows = lf.predict(clashing(documents).withColumn("lang_pred", F.lit("y")), model)
    assert set(rows.columns) == {*clashing(documents).columns, "lang_pred"}
    got = rows.collect()
    assert len(got) == documents.count()
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert 0 <= r.score <= 1 and (letters or r.score == 0)
    far = spark.createDataFrame([(1, "東京"), (2, "ß"), (3, "1 2")], "doc_id long, text string")
    assert [(r.lang_pred, r.score) for r in lf.predict(far, model).sort("doc_id").collect()] == [
        (model.common, 0.0), (model.common, 0.0), ("und", 0.0),
    ]


def test_empty_tables(spark):
    nothing = lf.learn(empty_documents(spark))
    assert nothing.filters == () and nothing.common is None
    rows = lf.predict(odd_documents(spark), nothing).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
    assert lf.predict(empty_documents(spark), lf.learn(odd_documents(spark))).count() == 0
    silent = spark.createDataFrame([(1, "123", "xx"), (2, "", "yy")], "doc_id long, text string, lang string")
    assert lf.learn(silent).filters == ()


def test_held_out_rule_without_id(spark):
    rows = spark.createDataFrame([(i,) for i in (None, 0, 1, 2, 17, 123456789)], "doc_id long")
    for r in rows.select("doc_id", lf.held_out().alias("out")).collect():
        key = b"" if r.doc_id is None else str(r.doc_id).encode()
        assert r.out == (zlib.crc32(key) % 3 == 1)


@pytest.mark.parametrize("name", ["op13_language_filters"])
def test_accuracy_on_held_out_rows(spark, name):
    rows = entry.queries()[name](spark, entry.FLAGSHIP_DATA)
    documents = table(spark, entry.FLAGSHIP_DATA, "documents").select("doc_id", "lang")
    met = rows.where("held_out").join(documents, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in met) >= 0.98 * len(met) > 0
