import numpy as np
from pyspark.sql import functions as F

from helpers import clashing, empty_documents, odd_documents, odd_rows
from parcelsight.llm import ordinal

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").withColumn("held", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    model = ordinal.train(documents, labels.where("NOT held"))
    rated = ordinal.rate(documents.select("doc_id", "text"), model)
    rows = rated.join(labels.where("held"), "doc_id").select(
        "selected", "expected_grade", ordinal.grade().alias("grade")
    ).toPandas()
    good = rows["grade"] == 2
    assert (rows["selected"] == good).mean() > 0.97
    assert rows[good]["selected"].mean() > 0.97
    assert rows[rows["grade"] == 0]["selected"].mean() < 0.08
    means = rows.groupby("grade")["expected_grade"].mean()
    assert means[0] < means[1] < means[2]


def test_thresholds_rise_and_chances_fall():
    texts = ["bad awful"] * 20 + ["plain text"] * 20 + ["fine good"] * 20 + ["best great"] * 20
    model = ordinal.fit(texts, np.repeat(np.arange(4), 20), levels=4)
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.tails(*ordinal.features(["bad awful", "plain text", "fine good", "best great"]))
    assert (np.diff(tails, axis=1) < 0).all()
    assert (np.diff(tails.sum(axis=1)) > 0).all()
    assert np.round(tails.sum(axis=1)).tolist() == [0, 1, 2, 3]


def test_sample_is_bounded_and_takes_the_lowest_grade(spark):
    documents = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (6, 0, None), (7, None, 0), (None, 1, 0), (99, 1, 0)], LABELS)
    found = ordinal.labelled_sample(documents, labels).collect()
    assert sorted(map(tuple, found)) == sorted([(odd_rows()[0][1], 0), ("same text here", 1), ("same text here", 1)])
    assert ordinal.labelled_sample(documents, labels, limit=1).count() == 1


def test_odd_rows(spark):
    documents = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1)], LABELS)
    model = ordinal.train(documents, labels)
    rows = clashing(documents)
    out = ordinal.rate(rows, model)
    assert out.columns == [*rows.columns, "expected_grade", "tail_probability", "selected"]
    got = out.collect()
    assert len(got) == len(odd_rows())
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.tail_probability <= 1 for r in got)
    assert not any(r.selected for r in got if not r.text)
    same = {(r.expected_grade, r.tail_probability) for r in got if r.text == "same text here"}
    assert len(same) == 1
    again = ordinal.rate(out, model)
    assert again.columns == out.columns
    prior = ordinal.train(empty_documents(spark), labels)
    assert ordinal.rate(empty_documents(spark), prior).collect() == []
    assert ordinal.rate(documents, prior).count() == len(odd_rows())


def loss(texts, grades, weights, thresholds, decay=1e-4):
    """Likelihood by its definition: grades weigh the same, a grade's chance is a difference of tails."""
    total = 0.0
    for text, grade in zip(texts, grades):
        index, value, _ = ordinal.features([text])
        score = float((weights[index] * value).sum())
        above = [1.0, *[1 / (1 + np.exp(t - score)) for t in thresholds], 0.0]
        total -= np.log(above[grade] - above[grade + 1]) / list(grades).count(grade) / len(set(grades))
    return total + decay / 2 * float((weights**2).sum())


def test_no_step_from_the_fit_is_better():
    drawn = np.random.default_rng(3)
    words = ["bad", "poor", "plain", "fine", "great"]
    grades = drawn.integers(0, 3, 60)
    texts = [" ".join(words[min(4, max(0, g + int(drawn.integers(0, 3))))] for _ in range(3)) for g in grades]
    model = ordinal.fit(texts, grades, steps=6000, rate=0.01)
    least = loss(texts, grades, model.weights, model.thresholds)
    assert least < loss(texts, grades, np.zeros_like(model.weights), model.thresholds) - 0.1
    used = np.flatnonzero(model.weights)
    for _ in range(30):
        moved = model.weights.copy()
        moved[used] += drawn.normal(0, 0.05, len(used))
        cuts = np.sort(model.thresholds + drawn.normal(0, 0.05, 2))
        assert loss(texts, grades, moved, cuts) > least - 1e-5


def test_sparse_rows_give_the_fit_of_the_texts(spark):
    drawn = np.random.default_rng(5)
    words = ["bad", "poor", "plain", "fine", "great", "x" * 40]
    rows = [(i, " ".join(drawn.choice(words[g : g + 4], 5)), int(g)) for i, g in enumerate(drawn.integers(0, 3, 90))]
    rows += [(90, None, 0), (91, "", 1)]
    documents = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(g > 1), int(g == 0)) for i, _, g in rows], LABELS)
    found = ordinal.train(documents, labels)
    plain = ordinal.fit([t for _, t, _ in rows], np.array([g for _, _, g in rows]))
    assert np.allclose(found.weights, plain.weights, atol=1e-4)
    assert np.allclose(found.thresholds, plain.thresholds, atol=1e-4)
