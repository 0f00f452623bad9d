"""Fits that new rows are added to, against fits of all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelsight.operators import bayes, prep
from parcelsight.sources.scratch import scratch_path, staged


def rows(spark, n=400):
    made = np.random.default_rng(2)
    values = [
        (
            i,
            float(made.normal(5, 2)) if i % 17 else None,
            float(made.gamma(2, 20)) if i % 11 else None,
            float(1e6 + made.normal()),
            float(made.integers(0, 3)),
            float(made.normal(30, 5)),
            ["low", "high", None, f"x{i % 7}"][i % 4],
            ["No_Complaint", "Complaint", "Complaint", None][i % 4] if i % 5 else "No_Complaint",
        )
        for i in range(n)
    ]
    names = ", ".join(f"{c} double" for c in (*prep.FEATURES, "delivery_time_min"))
    return staged(spark.createDataFrame(values, f"id long, {names}, level string, label string"), "rows")


def test_moments_of_parts_merge_to_those_of_the_whole(spark):
    df = prep.fill(rows(spark), "order_value", 30.0)
    whole = prep.fit_moments(df)
    held = prep.fit_moments(df.where("id < 0"))
    assert held.n == 0 and np.isnan(held.sd).all()
    for part in range(5):
        held = held.merged(prep.fit_moments(df.where(f"id % 5 = {part}")))
    assert held.n == whole.n
    for name in ("mean", "comoment", "sd", "correlation"):
        assert np.allclose(getattr(held, name), getattr(whole, name), rtol=1e-9, atol=1e-9), name
    complete = df.toPandas()[list(prep.FEATURES)].dropna()
    assert np.allclose(whole.sd, complete.std(ddof=1)) and np.allclose(whole.correlation, complete.corr())
    with pytest.raises(ValueError):
        held.merged(prep.fit_moments(df, ["distance_km"]))


def test_a_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 2.0)], "a double, b double")
    moments = prep.fit_moments(df, ["a", "b"])
    assert np.isnan(moments.correlation[0, 1]) and moments.sd[1] == 0
    assert prep.correlation_row(df, ["a", "b"]).first()["corr_0_1"] is None


def test_an_extended_preparation_equals_one_of_all_rows(spark):
    df = rows(spark)
    first = prep.fit_preparation(df.where("id % 3 > 0"))
    path = first.save(spark, scratch_path(spark, "prep"))
    extended = prep.Preparation.load(spark, path).extended(df.where("id % 3 = 0"))
    again = prep.fit_moments(prep.fill(df, "order_value", first.median))
    assert extended.median == first.median
    pairs = zip(*(prep.Preparation(first.median, m).apply(df).orderBy("id").collect() for m in (extended.moments, again)))
    for a, b in pairs:
        assert (a.PC1 is None) == (b.PC1 is None)
        assert a.PC1 is None or np.allclose([a.PC1, a.PC2], [b.PC1, b.PC2], atol=1e-9)


def test_merged_counts_give_the_model_of_all_rows(spark):
    df = rows(spark)
    args = ("label", ["distance_km", "order_value"], ["level"])
    whole = bayes.fit(df, *args)
    held = bayes.count(df.where("id < 0"), *args)
    for part in range(3):
        held = held.merged(bayes.count(df.where(f"id % 3 = {part}"), *args))
        held = bayes.Counts.load(spark, held.save(spark, scratch_path(spark, "counts")))
    model = held.model()
    assert model.labels == whole.labels and model.shares == whole.shares
    assert all(abs(model.prior[k] - whole.prior[k]) < 1e-12 for k in whole.labels)
    assert model.normal.keys() == whole.normal.keys()
    for key, two in whole.normal.items():
        assert np.allclose(model.normal[key], two, rtol=1e-9)
    said = [bayes.predict(m, df).orderBy("id").select(F.col("prediction")).collect() for m in (model, whole)]
    assert said[0] == said[1]
    with pytest.raises(ValueError):
        held.merged(bayes.count(df, "label", ["distance_km"], []))


def test_one_row_and_missing_numbers(spark):
    df = spark.createDataFrame([("a", None, "u"), ("b", 2.0, "u")], "label string, x double, level string")
    model = bayes.fit(df, "label", ["x"], ["level"])
    assert model.normal == {("x", "a"): (None, bayes.FLOOR), ("x", "b"): (2.0, bayes.FLOOR)}
