"""Properties of the mining operators, and brute-force twins on small frames."""

import math
import random
from itertools import combinations, product

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelsight.functions.columns import uniform
from parcelsight.operators import bayes, classify, cluster, evaluate, prep, rules
from parcelsight.sources.scratch import staged
from parcelsight.sources.writers import load_models, save_models


@pytest.fixture(scope="module")
def deliveries(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(1_500):
        distance, value = rng.uniform(0, 20), rng.uniform(1, 100)
        late = int(distance + 0.1 * value + rng.normal(0, 0.5) > 14)
        rows.append(
            (f"d{i}", float(distance), float(value) if i % 13 else None, float(rng.uniform(0.5, 5)),
             float(rng.uniform(0, 1)), float(rng.normal(20, 15)), late,
             str(rng.choice(["Low", "Medium", "High"])))
        )
    return spark.createDataFrame(
        rows,
        "delivery_id string, distance_km double, order_value double, agent_experience_years double,"
        "traffic_density_index double, delivery_time_min double, customer_complaint int,"
        "traffic_level string",
    ).cache()


@pytest.fixture(scope="module")
def prepared(deliveries):
    return prep.prepare(deliveries).cache()


def test_prepared_values(deliveries, prepared):
    rows = prepared.collect()
    known = sorted(r["order_value"] for r in deliveries.collect() if r["order_value"] is not None)
    middle = (known[(len(known) - 1) // 2] + known[len(known) // 2]) / 2
    filled = {r["delivery_id"]: r["order_value"] for r in rows}
    assert all(filled[f"d{i}"] == middle for i in range(0, 1_500, 13))
    assert min(r["delivery_time_min"] for r in rows) == 0.0


def test_components(prepared):
    x = np.array([[r[c] for c in prep.FEATURES] for r in prepared.collect()])
    got = np.array([[r["PC1"], r["PC2"]] for r in prepared.collect()])
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    _, _, axes = np.linalg.svd(z, full_matrices=False)
    for j in range(2):
        want = z @ axes[j]
        assert min(abs(got[:, j] - want).max(), abs(got[:, j] + want).max()) < 1e-8
    assert abs(got.mean(0)).max() < 1e-9 and abs(np.corrcoef(got.T)[0, 1]) < 1e-9
    assert got[:, 0].var() >= got[:, 1].var()


def test_split_takes_its_share_of_every_class(prepared):
    frame = prep.model_frame(prepared, ["delivery_id"])
    marked = prep.stratified_split(frame, "label", ["delivery_id"]).cache()
    again = prep.stratified_split(frame.repartition(3), "label", ["delivery_id"])
    assert sorted(marked.select("delivery_id", "is_train").collect()) == sorted(
        again.select("delivery_id", "is_train").collect()
    )
    for r in marked.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if("is_train").alias("k")
    ).collect():
        assert r["k"] == math.ceil(0.8 * r["n"])


@pytest.mark.parametrize("fit", [classify.fit_tree, classify.fit_forest, classify.fit_svm])
def test_models_beat_the_majority(prepared, fit):
    """Complaints follow distance and value, so every model must find some of it."""
    frame = prepared.withColumn("label", prep.recode("customer_complaint", prep.COMPLAINT_NAMES))
    marked = prep.stratified_split(frame, "label", ["delivery_id"]).cache()
    train, test = marked.filter("is_train"), marked.filter("NOT is_train")
    model = fit(train, numeric=["distance_km", "order_value"], categorical=["traffic_level"])
    scored = classify.predictions(model, test).cache()
    rows = scored.collect()
    right = sum(r["label"] == r["prediction"] for r in rows) / len(rows)
    majority = max(sum(r["label"] == k for r in rows) for k in ("Complaint", "No_Complaint"))
    assert right > max(0.85, majority / len(rows) + 0.1)
    assert evaluate.compare({"m": scored}).first()["accuracy"] == pytest.approx(right)
    assert all(abs(sum(r["probabilities"]) - 1) < 1e-9 for r in rows)
    bins = classify.probability_histogram(scored).collect()
    assert sum(b["n"] for b in bins) == len(rows) and all(0 <= b["bin"] < 20 for b in bins)


def test_rows_without_label_can_be_scored(prepared):
    train = prepared.withColumn("label", prep.recode("customer_complaint", prep.COMPLAINT_NAMES))
    model = classify.fit_tree(train)
    unknown = train.limit(5).withColumn("label", F.lit(None).cast("string"))
    scored = classify.predictions(model, unknown)
    assert scored.count() == 5 and scored.filter("prediction IS NULL").count() == 0


def test_kernel_svm_finds_a_ring(spark, tmp_path):
    rng = np.random.default_rng(2)
    points = rng.normal(0, 1, (1_500, 2))
    rows = [(float(a), float(b), "k", "in" if a * a + b * b < 1.2 else "out") for a, b in points]
    df = spark.createDataFrame(rows, "x double, y double, kind string, label string").cache()
    model = classify.fit_svm(df, numeric=["x", "y"], categorical=["kind"], gamma=0.5, max_iter=40)
    scored = classify.predictions(model, df)
    result = evaluate.compare({"svm": scored}).first()["accuracy"]
    assert result > 0.95
    paths = save_models({"svm": model}, evaluate.compare({"svm": scored}), str(tmp_path))
    models, accuracies = load_models(spark, paths)
    assert accuracies.first()["accuracy"] == result
    again = classify.predictions(models["svm"], df)
    assert evaluate.compare({"svm": again}).first()["accuracy"] == result


def test_scores_from_counts(spark):
    counts = spark.createDataFrame(
        [("a", "a", 6), ("a", "b", 2), ("b", "a", 1), ("b", "b", 11)],
        "label string, prediction string, n long",
    )
    got = evaluate.scores(counts, "m", "a").first()
    p, r = 6 / 7, 6 / 8
    assert got.asDict() == {
        "model": "m", "accuracy": pytest.approx(17 / 20), "precision": pytest.approx(p),
        "recall": pytest.approx(r), "f1": pytest.approx(2 * p * r / (p + r)),
    }
    never = evaluate.scores(counts, "m", "c").first()
    assert (never["precision"], never["recall"], never["f1"]) == (None, None, None)


def _naive_bayes(train, row, numeric, categorical):
    """Log score per class, by hand."""
    out = {}
    for k in sorted({t["label"] for t in train}):
        mine = [t for t in train if t["label"] == k]
        score = math.log(len(mine) / len(train))
        for c in numeric:
            xs = np.array([t[c] for t in mine if t[c] is not None])
            if row[c] is None:
                continue
            sd = xs.std(ddof=1) or 0.001
            density = math.exp(-(((row[c] - xs.mean()) / sd) ** 2) / 2) / (sd * math.sqrt(2 * math.pi))
            score += math.log(density or 0.001)
        for c in categorical:
            if row[c] is None or all(t[c] != row[c] for t in train):
                continue
            known = [t[c] for t in mine if t[c] is not None]
            score += math.log(known.count(row[c]) / len(known) or 0.001)
        out[k] = score
    return out


@pytest.mark.parametrize("levels", [1_000, 2])
def test_naive_bayes(spark, monkeypatch, levels):
    monkeypatch.setattr(bayes, "LITERAL_LEVELS", levels)
    rng = random.Random(7)
    rows = []
    for i in range(400):
        k = rng.choice(["no", "yes", "no"])
        x = None if i % 17 == 0 else rng.gauss(2.0 if k == "yes" else 0.0, 1.0)
        level = None if i % 19 == 0 else rng.choice("aab" if k == "yes" else "bbc")
        rows.append({"id": i, "label": k, "x": x, "flat": 1.0, "c": level})
    schema = "id int, label string, x double, flat double, c string"
    train = spark.createDataFrame(rows, schema)
    odd = [
        {"id": 900, "label": "no", "x": 60.0, "flat": 1.0, "c": "zzz"},
        {"id": 901, "label": "yes", "x": None, "flat": None, "c": None},
    ]
    model = bayes.fit(train, "label", ["x", "flat"], ["c"])
    assert bool(model.joined) == (levels == 2)
    got = bayes.predict(model, spark.createDataFrame(rows + odd, schema)).collect()
    assert len(got) == 402
    for r in got:
        want = _naive_bayes(rows, r.asDict(), ["x", "flat"], ["c"])
        assert r["score_no"] == pytest.approx(want["no"], abs=1e-8)
        assert r["score_yes"] == pytest.approx(want["yes"], abs=1e-8)
        assert r["prediction"] == max(sorted(want), key=lambda k: want[k])


def _all_rules(rows, columns, min_support, min_confidence):
    """Every rule by counting every item set in every row."""
    sets = [frozenset(f"{c}={r[c]}" for c in columns if r[c] is not None) for r in rows]
    n = len(rows)
    count = {}
    for s in sets:
        for size in range(1, len(s) + 1):
            for items in combinations(sorted(s), size):
                count[items] = count.get(items, 0) + 1
    count = {k: v for k, v in count.items() if v >= min_support * n}
    found = {}
    for items, freq in count.items():
        for right in items:
            left = tuple(i for i in items if i != right)
            if left and freq / count[left] >= min_confidence:
                confidence = freq / count[left]
                found["{" + ",".join(left) + "} => {" + right + "}"] = (
                    freq / n, confidence, count[left] / n, confidence / (count[(right,)] / n), freq,
                )
    return found


@pytest.mark.parametrize("method", ["subsets", "fpgrowth"])
def test_rules_against_counting(spark, method):
    rng = random.Random(11)
    columns = ["p", "q", "r"]
    rows = []
    for _ in range(600):
        p = rng.choice(["x", "x", "y", None])
        q = p if rng.random() < 0.7 else rng.choice("xyz")
        rows.append({"p": p, "q": q, "r": rng.choice("uv")})
    df = spark.createDataFrame(rows, "p string, q string, r string")
    got = {
        r["rules"]: (r["support"], r["confidence"], r["coverage"], r["lift"], r["count"])
        for r in rules.mine_rules(df, 0.05, 0.6, method).collect()
    }
    want = _all_rules(rows, columns, 0.05, 0.6)
    assert set(got) == set(want) and len(got) > 3
    for k, v in want.items():
        assert got[k] == pytest.approx(v)


@pytest.mark.parametrize("method", ["subsets", "fpgrowth"])
def test_wide_frames(spark, method):
    columns = [f"c{i}" for i in range(9)]
    cells = list(product("ab", repeat=2)) * 20
    rows = [tuple((a if i % 2 else b) for i in range(len(columns))) for a, b in cells]
    df = spark.createDataFrame(rows, columns)
    found = rules.frequent_itemsets(df, 0.5, method).collect()
    assert {(r["items"][0], r["freq"]) for r in found if len(r["items"]) == 1} == {
        (f"{c}={v}", 40) for c in columns for v in "ab"
    }
    assert all(r["freq"] >= 40 and r["total"] == 80 for r in found)


def test_rare_items_are_not_expanded(spark):
    """One attribute with a value of its own in each row: no set holds one of them."""
    rows = [(str(i), "x", "y" if i % 2 else "z") for i in range(200)]
    found = rules.frequent_itemsets(spark.createDataFrame(rows, ["id", "a", "b"]), 0.1).collect()
    assert {tuple(r["items"]) for r in found} == {
        ("a=x",), ("b=y",), ("b=z",), ("a=x", "b=y"), ("a=x", "b=z"),
    }


def test_split_of_very_many_classes(spark):
    rows = [(f"k{i}", f"c{i % 1500}" if i % 1501 else None) for i in range(6_000)]
    df = spark.createDataFrame(rows, "id string, label string")
    marked = prep.stratified_split(df, "label", ["id"])
    assert marked.count() == 6_000
    for r in marked.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_train").alias("k")).collect():
        assert r["k"] == math.ceil(0.8 * r["n"])


def test_trees_take_many_levels_and_missing_predictors(spark):
    rows = [
        (f"level{i % 40}" if i % 7 else None, float(i % 11) if i % 5 else (None if i % 2 else float("nan")),
         "yes" if i % 40 < 20 else "no")
        for i in range(800)
    ]
    df = spark.createDataFrame(rows, "c string, x double, label string")
    for fit in (classify.fit_tree, classify.fit_forest):
        scored = classify.predictions(fit(df, numeric=["x"], categorical=["c"]), df).collect()
        assert len(scored) == 800 and all(r["prediction"] in ("yes", "no") for r in scored)
        known = [r for r in scored if r["c"]]
        assert sum(r["label"] == r["prediction"] for r in known) > 0.95 * len(known)


def test_svm_leaves_out_rows_with_missing_predictors(spark):
    rows = [(float(i % 10), "a" if i % 10 < 5 else "b") for i in range(300)]
    rows += [(None, "a"), (float("nan"), "b")]
    df = spark.createDataFrame([(x, "k", y) for x, y in rows], "x double, c string, label string")
    model = classify.fit_svm(df, numeric=["x"], categorical=["c"])
    got = classify.predictions(model, df).collect()
    assert len(got) == 302
    assert sum(r["prediction"] is None for r in got) == 2
    assert sum(r["probabilities"] is None for r in got) == 2
    assert sum(r["prediction"] == r["label"] for r in got) > 285


def test_bayes_of_many_classes_is_stored(spark, tmp_path):
    rows = [(f"c{i % 1100}", float(i % 1100) + (i % 3) / 10) for i in range(3_300)]
    df = spark.createDataFrame(rows, "label string, x double")
    model = bayes.fit(df, "label", ["x"], [])
    assert len(model.labels) == 1_100
    few = bayes.fit(df.where("x < 30").withColumn("c", F.col("label")), "label", ["x"], ["c"])
    again = bayes.NaiveBayesModel.load(spark, few.save(spark, str(tmp_path / "bayes")))
    test = df.where("x < 30").withColumn("c", F.col("label"))
    one, two = (sorted(map(tuple, bayes.predict(m, test).collect())) for m in (few, again))
    assert one == two and all(r[0] == r[-1] for r in one)


def test_stored_preparation_keeps_its_scale(spark, deliveries, tmp_path):
    fitted = prep.fit_preparation(deliveries)
    loaded = prep.Preparation.load(spark, fitted.save(spark, str(tmp_path / "prep")))
    new = deliveries.limit(7)
    one, two = (sorted(map(tuple, p.apply(new).collect())) for p in (fitted, loaded))
    assert one == two
    whole = {r["delivery_id"]: (r["PC1"], r["PC2"]) for r in prep.prepare(deliveries).collect()}
    assert all(whole[r["delivery_id"]] == (r["PC1"], r["PC2"]) for r in loaded.apply(new).collect())


def test_nan_features_are_missing(spark):
    rows = [(i, float(i % 3) * 5 + i / 100, float(i % 3)) for i in range(60)] + [(99, float("nan"), 1.0), (98, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    for make, name in ((cluster.kmeans, "cluster"), (cluster.lloyd, "cluster"), (cluster.bisecting, "cluster_hierarchical")):
        got = {r["id"]: r[name] for r in make(df, ["a", "b"]).collect()}
        assert len(got) == 62 and got[99] is None and got[98] is None
        assert {got[i] for i in range(60)} == {1, 2, 3}
    filled = {r["id"]: r["a"] for r in prep.impute_median(df, "a").collect()}
    known = sorted(a for _, a, _ in rows[:60])
    assert filled[99] == filled[98] == (known[29] + known[30]) / 2


def test_lloyd_steps_find_the_blobs(spark):
    rng = np.random.default_rng(8)
    rows = [(i, *map(float, rng.normal(3 * (i % 3), 0.7, 3))) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    got = cluster.lloyd(df, ["a", "b", "c"]).collect()
    assert sum(r["cluster"] == r["id"] % 3 + 1 for r in got) > 295


def test_kmeans_assigns_the_nearest_centre(spark):
    rng = np.random.default_rng(8)
    rows = [(i, *map(float, rng.normal(3 * (i % 3), 0.7, 3))) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    got = cluster.kmeans(df, ["a", "b", "c"]).collect()
    assert {r["cluster"] for r in got} == {1, 2, 3}
    x = np.array([[r["a"], r["b"], r["c"]] for r in got])
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    label = np.array([r["cluster"] for r in got])
    centres = np.array([z[label == k].mean(0) for k in (1, 2, 3)])
    distance = ((z[:, None, :] - centres[None]) ** 2).sum(2)
    assert (distance.argmin(1) + 1 == label).mean() > 0.99
    assert distance.min(1).sum() < 0.5 * (z**2).sum()
    assert list(centres[:, 0]) == sorted(centres[:, 0])


def test_bisecting_separates_blobs(spark):
    rng = np.random.default_rng(4)
    rows = [(i, *map(float, rng.normal(6 * (i % 3), 0.4, 2))) for i in range(150)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    found: dict[int, set] = {}
    for r in cluster.bisecting(df, ["a", "b"]).collect():
        found.setdefault(r["cluster_hierarchical"], set()).add(r["id"] % 3)
    assert sorted(map(tuple, found.values())) == [(0,), (1,), (2,)]


def test_lloyd_says_when_centres_still_move(spark):
    df = spark.createDataFrame([(float(i * i),) for i in range(60)], "a double")
    with pytest.raises(RuntimeError, match="still move after 2 steps"):
        cluster.lloyd(df, ["a"], steps=2)
    assert cluster.lloyd(df, ["a"]).select("cluster").distinct().count() == 3


def test_lloyd_goes_on_until_no_centre_moves(spark):
    """More than 100 steps, which were an error before; the same clusters as by numpy."""
    k, x = 12, np.arange(2000.0) ** 2
    z = (x - x.mean()) / x.std(ddof=1)
    centres, taken = (2 * np.arange(k) + 1) / k - 1, 0
    while True:
        label = np.abs(z[:, None] - centres).argmin(1)
        moved = np.array([z[label == i].mean() if (label == i).any() else centres[i] for i in range(k)])
        taken += 1
        if np.abs(moved - centres).max() <= 1e-12:
            break
        centres = moved
    assert taken > 100
    df = spark.createDataFrame([(v,) for v in x.tolist()], "a double").coalesce(1)
    got = sorted((r["a"], r["cluster"]) for r in cluster.lloyd(df, ["a"], k=k).collect())
    assert [c for _, c in got] == (np.argsort(np.argsort(centres))[label] + 1).tolist()


def test_probabilities_are_cross_fitted_and_calibrated(spark):
    """The curve comes from margins of rows that their model has not seen, and its chances hold."""
    from pyspark.ml.classification import LogisticRegressionModel

    drawn = np.random.default_rng(4)
    rows = []
    for i in range(3000):
        a, b = map(float, drawn.normal(size=2))
        rows.append((i, a, b, "u", "v", "yes" if drawn.random() < 1 / (1 + np.exp(-2 * a)) else "no"))
    df = staged(
        spark.createDataFrame(rows, "id long, PC1 double, PC2 double, order_segment string, traffic_level string, label string"),
        "rows",
    )
    seen = []
    plain = classify.held_out_margins

    def watched(frame, fitted, folds):
        out = plain(frame, fitted, folds)
        seen.append((frame.toPandas(), out.select("margin", "label_code", "_fold").toPandas()))
        return out

    classify.held_out_margins = watched
    try:
        model = classify.fit_svm(df.where("id < 2000"), key=["id"], max_iter=30, features=32)
    finally:
        classify.held_out_margins = plain
    (design, held), curve = seen[0], next(s for s in model.stages if isinstance(s, LogisticRegressionModel))
    assert len(held) == len(design) == 2000 and set(design["_fold"]) == {0, 1, 2}
    x, y = np.array([m[1] for m in held["margin"]]), held["label_code"].to_numpy()

    def loss(slope, shift):
        z = slope * x + shift
        return float(np.mean(np.log1p(np.exp(-z)) + (1 - y) * z))

    slope = float(curve.coefficients[1] - curve.coefficients[0])
    found = loss(slope, float(curve.intercept))
    around = [loss(slope * s, float(curve.intercept) + d) for s in (0.9, 1.0, 1.1) for d in (-0.1, 0.0, 0.1)]
    assert found <= min(around) + 1e-4
    test = classify.predictions(model, df.where("id >= 2000")).toPandas()
    chance = np.array([p[1] for p in test["probabilities"]])
    truth = (test["label"] == "yes").to_numpy()
    for low in (0.0, 0.25, 0.5, 0.75):
        some = (chance >= low) & (chance < low + 0.25)
        if some.sum() >= 50:
            assert abs(chance[some].mean() - truth[some].mean()) < 0.1
    one = classify.fit_svm(df.where("id < 200"), max_iter=10, features=16, folds=1)
    assert classify.predictions(one, df.limit(5)).count() == 5


def test_svms_fitted_side_by_side_are_linear_svcs(spark, monkeypatch):
    """The same models as LinearSVC fits one after the other; a pass over the rows for each step of all."""
    from pyspark.ml.classification import LinearSVC, LinearSVCModel

    from parcelsight.operators import svm

    drawn = np.random.default_rng(5)
    rows = []
    for i in range(400):
        a, b = map(float, drawn.normal(size=2))
        kind = "uvw"[i % 3]
        rows.append((i, a, b, kind, "hl"[i % 2], "yes" if a * b + (kind == "u") + drawn.normal() > 0.5 else "no"))
    rows += [(400, None, 0.0, "u", "h", "yes"), (401, 0.0, float("nan"), "u", "h", "no"), (402, 0.0, 0.0, None, "h", "no")]
    columns = "id long, PC1 double, PC2 double, order_segment string, traffic_level string, label string"
    df = staged(spark.createDataFrame(rows, columns).coalesce(2), "rows")
    passes, plain = [], svm._losses
    monkeypatch.setattr(svm, "_losses", lambda *a: passes.append(len(a[2])) or plain(*a))
    found = []
    searched = svm._searched
    monkeypatch.setattr(svm, "_searched", lambda *a: found.append(searched(*a)) or found[0])
    model = classify.fit_svm(df, key=["id"], max_iter=25, features=24)
    assert len(passes) <= 40  # some 25 steps of four models, each with a point or more
    final = next(s for s in model.stages if isinstance(s, LinearSVCModel))
    design = model.stages[1].transform(model.stages[0].transform(df)).where("_known")
    fold = F.floor(uniform(["id"], "svm-fold") * 3).cast("int")
    design = design.select("features", F.expr("if(label = 'yes', 1D, 0D)").alias("y"), fold.alias("f")).coalesce(1).persist()
    assert design.count() == 400
    for at, some in enumerate([design, *[design.where(F.col("f") != i) for i in range(3)]]):
        plainly = LinearSVC(
            labelCol="y", regParam=1.0 / some.count(), maxIter=25, standardization=False, tol=1e-4
        ).fit(some)
        np.testing.assert_allclose(found[0][1][at, :-1], plainly.coefficients.toArray(), rtol=1e-5, atol=1e-6)
        assert found[0][1][at, -1] == pytest.approx(plainly.intercept, rel=1e-5, abs=1e-6)
    np.testing.assert_array_equal(final.coefficients.toArray(), found[0][1][0, :-1])
    design.unpersist()
