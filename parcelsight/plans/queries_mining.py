"""Queries for preprocessing, outliers, classification and clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelsight.operators import (
    bayes,
    classify,
    cluster,
    evaluate,
    olap,
    outliers,
    prep,
    tree,
    ward,
)
from parcelsight.operators.numbering import exact_median
from parcelsight.plans.queries_olap import performance
from parcelsight.plans.registry import query, rounded
from parcelsight.plans.star import DeliveryStar, sql_uniform
from parcelsight.sources.scratch import scratch_path, staged
from parcelsight.sources.writers import load_models, save_models

SEGMENT = """CASE WHEN order_value <= 25 THEN 'Low Value' WHEN order_value <= 60 THEN 'Medium Value'
    WHEN order_value > 60 THEN 'High Value' END"""
# The feature columns with repaired values.
_CLEAN = """clean AS (SELECT * REPLACE (
        coalesce(order_value_raw, (SELECT quantile_cont(order_value_raw, 0.5) FROM fact_delivery))
            AS order_value,
        CASE WHEN delivery_time_raw < 0 THEN 0.0::DOUBLE ELSE delivery_time_raw END
            AS delivery_time_raw)
    FROM fact_delivery)"""


def _features(star: DeliveryStar, *more: str):
    names = [c for c in prep.FEATURES if c != "order_value"]
    facts = star.deliveries("delivery_id", *names, "order_value_raw", *more)
    return facts.withColumnRenamed("order_value_raw", "order_value")


@query(
    "median_order_value",
    "AGG-18",
    """SELECT round(quantile_cont(order_value_raw, 0.5), 9) AS median_value,
        count(order_value_raw) AS known FROM fact_delivery""",
)
def median_order_value(star: DeliveryStar):
    facts = star.deliveries("order_value_raw")
    median = exact_median(facts, "order_value_raw")
    return facts.agg(F.count("order_value_raw").alias("known")).select(
        F.round(F.lit(median), 9).alias("median_value"), "known"
    )


@query(
    "repaired_deliveries",
    "ML-01 ML-02 FN-06 FN-15",
    f"""WITH {_CLEAN} SELECT delivery_id, round(order_value, 9) AS order_value,
        delivery_time_raw AS delivery_time_min FROM clean""",
)
def repaired_deliveries(star: DeliveryStar):
    facts = star.deliveries("delivery_id", "order_value_raw", "delivery_time_raw").toDF(
        "delivery_id", "order_value", "delivery_time_min"
    )
    fixed = prep.repair_times(prep.impute_median(facts, "order_value"))
    return rounded(fixed, 9, "order_value")


_SCALED = ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS {c}" for c in prep.FEATURES
)


@query(
    "scaled_features",
    "ML-03",
    f"WITH {_CLEAN} SELECT delivery_id, {_SCALED} FROM clean",
)
def scaled_features(star: DeliveryStar):
    clean = prep.impute_median(_features(star), "order_value")
    scaled = rounded(prep.standardize(clean), 6, *prep.FEATURES)
    return scaled.select("delivery_id", *prep.FEATURES)


_MOMENTS = [f"round(avg({c}), 6) AS mean_{i}, round(stddev_samp({c}), 6) AS sd_{i}"
            for i, c in enumerate(prep.FEATURES)]
_PAIRS = [
    f"round(corr({a}, {b}), 6) AS corr_{i}_{j}"
    for i, a in enumerate(prep.FEATURES)
    for j, b in enumerate(prep.FEATURES)
    if i < j
]


@query(
    "feature_correlations",
    "ML-03 ML-04",
    f"WITH {_CLEAN} SELECT {', '.join(_MOMENTS + _PAIRS)} FROM clean",
)
def feature_correlations(star: DeliveryStar):
    row = prep.correlation_row(prep.impute_median(_features(star), "order_value"))
    return rounded(row, 6, *row.columns)


def _pca_sql() -> str:
    """Leading eigenvectors of the correlation matrix by repeated squaring, in SQL.

    The matrix is squared (and scaled by its trace) until only the leading direction is
    left; the second direction is found the same way after taking the first one out.
    """
    k = range(4)
    cells = [(i, j) for i in k for j in k if i <= j]

    def cell(i: int, j: int, p: str = "m") -> str:
        return f"{p}{min(i, j)}{max(i, j)}"

    names = ", ".join(cell(*c) for c in cells)
    trace = "(" + " + ".join(f"({' + '.join(f'{cell(i, t)} * {cell(t, i)}' for t in k)})" for i in k) + ")"
    squared = ", ".join(
        f"({' + '.join(f'{cell(i, t)} * {cell(t, j)}' for t in k)}) / {trace}" for i, j in cells
    )
    corr = ", ".join(
        "1.0::DOUBLE AS " + cell(i, j)
        if i == j
        else f"corr({prep.FEATURES[i]}, {prep.FEATURES[j]}) AS {cell(i, j)}"
        for i, j in cells
    )
    # The power of the matrix is v v' up to size: the column of its largest diagonal cell
    # is the direction, and its largest entry is made positive.
    ctes = [f"base1 AS (SELECT {corr} FROM clean)"]
    for p in (1, 2):
        ctes.append(
            f"power{p}(step, {names}) AS (SELECT 0, {names} FROM base{p} UNION ALL"
            f" SELECT step + 1, {squared} FROM power{p} WHERE step < 40)"
        )
        top = f"greatest({', '.join(cell(i, i) for i in k)})"
        pick = [
            "CASE " + " ".join(f"WHEN {cell(d, d)} = {top} THEN {cell(i, d)}" for d in k) + " END"
            for i in k
        ]
        raw = ", ".join(f"{e} AS r{i}" for i, e in enumerate(pick))
        norm = "sqrt(" + " + ".join(f"r{i} * r{i}" for i in k) + ")"
        unit = ", ".join(f"r{i} / {norm} AS v{i}" for i in k)
        ctes.append(
            f"vector{p} AS (SELECT {unit} FROM (SELECT {raw} FROM power{p} WHERE step = 40))"
        )
        # The diagonal cell is its own square root's square, so the largest entry is positive.
        if p == 1:
            value = " + ".join(f"v{i} * v{j} * {cell(i, j)}" for i in k for j in k)
            ctes.append(f"lead1 AS (SELECT *, {value} AS size1 FROM base1, vector1)")
            rest = ", ".join(f"{cell(i, j)} - size1 * v{i} * v{j} AS {cell(i, j)}" for i, j in cells)
            ctes.append(f"base2 AS (SELECT {rest} FROM lead1)")
    z = [f"(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ())" for c in prep.FEATURES]
    score = [
        " + ".join(f"{z[i]} * (SELECT v{i} FROM vector{p})" for i in k) + f" AS PC{p}" for p in (1, 2)
    ]
    ctes.append(f"scored AS (SELECT *, {', '.join(score)} FROM clean)")
    return ",\n".join(ctes)


_PCA = f"WITH RECURSIVE {_CLEAN}, {_pca_sql()}"


@query(
    "principal_components",
    "ML-04 ML-05 PRJ-06",
    f"""{_PCA} SELECT delivery_id, round(PC1, 6) AS PC1, round(PC2, 6) AS PC2,
        {SEGMENT} AS order_segment FROM scored""",
)
def principal_components(star: DeliveryStar):
    prepared = prep.prepare(staged(_with_time(star), "features"))
    return rounded(prepared, 6, "PC1", "PC2").select("delivery_id", "PC1", "PC2", "order_segment")


def _with_time(star: DeliveryStar, *more: str):
    return _features(star, "delivery_time_raw", *more).withColumnRenamed(
        "delivery_time_raw", "delivery_time_min"
    )


@query(
    "order_segments",
    "ML-05 AGG-14 FN-10",
    f"SELECT {SEGMENT} AS order_segment, count(*) AS n FROM fact_delivery GROUP BY 1",
)
def order_segments(star: DeliveryStar):
    return olap.count_by(prep.segment_orders(star.deliveries("order_value")), "order_segment")


_LABEL = "CASE customer_complaint WHEN 0 THEN 'No_Complaint' WHEN 1 THEN 'Complaint' END"
_DRAWN = f"""drawn AS (SELECT delivery_id, {_LABEL} AS label, distance_km, order_value,
        {SEGMENT} AS order_segment, traffic_level, {sql_uniform("delivery_id", "split123")} AS u
    FROM fact_delivery),
    limits AS (SELECT label, quantile_disc(u, 0.8) AS t FROM drawn GROUP BY label),
    marked AS (SELECT drawn.* EXCLUDE (u), u <= t AS is_train FROM drawn JOIN limits USING (label))"""


def _labelled(star: DeliveryStar):
    facts = star.deliveries(
        "delivery_id", "customer_complaint", "distance_km", "order_value", "traffic_level"
    )
    named = prep.recode("customer_complaint", prep.COMPLAINT_NAMES)
    return prep.segment_orders(facts).withColumn("label", named).drop("customer_complaint")


def _marked(star: DeliveryStar):
    return prep.stratified_split(_labelled(star), "label", ["delivery_id"], 0.8, 123)


@query(
    "model_frame",
    "ML-06 FN-13",
    f"""{_PCA} SELECT delivery_id, {_LABEL} AS label, round(PC1, 6) AS PC1, round(PC2, 6) AS PC2,
        {SEGMENT} AS order_segment, traffic_level FROM scored""",
)
def model_frame(star: DeliveryStar):
    features = _with_time(star, "customer_complaint", "traffic_level")
    prepared = prep.prepare(staged(features, "features"))
    return rounded(prep.model_frame(prepared, ["delivery_id"]), 6, "PC1", "PC2")


@query(
    "stratified_split",
    "ML-07",
    f"WITH {_DRAWN} SELECT delivery_id, label, is_train FROM marked",
)
def stratified_split(star: DeliveryStar):
    return _marked(star).select("delivery_id", "label", "is_train")


_BAYES = (
    _DRAWN
    + """,
    train AS (SELECT * FROM marked WHERE is_train),
    test AS (SELECT * FROM marked WHERE NOT is_train),
    classes AS (SELECT label, ln(count(*)::DOUBLE / (SELECT count(*) FROM train)) AS prior,
        avg(distance_km) AS m1, stddev_samp(distance_km) AS s1,
        avg(order_value) AS m2, stddev_samp(order_value) AS s2 FROM train GROUP BY label),
    seg AS (SELECT label, order_segment, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY label)
        AS p FROM train GROUP BY label, order_segment),
    traffic AS (SELECT label, traffic_level, count(*)::DOUBLE / sum(count(*))
        OVER (PARTITION BY label) AS p FROM train GROUP BY label, traffic_level),
    scores AS (SELECT t.delivery_id, t.label, t.distance_km, t.order_value, c.label AS said,
        prior - 0.5 * ((t.distance_km - m1) / s1) ** 2 - ln(s1) - 0.5 * ln(2 * pi())
            - 0.5 * ((t.order_value - m2) / s2) ** 2 - ln(s2) - 0.5 * ln(2 * pi())
            + ln(coalesce(g.p, 0.001)) + ln(coalesce(w.p, 0.001)) AS score
        FROM test t CROSS JOIN classes c
        LEFT JOIN seg g ON g.label = c.label AND g.order_segment = t.order_segment
        LEFT JOIN traffic w ON w.label = c.label AND w.traffic_level = t.traffic_level),
    said AS (SELECT delivery_id, label, distance_km, order_value,
        max(score) FILTER (said = 'Complaint') AS complaint_score,
        max(score) FILTER (said = 'No_Complaint') AS fine_score
        FROM scores GROUP BY ALL),
    predicted AS (SELECT delivery_id, label, complaint_score, fine_score,
        CASE WHEN complaint_score >= fine_score THEN 'Complaint' ELSE 'No_Complaint' END AS prediction
        FROM said)"""
)


def _bayes_test(star: DeliveryStar):
    marked = staged(_marked(star), "marked")
    model = bayes.fit(
        marked.filter("is_train"),
        "label",
        ["distance_km", "order_value"],
        ["order_segment", "traffic_level"],
    )
    return bayes.predict(model, marked.filter("NOT is_train"))


@query(
    "naive_bayes_scores",
    "ML-09",
    f"""WITH {_BAYES} SELECT delivery_id, label, round(complaint_score, 6) AS complaint_score,
        round(fine_score, 6) AS fine_score, prediction FROM predicted""",
)
def naive_bayes_scores(star: DeliveryStar):
    scored = _bayes_test(star).withColumnsRenamed(
        {"score_Complaint": "complaint_score", "score_No_Complaint": "fine_score"}
    )
    return rounded(scored, 6, "complaint_score", "fine_score").select(
        "delivery_id", "label", "complaint_score", "fine_score", "prediction"
    )


@query(
    "naive_bayes_confusion",
    "ML-11",
    f"WITH {_BAYES} SELECT label, prediction, count(*) AS n FROM predicted GROUP BY label, prediction",
)
def naive_bayes_confusion(star: DeliveryStar):
    return evaluate.confusion(_bayes_test(star))


@query(
    "naive_bayes_quality",
    "ML-11 ML-12",
    f"""WITH {_BAYES}, hits AS (SELECT
        count(*) FILTER (label = prediction)::DOUBLE / count(*) AS accuracy,
        count(*) FILTER (label = 'No_Complaint' AND prediction = label)::DOUBLE
            / count(*) FILTER (prediction = 'No_Complaint') AS precision,
        count(*) FILTER (label = 'No_Complaint' AND prediction = label)::DOUBLE
            / count(*) FILTER (label = 'No_Complaint') AS recall FROM predicted)
    SELECT 'Naive Bayes' AS model, round(accuracy, 9) AS accuracy, round(precision, 9) AS precision,
        round(recall, 9) AS recall, round(2 * precision * recall / (precision + recall), 9) AS f1
    FROM hits""",
)
def naive_bayes_quality(star: DeliveryStar):
    quality = evaluate.compare({"Naive Bayes": _bayes_test(star)}, "No_Complaint")
    return rounded(quality, 9, "accuracy", "precision", "recall", "f1")


_ANOMALY = """diffs AS (SELECT delivery_id, city_id, distance_km, delivery_time_min, sla_min,
        delivery_time_min - sla_min AS delay_diff FROM fact_delivery),
    scored AS (SELECT *, (delay_diff - avg(delay_diff) OVER ()) / stddev_samp(delay_diff) OVER ()
        AS z_delay FROM diffs)"""


@query(
    "delay_anomalies",
    "OUT-01",
    f"""WITH {_ANOMALY} SELECT delivery_id, city_id, distance_km, delivery_time_min, sla_min,
        delay_diff, round(z_delay, 6) AS z_delay FROM scored WHERE abs(z_delay) > 1.75""",
)
def delay_anomalies(star: DeliveryStar):
    return rounded(_anomalies(star), 6, "z_delay")


def _anomalies(star: DeliveryStar):
    facts = star.deliveries("delivery_id", "city_id", "distance_km", "delivery_time_min", "sla_min")
    times = star.deliveries("delivery_time_min", "sla_min")
    return outliers.delay_anomalies(facts, 1.75, times)


@query(
    "order_outliers",
    "OUT-02",
    """SELECT delivery_id, distance_km, order_value,
        abs((distance_km - avg(distance_km) OVER ()) / stddev_samp(distance_km) OVER ()) > 1.6
        OR abs((order_value - avg(order_value) OVER ()) / stddev_samp(order_value) OVER ()) > 1.6
            AS is_outlier FROM fact_delivery""",
)
def order_outliers(star: DeliveryStar):
    facts = star.deliveries("delivery_id", "distance_km", "order_value")
    return outliers.flag_outliers(facts, ["distance_km", "order_value"], 1.6)


@query(
    "executive_summary",
    "AGG-20",
    f"""WITH {_BAYES}, {_ANOMALY}
    SELECT (SELECT count(*) FROM fact_delivery) AS total_records,
        (SELECT round(avg(CAST(label = prediction AS INTEGER)), 9) FROM predicted) AS avg_accuracy,
        (SELECT count(*) FROM scored WHERE abs(z_delay) > 1.75) AS outlier_count""",
)
def executive_summary(star: DeliveryStar):
    summary = olap.executive_summary(
        star.deliveries("delivery_time_min"),
        evaluate.compare({"Naive Bayes": _bayes_test(star)}),
        _anomalies(star),
    )
    return rounded(summary, 9, "avg_accuracy")


# Rows of a staged file that a model is fitted on.
FILE_ROWS = 20_000


def _model_rows(star: DeliveryStar):
    """Prepared, labelled and split deliveries, staged once for all models."""
    features = _with_time(star, "customer_complaint", "traffic_level")
    prepared = prep.prepare(staged(features, "features"))
    framed = staged(prep.model_frame(prepared, ["delivery_id"]), "model-frame")
    marked = staged(prep.stratified_split(framed, "label", ["delivery_id"]), "marked", FILE_ROWS)
    return marked.filter("is_train"), marked.filter("NOT is_train")


def _quality(star: DeliveryStar, name: str, fit):
    train, test = _model_rows(star)
    return evaluate.compare({name: classify.predictions(fit(train), test)}, "No_Complaint")


@query("decision_tree_quality", "ML-08 ML-11 ML-12")
def decision_tree_quality(star: DeliveryStar):
    return _quality(star, "Decision Tree", classify.fit_tree)


_TREE = ("label", ["distance_km", "order_value"], ["order_segment", "traffic_level"], ["delivery_id"])
_PREDICTORS = ("distance_km", "order_value", "order_segment", "traffic_level")
TREE_DEPTH, FOREST_TREES, FOREST_DEPTH, FOREST_TRIES = 3, 5, 2, 2
FOREST_COMPLEXITY = 0.01


def _tree_sql(depth: int, tries: int, complexity: float, least: int, smallest: int) -> str:
    """Trees over ``rows0`` (tree, node, w, class, x0, x1, c2, c3), one level after the other; rows
    of weight 0 only follow the splits. ``nodes`` holds all nodes, ``leaves`` the rows at the end."""
    ctes, nodes = [], []
    for at in range(depth + 1):
        ctes.append(
            f"""stats{at} AS MATERIALIZED (SELECT tree, node, sum(w)::BIGINT AS n,
                coalesce(sum(w) FILTER (class = 0), 0)::BIGINT AS t0,
                coalesce(sum(w) FILTER (class = 1), 0)::BIGINT AS t1
                FROM rows{at} WHERE w > 0 AND NOT done GROUP BY tree, node)"""
        )
        if at == 0:
            ctes.append("roots AS MATERIALIZED (SELECT tree, least(t0, t1) AS risk FROM stats0)")
        if at == depth:
            nodes.append(
                f"SELECT tree, node, n, t0, t1, NULL::INTEGER AS p, NULL::DOUBLE AS cut, NULL::VARCHAR AS lefts,"
                f" NULL::DOUBLE AS gain FROM stats{at}"
            )
            ctes.append(f"leaves AS MATERIALIZED (SELECT * FROM rows{at})")
            break
        draw = sql_uniform("concat_ws('|', tree, node, p)", "split")
        numbers = " UNION ALL ".join(
            f"SELECT tree, node, {i} AS p, x{i} AS v, class, w FROM inner{at}" for i in (0, 1)
        )
        levels = " UNION ALL ".join(
            f"SELECT tree, node, {i} AS p, c{i} AS level, class, w FROM inner{at}" for i in (2, 3)
        )
        sums = "coalesce(sum(w) FILTER (class = 0), 0) AS n0, coalesce(sum(w) FILTER (class = 1), 0) AS n1"
        ctes.append(
            f"""active{at} AS MATERIALIZED (SELECT s.* FROM stats{at} s JOIN roots USING (tree)
                WHERE n >= {least} AND least(t0, t1) > {complexity!r} * risk AND least(t0, t1) > 0),
            inner{at} AS MATERIALIZED (SELECT r.* FROM rows{at} r SEMI JOIN active{at} USING (tree, node) WHERE w > 0 AND NOT done),
            some{at} AS MATERIALIZED (SELECT tree, node, p FROM (SELECT tree, node, p, row_number() OVER (
                PARTITION BY tree, node ORDER BY {draw}) AS place FROM active{at}
                CROSS JOIN (VALUES (0), (1), (2), (3)) AS ps(p)) WHERE place <= {tries}),
            levels{at} AS MATERIALIZED (SELECT *, n1 / (n0 + n1)::DOUBLE AS v FROM (
                SELECT tree, node, p, level, {sums} FROM ({levels}) GROUP BY tree, node, p, level)),
            values{at} AS MATERIALIZED (SELECT tree, node, p, v, {sums} FROM ({numbers}) GROUP BY tree, node, p, v
                UNION ALL SELECT tree, node, p, v, sum(n0), sum(n1) FROM levels{at} GROUP BY tree, node, p, v),
            upto{at} AS MATERIALIZED (SELECT tree, node, p, v, t0, t1, n,
                (sum(n0) OVER upto)::DOUBLE AS l0, (sum(n1) OVER upto)::DOUBLE AS l1, lead(v) OVER following AS beyond
                FROM values{at} SEMI JOIN some{at} USING (tree, node, p) JOIN active{at} USING (tree, node)
                WINDOW upto AS (PARTITION BY tree, node, p ORDER BY v ROWS UNBOUNDED PRECEDING),
                    following AS (PARTITION BY tree, node, p ORDER BY v)),
            best{at} AS MATERIALIZED (SELECT * FROM (SELECT *,
                round((l0 * l0 + l1 * l1) / (l0 + l1)
                    + ((t0 - l0) * (t0 - l0) + (t1 - l1) * (t1 - l1)) / (n - l0 - l1)
                    - (t0::DOUBLE * t0 + t1::DOUBLE * t1) / n, 9) AS gain
                FROM upto{at} WHERE least(l0 + l1, n - l0 - l1) >= {smallest}) WHERE gain > 0
                QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, p, v) = 1),
            sides{at} AS MATERIALIZED (SELECT tree, node, list(level ORDER BY level) AS lefts
                FROM levels{at} l JOIN best{at} b USING (tree, node, p) WHERE l.v <= b.v GROUP BY tree, node),
            won{at} AS MATERIALIZED (SELECT tree, node, p, gain, CASE WHEN p < 2 THEN (v + beyond) / 2 END AS cut,
                lefts FROM best{at} LEFT JOIN sides{at} USING (tree, node)),
            rows{at + 1} AS MATERIALIZED (SELECT r.* REPLACE (CASE WHEN won.p IS NULL THEN node ELSE 2 * node + CASE
                    WHEN CASE won.p WHEN 0 THEN x0 <= cut WHEN 1 THEN x1 <= cut WHEN 2 THEN list_contains(lefts, c2)
                        ELSE list_contains(lefts, c3) END THEN 0 ELSE 1 END END AS node,
                done OR won.p IS NULL AS done) FROM rows{at} r LEFT JOIN won{at} won USING (tree, node))"""
        )
        nodes.append(
            f"""SELECT tree, node, n, t0, t1, p, cut, array_to_string(lefts, ',') AS lefts, gain
                FROM stats{at} LEFT JOIN won{at} USING (tree, node)"""
        )
    ctes.append("nodes AS MATERIALIZED (" + " UNION ALL ".join(nodes) + ")")
    return ",\n".join(ctes)


def _tree_rows(copies: str, trees: int) -> str:
    return f"""rows0 AS MATERIALIZED (SELECT tree, 1::BIGINT AS node, {copies} AS w, FALSE AS done,
        (label = 'No_Complaint')::INTEGER AS class, r, delivery_id, label, is_train, distance_km AS x0,
        order_value AS x1, coalesce('=' || order_segment, '') AS c2, coalesce('=' || traffic_level, '') AS c3
        FROM (SELECT *, row_number() OVER () AS r FROM marked) CROSS JOIN range({trees}) AS ts(tree))"""


_ONE_TREE = f"""{_DRAWN}, {_tree_rows("is_train::INTEGER", 1)},
    {_tree_sql(TREE_DEPTH, 4, tree.COMPLEXITY, tree.MIN_SPLIT, tree.MIN_LEAF)}"""


def _one_tree(star: DeliveryStar):
    marked = staged(_marked(star), "marked")
    return marked, tree.grow(marked.where("is_train"), *_TREE, max_depth=TREE_DEPTH)


@query(
    "tree_splits",
    "ML-08",
    f"""WITH {_ONE_TREE} SELECT node, n, t0 AS complaints,
        CASE p WHEN 0 THEN 'distance_km' WHEN 1 THEN 'order_value' WHEN 2 THEN 'order_segment'
            WHEN 3 THEN 'traffic_level' END AS predictor,
        round(cut, 9) AS threshold, CASE WHEN p > 1 THEN lefts END AS left_levels, round(gain, 6) AS gain
    FROM nodes""",
)
def tree_splits(star: DeliveryStar):
    """Every node of a tree of depth 3, with its exact best split."""
    _, grown = _one_tree(star)
    rows = [
        (
            i, sum(x.counts), x.counts[0], None if x.predictor is None else _PREDICTORS[x.predictor],
            x.threshold, None if x.left is None else ",".join(x.left),
            None if x.predictor is None else x.gain,
        )
        for i, x in grown.trees[0].nodes.items()
    ]
    schema = "node long, n long, complaints long, predictor string, threshold double, left_levels string, gain double"
    return rounded(rounded(star.spark.createDataFrame(rows, schema), 9, "threshold"), 6, "gain")


@query(
    "tree_confusion",
    "ML-08 ML-11",
    f"""WITH {_ONE_TREE} SELECT label, CASE WHEN t0 >= t1 THEN 'Complaint' ELSE 'No_Complaint' END AS prediction,
        count(*) AS n FROM leaves JOIN nodes USING (tree, node) WHERE NOT is_train GROUP BY ALL""",
)
def tree_confusion(star: DeliveryStar):
    """Test rows by class and by what the tree says, grown and stored and loaded."""
    marked, grown = _one_tree(star)
    path = grown.save(star.spark, scratch_path(star.spark, "tree"))
    loaded = tree.Forest.load(star.spark, path)
    return evaluate.confusion(tree.predictions(loaded, marked.where("NOT is_train")))


@query("pruned_tree_path", "ML-08")
def pruned_tree_path(star: DeliveryStar):
    """Complexity, leaves, training error, cross-validated error and its deviation of each subtree."""
    marked = staged(_marked(star), "marked")
    grown = tree.grow(marked.where("is_train"), *_TREE, max_depth=5, complexity=0.002)
    schema = "complexity double, leaves long, error double, validated_error double, deviation double"
    return star.spark.createDataFrame(grown.trees[0].validated(), schema)


_COPIES = " + ".join(f"(u >= {x!r})::INTEGER" for x in tree.DRAWN)
_FOREST = f"""{_DRAWN}, {_tree_rows("CASE WHEN is_train THEN (SELECT " + _COPIES + " FROM (SELECT "
    + sql_uniform("delivery_id", "tree' || tree || '") + " AS u)) ELSE 0 END", FOREST_TREES)},
    {_tree_sql(FOREST_DEPTH, FOREST_TRIES, FOREST_COMPLEXITY, 2, 1)}"""


def _forest(star: DeliveryStar):
    train = staged(_marked(star).where("is_train"), "training")
    grown = tree.grow(
        train, *_TREE, trees=FOREST_TREES, tries=FOREST_TRIES, max_depth=FOREST_DEPTH, min_split=2, min_leaf=1,
        complexity=FOREST_COMPLEXITY, folds=1,
    )
    return train, grown


@query(
    "forest_out_of_bag",
    "ML-14 ML-11",
    f"""WITH {_FOREST}, votes AS (SELECT r, label,
            count(*) FILTER (w = 0 AND t0 >= t1) AS v0, count(*) FILTER (w = 0 AND t0 < t1) AS v1
            FROM leaves JOIN nodes USING (tree, node) WHERE is_train GROUP BY ALL)
        SELECT label, CASE WHEN v0 + v1 = 0 THEN NULL WHEN v0 >= v1 THEN 'Complaint' ELSE 'No_Complaint' END
            AS prediction, count(*) AS n FROM votes GROUP BY ALL""",
)
def forest_out_of_bag(star: DeliveryStar):
    """Training rows by class and by the votes of the trees that did not draw them."""
    train, grown = _forest(star)
    return evaluate.confusion(tree.predictions(grown, train, ["delivery_id"]))


@query("forest_importance", "ML-14")
def forest_importance(star: DeliveryStar):
    train, grown = _forest(star)
    return tree.importance(grown, train, "label", ["delivery_id"])


@query("random_forest_quality", "ML-14 ML-11 ML-12")
def random_forest_quality(star: DeliveryStar):
    return _quality(star, "Random Forest", classify.fit_forest)


@query("svm_quality", "ML-10 ML-11 ML-12")
def svm_quality(star: DeliveryStar):
    return _quality(star, "SVM", classify.fit_svm)


@query("svm_probabilities", "ML-16 ML-10")
def svm_probabilities(star: DeliveryStar):
    train, test = _model_rows(star)
    scored = classify.predictions(classify.fit_svm(train), test)
    return classify.probability_histogram(scored, code=0)


@query("stored_model_comparison", "SNK-03 SRC-04 ML-11")
def stored_model_comparison(star: DeliveryStar):
    """Fit a tree, store it with its accuracy, load both, and score with the loaded one."""
    train, test = _model_rows(star)
    tree = classify.fit_tree(train)
    accuracies = evaluate.compare({"Decision Tree": classify.predictions(tree, test)})
    paths = save_models({"tree": tree}, accuracies, scratch_path(star.spark, "models"))
    models, stored = load_models(star.spark, paths)
    again = evaluate.compare({"Decision Tree": classify.predictions(models["tree"], test)})
    return stored.join(again.withColumnRenamed("accuracy", "accuracy_again"), "model")


_MODELS = ("Decision Tree", "Naive Bayes", "Random Forest", "SVM")


@query(
    "stored_model_agreement",
    "SNK-03 ML-08 ML-09 ML-10 ML-14 ML-16",
    f"""WITH {_DRAWN} SELECT model, label, count(*) AS tested, 0::BIGINT AS disagreeing,
        0::BIGINT AS improbable FROM marked
    CROSS JOIN (VALUES {", ".join(f"('{m}')" for m in _MODELS)}) AS models(model)
    WHERE NOT is_train GROUP BY model, label""",
)
def stored_model_agreement(star: DeliveryStar):
    """All models fitted, stored and loaded: test rows by class, those that the loaded model
    predicts otherwise, and those whose class probabilities do not add up to 1."""
    train, test = _model_rows(star)
    root = scratch_path(star.spark, "models")
    fitted = {
        "Decision Tree": classify.fit_tree(train),
        "Random Forest": classify.fit_forest(train),
        "SVM": classify.fit_svm(train),
    }
    accuracies = evaluate.compare({n: classify.predictions(m, test) for n, m in fitted.items()})
    paths = save_models(fitted, accuracies, root)
    loaded, _ = load_models(star.spark, paths)
    mixed = bayes.fit(train, "label", classify.NUMERIC, classify.CATEGORICAL)
    mixed.save(star.spark, f"{root}/bayes")
    again = bayes.NaiveBayesModel.load(star.spark, f"{root}/bayes")
    pairs = {
        name: [classify.predictions(m, test) for m in (fitted[name], loaded[name])]
        for name in fitted
    }
    pairs["Naive Bayes"] = [
        bayes.predict(m, test).withColumn("probabilities", F.array(F.lit(1.0)))
        for m in (mixed, again)
    ]
    rows = None
    for name, (one, two) in pairs.items():
        total = F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x)
        met = one.select("delivery_id", "label", F.col("prediction").alias("said")).join(
            two.select("delivery_id", "prediction", total.alias("total")), "delivery_id"
        )
        counts = met.groupBy("label").agg(
            F.count(F.lit(1)).alias("tested"),
            F.count_if(~F.col("said").eqNullSafe(F.col("prediction"))).alias("disagreeing"),
            F.count_if(F.abs(F.col("total") - 1) > 1e-9).alias("improbable"),
        )
        counts = counts.select(F.lit(name).alias("model"), "*")
        rows = counts if rows is None else rows.unionByName(counts)
    return rows


@query(
    "stored_preparation",
    "SNK-03 ML-01 ML-03 ML-04 ML-09",
    f"WITH {_BAYES} SELECT label, prediction, count(*) AS n, 0::BIGINT AS moved FROM predicted"
    " GROUP BY label, prediction",
)
def stored_preparation(star: DeliveryStar):
    """Preparation and naive Bayes fitted on training rows, stored, loaded, applied to test rows:
    predictions by class, and rows whose components or prediction the loaded ones change."""
    marked = staged(_marked(star), "marked")
    features = staged(_with_time(star), "features")
    keys = marked.where("is_train").select("delivery_id")
    fitted = prep.fit_preparation(
        staged(features.join(keys, "delivery_id", "left_semi"), "training")
    )
    root = scratch_path(star.spark, "preparation")
    loaded = prep.Preparation.load(star.spark, fitted.save(star.spark, f"{root}/prep"))
    model = bayes.fit(
        marked.where("is_train"), "label", ["distance_km", "order_value"],
        ["order_segment", "traffic_level"],
    )
    model.save(star.spark, f"{root}/bayes")
    again = bayes.NaiveBayesModel.load(star.spark, f"{root}/bayes")
    test = marked.where("NOT is_train")
    one = bayes.predict(model, test).select("delivery_id", F.col("prediction").alias("said"))
    two = bayes.predict(again, test).select("delivery_id", "label", "prediction")
    parts = [
        p.apply(features).select("delivery_id", F.array("PC1", "PC2").alias(n))
        for p, n in ((fitted, "at"), (loaded, "again_at"))
    ]
    met = two.join(one, "delivery_id").join(parts[0], "delivery_id").join(parts[1], "delivery_id")
    differs = (F.col("at") != F.col("again_at")) | (F.col("said") != F.col("prediction"))
    return met.groupBy("label", "prediction").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(differs).alias("moved")
    )


_SIDES = "CAST(right(delivery_id, 1) AS INTEGER) % 3"
_EXTENDED = [f"round(avg({c}), 6) AS mean_{i}, round(stddev_samp({c}), 6) AS sd_{i}"
             for i, c in enumerate(prep.FEATURES)]


@query(
    "extended_preparation",
    "ML-03 ML-04 SNK-03",
    f"""WITH filled AS (SELECT * REPLACE (coalesce(order_value_raw, (SELECT
            quantile_cont(order_value_raw, 0.5) FROM fact_delivery WHERE {_SIDES} > 0)) AS order_value)
        FROM fact_delivery)
    SELECT count(*) AS n, {", ".join(_EXTENDED + _PAIRS)} FROM filled
    WHERE {" AND ".join(f"{c} IS NOT NULL" for c in prep.FEATURES)}""",
)
def extended_preparation(star: DeliveryStar):
    """Moments fitted on two thirds of the deliveries, stored, loaded, and extended by the rest."""
    rows = staged(_features(star), "features")
    first = prep.fit_preparation(rows.where(f"{_SIDES} > 0"))
    path = first.save(star.spark, scratch_path(star.spark, "preparation"))
    moments = prep.Preparation.load(star.spark, path).extended(rows.where(f"{_SIDES} = 0")).moments
    k = len(moments.columns)
    named = {"n": moments.n}
    named |= {f"mean_{i}": round(float(m), 6) for i, m in enumerate(moments.mean)}
    named |= {f"sd_{i}": round(float(m), 6) for i, m in enumerate(moments.sd)}
    named |= {
        f"corr_{i}_{j}": round(float(moments.correlation[i, j]), 6) for i in range(k) for j in range(i + 1, k)
    }
    schema = ", ".join(f"{c} {'long' if c == 'n' else 'double'}" for c in named)
    return star.spark.createDataFrame([tuple(named.values())], schema)


@query(
    "extended_bayes_confusion",
    "ML-09 ML-11 SNK-03",
    f"WITH {_BAYES} SELECT label, prediction, count(*) AS n FROM predicted GROUP BY label, prediction",
)
def extended_bayes_confusion(star: DeliveryStar):
    """Counts of two thirds of the training rows, stored and loaded, with those of the rest."""
    marked = staged(_marked(star), "marked")
    train = marked.where("is_train")
    of = ("label", ["distance_km", "order_value"], ["order_segment", "traffic_level"])
    root = scratch_path(star.spark, "counts")
    bayes.count(train.where(f"{_SIDES} > 0"), *of).save(star.spark, root)
    held = bayes.Counts.load(star.spark, root).merged(bayes.count(train.where(f"{_SIDES} = 0"), *of))
    return evaluate.confusion(bayes.predict(held.model(), marked.where("NOT is_train")))


def _lloyd_sql(k: int = 3, steps: int = 40) -> str:
    """The steps of ``cluster.lloyd`` one after the other; after the last move nothing changes."""
    names, centres = ("z0", "z1", "z2"), ("c0", "c1", "c2")
    start = ", ".join(
        f"({i + 1}, " + ", ".join([f"{(2 * i + 1) / k - 1!r}::DOUBLE"] * 3) + ")" for i in range(k)
    )
    size = " + ".join(f"({z} - {c}) ** 2" for z, c in zip(names, centres))

    def nearest(at: int) -> str:
        return f"""(SELECT p.*, (SELECT min_by(i, {size} + i * 1e-300) FROM centre{at}) AS near
            FROM points p)"""

    ctes = [f"centre0(i, c0, c1, c2) AS MATERIALIZED (VALUES {start})"]
    for at in range(steps):
        means = ", ".join(f"coalesce(avg({z}), any_value({c}))" for z, c in zip(names, centres))
        ctes.append(
            f"centre{at + 1}(i, c0, c1, c2) AS MATERIALIZED (SELECT i, {means} FROM centre{at}"
            f" LEFT JOIN {nearest(at)} ON near = i GROUP BY i)"
        )
    ctes.append(
        f"""ranked AS (SELECT i, row_number() OVER (ORDER BY c0, c1, c2) AS cluster
        FROM centre{steps}), found AS (SELECT agent_key, cluster FROM {nearest(steps)}
        JOIN ranked ON near = i)"""
    )
    return ",\n".join(ctes)


_PERFORMANCE = """performance AS (SELECT a.*, avg_delivery_time, delay_rate, avg_rating
        FROM dim_agent a
        JOIN (SELECT agent_id, avg(delivery_time_min) AS avg_delivery_time,
            sum(delayed_flag) * 1.0::DOUBLE / count(*) AS delay_rate
            FROM fact_delivery GROUP BY agent_id) d USING (agent_id)
        LEFT JOIN (SELECT agent_key, avg(rating) AS avg_rating FROM fact_review GROUP BY agent_key) r
            USING (agent_key)),
    points AS MATERIALIZED (SELECT agent_key,
        (avg_delivery_time - avg(avg_delivery_time) OVER ()) / stddev_samp(avg_delivery_time) OVER () AS z0,
        (delay_rate - avg(delay_rate) OVER ()) / stddev_samp(delay_rate) OVER () AS z1,
        (avg_rating - avg(avg_rating) OVER ()) / stddev_samp(avg_rating) OVER () AS z2
        FROM performance WHERE avg_rating IS NOT NULL)"""


@query(
    "agent_clusters_lloyd",
    "ML-13 FLT-02",
    f"""WITH {_PERFORMANCE}, {_lloyd_sql()} SELECT agent_key, agent_id, CAST(cluster AS INTEGER) AS cluster
    FROM performance LEFT JOIN found USING (agent_key)""",
)
def agent_clusters_lloyd(star: DeliveryStar):
    rows = cluster.lloyd(staged(performance(star), "agent-performance"))
    return rows.select("agent_key", "agent_id", "cluster")


@query(
    "hierarchical_cluster_totals",
    "ML-15 FLT-02",
    f"""WITH {_PERFORMANCE} SELECT count(*) AS agents, count(avg_rating) AS clustered,
        3::BIGINT AS clusters, 0::BIGINT AS out_of_order FROM performance""",
)
def hierarchical_cluster_totals(star: DeliveryStar):
    """Agents, those with a cluster, clusters, and clusters whose number is not from 1 to 3."""
    rows = cluster.bisecting(staged(performance(star), "agent-performance"))
    label = F.col("cluster_hierarchical")
    return rows.agg(
        F.count(F.lit(1)).alias("agents"),
        F.count(label).alias("clustered"),
        F.count_distinct(label).alias("clusters"),
        F.count_if(~label.between(1, 3)).alias("out_of_order"),
    )


WARD_WIDTH = 0.25


def _ward_sql() -> str:
    """Leaves of the stated width, and all clusters after every merge of the nearest two."""
    cells = ", ".join(f"CAST(trunc(abs(z{i}) / {WARD_WIDTH}) * sign(z{i}) AS BIGINT) AS c{i}" for i in range(3))
    gap = " + ".join(f"(a.s{i} / a.n - b.s{i} / b.n) ** 2" for i in range(3))
    return f"""celled AS MATERIALIZED (SELECT agent_key, z0, z1, z2, {cells} FROM points),
    leaves AS MATERIALIZED (SELECT row_number() OVER (ORDER BY c0, c1, c2) - 1 AS id, c0, c1, c2,
        count(*) AS n, sum(z0) AS s0, sum(z1) AS s1, sum(z2) AS s2 FROM celled GROUP BY c0, c1, c2),
    clusters(step, id, n, s0, s1, s2, held, lft, rgt, cost) AS (
        SELECT 0::BIGINT, id, n, s0, s1, s2, [id], NULL::BIGINT, NULL::BIGINT, NULL::DOUBLE FROM leaves
        UNION ALL
        SELECT * FROM (
            WITH best AS (SELECT a.id AS x, b.id AS y, a.n * b.n / (a.n + b.n)::DOUBLE * ({gap}) AS cost
                FROM clusters a JOIN clusters b ON a.id < b.id ORDER BY cost, x, y LIMIT 1),
            pair AS (SELECT c.*, x, y, best.cost AS least FROM clusters c, best)
            SELECT step + 1, id, n, s0, s1, s2, held, NULL::BIGINT, NULL::BIGINT, NULL::DOUBLE
                FROM pair WHERE id NOT IN (x, y)
            UNION ALL
            SELECT any_value(step) + 1, (SELECT count(*) FROM leaves) + any_value(step), sum(n)::BIGINT,
                sum(s0), sum(s1), sum(s2), flatten(list(held)), any_value(x), any_value(y), any_value(least)
                FROM pair WHERE id IN (x, y) HAVING count(*) = 2)),
    cut AS (SELECT k, unnest(held) AS id, cluster FROM (SELECT k, held, row_number() OVER (
            PARTITION BY k ORDER BY s0 / n, s1 / n, s2 / n) AS cluster FROM clusters
        JOIN (VALUES (2), (3), (5)) AS ks(k) ON step = greatest((SELECT count(*) FROM leaves) - k, 0)))"""


@query(
    "ward_agent_clusters",
    "ML-15 FLT-02 PRJ-06",
    f"""WITH RECURSIVE {_PERFORMANCE}, {_ward_sql()},
    found AS (SELECT agent_key, CAST(max(cluster) FILTER (k = 2) AS INTEGER) AS cluster_2,
        CAST(max(cluster) FILTER (k = 3) AS INTEGER) AS cluster_3,
        CAST(max(cluster) FILTER (k = 5) AS INTEGER) AS cluster_5
        FROM celled JOIN leaves USING (c0, c1, c2) JOIN cut USING (id) GROUP BY agent_key)
    SELECT agent_key, agent_id, cluster_2, cluster_3, cluster_5
    FROM performance LEFT JOIN found USING (agent_key)""",
)
def ward_agent_clusters(star: DeliveryStar):
    """Agents with their clusters of one dendrogram, cut at 2, 3 and 5."""
    agents = staged(performance(star), "agent-performance")
    tree = ward.dendrogram(agents, width=WARD_WIDTH)
    cut = tree.apply(agents, {f"cluster_{k}": k for k in (2, 3, 5)})
    return cut.select("agent_key", "agent_id", "cluster_2", "cluster_3", "cluster_5")


@query(
    "ward_merges",
    "ML-15",
    f"""WITH RECURSIVE {_PERFORMANCE}, {_ward_sql()}
    SELECT step, lft AS "left", rgt AS "right", n, round(sqrt(2 * cost), 6) AS height
    FROM clusters WHERE cost IS NOT NULL""",
)
def ward_merges(star: DeliveryStar):
    agents = staged(performance(star), "agent-performance")
    return rounded(ward.dendrogram(agents, width=WARD_WIDTH).merges(star.spark), 6, "height")


@query("agent_clusters", "ML-13 FLT-02 PRJ-06")
def agent_clusters(star: DeliveryStar):
    return cluster.kmeans(staged(performance(star), "agent-performance"))


@query("agent_cluster_sizes", "ML-13")
def agent_cluster_sizes(star: DeliveryStar):
    return olap.count_by(cluster.kmeans(staged(performance(star), "agent-performance")), "cluster")


@query("hierarchical_clusters", "ML-15")
def hierarchical_clusters(star: DeliveryStar):
    return cluster.bisecting(staged(performance(star), "agent-performance"))


@query(
    "complete_agents",
    "FLT-02",
    """SELECT agent_key, agent_id FROM dim_agent WHERE agent_key IN (
        SELECT agent_key FROM fact_review WHERE rating IS NOT NULL)
        AND agent_id IN (SELECT agent_id FROM fact_delivery)""",
)
def complete_agents(star: DeliveryStar):
    known = performance(star).na.drop("any", subset=list(cluster.AGENT_FEATURES))
    return known.select("agent_key", "agent_id")
