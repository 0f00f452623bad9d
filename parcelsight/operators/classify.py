"""Decision tree, random forest and kernel SVM on the prepared deliveries."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    Imputer,
    IndexToString,
    SQLTransformer,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelsight.functions.columns import uniform
from parcelsight.functions.fourier import FourierFeatures
from parcelsight.operators import svm
from parcelsight.sources.scratch import staged

NUMERIC = ("PC1", "PC2")
CATEGORICAL = ("order_segment", "traffic_level")
# Bins of a continuous predictor; a category with more levels than this gets as many.
MAX_BINS = 32


def _indexer(rows: DataFrame, column: str, code: str) -> StringIndexerModel:
    """Codes of the distinct known values in lexical order, however many there are."""
    return StringIndexer(
        inputCol=column, outputCol=code, stringOrderType="alphabetAsc", handleInvalid="skip"
    ).fit(rows.filter(F.col(column).isNotNull()))


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _coded(train: DataFrame, label: str) -> tuple[DataFrame, list[str]]:
    """Training rows with ``label_code``, and the classes in the order of their codes.

    The code is for training only: rows to score need no label.
    """
    model = _indexer(train, label, "label_code")
    return model.transform(train.filter(F.col(label).isNotNull())), list(model.labels)


def _name_stage(classes: Sequence[str], output: str = "prediction") -> IndexToString:
    return IndexToString(inputCol="prediction_code", outputCol=output, labels=list(classes))


def _tree_pipeline(
    estimator, train: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str]
) -> PipelineModel:
    """Missing numbers (NaN too) become the median, a missing category is a level of its own.

    Thresholds of continuous predictors are searched among MAX_BINS bins of their quantiles.
    """
    train, classes = _coded(train, label)
    codes, known = [f"{c}_code" for c in categorical], [f"{c}_known" for c in numeric]
    features = [
        # Category codes carry their nominal nature, so trees split on sets of levels.
        StringIndexer(
            inputCols=list(categorical), outputCols=codes, stringOrderType="alphabetAsc",
            handleInvalid="keep",
        ),
        Imputer(inputCols=list(numeric), outputCols=known, strategy="median"),
        VectorAssembler(inputCols=[*known, *codes], outputCol="features"),
    ]
    prepared = Pipeline(stages=features).fit(train)
    levels = max((len(x) + 1 for x in prepared.stages[0].labelsArray), default=0)
    estimator = estimator.copy({estimator.maxBins: max(MAX_BINS, levels)})
    model = estimator.fit(prepared.transform(train))
    return PipelineModel([*prepared.stages, model, _name_stage(classes)])


def fit_tree(
    train: DataFrame,
    label: str = "label",
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
    max_depth: int = 30,
    min_leaf: int = 7,
    min_gain: float = 0.01,
) -> PipelineModel:
    """Gini tree. The cost-complexity limit is approximated by a least gain per split."""
    tree = DecisionTreeClassifier(
        labelCol="label_code", predictionCol="prediction_code", impurity="gini",
        maxDepth=max_depth, minInstancesPerNode=min_leaf, minInfoGain=min_gain, seed=123,
    )
    return _tree_pipeline(tree, train, label, numeric, categorical)


def fit_forest(
    train: DataFrame,
    label: str = "label",
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
    trees: int = 20,
    max_depth: int = 8,
) -> PipelineModel:
    """Random forest; no settings of one are known, so these are ours."""
    forest = RandomForestClassifier(
        labelCol="label_code", predictionCol="prediction_code", numTrees=trees,
        maxDepth=max_depth, seed=123,
    )
    return _tree_pipeline(forest, train, label, numeric, categorical)


def _design(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
) -> tuple[str, list[str], dict[str, list[str]]]:
    """SQL condition that no predictor is missing, SQL terms of the scaled numeric predictors, 0
    where they are missing, and the levels of each category."""
    moments = train.agg(
        *[F.avg(F.when(~F.isnan(c), F.col(c))).alias(f"m_{c}") for c in numeric],
        *[F.stddev_samp(F.when(~F.isnan(c), F.col(c))).alias(f"s_{c}") for c in numeric],
    ).first()
    known = [f"`{c}` IS NOT NULL AND NOT isnan(`{c}`)" for c in numeric]
    known += [f"`{c}` IS NOT NULL" for c in categorical]
    terms = [
        f"coalesce((nanvl(`{c}`, NULL) - {moments[f'm_{c}'] or 0.0!r}D)"
        f" / {(moments[f's_{c}'] or 1.0)!r}D, 0D)"
        for c in numeric
    ]
    levels = {c: list(_indexer(train, c, "_code").labels) for c in categorical}
    return " AND ".join(known), terms, levels


def fit_svm(
    train: DataFrame,
    label: str = "label",
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
    cost: float = 1.0,
    gamma: float | None = None,
    features: int = 64,
    max_iter: int = 100,
    seed: int = 123,
    key: Sequence[str] | None = None,
    folds: int = 3,
) -> PipelineModel:
    """Radial-kernel SVM with cross-fitted class probabilities.

    The kernel is approximated by random Fourier features, so training is linear in the
    rows; their inputs are staged, and all models are fitted side by side (see ``svm``).
    Probabilities come from a logistic curve over the margin, fitted on margins of rows that their
    own model has not seen: rows are dealt into ``folds`` by ``key`` (by their features without one),
    and each fold is scored by a model of the others. Where a fold's others hold one class only, and
    with one fold, the curve is fitted on the final model's margins. Rows with a missing predictor (or
    NaN) are left out of the fit, and get no prediction.
    """
    train, classes = _coded(train, label)
    if len(classes) != 2:
        raise ValueError(f"an SVM tells two classes apart, not {len(classes)}")
    known, terms, levels = _design(train, numeric, categorical)
    train = train.filter(known)
    indicators = [f"if(`{c}` = {_quoted(v)}, 1D, 0D)" for c, some in levels.items() for v in some]
    inputs = [f"_x{i}" for i in range(len(terms) + len(indicators))]
    design = ", ".join(f"{t} AS {x}" for t, x in zip([*terms, *indicators], inputs))
    fourier = FourierFeatures.drawn(inputs, "features", features, gamma or 1.0 / len(inputs), seed)
    before = [
        SQLTransformer(statement=f"SELECT *, {design}, {known} AS _known FROM __THIS__"), fourier
    ]
    drawn = uniform(key, "svm-fold") if key else uniform([F.to_json(F.struct(*numeric, *categorical))], "svm-fold")
    numbers = inputs[: len(terms)]
    rows = train.select(
        "label_code", F.floor(drawn * folds).cast("int").alias("_fold"),
        *[F.expr(t).alias(x) for t, x in zip(terms, numbers, strict=True)], *[f"`{c}`" for c in levels],
    )
    held = svm.blocks(rows, numbers, levels)
    weights, offsets = fourier.drawn_arrays()
    waves = svm.Waves(weights, offsets, len(terms), tuple(tuple(some) for some in levels.values()))
    fits = svm.fit(held, waves, folds, cost, max_iter, 1e-4)
    counts = fits.classes.sum()
    final = fits.model(
        LinearSVC(
            labelCol="label_code", predictionCol="prediction_code", rawPredictionCol="margin",
            regParam=1.0 / (cost * float(counts)), maxIter=max_iter, standardization=False, tol=1e-4,
        )
    )
    rows = staged(fits.margins(), "svm-margins")
    margins = held_out_margins(rows, fits.classes, folds) if folds > 1 else None
    margins = _margin_vector(rows, F.lit(1)) if margins is None else margins
    curve = LogisticRegression(
        featuresCol="margin", labelCol="label_code", predictionCol="_p",
        rawPredictionCol="_raw", probabilityCol="probability", maxIter=max_iter,
    ).fit(margins.select("margin", "label_code"))
    after = [
        _name_stage(classes, "_named"),
        SQLTransformer(statement="SELECT *, if(_known, _named, NULL) AS prediction FROM __THIS__"),
    ]
    return PipelineModel([*before, final, curve, *after])


def _margin_vector(rows: DataFrame, at: Column) -> DataFrame:
    """Rows with the margin that one of their ``_margins`` is, for and against the second class."""
    margin = F.element_at("_margins", at)
    return rows.withColumn("margin", array_to_vector(F.array(-margin, margin)))


def held_out_margins(rows: DataFrame, classes: np.ndarray, folds: int) -> DataFrame | None:
    """All rows with the margin that a model of the other folds gives them; None if a fold's others
    hold fewer than two classes, by the rows of each class and fold. ``_margins`` are those of the
    model of all rows, then of those without each fold."""
    others = classes.sum(axis=0) - classes
    if (others == 0).any():
        return None
    return _margin_vector(rows, F.col("_fold") + 2)


def predictions(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with the predicted class and, per class code, its probability; both are missing
    where the model makes no prediction."""
    scored = model.transform(rows)
    probabilities = F.when(F.col("prediction").isNotNull(), vector_to_array("probability"))
    return scored.select(*rows.columns, "prediction", probabilities.alias("probabilities"))


def probability_histogram(scored: DataFrame, code: int = 1, bins: int = 20) -> DataFrame:
    """Rows per probability bin of one class."""
    p = F.element_at("probabilities", code + 1)
    bucket = F.least(F.floor(p * bins), F.lit(bins - 1)).cast("int")
    return (
        scored.where("prediction IS NOT NULL")
        .groupBy(bucket.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_start", F.col("bin") / F.lit(float(bins)))
    )
