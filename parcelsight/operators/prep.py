"""Preprocessing of deliveries: repair, scaling, principal components, segments, split.

Everything fitted is a handful of numbers from one aggregation pass; they become literals
in column expressions, so applying them is a narrow projection inside code generation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelsight.functions.columns import cut_right, floor_at_zero, recode, uniform
from parcelsight.operators.numbering import SMALL, drawn_thresholds, exact_median
from parcelsight.sources.scratch import staged

FEATURES = ("distance_km", "order_value", "agent_experience_years", "traffic_density_index")
# Segment bounds and names, label names: fixed values.
SEGMENT_BREAKS = (25.0, 60.0)
SEGMENTS = ("Low Value", "Medium Value", "High Value")
COMPLAINT_NAMES = {0: "No_Complaint", 1: "Complaint"}


def impute_median(
    df: DataFrame, column: str, small: int = SMALL, approximate: int | None = None
) -> DataFrame:
    """Fill missing values (NaN too) with the column's median, exact unless an accuracy is given."""
    return fill(df, column, median_of(df, column, small, approximate))


def median_of(
    df: DataFrame, column: str, small: int = SMALL, approximate: int | None = None
) -> float | None:
    """Median of the known values."""
    if approximate:
        known = F.when(~F.isnan(column), F.col(column))
        return df.agg(F.percentile_approx(known, 0.5, approximate).alias("m")).first()["m"]
    return exact_median(df, column, small)


def fill(df: DataFrame, column: str, value: float | None) -> DataFrame:
    """Put a value where the column is missing or NaN."""
    known = F.when(~F.isnan(column), F.col(column))
    return df.withColumn(column, F.coalesce(known, F.lit(value).cast("double")))


def repair_times(df: DataFrame, column: str = "delivery_time_min") -> DataFrame:
    """Negative times become 0."""
    return df.withColumn(column, floor_at_zero(column))


@dataclass(frozen=True)
class Moments:
    """Rows, means and co-moments (sums of products of deviations) of columns, over the rows that
    have all of them. Those of two parts of a frame merge to those of the whole, without rows."""

    columns: tuple[str, ...]
    n: int
    mean: np.ndarray
    comoment: np.ndarray

    @property
    def sd(self) -> np.ndarray:
        """Standard deviations (n - 1); NaN for fewer than two rows."""
        if self.n < 2:
            return np.full(len(self.columns), np.nan)
        return np.sqrt(np.diag(self.comoment) / (self.n - 1))

    @property
    def correlation(self) -> np.ndarray:
        """Correlations, 1 on the diagonal; NaN where a column is constant."""
        size = np.sqrt(np.diag(self.comoment))
        scale = np.outer(size, size)
        out = np.full(scale.shape, np.nan)
        np.divide(self.comoment, scale, out=out, where=scale > 0)
        np.fill_diagonal(out, 1.0)
        return out

    def merged(self, other: Moments) -> Moments:
        """Moments of the rows of both; the columns must be the same."""
        if self.columns != other.columns:
            raise ValueError(f"moments of {self.columns} and of {other.columns} do not merge")
        if not self.n or not other.n:
            return self if self.n else other
        n = self.n + other.n
        gap = other.mean - self.mean
        return Moments(
            self.columns,
            n,
            self.mean + gap * (other.n / n),
            self.comoment + other.comoment + np.outer(gap, gap) * (self.n * other.n / n),
        )


def _complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop("any", subset=list(columns))


def correlation_row(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """One row with mean_i, sd_i and corr_i_j over the rows complete in all columns; a correlation
    with a constant column is missing."""
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.avg(c).alias(f"mean_{i}"), F.stddev_samp(c).alias(f"sd_{i}")]
    for (i, a), (j, b) in combinations(enumerate(columns), 2):
        size = F.stddev_samp(a) * F.stddev_samp(b)
        aggs.append(F.try_divide(F.covar_samp(a, b), size).alias(f"corr_{i}_{j}"))
    return _complete(df, columns).agg(*aggs)


def fit_moments(df: DataFrame, columns: Sequence[str] = FEATURES) -> Moments:
    """One pass over the rows."""
    k = len(columns)
    aggs = [F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{i}") for i, c in enumerate(columns)]]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    aggs += [F.covar_pop(columns[i], columns[j]).alias(f"co_{i}_{j}") for i, j in pairs]
    row = _complete(df, columns).agg(*aggs).first()
    comoment = np.zeros((k, k))
    for i, j in pairs:
        comoment[i, j] = comoment[j, i] = row["n"] * (row[f"co_{i}_{j}"] or 0.0)
    mean = np.array([row[f"mean_{i}"] or 0.0 for i in range(k)], float)
    return Moments(tuple(columns), row["n"], mean, comoment)


def scaled(moments: Moments) -> list[Column]:
    """(x - mean) / sd of every column; NULL for a constant column."""
    return [
        (F.col(c) - F.lit(float(m))) / F.lit(float(s)) if s > 0 else F.lit(None).cast("double")
        for c, m, s in zip(moments.columns, moments.mean, moments.sd)
    ]


def standardize(df: DataFrame, columns: Sequence[str] = FEATURES, suffix: str = "") -> DataFrame:
    """Centre and scale columns; scaling twice gives the same as once."""
    moments = fit_moments(df, columns)
    return df.withColumns({c + suffix: v for c, v in zip(columns, scaled(moments))})


def component_loadings(moments: Moments, k: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Leading eigenvectors (columns) and eigenvalues of the correlation matrix.

    The sign is free; the loading largest in size is made positive.
    """
    values, vectors = np.linalg.eigh(moments.correlation)
    order = np.argsort(values)[::-1][:k]
    vectors = vectors[:, order]
    largest = np.abs(vectors).argmax(axis=0)
    signs = np.sign(vectors[largest, np.arange(vectors.shape[1])])
    return vectors * signs, values[order]


def principal_components(
    df: DataFrame, columns: Sequence[str] = FEATURES, k: int = 2, moments: Moments | None = None
) -> DataFrame:
    """Add PC1 ... PCk of the centred and scaled columns.

    One pass fits means, deviations and correlations; the decomposition is of a matrix as
    wide as the feature list, and the scores are plain column arithmetic.
    """
    moments = moments or fit_moments(df, columns)
    loadings, _ = component_loadings(moments, k)
    parts = scaled(moments)
    scores = {}
    for j in range(k):
        total = F.lit(0.0)
        for value, weight in zip(parts, loadings[:, j]):
            total = total + value * F.lit(float(weight))
        scores[f"PC{j + 1}"] = total
    return df.withColumns(scores)


def segment_orders(df: DataFrame, column: str = "order_value") -> DataFrame:
    """Low up to 25, medium up to 60, high above."""
    return df.withColumn("order_segment", cut_right(column, SEGMENT_BREAKS, SEGMENTS))


@dataclass(frozen=True)
class Preparation:
    """What preparing deliveries has learned: the median order value, and the moments that the
    components come from. Rows prepared with one of them are on one scale, whenever they come."""

    median: float | None
    moments: Moments

    def apply(self, df: DataFrame) -> DataFrame:
        """Impute, repair, add components and segments."""
        clean = repair_times(fill(df, "order_value", self.median))
        return segment_orders(
            principal_components(clean, self.moments.columns, moments=self.moments)
        )

    def extended(self, df: DataFrame) -> Preparation:
        """Learned from new rows, too, without those learned from before.

        The moments are those of all rows together; the median, which is not a sum, stays, and
        missing values of the new rows are filled with it.
        """
        new = fit_moments(fill(df, "order_value", self.median), self.moments.columns)
        return Preparation(self.median, self.moments.merged(new))

    def save(self, spark: SparkSession, path: str) -> str:
        """Store the fitted numbers, replacing earlier ones."""
        m = self.moments
        row = (self.median, list(m.columns), m.n, m.mean.tolist(), m.comoment.ravel().tolist())
        spark.createDataFrame([row], _STORED).coalesce(1).write.mode("overwrite").parquet(path)
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> Preparation:
        """Counterpart of :meth:`save`."""
        r = spark.read.schema(_STORED).parquet(path).first()
        k = len(r["columns"])
        return Preparation(
            r["median"],
            Moments(
                tuple(r["columns"]), r["n"], np.array(r["mean"], float),
                np.array(r["comoment"], float).reshape(k, k),
            ),
        )


_STORED = (
    "median double, columns array<string>, n long, mean array<double>, comoment array<double>"
)


def fit_preparation(df: DataFrame) -> Preparation:
    """Learn from training rows. They are read several times: give a stored frame."""
    median = median_of(df, "order_value")
    return Preparation(median, fit_moments(fill(df, "order_value", median)))


def prepare(df: DataFrame) -> DataFrame:
    """Impute, repair, add components and segments, all fitted on the rows themselves."""
    return fit_preparation(df).apply(df)


def model_frame(df: DataFrame, key: Sequence[str] = (), target: str = "customer_complaint"):
    """Named target and the four predictors; a target outside the known codes is NULL."""
    return df.select(
        *key,
        recode(target, COMPLAINT_NAMES).alias("label"),
        "PC1",
        "PC2",
        "order_segment",
        "traffic_level",
    )


def stratified_split(
    df: DataFrame,
    label: str,
    key: Sequence[str],
    share: float = 0.8,
    seed: int = 123,
) -> DataFrame:
    """Mark rows for training: the given share of every class, rounded up.

    Each row draws a number from its key, and a class (a missing label is one) takes those at
    or under its own exact threshold: no per-class sort, and the same rows on every run. The
    thresholds, one for each class, are joined to the rows.
    """
    drawn = df.withColumn("_u", uniform(key, f"split{seed}"))
    thresholds = staged(drawn_thresholds(drawn, label, "_u", share), "thresholds")
    thresholds = thresholds.withColumnRenamed(label, "_class")
    joined = drawn.join(thresholds, drawn[label].eqNullSafe(thresholds["_class"]), "left")
    training = F.coalesce(F.col("_u") <= F.col("threshold"), F.lit(False))
    return joined.select(*df.columns, training.alias("is_train"))
