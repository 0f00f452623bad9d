"""Segments of agents and deliveries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelsight.operators.prep import fit_moments, scaled
from parcelsight.operators.quality import require_rows
from parcelsight.sources.scratch import staged

AGENT_FEATURES = ("avg_delivery_time", "delay_rate", "avg_rating")


def _known(columns: Sequence[str]) -> Column:
    """Rows that have all columns; NaN is missing, too."""
    return reduce(
        lambda a, b: a & b,
        [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns],
    )


def _scaled_frame(
    df: DataFrame, columns: Sequence[str], shift: float = 0.0
) -> tuple[DataFrame, list[Column]]:
    """Feature vectors of the complete rows, and the scaled columns they are made of."""
    complete = df.where(_known(columns))
    values = [
        F.coalesce(v, F.lit(0.0)) + F.lit(shift) for v in scaled(fit_moments(complete, columns))
    ]
    names = [f"_z{i}" for i in range(len(values))]
    frame = complete.withColumns(dict(zip(names, values)))
    return VectorAssembler(inputCols=names, outputCol="_features").transform(frame), values


def _nearest(values: Sequence[Column], centers: Sequence[Sequence[float]]) -> Column:
    """Number (from 1) of the closest centre, as column arithmetic."""
    distances = [
        reduce(lambda a, b: a + b, [(v - F.lit(float(c))) ** 2 for v, c in zip(values, center)])
        for center in centers
    ]
    best = F.least(*distances) if len(distances) > 1 else distances[0]
    chain = F.lit(len(centers))
    for i in reversed(range(len(centers) - 1)):
        chain = F.when(distances[i] == best, F.lit(i + 1)).otherwise(chain)
    return chain


def kmeans(
    df: DataFrame,
    columns: Sequence[str] = AGENT_FEATURES,
    k: int = 3,
    seeds: Sequence[int] = (123, 1, 2),
    name: str = "cluster",
) -> DataFrame:
    """k-means on scaled columns, best of several seeds; incomplete rows keep NULL.

    Clusters are numbered by the centre of the first column, then the next ones, so the
    numbers do not depend on the seed.
    """
    complete = df.where(_known(columns))
    require_rows(complete, k, "clustering input")
    frame, values = _scaled_frame(df, columns)
    frame = frame.select("_features").persist()
    try:
        models = [
            KMeans(k=k, seed=s, featuresCol="_features").fit(frame) for s in seeds
        ]
        best = min(models, key=lambda m: m.summary.trainingCost)
        centers = sorted(tuple(float(x) for x in c) for c in best.clusterCenters())
    finally:
        frame.unpersist()
    return df.withColumn(name, F.when(_known(columns), _nearest(values, centers)))


#: Centres of scaled columns that moved by no more stand still.
SETTLED = 1e-12


def lloyd(
    df: DataFrame,
    columns: Sequence[str] = AGENT_FEATURES,
    k: int = 3,
    steps: int | None = None,
    name: str = "cluster",
) -> DataFrame:
    """k-means on scaled columns from a stated start; incomplete rows keep NULL.

    Centre i of k starts at (2 i - 1) / k - 1 in every scaled column. A step is one sum over the
    rows; a centre without rows stays where it is, equally near ones go to the lower number, and
    the steps end when no centre moves by more than sums in another order may differ. More rows need
    more steps, so their number has no bound of its own; with ``steps``, centres that still move after
    so many are an error. Centres never come back to where they have been but by rows as near to one
    centre as to another, so the steps end there, too. Clusters are numbered by the final centres'
    order, first column first. The rows are read once for each step: give a stored frame.
    """
    complete = df.where(_known(columns))
    values = [F.coalesce(v, F.lit(0.0)) for v in scaled(fit_moments(complete, columns))]
    names = [f"_z{i}" for i in range(len(values))]
    points = staged(complete.select(*[v.alias(n) for v, n in zip(values, names)]), "points")
    centers = [((2 * i + 1) / k - 1,) * len(values) for i in range(k)]
    seen = [np.array(centers)]
    settled = False
    while not settled:
        if steps is not None and len(seen) > steps:
            raise RuntimeError(f"the centres still move after {steps} steps")
        nearest = _nearest([F.col(n) for n in names], centers)
        means = points.groupBy(nearest.alias("_c")).agg(*[F.avg(n).alias(n) for n in names])
        found = {r["_c"]: tuple(r[n] for n in names) for r in means.collect()}
        centers = [found.get(i + 1, c) for i, c in enumerate(centers)]
        settled = any(np.abs(np.array(centers) - old).max(initial=0.0) <= SETTLED for old in reversed(seen))
        seen.append(np.array(centers))
    return df.withColumn(name, F.when(_known(columns), _nearest(values, sorted(centers))))


def bisecting(
    df: DataFrame,
    columns: Sequence[str] = AGENT_FEATURES,
    k: int = 3,
    seed: int = 123,
    name: str = "cluster_hierarchical",
) -> DataFrame:
    """Hierarchical clusters by repeated splitting; incomplete rows keep NULL.

    Merging bottom-up needs all pairs of rows; splitting top-down does not. The splitter
    moves a centre by a fraction of its length, and the centre of scaled data is the origin:
    without a shift, which changes no distance, it would never split.
    """
    frame, _ = _scaled_frame(df, columns, shift=1.0)
    points = frame.select("_features").persist()
    try:
        model = BisectingKMeans(
            k=k, seed=seed, featuresCol="_features", predictionCol="_p"
        ).fit(points)
    finally:
        points.unpersist()
    labelled = model.transform(frame).select(
        *df.columns, (F.col("_p") + 1).cast("int").alias(name)
    )
    rest = df.filter(~_known(columns)).withColumn(name, F.lit(None).cast("int"))
    return labelled.unionByName(rest)
