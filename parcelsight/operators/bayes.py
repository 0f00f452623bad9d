"""Naive Bayes for mixed predictors: normal densities and level shares, no smoothing."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Stand-in for a zero deviation, share or density: fixed value.
FLOOR = 0.001
# Level shares of one predictor kept as literals; more are looked up by a join, with the same
# result.
LITERAL_LEVELS = 1_000


@dataclass
class NaiveBayesModel:
    """Numbers per class; level shares of a predictor as numbers, or as a table to join."""

    labels: list[str]
    prior: dict[str, float]
    normal: dict[tuple[str, str], tuple[float, float]]
    shares: dict[str, dict[tuple[str, str], float]]
    joined: dict[str, DataFrame] = field(default_factory=dict)

    def save(self, spark: SparkSession, path: str) -> str:
        """Store the model, replacing an earlier one."""
        numbers = {
            "labels": self.labels,
            "prior": self.prior,
            "normal": [[c, k, mean, sd] for (c, k), (mean, sd) in self.normal.items()],
            "shares": {c: [[v, k, p] for (v, k), p in s.items()] for c, s in self.shares.items()},
            "joined": list(self.joined),
        }
        text = spark.createDataFrame([(json.dumps(numbers),)], "model string")
        for i, table in enumerate(self.joined.values()):
            table.write.mode("overwrite").parquet(f"{path}/joined_{i}")
        text.coalesce(1).write.mode("overwrite").text(f"{path}/numbers")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> NaiveBayesModel:
        """Counterpart of :meth:`save`."""
        numbers = json.loads(spark.read.text(f"{path}/numbers").first()[0])
        return NaiveBayesModel(
            numbers["labels"],
            numbers["prior"],
            {(c, k): (mean, sd) for c, k, mean, sd in numbers["normal"]},
            {c: {(v, k): p for v, k, p in s} for c, s in numbers["shares"].items()},
            {c: spark.read.parquet(f"{path}/joined_{i}") for i, c in enumerate(numbers["joined"])},
        )


@dataclass
class Counts:
    """What a model is made of, in parts that add up: rows of each class, number, mean and squared
    deviations of each predictor in each class, and rows (label, level, n) of each level."""

    label: str
    rows: dict[str, int]
    normal: dict[tuple[str, str], tuple[int, float, float]]
    levels: dict[str, DataFrame]

    def merged(self, other: Counts) -> Counts:
        """Counts of the rows of both; the label and the predictors must be the same."""
        if self.label != other.label or set(self.levels) != set(other.levels):
            raise ValueError("counts of other predictors do not merge")
        rows = {k: self.rows.get(k, 0) + other.rows.get(k, 0) for k in self.rows | other.rows}
        normal = dict(self.normal)
        for key, (n, mean, squares) in other.normal.items():
            m, before, held = normal.get(key, (0, 0.0, 0.0))
            total = m + n
            gap = mean - before
            if total:
                before += gap * n / total
                held += squares + gap * gap * m * n / total
            normal[key] = (total, before, held)
        both = {c: t.unionByName(other.levels[c]) for c, t in self.levels.items()}
        sums = {
            c: t.groupBy(self.label, "level").agg(F.sum("n").alias("n")) for c, t in both.items()
        }
        return Counts(self.label, rows, normal, sums)

    def model(self) -> NaiveBayesModel:
        """Normal densities and level shares of the counted rows."""
        labels, total = sorted(self.rows), sum(self.rows.values())
        normal = {}
        for (c, k), (n, mean, squares) in self.normal.items():
            sd = math.sqrt(squares / (n - 1)) if n > 1 else None
            normal[c, k] = (mean if n else None, sd or FLOOR)
        prior = {k: math.log(n / total) for k, n in self.rows.items()}
        model = NaiveBayesModel(labels, prior, normal, {})
        for c, counts in self.levels.items():
            seen = counts.limit(LITERAL_LEVELS + 1).collect()
            if len(seen) > LITERAL_LEVELS:
                model.joined[c] = _share_table(counts, self.label, labels)
                continue
            per_class = {k: sum(r["n"] for r in seen if r[self.label] == k) for k in labels}
            model.shares[c] = {
                (r["level"], r[self.label]): r["n"] / per_class[r[self.label]] for r in seen
            }
        return model

    def save(self, spark: SparkSession, path: str) -> str:
        """Store the counts, replacing earlier ones; not those that these were read from."""
        numbers = {
            "label": self.label,
            "rows": self.rows,
            "normal": [[c, k, *three] for (c, k), three in self.normal.items()],
            "levels": list(self.levels),
        }
        for i, table in enumerate(self.levels.values()):
            table.write.mode("overwrite").parquet(f"{path}/levels_{i}")
        text = spark.createDataFrame([(json.dumps(numbers),)], "counts string")
        text.coalesce(1).write.mode("overwrite").text(f"{path}/numbers")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> Counts:
        """Counterpart of :meth:`save`."""
        numbers = json.loads(spark.read.text(f"{path}/numbers").first()[0])
        return Counts(
            numbers["label"],
            numbers["rows"],
            {(c, k): tuple(three) for c, k, *three in numbers["normal"]},
            {c: spark.read.parquet(f"{path}/levels_{i}") for i, c in enumerate(numbers["levels"])},
        )


def _level_counts(train: DataFrame, label: str, column: str) -> DataFrame:
    known = train.filter(F.col(column).isNotNull() & F.col(label).isNotNull())
    return known.groupBy(label, F.col(column).alias("level")).agg(F.count(F.lit(1)).alias("n"))


def count(
    train: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str]
) -> Counts:
    """Moments per class and level counts per class; missing values are left out of both."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in numeric:
        aggs += [F.count(c).alias(f"n_{c}"), F.avg(c).alias(f"mean_{c}"), F.var_pop(c).alias(f"var_{c}")]
    rows = train.filter(F.col(label).isNotNull()).groupBy(label).agg(*aggs).collect()
    normal = {
        (c, r[label]): (r[f"n_{c}"], r[f"mean_{c}"] or 0.0, (r[f"var_{c}"] or 0.0) * r[f"n_{c}"])
        for r in rows
        for c in numeric
    }
    levels = {c: _level_counts(train, label, c) for c in categorical}
    return Counts(label, {r[label]: r["n"] for r in rows}, normal, levels)


def fit(
    train: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str]
) -> NaiveBayesModel:
    """The model of some rows; see :class:`Counts` for one that more rows can be added to."""
    return count(train, label, numeric, categorical).model()


def _share_table(counts: DataFrame, label: str, labels: Sequence[str]) -> DataFrame:
    """Wide table of log shares per level, for predictors with very many levels."""
    sums = counts.groupBy(label).agg(F.sum("n").alias("class_n"))
    shares = counts.join(sums, label).withColumn("share", F.col("n") / F.col("class_n"))
    by_label = F.map_from_entries(F.collect_list(F.struct(label, "share")))
    wide = shares.groupBy("level").agg(by_label.alias("_by"))
    return wide.select(
        "level",
        *[
            F.log(F.coalesce(F.try_element_at("_by", F.lit(k)), F.lit(FLOOR))).alias(f"_share_{i}")
            for i, k in enumerate(labels)
        ],
    )


def _log_density(x: Column, mean: float | None, sd: float) -> Column:
    if mean is None:
        return F.lit(0.0)
    z = (x - F.lit(mean)) / F.lit(sd)
    log_density = F.lit(-0.5) * z * z - F.lit(math.log(sd) + 0.5 * math.log(2 * math.pi))
    floored = F.when(F.exp(log_density) == 0.0, F.lit(math.log(FLOOR))).otherwise(log_density)
    return F.coalesce(floored, F.lit(0.0))


def _log_share(x: Column, shares: dict[tuple[str, str], float], label: str) -> Column:
    levels = {level for level, _ in shares}
    chain = F.when(x.isNull(), F.lit(0.0))
    for level in sorted(levels):
        share = max(shares.get((level, label), 0.0), 0.0) or FLOOR
        chain = chain.when(x == F.lit(level), F.lit(math.log(share)))
    return chain.otherwise(F.lit(0.0))


def predict(
    model: NaiveBayesModel, rows: DataFrame, prediction: str = "prediction"
) -> DataFrame:
    """Add a log score per class and the class with the largest one (first on ties).

    A missing value, or a level no class was trained on, says nothing and is skipped.
    """
    scored = rows
    for c, table in model.joined.items():
        renamed = table.withColumnsRenamed(
            {"level": c, **{f"_share_{i}": f"_{c}_{i}" for i in range(len(model.labels))}}
        )
        scored = scored.join(renamed, c, "left")
    scores = []
    for i, k in enumerate(model.labels):
        score = F.lit(model.prior[k])
        for (c, label), (mean, sd) in model.normal.items():
            if label == k:
                score = score + _log_density(F.col(c), mean, sd)
        for c, shares in model.shares.items():
            score = score + _log_share(F.col(c), shares, k)
        for c in model.joined:
            score = score + F.coalesce(F.col(f"_{c}_{i}"), F.lit(0.0))
        scores.append(score.alias(f"score_{k}"))
    scored = scored.select(*rows.columns, *scores)
    names = F.array(*[F.col(f"`score_{k}`") for k in model.labels])
    place = F.array_position(names, F.array_max(names)).cast("int")
    labels = F.array(*[F.lit(k) for k in model.labels])
    return scored.withColumn(prediction, F.try_element_at(labels, place))
