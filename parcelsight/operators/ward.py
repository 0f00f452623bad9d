"""Bottom-up clusters of any number of rows: Ward merging of mergeable cluster features.

Rows are summed up in leaves, the cells of a grid over the scaled columns, by count, sums and sum
of squares. Two features of one cell are merged by adding them, so partitions build their own and
one small shuffle brings them together; a coarser grid merges cells of the finer one. Only the
leaves, at most a stated number, are merged step by step into a dendrogram, which can be cut at any
number of clusters. Where every row is a leaf of its own the result is that of Ward's method on all
rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelsight.operators.cluster import AGENT_FEATURES, _known
from parcelsight.operators.prep import Moments, fit_moments, scaled
from parcelsight.operators.quality import require_rows
from parcelsight.sources.scratch import staged

#: Leaves that are merged at most.
LEAVES = 4096
#: Widths of the grid that are tried, in standard deviations: 2 ^ -FINEST and its doubles.
FINEST = 16


def _cells(values: Sequence[Column], width: float) -> list[Column]:
    """Cell of each scaled value, cut towards zero: halving a cell gives that of twice the width."""
    return [F.floor(F.abs(v) / F.lit(width)) * F.signum(v).cast("long") for v in values]


def leaf_features(df: DataFrame, moments: Moments, width: float) -> DataFrame:
    """One row for each cell that holds rows: cell_i, ``n``, sum_i and ``squares`` of the scaled
    columns. Rows that lack a column have no cell; a constant column counts as 0."""
    values = _scaled(moments)
    names = [f"cell_{i}" for i in range(len(values))]
    rows = df.where(_known(moments.columns)).select(
        *[c.alias(n) for c, n in zip(_cells(values, width), names, strict=True)],
        *[v.alias(f"z_{i}") for i, v in enumerate(values)],
    )
    squares = sum((F.col(f"z_{i}") ** 2 for i in range(1, len(values))), F.col("z_0") ** 2)
    return rows.groupBy(*names).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(f"z_{i}").alias(f"sum_{i}") for i in range(len(values))],
        F.sum(squares).alias("squares"),
    )


def merged_features(leaves: DataFrame, halvings: int = 0) -> DataFrame:
    """Features of equal cells added up, after making cells 2 ^ ``halvings`` times as wide.

    Leaves of several frames, scaled by the same moments, are merged by their union.
    """
    cells = [c for c in leaves.columns if c.startswith("cell_")]
    wider = {c: F.shiftright(F.abs(c), halvings) * F.signum(c).cast("long") for c in cells}
    sums = [c for c in leaves.columns if c not in cells]
    return leaves.withColumns(wider).groupBy(*cells).agg(*[F.sum(c).alias(c) for c in sums])


def _scaled(moments: Moments) -> list[Column]:
    return [F.coalesce(v, F.lit(0.0)) for v in scaled(moments)]


@dataclass(frozen=True)
class Dendrogram:
    """The leaves of some rows and how they were merged.

    Leaves are numbered from 0 in the order of their cells; the cluster of merge i is number
    leaves + i. Merges are in the order of their height, which for two single rows is their
    distance (the square root of twice the growth of the squares within clusters).
    """

    moments: Moments
    width: float
    cells: np.ndarray
    sizes: np.ndarray
    sums: np.ndarray
    left: np.ndarray
    right: np.ndarray
    height: np.ndarray

    def labels(self, k: int) -> np.ndarray:
        """Cluster of each leaf, from 1 to ``k``, in the order of the clusters' means (first column
        first). With fewer leaves than ``k`` every leaf is a cluster."""
        leaves = len(self.sizes)
        parent = np.arange(leaves + len(self.left))
        for i in range(max(0, leaves - k)):
            parent[[self.left[i], self.right[i]]] = leaves + i
        for i in range(len(parent) - 1, -1, -1):
            parent[i] = parent[parent[i]]
        roots, of = np.unique(parent[:leaves], return_inverse=True)
        n = np.bincount(of, self.sizes)
        means = [np.bincount(of, s) / n for s in self.sums.T]
        order = np.lexsort(means[::-1])
        rank = np.empty(len(roots), np.int64)
        rank[order] = np.arange(1, len(roots) + 1)
        return rank[of]

    def merges(self, spark: SparkSession) -> DataFrame:
        """One row for each merge: ``step`` (from 1), the clusters ``left`` and ``right``, the rows
        in the new cluster, and ``height``."""
        leaves = len(self.sizes)
        held = [int(n) for n in self.sizes]
        rows = []
        for i, (a, b, h) in enumerate(zip(self.left.tolist(), self.right.tolist(), self.height.tolist())):
            held.append(held[a] + held[b])
            rows.append((i + 1, a, b, held[leaves + i], h))
        return spark.createDataFrame(rows, "step long, left long, right long, n long, height double")

    def apply(self, df: DataFrame, names: dict[str, int]) -> DataFrame:
        """Rows with a label for each name at its number of clusters.

        Rows that lack a column, or whose cell no leaf has, get NULL. The leaves' labels are a
        table of at most the stated number of leaves, sent to every task.
        """
        spark, keys = df.sparkSession, [f"_cell_{i}" for i in range(self.cells.shape[1])]
        columns = [self.labels(k).tolist() for k in names.values()]
        rows = [
            (*map(int, cell), *label)
            for cell, label in zip(self.cells.tolist(), zip(*columns, strict=True), strict=True)
        ]
        schema = ", ".join([f"{c} long" for c in keys] + [f"_label_{i} int" for i in range(len(names))])
        leaves = spark.createDataFrame(rows, schema)
        inside = _known(self.moments.columns)
        cells = {
            c: F.when(inside, v) for c, v in zip(keys, _cells(_scaled(self.moments), self.width), strict=True)
        }
        added = [F.col(f"_label_{i}").alias(name) for i, name in enumerate(names)]
        kept = [F.col(f"`{c}`") for c in df.columns if c not in names]
        return df.withColumns(cells).join(F.broadcast(leaves), keys, "left").select(*kept, *added)


def ward_merges(sizes: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Left, right and height of every merge of clusters with ``sizes`` rows and column ``sums``.

    A chain of nearest neighbours ends in a pair that are nearest to each other; Ward's costs let
    such a pair be merged at once, whatever else is merged before. Memory grows with the leaves,
    time with their square. Equal costs go to the cluster that comes first.
    """
    count = len(sizes)
    n = np.concatenate((sizes.astype(float), np.zeros(max(0, count - 1))))
    centre = np.zeros((len(n), sums.shape[1]))
    centre[:count] = sums / sizes[:, None]
    alive = np.zeros(len(n), bool)
    alive[:count] = True
    chain: list[int] = []
    found = []
    for new in range(count, len(n)):
        if not chain:
            chain.append(int(np.flatnonzero(alive)[0]))
        while True:
            last = chain[-1]
            cost = np.full(len(n), np.inf)
            gaps = ((centre[alive] - centre[last]) ** 2).sum(axis=1)
            cost[alive] = gaps * n[alive] * n[last] / (n[alive] + n[last])
            cost[last] = np.inf
            near = int(cost.argmin())
            if len(chain) > 1 and cost[chain[-2]] <= cost[near]:
                near = chain[-2]
                break
            chain.append(near)
        del chain[-2:]
        found.append((cost[near], min(near, last), max(near, last), new))
        n[new] = n[near] + n[last]
        centre[new] = (centre[near] * n[near] + centre[last] * n[last]) / n[new]
        alive[[near, last]] = False
        alive[new] = True
    # A merge follows those of its parts: their costs are not larger, and equal ones come earlier.
    found.sort(key=lambda m: (m[0], m[3]))
    number = {old: count + i for i, (_, _, _, old) in enumerate(found)}
    ends = [sorted((number.get(a, a), number.get(b, b))) for _, a, b, _ in found]
    pairs = np.array(ends, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1], np.sqrt(2 * np.array([c for c, _, _, _ in found], float))


def _width(df: DataFrame, moments: Moments, leaves: int) -> float:
    """The smallest width with about as many cells as leaves are allowed, by sketches of all widths
    in one pass."""
    values, complete = _scaled(moments), df.where(_known(moments.columns))
    counts = complete.agg(
        *[
            F.approx_count_distinct(F.xxhash64(*_cells(values, 2.0**-i)), 0.02).alias(f"w{i}")
            for i in range(FINEST + 1)
        ]
    ).first()
    fitting = [i for i in range(FINEST + 1) if counts[f"w{i}"] <= leaves]
    return 2.0 ** -max(fitting, default=0)


def dendrogram(
    df: DataFrame,
    columns: Sequence[str] = AGENT_FEATURES,
    width: float | None = None,
    leaves: int = LEAVES,
) -> Dendrogram:
    """Merge the complete rows of a frame, scaled, from leaves to one cluster.

    Without a ``width`` the finest grid is taken whose cells are not more than ``leaves``. Of a
    given one cells are merged, twice as wide at a time, until they are not. Rows are read three
    times: give a stored frame. Without complete rows an error is raised.
    """
    complete = df.where(_known(columns))
    require_rows(complete, 1, "clustering input")
    moments = fit_moments(complete, columns)
    width = width or _width(df, moments, leaves)
    features = staged(leaf_features(df, moments, width), "leaves")
    while features.count() > leaves:
        features, width = staged(merged_features(features, 1), "leaves"), 2 * width
    held = features.toArrow()
    cells = np.stack([held.column(f"cell_{i}").to_numpy() for i in range(len(columns))], axis=1)
    order = np.lexsort(cells.T[::-1])
    sums = np.stack([held.column(f"sum_{i}").to_numpy() for i in range(len(columns))], axis=1)[order]
    sizes = held.column("n").to_numpy()[order]
    return Dendrogram(moments, width, cells[order], sizes, sums, *ward_merges(sizes, sums))


def hierarchy(
    df: DataFrame,
    columns: Sequence[str] = AGENT_FEATURES,
    k: int = 3,
    name: str = "cluster_hierarchical",
    width: float | None = None,
    leaves: int = LEAVES,
) -> DataFrame:
    """Rows with their cluster of a dendrogram cut at ``k``; incomplete rows keep NULL."""
    return dendrogram(df, columns, width, leaves).apply(df, {name: k})
