"""Classification trees grown level by level in Spark: exact splits, pruning, out-of-bag votes.

All nodes of a level, of all trees, are split at once. Class counts of each distinct value are summed
up in the order of the values over range partitions, so the best threshold of a node is exact and
the root, which holds all rows, is no task of its own. Trees, which are small, are kept as numbers;
rows are never collected.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelsight.functions.columns import uniform
from parcelsight.operators.numbering import running_totals
from parcelsight.sources.scratch import staged

#: Rows of a node that is still split, and of a leaf, at least; least share of the root's risk.
MIN_SPLIT, MIN_LEAF, COMPLEXITY = 20, 7, 0.01
#: Parts that the rows are dealt into for cross-validation.
FOLDS = 10
#: Nodes of a level that may be split; more are an error, for they are kept in the driver.
LEVEL_NODES = 100_000
#: Chance that a row is drawn at most 0, 1, 2, ... times: the Poisson distribution of mean 1.
DRAWN = tuple(sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(12))


@dataclass
class Node:
    """Weight of each class in a node, in all and by fold, and how it is split."""

    counts: list[int]
    folds: list[list[int]] = field(default_factory=list)
    #: Place of the predictor, numeric ones first; none in a leaf.
    predictor: int | None = None
    #: Values up to this go to the left; of a categorical predictor these levels do, and the others
    #: to the right. A level that is in neither goes where more rows went.
    threshold: float | None = None
    left: list[str] | None = None
    right: list[str] | None = None
    gain: float = 0.0

    def risk(self, fold: int | None = None) -> int:
        """Weight of all but the most frequent class; without the rows of one fold, if given."""
        counts = self.kept(fold)
        return sum(counts) - max(counts)

    def kept(self, fold: int | None) -> list[int]:
        if fold is None:
            return self.counts
        return [a - b for a, b in zip(self.counts, self.folds[fold], strict=True)]


@dataclass
class Tree:
    """Nodes by number: 1 is the root, and the children of node i are 2 i and 2 i + 1."""

    nodes: dict[int, Node]

    def leaves(self, penalty: float = -1.0, fold: int | None = None) -> list[int]:
        """Leaves of the smallest subtree with the least risk, each leaf costing ``penalty`` more;
        a negative one keeps all."""
        cost: dict[int, tuple[float, list[int]]] = {}
        for i in sorted(self.nodes, reverse=True):
            node = self.nodes[i]
            alone = node.risk(fold) + penalty
            if node.predictor is None:
                cost[i] = (alone, [i])
                continue
            (a, one), (b, two) = cost.pop(2 * i), cost.pop(2 * i + 1)
            if penalty >= 0 and alone <= a + b + 1e-9:
                cost[i] = (alone, [i])
            else:
                cost[i] = (a + b, one + two)
        return sorted(cost[1][1])

    def pruned(self, complexity: float) -> Tree:
        """The smallest subtree with the least risk, where a leaf costs a share of the root's risk."""
        return self.cut_at(self.leaves(complexity * self.nodes[1].risk()))

    def cut_at(self, leaves: Sequence[int]) -> Tree:
        """The subtree whose leaves are some of this tree's nodes."""
        nodes, kept = {}, set(leaves)
        todo = [1]
        while todo:
            i = todo.pop()
            node = self.nodes[i]
            if i in kept or node.predictor is None:
                node = replace(node, predictor=None, threshold=None, left=None, right=None, gain=0.0)
            else:
                todo += [2 * i, 2 * i + 1]
            nodes[i] = node
        return Tree(dict(sorted(nodes.items())))

    def path(self) -> list[tuple[float, list[int]]]:
        """Weakest links: each penalty at which the best subtree gets smaller, and its leaves.

        The link whose subtree lowers the risk least for each leaf is cut again and again, until
        the root is left; the first penalty is 0.
        """
        out, tree = [], self.cut_at(self.leaves(0.0))
        out.append((0.0, tree.leaves()))
        while tree.nodes[1].predictor is not None:
            below: dict[int, tuple[int, int]] = {}
            links = {}
            for i in sorted(tree.nodes, reverse=True):
                node = tree.nodes[i]
                if node.predictor is None:
                    below[i] = (node.risk(), 1)
                    continue
                (a, m), (b, n) = below.pop(2 * i), below.pop(2 * i + 1)
                below[i] = (a + b, m + n)
                links[i] = (node.risk() - a - b) / (m + n - 1)
            weakest = min(links.values())
            tree = tree.cut_at([i for i, x in links.items() if x <= weakest + 1e-9])
            out.append((weakest, tree.leaves()))
        return out

    def validated(self) -> list[tuple[float, int, float, float, float]]:
        """Per step of the path: complexity (the penalty's share of the root's risk), leaves, and
        the training error, cross-validated error and its deviation as shares of the root's risk.

        The folds' counts in each node are enough: for each fold the subtree and its leaves' classes
        are chosen by the counts of the other rows, and the fold's rows are judged. Splits are
        those of all rows.
        """
        root, path = self.nodes[1].risk() or 1, self.path()
        penalties = [p for p, _ in path] + [math.inf]
        total, folds = sum(self.nodes[1].counts), range(len(self.nodes[1].folds))
        out = []
        for at, (penalty, leaves) in enumerate(path):
            # Between two penalties the subtree is the same; the middle one stands for them.
            middle = math.sqrt(penalty * penalties[at + 1]) if at + 1 < len(path) else math.inf
            wrong = 0
            for fold in folds:
                rest = total - sum(self.nodes[1].folds[fold])
                share = rest / total if total else 0.0
                cost = middle * share if math.isfinite(middle) else float(total + 1)
                for leaf in self.leaves(cost, fold):
                    node = self.nodes[leaf]
                    kept = node.kept(fold)
                    wrong += sum(node.folds[fold]) - node.folds[fold][kept.index(max(kept))]
            error = sum(self.nodes[i].risk() for i in leaves) / root
            spread = math.sqrt(wrong * max(0.0, 1 - wrong / total)) / root if total else 0.0
            out.append((penalty / root, len(leaves), error, wrong / root, spread))
        return out

    def best(self) -> Tree:
        """The smallest subtree of the path whose cross-validated error is within one deviation of
        the least one."""
        steps = self.validated()
        least = min(steps, key=lambda s: s[3])
        at = max(i for i, s in enumerate(steps) if s[3] <= least[3] + least[4])
        return self.cut_at(self.path()[at][1])


def _level(column: str) -> Column:
    """A level as text; a missing one is a level of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{column}`").cast("string")), F.lit(""))


@dataclass
class Forest:
    """One tree or more over the same predictors, with the classes in the order of their codes and
    the numbers that stand for missing ones."""

    classes: list[str]
    numeric: list[str]
    categorical: list[str]
    medians: list[float]
    trees: list[Tree]

    def inputs(self) -> tuple[Column, Column]:
        """Predictors as arrays: numbers, and levels."""
        numbers = [
            F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)), F.lit(m))
            for c, m in zip(self.numeric, self.medians, strict=True)
        ]
        return (
            F.array(*numbers) if numbers else F.array().cast("array<double>"),
            F.array(*[_level(c) for c in self.categorical]) if self.categorical else F.array().cast("array<string>"),
        )

    def save(self, spark: SparkSession, path: str) -> str:
        """Store the model, replacing an earlier one."""
        text = spark.createDataFrame([(json.dumps(asdict(self)),)], "model string")
        text.coalesce(1).write.mode("overwrite").text(path)
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forest:
        """Counterpart of :meth:`save`."""
        held = json.loads(spark.read.text(path).first()[0])
        trees = [{int(i): Node(**n) for i, n in t["nodes"].items()} for t in held.pop("trees")]
        return Forest(**held, trees=[Tree(t) for t in trees])


def poisson(key: Sequence[str], tree: int) -> Column:
    """How often a row is drawn for a tree: a Poisson number of mean 1 from the row's key."""
    return _copies(uniform(key, f"tree{tree}"))


def _copies(u: Column) -> Column:
    return sum((F.when(u >= F.lit(x), 1).otherwise(0) for x in DRAWN[1:]), F.when(u >= F.lit(DRAWN[0]), 1).otherwise(0))


def _drawn_numbers(key: Sequence[str], trees: int) -> list[Column]:
    """The numbers behind ``poisson``, for columns of their own (_u0, ...): one digest for each row and
    tree. Inside an array that is filtered it would be worked out for each number of copies."""
    return [uniform(key, f"tree{t}").alias(f"_u{t}") for t in range(trees)]


def _drawn(tree: int, node: int, predictors: int, some: int) -> list[int]:
    """The predictors that a node may be split by, drawn by its number; the same as ``uniform``
    over tree, node and predictor."""

    def number(p: int) -> int:
        return int(hashlib.md5(f"{tree}|{node}|{p}|split".encode()).hexdigest()[:13], 16)

    return sorted(sorted(range(predictors), key=number)[:some])


def _binned(value: Column, bounds: Sequence[float]) -> Column:
    """The smallest bound that is not under the value."""
    return F.array_min(F.filter(F.array(*[F.lit(float(b)) for b in bounds]), lambda b: b >= value))


class _Grower:
    def __init__(self, frame, forest, tries, bins, min_split, min_leaf, complexity, folds):
        self.frame, self.forest, self.tries, self.bins = frame, forest, tries, bins
        self.min_split, self.min_leaf = min_split, min_leaf
        self.complexity, self.folds = complexity, folds
        self.counts = [f"_n{k}" for k in range(len(forest.classes))]
        self.spark = frame.sparkSession

    def _sums(self) -> list[Column]:
        return [
            F.sum(F.when(F.col("_class") == k, F.col("_w")).otherwise(0)).alias(c)
            for k, c in enumerate(self.counts)
        ]

    def meet(self) -> list[tuple[int, int]]:
        """Count the classes of the nodes that the rows are in now; the nodes met."""
        met = []
        rows = self.frame.groupBy("_tree", "_node", "_fold").agg(*self._sums()).collect()
        for r in rows:
            nodes, k = self.forest.trees[r["_tree"]].nodes, len(self.counts)
            if r["_node"] not in nodes:
                met.append((r["_tree"], r["_node"]))
                nodes[r["_node"]] = Node([0] * k, [[0] * k for _ in range(self.folds)])
            node, found = nodes[r["_node"]], [r[c] for c in self.counts]
            node.counts = [a + b for a, b in zip(node.counts, found, strict=True)]
            node.folds[r["_fold"]] = found
        return sorted(met)

    def splittable(self, met: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Nodes that have rows enough, several classes, and more risk than a split must save."""
        out = []
        for tree, i in met:
            nodes = self.forest.trees[tree].nodes
            risk, root = nodes[i].risk(), nodes[1].risk()
            if sum(nodes[i].counts) >= self.min_split and risk > self.complexity * root and risk > 0:
                out.append((tree, i))
        if len(out) > LEVEL_NODES:
            raise ValueError(f"{len(out)} nodes to split at once: ask for larger leaves or more complexity")
        return out

    def _values(self, rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Class counts of each value of each predictor that a node may be split by, and those of
        the levels. A level's value is its share of a class; with more than two classes there is one
        order for each class."""
        n, parts, levels = len(self.forest.numeric), [], None
        keys = ("_tree", "_node", "_p")

        def one_each(values: str, first: int, size: int) -> Column:
            places = F.filter("_some", lambda p: (p >= first) & (p < first + size))
            return F.transform(
                places,
                lambda p: F.struct(p.alias("_p"), F.element_at(values, p - first + 1).alias("_value")),
            )

        if n:
            long = rows.select("_tree", "_node", "_class", "_w", F.explode(one_each("_x", 0, n)).alias("_one"))
            long = long.select("_tree", "_node", "_class", "_w", "_one.*")
            parts.append(long.withColumn("_o", F.lit(0)).groupBy(*keys, "_o", "_value").agg(*self._sums()))
        if self.forest.categorical:
            size = len(self.forest.categorical)
            long = rows.select("_tree", "_node", "_class", "_w", F.explode(one_each("_c", n, size)).alias("_one"))
            long = long.select("_tree", "_node", "_class", "_w", "_one.*")
            levels = staged(long.groupBy(*keys, "_value").agg(*self._sums()), "levels")
            total = sum((F.col(c) for c in self.counts[1:]), F.col(self.counts[0]))
            shares = [
                F.struct(F.lit(k).alias("_o"), (F.col(c) / total).alias("_share"))
                for k, c in enumerate(self.counts)
            ]
            orders = shares[1:] if len(shares) == 2 else shares
            levels = levels.select("*", F.explode(F.array(*orders)).alias("_in"))
            levels = levels.select(*keys, "_value", *self.counts, "_in.*")
            ordered = levels.groupBy(*keys, "_o", F.col("_share").alias("_value"))
            parts.append(ordered.agg(*[F.sum(c).alias(c) for c in self.counts]))
        both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return both, levels

    def split(self, active: list[tuple[int, int]], last: bool) -> list[tuple[int, int]]:
        """Find the best split of each node, and move the rows of those that have one; the nodes they
        are in then. Without folds the split itself tells these nodes' counts, and rows that will not
        be split again need not move."""
        n = len(self.forest.numeric)
        every = n + len(self.forest.categorical)
        known = [
            (t, i, _drawn(t, i, every, self.tries), self.forest.trees[t].nodes[i].counts)
            for t, i in active
        ]
        nodes = self.spark.createDataFrame(known, "_tree int, _node long, _some array<int>, _all array<long>")
        # As many rows as nodes are split at once: at most LEVEL_NODES.
        inside = self.frame.join(F.broadcast(nodes.drop("_all")), ["_tree", "_node"])
        values, levels = self._values(inside)
        totals = running_totals(values, ["_tree", "_node", "_p", "_o"], "_value", self.counts)
        met = totals.join(F.broadcast(nodes.drop("_some")), ["_tree", "_node"])
        left = sum((F.col(c) for c in self.counts[1:]), F.col(self.counts[0]))
        whole = F.aggregate("_all", F.lit(0).cast("long"), lambda a, x: a + x)
        squares = [F.lit(0.0), F.lit(0.0), F.lit(0.0)]
        for k, c in enumerate(self.counts):
            total = F.element_at("_all", k + 1)
            for at, x in enumerate((F.col(c), total - F.col(c), total)):
                squares[at] = squares[at] + x.cast("double") * x.cast("double")
        met = met.withColumns({"_l": left, "_r": whole - left})
        met = met.where(F.least("_l", "_r") >= max(1, self.min_leaf))
        gain = squares[0] / F.col("_l") + squares[1] / F.col("_r") - squares[2] / (F.col("_l") + F.col("_r"))
        ranked = F.struct((-F.round(gain, 9)).alias("_loss"), "_p", "_o", "_value", "following", *self.counts)
        best = met.groupBy("_tree", "_node").agg(F.min(ranked).alias("_best")).where("_best._loss < 0")
        found = best.select("_tree", "_node", "_best.*").collect()
        if not found:
            return []
        wanted = [(r["_tree"], r["_node"], r["_p"], r["_o"], r["_value"]) for r in found]
        sides: dict[tuple[int, int], tuple[list, list]] = {}
        if levels is not None and any(r["_p"] >= n for r in found):
            won = self.spark.createDataFrame(wanted, "_tree int, _node long, _p int, _o int, _cut double")
            chosen = levels.join(F.broadcast(won), ["_tree", "_node", "_p", "_o"])
            for r in chosen.select("_tree", "_node", "_value", (F.col("_share") > F.col("_cut")).alias("_up")).collect():
                sides.setdefault((r["_tree"], r["_node"]), ([], []))[r["_up"]].append(r["_value"])
        moves, met_next = [], []
        for r in found:
            at = (r["_tree"], r["_node"])
            node = self.forest.trees[at[0]].nodes[at[1]]
            node.predictor, node.gain = r["_p"], -r["_loss"]
            if r["_p"] < n:
                # Between the two values; a bin's bound is a threshold as it is.
                node.threshold = r["_value"] if self.bins else (r["_value"] + r["following"]) / 2
            else:
                node.left, node.right = map(sorted, sides[at])
            moves.append((*at, r["_p"], node.threshold, node.left))
            if self.folds == 1:
                under = [int(r[c]) for c in self.counts]
                over = [a - b for a, b in zip(node.counts, under, strict=True)]
                nodes = self.forest.trees[at[0]].nodes
                for i, counts in ((2 * at[1], under), (2 * at[1] + 1, over)):
                    nodes[i] = Node(counts, [list(counts)])
                    met_next.append((at[0], i))
        if self.folds == 1 and last:
            return sorted(met_next)
        plan = self.spark.createDataFrame(
            moves, "_tree int, _node long, _p int, _cut double, _left array<string>"
        )
        met = self.frame.join(F.broadcast(plan), ["_tree", "_node"])
        number = F.element_at("_x", F.col("_p") + 1) <= F.col("_cut")
        level = F.array_contains("_left", F.element_at("_c", F.col("_p") - n + 1))
        goes = F.when(F.col("_p") < n, number if n else F.lit(False)).otherwise(
            level if self.forest.categorical else F.lit(False)
        )
        below = met.withColumn("_node", F.col("_node") * 2 + F.when(goes, 0).otherwise(1))
        self.frame = staged(below.select(*self.frame.columns), "tree-rows")
        return sorted(met_next) if self.folds == 1 else self.meet()


def grow(
    train: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    key: Sequence[str] = (),
    trees: int = 1,
    tries: int | None = None,
    bins: int | None = None,
    max_depth: int = 30,
    min_split: int = MIN_SPLIT,
    min_leaf: int = MIN_LEAF,
    complexity: float = COMPLEXITY,
    folds: int = FOLDS,
) -> Forest:
    """Trees by the Gini index, not pruned yet.

    One tree takes every row once; more are grown on Poisson numbers of copies drawn from ``key``.
    ``tries`` predictors are drawn for each node (all without it). Thresholds lie in the middle of
    two neighbouring values, the best of all; with ``bins`` only bounds of so many quantile bins
    are tried. A split saves the most of the Gini index; equal ones go to the first predictor, then
    the lowest threshold. A node is a leaf at ``max_depth``, with less than ``min_split`` rows, or if
    its risk is no more than ``complexity`` of the root's; so at most 1 / complexity nodes of a tree
    are split at once. Levels are split by their share of a class, which is best of all for two classes.

    Missing numbers (NaN too) count as the median, a missing level is one of its own, rows without
    label are left out. Folds of cross-validation are drawn from ``key``. No rows are an error.
    """
    labelled = train.where(F.col(label).isNotNull())
    classes = sorted(r[0] for r in labelled.select(F.col(label).cast("string")).distinct().collect())
    if not classes:
        raise ValueError("no labelled rows to grow a tree from")
    medians = [0.0] * len(numeric)
    if numeric:
        known = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c in numeric]
        row = labelled.agg(*[F.percentile_approx(v, 0.5, 10_000).alias(f"m{i}") for i, v in enumerate(known)]).first()
        medians = [0.0 if m is None else m for m in row]
    forest = Forest(classes, list(numeric), list(categorical), medians, [Tree({}) for _ in range(trees)])
    x, c = forest.inputs()
    if bins and numeric:
        shares = [i / bins for i in range(1, bins + 1)]
        row = labelled.agg(
            *[F.percentile_approx(F.element_at(x, i + 1), shares, 10_000).alias(f"b{i}") for i in range(len(numeric))]
        ).first()
        x = F.array(*[_binned(F.element_at(x, i + 1), sorted(set(b))) for i, b in enumerate(row)])
    code = F.array_position(F.array(*[F.lit(k) for k in classes]), F.col(label).cast("string")) - 1
    fold = F.floor(uniform(key, "fold") * folds).cast("int") if folds > 1 and key else F.lit(0)
    columns = [code.cast("int").alias("_class"), fold.alias("_fold"), x.alias("_x"), c.alias("_c")]
    if trees > 1:
        rows = labelled.select(*columns, *_drawn_numbers(key, trees))
        drawn = F.array(
            *[F.struct(F.lit(t).alias("_tree"), _copies(F.col(f"_u{t}")).cast("long").alias("_w")) for t in range(trees)]
        )
        rows = rows.select("_class", "_fold", "_x", "_c", F.explode(drawn).alias("_in")).select("*", "_in.*").where("_w > 0")
    else:
        rows = labelled.select(*columns, F.lit(0).alias("_tree"), F.lit(1).cast("long").alias("_w"))
    frame = rows.select("_tree", F.lit(1).cast("long").alias("_node"), "_w", "_class", "_fold", "_x", "_c")
    every = len(numeric) + len(categorical)
    grower = _Grower(
        staged(frame, "tree-rows"), forest, min(tries or every, every), bins, min_split, min_leaf,
        complexity, folds if folds > 1 and key else 1,
    )
    met = grower.meet()
    for depth in range(max_depth):
        active = grower.splittable(met)
        if not active or not every:
            break
        met = grower.split(active, last=depth + 1 == max_depth)
    return forest


def fit_tree(
    train: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    key: Sequence[str],
    complexity: float | None = COMPLEXITY,
    **more,
) -> Forest:
    """One tree, pruned at a given complexity, or without one at the size that cross-validation
    prefers."""
    forest = grow(train, label, numeric, categorical, key, complexity=complexity or COMPLEXITY, **more)
    tree = forest.trees[0]
    return replace(forest, trees=[tree.pruned(complexity) if complexity else tree.best()])


def fit_forest(
    train: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    key: Sequence[str],
    trees: int = 20,
    tries: int | None = None,
    bins: int | None = 32,
    max_depth: int = 8,
    min_leaf: int = 1,
) -> Forest:
    """Trees on rows drawn by key, each node with its own drawn predictors (by default as many as
    the square root of all); none is pruned."""
    tries = tries or max(1, math.isqrt(len(numeric) + len(categorical)))
    return grow(
        train, label, numeric, categorical, key, trees, tries, bins, max_depth, 2 * min_leaf, min_leaf,
        0.0, 1,
    )


def _reached(tree: Tree, numbers: np.ndarray, levels: list[pa.DictionaryArray]) -> np.ndarray:
    """The leaf of each row."""
    out = np.ones(len(numbers), np.int64)
    todo = [(1, np.arange(len(numbers)))]
    while todo:
        i, rows = todo.pop()
        node = tree.nodes[i]
        if node.predictor is None or not len(rows):
            out[rows] = i
            continue
        if node.threshold is not None:
            goes = numbers[rows, node.predictor] <= node.threshold
        else:
            held = levels[node.predictor - numbers.shape[1]]
            heavier = sum(tree.nodes[2 * i].counts) >= sum(tree.nodes[2 * i + 1].counts)
            left, right = set(node.left), set(node.right)
            side = [x in left or x not in right and heavier for x in held.dictionary.to_pylist()]
            goes = np.array(side, bool)[held.indices.to_numpy()][rows]
        todo += [(2 * i, rows[goes]), (2 * i + 1, rows[~goes])]
    return out


def _arrays(batch: pa.RecordBatch, forest: Forest, x: str, c: str) -> tuple[np.ndarray, list]:
    size = batch.num_rows
    numbers = batch.column(x).flatten().to_numpy(zero_copy_only=False).reshape(size, len(forest.numeric))
    flat, k = batch.column(c).flatten(), len(forest.categorical)
    return numbers, [flat.take(pa.array(np.arange(size) * k + j)).dictionary_encode() for j in range(k)]


def _votes(forest: Forest, numbers: np.ndarray, levels: list, weights: np.ndarray | None) -> np.ndarray:
    """Votes for each class: one of each tree, or, of one tree, the shares of the leaf. With weights
    only trees that a row was not drawn for vote."""
    k = len(forest.classes)
    out = np.zeros((len(numbers), k))
    for t, tree in enumerate(forest.trees):
        leaf = _reached(tree, numbers, levels)
        ids = np.array(sorted(tree.nodes))
        counts = np.array([tree.nodes[i].counts for i in ids.tolist()], float)
        share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
        if len(forest.trees) > 1:
            share = np.eye(k)[counts.argmax(axis=1)]
        vote = share[np.searchsorted(ids, leaf)]
        out += vote if weights is None else vote * (weights[:, t] == 0)[:, None]
    return out


def predictions(forest: Forest, rows: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """Rows with ``prediction`` and, per class, ``probabilities``: shares of the leaf, or of votes.

    With ``key``, the one that the forest was grown with, only trees that did not draw a row vote
    for it; both columns are missing where every tree did. Equal chances go to the first class.
    """
    x, c = forest.inputs()
    trees = range(len(forest.trees))
    drawn = F.array(*[_copies(F.col(f"_u{t}")) for t in trees]) if key else F.lit(None).cast("array<int>")
    names = [f"_own{i}" for i in range(len(rows.columns))]
    entered = rows.select(
        *[F.col(f"`{n}`").alias(m) for n, m in zip(rows.columns, names, strict=True)],
        x.alias("_x"), c.alias("_c"), *(_drawn_numbers(key, len(trees)) if key else ()),
    ).select(*names, "_x", "_c", drawn.alias("_drawn"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = None
            if key:
                weights = batch.column("_drawn").flatten().to_numpy().reshape(batch.num_rows, -1)
            votes = _votes(forest, *_arrays(batch, forest, "_x", "_c"), weights)
            total = votes.sum(axis=1)
            silent = total == 0
            shares = votes / np.where(silent, 1, total)[:, None]
            offsets = np.arange(len(votes) + 1, dtype=np.int32) * len(forest.classes)
            said = pa.array([forest.classes[i] for i in votes.argmax(axis=1).tolist()], pa.string())
            yield pa.record_batch(
                [
                    *[batch.column(n) for n in names],
                    pc.if_else(pa.array(silent), pa.scalar(None, pa.string()), said),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(shares.ravel()), mask=pa.array(silent)),
                ],
                [*names, "_said", "_shares"],
            )

    kinds = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, rows.schema.fields, strict=True))
    scored = entered.mapInArrow(work, f"{kinds}{', ' if names else ''}_said string, _shares array<double>")
    kept = [
        F.col(m).alias(n)
        for n, m in zip(rows.columns, names, strict=True)
        if n not in ("prediction", "probabilities")
    ]
    return scored.select(*kept, F.col("_said").alias("prediction"), F.col("_shares").alias("probabilities"))


def importance(forest: Forest, rows: DataFrame, label: str, key: Sequence[str]) -> DataFrame:
    """Per predictor (``predictor``, ``importance``): by how much the trees' accuracy on the rows they
    did not draw falls when the predictor's values are dealt to other rows.

    Every row gets the values of the next row in an order drawn from the key; one permutation
    serves all predictors. ``key`` must identify a row. The mean is over the trees.

    Rows are range partitioned by that order and judged as they come out of the sort; what lies
    on either side of two parts, two rows of each, is paired in the driver.
    """
    x, c = forest.inputs()
    keys = [f"_k{i}" for i in range(len(key))]
    known = rows.where(F.col(label).isNotNull()).select(
        uniform(key, "deal").alias("_order"), *[F.col(f"`{k}`").alias(n) for k, n in zip(key, keys, strict=True)],
        F.col(label).cast("string").alias("_label"), x.alias("_x"), c.alias("_c"),
    )
    drawn = F.array(*[_copies(F.col(f"_u{t}")) for t in range(len(forest.trees))])
    placed = known.repartitionByRange("_order", *keys).sortWithinPartitions("_order", *keys)
    placed = placed.select("*", *_drawn_numbers(keys, len(forest.trees)))
    placed = placed.select("_order", *keys, "_label", "_x", "_c", drawn.alias("_drawn"))
    n, every = len(forest.numeric), [*forest.numeric, *forest.categorical]

    def judged(batch: pa.RecordBatch, other: pa.RecordBatch) -> np.ndarray:
        """Rows judged, and rightly so as they are and for each dealt predictor, by tree."""
        right = np.zeros((len(forest.trees), len(every) + 2), np.int64)
        numbers, levels = _arrays(batch, forest, "_x", "_c")
        numbers2, levels2 = _arrays(other, forest, "_x", "_c")
        weights = batch.column("_drawn").flatten().to_numpy().reshape(batch.num_rows, -1)
        truth = np.array([forest.classes.index(v) if v in forest.classes else -1 for v in batch.column("_label").to_pylist()])
        for t, tree in enumerate(forest.trees):
            out = weights[:, t] == 0
            ids = np.array(sorted(tree.nodes))
            says = np.array([np.argmax(tree.nodes[i].counts) for i in ids.tolist()])

            def hits(a, b):
                said = says[np.searchsorted(ids, _reached(tree, a, b))]
                return int(np.count_nonzero((said == truth) & out))

            right[t, :2] += int(out.sum()), hits(numbers, levels)
            used = {node.predictor for node in tree.nodes.values()}
            for p in range(len(every)):
                a, b = numbers, levels
                if p not in used:
                    right[t, p + 2] += right[t, 1]
                    continue
                if p < n:
                    a = numbers.copy()
                    a[:, p] = numbers2[:, p]
                else:
                    b = [*levels[: p - n], levels2[p - n], *levels[p - n + 1 :]]
                right[t, p + 2] += hits(a, b)
        return right

    def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right = np.zeros((len(forest.trees), len(every) + 2), np.int64)
        first = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            first = batch.slice(0, 1) if first is None else first
            whole = batch if last is None else joined([last, batch])
            if whole.num_rows > 1:
                right += judged(whole.slice(0, whole.num_rows - 1), whole.slice(1))
            last = whole.slice(whole.num_rows - 1)
        if first is not None:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, first.schema) as out:
                out.write_table(pa.Table.from_batches([first, last]).combine_chunks())
            edges = pa.array([sink.getvalue().to_pybytes()], pa.binary())
            yield pa.record_batch([pa.array([right.tobytes()], pa.binary()), edges], ["right", "edges"])

    held = np.zeros((len(forest.trees), len(every) + 2))
    parts = []
    for r in placed.mapInArrow(work, "right binary, edges binary").collect():
        held += np.frombuffer(r["right"], np.int64).reshape(held.shape)
        parts.append(joined(pa.ipc.open_stream(bytes(r["edges"])).read_all().to_batches()))
    if parts:
        places = [
            (part.column("_order")[0].as_py(), *[(v is not None, v) for v in (part.column(k)[0].as_py() for k in keys)])
            for part in parts
        ]
        parts = [parts[i] for i in sorted(range(len(parts)), key=places.__getitem__)]
        after = [part.slice(0, 1) for part in parts]
        held += judged(joined([part.slice(1) for part in parts]), joined([*after[1:], after[0]]))
    held = held[held[:, 0] > 0]
    falls = (held[:, 1:2] - held[:, 2:]) / held[:, :1]
    means = falls.mean(axis=0) if len(held) else np.zeros(len(every))
    rows_ = [(p, float(m)) for p, m in zip(every, means.tolist(), strict=True)]
    return rows.sparkSession.createDataFrame(rows_, "predictor string, importance double")
