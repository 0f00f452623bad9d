import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelsight.operators import tree
from parcelsight.operators.numbering import running_totals
from parcelsight.sources.scratch import scratch_path, staged

SCHEMA = "id long, a double, b double, c string, d string, y string"
ARGS = ("y", ["a", "b"], ["c", "d"], ["id"])


def drawn(n=160, seed=1, classes=2):
    made, rows = random.Random(seed), []
    for i in range(n):
        a, b, c = round(made.gauss(0, 1), 2), float(made.randrange(12)), made.choice("lmh")
        d = None if i % 9 == 0 else f"d{made.randrange(4)}"
        y = int((a > 0.3) != (c == "m" and b > 6))
        if made.random() < 0.15:
            y = made.randrange(classes)
        rows.append((i, a, b, c, d, f"k{y}" if classes == 2 or c != "h" else f"k{classes - 1}"))
    return rows


def frame(spark, rows):
    return staged(spark.createDataFrame(rows, SCHEMA).repartition(3), "rows")


def gini(rows, classes):
    n = [sum(r[5] == k for r in rows) for k in classes]
    return sum(x * x for x in n) / len(rows) if rows else 0.0


def brute_split(rows, classes, least):
    """Best split of all: every threshold in the middle of two values, every cut of the levels."""
    best = None
    for p in range(4):
        col = p + 1
        if p < 2:
            values = sorted({r[col] for r in rows})
            tests = [((u + v) / 2, lambda r, t=(u + v) / 2, q=col: r[q] <= t) for u, v in itertools.pairwise(values)]
        else:
            levels = sorted({"" if r[col] is None else "=" + r[col] for r in rows})
            tests = []
            for k in range(1, len(levels)):
                for some in itertools.combinations(levels, k):
                    tests.append((some, lambda r, s=some, q=col: ("" if r[q] is None else "=" + r[q]) in s))
        for at, test in tests:
            one, two = [r for r in rows if test(r)], [r for r in rows if not test(r)]
            if min(len(one), len(two)) < least:
                continue
            gain = gini(one, classes) + gini(two, classes) - gini(rows, classes)
            if best is None or gain > best[0] + 1e-9:
                best = (gain, p, at, test)
    return best


def walk(grown, rows, least):
    """Follow a grown tree with its rows; yields (node, rows, brute force)."""
    todo = [(1, rows)]
    while todo:
        i, held = todo.pop()
        node = grown.trees[0].nodes[i]
        assert node.counts == [sum(r[5] == k for r in held) for k in grown.classes]
        best = brute_split(held, grown.classes, least)
        yield i, node, held, best
        if node.predictor is None:
            continue
        col = node.predictor + 1

        def goes(r, node=node, col=col):
            if node.threshold is not None:
                return r[col] <= node.threshold
            return ("" if r[col] is None else "=" + r[col]) in node.left

        todo += [(2 * i, [r for r in held if goes(r)]), (2 * i + 1, [r for r in held if not goes(r)])]


def test_every_split_is_the_best_of_all(spark):
    rows = drawn()
    grown = tree.grow(frame(spark, rows), *ARGS, max_depth=3, complexity=0.001)
    seen = 0
    for i, node, _, best in walk(grown, rows, tree.MIN_LEAF):
        if node.predictor is None:
            assert i >= 8 or sum(node.counts) < tree.MIN_SPLIT or not best or best[0] <= 0 or min(node.counts) == 0
            continue
        seen += 1
        assert abs(node.gain - best[0]) < 1e-6
        if node.predictor < 2 and node.predictor == best[1]:
            assert node.threshold == pytest.approx(best[2])
    assert seen >= 5


def test_three_classes_and_missing_values(spark):
    rows = [(r[0], None if r[0] % 13 == 0 else r[1], float("nan") if r[0] % 17 == 0 else r[2], *r[3:5], None if r[0] % 19 == 0 else r[5]) for r in drawn(classes=3)]
    df = frame(spark, rows)
    grown = tree.grow(df, *ARGS, max_depth=3, complexity=0.001)
    assert grown.classes == ["k0", "k1", "k2"]
    filled = [
        (r[0], *(m if v is None or v != v else v for v, m in zip(r[1:3], grown.medians)), *r[3:])
        for r in rows if r[5] is not None
    ]
    # Cuts of the levels are tried by the share of each class: no better than any subset.
    for _, node, _, best in walk(grown, filled, tree.MIN_LEAF):
        if node.predictor is not None:
            assert best[0] - 1e-6 >= node.gain - 2e-6
            assert node.predictor >= 2 or node.gain == pytest.approx(best[0]) or best[1] >= 2
    scored = tree.predictions(grown, df).collect()
    assert len(scored) == len(rows)
    for r in scored:
        assert sum(r.probabilities) == pytest.approx(1)
        assert r.prediction == grown.classes[int(np.argmax(r.probabilities))]


def subtrees(t, i=1):
    """Leaves of every subtree with the same root."""
    yield [i]
    if t.nodes[i].predictor is not None:
        for one in subtrees(t, 2 * i):
            for two in subtrees(t, 2 * i + 1):
                yield one + two


def test_path_and_validation_equal_brute_force(spark):
    rows = drawn(220, 5)
    grown = tree.grow(frame(spark, rows), *ARGS, max_depth=3, complexity=0.0001, min_split=4, min_leaf=2, folds=5).trees[0]
    every = [(sum(grown.nodes[i].risk() for i in s), len(s), sorted(s)) for s in subtrees(grown)]
    path = grown.path()
    assert [len(leaves) for _, leaves in path] == sorted({len(x) for _, x in path}, reverse=True)
    assert path[-1][1] == [1] and path[0][0] == 0
    limits = [p for p, _ in path] + [path[-1][0] + 5]
    for (penalty, leaves), after in zip(path, limits[1:]):
        for cost in (penalty, (penalty + after) / 2):
            least = min(r + cost * n for r, n, _ in every)
            smallest = min((n, s) for r, n, s in every if r + cost * n <= least + 1e-9)
            assert smallest[1] == leaves == grown.leaves(cost)
    steps = grown.validated()
    root = grown.nodes[1].risk()
    assert [s[1] for s in steps] == [len(x) for _, x in path]
    for s, (_, leaves) in zip(steps, path):
        assert s[2] == pytest.approx(sum(grown.nodes[i].risk() for i in leaves) / root)
    wrong = 0
    for fold in range(5):
        node = grown.nodes[1]
        rest = node.kept(fold)
        wrong += sum(node.folds[fold]) - node.folds[fold][int(np.argmax(rest))]
    assert steps[-1][3] == pytest.approx(wrong / root)
    assert all(sum(f[k] for f in n.folds) == n.counts[k] for n in grown.nodes.values() for k in range(2))
    best = grown.best()
    assert len(best.leaves()) in {s[1] for s in steps}
    within = min(s[3] + s[4] for s in steps if s[3] == min(x[3] for x in steps))
    assert next(s[3] for s in steps if s[1] == len(best.leaves())) <= within
    assert grown.pruned(10.0).leaves() == [1]


def test_stored_trees_say_the_same(spark):
    df = frame(spark, drawn(120, 3))
    grown = tree.fit_tree(df, *ARGS)
    again = tree.Forest.load(spark, grown.save(spark, scratch_path(spark, "tree")))
    assert again == grown
    new = spark.createDataFrame([(1, 0.1, 2.0, "unseen", "d1", "z"), (2, None, None, None, None, None)], SCHEMA)
    clash = new.withColumns({"prediction": F.lit("x"), "_x": F.lit(1), "_drawn": F.lit(2)})
    rows = tree.predictions(again, clash).collect()
    assert len(rows) == 2 and all(r.prediction in grown.classes for r in rows) and rows[0]["_x"] == 1


def test_votes_out_of_bag_and_importance(spark):
    made = random.Random(4)
    rows = []
    for i in range(400):
        a = made.gauss(0, 1)
        rows.append((i, a, made.random(), made.choice("xyz"), "same", "k1" if (a > 0) != (made.random() < 0.05) else "k0"))
    df = frame(spark, rows)
    forest = tree.fit_forest(df, *ARGS, trees=6, tries=3, max_depth=4)
    weights = {r.id: list(r.w) for r in df.select("id", F.array(*[tree.poisson(["id"], t) for t in range(6)]).alias("w")).collect()}
    every = [w for ws in weights.values() for w in ws]
    assert abs(np.mean(every) - 1) < 0.1 and abs(np.mean([w == 0 for w in every]) - 0.368) < 0.05
    for t, one in enumerate(forest.trees):
        assert sum(one.nodes[1].counts) == sum(w[t] for w in weights.values())
    alone = [tree.predictions(tree.replace(forest, trees=[t]), df).select("id", "prediction").collect() for t in forest.trees]
    votes = {i: [] for i in weights}
    for t, said in enumerate(alone):
        for r in said:
            if weights[r.id][t] == 0:
                votes[r.id].append(r.prediction)
    for r in tree.predictions(forest, df, ["id"]).collect():
        held = votes[r.id]
        assert (r.prediction is None) == (not held) == (r.probabilities is None)
        if held:
            shares = [held.count(k) / len(held) for k in forest.classes]
            assert r.probabilities == pytest.approx(shares)
            assert r.prediction == forest.classes[int(np.argmax(shares))]
    falls = {r.predictor: r.importance for r in tree.importance(forest, df, "y", ["id"]).collect()}
    assert falls["a"] > 0.3 and all(abs(falls[p]) < 0.08 for p in "bcd") and falls["d"] == 0


def test_running_totals_of_a_hot_group(spark):
    rows = [(0, float(i), i % 5, 1) for i in range(900)] + [(g, float(i), 1, 2) for g in range(1, 6) for i in range(g)]
    df = spark.createDataFrame(rows, "g int, v double, x long, y long").repartition(5)
    got = {(r.g, r.v): (r.x, r.y, r.following) for r in running_totals(df, ["g"], "v", ["x", "y"]).collect()}
    assert len(got) == len(rows)
    for g in range(6):
        mine = sorted(r for r in rows if r[0] == g)
        for i, r in enumerate(mine):
            after = mine[i + 1][1] if i + 1 < len(mine) else None
            assert got[g, r[1]] == (sum(m[2] for m in mine[: i + 1]), sum(m[3] for m in mine[: i + 1]), after)


def test_nothing_to_grow_from(spark):
    df = frame(spark, drawn(10))
    with pytest.raises(ValueError):
        tree.grow(df.where("id < 0"), *ARGS)
    one = tree.grow(df.withColumn("y", F.lit("only")), *ARGS)
    assert list(one.trees[0].nodes) == [1] and one.trees[0].path() == [(0.0, [1])]
    assert {r.prediction for r in tree.predictions(one, df).collect()} == {"only"}


def test_a_forest_draws_once_and_moves_rows_only_to_split_them(spark, monkeypatch):
    """One digest for each row and tree, rows staged once for each level that is split, and none
    staged, nor any table joined, to deal a predictor's values to other rows."""
    rows = [(i, float(i % 17), "ab"[i % 2], "yes" if (i % 17 > 8) != (i % 5 == 0) else "no") for i in range(600)]
    df = spark.createDataFrame(rows, "id long, x double, c string, label string").coalesce(3)
    made = []
    plain = tree.staged

    def watched(frame, name):
        made.append((name, frame._jdf.queryExecution().optimizedPlan().toString()))
        return plain(frame, name)

    monkeypatch.setattr(tree, "staged", watched)
    forest = tree.fit_forest(df, "label", ["x"], ["c"], ["id"], trees=4, tries=2, bins=None, max_depth=2)
    frames = [plan for name, plan in made if name == "tree-rows"]
    assert len(frames) == 2 and frames[0].count("md5(") == 4
    for t in forest.trees:
        for i, node in t.nodes.items():
            if node.predictor is not None:
                assert node.counts == [a + b for a, b in zip(t.nodes[2 * i].counts, t.nodes[2 * i + 1].counts)]
    made.clear()
    got = {r["predictor"]: r["importance"] for r in tree.importance(forest, df, "label", ["id"]).collect()}
    assert not made and got["x"] > 0.1


def test_importance_of_parts_is_that_of_all_rows(spark):
    """Rows in one part, in many, and one row alone: every row gets the next one's values."""
    rows = [(i, float(i % 17), "ab"[i % 2], "yes" if i % 17 > 8 else "no") for i in range(120)]
    df = spark.createDataFrame(rows, "id long, x double, c string, label string")
    forest = tree.fit_forest(df, "label", ["x"], ["c"], ["id"], trees=3, tries=2, bins=None, max_depth=2)
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    try:
        spark.conf.set(merging, "false")
        for parts in ("1", "7", "150"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            found.append([r["importance"] for r in tree.importance(forest, df, "label", ["id"]).collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset(merging)
    assert found[0] == found[1] == found[2] and found[0][0] > 0
    one = tree.importance(forest, df.where("id = 3"), "label", ["id"]).collect()
    assert [r["importance"] for r in one] == [0.0, 0.0]
