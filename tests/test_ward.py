import numpy as np
import pytest

from parcelsight.operators import ward
from parcelsight.operators.quality import require_rows  # noqa: F401
from parcelsight.sources.scratch import staged

COLUMNS = ["a", "b", "c"]


def brute_ward(points):
    """Greedy Ward merging over all pairs: the height of every merge, and the sets after each."""
    sets = [frozenset([i]) for i in range(len(points))]
    heights, after = [], [set(sets)]
    while len(sets) > 1:
        best = None
        for i, x in enumerate(sets):
            for y in sets[i + 1 :]:
                gap = points[sorted(x)].mean(axis=0) - points[sorted(y)].mean(axis=0)
                cost = len(x) * len(y) / (len(x) + len(y)) * float(gap @ gap)
                if best is None or cost < best[0]:
                    best = (cost, x, y)
        cost, x, y = best
        sets = [s for s in sets if s not in (x, y)] + [x | y]
        heights.append((2 * cost) ** 0.5)
        after.append(set(sets))
    return heights, after


def drawn(n, seed=3):
    made = np.random.default_rng(seed)
    centres = made.normal(size=(4, 3)) * 4
    return [
        (i, *map(float, centres[i % 4] + made.normal(size=3) * (1 + i % 3)))
        for i in range(n)
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, a double, b double, c double").repartition(3)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force_on_small_frames(spark, seed):
    rows = drawn(60, seed)
    df = staged(frame(spark, rows), "ward")
    tree = ward.dendrogram(df, COLUMNS)
    points = np.array([r[1:] for r in rows])
    points = (points - points.mean(axis=0)) / points.std(axis=0, ddof=1)
    heights, after = brute_ward(points)
    assert len(tree.sizes) == 60 and np.allclose(tree.height, heights)
    cut = tree.apply(df, {f"k{k}": k for k in (1, 2, 3, 7, 60, 90)}).collect()
    for k in (1, 2, 3, 7, 60):
        held = {}
        for r in cut:
            held.setdefault(r[f"k{k}"], set()).add(r.id)
        assert {frozenset(x) for x in held.values()} == after[60 - k]
        assert sorted(held) == list(range(1, k + 1))
        means = [points[sorted(held[c])].mean(axis=0).tolist() for c in sorted(held)]
        assert means == sorted(means)
    assert {r.k90 for r in cut} == set(range(1, 61))
    merges = tree.merges(spark).orderBy("step").collect()
    assert [m.step for m in merges] == list(range(1, 60)) and merges[-1].n == 60
    assert all(m.left < m.right < 60 + m.step - 1 for m in merges)


def test_leaves_are_bounded_and_keep_all_rows(spark):
    df = staged(frame(spark, drawn(3000)), "ward")
    wide = ward.dendrogram(df, COLUMNS, leaves=200)
    assert len(wide.sizes) <= 200 and wide.sizes.sum() == 3000
    coarsened = ward.dendrogram(df, COLUMNS, width=2.0**-10, leaves=200)
    direct = ward.dendrogram(df, COLUMNS, width=coarsened.width, leaves=200)
    assert (coarsened.cells == direct.cells).all() and (coarsened.sizes == direct.sizes).all()
    assert np.allclose(coarsened.sums, direct.sums) and np.allclose(coarsened.height, direct.height)
    labelled = wide.apply(df, {"x": 4}).collect()
    assert len(labelled) == 3000 and {r.x for r in labelled} == {1, 2, 3, 4}


def test_features_of_parts_merge_to_those_of_the_whole(spark):
    df = staged(frame(spark, drawn(500)), "ward")
    moments = ward.fit_moments(df, COLUMNS)
    parts = [ward.leaf_features(df.where(f"id % 3 = {i}"), moments, 0.25) for i in range(3)]
    both = ward.merged_features(parts[0].union(parts[1]).union(parts[2]))
    key = [f"cell_{i}" for i in range(3)]
    got, want = (x.orderBy(*key).toPandas() for x in (both, ward.leaf_features(df, moments, 0.25)))
    assert (got[key + ["n"]] == want[key + ["n"]]).all().all()
    assert np.allclose(got, want)
    twice = ward.merged_features(both, 1).orderBy(*key).toPandas()
    assert np.allclose(twice, ward.leaf_features(df, moments, 0.5).orderBy(*key).toPandas())


def test_missing_constant_and_repeated_rows(spark):
    rows = [(1, 1.0, None, 1.0), (2, float("nan"), 1.0, 1.0)] + [(i, float(i % 4), 5.0, -float(i % 2)) for i in range(3, 43)]
    df = staged(frame(spark, rows), "ward")
    tree = ward.dendrogram(df, COLUMNS)
    assert len(tree.sizes) == 4 and tree.sizes.tolist() == [10, 10, 10, 10]
    got = {r.id: r.x for r in ward.hierarchy(df, COLUMNS, 2, "x").collect()}
    assert len(got) == 42 and got[1] is None and got[2] is None
    assert len({(i % 4, got[i]) for i in range(3, 43)}) == 4
    with pytest.raises(ValueError):
        ward.dendrogram(df.where("id < 3"), COLUMNS)
    one = ward.dendrogram(df.where("id = 3"), COLUMNS)
    assert one.labels(3).tolist() == [1] and len(one.height) == 0
