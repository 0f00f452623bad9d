import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelsight.llm import cross_polytope as cp

SCHEMA = "vec_id long, embedding array<float>, score string"


def vectors(n, seed=1, width=24):
    drawn = np.random.default_rng(seed)
    centres = drawn.normal(size=(8, width))
    return [(i, (centres[i % 8] * 0.5 + drawn.normal(size=width)).astype(np.float32).tolist(), "x") for i in range(n)]


def brute(rows, k=5):
    ids = np.array([r[0] for r in rows])
    values = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    out = {}
    for i in range(len(ids)):
        if ids[i] % 50 == 0:
            score = cp.cosines(values[i], values)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
            out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def search(frame, **more):
    out = {}
    for r in cp.search(frame.where("vec_id % 50 = 0"), frame, **more).collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: [(v, s) for _, v, s in sorted(hits)] for q, hits in out.items()}


def test_transform_is_a_rotation():
    rows = np.random.default_rng(1).normal(size=(5, 24))
    turned = cp.rotated(rows, 3)
    assert turned.shape == (5, 32)
    assert np.allclose(turned @ turned.T, rows @ rows.T)
    assert (cp.buckets(rows, 3, 4)[:, :1] == cp.buckets(rows, 3)).all()


@pytest.mark.parametrize("block", [16, 4096])
def test_all_buckets_give_exact_results(spark, block):
    rows = vectors(400)
    got = search(spark.createDataFrame(rows, SCHEMA), probes=64, tables=1, block=block)
    expected = brute(rows)
    assert got.keys() == expected.keys()
    for q, hits in expected.items():
        assert [v for v, _ in got[q]] == [v for v, _ in hits]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in hits], abs=1e-15)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    frame = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [tuple(r)[:2] for r in frame.select("vec_id", "embedding").collect()]
    got, expected = search(frame), brute(rows)
    assert got.keys() == expected.keys()
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in expected[q]}) for q in expected)
    assert hits / sum(map(len, expected.values())) >= 0.9


def test_ties_copies_and_odd_rows(spark):
    one = [1.0, 2.0, 0.0, 0.5]
    rows = [(i, one, None) for i in range(0, 60)] + [
        (100, None, "x"), (150, [0.0] * 4, "x"), (200, [1.0, None, 0.0, 0.0], "x"), (250, [float("nan")] * 4, "x"),
        (300, [float("inf"), 0.0, 0.0, 0.0], "x"), (350, [], "x"), (None, one, "x"), (400, [1.0, 2.0], "x"), (450, [2.0, 4.0, 0.0, 1.0], "x"),
    ]
    got = search(spark.createDataFrame(rows, SCHEMA), block=8)
    assert got[0] == [(i, got[0][0][1]) for i in (1, 2, 3, 4, 5)]
    assert got[50] == [(i, got[50][0][1]) for i in (0, 1, 2, 3, 4)]
    assert [v for v, _ in got[450]] == [0, 1, 2, 3, 4] and math.isclose(got[450][0][1], 1)
    assert set(got) == {0, 50, 450}
    empty = spark.createDataFrame([], SCHEMA)
    assert search(empty) == {}
    few = spark.createDataFrame([(0, one, "x"), (1, one, "x")], SCHEMA)
    assert [v for v, _ in search(few)[0]] == [1]


def test_rows_of_one_id_are_one_candidate_less(spark):
    rows = [(0, [1.0, 0.0], "x"), (1, [1.0, 0.1], "x"), (1, [1.0, 0.1], "x"), (2, [0.9, 0.2], "x")]
    got = search(spark.createDataFrame(rows, SCHEMA).withColumn("bucket", F.lit(1)), probes=4)
    assert [v for v, _ in got[0]] == [1, 2]


@pytest.mark.parametrize("n", [1, 2, 4, 6, 20, 130])
def test_small_tables_give_all_there_is(spark, n):
    drawn = np.random.default_rng(n)
    rows = [(50 * i if i % 2 else i, drawn.normal(size=64).astype(np.float32).tolist(), "x") for i in range(n)]
    got, expected = search(spark.createDataFrame(rows, SCHEMA)), brute(rows)
    assert {q: len(h) for q, h in got.items()} == {q: len(h) for q, h in expected.items() if h}
    if n <= 6:
        assert {q: [v for v, _ in h] for q, h in got.items()} == {q: [v for v, _ in h] for q, h in expected.items() if h}
