import random
from collections import Counter

import numpy as np
import pytest

from helpers import clashing, empty_documents, odd_documents, odd_rows, prose
from parcelsight.llm import odd_sketch as od


def sets(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, percent):
    found = {i: sets(t, width) for i, t in rows}
    root = {i: i for i in found}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(found)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = found[i], found[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return {i: (len(found[i]), top(i), top(i) == i) for i in ids}


def planted(seed):
    drawn = random.Random(seed)
    rows, at = [], 0
    for group in range(25):
        words = prose(drawn.randint(4, 300), 1000 * seed + group).split()
        for _ in range(drawn.choice((1, 2, 3, 12))):
            mine = list(words)
            for _ in range(drawn.randint(0, max(1, len(mine) // 12))):
                mine[drawn.randrange(len(mine))] = f"x{drawn.randrange(999)}"
            if drawn.random() < 0.3:
                mine = [w.upper() for w in mine]
            rows.append((at, " ".join(mine)))
            at += 1
    # A chain: each text is near the next one only.
    words = prose(120, 77 + seed).split()
    for step in range(12):
        words = [*words[6:], *(f"c{step}_{k}" for k in range(6))]
        rows.append((at, " ".join(words)))
        at += 1
    drawn.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "width"), [(1, 2), (2, 5), (3, 2)])
def test_components_are_those_of_all_pairs(spark, seed, width):
    rows = planted(seed)
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in od.near_duplicates(documents, width).collect()}
    assert got == brute(rows, width, 80)


def test_blocks_of_a_bucket_meet_each_other(spark, monkeypatch):
    monkeypatch.setattr(od, "BLOCK", 3)
    rows = planted(5)
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in od.near_duplicates(documents, 2).collect()}
    assert got == brute(rows, 2, 80)


def test_links_do_not_hang_on_the_leader(spark, monkeypatch):
    """Even if no leader's pair were close, pairs inside buckets find every link."""
    rows = planted(4)
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    plain = od._with_leaders
    monkeypatch.setattr(od, "_with_leaders", lambda *a: plain(*a).limit(0))
    got = {r.doc_id: tuple(r)[1:] for r in od.near_duplicates(documents, 2).collect()}
    expected = brute(rows, 2, 80)
    alone = [i for i in expected if got[i] != expected[i]]
    sizes = Counter(r[1] for r in expected.values())
    assert all(sizes[expected[i][1]] == 2 for i in alone)


def test_sketches_estimate_high_similarities():
    drawn = np.random.default_rng(3)
    for share in (0.7, 0.8, 0.9):
        off = []
        for _ in range(60):
            both = drawn.integers(0, 1 << 63, 2000, dtype=np.uint64)
            common = int(2000 * share)
            apart = (2000 - common) // 2
            a, b = both[: common + apart], np.concatenate((both[:common], both[common + apart :]))
            maps = [od.sketch(od.samples(np.sort(x))).view(np.uint64) for x in (a, b)]
            off.append(float(od.estimate(np.bitwise_count(maps[0] ^ maps[1]).sum())) - share)
        assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.05


def test_components_of_a_long_path(spark):
    names = [bytes([i]) * 16 for i in range(60)]
    order = list(range(60))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame([(names[order[i]], names[order[i + 1]]) for i in range(59) if i != 30], "a binary, b binary")
    got = {bytes(r.node): bytes(r.root) for r in od.components(links).collect()}
    for part in (order[:31], order[31:]):
        least = min(names[i] for i in part)
        assert all(got.get(names[i], names[i]) == least for i in part)


def test_small_tables_are_few_files_whatever_the_shuffles(spark, monkeypatch):
    """A file for each shuffle partition and step filled the disk with a run's log, and every file
    is one more process beside the executor."""
    files, plain = {}, od.staged

    def noted(df, name, *rest):
        out = plain(df, name, *rest)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(od, "staged", noted)
    most = spark.sparkContext.defaultParallelism
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 8 * most)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        rows = planted(6)
        documents = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
        got = {r.doc_id: tuple(r)[1:] for r in od.near_duplicates(documents, 2).collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert got == brute(rows, 2, 80)
    assert files and max(files.values()) <= most, files


def test_later_links_join_the_trees_of_earlier_ones(spark):
    """Tops of a forest, then links between trees, within one, to new nodes, and among these."""
    drawn = random.Random(8)
    names = [bytes([i]) * 16 for i in range(120)]
    first = [(names[drawn.randrange(max(0, i - 9), i)], names[i]) for i in range(1, 90) if i % 11]
    more = [(names[drawn.randrange(120)], names[drawn.randrange(120)]) for _ in range(9)]
    first, more = (spark.createDataFrame(x, "a binary, b binary") for x in (first, more))

    def groups(roots):
        found = {bytes(r.node): bytes(r.root) for r in roots.collect()}
        held = {}
        for n in names:
            held.setdefault(found.get(n, n), set()).add(n)
        return sorted(map(sorted, held.values()))

    tops = od._tops(first)
    assert groups(tops) == groups(od.components(first))
    assert groups(od._merged(tops, od.staged(more, "more"))) == groups(od.components(first.union(more)))


def test_odd_rows(spark):
    out = od.near_duplicates(clashing(odd_documents(spark)), 2).collect()
    assert len(out) == len(odd_rows())
    by = {}
    for r in out:
        by.setdefault(r.doc_id, set()).add(tuple(r)[1:])
    assert by[None] == {(3, None, True)}
    assert by[2] == {(0, 2, True)} and by[3] == {(0, 3, True)} and by[4] == {(0, 4, True)}
    assert by[6] == {(2, 6, True)} and by[7] == {(2, 6, False)}
    assert od.near_duplicates(empty_documents(spark), 2).collect() == []
