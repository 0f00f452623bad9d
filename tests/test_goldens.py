"""Known results: agent means and their clusters, rebuilt from their published totals."""

import pytest

from parcelsight.operators import cluster, olap, outliers

# agent, deliveries, summed time, delayed, reviews, summed rating in tenths; then the means
# and the cluster they were published with.
AGENTS = [
    ("Blinkit", 28, 163, 13, 1272, 38074, 5.821428571428571, 0.4642857142857143, 2.993238993710692, 3),
    ("JioMart", 30, 172, 14, 1224, 36541, 5.733333333333333, 0.4666666666666667, 2.985375816993464, 3),
    ("Swiggy Instamart", 16, 100, 9, 1222, 36884, 6.25, 0.5625, 3.0183306055646484, 1),
    ("Zepto", 26, 140, 11, 1282, 38646, 5.384615384615385, 0.4230769230769231, 3.014508580343214, 2),
]


def _spread(total: int, parts: int) -> list[int]:
    """Whole numbers with the given sum."""
    return [total // parts + (i < total % parts) for i in range(parts)]


@pytest.fixture(scope="module")
def performance(spark):
    agents, work, reviews = [], [], []
    for key, (name, n, time, late, rated, tenths, *_) in enumerate(AGENTS, 1):
        agents.append((key, name, name))
        work += [(name, float(t), int(i < late)) for i, t in enumerate(_spread(time, n))]
        reviews += [(key, t / 10) for t in _spread(tenths, rated)]
    assert len(work) == 100 and len(reviews) == 5000
    return olap.agent_performance(
        spark.createDataFrame(agents, "agent_key int, agent_id string, agent_name string"),
        spark.createDataFrame(work, "agent_id string, delivery_time_min double, delayed_flag int"),
        spark.createDataFrame(reviews, "agent_key int, rating double"),
    ).cache()


def test_agent_means(performance):
    got = {r["agent_name"]: r for r in performance.collect()}
    for name, *_, time, rate, rating, _cluster in AGENTS:
        row = got[name]
        assert row["avg_delivery_time"] == pytest.approx(time, abs=1e-12)
        assert row["delay_rate"] == pytest.approx(rate, abs=1e-12)
        assert row["avg_rating"] == pytest.approx(rating, abs=1e-9)


@pytest.mark.parametrize("seed", range(1, 4))
def test_agent_clusters(performance, seed):
    """The published partition, which is the only optimum; numbers are arbitrary."""
    got = cluster.kmeans(performance, seeds=[seed, seed + 10, seed + 20]).collect()
    found: dict[int, set] = {}
    for r in got:
        found.setdefault(r["cluster"], set()).add(r["agent_name"])
    known: dict[int, set] = {}
    for name, *_, number in AGENTS:
        known.setdefault(number, set()).add(name)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, known.values()))


def test_no_delay_anomalies_without_far_delays(spark):
    rows = [(i, 1, 1.0, float(20 + i % 11), 25) for i in range(100)]
    facts = spark.createDataFrame(
        rows,
        "delivery_id long, city_id int, distance_km double, delivery_time_min double, sla_min int",
    )
    found = outliers.delay_anomalies(facts)
    assert found.columns == [
        "delivery_id", "city_id", "distance_km", "delivery_time_min", "sla_min", "delay_diff",
        "z_delay",
    ]
    assert found.count() == 0
    late = facts.unionByName(spark.createDataFrame([(999, 1, 1.0, 90.0, 25)], facts.schema))
    assert [r["delivery_id"] for r in outliers.delay_anomalies(late).collect()] == [999]
