import numpy as np
import pytest

from helpers import clashing, empty_documents, odd_documents, odd_rows
from parcelsight.llm import mixing


def rows_of(spark, chances, tokens):
    rows = [(i, int(t), [float(x) for x in c]) for i, (c, t) in enumerate(zip(chances, tokens))]
    return spark.createDataFrame(rows, "doc_id long, n_tokens long, posteriors array<double>").repartition(3)


def model_of(*domains):
    return mixing.DomainModel(domains, np.zeros(len(domains)), np.zeros((len(domains), 4)))


def soft(n, k=3, seed=2):
    drawn = np.random.default_rng(seed)
    return drawn.dirichlet([0.15] * k, n), drawn.integers(1, 900, n)


def projected(chances, tokens, targets):
    """Plain projected gradient on the rates, in small steps, along chances."""
    rates = np.ones(len(tokens))
    for _ in range(20000):
        gap = (tokens * rates) @ chances - targets
        if np.abs(gap).max() < 1e-6 * targets.sum():
            break
        rates = np.maximum(0, rates - chances @ gap * 0.5 / tokens.sum())
    return rates


@pytest.mark.parametrize("weights", [None, {"a": 0.6, "b": 0.3, "c": 0.1}, {"a": 0.9, "b": 0.09, "c": 0.01}])
def test_expected_totals_match_targets(spark, weights):
    chances, tokens = soft(800)
    rows = rows_of(spark, chances, tokens)
    mix = mixing.fit_rates(rows, model_of("a", "b", "c"), weights)
    rates = {r.doc_id: r.rate for r in mixing.with_rates(rows, mix).collect()}
    rates = np.array([rates[i] for i in range(len(tokens))])
    assert (rates >= 0).all()
    totals = (tokens * rates) @ chances
    assert totals == pytest.approx(mix.targets, abs=1e-5 * mix.targets.sum())
    # Small steps come to the same totals, but slowly where few documents hold a domain alone.
    plain = projected(chances, tokens, mix.targets)
    assert (tokens * plain) @ chances == pytest.approx(totals, rel=0.03, abs=1)
    if weights is None:
        assert (totals >= tokens @ chances - 1e-3).all()
    else:
        assert totals / totals.sum() == pytest.approx(list(weights.values()), abs=1e-4)


def test_unreachable_targets_end_at_the_nearest(spark):
    rows = rows_of(spark, [[0.5, 0.5], [0.6, 0.4]], [100, 100])
    mix = mixing.fit_rates(rows, model_of("a", "b"), {"b": 1.0})
    rates = [r.rate for r in mixing.with_rates(rows, mix).collect()]
    assert all(np.isfinite(r) and r >= 0 for r in rates)
    none = mixing.fit_rates(rows.limit(0), model_of("a", "b"))
    assert none.totals.tolist() == [0, 0] and not none.gradient.any()


def test_domains_are_found_and_copies_follow_rates(spark):
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows, model, mix = mixing.mixed(documents, labels)
    assert model.domains == ("de", "en", "es", "fr")
    got = rows.join(documents.select("doc_id", "lang"), "doc_id").toPandas()
    best = [model.domains[int(np.argmax(p))] for p in got["posteriors"]]
    assert (got["lang"] == best).mean() > 0.95
    assert mix.totals == pytest.approx(mix.targets, abs=1e-5 * mix.targets.sum())
    counts = rows.select("rate", mixing.copies().alias("copies")).toPandas()
    assert ((counts["copies"] - counts["rate"]).abs() < 1).all()
    assert counts["copies"].sum() == pytest.approx(counts["rate"].sum(), rel=0.05)
    assert counts["rate"].min() > 0.99


def test_odd_rows(spark):
    documents = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1), (7, 1), (2, 1), (None, 1), (8, 0)], "doc_id long, quality int")
    rows, model, _ = mixing.mixed(clashing(documents), labels)
    got = rows.collect()
    assert model.domains == ("de", "en") and len(got) == len(odd_rows())
    by = {r.doc_id: r for r in got}
    assert by[2].n_tokens == by[3].n_tokens == 1 and by[2].posteriors == by[3].posteriors
    assert all(abs(sum(r.posteriors) - 1) < 1e-9 and r.rate >= 0 for r in got)
    rows, model, mix = mixing.mixed(documents, labels.limit(0))
    assert model.domains == ("",) and {r.rate for r in rows.collect()} == {1.0}
    rows, _, _ = mixing.mixed(empty_documents(spark), labels)
    assert rows.collect() == []


def test_targets_that_are_not_met_are_reported(spark):
    far = rows_of(spark, [[0.5, 0.5], [0.6, 0.4]], [100, 100])
    with pytest.warns(UserWarning, match="miss their targets"):
        assert not mixing.fit_rates(far, model_of("a", "b"), {"b": 1.0}).met
    chances, tokens = soft(200)
    rows = rows_of(spark, chances, tokens)
    with pytest.warns(UserWarning, match="miss their targets"):
        assert not mixing.fit_rates(rows, model_of("a", "b", "c"), steps=0).met
    assert mixing.fit_rates(rows, model_of("a", "b", "c")).met


def brute_least_squares(chances, tokens, targets, rounds=2_000):
    """Squares that no rates get below: coordinate steps, one rate at a time, until none moves."""
    whole = tokens @ chances
    rates, totals = np.ones(len(tokens)), tokens @ chances
    for _ in range(rounds):
        moved = 0.0
        for i, (p, t) in enumerate(zip(chances, tokens)):
            best = max(0.0, rates[i] - (p * (totals - targets) / whole).sum() / (t * (p * p / whole).sum()))
            moved = max(moved, abs(best - rates[i]))
            totals = totals + (best - rates[i]) * t * p
            rates[i] = best
        if moved < 1e-10:
            break
    return totals


@pytest.mark.parametrize("weights", [{"b": 1.0}, {"a": 0.02, "b": 0.97, "c": 0.01}, {"a": 0.3, "b": 0.3, "c": 0.4}])
def test_totals_are_the_nearest_that_rates_reach(spark, weights):
    drawn = np.random.default_rng(8)
    # No document holds a domain alone, so extreme shares are out of reach.
    chances = 0.1 + 0.7 * drawn.dirichlet([0.3] * 3, 25)
    tokens = drawn.integers(1, 900, 25)
    rows = rows_of(spark, chances, tokens)
    mix = mixing.fit_rates(rows, model_of("a", "b", "c"), weights)
    rates = {r.doc_id: r.rate for r in mixing.with_rates(rows, mix).collect()}
    rates = np.array([rates[i] for i in range(len(tokens))])
    assert (rates >= 0).all() and (tokens * rates) @ chances == pytest.approx(mix.totals, rel=1e-9)
    assert mix.totals == pytest.approx(brute_least_squares(chances, tokens, mix.targets), rel=1e-3)


def test_stored_rates_go_on_as_computed_ones(spark, monkeypatch):
    chances, tokens = soft(300)
    rows, weights = rows_of(spark, chances, tokens), {"a": 0.85, "b": 0.12, "c": 0.03}
    whole = mixing.fit_rates(rows, model_of("a", "b", "c"), weights)
    monkeypatch.setattr(mixing, "STORED", 3)
    parts = mixing.fit_rates(rows, model_of("a", "b", "c"), weights)
    assert len(whole.momenta) > 6 and parts.totals == pytest.approx(whole.totals, rel=1e-9)
    missing = rows.union(spark.sql("SELECT 9L, 5L, CAST(NULL AS array<double>)"))
    again = mixing.fit_rates(missing, model_of("a", "b", "c"), weights)
    assert again.totals == pytest.approx(whole.totals, rel=1e-9)
