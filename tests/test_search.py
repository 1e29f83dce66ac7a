"""Adaptive search: seeded, better than random draws, early ends."""

import math
import random

import pytest

from loamwork.operators.search import Parzen, Pruned, Range, adaptive_search, hopeless, suggest

SPACE = {"x": Range(-5, 10), "y": Range(0, 15), "n": Range(1, 9, whole=True), "s": Range(1e-4, 1.0, log=True)}


def hill(p):
    """Greatest value 0 at x = 2, y = 11, n = 4, s = 0.01."""
    return -((p["x"] - 2) ** 2 / 10 + (p["y"] - 11) ** 2 / 10 + (p["n"] - 4) ** 2 / 4 + (math.log10(p["s"]) + 2) ** 2)


def test_better_than_random_draws():
    wins, ours, theirs = 0, 0.0, 0.0
    for seed in range(20):
        best = max(t.metric for t in adaptive_search(lambda p, report: hill(p), SPACE, seed=seed))
        draw = random.Random(seed)
        plain = max(hill({k: r.value(draw.random()) for k, r in SPACE.items()}) for _ in range(40))
        wins, ours, theirs = wins + (best > plain), ours + best, theirs + plain
    assert wins >= 14 and ours > theirs * 2 / 3


def test_same_seed_same_trials_also_side_by_side():
    for parallel in (1, 4):
        a, b = (adaptive_search(lambda p, report: hill(p), SPACE, 24, seed=3, parallel=parallel) for _ in range(2))
        assert a == b and [t.number for t in a] == list(range(24))
    assert adaptive_search(lambda p, report: hill(p), SPACE, 24, seed=4) != a


def test_values_stay_in_their_range():
    draw = random.Random(1)
    for t in adaptive_search(lambda p, report: draw.random(), SPACE, 60, seed=1):
        for name, r in SPACE.items():
            assert r.low <= t.params[name] <= r.high and (not r.whole or isinstance(t.params[name], int))
    for r in SPACE.values():
        assert r.value(0.0) == pytest.approx(r.low) and r.value(1.0) == pytest.approx(r.high)
        assert r.value(r.unit(r.value(0.3))) == pytest.approx(r.value(0.3))
    assert Range(3, 3).value(0.7) == 3 and {Range(1, 3, whole=True).value(u / 100) for u in range(101)} == {1, 2, 3}


def test_hopeless_trials_end_early():
    full = []

    def objective(p, report):
        report(hill(p) - 1)
        full.append(p)
        return hill(p)

    trials = adaptive_search(objective, SPACE, seed=5)
    pruned = [t for t in trials if t.pruned]
    assert 5 <= len(pruned) < 30 and len(full) == 40 - len(pruned)
    assert all(t.metric is None and len(t.steps) == 1 for t in pruned)
    for t in pruned:
        assert hopeless(trials[: t.number], 0, t.steps[0])
    assert not any(t.pruned for t in adaptive_search(objective, SPACE, seed=5, prune=False))
    best = max(t.metric for t in trials if not t.pruned)
    assert best == max(t.metric or -math.inf for t in trials)


def test_densities_are_densities():
    for points in ([], [0.0], [0.2, 0.2, 0.9], [0.5]):
        p = Parzen(points)
        assert sum(p.density((i + 0.5) / 2000) for i in range(2000)) / 2000 == pytest.approx(1, abs=1e-3)
        assert all(0 <= p.draw(random.Random(i)) <= 1 for i in range(30))


def test_errors_of_an_objective_are_raised():
    def broken(p, report):
        raise ValueError("no data")

    with pytest.raises(ValueError):
        adaptive_search(broken, SPACE, 3)
    assert suggest(SPACE, [], [], random.Random(0)).keys() == SPACE.keys() and issubclass(Pruned, Exception)
