"""Adaptive search over parameters: Parzen estimators of good and bad trials, and early ends for hopeless ones.

Only parameters and metrics of the trials are held here; what a trial costs is the Spark jobs of its objective.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from statistics import median


@dataclass(frozen=True)
class Range:
    """Values from ``low`` to ``high``, whole numbers or not, spread evenly or by their logarithm."""

    low: float
    high: float
    whole: bool = False
    log: bool = False

    def unit(self, value: float) -> float:
        """Place of a value in 0..1; whole numbers stand in the middle of their cell."""
        low, high = self._edges()
        value = math.log(value) if self.log else value
        return (value - low) / (high - low) if high > low else 0.5

    def value(self, unit: float) -> float:
        low, high = self._edges()
        v = low + min(max(unit, 0.0), 1.0) * (high - low)
        v = math.exp(v) if self.log else v
        return min(max(round(v), int(self.low)), int(self.high)) if self.whole else min(max(v, self.low), self.high)

    def _edges(self) -> tuple[float, float]:
        half = 0.5 if self.whole else 0.0
        low, high = self.low - half, self.high + half
        return (math.log(low), math.log(high)) if self.log else (low, high)


@dataclass
class Trial:
    number: int
    params: dict[str, float]
    steps: list[float] = field(default_factory=list)
    metric: float | None = None
    pruned: bool = False


class Pruned(Exception):
    """The trial is hopeless and ends here."""


class Parzen:
    """Mixture of normal kernels on 0..1, one per point and a wide one in the middle, cut off at the ends."""

    def __init__(self, points: Sequence[float]) -> None:
        ordered = sorted([*points, 0.5])
        self.kernels = [(0.5, 1.0)]
        least = 1 / min(100, len(points) + 2)
        for p in points:
            at = ordered.index(p)
            left = p - (ordered[at - 1] if at else 0.0)
            right = (ordered[at + 1] if at + 1 < len(ordered) else 1.0) - p
            self.kernels.append((p, min(max(left, right, least), 1.0)))

    def draw(self, source: random.Random) -> float:
        middle, width = source.choice(self.kernels)
        while True:
            x = source.gauss(middle, width)
            if 0 <= x <= 1:
                return x

    def density(self, x: float) -> float:
        def below(z: float) -> float:
            return 0.5 * (1 + math.erf(z / math.sqrt(2)))

        total = 0.0
        for middle, width in self.kernels:
            inside = below((1 - middle) / width) - below(-middle / width)
            total += math.exp(-0.5 * ((x - middle) / width) ** 2) / (width * math.sqrt(2 * math.pi) * inside)
        return total / len(self.kernels)


def suggest(space: Mapping[str, Range], done: Sequence[Trial], pending: Sequence[Trial], source: random.Random, startup: int = 10, share: float = 0.15, candidates: int = 24) -> dict[str, float]:
    """Parameters of the next trial: random ones at first, then the candidate that is most likelier among good than among bad trials.

    ``done`` has larger metrics for better trials; pruned trials count by their last step, behind all others. Trials that
    are still running count as bad, so that parallel suggestions keep apart.
    """
    if len(done) < startup:
        return {name: r.value(source.random()) for name, r in space.items()}
    ranked = sorted(done, key=lambda t: (t.pruned, -(t.steps[-1] if t.pruned else t.metric), t.number))
    n_good = max(1, math.ceil(share * len(ranked)))
    good, bad = ranked[:n_good], [*ranked[n_good:], *pending]
    out = {}
    for name, r in space.items():
        likely, unlikely = Parzen([r.unit(t.params[name]) for t in good]), Parzen([r.unit(t.params[name]) for t in bad])
        drawn = [likely.draw(source) for _ in range(candidates)]
        out[name] = r.value(max(drawn, key=lambda x: likely.density(x) / unlikely.density(x)))
    return out


def hopeless(done: Sequence[Trial], step: int, value: float, startup: int = 5) -> bool:
    """Whether a value at a step is below the median of the earlier trials at that step."""
    others = [t.steps[step] for t in done if len(t.steps) > step]
    return len(others) >= startup and value < median(others)


def adaptive_search(
    objective: Callable[[dict, Callable[[float], None]], float], space: Mapping[str, Range], trials: int = 40, seed: int = 42, parallel: int = 1, startup: int = 10, prune: bool = True
) -> list[Trial]:
    """Trials in order; the objective's value is maximised.

    ``objective(params, report)`` may report intermediate values, the same number for every trial; ``report`` raises
    ``Pruned`` where a trial is hopeless. ``parallel`` trials run side by side and are judged by those before their batch, so
    that the same seed gives the same trials.
    """
    source, done = random.Random(seed), []
    while len(done) < trials:
        batch: list[Trial] = []
        for k in range(min(parallel, trials - len(done))):
            batch.append(Trial(len(done) + k, suggest(space, done, batch, source, startup)))
        before = list(done)

        def run(trial: Trial, before: list[Trial] = before) -> Trial:
            def report(value: float) -> None:
                trial.steps.append(value)
                if prune and hopeless(before, len(trial.steps) - 1, value):
                    raise Pruned

            try:
                trial.metric = objective(trial.params, report)
            except Pruned:
                trial.pruned = True
            return trial

        with ThreadPoolExecutor(parallel) as pool:
            done += pool.map(run, batch)
    return done
