"""Adaptive search of parameters: tree-structured Parzen estimates in rounds of parallel trials.

After a few random trials the best quarter of those so far and the rest are each described by a density
a parameter; candidates are drawn from the density of the good ones and the one whose ratio of both
densities is highest is tried next. A round proposes several at a time from what earlier rounds found.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

STARTUP = 8
GOOD = 0.25
DRAWS = 24


@dataclass(frozen=True)
class Range:
    """A parameter from ``low`` to ``high`` (left out for whole numbers), even in its logarithm with ``log``."""

    low: float
    high: float
    whole: bool = False
    log: bool = False

    def __call__(self, rng: random.Random) -> float:
        if self.whole:
            return rng.randrange(int(self.low), int(self.high))
        if self.log:
            return self.low * (self.high / self.low) ** rng.random()
        return rng.uniform(self.low, self.high)

    def place(self, value: float) -> float:
        """Where a value lies between the ends, 0 to 1."""
        if self.log:
            return math.log(value / self.low) / math.log(self.high / self.low)
        return (value - self.low) / (self.high - self.low)

    def at(self, place: float) -> float:
        """The value at a place; whole numbers by their interval."""
        place = min(max(place, 0.0), 1.0)
        if self.log:
            return self.low * (self.high / self.low) ** place
        value = self.low + place * (self.high - self.low)
        return min(int(value), int(self.high) - 1) if self.whole else value


def widths(places: list[float]) -> list[float]:
    """Width of each point's bump: the distance to its farther neighbour, within bounds."""
    ordered = sorted([0.0, *places, 1.0])
    least = 1 / (1 + min(99, len(places)))
    out = []
    for p in places:
        i = ordered.index(p, 1)
        out.append(min(max(p - ordered[i - 1], ordered[i + 1] - p, least), 1.0))
    return out


def density(place: float, places: list[float]) -> float:
    """Mean of a normal bump at each point, cut at the ends, and of an even share."""
    total = 1.0
    for p, w in zip(places, widths(places), strict=True):
        inside = 0.5 * (math.erf((1 - p) / w / math.sqrt(2)) - math.erf(-p / w / math.sqrt(2)))
        total += math.exp(-0.5 * ((place - p) / w) ** 2) / (w * math.sqrt(2 * math.pi)) / inside
    return total / (len(places) + 1)


def draw(places: list[float], rng: random.Random) -> float:
    """A place drawn from :func:`density`."""
    i = rng.randrange(len(places) + 1)
    if i == len(places):
        return rng.random()
    width = widths(places)[i]
    while not 0 <= (place := rng.gauss(places[i], width)) <= 1:
        pass
    return place


def propose(
    history: list[tuple[dict[str, Any], float]], space: dict[str, Range], rng: random.Random
) -> dict[str, Any]:
    """The next parameters to try, after trials with their losses (lower is better)."""
    if len(history) < STARTUP:
        return {name: span(rng) for name, span in space.items()}
    ranked = sorted(history, key=lambda trial: trial[1])
    n = max(1, math.ceil(GOOD * len(ranked)))
    out = {}
    for name, span in space.items():
        good, bad = ([span.place(params[name]) for params, _ in part] for part in (ranked[:n], ranked[n:]))
        drawn = [draw(good, rng) for _ in range(DRAWS)]
        out[name] = span.at(max(drawn, key=lambda place: density(place, good) / density(place, bad)))
    return out


def search(
    loss: Callable[[dict[str, Any]], float],
    space: dict[str, Range],
    n_trials: int,
    seed: int = 0,
    per_round: int = 4,
) -> list[tuple[dict[str, Any], float]]:
    """All trials in order. Those of a round run at the same time; the proposals depend on the seed alone."""
    rng, history = random.Random(seed), []
    with ThreadPoolExecutor(max_workers=per_round) as pool:
        while len(history) < n_trials:
            some = [propose(history, space, rng) for _ in range(min(per_round, n_trials - len(history)))]
            history += zip(some, pool.map(loss, some), strict=True)
    return history
