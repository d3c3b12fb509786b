"""Which settings a search tries next, from the scores so far: at random, by Parzen densities, or by a surrogate.

A sampler is asked for one trial at a time. Trials that are still running are told to it as well, so that trials that run at
once differ. Everything follows from the seed and the history.
"""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np


@dataclass(frozen=True)
class Choice:
    values: tuple

    def draw(self, rng: random.Random):
        return rng.choice(self.values)


@dataclass(frozen=True)
class Integer:
    low: int
    high: int

    def draw(self, rng: random.Random):
        return rng.randint(self.low, self.high)


@dataclass(frozen=True)
class Real:
    low: float
    high: float

    def draw(self, rng: random.Random):
        return rng.uniform(self.low, self.high)


Axis = Choice | Integer | Real
#: Settings with their score; None for a trial that is running or has failed.
History = Sequence[tuple[Mapping[str, Any], float | None]]


def _bounds(axis: Integer | Real) -> tuple[float, float]:
    """Whole numbers stand for the unit around them."""
    return (axis.low - 0.5, axis.high + 0.5) if isinstance(axis, Integer) else (axis.low, axis.high)


def _valued(axis: Integer | Real, x: float):
    if isinstance(axis, Integer):
        return int(min(axis.high, max(axis.low, math.floor(x + 0.5))))
    return float(min(axis.high, max(axis.low, x)))


@dataclass
class RandomSampler:
    """Seeded draws, whatever the history."""

    space: Mapping[str, Axis]
    seed: int = 0

    def __post_init__(self):
        self.rng = random.Random(self.seed)

    def ask(self, history: History) -> dict[str, Any]:
        return {name: axis.draw(self.rng) for name, axis in self.space.items()}


@dataclass
class ParzenSampler(RandomSampler):
    """Tree-structured Parzen estimation: on every axis a density of the good trials and one of all others; of some draws from the
    first, the one where it is largest against the second. Running and failed trials are not good ones."""

    startup: int = 10
    share: float = 0.25
    candidates: int = 24

    def ask(self, history: History) -> dict[str, Any]:
        scored = sorted((t for t in history if t[1] is not None), key=lambda t: -t[1])
        if len(scored) < self.startup:
            return super().ask(history)
        n_good = max(1, math.ceil(self.share * math.sqrt(len(scored)) * 2))
        good = [s for s, _ in scored[:n_good]]
        other = [s for s, _ in scored[n_good:]] + [s for s, score in history if score is None]
        return {name: self._axis(axis, [s[name] for s in good], [s[name] for s in other]) for name, axis in self.space.items()}

    def _axis(self, axis: Axis, good: list, other: list):
        if isinstance(axis, Choice):
            a, b = ([1.0 + sum(v == x for x in seen) for v in axis.values] for seen in (good, other))
            drawn = self.rng.choices(range(len(axis.values)), a, k=self.candidates)
            return axis.values[max(drawn, key=lambda i: (a[i] / sum(a)) / (b[i] / sum(b)))]
        low, high = _bounds(axis)
        near, far = (_Mixture(np.array(seen, dtype=float), low, high) for seen in (good, other))
        drawn = [near.draw(self.rng) for _ in range(self.candidates)]
        return _valued(axis, max(drawn, key=lambda x: near.log_density(x) - far.log_density(x)))


class _Mixture:
    """Normal densities around the values seen and a wide one over the whole range, cut at its ends. Each is as wide as the gap to
    the farther of its neighbours."""

    def __init__(self, seen: np.ndarray, low: float, high: float):
        width = high - low
        seen = np.sort(np.append(seen, (low + high) / 2))
        gaps = np.diff(np.concatenate([[low], seen, [high]]))
        spread = np.clip(np.maximum(gaps[:-1], gaps[1:]), width / min(100.0, 1.0 + len(seen)), width)
        spread[np.flatnonzero(seen == (low + high) / 2)[:1]] = width
        self.low, self.high, self.centre, self.spread = low, high, seen, np.maximum(spread, 1e-12)
        root = math.sqrt(2)
        self.mass = np.array([
            0.5 * (math.erf((high - c) / s / root) - math.erf((low - c) / s / root)) for c, s in zip(self.centre, self.spread)])

    def draw(self, rng: random.Random) -> float:
        i = rng.randrange(len(self.centre))
        for _ in range(64):
            x = rng.gauss(self.centre[i], self.spread[i])
            if self.low <= x <= self.high:
                return x
        return float(self.centre[i])

    def log_density(self, x: float) -> float:
        z = (x - self.centre) / self.spread
        parts = -0.5 * z * z - np.log(self.spread * np.maximum(self.mass, 1e-12))
        top = parts.max()
        return float(top + math.log(np.exp(parts - top).sum() / len(parts)))


@dataclass
class SurrogateSampler(RandomSampler):
    """A Gaussian process over the encoded settings; the next trial is where it expects the largest improvement. Running trials
    count as if they had scored the mean. Of several kernel widths the one with the largest likelihood."""

    startup: int = 8
    candidates: int = 512
    noise: float = 1e-4

    def encoded(self, settings: Mapping[str, Any]) -> np.ndarray:
        """Numbers from 0 to 1; a choice is one of several corners that are equally far apart."""
        out: list[float] = []
        for name, axis in self.space.items():
            if isinstance(axis, Choice):
                out += [math.sqrt(0.5) * (settings[name] == v and type(settings[name]) is type(v)) for v in axis.values]
            else:
                low, high = _bounds(axis)
                out.append((settings[name] - low) / (high - low) if high > low else 0.0)
        return np.array(out)

    def ask(self, history: History) -> dict[str, Any]:
        scored = [t for t in history if t[1] is not None]
        if len(scored) < self.startup:
            return super().ask(history)
        mean = sum(s for _, s in scored) / len(scored)
        # What has failed or is running is known by its place only.
        x = np.stack([self.encoded(s) for s, _ in history])
        y = np.array([mean if score is None else score for _, score in history])
        spread = y.std() or 1.0
        y = (y - mean) / spread
        best = max((s for s, _ in scored), key=lambda s: next(v for t, v in scored if t is s))
        drawn = [super(SurrogateSampler, self).ask(history) for _ in range(self.candidates)] + [
            self._beside(best) for _ in range(self.candidates // 4)]
        at = np.stack([self.encoded(s) for s in drawn])
        kernel = self._kernel(x, y)
        gain = self._improvement(kernel, x, y, at)
        return drawn[int(gain.argmax())]

    def _beside(self, settings: Mapping[str, Any]) -> dict[str, Any]:
        """The settings with one axis or two drawn anew, numbers close by."""
        out = dict(settings)
        for name in self.rng.sample(list(self.space), k=min(len(self.space), self.rng.choice((1, 2)))):
            axis = self.space[name]
            if isinstance(axis, Choice):
                out[name] = axis.draw(self.rng)
            else:
                low, high = _bounds(axis)
                out[name] = _valued(axis, self.rng.gauss(settings[name], 0.1 * (high - low)))
        return out

    @staticmethod
    def _covariance(a: np.ndarray, b: np.ndarray, width: float) -> np.ndarray:
        d = np.sqrt(np.maximum(((a[:, None] - b[None]) ** 2).sum(axis=2), 0)) / width * math.sqrt(5)
        return (1 + d + d * d / 3) * np.exp(-d)  # Matern, five halves

    def _kernel(self, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        found = []
        for width in (0.1, 0.2, 0.4, 0.8, 1.6):
            k = np.linalg.cholesky(self._covariance(x, x, width) + (self.noise + 1e-8) * np.eye(len(x)))
            z = np.linalg.solve(k, y)
            found.append((float(0.5 * z @ z + np.log(np.diag(k)).sum()), width, k))
        _, width, k = min(found, key=lambda f: f[0])
        return width, k

    def _improvement(self, kernel, x, y, at) -> np.ndarray:
        width, k = kernel
        cross = self._covariance(x, at, width)
        half = np.linalg.solve(k, cross)
        mean = half.T @ np.linalg.solve(k, y)
        spread = np.sqrt(np.maximum(1 + self.noise - (half ** 2).sum(axis=0), 1e-12))
        z = (mean - y.max()) / spread
        below = np.array([0.5 * (1 + math.erf(v / math.sqrt(2))) for v in z])
        return (mean - y.max()) * below + spread * np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)


SAMPLERS = {"random": RandomSampler, "parzen": ParzenSampler, "surrogate": SurrogateSampler}
