"""Adaptive parameter search with a tree-structured Parzen sampler.

Past trials are split into the best share and the rest. Per parameter, each side
is a density on [0, 1] (the range, on a log scale where asked): a uniform part
and a Gaussian around every trial, as wide as the gap to its neighbours.
Candidates are drawn from the good side's density, and the one with the largest
ratio of good to bad density is taken. Trials of a batch run in parallel; those
still running count as bad, so that a batch spreads out.

The state is a list of trials (a handful of numbers each); every fit and every
score is a Spark job (``models.param_search``).
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from paddock.operators import models as ML


@dataclass(frozen=True)
class Real:
    low: float
    high: float
    log: bool = False

    def unit(self, x: float) -> float:
        f = math.log if self.log else float
        return (f(x) - f(self.low)) / (f(self.high) - f(self.low))

    def value(self, u: float):
        if self.log:
            return math.exp(math.log(self.low) + u * (math.log(self.high) - math.log(self.low)))
        return self.low + u * (self.high - self.low)


@dataclass(frozen=True)
class Whole(Real):
    def value(self, u: float) -> int:
        return min(int(self.high), max(int(self.low), round(super().value(u))))


#: Nine parameters of boosted trees: number and step of the trees, their shape,
#: row and column shares, and three that regularise.
SPACE = {"maxIter": Whole(100, 1000), "stepSize": Real(0.01, 0.3, log=True), "maxDepth": Whole(3, 12), "maxBins": Whole(16, 64),
         "minInstancesPerNode": Whole(5, 50), "subsamplingRate": Real(0.5, 1.0), "featureSubsetStrategy": Real(0.5, 1.0),
         "minInfoGain": Real(1e-6, 1e-2, log=True), "minWeightFractionPerNode": Real(1e-5, 1e-2, log=True)}
TRIALS, FOLDS, START, GOOD, DRAWS = 50, 3, 10, 0.2, 24


def _density(points: Sequence[float]) -> list[tuple[float, float]]:
    """(centre, width) of the Gaussians around the points."""
    xs = sorted(points)
    out = []
    for i, x in enumerate(xs):
        left, right = x - (xs[i - 1] if i else 0.0), (xs[i + 1] if i + 1 < len(xs) else 1.0) - x
        out.append((x, min(1.0, max(left, right, 1.0 / (1 + len(xs)) / 2))))
    return out


def _weight(kernels: Sequence[tuple[float, float]], u: float) -> float:
    total = 1.0                                             # the uniform part
    for c, s in kernels:
        inside = (math.erf((1 - c) / s / math.sqrt(2)) + math.erf(c / s / math.sqrt(2))) / 2
        total += math.exp(-((u - c) / s) ** 2 / 2) / (s * math.sqrt(2 * math.pi) * inside)
    return total / (1 + len(kernels))


def _draw(kernels: Sequence[tuple[float, float]], rnd: random.Random) -> float:
    i = rnd.randrange(len(kernels) + 1)
    if i == len(kernels):
        return rnd.random()
    c, s = kernels[i]
    for _ in range(100):
        u = rnd.gauss(c, s)
        if 0 <= u <= 1:
            return u
    return c


def suggest(space: dict[str, Real], trials: Sequence[tuple[dict, float]], running: Sequence[dict], rnd: random.Random,
            maximize: bool = True, start: int = START) -> dict:
    """The next trial's parameters; random until ``start`` trials are known."""
    if len(trials) < start:
        return {k: d.value(rnd.random()) for k, d in space.items()}
    ranked = sorted(trials, key=lambda t: -t[1] if maximize else t[1])
    n_good = max(1, math.ceil(GOOD * len(ranked)))
    good, bad = [p for p, _ in ranked[:n_good]], [p for p, _ in ranked[n_good:]] + list(running)
    out = {}
    for k, d in space.items():
        up, down = _density([d.unit(p[k]) for p in good]), _density([d.unit(p[k]) for p in bad])
        out[k] = d.value(max((_draw(up, rnd) for _ in range(DRAWS)), key=lambda u: _weight(up, u) / _weight(down, u)))
    return out


def search(evaluate: Callable[[int, list[dict]], list[float]], space: dict[str, Real], n: int = TRIALS, batch: int = 5,
           seed: int = 42, maximize: bool = True, start: int = START) -> list[tuple[dict, float]]:
    """Trials (parameters, score) in order; ``evaluate(first, batch)`` scores a
    batch whose first trial has that number. Reproducible by seed."""
    rnd, trials = random.Random(seed), []
    while len(trials) < n:
        running: list[dict] = []
        for _ in range(min(batch, n - len(trials))):
            running.append(suggest(space, trials, running, rnd, maximize, start))
        trials += list(zip(running, evaluate(len(trials), running), strict=True))
    return trials


def model_params(params: dict) -> dict:
    """Parameters as the tree estimator takes them."""
    return {k: str(round(v, 3)) if k == "featureSubsetStrategy" else v for k, v in params.items()}


def tune(df: DataFrame, feature_cols: Sequence[str], folds: DataFrame, space: dict[str, Real] | None = None, n: int = TRIALS,
         batch: int = 5, metric: str = "auc_roc", maximize: bool = True, kind: str = "gbt", seed: int = 42, start: int = START,
         parallelism: int = 4) -> DataFrame:
    """(candidate, params, fold, score): every trial on every time fold. Any
    metric of ``classification_metrics`` is an objective; log_loss is minimised."""
    found: list[DataFrame] = []
    ready = None if folds is None else ML.search_folds(folds, feature_cols)                # the same for all batches

    def evaluate(first: int, batch_params: list[dict]) -> list[float]:
        r = ML.param_search(df, feature_cols, ready, [model_params(p) for p in batch_params], metric, kind, parallelism)
        rows = r.collect()                                  # one number per trial and fold
        found.append(r.withColumn("candidate", r["candidate"] + first))
        scores = [[x["score"] for x in rows if x["candidate"] == i] for i in range(len(batch_params))]
        return [sum(s) / len(s) for s in scores]

    search(evaluate, space or SPACE, n, batch, seed, maximize and metric != "log_loss", start)
    out = found[0]
    for r in found[1:]:
        out = out.unionByName(r)
    return out
