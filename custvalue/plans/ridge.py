"""Linear models of any penalty from one table of moments.

Inputs and label are standardized by the training rows, so a penalty means the same whatever
their units: the least of mean((y - xb)^2) + l2 * sum(b^2) + l1 * sum(|b|). The driver holds
the matrix of products, whose size is that of the list of columns.
"""

from __future__ import annotations

import dataclasses
import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from custvalue.operators.moments import ONE

#: Range of the l2 penalty, drawn evenly by its logarithm, and the number of settings.
L2_RANGE = (1e-4, 100.0)
TRIALS = 1000
#: Step of a sequence whose every start is spread over the range: the golden ratio less one.
GOLDEN = 0.6180339887498949


@dataclasses.dataclass(frozen=True)
class Terms:
    """A linear model: its intercept, coefficients and their effects, in the label's unit, of one
    standard deviation of the input."""

    names: tuple[str, ...]
    intercept: float
    coefficients: np.ndarray
    effects: np.ndarray


class Products:
    """Products of a group's columns, from a table of moments."""

    def __init__(self, names: list[str], matrix: np.ndarray):
        self.names, self.matrix = names, matrix
        self.count = matrix[0, 0]
        self.means = matrix[0, 1:] / self.count
        covariance = matrix[1:, 1:] / self.count - np.outer(self.means, self.means)
        spread = np.sqrt(np.clip(np.diag(covariance), 0, None))
        # A column that does not vary has no effect.
        self.varies = spread > 1e-12 * np.maximum(1.0, np.abs(self.means))
        self.spread = np.where(self.varies, spread, 1.0)
        self.correlation = covariance / np.outer(self.spread, self.spread)

    @property
    def inputs(self) -> tuple[str, ...]:
        return tuple(self.names[1:-1])

    def terms(self, standardized: np.ndarray) -> Terms:
        """The model of some standardized coefficients."""
        effects = standardized * self.spread[-1]
        coefficients = effects / self.spread[:-1]
        return Terms(self.inputs, float(self.means[-1] - coefficients @ self.means[:-1]), coefficients, effects)

    def ridge(self, penalties: list[float]) -> list[Terms]:
        """Models of several l2 penalties, from one decomposition."""
        free = np.flatnonzero(self.varies[:-1])
        values, axes = np.linalg.eigh(self.correlation[np.ix_(free, free)])
        along = axes.T @ self.correlation[free, -1]
        found = []
        for l2 in penalties:
            kept = values + l2 > 1e-10 * max(values.max(initial=0.0), 1e-300)
            b = np.zeros(len(self.inputs))
            b[free] = axes[:, kept] @ (along[kept] / (values[kept] + l2))
            found.append(self.terms(b))
        return found

    def elastic_net(self, l1: float, l2: float, rounds: int = 10_000) -> Terms:
        """The model of both penalties, by descent on one coefficient after the other."""
        b, toward = np.zeros(len(self.inputs)), self.correlation[:-1, -1]
        inner = self.correlation[:-1, :-1]
        for _ in range(rounds):
            largest = 0.0
            for j in np.flatnonzero(self.varies[:-1]):
                rest = toward[j] - inner[j] @ b + inner[j, j] * b[j]
                new = math.copysign(max(abs(rest) - l1 / 2, 0.0), rest) / (inner[j, j] + l2)
                largest, b[j] = max(largest, abs(new - b[j])), new
            if largest < 1e-13:
                break
        return self.terms(b)

    def around(self, whole: Products) -> np.ndarray:
        """Products of these rows in the standardized columns of others, by row."""
        means = np.concatenate([[0.0], whole.means])
        raw = self.matrix / self.count
        centred = raw - np.outer(means, raw[0]) - np.outer(raw[0], means) + np.outer(means, means)
        return centred[1:, 1:] / np.outer(whole.spread, whole.spread)

    def rmse(self, model: Terms) -> float:
        """Error of a model, which may come from other rows, on these."""
        residual = np.concatenate([[-model.intercept], -model.coefficients, [1.0]])
        return math.sqrt(max(0.0, residual @ self.matrix @ residual) / self.count)


def proximal(
    whole: Products,
    blocks: list[Products],
    l1: float,
    l2: float = 0.0,
    rate: float = 0.5,
    decay_rate: float = 1.0,
    decay_steps: int = 100,
    steps: int = 2000,
) -> Terms:
    """The model of both penalties by proximal Adagrad steps, a block of rows after the other.

    The rate falls by ``decay_rate`` after every ``decay_steps`` steps. A block's gradient comes from
    its moments, so any number of steps and settings costs the one pass that made these.
    """
    matrices = [b.around(whole) for b in blocks]
    free = whole.varies[:-1]
    b, squares = np.zeros(len(free)), np.full(len(free), 0.1)
    for step in range(steps):
        m = matrices[step % len(matrices)]
        slope = np.where(free, 2 * (m[:-1, :-1] @ b - m[:-1, -1] + l2 * b), 0.0)
        squares += slope * slope
        pace = rate * decay_rate ** (step // decay_steps) / np.sqrt(squares)
        moved = b - pace * slope
        b = np.sign(moved) * np.maximum(np.abs(moved) - pace * l1, 0.0)
    return whole.terms(b)


#: Settings of a search over steps, with the decay of their rate.
STEP_RANGES = {"l1": (1e-4, 0.1), "l2": (1e-4, 0.1), "rate": (0.05, 1.0), "decay_rate": (0.5, 1.0)}


def step_search(
    spark: SparkSession, train: Products, blocks: list[Products], chosen: Products, trials: int = 100
) -> tuple[Terms, DataFrame]:
    """The best of many settings of ``proximal`` by the error on other rows, and all of them."""
    rows, models = [], []
    for trial in range(trials):
        shares = [math.fmod((trial + 1) * GOLDEN * (k + 1) ** 0.5, 1.0) for k in range(len(STEP_RANGES))]
        drawn = {
            name: low * (high / low) ** u for u, (name, (low, high)) in zip(shares, STEP_RANGES.items())
        }
        models.append(proximal(train, blocks, steps=400, decay_steps=40, **drawn))
        rows.append((trial, *drawn.values(), train.rmse(models[-1]), chosen.rmse(models[-1])))
    ddl = ", ".join(["trial int", *(f"{name} double" for name in STEP_RANGES), "train_rmse double", "rmse double"])
    best = min(range(trials), key=lambda i: rows[i][-1])
    return models[best], spark.createDataFrame(rows, ddl)


def products(moments: DataFrame, inputs: list[str], label: str, by: str = "split") -> dict[str, Products]:
    """Products of every group of a table of moments."""
    names = [ONE, *inputs, label]
    place = {name: i for i, name in enumerate(names)}
    matrices: dict[str, np.ndarray] = {}
    for row in moments.collect():
        if row["left"] in place and row["right"] in place:
            matrix = matrices.setdefault(row[by], np.zeros((len(names), len(names))))
            i, j = place[row["left"]], place[row["right"]]
            matrix[i, j] = matrix[j, i] = row["total"]
    return {group: Products(names, m) for group, m in matrices.items() if m[0, 0] > 0}


def penalties(trials: int = TRIALS, bounds: tuple[float, float] = L2_RANGE) -> list[float]:
    """Settings of a search, the first ones of a longer search."""
    low, high = bounds
    return [low * math.pow(high / low, math.fmod((i + 1) * GOLDEN, 1.0)) for i in range(trials)]


def search(
    spark: SparkSession, found: dict[str, Products], trials: int = TRIALS, chosen_by: str = "eval"
) -> tuple[Terms, DataFrame]:
    """The model with the least error on a split, and every trial with its errors."""
    if "train" not in found or chosen_by not in found:
        raise ValueError(f"no rows in the train or {chosen_by} split to search with")
    settings = penalties(trials)
    models = found["train"].ridge(settings)
    errors = [(found["train"].rmse(m), found[chosen_by].rmse(m)) for m in models]
    rows = [(i, l2, *e) for i, (l2, e) in enumerate(zip(settings, errors))]
    best = min(range(trials), key=lambda i: errors[i][1])
    return models[best], spark.createDataFrame(rows, "trial int, l2 double, train_rmse double, rmse double")
