"""Maximum-likelihood fits whose objective is a distributed aggregate.

The driver holds only three or four parameters.  A job gives the mean log-likelihood with its
gradient and curvature, in closed form, at the next point and at shorter steps towards it: one
pass over the compressed customer table for each round of a Newton descent.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custvalue.functions.scratch import settle
from custvalue.operators.btyd import BgNbd, GammaGamma, ParetoNbd, value_names
from custvalue.params import ClvParams

# Ages are scaled so that the oldest customer is 10 time units old.
OLDEST = 10.0
STEPS = (1.0, 0.25, 0.02)
LONGEST_MOVE = 4.0
ROUNDS = 50
# Beyond this logarithm of a (scaled) parameter the data says nothing more about it.
EDGE = 9.0


def compress(summary: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Distinct model inputs with their number of customers ``n``; they share a likelihood term."""
    return summary.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


class NotConverged(RuntimeError):
    """A fit that ended without a minimum."""


@dataclasses.dataclass(frozen=True)
class Descent:
    """Where a descent ended.

    ``status`` is "converged"; "boundary" if the objective no longer changes but a parameter
    has run off; "stalled" if no step from a sloping point was better; or "rounds" if they
    were used up.
    """

    point: np.ndarray
    value: float
    status: str
    gradient_norm: float
    rounds: int


class Fit(NamedTuple):
    """A fitted model, its penalised objective, how the descent ended, and the parameters on the
    scale of the fit, which the penalty applies to."""

    model: object
    objective: float
    status: str
    gradient_norm: float
    rounds: int
    scaled: dict[str, float]


class Slope(NamedTuple):
    """Value, gradient and curvature at a point; not finite where there is none."""

    value: float
    gradient: np.ndarray
    curvature: np.ndarray


class Objective:
    """Mean log-likelihood of a model over compressed inputs, with its derivatives.

    A task sums the closed forms over a batch of customers at once, for all points of a round; only
    these sums are shuffled. A customer with an unknown input has no likelihood and is left out.
    """

    def __init__(self, inputs: DataFrame, model: type) -> None:
        numbers = [F.col(c).cast("double").alias(c) for c in ("n", *model.inputs)]
        self.inputs = inputs.select(*numbers).dropna()
        self.model = model
        self.names = tuple(field.name for field in dataclasses.fields(model))

    def sums(self, points: list[dict[str, float]]) -> DataFrame:
        """For each point ``i``: customers ``n``, sums of the log-likelihood and its derivatives."""
        model, names = self.model, ["n", *value_names(self.names)]
        known = [point | model.constants(**point) for point in points]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(known), len(names)))
            for batch in batches:
                n, *columns = (np.asarray(column) for column in batch.columns)
                for i, point in enumerate(known):
                    with np.errstate(all="ignore"):  # a point may lie where there is no value
                        total[i] += [n.sum(), *(n @ found for found in model.derivatives(point, *columns))]
            yield pa.record_batch([np.arange(len(known)), *total.T], names=["i", *names])

        schema = f"i long, {', '.join(f'{name} double' for name in names)}"
        partial = self.inputs.mapInArrow(run, schema)
        return partial.groupBy("i").agg(*(F.sum(name).alias(name) for name in names))

    def __call__(self, points: list[dict[str, float]]) -> list[Slope]:
        size, names = len(self.names), value_names(self.names)
        found = {row["i"]: row for row in self.sums(points).collect()}
        slopes = []
        for i in range(len(points)):
            numbers = np.array([found[i][c] for c in names]) / found[i]["n"]
            curvature = np.zeros((size, size))
            upper = np.triu_indices(size)
            curvature[upper] = curvature.T[upper] = numbers[1 + size :]
            slopes.append(Slope(numbers[0], numbers[1 : 1 + size], curvature))
        return slopes


def minimise(
    evaluate: Callable[[np.ndarray], list[Slope]],
    start: np.ndarray,
    tolerance: float = 1e-7,
    rounds: int = ROUNDS,
) -> Descent:
    """Newton descent; a round scores the next point and shorter steps at once.

    It has converged if a round gains less than ``tolerance`` or the gradient is below its square
    root (relative); or if none of a round's points is better, as the gradient is lost in the last
    digits of the objective.
    """
    point = np.asarray(start, dtype=float)
    (here,) = evaluate(point[None])
    status, done = "rounds", 0
    for done in range(1, rounds + 1):
        bends, axes = np.linalg.eigh(here.curvature)
        bends = np.maximum(np.abs(bends), 1e-10 * max(np.abs(bends).max(), 1e-6))
        move = -axes @ ((axes.T @ here.gradient) / bends)
        move *= min(1.0, LONGEST_MOVE / max(np.linalg.norm(move), 1e-300))
        tries = point + np.outer(STEPS, move)
        scored = [s if np.isfinite([s.value, *s.gradient]).all() else None for s in evaluate(tries)]
        values = [math.inf if s is None else s.value for s in scored]
        best = int(np.argmin(values))
        gain = here.value - values[best]
        if gain <= 0:
            flat = np.linalg.norm(here.gradient) <= 1e-5 * (1 + abs(here.value))
            status = "converged" if flat else "stalled"
            break
        point, here = tries[best], scored[best]
        slope = np.linalg.norm(here.gradient)
        if gain < tolerance * (1 + abs(here.value)) or slope < math.sqrt(tolerance) / 10:
            status = "converged"
            break
    if status == "converged" and np.abs(point).max() > EDGE:
        status = "boundary"
    return Descent(point, float(here.value), status, float(np.linalg.norm(here.gradient)), done)


def _fit(
    inputs: DataFrame, model: type, names: tuple[str, ...], penalizer: float, rounds: int
) -> tuple[dict[str, float], Descent]:
    """Parameters that minimise mean negative log-likelihood plus an L2 penalty."""

    objective = Objective(inputs, model)

    def evaluate(logs: np.ndarray) -> list[Slope]:
        """Cost by the logarithms of the parameters, which may then be any numbers."""
        params = np.exp(logs)
        found = objective([dict(zip(names, map(float, row))) for row in params])
        return [
            Slope(
                penalizer * (p**2).sum() - s.value,
                2 * penalizer * p**2 - p * s.gradient,
                np.diag(4 * penalizer * p**2 - p * s.gradient) - np.outer(p, p) * s.curvature,
            )
            for p, s in zip(params, found)
        ]

    # Cached copies lost with an executor are read again from the settled table.
    inputs.persist()
    try:
        found = minimise(evaluate, np.zeros(len(names)), rounds=rounds)
    finally:
        inputs.unpersist()
    if found.status not in ("converged", "boundary"):
        raise NotConverged(
            f"{model.__name__}: {found.status} after {found.rounds} rounds, "
            f"gradient norm {found.gradient_norm:.3g}"
        )
    return dict(zip(names, map(float, np.exp(found.point)))), found


def _fit_timed(summary: DataFrame, model: type, params: ClvParams, rounds: int) -> Fit:
    inputs = settle(compress(summary, model.inputs))
    oldest = inputs.agg(F.max("T")).first()[0]
    if not oldest:
        raise ValueError("no customer with a positive age to fit")
    scale = OLDEST / oldest
    scaled = inputs.select("n", "frequency", *[(F.col(c) * scale).alias(c) for c in ("recency", "T")])
    names = tuple(f.name for f in dataclasses.fields(model))
    values, found = _fit(scaled, model, names, params.penalizer, rounds)
    rescaled = {k: v / scale if k in model.time_parameters else v for k, v in values.items()}
    return Fit(model(**rescaled), found.value, found.status, found.gradient_norm, found.rounds, values)


def fit_bgnbd(summary: DataFrame, params: ClvParams, rounds: int = ROUNDS) -> Fit:
    """BG/NBD and its penalised objective, on ages scaled as above; raises if not converged."""
    return _fit_timed(summary, BgNbd, params, rounds)


def fit_paretonbd(summary: DataFrame, params: ClvParams, rounds: int = ROUNDS) -> Fit:
    """Pareto/NBD and its penalised objective, on ages scaled as above; raises if not converged."""
    return _fit_timed(summary, ParetoNbd, params, rounds)


def fit_gamma_gamma(summary: DataFrame, penalizer: float = 0.0, rounds: int = ROUNDS) -> Fit:
    """Gamma-Gamma on repeat customers; money is scaled by its mean during the fit.

    The model has no place for a repeat customer without positive spend, so one is refused.
    Mean values rarely repeat, so equal inputs are not looked for.
    """
    repeat = summary.where(F.col("frequency") > 0).select(
        *GammaGamma.inputs, F.lit(1).cast("bigint").alias("n")
    )
    inputs = settle(repeat)
    spend = F.col("monetary_value")
    head = inputs.agg(
        F.avg(spend).alias("mean"), F.count_if(spend.isNull() | (spend <= 0)).alias("refused")
    ).first()
    if head["refused"]:
        raise ValueError(f"{head['refused']} repeat customers have no positive spend")
    if head["mean"] is None:
        raise ValueError("no repeat customer to fit")
    scaled = inputs.select("n", "frequency", (spend / head["mean"]).alias("monetary_value"))
    values, found = _fit(scaled, GammaGamma, ("p", "q", "v"), penalizer, rounds)
    model = GammaGamma(**(values | {"v": values["v"] * head["mean"]}))
    return Fit(model, found.value, found.status, found.gradient_norm, found.rounds, values)
