"""Random search over model settings, scored on the evaluation split."""

from __future__ import annotations

import dataclasses
import math
import random
from collections.abc import Mapping
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custvalue.operators.metrics import evaluation_report
from custvalue.plans.models import PREDICTION, FitOptions, fit_model, save_version, score
from custvalue.sources import schemas
from custvalue.sources.sinks import write_parquet

PARALLEL_TRIALS = 10


@dataclasses.dataclass(frozen=True)
class Range:
    """A range of doubles, drawn evenly, or densely near its top if ``reverse_log``."""

    low: float
    high: float
    reverse_log: bool = False

    def draw(self, rng: random.Random) -> float:
        u = rng.random()
        if not self.reverse_log:
            return self.low + (self.high - self.low) * u
        mirrored = self.low * math.pow(self.high / self.low, 1 - u)
        return self.low + self.high - mirrored


@dataclasses.dataclass(frozen=True)
class Choice:
    """One of a few values."""

    values: tuple

    def draw(self, rng: random.Random):
        return rng.choice(self.values)


# Ranges of the penalties are fixed values.
LINEAR_SPACE = {"l1": Range(0.0001, 0.1, True), "l2": Range(0.0001, 0.1, True)}
# For about twenty boosted trees: steps that can reach the level of the label within them, most
# of the rows for each, and trees from stumps of a few leaves to some dozens.
TREE_SPACE = {
    "step_size": Range(0.05, 0.4),
    "subsampling_rate": Range(0.6, 1.0),
    "max_depth": Choice((2, 3, 4, 5)),
    "min_instances": Choice((1, 2, 5, 10)),
}


def draw_trials(space: Mapping[str, Range | Choice], count: int, seed: int) -> list[FitOptions]:
    """``count`` settings, the same for the same seed."""
    rng = random.Random(seed)
    return [
        FitOptions(**{name: dim.draw(rng) for name, dim in space.items()}) for _ in range(count)
    ]


def tune(
    model_type: str,
    labelled: DataFrame,
    space: Mapping[str, Range | Choice],
    trials: int,
    seed: int = 42,
    parallelism: int = PARALLEL_TRIALS,
    metric: str = "rmse",
    folder: str | None = None,
) -> tuple[FitOptions, DataFrame]:
    """Best settings by ``metric`` ("rmse" or "mae"), and a table of all trials with both.

    ``labelled`` carries ``split`` and should be stored or cached: each trial
    reads it.  Trials run side by side as Spark jobs.  With a ``folder``, every trial's model is
    saved as its version and the table beside them.
    """
    if metric not in ("rmse", "mae"):
        raise ValueError(f"metric must be 'rmse' or 'mae', got {metric!r}")
    spark = labelled.sparkSession
    train = labelled.where(F.col("split") == "train")
    held_out = labelled.where(F.col("split") == "eval")
    if held_out.isEmpty():
        raise ValueError("no rows in the evaluation split to choose by")
    settings = draw_trials(space, trials, seed)

    def run(trial: int) -> tuple[float, float]:
        model = fit_model(model_type, train, settings[trial])
        report = evaluation_report(score(model, held_out), PREDICTION, schemas.TARGET).first()
        if folder:
            save_version(model, f"{folder.rstrip('/')}/models", trial)
        return report["rmse"], report["mae"]

    with ThreadPool(min(parallelism, trials)) as pool:
        errors = pool.map(run, range(trials))
    rows = [
        [i, *errors[i], *(float(getattr(settings[i], name)) for name in space)]
        for i in range(trials)
    ]
    best = min(range(trials), key=lambda i: errors[i][metric == "mae"])
    ddl = ", ".join(["trial int", "rmse double", "mae double", *(f"{name} double" for name in space)])
    table = spark.createDataFrame(rows, ddl)
    if folder:
        path = f"{folder.rstrip('/')}/trials"
        write_parquet(table.coalesce(1), path)
        table = spark.read.parquet(path)
    return settings[best], table
