"""Boosted trees of many settings at once, on binned inputs.

A pass over the rows gives the histograms of one level of one tree for *all* settings that are
tried: counts and residual sums by setting, node, input and bin. They are summed and searched for
the best split by Spark; the driver gets one split for each node. Trees therefore cost passes by
their depth, not by the number of settings, and what was grown is the warm start of what follows.

Inputs are binned evenly between the least and the largest of the training rows, on a logarithmic
scale to both sides of zero. A setting's trees are a few numbers, held by the driver and sent to
the tasks; a task predicts with numpy, a batch at a time.
"""

from __future__ import annotations

import dataclasses
import json
import random
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from custvalue.functions.scratch import settle
from custvalue.plans.tune import Choice, Range
from custvalue.sources.sinks import latest_version, mark_complete, version_path

BINS = 32
#: Settings of a search and their ranges.
SPACE = {
    "step_size": Range(0.05, 0.6),
    "max_depth": Choice((1, 2, 3)),
    "min_instances": Choice((1, 2, 5, 10)),
    "l2": Range(0.01, 30.0),
}
#: Settings that start, rounds at the end of each rung, and the share that goes on to the next.
TRIALS, RUNGS, KEPT = 100, (1, 2, 4, 8), 1 / 3
#: Gains are compared in these shares of the spread of the label, so that equal ones tie.
GAIN_DIGITS = 9


@dataclasses.dataclass
class Trial:
    """Settings with the trees grown so far; a tree is a heap of nodes."""

    number: int
    step_size: float
    max_depth: int
    min_instances: int
    l2: float
    trees: list[dict[str, list]] = dataclasses.field(default_factory=list)


@dataclasses.dataclass(frozen=True)
class Binned:
    """Rows with split, label and bins, and what they are binned by."""

    rows: DataFrame
    inputs: tuple[str, ...]
    base: float  # mean label of the training rows
    spread: float  # sum of squares around it


def _scale(x: Column) -> Column:
    return F.signum(x) * F.ln(1 + F.abs(x))


def binned(labelled: DataFrame, inputs: list[str], label: str, bins: int = BINS) -> Binned:
    """Bin the inputs by the training rows; a row with a null input or label is left out."""
    known = labelled.dropna(subset=[*inputs, label]).select(
        "split", F.col(label).cast("double").alias("label"), *(F.col(c).cast("double").alias(c) for c in inputs)
    )
    scaled = known.select("split", "label", *(_scale(F.col(c)).alias(c) for c in inputs))
    train = scaled.where("split = 'train'")
    bounds = [f(c).alias(f"{k}_{c}") for c in inputs for k, f in (("low", F.min), ("high", F.max))]
    head = train.agg(F.avg("label").alias("base"), F.var_pop("label").alias("spread"), F.count("*").alias("n"), *bounds).first()
    if not head["n"]:
        raise ValueError("no training rows")

    def bin_of(c: str) -> Column:
        low, high = head[f"low_{c}"], head[f"high_{c}"]
        if not high > low:
            return F.lit(0)
        place = F.floor((F.col(c) - F.lit(low)) / F.lit(high - low) * bins)
        return F.greatest(F.lit(0), F.least(F.lit(bins - 1), place)).cast("int")

    rows = scaled.select("split", "label", F.array(*(bin_of(c) for c in inputs)).alias("bins"))
    return Binned(settle(rows), tuple(inputs), head["base"], head["spread"] * head["n"])


def _leaf(tree: Mapping[str, list], bins: np.ndarray) -> np.ndarray:
    """The node of a tree where each row ends."""
    feature, cut = np.array(tree["feature"]), np.array(tree["cut"])
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    while True:
        at = feature[node]
        inner = at >= 0
        if not inner.any():
            return node
        right = bins[rows, np.where(inner, at, 0)] > cut[node]
        node = np.where(inner, 2 * node + 1 + right, node)


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    bins = np.asarray(batch.column("bins").flatten()).reshape(batch.num_rows, -1)
    return np.asarray(batch.column("label")), bins


def _predicted(trial: Trial, trees: list[Mapping], base: float, bins: np.ndarray) -> np.ndarray:
    value = np.full(len(bins), base)
    for tree in trees:
        value += trial.step_size * np.array(tree["value"])[_leaf(tree, bins)]
    return value


def _histograms(data: Binned, trials: list[Trial]) -> DataFrame:
    """trial, node, feature, bin, rows and residual of the last, unfinished tree of each trial."""
    base, names = data.base, ["trial", "node", "feature", "bin", "n", "total"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, bins = _arrays(batch)
            width = int(bins.max(initial=0)) + 1
            for trial in trials:
                *done, current = trial.trees
                rest = label - _predicted(trial, done, base, bins)
                node = _leaf(current, bins)
                open_ = np.array(current["open"])[node]
                where, rest, kept = node[open_], rest[open_], bins[open_]
                for feature in range(bins.shape[1]):
                    cell = where * width + kept[:, feature]
                    n, total = np.bincount(cell), np.bincount(cell, rest)
                    there = np.flatnonzero(n)
                    if not len(there):
                        continue
                    columns = [np.full(len(there), trial.number), there // width, np.full(len(there), feature)]
                    columns += [there % width, n[there], total[there]]
                    yield pa.record_batch([pa.array(c) for c in columns], names=names)

    ddl = "trial long, node long, feature long, bin long, n long, total double"
    partial = data.rows.where("split = 'train'").mapInArrow(run, ddl)
    return partial.groupBy("trial", "node", "feature", "bin").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def best_splits(data: Binned, trials: list[Trial]) -> DataFrame:
    """Of every open node: its rows and residual, and the split that gains most, if one does."""
    spark = data.rows.sparkSession
    settings = [(t.number, float(t.l2), t.min_instances) for t in trials]
    known = spark.createDataFrame(settings, "trial long, l2 double, least long")
    cells = _histograms(data, trials).join(known, "trial")
    whole = Window.partitionBy("trial", "node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = cells.withColumns(
        {
            "left_n": F.sum("n").over(upto),
            "left_total": F.sum("total").over(upto),
            "all_n": F.sum("n").over(whole),
            "all_total": F.sum("total").over(whole),
        }
    ).withColumns({"right_n": F.col("all_n") - F.col("left_n"), "right_total": F.col("all_total") - F.col("left_total")})

    def worth(side: str) -> Column:
        return F.col(f"{side}_total") * F.col(f"{side}_total") / (F.col(f"{side}_n") + F.col("l2"))

    gain = F.round((worth("left") + worth("right") - worth("all")) / max(data.spread, 1e-300), GAIN_DIGITS)
    fits = (F.col("left_n") >= F.col("least")) & (F.col("right_n") >= F.col("least")) & (F.col("right_n") > 0)
    split = F.struct(
        gain.alias("gain"),
        (-F.col("feature")).alias("before"),
        (-F.col("bin")).alias("lower"),
        *("feature", "bin", "left_n", "left_total", "right_n", "right_total"),
    )
    return sums.groupBy("trial", "node").agg(
        F.max("all_n").alias("n"),
        F.max_by("all_total", "feature").alias("total"),
        F.max(F.when(fits & (gain > 0), split)).alias("best"),
    )


def _new_tree(depth: int) -> dict[str, list]:
    size = (2 << depth) - 1
    tree = {"feature": [-1] * size, "cut": [0] * size, "value": [0.0] * size, "open": [False] * size}
    tree["open"][0] = True
    return tree


def grow(data: Binned, trials: list[Trial], rounds: int) -> None:
    """Add trees to every trial until it has ``rounds`` of them."""
    while waiting := [t for t in trials if len(t.trees) < rounds]:
        for trial in waiting:
            trial.trees.append(_new_tree(trial.max_depth))
        by_number = {t.number: t for t in waiting}
        for level in range(max(t.max_depth for t in waiting)):
            some = [t for t in waiting if level < t.max_depth and any(t.trees[-1]["open"])]
            if not some:
                break
            for row in best_splits(data, some).collect():
                trial, node, best = by_number[row["trial"]], row["node"], row["best"]
                tree = trial.trees[-1]
                tree["open"][node] = False
                tree["value"][node] = row["total"] / (row["n"] + trial.l2)
                if best is None:
                    continue
                tree["feature"][node], tree["cut"][node] = best["feature"], best["bin"]
                for child, side in ((2 * node + 1, "left"), (2 * node + 2, "right")):
                    tree["value"][child] = best[f"{side}_total"] / (best[f"{side}_n"] + trial.l2)
                    tree["open"][child] = level + 1 < trial.max_depth
        for trial in waiting:
            del trial.trees[-1]["open"]


def curve(data: Binned, trials: list[Trial]) -> DataFrame:
    """trial, split, round, n, rmse and mae after every round from 0, from one pass over the rows."""
    base, names = data.base, ["split", "trial", "round", "n", "squares", "sizes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, bins = _arrays(batch)
            split = np.array(batch.column("split").to_pylist(), object)
            for trial in trials:
                value, found = np.full(len(label), base), []
                for done in range(len(trial.trees) + 1):
                    if done:
                        tree = trial.trees[done - 1]
                        value = value + trial.step_size * np.array(tree["value"])[_leaf(tree, bins)]
                    for name in set(split):
                        rest = (label - value)[split == name]
                        found.append((name, trial.number, done, len(rest), float(rest @ rest), float(np.abs(rest).sum())))
                yield pa.record_batch([pa.array(c) for c in zip(*found)], names=names)

    ddl = "split string, trial long, round long, n long, squares double, sizes double"
    sums = data.rows.mapInArrow(run, ddl).groupBy("trial", "split", "round")
    return sums.agg(
        F.sum("n").alias("n"),
        F.sqrt(F.sum("squares") / F.sum("n")).alias("rmse"),
        (F.sum("sizes") / F.sum("n")).alias("mae"),
    )


def draw(count: int, seed: int = 42, space: Mapping[str, Range | Choice] = SPACE) -> list[Trial]:
    """Settings of a search, the same for the same seed."""
    rng = random.Random(seed)
    return [Trial(i, **{name: dim.draw(rng) for name, dim in space.items()}) for i in range(count)]


def halving(
    data: Binned,
    trials: list[Trial],
    rungs: tuple[int, ...] = RUNGS,
    kept: float = KEPT,
    metric: str = "rmse",
) -> tuple[Trial, DataFrame]:
    """The best trial and a table of rungs, by the error on the evaluation split.

    At each rung all trials that are left are grown on, from the trees they have, to its number of
    rounds; a share of them goes on to the next.
    """
    if data.rows.where("split = 'eval'").isEmpty():
        raise ValueError("no rows in the evaluation split to choose by")
    left, table = list(trials), []
    for rung, rounds in enumerate(rungs):
        grow(data, left, rounds)
        scored = curve(data, left).where((F.col("split") == "eval") & (F.col("round") == rounds)).collect()
        errors = {r["trial"]: r[metric] for r in scored}
        place = sorted(left, key=lambda t: (errors[t.number], t.number))
        stays = max(1, int(len(left) * kept)) if rung + 1 < len(rungs) else 1
        for rank, trial in enumerate(place):
            table.append((rung, rounds, trial.number, errors[trial.number], rank, rank < stays))
        left = place[:stays]
    ddl = "rung int, rounds int, trial int, error double, place int, stays boolean"
    return left[0], data.rows.sparkSession.createDataFrame(table, ddl)


def stopped_early(data: Binned, trial: Trial, metric: str = "rmse") -> Trial:
    """The trial with the trees up to its best round on the evaluation split."""
    rows = curve(data, [trial]).where("split = 'eval'").collect()
    best = min(rows, key=lambda r: (r[metric], r["round"]))["round"]
    return dataclasses.replace(trial, trees=trial.trees[:best])


def predict(data: Binned, trial: Trial) -> DataFrame:
    """The rows with ``predicted``."""
    base = data.base

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, bins = _arrays(batch)
            value = pa.array(_predicted(trial, trial.trees, base, bins))
            yield pa.record_batch([batch.column("split"), batch.column("label"), value], names=["split", "label", "predicted"])

    return data.rows.select("split", "label", "bins").mapInArrow(run, "split string, label double, predicted double")


# Continuing a fit


def save_round(spark: SparkSession, folder: str, trials: list[Trial]) -> None:
    """Write the state after a round; it counts once its mark is there."""
    path = version_path(folder, len(trials[0].trees))
    rows = [(t.number, json.dumps(dataclasses.asdict(t))) for t in trials]
    spark.createDataFrame(rows, "trial int, state string").coalesce(1).write.mode("overwrite").parquet(path)
    mark_complete(spark, path)


def load_round(spark: SparkSession, folder: str) -> list[Trial] | None:
    """The trials of the last whole round of a folder; None if there is none."""
    version = latest_version(spark, folder).first()[0]
    if version is None:
        return None
    rows = spark.read.parquet(version_path(folder, version)).orderBy("trial").collect()
    return [Trial(**json.loads(r["state"])) for r in rows]


def grow_saved(data: Binned, trials: list[Trial], rounds: int, folder: str) -> list[Trial]:
    """Grow to ``rounds``, from the last round that ``folder`` has, writing each round to it.

    A fit that was ended goes on where it was, and ends as if it had not been.
    """
    spark = data.rows.sparkSession
    trials = load_round(spark, folder) or trials
    for done in range(len(trials[0].trees) + 1, rounds + 1):
        grow(data, trials, done)
        save_round(spark, folder, trials)
    return trials
