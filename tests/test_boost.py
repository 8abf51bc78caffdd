import numpy as np
import pytest
from pyspark.sql import functions as F

from custvalue.functions.scratch import scratch_path
from custvalue.operators import choose
from custvalue.plans import boost, models
from custvalue.sources import schemas

INPUTS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    a, b, c = rng.normal(0, 20, 900), rng.integers(0, 9, 900).astype(float), rng.exponential(50, 900)
    y = 30 * (a > 5) + 4 * b - 20 * ((c > 40) & (b > 4)) + rng.normal(0, 3, 900)
    split = np.where(np.arange(900) % 3 == 2, "eval", "train")
    data = [(*map(float, r), str(s)) for *r, s in zip(a, b, c, y, split)] + [(None, 1.0, 1.0, 5.0, "train")]
    return spark.createDataFrame(data, "a double, b double, c double, y double, split string").repartition(3).cache()


@pytest.fixture(scope="module")
def data(rows):
    return boost.binned(rows, INPUTS, "y")


def slow_tree(bins, rest, depth, least, l2, spread):
    """value of each row after one tree, by trying every split of every node."""
    total, n = rest.sum(), len(rest)
    value = np.full(n, total / (n + l2))
    best = None
    for f in range(bins.shape[1]):
        for cut in range(int(bins.max()) + 1):
            left = bins[:, f] <= cut
            if left.sum() < least or (~left).sum() < max(least, 1):
                continue
            worth = [rest[s].sum() ** 2 / (s.sum() + l2) for s in (left, ~left)]
            gain = round((sum(worth) - total**2 / (n + l2)) / spread, boost.GAIN_DIGITS)
            if gain > 0 and (best is None or gain > best[0]):
                best = (gain, left)
    if depth and best:
        for side in (best[1], ~best[1]):
            value[side] = slow_tree(bins[side], rest[side], depth - 1, least, l2, spread)
    return value


def test_trees_are_those_of_a_plain_search(data):
    trials = [boost.Trial(3, 0.5, 2, 5, 1.0), boost.Trial(8, 0.2, 3, 30, 0.1), boost.Trial(9, 1.0, 1, 500, 1.0)]
    boost.grow(data, trials, 3)
    train = data.rows.where("split = 'train'").collect()
    bins, label = np.array([r["bins"] for r in train]), np.array([r["label"] for r in train])
    for trial in trials:
        value = np.full(len(label), data.base)
        for _ in range(3):
            value += trial.step_size * slow_tree(bins, label - value, trial.max_depth, trial.min_instances, trial.l2, data.spread)
        got = {(tuple(r["bins"]), r["label"]): v for r, v in zip(train, boost._predicted(trial, trial.trees, data.base, bins))}
        assert [got[tuple(b), y] for b, y in zip(bins.tolist(), label.tolist())] == pytest.approx(value.tolist(), rel=1e-9)


def test_curve_is_the_error_of_the_predictions_and_falls(data):
    trial = boost.Trial(0, 0.3, 2, 5, 1.0)
    boost.grow(data, [trial], 6)
    found = {(r["split"], r["round"]): r for r in boost.curve(data, [trial]).collect()}
    assert len(found) == 14
    errors = [found["train", i]["rmse"] for i in range(7)]
    assert all(a > b for a, b in zip(errors, errors[1:]))
    rest = F.col("label") - F.col("predicted")
    for row in boost.predict(data, trial).groupBy("split").agg(F.sqrt(F.avg(rest * rest)).alias("rmse"), F.avg(F.abs(rest)).alias("mae")).collect():
        last = found[row["split"], 6]
        assert (last["rmse"], last["mae"]) == pytest.approx((row["rmse"], row["mae"]), rel=1e-9)


def test_a_fit_stops_at_its_best_round(data):
    trial = boost.Trial(0, 2.5, 3, 1, 0.0)  # steps that are too long
    boost.grow(data, [trial], 6)
    errors = {r["round"]: r["rmse"] for r in boost.curve(data, [trial]).where("split = 'eval'").collect()}
    stopped = boost.stopped_early(data, trial)
    assert errors[len(stopped.trees)] == min(errors.values()) and len(stopped.trees) < 6
    assert len(trial.trees) == 6


def test_halving_grows_on_and_its_settings_differ(data):
    trials = boost.draw(18, seed=3)
    best, table = boost.halving(data, trials, rungs=(1, 2, 5), kept=0.34)
    rows = table.orderBy("rung", "place").collect()
    assert [sum(r["rung"] == i for r in rows) for i in range(3)] == [18, 6, 2]
    assert [sum(r["stays"] for r in rows if r["rung"] == i) for i in range(3)] == [6, 2, 1]
    first = [r["error"] for r in rows if r["rung"] == 0]
    assert first == sorted(first) and first[-1] > 1.05 * first[0]
    assert {r["trial"] for r in rows if r["rung"] == 1} == {r["trial"] for r in rows[:18] if r["stays"]}
    assert best.number == next(r["trial"] for r in rows if r["rung"] == 2 and r["stays"])
    # Warm start: the trees of an early rung are the first of a later one.
    again = boost.Trial(**{k: v for k, v in vars(boost.draw(18, seed=3)[best.number]).items()})
    boost.grow(data, [again], 5)
    assert again.trees == best.trees
    dropped = next(t for t in trials if t.number == rows[17]["trial"])
    assert len(dropped.trees) == 1


def test_a_stopped_fit_ends_at_the_same_trees(spark, data, monkeypatch):
    def start():
        return [boost.Trial(0, 0.3, 2, 5, 1.0), boost.Trial(1, 0.1, 1, 5, 1.0)]

    whole = start()
    boost.grow(data, whole, 5)
    path = scratch_path(spark, "stopped")
    grow = boost.grow

    def killed(data, trials, rounds):
        if rounds == 4:
            raise KeyboardInterrupt
        grow(data, trials, rounds)

    monkeypatch.setattr(boost, "grow", killed)
    with pytest.raises(KeyboardInterrupt):
        boost.grow_saved(data, start(), 5, path)
    monkeypatch.setattr(boost, "grow", grow)
    assert [len(t.trees) for t in boost.load_round(spark, path)] == [3, 3]
    assert boost.grow_saved(data, start(), 5, path) == whole


def test_no_rows_to_choose_by(rows):
    with pytest.raises(ValueError, match="evaluation split"):
        boost.halving(boost.binned(rows.where("split = 'train'"), INPUTS, "y"), boost.draw(2))
    with pytest.raises(ValueError, match="no training rows"):
        boost.binned(rows.limit(0), INPUTS, "y")


def test_choice_of_inputs(spark):
    rng = np.random.default_rng(5)
    signal, noise = rng.normal(0, 10, 3000), rng.normal(0, 10, 3000)
    other = rng.normal(0, 10, 3000)
    rows = [(float(s), float(s), float(n), float(o), 7, float(s + 0.5 * o), None) for s, n, o in zip(signal, noise, other)]
    df = spark.createDataFrame(rows, "signal double, copy double, noise double, other double, still int, y double, none double")
    names = ["signal", "copy", "noise", "other", "still", "none"]
    table = choose.mutual_information(choose.joint_counts(df, [*names, "y"]))
    known = {(r["left"], r["right"]): r["information"] for r in table.collect()}
    assert known["signal", "y"] > known["other", "y"] > known["noise", "y"]
    assert known["still", "y"] == known["none", "y"] == 0
    order = [r[0] for r in choose.ranked(table, names, "y")]
    assert order[0] in ("signal", "copy") and order.index("other") < max(order.index("signal"), order.index("copy"))
    chosen = choose.choose(df, names, "y")
    assert chosen[0] in ("signal", "copy") and "other" in chosen
    assert not {"signal", "copy"} <= set(chosen)


def test_a_fit_uses_the_chosen_columns():
    stages = models.pipeline("gbt_mae", models.FitOptions(columns=("recency", "has_returned"))).getStages()
    inputs = next(s for s in stages if hasattr(s, "getInputCols")).getInputCols()
    assert "recency" in inputs and any(c.startswith("has_returned") for c in inputs)
    assert not any(c in inputs for c in schemas.used_columns() if c not in ("recency", "has_returned"))
