import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from custvalue.functions.scratch import scratch_path
from custvalue.operators import moments
from custvalue.plans import ridge
from custvalue.sources import schemas

INPUTS = ["a", "b", "c", "still"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(5, 2, 400), rng.normal(0, 30, 400)
    c = a * 3 + rng.normal(0, 0.2, 400)  # nearly the same as a
    y = 100 + 4 * a - 0.5 * b + 2 * c + rng.normal(0, 5, 400)
    split = np.where(np.arange(400) % 4 == 3, "eval", "train")
    data = [(*map(float, r), 7, str(s)) for *r, s in zip(a, b, c, y, split)] + [(None, 1.0, 1.0, 1.0, 7, "train")]
    frame = spark.createDataFrame(data, "a double, b double, c double, y double, still int, split string")
    return frame.cache()


@pytest.fixture(scope="module")
def found(rows):
    return ridge.products(moments.moments(rows, INPUTS, "y"), INPUTS, "y")


def test_least_squares_is_that_of_numpy(rows, found):
    data = np.array([r[:4] for r in rows.where("split = 'train' and a is not null").collect()], float)
    design = np.column_stack([np.ones(len(data)), data[:, :3]])
    want, *_ = np.linalg.lstsq(design, data[:, 3], rcond=None)
    (model,) = found["train"].ridge([0.0])
    assert [model.intercept, *model.coefficients[:3]] == pytest.approx(want, rel=1e-6)
    assert model.coefficients[3] == 0  # a constant column
    fitted = design @ want
    assert found["train"].rmse(model) == pytest.approx(math.sqrt(np.mean((data[:, 3] - fitted) ** 2)), rel=1e-6)


@pytest.mark.parametrize("l1,l2", [(0.0, 0.3), (0.2, 0.0), (0.1, 0.05)])
def test_penalties_mean_what_mllib_means(rows, found, l1, l2):
    """MLlib halves the squared error and the l2 term, and takes penalties by the unit of the label."""
    train = rows.where("split = 'train'").dropna()
    spread = train.agg(F.stddev("y")).first()[0]
    both = l2 + l1 / 2
    library = LinearRegression(
        labelCol="y", regParam=both * spread, elasticNetParam=l1 / 2 / both, maxIter=2000, tol=1e-14, solver="l-bfgs"
    ).fit(VectorAssembler(inputCols=INPUTS[:3], outputCol="features").transform(train))
    model = found["train"].elastic_net(l1, l2)
    assert model.coefficients[:3] == pytest.approx(library.coefficients.toArray(), rel=0.01, abs=0.02)
    if not l1:
        (same,) = found["train"].ridge([l2])
        assert same.coefficients == pytest.approx(model.coefficients, rel=1e-8)


def test_state_takes_batches_and_replaces_them(spark, rows, found):
    path = scratch_path(spark, "state")
    halves = [rows.where("b < 0"), rows.where("b >= 0 or b is null")]
    for batch, part in zip("xyx", [rows, halves[1], halves[0]]):
        moments.add_batch(moments.moments(part, INPUTS, "y"), path, batch)
    again = ridge.products(moments.read_state(spark, path), INPUTS, "y")
    for split in ("train", "eval"):
        assert again[split].matrix == pytest.approx(found[split].matrix, rel=1e-9)


def test_a_search_reads_no_rows_and_its_trials_differ(spark, feature_rows, params):
    from custvalue.operators import split

    labelled = split.with_split(feature_rows, params)
    inputs = schemas.used_columns()
    found = ridge.products(moments.moments(labelled, inputs, schemas.TARGET), inputs, schemas.TARGET)
    best, trials = ridge.search(spark, found)
    rows = trials.collect()
    assert len(rows) == 1000 and len({r["l2"] for r in rows}) == 1000
    errors = [r["rmse"] for r in rows]
    assert max(errors) > 1.01 * min(errors)
    assert found["eval"].rmse(best) == min(errors)
    assert [r["l2"] for r in rows[:50]] == ridge.penalties(50)
    with pytest.raises(ValueError, match="no rows"):
        ridge.search(spark, {"train": found["train"]})


def test_no_rows(spark, rows):
    assert ridge.products(moments.moments(rows.limit(0), INPUTS, "y"), INPUTS, "y") == {}


@pytest.mark.parametrize("l1,l2", [(1e-6, 0.05), (0.1, 0.05), (0.4, 0.2)])
def test_steps_end_at_the_closed_form(rows, found, l1, l2):
    want = found["train"].elastic_net(l1, l2)
    got = ridge.proximal(found["train"], [found["train"]], l1, l2, steps=20_000)
    assert got.effects == pytest.approx(want.effects, abs=1e-3 * found["train"].spread[-1])
    assert [e == 0 for e in got.effects] == [e == 0 for e in want.effects]


def test_blocks_of_rows_and_a_falling_rate(rows, found):
    """Steps over blocks come as near as the rate has fallen."""
    blocked = rows.where("split = 'train'").withColumn("block", F.pmod(F.xxhash64("b"), F.lit(4)).cast("string"))
    blocks = ridge.products(moments.moments(blocked, INPUTS, "y", by="block"), INPUTS, "y", by="block")
    assert sum(b.count for b in blocks.values()) == found["train"].count
    summed = sum(b.around(found["train"]) * b.count for b in blocks.values()) / found["train"].count
    assert summed == pytest.approx(found["train"].correlation, abs=1e-9)
    want = found["train"].elastic_net(0.01, 0.1).effects
    away = [
        np.abs(ridge.proximal(found["train"], list(blocks.values()), 0.01, 0.1, decay_rate=d, steps=4000).effects - want).max()
        for d in (1.0, 0.9)
    ]
    assert away[1] < away[0] and away[1] < 0.02 * found["train"].spread[-1]


def test_a_search_over_steps_and_their_decay(spark, found):
    train = found["train"]
    best, trials = ridge.step_search(spark, train, [train], found["eval"], trials=30)
    table = trials.collect()
    assert len({r["decay_rate"] for r in table}) == 30 and all(0.5 <= r["decay_rate"] <= 1 for r in table)
    assert found["eval"].rmse(best) == min(r["rmse"] for r in table)
