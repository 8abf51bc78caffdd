import math
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from custvalue import ClvParams
from custvalue.functions import special
from custvalue.operators import btyd
from custvalue.plans import fit

def customer():
    return [F.col(name) for name in btyd.CUSTOMER_COLUMNS]



def table(spark, rows, columns):
    return spark.createDataFrame(pd.DataFrame(rows, columns=columns))


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_lgamma(spark):
    xs = [0.01, 0.5, 1.0, 2.0, 3.7, 120.25, 1e6]
    got = values(table(spark, [(x,) for x in xs], ["x"]), special.lgamma(F.col("x")))
    assert got == pytest.approx([math.lgamma(x) for x in xs], rel=1e-12, abs=1e-11)


def test_log_sums(spark):
    df = table(spark, [(-800.0, 2.0), (900.0, 899.0), (-1e9, -1e9)], ["a", "b"])
    want = [2.0, 900 + math.log1p(math.exp(-1)), -1e9 + math.log(2)]
    assert values(df, special.log_add_exp(F.col("a"), F.col("b"))) == pytest.approx(want)
    assert values(df, special.log1p_exp(F.col("a"))) == pytest.approx([0.0, 900.0, 0.0])


def test_derivatives_of_lgamma(spark):
    xs = [0.01, 0.5, 1.0, 2.0, 3.7, 120.25, 1e6]
    df = table(spark, [(x,) for x in xs], ["x"])
    first, second = values(df, special.digamma(F.col("x"))), values(df, special.trigamma(F.col("x")))
    for x, f, s in zip(xs, first, second):
        assert (f, s) == pytest.approx(special.polygamma_numbers(x), rel=1e-10)
    array = np.array(xs)
    assert special.digamma(array, np.log).tolist() == pytest.approx(first, rel=1e-13)
    assert special.trigamma(array).tolist() == pytest.approx(second, rel=1e-13)
    assert special.lgamma(array, np.log).tolist() == pytest.approx([math.lgamma(x) for x in xs], rel=1e-12, abs=1e-11)
    assert special.polygamma_numbers(1.0) == pytest.approx((-0.5772156649015329, math.pi**2 / 6), rel=1e-12)


def test_dropout_integral_closed_forms(spark):
    # With equal alpha and beta the integrand is a power; with p = 0 it is one of beta alone.
    cases = [(2.0, 3.0, 1.5, 3.0, 0.0, 9.0), (0.0, 5.0, 1.7, 2.0, 1.0, 40.0), (0.0, 1.0, 2.5, 1e-9, 0.0, 10.0)]
    cases += [(400.0, 20.0, 1.5, 20.0, 3.0, 300.0), (1.2, 1e-7, 1.0, 1e-7, 0.0, 1e4), (1.0, 1.0, 1.0, 1.0, 5.0, 5.0)]
    df = table(spark, cases, ["p", "alpha", "q", "beta", "tx", "T"]).coalesce(1)
    columns = [F.col(c) for c in df.columns]
    got = values(df, special.dropout_integral(*columns))
    for (p, _, q, beta, tx, T), log in zip(cases[:-1], got):
        power = p + q - 1
        scaled = -math.expm1(-power * math.log((beta + T) / (beta + tx))) / power
        assert log == pytest.approx(math.log(scaled) - power * math.log(beta + tx), abs=1e-9)
    assert got[-1] == -math.inf
    moments = special.dropout_kernel(True)(*np.array(cases).T)
    assert moments[:, 0].tolist() == got


def test_dropout_integral_has_bounded_work(spark):
    """alpha and beta far apart, recency 0: where a series would have millions of terms."""
    rows = [(3.0, 1.0, 1.7, 10.0 ** -(12 * i / 10_000), 0.0, 50.0) for i in range(10_000)]
    df = table(spark, rows, ["p", "alpha", "q", "beta", "tx", "T"]).coalesce(1).cache()
    df.count()
    column = special.dropout_integral(*[F.col(c) for c in df.columns])
    df.limit(10).agg(F.sum(column)).collect()  # starts the worker
    start = time.perf_counter()
    assert math.isfinite(df.agg(F.sum(column)).first()[0])
    assert time.perf_counter() - start < 5


@pytest.mark.parametrize(
    "kind,point",
    [
        (btyd.BgNbd, {"r": 0.9, "alpha": 1.3, "a": 0.7, "b": 2.1}),
        (btyd.ParetoNbd, {"r": 0.9, "alpha": 1.3, "s": 0.7, "beta": 2.1}),
        (btyd.ParetoNbd, {"r": 0.9, "alpha": 3.3, "s": 0.7, "beta": 1.1}),
        (btyd.GammaGamma, {"p": 2.0, "q": 3.0, "v": 1.5}),
    ],
)
def test_gradient_and_curvature_against_differences(spark, kind, point):
    timed = [(0.0, 0.0, 3.0, 1), (2.0, 2.0, 3.0, 4), (7.0, 5.0, 9.0, 1), (3.0, 9.0, 9.0, 2), (40.0, 8.0, 10.0, 1)]
    money = [(2.0, 1.3, 1), (5.0, 0.4, 3), (1.0, 7.0, 1)]
    rows = money if kind is btyd.GammaGamma else timed
    inputs = table(spark, rows, [*kind.inputs, "n"]).coalesce(1)
    step, points = 1e-4, [point]
    for name in point:
        points += [point | {name: point[name] + s} for s in (step, -step)]
    here, *near = fit.Objective(inputs, kind)(points)
    model, columns = kind(**point), [F.col(c) for c in kind.inputs]
    terms = inputs.select("n", model.log_likelihood(model.point(), *columns).alias("value"))
    assert here.value == pytest.approx(terms.agg(F.sum(F.col("n") * F.col("value")) / F.sum("n")).first()[0], rel=1e-12)
    assert here.gradient == pytest.approx([(u.value - d.value) / (2 * step) for u, d in zip(near[::2], near[1::2])], abs=1e-6)
    for row, u, d in zip(here.curvature, near[::2], near[1::2]):
        assert row == pytest.approx((u.gradient - d.gradient) / (2 * step), abs=1e-6)


def pareto_likelihood(r, alpha, s, beta, x, tx, T):
    """By direct integration over the moment of leaving."""
    edges = np.linspace(tx, T, 200_001)
    u = (edges[1:] + edges[:-1]) / 2
    left = np.sum((alpha + u) ** -(r + x) * (beta + u) ** -(s + 1)) * (T - tx) / len(u)
    alive = (alpha + T) ** -(r + x) * (beta + T) ** -s
    front = math.exp(math.lgamma(r + x) - math.lgamma(r)) * alpha**r * beta**s
    return front * (alive + s * left), alive / (alive + s * left)


@pytest.mark.parametrize("alpha,beta", [(10.0, 12.0), (12.0, 10.0), (10.0, 10.0), (1.0, 60.0), (60.0, 1.0)])
def test_pareto_against_integration(spark, alpha, beta):
    cases = [(0, 0.0, 30.0), (2, 20.0, 30.0), (7, 5.0, 40.0), (3, 40.0, 40.0)]
    model = btyd.ParetoNbd(r=0.6, alpha=alpha, s=0.7, beta=beta)
    df = table(spark, cases, list(btyd.CUSTOMER_COLUMNS)).coalesce(1)
    logs = values(df, model.log_likelihood(model.point(), *customer()))
    alive = values(df, model.p_alive(*customer()))
    for case, log, p in zip(cases, logs, alive):
        want, want_p = pareto_likelihood(0.6, alpha, 0.7, beta, *case)
        assert log == pytest.approx(math.log(want), abs=1e-6)
        assert p == pytest.approx(want_p, rel=1e-6)


def test_bgnbd_likelihood_by_hand(spark):
    r, alpha, a, b = 0.9, 8.0, 1.3, 2.1
    model = btyd.BgNbd(r, alpha, a, b)
    df = table(spark, [(0, 0.0, 30.0), (3, 12.0, 30.0)], list(btyd.CUSTOMER_COLUMNS)).coalesce(1)
    got = values(df, model.log_likelihood(model.point(), *customer()))
    beta = lambda p, q: math.exp(math.lgamma(p) + math.lgamma(q) - math.lgamma(p + q))
    none = (alpha / (alpha + 30)) ** r
    front = math.gamma(r + 3) / math.gamma(r) * alpha**r
    some = front * (
        beta(a, b + 3) / beta(a, b) * (alpha + 30) ** -(r + 3)
        + beta(a + 1, b + 2) / beta(a, b) * (alpha + 12) ** -(r + 3)
    )
    assert got == pytest.approx([math.log(none), math.log(some)], rel=1e-10)


@pytest.mark.parametrize(
    "model",
    [btyd.BgNbd(0.9, 30.0, 0.7, 2.1), btyd.BgNbd(0.9, 30.0, 1.6, 2.1), btyd.ParetoNbd(0.9, 30.0, 0.6, 45.0),
     btyd.BgNbd(0.9, 30.0, 1.0, 2.1), btyd.ParetoNbd(0.9, 30.0, 1.0, 45.0)],
)
def test_expectation_grows_and_probability_is_one_at_most(spark, model):
    rows = [(0, 0, 90), (1, 30, 90), (12, 85, 90), (300, 20, 400), (600, 400, 400)]
    df = table(spark, rows, list(btyd.CUSTOMER_COLUMNS)).coalesce(1)
    curve = [values(df, model.expected_purchases(t, *customer())) for t in (0, 1, 30, 300, 3000)]
    assert curve[0] == [0.0] * len(rows)
    for before, after in zip(curve, curve[1:]):
        assert all(a >= b for a, b in zip(after, before))
    assert all(0 <= p <= 1 for p in values(df, model.p_alive(*customer())))


def test_lifetime_value_is_the_discounted_sum(spark):
    model, money = btyd.BgNbd(0.9, 30.0, 0.7, 2.1), btyd.GammaGamma(2.0, 4.0, 50.0)
    df = table(spark, [(4, 60.0, 90.0, 25.0)], [*btyd.CUSTOMER_COLUMNS, "monetary_value"])
    at = [values(df, model.expected_purchases(30 * k, *customer()))[0] for k in range(5)]
    profit = 2.0 * (50 + 4 * 25) / (2.0 * 4 + 4 - 1)
    want = sum(profit * (at[k] - at[k - 1]) / 1.01**k for k in range(1, 5))
    got = values(df, btyd.customer_lifetime_value(model, money, 4, 0.01))[0]
    assert got == pytest.approx(want, rel=1e-12)


def simulate_bgnbd(size, r, alpha, a, b, seed=7):
    rng = np.random.default_rng(seed)
    age = rng.uniform(100, 400, size)
    rate, drop = rng.gamma(r, 1 / alpha, size), rng.beta(a, b, size)
    rows = []
    for T, lam, p in zip(age, rate, drop):
        x, t, last = 0, 0.0, 0.0
        while True:
            t += rng.exponential(1 / lam)
            if t > T:
                break
            x, last = x + 1, t
            if rng.random() < p:
                break
        rows.append((x, round(last), round(T)))
    return rows


def simulate_pareto(size, r, alpha, s, beta, seed=7):
    rng = np.random.default_rng(seed)
    age = rng.uniform(100, 400, size)
    rate, leave = rng.gamma(r, 1 / alpha, size), rng.gamma(s, 1 / beta, size)
    rows = []
    for T, lam, mu in zip(age, rate, leave):
        end = min(T, rng.exponential(1 / mu))
        times = np.sort(rng.uniform(0, end, rng.poisson(lam * end)))
        rows.append((len(times), round(times[-1]) if len(times) else 0, round(T)))
    return rows


FREE = ClvParams("2000-06-30", "2001-08-01", 1.0, penalizer=0.0)


@pytest.mark.parametrize(
    "simulate,fitter,truth",
    [
        (simulate_bgnbd, fit.fit_bgnbd, btyd.BgNbd(0.8, 25.0, 0.8, 2.5)),
        (simulate_pareto, fit.fit_paretonbd, btyd.ParetoNbd(0.8, 25.0, 0.6, 60.0)),
    ],
)
def test_fit_recovers_parameters(spark, simulate, fitter, truth):
    rows = simulate(6000, *truth.values().values())
    df = table(spark, rows, list(btyd.CUSTOMER_COLUMNS))
    model, value, status, gradient, *_ = fitter(df, FREE)
    assert status == "converged" and gradient < 1e-2
    for name, known in truth.values().items():
        assert model.values()[name] == pytest.approx(known, rel=0.35), (model, truth)
    # No worse than the truth and than its own neighbours on the same objective.
    inputs = fit.compress(df, truth.inputs)
    scale = fit.OLDEST / df.agg(F.max("T")).first()[0]
    near = [model.values() | {k: v * f} for k, v in model.values().items() for f in (0.97, 1.03)]
    means = fit.Objective(inputs, type(truth))([model.values(), truth.values(), *near])
    assert all(means[0].value >= other.value for other in means[1:])
    assert scale > 0 and math.isfinite(value)


def test_gamma_gamma_recovers_parameters(spark):
    rng = np.random.default_rng(3)
    p, q, v = 6.0, 4.0, 15.0
    x = rng.integers(1, 20, 6000)
    nu = rng.gamma(q, 1 / v, len(x))
    m = rng.gamma(p * x, 1 / (nu * x))
    df = table(spark, list(zip(x.tolist(), m.tolist())), ["frequency", "monetary_value"])
    model = fit.fit_gamma_gamma(df).model
    assert model.p == pytest.approx(p, rel=0.1)
    assert model.q == pytest.approx(q, rel=0.1)
    assert model.v == pytest.approx(v, rel=0.15)
    profit = model.expected_profit(F.col("frequency"), F.col("monetary_value"))
    assert np.mean(values(df, profit)) == pytest.approx(np.mean(p / nu), rel=0.05)


def test_unknown_inputs_are_left_out(spark):
    rows = [(2.0, 2.0, 3.0, 4), (0.0, 0.0, 3.0, 1)]
    columns = "frequency double, recency double, T double, n int"
    whole = spark.createDataFrame(rows, columns)
    more = spark.createDataFrame([*rows, (None, 1.0, 3.0, 1), (1.0, 1.0, None, 2)], columns)
    point = {"r": 0.9, "alpha": 1.3, "a": 0.7, "b": 2.1}
    means = [fit.Objective(df, btyd.BgNbd)([point])[0].value for df in (whole, more)]
    assert means[0] == pytest.approx(means[1], rel=1e-14)


def test_penalty_shrinks(spark):
    df = table(spark, simulate_bgnbd(1500, 0.8, 25.0, 0.8, 2.5), list(btyd.CUSTOMER_COLUMNS))
    free = fit.fit_bgnbd(df, FREE).model
    bound = fit.fit_bgnbd(df, ClvParams("2000-06-30", "2001-08-01", 1.0, penalizer=0.1)).model
    norm = lambda m: m.r**2 + m.a**2 + m.b**2
    assert norm(bound) < norm(free)


def test_compression_keeps_every_customer(spark):
    rows = [(1, 5, 9)] * 400 + [(2, 5, 9)] * 3
    packed = fit.compress(table(spark, rows, list(btyd.CUSTOMER_COLUMNS)), btyd.CUSTOMER_COLUMNS)
    assert sorted(r.n for r in packed.collect()) == [3, 400]


def test_fit_needs_rows(spark):
    empty = spark.createDataFrame([], "frequency bigint, recency bigint, T bigint, monetary_value double")
    with pytest.raises(ValueError):
        fit.fit_bgnbd(empty, FREE)
    with pytest.raises(ValueError):
        fit.fit_gamma_gamma(empty)


@pytest.mark.parametrize("name,kind", [("a", btyd.BgNbd), ("s", btyd.ParetoNbd)])
def test_expectation_is_continuous_at_one(spark, name, kind):
    df = table(spark, [(4, 60.0, 90.0)], list(btyd.CUSTOMER_COLUMNS))
    fields = [f for f in kind.__annotations__ if f in ("r", "alpha", "a", "b", "s", "beta")]
    base = dict(zip(fields, (0.9, 30.0, 1.0, 20.0)))
    got = [
        values(df, kind(**(base | {name: v})).expected_purchases(200, *customer()))[0]
        for v in (0.999, 1.0, 1.001)
    ]
    assert got[1] == pytest.approx((got[0] + got[2]) / 2, rel=1e-4)
