"""Repeat-purchase ("buy till you die") models as Column expressions.

Per customer: ``x`` repeat purchases, ``tx`` age at the last one, ``T`` age at
the end of observation, ``m`` mean value of a repeat purchase.  BG/NBD is Fader,
Hardie and Lee (2005); Pareto/NBD is Schmittlein, Morrison and Colombo (1987) in
Fader and Hardie's notation; Gamma-Gamma is Fader and Hardie (2013).

The log-likelihoods take their parameters as Columns, so one plan can score many
parameter points.  ``constants`` holds what depends on the parameters alone and
is computed once per point.  ``derivatives`` gives the log-likelihood with its gradient
and curvature in closed form, of arrays of customers: as expressions they would take
longer to compile for each point than to evaluate.
"""

from __future__ import annotations

import dataclasses
import functools
import math
import operator
from typing import ClassVar

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custvalue.functions.special import (
    MOMENTS,
    PAIRS,
    digamma,
    dropout_integral,
    dropout_kernel,
    dropout_purchases,
    lgamma,
    log_add_exp,
    polygamma_numbers,
    trigamma,
)
from custvalue.params import ClvParams

DAYS_PER_MONTH = 30
NEAR_ONE = 1e-7
CUSTOMER_COLUMNS = ("frequency", "recency", "T")


def summary(features: DataFrame) -> DataFrame:
    """Model input of each customer."""
    return features.select(
        "customer_id",
        F.col("frequency_btyd").alias("frequency"),
        "recency",
        "T",
        F.col("monetary_btyd").alias("monetary_value"),
    )


def actuals(features: DataFrame) -> DataFrame:
    """What the prediction is compared with."""
    return features.select(
        "customer_id",
        F.col("frequency_btyd").alias("train_frequency"),
        F.col("monetary_dnn").alias("train_monetary"),
        F.col("target_monetary").alias("act_target_monetary"),
    )


def horizon(features: DataFrame, params: ClvParams) -> DataFrame:
    """Model input with the length of the prediction period in days and months."""
    end = F.lit(params.predict_end)
    days = F.datediff(end, F.lit(params.threshold_date))
    return summary(features).select(
        "customer_id",
        "frequency",
        "recency",
        "T",
        days.cast("bigint").alias("time_days"),
        F.ceil(days / DAYS_PER_MONTH).cast("bigint").alias("time_months"),
    )


def _literals(values: dict[str, float]) -> dict[str, Column]:
    return {name: F.lit(value) for name, value in values.items()}


def _if_known(value: Column, *inputs: Column) -> Column:
    """NULL if an input is."""
    known = functools.reduce(operator.and_, [c.isNotNull() for c in inputs])
    return F.when(known, value)


Numbers = np.ndarray | float
Slopes = dict[str, Numbers]
Bends = dict[tuple[str, str], Numbers]


def value_names(names: tuple[str, ...]) -> list[str]:
    """What ``derivatives`` gives, in order: value, gradient, upper triangle of curvature."""
    pairs = [f"bend_{m}_{n}" for i, m in enumerate(names) for n in names[i:]]
    return ["value", *(f"slope_{n}" for n in names), *pairs]


def _listed(names: tuple[str, ...], value: np.ndarray, slopes: Slopes, bends: Bends) -> list[np.ndarray]:
    """Arrays in the order of ``value_names``; a pair that is not there has no curvature."""
    pairs = [(m, n) for i, m in enumerate(names) for n in names[i:]]
    found = [value, *(slopes[n] for n in names), *(bends.get(pair, 0.0) for pair in pairs)]
    return [np.broadcast_to(column, value.shape) for column in found]


def _blend(
    names: tuple[str, ...], share: np.ndarray, one: tuple[Slopes, Bends], other: tuple[Slopes, Bends]
) -> tuple[Slopes, Bends]:
    """Derivatives of ``ln(exp(one) + exp(other))``; ``share`` is that of the other."""
    slopes = {n: (1 - share) * one[0].get(n, 0.0) + share * other[0].get(n, 0.0) for n in names}
    bends: Bends = {}
    for i, m in enumerate(names):
        for n in names[i:]:
            apart = [other[0].get(k, 0.0) - one[0].get(k, 0.0) for k in (m, n)]
            bends[m, n] = (
                (1 - share) * one[1].get((m, n), 0.0)
                + share * other[1].get((m, n), 0.0)
                + share * (1 - share) * apart[0] * apart[1]
            )
    return slopes, bends


class _Model:
    """A fitted model: its parameters are the dataclass fields."""

    def values(self) -> dict[str, float]:
        return dataclasses.asdict(self)

    def point(self) -> dict[str, Column]:
        known = self.values()
        return _literals(known | self.constants(**known))


@dataclasses.dataclass(frozen=True)
class BgNbd(_Model):
    r: float
    alpha: float
    a: float
    b: float

    inputs: ClassVar[tuple[str, ...]] = CUSTOMER_COLUMNS
    time_parameters: ClassVar[tuple[str, ...]] = ("alpha",)

    @staticmethod
    def constants(r: float, alpha: float, a: float, b: float) -> dict[str, float]:
        gammas = math.lgamma(a + b) - math.lgamma(b) - math.lgamma(r)
        known = {"base": gammas + r * math.log(alpha)}
        for name, at in (("r", r), ("b", b), ("ab", a + b)):
            known[f"psi_{name}"], known[f"psi1_{name}"] = polygamma_numbers(at)
        return known

    @staticmethod
    def log_likelihood(p: dict[str, Column], x: Column, tx: Column, T: Column) -> Column:
        r, alpha, a, b = p["r"], p["alpha"], p["a"], p["b"]
        gammas = lgamma(r + x) + lgamma(b + x) - lgamma(a + b + x)
        alive = -(r + x) * F.ln(alpha + T)
        dropped = F.ln(a) - F.ln(b + x - 1) - (r + x) * F.ln(alpha + tx)
        ended = F.when(x > 0, log_add_exp(alive, dropped)).otherwise(alive)
        return p["base"] + gammas + ended

    @staticmethod
    def derivatives(p: dict[str, float], x: np.ndarray, tx: np.ndarray, T: np.ndarray) -> list[np.ndarray]:
        r, alpha, a, b = p["r"], p["alpha"], p["a"], p["b"]
        names = ("r", "alpha", "a", "b")
        # Where x is 0 nobody has gone, and b + x - 1 is not used.
        later = np.where(x > 0, b + x - 1, 1.0)
        alive = -(r + x) * np.log(alpha + T)
        gone = np.where(x > 0, np.log(a) - np.log(later) - (r + x) * np.log(alpha + tx), -np.inf)
        ended = np.logaddexp(alive, gone)
        slopes, bends = _blend(
            names,
            np.exp(gone - ended),
            (
                {"r": -np.log(alpha + T), "alpha": -(r + x) / (alpha + T)},
                {("r", "alpha"): -1 / (alpha + T), ("alpha", "alpha"): (r + x) / (alpha + T) ** 2},
            ),
            (
                {"r": -np.log(alpha + tx), "alpha": -(r + x) / (alpha + tx), "a": 1 / a, "b": -1 / later},
                {
                    ("r", "alpha"): -1 / (alpha + tx),
                    ("alpha", "alpha"): (r + x) / (alpha + tx) ** 2,
                    ("a", "a"): -1 / (a * a),
                    ("b", "b"): 1 / (later * later),
                },
            ),
        )
        both = p["psi_ab"] - digamma(a + b + x, np.log)
        both1 = p["psi1_ab"] - trigamma(a + b + x)
        slopes["r"] += digamma(r + x, np.log) - p["psi_r"] + np.log(alpha)
        slopes["alpha"] += r / alpha
        slopes["a"] += both
        slopes["b"] += both - p["psi_b"] + digamma(b + x, np.log)
        bends["r", "r"] += trigamma(r + x) - p["psi1_r"]
        bends["r", "alpha"] += 1 / alpha
        bends["alpha", "alpha"] += -r / (alpha * alpha)
        bends["a", "a"] += both1
        bends["a", "b"] += both1
        bends["b", "b"] += both1 - p["psi1_b"] + trigamma(b + x)
        gammas = lgamma(r + x, np.log) + lgamma(b + x, np.log) - lgamma(a + b + x, np.log)
        return _listed(names, p["base"] + gammas + ended, slopes, bends)

    def p_alive(self, x: Column, tx: Column, T: Column) -> Column:
        """Probability that the customer is still active at age ``T``."""
        odds = self.a / (self.b + x - 1) * F.pow((self.alpha + T) / (self.alpha + tx), self.r + x)
        alive = F.when(x > 0, 1.0 / (1.0 + odds)).otherwise(1.0)
        return _if_known(alive, x, tx, T)

    def expected_purchases(self, t: float, x: Column, tx: Column, T: Column) -> Column:
        """Expected purchases in the ``t`` days after ``T``."""
        if t == 0:
            return F.lit(0.0)
        return self.purchases_if_alive([float(t)], [1.0], x, T) * self.p_alive(x, tx, T)

    def purchases_if_alive(
        self, times: list[float], weights: list[float], x: Column, T: Column
    ) -> Column:
        """Weighted sum of the expected purchases at several times, in one call per row."""
        kernel = dropout_purchases(self.r, self.alpha, self.a, self.b, times, weights)
        return kernel(x, T)


@dataclasses.dataclass(frozen=True)
class ParetoNbd(_Model):
    r: float
    alpha: float
    s: float
    beta: float

    inputs: ClassVar[tuple[str, ...]] = CUSTOMER_COLUMNS
    time_parameters: ClassVar[tuple[str, ...]] = ("alpha", "beta")

    @staticmethod
    def constants(r: float, alpha: float, s: float, beta: float) -> dict[str, float]:
        known = {"base": r * math.log(alpha) + s * math.log(beta) - math.lgamma(r)}
        known["psi_r"], known["psi1_r"] = polygamma_numbers(r)
        return known

    @staticmethod
    def _log_alive(p: dict[str, Column], x: Column, T: Column) -> Column:
        return -(p["r"] + x) * F.ln(p["alpha"] + T) - p["s"] * F.ln(p["beta"] + T)

    @staticmethod
    def _log_left(p: dict[str, Column], x: Column, tx: Column, T: Column) -> Column:
        """Log of the part of those who left between ``tx`` and ``T``, on the scale of the alive."""
        integral = dropout_integral(p["r"] + x, p["alpha"], p["s"] + 1, p["beta"], tx, T)
        return F.ln(p["s"]) + integral

    @staticmethod
    def log_likelihood(p: dict[str, Column], x: Column, tx: Column, T: Column) -> Column:
        alive, left = ParetoNbd._log_alive(p, x, T), ParetoNbd._log_left(p, x, tx, T)
        return p["base"] + lgamma(p["r"] + x) + log_add_exp(alive, left)

    @staticmethod
    def derivatives(p: dict[str, float], x: np.ndarray, tx: np.ndarray, T: np.ndarray) -> list[np.ndarray]:
        r, alpha, s, beta = p["r"], p["alpha"], p["s"], p["beta"]
        names = ("r", "alpha", "s", "beta")
        moments = dropout_kernel(True)(r + x, alpha, s + 1, beta, tx, T).T
        mean = dict(zip(MOMENTS, moments[1:5]))
        spread = dict(zip(PAIRS, moments[5:]))
        alive = -(r + x) * np.log(alpha + T) - s * np.log(beta + T)
        left = np.log(s) + moments[0]
        ended = np.logaddexp(alive, left)
        slopes, bends = _blend(
            names,
            np.exp(left - ended),
            (
                {
                    "r": -np.log(alpha + T),
                    "alpha": -(r + x) / (alpha + T),
                    "s": -np.log(beta + T),
                    "beta": -s / (beta + T),
                },
                {
                    ("r", "alpha"): -1 / (alpha + T),
                    ("alpha", "alpha"): (r + x) / (alpha + T) ** 2,
                    ("s", "beta"): -1 / (beta + T),
                    ("beta", "beta"): s / (beta + T) ** 2,
                },
            ),
            (
                {
                    "r": -mean["la"],
                    "alpha": -(r + x) * mean["ia"],
                    "s": 1 / s - mean["lb"],
                    "beta": -(s + 1) * mean["ib"],
                },
                # Of the logarithm of an integral: the spread of the slopes, and the mean of the bends.
                {
                    ("r", "r"): spread["la", "la"],
                    ("r", "alpha"): (r + x) * spread["la", "ia"] - mean["ia"],
                    ("r", "s"): spread["la", "lb"],
                    ("r", "beta"): (s + 1) * spread["la", "ib"],
                    ("alpha", "alpha"): (r + x)
                    * ((r + x + 1) * spread["ia", "ia"] + mean["ia"] * mean["ia"]),
                    ("alpha", "s"): (r + x) * spread["ia", "lb"],
                    ("alpha", "beta"): (r + x) * (s + 1) * spread["ia", "ib"],
                    ("s", "s"): spread["lb", "lb"] - 1 / (s * s),
                    ("s", "beta"): (s + 1) * spread["lb", "ib"] - mean["ib"],
                    ("beta", "beta"): (s + 1) * ((s + 2) * spread["ib", "ib"] + mean["ib"] * mean["ib"]),
                },
            ),
        )
        slopes["r"] += digamma(r + x, np.log) - p["psi_r"] + np.log(alpha)
        slopes["alpha"] += r / alpha
        slopes["s"] += np.log(beta)
        slopes["beta"] += s / beta
        bends["r", "r"] += trigamma(r + x) - p["psi1_r"]
        bends["r", "alpha"] += 1 / alpha
        bends["alpha", "alpha"] += -r / (alpha * alpha)
        bends["s", "beta"] += 1 / beta
        bends["beta", "beta"] += -s / (beta * beta)
        return _listed(names, p["base"] + lgamma(r + x, np.log) + ended, slopes, bends)

    def p_alive(self, x: Column, tx: Column, T: Column) -> Column:
        """Probability that the customer is still active at age ``T``."""
        p = self.point()
        odds = F.exp(self._log_left(p, x, tx, T) - self._log_alive(p, x, T))
        return _if_known(1 / (1 + odds), x, tx, T)

    def expected_purchases(self, t: float, x: Column, tx: Column, T: Column) -> Column:
        """Expected purchases in the ``t`` days after ``T``."""
        return self.purchases_if_alive(t, x, T) * self.p_alive(x, tx, T)

    def purchases_if_alive(self, t: float, x: Column, T: Column) -> Column:
        r, alpha, beta = self.r, self.alpha, self.beta
        # The formula has a removable singularity at s = 1.
        s = self.s if abs(self.s - 1) > NEAR_ONE else 1 + NEAR_ONE
        shrink = F.expm1((s - 1) * F.ln((beta + T) / (beta + T + float(t))))
        return (r + x) * (beta + T) / ((alpha + T) * (s - 1)) * -shrink


@dataclasses.dataclass(frozen=True)
class GammaGamma(_Model):
    p: float
    q: float
    v: float

    inputs: ClassVar[tuple[str, ...]] = ("frequency", "monetary_value")
    time_parameters: ClassVar[tuple[str, ...]] = ()

    @staticmethod
    def constants(p: float, q: float, v: float) -> dict[str, float]:
        known = {"base": q * math.log(v) - math.lgamma(q)}
        known["psi_q"], known["psi1_q"] = polygamma_numbers(q)
        return known

    @staticmethod
    def log_likelihood(k: dict[str, Column], x: Column, m: Column) -> Column:
        p, q, v = k["p"], k["q"], k["v"]
        px = p * x
        return (
            k["base"]
            + lgamma(px + q)
            - lgamma(px)
            + (px - 1) * F.ln(m)
            + px * F.ln(x)
            - (px + q) * F.ln(x * m + v)
        )

    @staticmethod
    def derivatives(k: dict[str, float], x: np.ndarray, m: np.ndarray) -> list[np.ndarray]:
        p, q, v = k["p"], k["q"], k["v"]
        px, spent = p * x, x * m
        every = spent + v
        psi_all, psi1_all = digamma(px + q, np.log), trigamma(px + q)
        slopes = {
            "p": x * (psi_all - digamma(px, np.log) + np.log(spent) - np.log(every)),
            "q": np.log(v) - k["psi_q"] + psi_all - np.log(every),
            "v": q / v - (px + q) / every,
        }
        bends = {
            ("p", "p"): x * x * (psi1_all - trigamma(px)),
            ("p", "q"): x * psi1_all,
            ("p", "v"): -x / every,
            ("q", "q"): psi1_all - k["psi1_q"],
            ("q", "v"): 1 / v - 1 / every,
            ("v", "v"): (px + q) / (every * every) - q / (v * v),
        }
        gammas = lgamma(px + q, np.log) - lgamma(px, np.log)
        value = k["base"] + gammas + px * np.log(spent) - np.log(m) - (px + q) * np.log(every)
        return _listed(("p", "q", "v"), value, slopes, bends)

    def expected_profit(self, x: Column, m: Column) -> Column:
        """Expected mean value of a purchase."""
        return self.p * (self.v + x * m) / (self.p * x + self.q - 1)


def customer_lifetime_value(
    model: BgNbd | ParetoNbd, money: GammaGamma, months: int, rate: float
) -> Column:
    """Discounted value of the purchases expected in each of the next 30-day months.

    The monthly differences are summed by parts, so each horizon is evaluated once.
    """
    x, tx, T = (F.col(name) for name in CUSTOMER_COLUMNS)
    discount = [(1 + rate) ** -k for k in range(1, months + 1)] + [0.0]
    weights = [now - later for now, later in zip(discount, discount[1:])]
    times = [float(DAYS_PER_MONTH * k) for k in range(1, months + 1)]
    if not months:
        purchases = F.lit(0.0)
    elif isinstance(model, ParetoNbd):
        parts = [w * model.purchases_if_alive(t, x, T) for t, w in zip(times, weights)]
        purchases = functools.reduce(operator.add, parts)
    else:
        purchases = model.purchases_if_alive(times, weights, x, T)
    profit = money.expected_profit(x, F.col("monetary_value"))
    return profit * purchases * model.p_alive(x, tx, T)


def predict_value(
    features: DataFrame, model: BgNbd | ParetoNbd, money: GammaGamma, params: ClvParams
) -> DataFrame:
    """Predicted purchases, value and total of each customer, with actual total and error."""
    x, tx, T = (F.col(name) for name in CUSTOMER_COLUMNS)
    joined = features.select(
        "customer_id",
        F.col("frequency_btyd").alias("frequency"),
        "recency",
        "T",
        F.col("monetary_btyd").alias("monetary_value"),
        F.col("monetary_dnn").alias("train_monetary"),
        F.col("target_monetary").alias("actual_total"),
    )
    return (
        joined.withColumns(
            {
                "predicted_num_purchases": model.expected_purchases(params.time_days, x, tx, T),
                "predicted_value": customer_lifetime_value(
                    model, money, params.time_months, params.discount_rate
                ),
            }
        )
        .withColumn("predicted_total", F.col("train_monetary") + F.col("predicted_value"))
        .withColumn("error", F.col("actual_total") - F.col("predicted_total"))
        .select(
            "customer_id",
            "actual_total",
            "predicted_num_purchases",
            "predicted_value",
            "predicted_total",
            "error",
        )
    )
