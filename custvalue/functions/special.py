"""Special functions as Column expressions."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

LGAMMA_SHIFT = 8


def lgamma(x: Column | np.ndarray, ln: Callable = F.ln) -> Column | np.ndarray:
    """Log of the gamma function for ``x > 0``: Stirling's series at ``x + 8``, recursed down.

    Of a Column, or of an array with numpy's ``ln``.
    """
    product = x
    for i in range(1, LGAMMA_SHIFT):
        product = product * (x + i)
    z = x + LGAMMA_SHIFT
    inverse = 1.0 / z
    square = inverse * inverse
    tail = inverse * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square / 1680)))
    return (z - 0.5) * ln(z) - z + 0.5 * math.log(2 * math.pi) + tail - ln(product)


def log_add_exp(a: Column, b: Column) -> Column:
    """``ln(exp(a) + exp(b))`` without overflow."""
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))


def log1p_exp(y: Column) -> Column:
    """``ln(1 + exp(y))`` without overflow."""
    return F.greatest(y, F.lit(0.0)) + F.log1p(F.exp(-F.abs(y)))


def digamma(x: Column | np.ndarray, ln: Callable = F.ln) -> Column | np.ndarray:
    """First derivative of ``lgamma`` for ``x > 0``, by the same shift; of an array with numpy's ``ln``."""
    above = 0.0
    for i in range(LGAMMA_SHIFT):
        above = above + 1 / (x + i)
    z = x + LGAMMA_SHIFT
    square = 1 / (z * z)
    tail = square * (1 / 12 - square * (1 / 120 - square * (1 / 252 - square * (1 / 240 - square / 132))))
    return ln(z) - 0.5 / z - tail - above


def trigamma(x: Column | np.ndarray) -> Column | np.ndarray:
    """Second derivative of ``lgamma`` for ``x > 0``, of a Column or an array."""
    above = 0.0
    for i in range(LGAMMA_SHIFT):
        above = above + 1 / ((x + i) * (x + i))
    z = x + LGAMMA_SHIFT
    square = 1 / (z * z)
    tail = 1 / 6 - square * (1 / 30 - square * (1 / 42 - square * (1 / 30 - square * 5 / 66)))
    return 1 / z + 0.5 * square + square / z * tail + above


def polygamma_numbers(x: float) -> tuple[float, float]:
    """``digamma`` and ``trigamma`` of one number, by longer shifts."""
    first = second = 0.0
    while x < 20:
        first -= 1 / x
        second += 1 / (x * x)
        x += 1
    square = 1 / (x * x)
    first += math.log(x) - 0.5 / x - square * (1 / 12 - square * (1 / 120 - square / 252))
    second += 1 / x + square / 2 + square / x * (1 / 6 - square * (1 / 30 - square / 42))
    return first, second


#: What the moments of ``dropout_kernel`` are: means, then covariances, of
#: ln(alpha + u), 1 / (alpha + u), ln(beta + u) and 1 / (beta + u).
MOMENTS = ("la", "ia", "lb", "ib")
PAIRS = tuple((m, n) for i, m in enumerate(MOMENTS) for n in MOMENTS[i:])


def dropout_kernel(with_moments: bool) -> Callable:
    """Function of arrays: the integral of ``(alpha + u) ** -p * (beta + u) ** -q`` from tx to T.

    A column with its logarithm, -Infinity if it is empty; ``with_moments`` adds one column for each
    of ``MOMENTS`` and ``PAIRS`` under the integrand. Double-exponential quadrature in
    ``ln(min(alpha, beta) + u)``, in which the integrand is an exponential with bends: its 161
    nodes lie densely at both ends, so steep ones are met as well. All terms are positive and no
    difference is taken. The work of a row does not depend on its values. The inner function
    stands alone, so tasks need no import of this package.
    """

    def evaluate(p, alpha, q, beta, tx, end) -> np.ndarray:
        t = np.linspace(-3.2, 3.2, 161)
        y = np.pi * np.sinh(t)
        place = 1 / (1 + np.exp(-y))  # of the range, exact near its start
        log_w = np.log(np.pi * np.cosh(t) * (t[1] - t[0])) - np.logaddexp(0, y) - np.logaddexp(0, -y)
        columns = np.broadcast_arrays(*(np.asarray(s, dtype=float) for s in (p, alpha, q, beta, tx, end)))
        out = np.empty((len(columns[0]), 15 if with_moments else 1))
        for start in range(0, len(out), 1024):  # bounds the matrix of rows by nodes
            with np.errstate(divide="ignore", invalid="ignore"):
                ps, al, qs, be, low, high = (c[start : start + 1024, None] for c in columns)
                least, spread = np.minimum(al, be), np.abs(al - be)
                first = np.log(least + low)
                width = np.log1p((high - low) / (least + low))
                near = first + width * place
                far = np.logaddexp(near, np.log(spread))
                la, lb = np.where(al <= be, near, far), np.where(al <= be, far, near)
                log_f = near + np.log(width) + log_w - ps * la - qs * lb
                top = log_f.max(axis=1, keepdims=True)
                share = np.exp(log_f - top)
                total = share.sum(axis=1, keepdims=True)
                empty = (width == 0)[:, 0]
                logs = np.where(empty, -np.inf, (top + np.log(total))[:, 0])
                out[start : start + 1024, 0] = logs
                if not with_moments:
                    continue
                share = share / total
                values = [la, np.exp(-la), lb, np.exp(-lb)]
                means = [(share * v).sum(axis=1) for v in values]
                apart = [v - m[:, None] for v, m in zip(values, means)]
                spreads = [(share * apart[i] * apart[j]).sum(axis=1) for i in range(4) for j in range(i, 4)]
                found = np.stack([*means, *spreads], axis=1)
                out[start : start + 1024, 1:] = np.where(empty[:, None], 0.0, found)
        return out

    return evaluate


def dropout_integral(p: Column, alpha: Column, q: Column, beta: Column, tx: Column, end: Column) -> Column:
    """Logarithm of the integral of ``dropout_kernel``; -Infinity if it is empty."""
    kernel = dropout_kernel(False)

    def evaluate(
        p: pd.Series, alpha: pd.Series, q: pd.Series, beta: pd.Series, tx: pd.Series, end: pd.Series
    ) -> pd.Series:
        return pd.Series(kernel(p, alpha, q, beta, tx, end)[:, 0])

    return F.pandas_udf(evaluate, T.DoubleType())(p, alpha, q, beta, tx.cast("double"), end.cast("double"))


def dropout_purchases(
    r: float, alpha: float, a: float, b: float, times: list[float], weights: list[float]
):
    """Vectorized UDF of ``sum(weights[k] * E[purchases within times[k] | active at T])``, BG/NBD.

    With ``p ~ Beta(a, b + x)`` and ``lambda ~ Gamma(r + x, alpha + T)`` the expectation is that
    of ``(1 - (1 + p s) ** -(r + x)) / p``, ``s = t / (alpha + T)``.  Where ``z = t / (alpha + T + t)``
    is at most 0.9 it is the hypergeometric series, whose length is then bounded; beyond, it is
    a double-exponential quadrature of 361 nodes.  The work of a row does not depend on its
    values.  The inner function stands alone, so tasks need no import of this package.
    """
    near_one = 1e-7
    a_series = a if abs(a - 1) > near_one else 1 + near_one

    def evaluate(x: pd.Series, T_: pd.Series) -> pd.Series:
        known = (x.notna() & T_.notna()).to_numpy()
        xs, ages = x.to_numpy(dtype=float)[known], T_.to_numpy(dtype=float)[known]
        total = np.zeros(len(xs))
        # Nodes in y = logit(p); the weights hold dp = p (1 - p) dy.
        u = np.linspace(-7.5, 7.5, 361)
        y = np.pi * np.sinh(u)
        log_p, log_q = -np.logaddexp(0, -y), -np.logaddexp(0, y)
        log_w = np.log(np.pi * np.cosh(u) * (u[1] - u[0]))
        log_w[[0, -1]] -= math.log(2)  # the ends count half
        p = np.exp(log_p)
        safe_p = np.maximum(p, 1e-290)
        counts, places = np.unique(xs, return_inverse=True)
        log_beta = np.array(
            [math.lgamma(a) + math.lgamma(b + c) - math.lgamma(a + b + c) for c in counts]
        )[places]

        def series(xs, ages, t):
            z = t / (alpha + ages + t)
            ca, cb, cc = a_series + b - 1 - r, a_series - 1, a_series + b - 1 + xs
            term, inner = np.ones(len(xs)), np.ones(len(xs))
            for n in range(400):
                term = term * (ca + n) * (cb + n) / ((cc + n) * (n + 1)) * z
                inner += term
                if np.abs(term).max(initial=0.0) < 1e-17:
                    break
            growth = 1.0 - ((alpha + ages) / (alpha + ages + t)) ** (a_series - 1) * inner
            return (a_series + b + xs - 1) / (a_series - 1) * growth

        def quadrature(xs, ages, t, log_beta):
            s, out = t / (alpha + ages), np.empty(len(xs))
            for start in range(0, len(xs), 2048):  # bounds the matrix of rows by nodes
                k = slice(start, start + 2048)
                shape = (r + xs[k])[:, None]
                rate = s[k][:, None]
                near_zero = shape * rate  # the limit, where p itself is lost
                g = np.where(p > 1e-290, -np.expm1(-shape * np.log1p(p * rate)) / safe_p, near_zero)
                at = a * log_p + (b + xs[k])[:, None] * log_q + log_w - log_beta[k][:, None]
                inside = (np.exp(at) * g).sum(axis=1)
                # What lies outside the nodes, where the other factors no longer change.
                low = np.exp(a * log_p[0] - log_beta[k]) / a * g[:, 0]
                high = np.exp((b + xs[k]) * log_q[-1] - log_beta[k]) / (b + xs[k]) * g[:, -1]
                out[k] = inside + low + high
            return out

        for t, weight in zip(times, weights):
            far = t / (alpha + ages + t) > 0.9
            value = np.empty(len(xs))
            value[~far] = series(xs[~far], ages[~far], t)
            value[far] = quadrature(xs[far], ages[far], t, log_beta[far])
            total += weight * value
        out = np.full(len(x), np.nan)
        out[known] = total
        return pd.Series(out).where(pd.Series(known), None).astype("Float64")

    return F.pandas_udf(evaluate, T.DoubleType())
