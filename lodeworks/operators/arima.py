"""Seasonal ARMA models of differenced series by exact likelihood, and the search for an order by AIC.

The differences are chosen by the unit-root test; every (market, order) is a row of its own, so the search of a market is
dealt out over all tasks, and the best order is the least of a struct. The likelihood is that of a state-space filter
started from the stationary state, with the variance and the mean concentrated out; partial autocorrelations keep the
parameters stationary and invertible. A null market is a market of its own; markets of fewer than LEAST values have no
rows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .diagnostics import _types, adf, beside

LEAST, SEASON = 16, 4
#: Seasonal orders tried (autoregressive, moving average).
SEASONAL = ((0, 0), (1, 0), (1, 1), (0, 1))


def _from_partial(r: np.ndarray) -> np.ndarray:
    """Autoregressive coefficients of partial autocorrelations within (-1, 1)."""
    out = np.zeros(0)
    for x in r:
        out = np.append(out - x * out[::-1], x)
    return out


def _lag_polynomial(short: np.ndarray, long: np.ndarray, season: int) -> np.ndarray:
    """Coefficients after the leading 1 of (1 + short)(1 + long at multiples of the season)."""
    far = np.zeros(1 + len(long) * season)
    far[0] = 1
    far[season::season] = long
    return np.convolve(np.concatenate([[1.0], short]), far)[1:]


def coefficients(x: np.ndarray, p: int, q: int, sp: int, sq: int, season: int) -> tuple[np.ndarray, np.ndarray]:
    """(autoregressive, moving average) coefficients of unbounded parameters."""
    part = np.split(np.tanh(x), np.cumsum([p, q, sp]))
    ar = -_lag_polynomial(-_from_partial(part[0]), -_from_partial(part[2]), season)
    return ar, _lag_polynomial(-_from_partial(part[1]), -_from_partial(part[3]), season)


def innovations(y: np.ndarray, ar: np.ndarray, ma: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One-step errors of each column of `y`, their variances in units of the shock's, and the state after the last row
    with its transition matrix."""
    n, r = len(y), max(len(ar), len(ma) + 1)
    move, shock = np.eye(r, k=1), np.zeros(r)
    move[: len(ar), 0] = ar
    shock[0], shock[1 : 1 + len(ma)] = 1, ma
    noise = np.outer(shock, shock)
    cover, step = noise.copy(), move.copy()
    for _ in range(60):  # the stationary covariance, twice as many terms of its sum each time
        more = step @ cover @ step.T
        cover += more
        step = step @ step
        if np.abs(more).max() <= 1e-14 * np.abs(cover).max():
            break
    state, errors, sizes = np.zeros((r, y.shape[1])), np.empty_like(y), np.ones(n)
    settled = False
    for t in range(n):
        if not settled:
            size = cover[0, 0]
            gain = move @ cover[:, 0] / size
            cover = move @ cover @ move.T + noise - np.outer(gain, gain) * size
            settled = abs(size - 1) < 1e-10
            sizes[t] = size
        errors[t] = y[t] - state[0]
        state = move @ state + np.outer(gain, errors[t])
    return errors, sizes, state, move


def log_likelihood(y: np.ndarray, ar: np.ndarray, ma: np.ndarray, mean: bool) -> tuple[float, float, float]:
    """(log-likelihood, mean, variance of the shock), the last two at their best."""
    both = np.column_stack([y, np.ones(len(y))]) if mean else y[:, None]
    e, f, _, _ = innovations(both, ar, ma)
    mu = float((e[:, 0] * e[:, 1] / f).sum() / (e[:, 1] ** 2 / f).sum()) if mean else 0.0
    v = e[:, 0] - mu * e[:, 1] if mean else e[:, 0]
    n, s2 = len(y), max(float((v * v / f).mean()), 1e-300)
    return -0.5 * (n * (math.log(2 * math.pi * s2) + 1) + float(np.log(f).sum())), mu, s2


def minimise(f, x: np.ndarray, rounds: int = 60, tolerance: float = 1e-6) -> tuple[np.ndarray, float]:
    """Quasi-Newton (BFGS) descent with differences and a halving step."""
    n, h = len(x), 1e-6

    def slope(at, value):
        return np.array([(f(at + h * e) - value) / h for e in np.eye(n)])

    now = f(x)
    g, inverse = slope(x, now), np.eye(n)
    for _ in range(rounds):
        way = -inverse @ g
        if way @ g >= 0:
            inverse, way = np.eye(n), -g
        way *= min(1.0, 2.0 / max(1e-12, float(np.abs(way).max())))
        size = 1.0
        while size > 1e-8:
            after = f(x + size * way)
            if after <= now + 1e-4 * size * (g @ way):
                break
            size /= 2
        else:
            break
        s = size * way
        g1 = slope(x + s, after)
        d = g1 - g
        x, gain, now, g = x + s, now - after, after, g1
        if s @ d > 1e-12:
            rho = 1 / (s @ d)
            left = np.eye(n) - rho * np.outer(s, d)
            inverse = left @ inverse @ left.T + rho * np.outer(s, s)
        if gain < tolerance and np.abs(g).max() < 1e-2:
            break
    return x, now


def fit(series: np.ndarray, p: int, d: int, q: int, sp: int, sq: int, horizon: int, season: int = SEASON) -> dict:
    """One order fitted to one series: aic, coefficients, mean, sd of the errors and forecasts of the series itself."""
    y = np.diff(series, n=d)
    scale = float(y.std()) or 1.0
    z, mean = y / scale, d == 0

    def cost(x):
        return -log_likelihood(z, *coefficients(x, p, q, sp, sq, season), mean)[0]

    x, least = minimise(cost, np.full(p + q + sp + sq, 0.1))
    ar, ma = coefficients(x, p, q, sp, sq, season)
    _, mu, _ = log_likelihood(z, ar, ma, mean)
    e, _, state, move = innovations((z - mu)[:, None], ar, ma)
    ahead = []
    for _ in range(horizon):
        ahead.append(mu + float(state[0, 0]))
        state = move @ state
    ahead = np.array(ahead) * scale
    for k in range(d - 1, -1, -1):  # add up what was differenced, from the last value of each difference
        ahead = np.diff(series, n=k)[-1] + np.cumsum(ahead)
    aic = 2 * (least + len(y) * math.log(scale)) + 2 * (len(x) + mean + 1)
    return {"aic": aic, "ar": ar, "ma": ma, "mean": mu * scale, "sd": float(e[:, 0].std(ddof=1)) * scale, "rmse": float(np.sqrt((e[:, 0] ** 2).mean())) * scale, "forecast": ahead}


def differences(df: DataFrame, keys: list[str], at: str, value: str, most: int = 2, level: float = 0.05) -> DataFrame:
    """(keys, d): the differences after which the unit-root test first rejects, `most` if it never does."""
    w = Window.partitionBy(*keys).orderBy(at)
    s = df.select(*keys, at, F.col(value).cast("double").alias("y")).where("y IS NOT NULL")
    found = s.select(*keys).distinct().withColumn("d", F.lit(most))
    for d in range(most):
        tested = adf(s, keys, at, "y").where(F.col("p") < level).select(*keys, F.lit(d).alias("d"))
        found = found.unionByName(tested)
        s = s.withColumn("y", F.col("y") - F.lag("y").over(w)).where("y IS NOT NULL")
    return found.groupBy(*keys).agg(F.min("d").alias("d"))


def search(df: DataFrame, keys: list[str], at: str, value: str, most_p: int = 3, most_q: int = 3, most_d: int = 2, seasonal: tuple = SEASONAL, horizon: int = 8) -> DataFrame:
    """Every order of every market: (keys, p, d, q, sp, sq, aic, mean, sd, rmse, ar, ma, forecast)."""
    orders = [(p, q, sp, sq) for p in range(most_p + 1) for q in range(most_q + 1) if p or q for sp, sq in seasonal]
    s = df.select(*keys, at, F.col(value).cast("double").alias("y")).where("y IS NOT NULL").groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(at), "y"))), lambda x: x["y"]).alias("series"))
    s = beside(s.where(F.size("series") >= LEAST), differences(df, keys, at, value, most_d), keys)
    each = F.explode(F.array(*(F.struct(*(F.lit(v).alias(c) for v, c in zip(o, ("p", "q", "sp", "sq"), strict=True))) for o in orders)))
    rows = s.withColumn("o", each).select(*keys, "d", "series", "o.*")
    rows = rows.repartition(*keys, "p", "q", "sp", "sq")
    names = [*keys, "p", "d", "q", "sp", "sq", "aic", "mean", "sd", "rmse", "ar", "ma", "forecast"]

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                try:
                    m = fit(np.asarray(r["series"], float), r["p"], r["d"], r["q"], r["sp"], r["sq"], horizon)
                except np.linalg.LinAlgError:  # such an order can't be fitted to such a series
                    continue
                out.append([*(r[k] for k in keys), r["p"], r["d"], r["q"], r["sp"], r["sq"], *(m[c] for c in names[len(keys) + 5 :])])
            yield pd.DataFrame(out, columns=names)

    kinds = "p int, d int, q int, sp int, sq int, aic double, mean double, sd double, rmse double, ar array<double>, ma array<double>, forecast array<double>"
    return rows.mapInPandas(run, f"{_types(df, keys)}, {kinds}")


def best(found: DataFrame, keys: list[str]) -> DataFrame:
    """Of each market the order of the least AIC, the smaller one if equal."""
    order = F.struct("aic", "p", "q", "sp", "sq")
    return found.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in found.columns if c not in keys]), order).alias("_best")).select(*keys, "_best.*")
