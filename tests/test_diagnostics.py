"""Tests of series and forecasts: published critical values, and regressions done plainly in numpy."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodeworks.operators import diagnostics as dg

# Quantiles from published tables: (x, degrees, tail).
CHI2 = [(3.841459, 1, 0.05), (6.634897, 1, 0.01), (5.991465, 2, 0.05), (9.487729, 4, 0.05), (11.070498, 5, 0.05), (15.507313, 8, 0.05), (21.026070, 12, 0.05), (26.216967, 12, 0.01), (1.145476, 5, 0.95)]
F_TABLE = [(4.351244, 1, 20, 0.05), (3.492828, 2, 20, 0.05), (2.866081, 4, 20, 0.05), (4.430690, 4, 20, 0.01), (161.4476, 1, 1, 0.05), (2.447237, 4, 120, 0.05)]


def test_tails(spark):
    for df in {d for _, d, _ in CHI2}:
        rows = [(x, p) for x, d, p in CHI2 if d == df]
        got = spark.createDataFrame(rows, "x double, p double").select("p", dg.chi2_tail(F.col("x"), df).alias("q")).collect()
        assert all(abs(r.p - r.q) < 1e-6 for r in got)
    odd = spark.createDataFrame([(0.0,), (1e-9,), (60.0,), (5000.0,), (None,)], "x double").select(dg.chi2_tail(F.col("x"), 5).alias("q"), dg.normal_two_sided(F.col("x")).alias("z")).collect()
    assert odd[0].q == odd[0].z == 1 and odd[2].q == pytest.approx(1.2149e-11, rel=1e-3) and odd[3].q == 0 and odd[4].q is None
    z = spark.createDataFrame([(1.959964,), (-2.575829,)], "x double").select(dg.normal_two_sided(F.col("x")).alias("z")).collect()
    assert [round(r.z, 6) for r in z] == [0.05, 0.01]
    for x, a, b, p in F_TABLE:
        assert dg.f_tail(x, a, b) == pytest.approx(p, abs=2e-6)
    assert dg.f_tail(0, 2, 3) == 1


def test_unit_root_p():
    """Published asymptotic critical values with a constant."""
    for tau, p in ((-3.43035, 0.01), (-2.86154, 0.05), (-2.56677, 0.10)):
        assert dg.unit_root_p(tau) == pytest.approx(p, abs=0.002)
    assert dg.unit_root_p(3) == 1 and dg.unit_root_p(-20) == 0


def series(seed, n, rho=0.5, walk=False, shift=0.0):
    rng = np.random.default_rng(seed)
    y = np.zeros(n)
    for i in range(1, n):
        y[i] = (1.0 if walk else rho) * y[i - 1] + rng.normal()
    return y + shift


MARKETS = {"a": series(1, 90), "b": series(2, 120, walk=True, shift=1e6), None: series(3, 40, 0.9), "short": series(4, 5), "flat": np.full(60, 3.0)}


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(9)
    rows = [(k, i, float(v), float(v + rng.normal()) if i % 7 else None, 1) for k, s in MARKETS.items() for i, v in enumerate(s)]
    rng.shuffle(rows)
    rows = [(k, int(i), float(v), None if x is None else float(x), 1) for k, i, v, x, _ in rows] + [("a", 1000, None, None, 1)]
    return spark.createDataFrame(rows, "market string, q int, y double, x double, i int")


def fit(y, x):
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    e = y - x @ beta
    return beta, float(e @ e)


def adf_plain(y, most=8):
    most = min(most, len(y) // 2 - 2)
    d = np.diff(y)

    def design(k, drop):
        rows = range(drop, len(d))
        return d[drop:], np.array([[1, y[t], *(d[t - j] for j in range(1, k + 1))] for t in rows])

    aic = []
    for k in range(most + 1):
        a, x = design(k, most)
        aic.append(len(a) * math.log(fit(a, x)[1] / len(a)) + 2 * x.shape[1])
    k = int(np.argmin(aic))
    a, x = design(k, k)
    beta, ssr = fit(a, x)
    return beta[1] / math.sqrt(ssr / (len(a) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1]), k, len(a)


def test_adf(panel):
    got = {r.market: r for r in dg.adf(panel, ["market"], "q", "y").collect()}
    assert set(got) == {"a", "b", None}
    for k, r in got.items():
        y = MARKETS[k] - MARKETS[k].mean()
        tau, lags, rows = adf_plain(y)
        assert (r.lags, r.rows) == (lags, rows) and r.statistic == pytest.approx(tau, rel=1e-6) and r.p == dg.unit_root_p(r.statistic)
    assert got["a"].p < 0.01 < got["b"].p


def test_kpss_and_ljung_box(panel):
    lb = {(r.market, r.lag): r for r in dg.ljung_box(panel, ["market"], "q", "y").collect()}
    ks = {r.market: r for r in dg.kpss(panel, ["market"], "q", "y").collect()}
    assert set(ks) == {"a", "b", None, "short"} and ("short", 4) in lb and ("short", 8) not in lb and ("flat", 4) not in lb
    for k in ("a", "b", None):
        e, n = MARKETS[k] - MARKETS[k].mean(), len(MARKETS[k])
        g = [float(e[j:] @ e[: n - j]) for j in range(n)]
        for lag in (4, 8, 12):
            q = n * (n + 2) * sum((g[j] / g[0]) ** 2 / (n - j) for j in range(1, lag + 1))
            assert lb[k, lag].statistic == pytest.approx(q, rel=1e-8)
        few = int(n ** (2 / 9))
        s0, s1 = g[0] / n + sum(g[i] / (n / 2) for i in range(1, few + 1)), sum(i * g[i] / (n / 2) for i in range(1, few + 1))
        lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
        long_run = (g[0] + 2 * sum(g[i] * (1 - i / (lags + 1)) for i in range(1, lags + 1))) / n
        stat = float((np.cumsum(e) ** 2).sum()) / n**2 / long_run
        assert ks[k].lags == lags and ks[k].statistic == pytest.approx(stat, rel=1e-7)
        assert ks[k].p == pytest.approx(float(np.interp(stat, dg.KPSS_STATISTIC, dg.KPSS_P)))


def test_granger(panel):
    got = {(r.market, r.lag): r for r in dg.granger(panel, ["market"], "q", "y", "x").collect()}
    rows = {}
    for r in panel.where("x is not null and y is not null").orderBy("q").collect():
        rows.setdefault(r.market, []).append((r.y, r.x))
    assert {k for k, _ in got} == {"a", "b", None}
    for (k, lag), r in got.items():
        y, x = np.array(rows[k]).T
        y = y - y.mean()
        x = x - x.mean()
        own = np.array([[1, *(y[t - j] for j in range(1, lag + 1))] for t in range(lag, len(y))])
        more = np.array([[x[t - j] for j in range(1, lag + 1)] for t in range(lag, len(y))])
        alone, both = fit(y[lag:], own)[1], fit(y[lag:], np.hstack([own, more]))[1]
        free = len(y) - lag - 2 * lag - 1
        f = (alone - both) / lag / (both / free)
        assert r.statistic == pytest.approx(f, rel=1e-5, abs=1e-8) and r.p == pytest.approx(dg.f_tail(f, lag, free), abs=1e-6)


def test_diagnose_has_every_test(panel):
    got = dg.diagnose(panel, ["market"], "q", "y", "x").where("market = 'a'").collect()
    assert sorted({r.test for r in got}) == ["adf", "granger", "jarque_bera", "kpss", "ljung_box"] and all(0 <= r.p <= 1 for r in got)
    assert dg.diagnose(panel.limit(0), ["market"], "q", "y", "x").count() == 0


def test_accuracy_and_diebold_mariano(spark):
    rng = np.random.default_rng(4)
    rows, errors = [], {}
    for market in ("m", None):
        actual = rng.normal(size=60)
        for model, spread in (("Naive", 1.0), ("Good", 0.3), ("Same", 1.0), ("Few", 0.5)):
            e = errors.get((market, "Naive")) if model == "Same" else rng.normal(size=60) * spread
            errors[market, model] = e
            rows += [(market, model, i, float(actual[i]), float(actual[i] - e[i]), float(actual[i] - e[i] - 0.5), float(actual[i] - e[i] + 0.5)) for i in range(9 if model == "Few" else 60)]
    bt = spark.createDataFrame(rows, "market string, model string, q int, actual double, predicted double, lo double, hi double")
    dm = {(r.market, r.model): r for r in dg.diebold_mariano(bt, ["market"], "q").collect()}
    assert set(dm) == {("m", "Good"), (None, "Good")}
    for (market, model), r in dm.items():
        d = errors[market, "Naive"] ** 2 - errors[market, model] ** 2
        z = d.mean() / math.sqrt(d.var(ddof=1) / len(d))
        assert r.n == 60 and r.statistic == pytest.approx(z) and r.p == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=1e-12)
    acc = {(r.market, r.model): r for r in dg.accuracy(bt, ["market"], "q").collect()}
    for (market, model), r in acc.items():
        e = errors[market, model][: r.n]
        assert r.rmse == pytest.approx(math.sqrt((e**2).mean())) and r.bias == pytest.approx(e.mean()) and r.coverage == pytest.approx((abs(e) <= 0.5).mean())
        assert r.acf1 == pytest.approx(np.corrcoef(e[1:], e[:-1])[0, 1]) and (r.ljung_box_p is None) == (model == "Few")
