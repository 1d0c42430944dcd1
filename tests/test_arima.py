"""ARIMA: the likelihood against the plain multivariate normal, orders and coefficients of simulated series."""

from __future__ import annotations

import math

import numpy as np
import pytest

from lodeworks.operators import arima


def simulate(seed, n, ar=(), ma=(), mean=0.0):
    rng = np.random.default_rng(seed)
    e, y = rng.normal(size=n + 200), np.zeros(n + 200)
    for t in range(10, n + 200):
        y[t] = e[t] + sum(a * y[t - 1 - i] for i, a in enumerate(ar)) + sum(b * e[t - 1 - i] for i, b in enumerate(ma))
    return y[200:] + mean


@pytest.mark.parametrize(("ar", "ma"), [([0.6], []), ([], [0.4, -0.3]), ([0.5, 0.3], [0.7]), ([0, 0, 0, 0.8], [0.2])])
def test_exact_likelihood(ar, ma):
    """Autocovariances by a long sum of squared weights give the covariance matrix; its normal density is the likelihood."""
    ar, ma, n = np.array(ar, float), np.array(ma, float), 40
    psi = np.zeros(4000)
    psi[0] = 1
    for j in range(1, len(psi)):
        psi[j] = (ma[j - 1] if j <= len(ma) else 0) + sum(a * psi[j - 1 - i] for i, a in enumerate(ar) if j - 1 - i >= 0)
    cover = np.array([[psi[: len(psi) - abs(i - j)] @ psi[abs(i - j) :] for j in range(n)] for i in range(n)])
    y = simulate(5, n, ar, ma, 2.0)
    for mean in (True, False):
        inv, one = np.linalg.inv(cover), np.ones(n)
        mu = (one @ inv @ y) / (one @ inv @ one) if mean else 0.0
        s2 = (y - mu) @ inv @ (y - mu) / n
        plain = -0.5 * (n * math.log(2 * math.pi * s2) + np.linalg.slogdet(cover)[1] + n)
        got, m, v = arima.log_likelihood(y, ar, ma, mean)
        assert got == pytest.approx(plain, rel=1e-8) and m == pytest.approx(mu, abs=1e-8) and v == pytest.approx(s2, rel=1e-8)


def test_coefficients_are_stationary():
    rng = np.random.default_rng(1)
    for _ in range(50):
        ar, ma = arima.coefficients(rng.normal(size=7) * 2, 3, 2, 1, 1, 4)
        for c in (np.concatenate([[1], -ar]), np.concatenate([[1], ma])):
            assert (np.abs(np.roots(c)) < 1 + 1e-9).all()


def test_fit_finds_coefficients_and_forecasts():
    m = arima.fit(simulate(3, 1500, [0.6], [0.3], 5.0), 1, 0, 1, 0, 0, 3)
    assert m["ar"][0] == pytest.approx(0.6, abs=0.06) and m["ma"][0] == pytest.approx(0.3, abs=0.06) and m["mean"] == pytest.approx(5.0, abs=0.3)
    y = np.arange(50.0) ** 2 + np.sin(np.arange(50.0))
    ahead = arima.fit(y, 1, 2, 0, 0, 0, 2)["forecast"]
    assert ahead == pytest.approx([2500, 2601], abs=6)


def test_search(spark):
    """Orders of known series: one lag, one shock, a yearly lag, and a walk that has to be differenced."""
    known = {
        "ar": simulate(1, 160, [0.8]), "ma": simulate(2, 160, [], [0.8]), "season": simulate(4, 160, [0.3, 0, 0, 0.65, -0.195]),
        "walk": np.cumsum(simulate(6, 160, [0.6])), None: simulate(8, 60, [0.7]), "short": simulate(9, 12),
    }
    rows = [(k, i, float(v)) for k, s in known.items() for i, v in enumerate(s)]
    found = arima.search(spark.createDataFrame(rows, "market string, q int, y double"), ["market"], "q", "y", 1, 1).cache()
    assert found.count() == 5 * 12
    got = {r.market: r for r in arima.best(found, ["market"]).collect()}
    assert set(got) == {"ar", "ma", "season", "walk", None}
    assert got["ar"].p == 1 and got["ar"].d == 0 and got["ar"].ar[0] == pytest.approx(0.8, abs=0.12)
    assert got["ma"].q == 1 and got["ma"].d == 0 and got["season"].sp == 1 and got["walk"].d == 1
    for r in found.where("market = 'ma'").collect():
        assert r.aic >= got["ma"].aic and len(r.forecast) == 8
    plain = arima.fit(known["walk"], got["walk"].p, 1, got["walk"].q, got["walk"].sp, got["walk"].sq, 8)
    assert got["walk"].aic == pytest.approx(plain["aic"]) and list(got["walk"].forecast) == pytest.approx(list(plain["forecast"]))
