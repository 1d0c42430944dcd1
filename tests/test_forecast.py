"""Backtests, full fits, ensemble and documents of panels against plain refits."""

from __future__ import annotations

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodeworks.operators import arima, diagnostics, forecast, models

ONE = (1, 1, ((0, 0),))  # a small search of orders


def market(seed, n):
    rng = np.random.default_rng(seed)
    g, v = np.zeros(n), np.full(n, 0.07)
    for t in range(1, n):
        v[t] = 0.9 * v[t - 1] + 0.007 + rng.normal() * 0.003
        g[t] = 0.7 * g[t - 1] - 0.2 * (v[t - 1] - 0.07) + 0.01 + rng.normal() * 0.01
    return [(i, float(g[i]), float(v[i]), float(rng.integers(0, 40)), float(rng.integers(-10, 50)), float(rng.integers(0, 60)), 1000.0 + 5 * i) for i in range(n)]


def with_gaps(rows):
    """No growth in the first three quarters and in one later, no vacancy in two, no inventory in one."""
    out = [list(r) for r in rows]
    for i in (0, 1, 2, 20):
        out[i][1] = None
    out[4][2] = out[30][2] = out[10][6] = None
    return out


COLUMNS = "q int, effective_rent_growth_yoy double, vacancy_rate double, deliveries_12mo double, absorption_units_12mo double, under_construction double, inventory_units double"


@pytest.fixture(scope="module")
def panel(spark):
    rows = [("a", *r) for r in market(1, 60)] + [(None, *r) for r in with_gaps(market(2, 55))] + [("short", *r) for r in market(3, 15)]
    return forecast.features(spark.createDataFrame(rows, f"market string, {COLUMNS}"), ["market"], "q").cache()


@pytest.fixture(scope="module")
def arrays(panel):
    out = {}
    for r in panel.orderBy("q").collect():
        out.setdefault(r.market, []).append([r[c] if r[c] is not None else math.nan for c in dict.fromkeys([*forecast.ENDOG, *forecast.FEATURES])])
    return {k: np.array(v, float) for k, v in out.items()}


@pytest.fixture(scope="module")
def bt(panel):
    return forecast.backtest(panel, ["market"], "q", orders=ONE).cache()


def test_features(panel, arrays):
    a = arrays[None]
    assert np.isnan(a[:3, 0]).all() and a[20, 0] == a[19, 0] and a[30, 1] == a[29, 1] and a[10, 2] == 0
    assert np.allclose(a[1:, 4], a[:-1, 1], equal_nan=True) and np.isnan(a[0, 4:]).all()


def plain_ridge(train):
    x, y = train[:, 4:], train[:, 0]
    ok = ~np.isnan(train[:, 4:]).any(1) & ~np.isnan(y)
    xm, ym = x[ok].mean(0), y[ok].mean()
    b = np.linalg.solve((x[ok] - xm).T @ (x[ok] - xm) + 6 * np.eye(5), (x[ok] - xm).T @ (y[ok] - ym))
    last = x[~np.isnan(x).any(1)][-1]
    return ym + (last - xm) @ b, y[ok] - ym - (x[ok] - xm) @ b


def plain_net(train):
    x, y = train[:, 4:], train[:, 0]
    ok = ~np.isnan(train[:, 4:]).any(1) & ~np.isnan(y)
    b, c = models.elastic_net(x[ok], y[ok])
    return x[~np.isnan(x).any(1)][-1] @ b + c, y[ok] - x[ok] @ b - c


def plain_bvar(train, horizon=1):
    y = train[:, :4][~np.isnan(train[:, :4]).any(1)]
    n, k = y.shape
    most = max(min(6, n // 5), 1)

    def design(p, start):
        return np.array([[*np.concatenate([y[t - i] for i in range(1, p + 1)] or [[]]), 1.0] for t in range(start, n)])

    aic = []
    for p in range(most + 1):
        x = design(p, most)
        beta, *_ = np.linalg.lstsq(x, y[most:], rcond=None)
        e = y[most:] - x @ beta
        aic.append(np.linalg.slogdet(e.T @ e / (n - most))[1] + 2 / (n - most) * (p * k * k + k))
    p = max(int(np.argmin(aic)), 1)
    var = []
    for i in range(k):
        a, b = y[1:, i], y[:-1, i]
        slope = np.cov(a, b, ddof=0)[0, 1] / b.var()
        var.append((a - slope * b).var())
    x, coefs = design(p, p), []
    for eq in range(k):
        pen = np.array([(lag / 0.2) ** 2 if v == eq else (lag / 0.1) ** 2 * var[eq] / var[v] for lag in range(1, p + 1) for v in range(k)] + [0.0])
        coefs.append(np.linalg.solve(x.T @ x + np.diag(pen), x.T @ y[p:, eq]))
    past = list(y)
    for _ in range(horizon):
        past.append(np.array([np.concatenate([*(past[-i] for i in range(1, p + 1)), [1.0]]) @ c for c in coefs]))
    return [r[0] for r in past[n:]], y[p:, 0] - x @ coefs[0]


def plain_naive(train):
    v = train[:, 0][~np.isnan(train[:, 0])]
    return v[-1], np.diff(v)


def test_backtest_equals_refits(bt, arrays):
    rows = {(r.market, r.model, r.q): r for r in bt.collect()}
    plain = {"Naive": plain_naive, "Ridge": plain_ridge, "ElasticNet": plain_net, "BVAR": lambda a: (plain_bvar(a)[0][0], plain_bvar(a)[1])}
    for k in ("a", None):
        a = arrays[k]
        known = np.flatnonzero(~np.isnan(a[:, 0]))
        assert len([1 for m, model, _ in rows if m == k]) == 6 * (len(known) - 40)  # every origin, every model
        for t in range(40, len(known)):
            for model, f in plain.items():
                value, e = f(a[:t])
                r, sd = rows[k, model, int(known[t])], np.std(e, ddof=1)
                assert r.actual == a[known[t], 0] and r.predicted == pytest.approx(value, rel=1e-6, abs=1e-9)
                assert (r.lo, r.hi) == pytest.approx((value - 1.28 * sd, value + 1.28 * sd), rel=1e-5, abs=1e-8)
    assert not [m for m, *_ in rows if m == "short"]


def test_backtest_of_arima(bt, arrays, spark):
    """An origin's order and forecast are those of a search over the rows before it."""
    t = 47
    y = arrays["a"][:t, 0]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(y)], "q int, y double").withColumn("m", F.lit("x"))
    best = arima.best(arima.search(df, ["m"], "q", "y", *ONE[:2], seasonal=ONE[2], horizon=1), ["m"]).first()
    r = bt.where(f"market = 'a' AND model = 'ARIMA' AND q = {t}").first()
    assert r.predicted == pytest.approx(best.forecast[0]) and r.hi - r.predicted == pytest.approx(1.28 * best.sd)


def test_boosted():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 5))
    y = np.where(x[:, 2] > 0.3, 2.0, -1.0) + 0.05 * rng.normal(size=200)
    for at, want in ((1.0, 2.0), (-1.0, -1.0)):
        now = np.zeros(5)
        now[2] = at
        value, fitted = forecast.boosted(x, y, now)
        assert abs(value - want) < 0.3 and np.corrcoef(fitted, y)[0, 1] > 0.98
        assert forecast.boosted(x, y, now)[0] == value
    value, fitted = forecast.boosted(x[:15], y[:15], now)  # no split leaves ten rows on both sides
    assert np.ptp(fitted) < 1e-12 and value == pytest.approx(fitted[0])


def test_full_fit_and_ensemble(panel, bt, arrays):
    fits = forecast.full_fit(panel, ["market"], "q", orders=ONE).cache()
    got = {(r.market, r.model, r.h): r for r in fits.collect()}
    assert {m for k, m, _ in got if k == "a"} == set(forecast.MODELS) and {h for *_, h in got} == set(range(1, 9))
    ahead, e = plain_bvar(arrays["a"], 8)
    assert [got["a", "BVAR", h].predicted for h in range(1, 9)] == pytest.approx(ahead, rel=1e-6) and got["a", "BVAR", 1].ssr == pytest.approx(float(e @ e), rel=1e-6)
    assert len({got["a", "Ridge", h].predicted for h in range(1, 9)}) == 1 and got["a", "Ridge", 1].predicted == pytest.approx(plain_ridge(arrays["a"])[0])
    acc = diagnostics.accuracy(bt, ["market"], "q").cache()
    rmse = {r.model: r.rmse for r in acc.where("market = 'a'").collect()}
    inv = {m: 1 / v for m, v in rmse.items() if m != "Naive"}
    path = {r.h: r for r in forecast.combined(fits, acc, ["market"]).where("market = 'a'").collect()}
    sd = math.sqrt(sum(got["a", m, 1].ssr for m in inv) / sum(got["a", m, 1].n for m in inv))
    for h, r in path.items():
        want = sum(got["a", m, h].predicted * w for m, w in inv.items()) / sum(inv.values())
        assert r.predicted == pytest.approx(want) and r.hi80 - r.predicted == pytest.approx(1.28 * sd * math.sqrt(h)) and r.predicted - r.lo95 == pytest.approx(1.96 * sd * math.sqrt(h))
        assert r.bull - r.predicted == pytest.approx(np.mean([rmse[m] for m in inv]) * math.sqrt(h)) == pytest.approx(r.predicted - r.bear)
    vendor = fits.where("model = 'Naive'").select("market", "h", F.when(F.col("h") != 3, 0.01 * F.col("h")).alias("vendor"))
    pull = {r.model: r for r in forecast.against_vendor(fits, acc, vendor, ["market"]).where("market = 'a'").collect()}
    hs = [h for h in range(1, 9) if h != 3]
    spread = np.mean([path[h].predicted for h in hs]) - np.mean([0.01 * h for h in hs])
    assert pull["Ensemble"].spread == pytest.approx(spread) == pytest.approx(sum(pull[m].contribution for m in inv)) and pull["Ensemble"].direction == ("BULL" if spread > 0 else "BEAR")
    years = forecast.yearly(forecast.combined(fits, acc, ["market"]), ["market"], ["predicted"]).where("market = 'a'").orderBy("year").collect()
    assert [y.year for y in years] == [1, 2] and years[1].predicted == pytest.approx(np.mean([path[h].predicted for h in range(5, 9)]))


def test_document(panel, bt):
    docs = {r.market: json.loads(r.document) for r in forecast.document(bt, panel, ["market"], "q").collect()}
    assert set(docs) == {"a", None}
    for d in docs.values():
        assert set(d["models"]) == set(forecast.MODELS) and sum(m["weight"] for m in d["models"].values()) == pytest.approx(1) and d["models"]["Naive"]["weight"] == 0
        assert d["ensemble"]["confidence_level"] in ("High", "Medium", "Low") and d["ensemble"]["regime_change"] in (True, False) and "dm_p" in d["models"]["BVAR"]
