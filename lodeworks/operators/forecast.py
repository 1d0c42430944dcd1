"""Rent-growth forecasts of submarket panels: features, one-step backtests of six models over every origin, full fits,
ensemble with bands and scenarios, the comparison with a vendor's forecast, and the diagnostics document.

A backtest doesn't refit: normal equations of all origins are running sums of cross products, one batch of small solves.
Each (market, model) is a task; the orders of ARIMA are tasks each (see `arima`). Everything after the models is
aggregation.

Defined cases: a null market is a market of its own; a market with fewer rows than a model needs has no row of that model;
an origin trains on the panel's rows before its number and is judged by the value with that number among those not null, so
the two differ where growth is missing at the start (as the rule to be matched has it)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import arima, diagnostics
from . import windows as win
from .diagnostics import _types, beside

ENDOG = ("rent_growth_yoy", "vacancy_rate", "deliveries_pct_inventory", "absorption_pct_inventory")
FEATURES = ("vacancy_rate_lag1", "deliveries_pct_inventory_lag1", "absorption_pct_inventory_lag1", "rent_growth_yoy_lag1", "uc_pct_inventory_lag1")
#: Rows a model needs, rows before the first origin, penalties and prior, boosting, bands, scenario quarters.
NEEDED, FIRST = 20, 40
RIDGE, NET_ALPHA, NET_RATIO = 6.0, 1.0, 0.5
TIGHT, CROSS, MOST_LAGS = 0.2, 0.5, 6
TREES, RATE, SHARE, LEAF = 50, 0.05, 0.8, 10
BAND, BANDS = 1.28, {80: 1.28, 95: 1.96}
MODELS = ("Naive", "ARIMA", "BVAR", "Ridge", "GBM", "ElasticNet")


def features(df: DataFrame, keys: list[str], at: str) -> DataFrame:
    """`df` with shares of the inventory (0 where unknown), growth and vacancy carried forward, and lags of a quarter."""
    w = Window.partitionBy(*keys).orderBy(at)
    share = lambda c: F.coalesce(F.col(c).cast("double") / F.nullif(F.col("inventory_units").cast("double"), F.lit(0.0)), F.lit(0.0))
    df = df.withColumns({
        "deliveries_pct_inventory": share("deliveries_12mo"), "absorption_pct_inventory": share("absorption_units_12mo"), "uc_pct_inventory": share("under_construction"),
        "rent_growth_yoy": win.ffill("effective_rent_growth_yoy", w), "vacancy_rate": win.ffill("vacancy_rate", w),
    })
    return df.withColumns({f: F.lag(f.removesuffix("_lag1")).over(w) for f in FEATURES})


# ----------------------------------------------------------------- models, all origins at once


class _Panel:
    """One market's rows in order, and what every origin trains on: rows before it."""

    def __init__(self, pdf: pd.DataFrame):
        self.endog, self.x = pdf[list(ENDOG)].to_numpy(float), pdf[list(FEATURES)].to_numpy(float)
        self.y = self.endog[:, 0]
        self.whole = ~np.isnan(self.x).any(1) & ~np.isnan(self.y)
        seen = ~np.isnan(self.x).any(1)
        last = np.maximum.accumulate(np.where(seen, np.arange(len(self.y)), -1))
        self.last = np.concatenate([[-1], last])  # the last row with features, before each origin

    def moments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows, means, centred cross products of features and target) of the whole rows before each origin."""
        z = np.column_stack([self.x, self.y])
        shift = z[self.whole].mean(0)
        z = np.where(self.whole[:, None], z - shift, 0.0)
        start = lambda a: np.concatenate([np.zeros_like(a[:1]), np.cumsum(a, 0)])
        n, s, p = start(self.whole.astype(float)), start(z), start(z[:, :, None] * z[:, None, :])
        m = s / np.maximum(n, 1)[:, None]
        return n, m + shift, p - n[:, None, None] * m[:, :, None] * m[:, None, :]


def _linear(panel: _Panel, origins: np.ndarray, solve) -> list[tuple]:
    """(origin, forecast, squared residuals, rows) by `solve`(centred products, rows) -> coefficients."""
    if panel.whole.sum() < NEEDED:
        return []
    n, mean, c = panel.moments()
    out = []
    for t in origins:
        if n[t] >= NEEDED and panel.last[t] >= 0:
            b = solve(c[t], n[t])
            ssr = c[t][-1, -1] - 2 * b @ c[t][:-1, -1] + b @ c[t][:-1, :-1] @ b
            out.append((t, mean[t][-1] + (panel.x[panel.last[t]] - mean[t][:-1]) @ b, max(0.0, ssr), int(n[t])))
    return out


def _ridge(panel: _Panel, origins: np.ndarray) -> list[tuple]:
    return _linear(panel, origins, lambda c, n: np.linalg.solve(c[:-1, :-1] + RIDGE * np.eye(len(FEATURES)), c[:-1, -1]))


def _elastic_net(panel: _Panel, origins: np.ndarray) -> list[tuple]:
    now = np.zeros(len(FEATURES))  # each origin starts from the one before

    def solve(c, n):
        for _ in range(5000):
            move = 0.0
            for j in range(len(now)):
                rho = (c[j, -1] - c[j, :-1] @ now + c[j, j] * now[j]) / n
                new = math.copysign(max(0.0, abs(rho) - NET_ALPHA * NET_RATIO), rho) / (c[j, j] / n + NET_ALPHA * (1 - NET_RATIO))
                move, now[j] = max(move, abs(new - now[j])), new
            if move < 1e-12:
                break
        return now.copy()

    return _linear(panel, origins, solve)


def _naive(panel: _Panel, origins: np.ndarray) -> list[tuple]:
    out = []
    for t in origins:
        v = panel.y[:t][~np.isnan(panel.y[:t])]
        if len(v) > 1:
            d = np.diff(v)
            out.append((t, v[-1], float(((d - d.mean()) ** 2).sum()), len(d)))
    return out


def bvar(endog: np.ndarray, ends: np.ndarray, horizon: int = 1, most: int = MOST_LAGS) -> list[tuple]:
    """Vector autoregressions of rows 0 to end - 1 for each of `ends`: (end, lags, forecasts of the first variable, its squared
    residuals, rows). Lags are chosen by AIC over the rows that the most lags leave; own lags shrink by their number, others
    by CROSS more and by the ratio of the variables' variances about a first-order autoregression."""
    n, k = endog.shape
    shift = endog.mean(0)
    e = endog - shift
    sums = {}
    for p in range(min(most, n - 1) + 1):
        z = np.hstack([e[p - i : n - i] for i in range(1, p + 1)] + [np.ones((n - p, 1)), e[p:]])
        sums[p] = np.concatenate([np.zeros((p + 1, z.shape[1], z.shape[1])), np.cumsum(z[:, :, None] * z[:, None, :], 0)])
    pair = np.stack([e[:-1], e[1:], e[:-1] ** 2, e[1:] ** 2, e[:-1] * e[1:]])
    pair = np.concatenate([np.zeros((5, 1, k)), np.cumsum(pair, 1)], 1)
    out = []
    for end in ends:
        if end < NEEDED:
            continue
        top = max(min(most, end // 5), 1)
        aic = []
        for p in range(top + 1):
            g, m = sums[p][end] - sums[p][top], k * p + 1
            beta = np.linalg.lstsq(g[:m, :m], g[:m, m:], rcond=None)[0]
            left = g[m:, m:] - g[m:, :m] @ beta
            sign, size = np.linalg.slogdet(left / (end - top))
            aic.append((size if sign > 0 else -math.inf) + 2 / (end - top) * (p * k * k + k))
        p = max(int(np.argmin(aic)), 1)
        s0, s1, q0, q1, q01 = pair[:, end - 1] / (end - 1)
        v0 = q0 - s0 * s0
        b = np.where(v0 > 0, (q01 - s0 * s1) / np.where(v0 > 0, v0, 1), 0.0)
        var = np.maximum(q1 - s1 * s1 - 2 * b * (q01 - s0 * s1) + b * b * v0, 0)
        var[var <= 1e-18] = 1e-10
        g, m = sums[p][end], k * p + 1
        coef = np.zeros((m, k))
        for eq in range(k):
            other = np.where(np.arange(k) == eq, 1.0, var[eq] / var / CROSS**2)
            penalty = np.concatenate([(np.arange(1, p + 1)[:, None] / TIGHT) ** 2 * other, np.zeros((0, k))]).ravel()
            # Values are centred, which changes the constant only; the constant isn't penalised.
            coef[:, eq] = np.linalg.solve(g[:m, :m] + np.diag(np.append(penalty, 0.0)), g[:m, m + eq])
        ssr = g[m, m] - 2 * coef[:, 0] @ g[:m, m] + coef[:, 0] @ g[:m, :m] @ coef[:, 0]
        past, ahead = list(e[end - p : end]), []
        for _ in range(horizon):
            past.append(np.append(np.concatenate(past[: -p - 1 : -1]), 1.0) @ coef)
            ahead.append(past[-1][0] + shift[0])
        out.append((end, p, np.array(ahead), max(0.0, float(ssr)), end - p))
    return out


def _bvar(panel: _Panel, origins: np.ndarray) -> list[tuple]:
    ok = ~np.isnan(panel.endog).any(1)
    if ok.sum() < NEEDED:
        return []
    before = np.concatenate([[0], np.cumsum(ok)])
    found = {end: r for end, *r in bvar(panel.endog[ok], np.unique(before[origins]))}
    return [(t, found[before[t]][1][0], found[before[t]][2], found[before[t]][3]) for t in origins if before[t] in found]


def boosted(x: np.ndarray, y: np.ndarray, now: np.ndarray, seed: int = 7) -> tuple[float, np.ndarray]:
    """Gradient boosting of trees of depth 2 on squared error, each on a share of the rows drawn with a fixed seed, leaves of
    LEAF rows at least: (value at `now`, fitted values)."""
    rng, n = np.random.default_rng(seed), len(y)
    fitted, value = np.full(n, y.mean()), float(y.mean())

    def split(rows: np.ndarray, r: np.ndarray) -> tuple[int, float] | None:
        best = None
        for j in range(x.shape[1]):
            order = rows[np.argsort(x[rows, j], kind="stable")]
            v, total = x[order, j], np.cumsum(r[order])
            left = np.arange(1, len(order))
            gain = total[:-1] ** 2 / left + (total[-1] - total[:-1]) ** 2 / (len(order) - left)
            gain = np.where((v[1:] > v[:-1]) & (left >= LEAF) & (len(order) - left >= LEAF), gain, -np.inf)
            if len(gain) and gain.max() > (best[0] if best else total[-1] ** 2 / len(order) + 1e-15):
                i = int(gain.argmax())
                best = (float(gain[i]), j, float((v[i] + v[i + 1]) / 2))
        return best and best[1:]

    def grow(rows: np.ndarray, r: np.ndarray, depth: int, own: np.ndarray, here: bool) -> None:
        nonlocal value
        cut = split(rows, r) if depth else None
        if cut is None:
            leaf = RATE * float(r[rows].mean())
            fitted[own] += leaf
            value += leaf * here
            return
        j, at = cut
        for low in (True, False):
            grow(rows[(x[rows, j] <= at) == low], r, depth - 1, own[(x[own, j] <= at) == low], here and (now[j] <= at) == low)

    for _ in range(TREES):
        r = y - fitted
        grow(np.sort(rng.choice(n, max(1, int(SHARE * n)), replace=False)), r, 2, np.arange(n), True)
    return value, fitted


def _gbm(panel: _Panel, origins: np.ndarray) -> list[tuple]:
    out = []
    for t in origins:
        rows = np.flatnonzero(panel.whole[:t])
        if len(rows) >= NEEDED and panel.last[t] >= 0:
            value, fitted = boosted(panel.x[rows], panel.y[rows], panel.x[panel.last[t]])
            e = panel.y[rows] - fitted
            out.append((t, value, float(((e - e.mean()) ** 2).sum()), len(rows)))
    return out


_WALKS = {"Naive": _naive, "BVAR": _bvar, "Ridge": _ridge, "GBM": _gbm, "ElasticNet": _elastic_net}


# ----------------------------------------------------------------- backtest


def backtest(panel: DataFrame, keys: list[str], at: str, models: tuple[str, ...] = MODELS, first: int = FIRST, orders: tuple[int, int, tuple] = (3, 3, arima.SEASONAL)) -> DataFrame:
    """One-step forecasts of every model at all origins from number `first` on: (keys, model, at, actual, predicted, lo, hi), the
    band being 1.28 deviations of the residuals in the sample. `panel` has the columns of `features`."""
    cols = list(dict.fromkeys([*ENDOG, *FEATURES]))
    names = [*keys, "model", at, "actual", "predicted", "lo", "hi"]
    plain = [m for m in models if m != "ARIMA"]
    at_type = dict(panel.dtypes)[at]

    def run(group, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(at)
        p, when = _Panel(pdf), pdf[at].to_numpy()
        known = np.flatnonzero(~np.isnan(p.y))
        rows = []
        for t, value, ssr, n in _WALKS[group[-1]](p, np.arange(first, len(known))):
            sd = math.sqrt(ssr / (n - 1)) if n > 1 else math.nan
            rows.append([*group, when[known[t]], p.y[known[t]], value, value - BAND * sd, value + BAND * sd])
        return pd.DataFrame(rows, columns=names)

    out = None
    if plain:
        each = panel.select(*keys, at, *(F.col(c).cast("double").alias(c) for c in cols)).withColumn("model", F.explode(F.array(*map(F.lit, plain))))
        out = each.groupBy(*keys, "model").applyInPandas(run, f"{_types(panel, keys)}, model string, {at} {at_type}, actual double, predicted double, lo double, hi double")
    if "ARIMA" in models:
        w = Window.partitionBy(*keys).orderBy(at)
        s = panel.select(*keys, at, F.col(ENDOG[0]).cast("double").alias("actual"), (F.row_number().over(w) - 1).alias("row"))
        s = s.where("actual IS NOT NULL").withColumn("i", F.row_number().over(w) - 1).withColumn("n", F.count("*").over(Window.partitionBy(*keys)))
        # A row trains all origins after its own number.
        train = s.where(f"n > {first}").withColumn("origin", F.explode(F.sequence(F.greatest(F.col("row") + 1, F.lit(first)), F.greatest(F.col("n") - 1, F.col("row") + 1, F.lit(first))))).where("origin < n")
        found = arima.best(arima.search(train, [*keys, "origin"], at, "actual", orders[0], orders[1], seasonal=orders[2], horizon=1), [*keys, "origin"])
        held = s.select(*keys, F.col("i").alias("origin"), F.col(at).alias("_at"), "actual")
        value = F.get("forecast", F.lit(0))
        one = beside(found, held, [*keys, "origin"]).select(*keys, F.lit("ARIMA").alias("model"), F.col("_at").alias(at), "actual", value.alias("predicted"), (value - BAND * F.col("sd")).alias("lo"), (value + BAND * F.col("sd")).alias("hi"))
        out = one if out is None else out.unionByName(one)
    return out


def full_fit(panel: DataFrame, keys: list[str], at: str, horizon: int = 8, models: tuple[str, ...] = MODELS, orders: tuple[int, int, tuple] = (3, 3, arima.SEASONAL)) -> DataFrame:
    """Every model fitted to all rows: (keys, model, h, predicted, n, ssr), h from 1, with the residuals' number and squares.
    Models of features forecast one value for all quarters ahead."""
    cols = list(dict.fromkeys([*ENDOG, *FEATURES]))
    names = [*keys, "model", "h", "predicted", "n", "ssr"]

    def run(group, pdf: pd.DataFrame) -> pd.DataFrame:
        p = _Panel(pdf.sort_values(at))
        end, model = len(p.y), group[-1]
        if model == "BVAR":
            ok = ~np.isnan(p.endog).any(1)
            got = [(ahead, ssr, n) for _, _, ahead, ssr, n in bvar(p.endog[ok], np.array([ok.sum()]), horizon)] if ok.any() else []
        else:
            got = [(np.full(horizon, value), ssr, n) for _, value, ssr, n in _WALKS[model](p, np.array([end]))]
        return pd.DataFrame([[*group, h + 1, float(ahead[h]), n, ssr] for ahead, ssr, n in got for h in range(horizon)], columns=names)

    plain = [m for m in models if m != "ARIMA"]
    each = panel.select(*keys, at, *(F.col(c).cast("double").alias(c) for c in cols)).withColumn("model", F.explode(F.array(*map(F.lit, plain))))
    out = each.groupBy(*keys, "model").applyInPandas(run, f"{_types(panel, keys)}, model string, h int, predicted double, n long, ssr double")
    if "ARIMA" in models:
        found = arima.best(arima.search(panel, keys, at, ENDOG[0], orders[0], orders[1], seasonal=orders[2], horizon=horizon), keys)
        found = beside(found, panel.where(F.col(ENDOG[0]).isNotNull()).groupBy(*keys).agg(F.count("*").alias("_n")), keys)
        n = F.col("_n") - F.col("d")
        out = out.unionByName(found.select(*keys, F.lit("ARIMA").alias("model"), F.posexplode("forecast").alias("h", "predicted"), n.alias("n"), (F.col("sd") * F.col("sd") * (n - 1)).alias("ssr")).withColumn("h", F.col("h") + 1))
    return out


def combined(fits: DataFrame, accuracy: DataFrame, keys: list[str]) -> DataFrame:
    """The ensemble of full fits, weighted by the inverse backtest RMSE, without Naive: (keys, h, predicted, lo80, hi80, lo95,
    hi95, bear, bull). Bands are deviations of all residuals pooled times the root of h, scenarios the mean RMSE times it."""
    by = [*keys, "model"]
    rmse = accuracy.where("model <> 'Naive' AND rmse > 0").select(*by, "rmse")
    f = beside(fits, rmse, by)
    # Residuals have mean 0, or nearly so: their squares pool.
    g = f.groupBy(*keys, "h").agg(
        (F.sum(F.col("predicted") / F.col("rmse")) / F.sum(1 / F.col("rmse"))).alias("predicted"), F.sqrt(F.sum("ssr") / F.sum("n")).alias("sd"), F.avg("rmse").alias("rmse"),
    )
    root = F.sqrt(F.col("h").cast("double"))
    bands = [(F.col("predicted") + s * z * F.col("sd") * root).alias(f"{n}{p}") for p, z in BANDS.items() for n, s in (("lo", -1), ("hi", 1))]
    return g.select(*keys, "h", "predicted", *bands, (F.col("predicted") - F.col("rmse") * root).alias("bear"), (F.col("predicted") + F.col("rmse") * root).alias("bull"))


def against_vendor(fits: DataFrame, accuracy: DataFrame, vendor: DataFrame, keys: list[str]) -> DataFrame:
    """How far each model pulls the ensemble from the vendor's forecast (keys, h, vendor): (keys, model, weight, mean, spread,
    contribution, direction) over the quarters that the vendor has; model `Ensemble` sums up."""
    by = [*keys, "model"]
    rmse = accuracy.where("model <> 'Naive' AND rmse > 0").select(*by, "rmse")
    v = vendor.where("vendor IS NOT NULL").select(*keys, "h", F.col("vendor").cast("double").alias("vendor"))
    f = beside(beside(fits, rmse, by), v, [*keys, "h"])
    g = f.groupBy(*by).agg(F.avg("predicted").alias("mean"), F.avg("vendor").alias("vendor"), (1 / F.first("rmse")).alias("inverse"))
    total = Window.partitionBy(*keys)
    g = g.withColumn("weight", F.col("inverse") / F.sum("inverse").over(total)).withColumn("spread", F.col("mean") - F.col("vendor")).withColumn("contribution", F.col("weight") * F.col("spread"))
    whole = g.groupBy(*keys).agg(F.sum("weight").alias("weight"), F.sum(F.col("weight") * F.col("mean")).alias("mean"), F.sum("contribution").alias("spread"), F.sum("contribution").alias("contribution"))
    out = g.select(*by, "weight", "mean", "spread", "contribution").unionByName(whole.select(*keys, F.lit("Ensemble").alias("model"), "weight", "mean", "spread", "contribution"))
    return out.withColumn("direction", F.when(F.col("spread") > 0, "BULL").otherwise("BEAR"))


def yearly(path: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Means of whole groups of four quarters ahead: (keys, year from 1, columns); missing values don't count in theirs."""
    year = F.floor((F.col("h") - 1) / 4).cast("int") + 1
    g = path.groupBy(*keys, year.alias("year")).agg(F.count("*").alias("n"), *(F.avg(c).alias(c) for c in columns))
    return g.where("n = 4").drop("n")


def document(bt: DataFrame, panel: DataFrame, keys: list[str], at: str) -> DataFrame:
    """(keys, document): per market the accuracy and weight of every model, the ensemble's RMSE (the models' mean), the growth's
    deviation, the confidence drawn from both, and whether the last quarters left their regime, as JSON."""
    acc = diagnostics.accuracy(bt, keys, at)
    dm = diagnostics.diebold_mariano(bt, keys, at)
    by = [*keys, "model"]
    dm = dm.select(*by, F.col("statistic").alias("dm_statistic"), F.col("p").alias("dm_p"))
    counted = (F.col("model") != "Naive") & (F.col("rmse") > 0)
    inverse = F.when(counted, 1 / F.col("rmse"))
    m = beside(acc, dm, by, "left")
    m = m.withColumn("weight", F.coalesce(inverse / F.sum(inverse).over(Window.partitionBy(*keys)), F.lit(0.0)))
    fields = ["n", "rmse", "mae", "bias", "acf1", "ljung_box_p", "coverage", "weight", "dm_statistic", "dm_p"]
    g = m.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("model", F.struct(*fields))))).alias("models"), F.avg(F.when(counted, F.col("rmse"))).alias("ensemble_rmse"))
    growth = panel.where("rent_growth_yoy IS NOT NULL")
    w = Window.partitionBy(*keys).orderBy(F.desc(at))
    growth = growth.withColumn("_back", F.row_number().over(w))
    five = F.when(F.col("_back") <= 20, F.col("rent_growth_yoy"))
    s = growth.groupBy(*keys).agg(F.stddev_samp("rent_growth_yoy").alias("yoy_std"), F.avg(five).alias("mean"), F.stddev_samp(five).alias("sd"), F.count("*").alias("n"), F.collect_list(F.when(F.col("_back") <= 4, F.col("rent_growth_yoy"))).alias("recent"))
    s = s.select(*keys, "yoy_std", F.coalesce((F.col("n") >= 20) & (F.col("sd") > 0) & F.exists("recent", lambda x: F.abs(x - F.col("mean")) > 2 * F.col("sd")), F.lit(False)).alias("regime_change"))
    g = beside(g, s, keys)
    ratio = F.col("ensemble_rmse") / F.nullif(F.col("yoy_std"), F.lit(0.0))
    level = F.when(ratio < 0.5, "High").when(ratio < 1.0, "Medium").otherwise("Low")
    return g.select(*keys, F.to_json(F.struct("models", F.struct("ensemble_rmse", "yoy_std", level.alias("confidence_level"), "regime_change").alias("ensemble"))).alias("document"))
