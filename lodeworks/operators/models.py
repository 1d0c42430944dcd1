"""Small statistical models over panels: least squares from sums, ridge, vector autoregression, backtests, ensembles.

Sums and cross products are aggregated by Spark; what is sequential (a refit at every origin) runs per group in numpy,
groups being (market, model), of a few hundred rows. No library beyond numpy is used. Models of whole panels
are in `forecast`, seasonal ARIMA in `arima`, tests of series in `diagnostics`."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Prior tightness, cross-variable shrinkage (fixed values).
TIGHT, CROSS = 0.2, 0.5
BANDS = {80: 1.28, 95: 1.96}
#: Rows that one task trains trees on (fixed value).
TASK_ROWS = 100_000


def ols(df: DataFrame, keys: list[str], y: str, xs: list[str], least: int = 8) -> DataFrame:
    """Coefficients by group from one pass of sums and cross products; columns that are constant get 0; fewer than `least`
    complete rows give none. (keys, n, intercept, one column a feature, r2, low_confidence)"""
    cols = [y, *xs]
    ok = df.dropna(subset=cols).select(*keys, *(F.col(c).cast("double") for c in cols))
    sums = [F.sum(c).alias(f"s_{i}") for i, c in enumerate(cols)] + [F.sum(F.col(a) * F.col(b)).alias(f"p_{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if j >= i]
    g = ok.groupBy(*keys).agg(F.count("*").alias("n"), *sums).where(F.col("n") >= least)
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in g.schema if f.name in keys), "n long", "intercept double", *(f"{x} double" for x in xs), "r2 double", "low_confidence boolean"])
    m = len(cols)

    def solve(batches):
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                n = r["n"]
                s = np.array([r[f"s_{i}"] for i in range(m)])
                c = np.array([[r[f"p_{min(i, j)}_{max(i, j)}"] for j in range(m)] for i in range(m)]) - np.outer(s, s) / n
                used = [i for i in range(1, m) if c[i, i] > 1e-9 * max(1.0, r[f"p_{i}_{i}"])]
                b = np.zeros(m)
                if used:
                    b[used] = np.linalg.lstsq(c[np.ix_(used, used)], c[used, 0], rcond=None)[0]
                fit = float(b[1:] @ c[1:, 0])
                rows.append([*(r[k] for k in keys), n, (s[0] - b[1:] @ s[1:]) / n, *b[1:], fit / c[0, 0] if c[0, 0] > 0 else None, n < 20])
            yield pd.DataFrame(rows, columns=[*keys, "n", "intercept", *xs, "r2", "low_confidence"])

    return g.mapInPandas(solve, schema)


def trendline(df: DataFrame, keys: list[str], y: str, x: str) -> DataFrame:
    """Slope and intercept by group; none for fewer than two points."""
    g = df.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_count(y, x).alias("n"))
    return g.where("n >= 2").select(*keys, F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"), "n")


def ridge_fit(x: np.ndarray, y: np.ndarray, alphas: tuple[float, ...]) -> tuple[np.ndarray, float, float]:
    """Ridge on standardised features and a centred target; alpha by leave-one-out in closed form: (beta in the features'
    own units, intercept, alpha)."""
    mu, sd = x.mean(0), x.std(0)
    sd = np.where(sd > 0, sd, 1.0)
    z, c = (x - mu) / sd, y - y.mean()
    u, s, _ = np.linalg.svd(z, full_matrices=False)
    best = None
    for a in alphas:
        h = (u * (s**2 / (s**2 + a))) @ u.T
        e = (c - h @ c) / np.maximum(1e-9, 1 - np.diag(h) - 1 / len(y))
        if best is None or (e @ e) < best[0]:
            best = (float(e @ e), a)
    beta = np.linalg.solve(z.T @ z + best[1] * np.eye(z.shape[1]), z.T @ c) / sd
    return beta, float(y.mean() - mu @ beta), best[1]


def elastic_net(x: np.ndarray, y: np.ndarray, alpha: float = 1.0, ratio: float = 0.5, rounds: int = 500) -> tuple[np.ndarray, float]:
    """Coordinate descent on unscaled features: 1/2n |y - xb|^2 + alpha (ratio |b|_1 + (1 - ratio)/2 |b|^2)."""
    mu, n = x.mean(0), len(y)
    z, c = x - mu, y - y.mean()
    b = np.zeros(x.shape[1])
    norm = (z * z).sum(0) / n
    r = c.copy()
    for _ in range(rounds):
        move = 0.0
        for j in range(len(b)):
            rho = z[:, j] @ r / n + norm[j] * b[j]
            new = math.copysign(max(0.0, abs(rho) - alpha * ratio), rho) / (norm[j] + alpha * (1 - ratio)) if norm[j] > 0 else 0.0
            if new != b[j]:
                r -= z[:, j] * (new - b[j])
                move = max(move, abs(new - b[j]))
                b[j] = new
        if move < 1e-10:
            break
    return b, float(y.mean() - mu @ b)


def minnesota(series: np.ndarray, lags: int) -> np.ndarray:
    """Equation-wise penalised vector autoregression: own lags shrink by 1/lag, others by CROSS more; (1 + k lags, k)."""
    t, k = series.shape
    x = np.hstack([np.ones((t - lags, 1))] + [series[lags - i - 1 : t - i - 1] for i in range(lags)])
    y = series[lags:]
    sd = np.maximum(series.std(0, ddof=1), 1e-9)
    out = np.zeros((1 + k * lags, k))
    for eq in range(k):
        pen, centre = np.zeros(1 + k * lags), np.zeros(1 + k * lags)
        for i in range(lags):
            for v in range(k):
                tight = TIGHT / (i + 1) * (1.0 if v == eq else CROSS * sd[eq] / sd[v])
                pen[1 + i * k + v] = (sd[eq] / tight) ** 2 / max(1.0, t)
        centre[1 + eq] = 1.0
        out[:, eq] = np.linalg.lstsq(x.T @ x + np.diag(pen), x.T @ y[:, eq] + pen * centre, rcond=None)[0]
    return out


def _lagged(values: np.ndarray, lags: int) -> tuple[np.ndarray, np.ndarray]:
    x = np.column_stack([values[lags - i - 1 : len(values) - i - 1] for i in range(lags)])
    return x, values[lags:]


def _forecast(model: str, train: np.ndarray, lags: int = 4) -> float:
    """One step ahead. Models: Naive, Mean, AR (least squares), Ridge, ElasticNet, BVAR."""
    if model == "Naive" or len(train) < lags + 4:
        return float(train[-1])
    if model == "Mean":
        return float(train.mean())
    if model == "BVAR":
        both = np.column_stack([train[1:], np.diff(train)])
        b = minnesota(both, 2)
        return float(np.concatenate([[1.0], both[-1], both[-2]]) @ b[:, 0])
    x, y = _lagged(train, lags)
    now = train[::-1][:lags]
    if model == "Ridge":
        beta, c, _ = ridge_fit(x, y, (0.1, 1.0, 6.0, 10.0, 100.0))
    elif model == "ElasticNet":
        beta, c = elastic_net(x, y)
    else:
        sol = np.linalg.lstsq(np.column_stack([np.ones(len(y)), x]), y, rcond=None)[0]
        beta, c = sol[1:], float(sol[0])
    return float(now @ beta + c)


MODELS = ("Naive", "Mean", "AR", "Ridge", "ElasticNet", "BVAR")


def backtest(df: DataFrame, keys: list[str], at: str, y: str, models: tuple[str, ...] = MODELS, least: int = 12, most: int | None = None) -> DataFrame:
    """Expanding-window one-step forecasts: every (group, model) is a task of its own, refit at every origin
    that leaves `least` rows to learn from, or the last `most` of them: (keys, model, at, actual, predicted, lo, hi)."""
    names = F.explode(F.array(*map(F.lit, models)))
    key_types = [f"{f.name} {f.dataType.simpleString()}" for f in df.schema if f.name in keys]
    schema = ", ".join([*key_types, "model string", f"{at} long", "actual double", "predicted double", "lo double", "hi double"])

    def run(group, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna(subset=[y]).sort_values(at)
        v, when = pdf[y].to_numpy(float), pdf[at].to_numpy()
        rows, errors = [], []
        for i in range(least if most is None else max(least, len(v) - most), len(v)):
            p = _forecast(group[-1], v[:i])
            sd = float(np.std(errors)) if len(errors) > 1 else float(np.std(np.diff(v[:i])))
            rows.append([*group[:-1], group[-1], int(when[i]), v[i], p, p - 1.28 * sd, p + 1.28 * sd])
            errors.append(v[i] - p)
        return pd.DataFrame(rows, columns=[*keys, "model", at, "actual", "predicted", "lo", "hi"])

    return df.select(*keys, at, y).withColumn("model", names).groupBy(*keys, "model").applyInPandas(run, schema)


def metrics(bt: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Per model: n, RMSE, MAE, bias, lag-1 autocorrelation of errors, share of actuals within the band."""
    w = Window.partitionBy(*keys, "model").orderBy(at)
    e = bt.withColumn("e", F.col("actual") - F.col("predicted")).withColumn("e1", F.lag("e").over(w))
    return e.groupBy(*keys, "model").agg(
        F.count("*").alias("n"), F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"), F.avg(F.abs("e")).alias("mae"), F.avg("e").alias("bias"),
        (F.covar_samp("e", "e1") / F.nullif(F.stddev_samp(F.when(F.col("e1").isNotNull(), F.col("e"))) * F.stddev_samp("e1"), F.lit(0.0))).alias("acf1"), F.avg(F.col("actual").between(F.col("lo"), F.col("hi")).cast("double")).alias("coverage"),
    )


def ensemble(forecasts: DataFrame, weights: DataFrame, keys: list[str], at: str, sigma: float) -> DataFrame:
    """Inverse-RMSE weighted forecast with 80/95 % bands of sigma sqrt(h)."""
    h = F.row_number().over(Window.partitionBy(*keys).orderBy(at))
    mean = F.sum(F.col("predicted") * F.col("weight")) / F.nullif(F.sum("weight"), F.lit(0.0))
    g = forecasts.join(weights.select(*keys, "model", "weight"), [*keys, "model"]).groupBy(*keys, at).agg(mean.alias("predicted")).withColumn("h", h)
    bands = [(F.col("predicted") + s * z * sigma * F.sqrt("h")).alias(f"{n}{p}") for p, z in BANDS.items() for n, s in (("lo", -1), ("hi", 1))]
    return g.select(*keys, at, "predicted", *bands)


def scenarios(df: DataFrame, keys: list[str], at: str, growth: str, rmse: float) -> DataFrame:
    """Bear, base and bull paths of an index: growth less, as is, plus RMSE, compounded a quarter at a time."""
    from .windows import compound

    three = F.explode(F.array(*(F.struct(F.lit(n).alias("scenario"), F.lit(d).alias("d")) for n, d in (("bear", -rmse), ("base", 0.0), ("bull", rmse)))))
    long = df.select(*keys, at, growth, three.alias("s")).select(*keys, at, growth, "s.*")
    w = Window.partitionBy(*keys, "scenario").orderBy(at)
    return long.withColumn("level", compound(F.col(growth) + F.col("d"), w)).drop("d")


def jarque_bera(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Statistic and p-value (chi-square with two degrees: exp(-x/2))."""
    g = df.groupBy(*keys).agg(F.count(value).alias("n"), F.skewness(value).alias("s"), F.kurtosis(value).alias("k"))
    jb = F.col("n") / 6 * (F.col("s") * F.col("s") + F.col("k") * F.col("k") / 4)
    return g.select(*keys, "n", F.round(jb, 4).alias("jb"), F.round(F.exp(-jb / 2), 6).alias("p"))


def confidence(rmse, sd):
    """High, Medium or Low by an error's size against the series' deviation; Low for a series without any."""
    return F.when(sd <= 0, "Low").when(rmse < 0.5 * sd, "High").when(rmse < sd, "Medium").otherwise("Low")


def cascade(df: DataFrame, key: str, at: str, tier: str, y: str, tiers: tuple[str, ...], alphas: tuple[float, ...] = (0.1, 1.0, 10.0), least: int = 12) -> DataFrame:
    """Tiers in order: each one's growth is fitted by ridge on its own lag and, but for the first, on the lag of what was
    predicted for the tier above; beside it the fit without that one. (key, tier, rmse, rmse_alone, n). A market is a
    group of a few hundred rows."""
    key_type = dict(df.dtypes)[key]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        wide = pdf.pivot_table(index=at, columns=tier, values=y, aggfunc="first").sort_index()
        above, rows = None, []
        for name in tiers:
            if name not in wide:
                continue
            own = wide[name]
            x = pd.DataFrame({"own": own.shift(1)})
            alone = x.copy()
            if above is not None:
                x["above"] = above.shift(1)
            ok = x.notna().all(axis=1) & own.notna()
            if ok.sum() < least:
                continue
            fit = []
            for feats in (x, alone):
                beta, c, _ = ridge_fit(feats[ok].to_numpy(float), own[ok].to_numpy(float), alphas)
                fit.append(pd.Series(feats[ok].to_numpy(float) @ beta + c, index=own[ok].index))
            err = [float(np.sqrt(((own[ok] - f) ** 2).mean())) for f in fit]
            rows.append([pdf[key].iloc[0], name, *err, int(ok.sum())])
            above = fit[0].reindex(wide.index)
        return pd.DataFrame(rows, columns=[key, "tier", "rmse", "rmse_alone", "n"])

    return df.groupBy(key).applyInPandas(run, f"{key} {key_type}, tier string, rmse double, rmse_alone double, n long")


def boosted(df: DataFrame, y: str, xs: list[str], seed: int = 7, rounds: int = 20) -> DataFrame:
    """Gradient-boosted trees over the whole frame with a fixed seed: `df` with `predicted`. Training keeps points of all rows in
    the partitions it is given and reads them in every round, so rows are dealt out evenly, to more partitions the more there
    are; up to TASK_ROWS they stay where they are."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    ready = VectorAssembler(inputCols=xs, outputCol="_x", handleInvalid="skip").transform(df.where(F.col(y).isNotNull()))
    points = ready.select("_x", y)
    shares = -(-points.count() // TASK_ROWS)
    if shares > 1:
        points = points.repartition(shares)
    model = GBTRegressor(featuresCol="_x", labelCol=y, predictionCol="predicted", seed=seed, maxIter=rounds, maxDepth=3).fit(points)
    return model.transform(ready).drop("_x")


def butter_band(low: float, high: float, order: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (b, a) of a Butterworth band pass between two frequencies, given as shares of the Nyquist frequency:
    analog prototype, low pass to band pass, bilinear transform with pre-warped edges."""
    edge = 4 * np.tan(np.pi * np.array([low, high]) / 2)
    width, middle = edge[1] - edge[0], np.sqrt(edge[0] * edge[1])
    k = np.arange(order)
    half = np.exp(1j * np.pi * (2 * k + order + 1) / (2 * order)) * width / 2
    root = np.sqrt(half**2 - middle**2)
    poles = np.concatenate([half + root, half - root])
    gain = width**order * np.real(4.0**order / np.prod(4 - poles))
    zeros = np.concatenate([np.ones(order), -np.ones(order)])
    return gain * np.poly(zeros), np.real(np.poly((4 + poles) / (4 - poles)))


def _filter(b: np.ndarray, a: np.ndarray, x: np.ndarray, state: np.ndarray) -> np.ndarray:
    """Direct form II transposed."""
    z, out = np.append(state, 0.0), np.empty(len(x))
    for i, v in enumerate(x):
        out[i] = b[0] * v + z[0]
        z[:-1] = b[1:] * v + z[1:] - a[1:] * out[i]
    return out


def zero_phase(b: np.ndarray, a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Filtered forwards and backwards, with odd extensions of 3 max(len) values and the steady state of a constant."""
    n = 3 * max(len(a), len(b))
    companion = np.eye(len(a) - 1, k=1)
    companion[:, 0] -= a[1:]
    state = np.linalg.solve(np.eye(len(a) - 1) - companion, b[1:] - a[1:] * b[0])
    ext = np.concatenate([2 * x[0] - x[n:0:-1], x, 2 * x[-1] - x[-2 : -n - 2 : -1]])
    y = _filter(b, a, ext, state * ext[0])
    y = _filter(b, a, y[::-1], state * y[-1])[::-1]
    return y[n:-n]


def analytic(x: np.ndarray) -> np.ndarray:
    """The signal with its Hilbert transform as imaginary part."""
    n = len(x)
    h = np.zeros(n)
    h[0] = 1
    h[1 : (n + 1) // 2] = 2
    if n % 2 == 0:
        h[n // 2] = 1
    return np.fft.ifft(np.fft.fft(x) * h)


def hilbert_phase(df: DataFrame, keys: list[str], at: str, value: str, low: int = 16, high: int = 32) -> DataFrame:
    """Phase of the cycle of `low` to `high` rows: gaps interpolated, detrended, passed through a Butterworth band filter of
    order 2 in both directions and made analytic; the phase, from 0 to 2 pi, gives the label by quarters. Markets with fewer
    than 2 `high` rows, or more than 30 % gaps, give none. (keys, at, angle, amplitude, sin, cos, phase)"""
    key_types = [f"{f.name} {f.dataType.simpleString()}" for f in df.schema if f.name in keys]
    names = np.array(["EXPANSION", "PEAK", "CONTRACTION", "TROUGH"])
    out = [*keys, at, "angle", "amplitude", "sin", "cos", "phase"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(at)
        if len(pdf) < 2 * high or pdf[value].isna().mean() > 0.3:
            return pd.DataFrame(columns=out)
        v = pdf[value].astype(float).interpolate(method="linear").bfill().ffill().to_numpy()
        t = np.arange(len(v))
        z = analytic(zero_phase(*butter_band(2 / high, 2 / low), v - np.polyval(np.polyfit(t, v, 1), t)))
        angle = np.angle(z)
        quarter = np.minimum(3, (angle % (2 * np.pi)) // (np.pi / 2)).astype(int)
        more = {at: pdf[at].to_numpy(), "angle": angle, "amplitude": np.abs(z), "sin": np.sin(angle), "cos": np.cos(angle), "phase": names[quarter]}
        return pdf[keys].assign(**more)[out]

    ddl = ", ".join([*key_types, f"{at} {dict(df.dtypes)[at]}", "angle double, amplitude double, sin double, cos double, phase string"])
    return df.select(*keys, at, value).groupBy(*keys).applyInPandas(run, ddl)
