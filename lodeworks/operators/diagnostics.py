"""Tests of series and of forecasts, by market: unit roots, stationarity, autocorrelation, Granger causality, accuracy and
Diebold-Mariano.

Regressions of the unit-root and causality tests come from sums of cross products that Spark aggregates (partial sums, then
one row a market and lag order); a row is then solved in numpy. Autocorrelations work on a market's series as one array,
which the calendar bounds to a few hundred values. Tails of chi-square and normal are Column expressions.

Defined cases: rows without a value are left out; a market whose series is too short or constant has no row for the test;
a null market is a market of its own."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ----------------------------------------------------------------- tails


def chi2_tail(x: Column, df: int) -> Column:
    """P(X > x) of chi-square with `df` degrees: a finite sum for even degrees; for odd ones the complementary error
    function, by its series, and a finite sum."""
    z = x / 2
    if df % 2 == 0:
        terms = [F.pow(z, j) / math.factorial(j) for j in range(df // 2)]
        tail = F.exp(-z) * sum(terms[1:], terms[0])
    else:
        # erf(sqrt z) = exp(-z) sum z^(n + 1/2) / Gamma(n + 3/2); terms fall off once n exceeds z.
        step = lambda s, n: F.struct((s["t"] * s["z"] / (n + 0.5)).alias("t"), (s["sum"] + s["t"]).alias("sum"), s["z"].alias("z"))
        first = F.struct((F.sqrt(z) / math.gamma(1.5)).alias("t"), F.lit(0.0).alias("sum"), z.alias("z"))
        total = F.aggregate(F.sequence(F.lit(1), F.ceil(2 * F.least(z, F.lit(700.0)) + 60).cast("int")), first, step, lambda s: s["sum"])
        tail = F.lit(1.0) - F.exp(-z) * total
        for j in range(1, (df + 1) // 2):
            tail = tail + F.exp(-z) * F.pow(z, j - 0.5) / math.gamma(j + 0.5)
    return F.when(z > 700, 0.0).when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail)))


def normal_two_sided(x: Column) -> Column:
    """P(|X| > |x|) of a standard normal."""
    return chi2_tail(x * x, 1)


def f_tail(f: float, d1: float, d2: float) -> float:
    """P(X > f) of F with (d1, d2) degrees: the incomplete beta function by its continued fraction."""
    if not f > 0:
        return 1.0
    x, a, b = d2 / (d2 + d1 * f), d2 / 2, d1 / 2
    turned = x > (a + 1) / (a + b + 2)
    if turned:
        x, a, b = 1 - x, b, a
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a if 0 < x < 1 else 0.0
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d or tiny)
    h = d
    for m in range(1, 500):
        for t in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + t * d) or tiny)
            c = (1 + t / c) or tiny
            h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return 1 - front * h if turned else front * h


#: Response surface of the unit-root test with a constant [MacKinnon 1994], least and greatest statistic,
#: where the two polynomials meet, and their coefficients.
TAU_MIN, TAU_MAX, TAU_STAR = -18.83, 2.74, -1.61
TAU_SMALL, TAU_LARGE = (2.1659, 1.4412, 0.038269), (1.7339, 0.93202, -0.12745, -0.010368)
#: Statistics of the stationarity test with a constant and their p-values [Kwiatkowski et al. 1992].
KPSS_STATISTIC, KPSS_P = (0.347, 0.463, 0.574, 0.739), (0.10, 0.05, 0.025, 0.01)


def unit_root_p(tau: float) -> float:
    if tau > TAU_MAX:
        return 1.0
    if tau < TAU_MIN:
        return 0.0
    value = sum(c * tau**i for i, c in enumerate(TAU_SMALL if tau <= TAU_STAR else TAU_LARGE))
    return 0.5 * math.erfc(-value / math.sqrt(2))


# ----------------------------------------------------------------- regressions from cross products


def gram(df: DataFrame, keys: list[str], z: list[Column]) -> DataFrame:
    """(keys, rows, gram): the sums of all products of two of `z`, row by row of the matrix; partial sums are combined map
    side, so no group is ever held."""
    vector = F.array(*(F.coalesce(c.cast("double"), F.lit(0.0)) for c in z))
    products = F.flatten(F.transform(vector, lambda a: F.transform(vector, lambda b: a * b)))
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), vector_to_array(Summarizer.sum(array_to_vector(products))).alias("gram"))


def regression(g: np.ndarray, y: int, xs: list[int]) -> tuple[np.ndarray, np.ndarray, float]:
    """Least squares of column `y` on `xs` from a matrix of cross products: (coefficients, inverse of X'X, squared residuals)."""
    xx, xy = g[np.ix_(xs, xs)], g[xs, y]
    inverse = np.linalg.pinv(xx, rcond=1e-13, hermitian=True)
    beta = inverse @ xy
    return beta, inverse, float(max(0.0, g[y, y] - 2 * beta @ xy + beta @ xx @ beta))


def _standard(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """`columns` centred and scaled by market, and the market's rows as `_n`: tests with a constant don't change, and sums of
    products keep their digits."""
    w = Window.partitionBy(*keys)
    for c in columns:
        df = df.withColumn(c, (F.col(c) - F.avg(c).over(w)) / F.nullif(F.stddev_pop(c).over(w), F.lit(0.0)))
    return df.withColumn("_n", F.count("*").over(w)).where(F.coalesce(*(F.col(c) for c in columns)).isNotNull())


def beside(left: DataFrame, right: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """Join on `by`, nulls being equal; the right side's keys go, its other columns must be new."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in by})
    return left.join(right, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in by], how).drop(*(f"_right_{k}" for k in by))


def _types(df: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"{k} {dict(df.dtypes)[k]}" for k in keys)


def adf(df: DataFrame, keys: list[str], at: str, value: str, most: int = 8) -> DataFrame:
    """Augmented Dickey-Fuller with a constant: (keys, statistic, p, lags, rows). Lags of the difference, at most `most` and
    half the rows less two, are chosen by AIC over one sample; the statistic uses all rows that those lags leave."""
    s = df.select(*keys, at, F.col(value).cast("double").alias("y")).where("y IS NOT NULL")
    s = _standard(s, keys, ["y"])
    w = Window.partitionBy(*keys).orderBy(at)
    s = s.withColumn("i", F.row_number().over(w)).withColumn("d", F.col("y") - F.lag("y").over(w)).withColumn("y1", F.lag("y").over(w))
    s = s.select("*", *(F.lag("d", j).over(w).alias(f"d{j}") for j in range(1, most + 1)))
    per = s.withColumn("k", F.explode(F.sequence(F.lit(0), F.least(F.lit(most), F.floor(F.col("_n") / 2).cast("int") - 2)))).where("_n >= 6 AND i >= k + 2")
    g = gram(per, [*keys, "k"], [F.col("d"), F.lit(1.0), F.col("y1"), *(F.col(f"d{j}") for j in range(1, most + 1))])
    one = g.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("k", "rows", "gram"))).alias("g"))  # `most` + 1 of them
    size = most + 3

    def solve(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                by = [(x["rows"], np.asarray(x["gram"], float).reshape(size, size)) for x in r["g"]]
                rows, common = by[-1]
                aic = []
                for k in range(len(by)):
                    ssr = regression(common, 0, list(range(1, 3 + k)))[2]
                    aic.append(rows * math.log(max(ssr, 1e-300) / rows) + 2 * (2 + k))
                k = int(np.argmin(aic))
                rows, own = by[k]
                beta, inverse, ssr = regression(own, 0, list(range(1, 3 + k)))
                spread = ssr / (rows - 2 - k) * inverse[1, 1] if rows > 2 + k else 0.0
                if spread > 0:
                    tau = float(beta[1] / math.sqrt(spread))
                    out.append([*(r[c] for c in keys), tau, unit_root_p(tau), k, rows])
            yield pd.DataFrame(out, columns=[*keys, "statistic", "p", "lags", "rows"])

    return one.mapInPandas(solve, f"{_types(df, keys)}, statistic double, p double, lags long, rows long")


def granger(df: DataFrame, keys: list[str], at: str, effect: str, cause: str, most: int = 4, least: int = 21) -> DataFrame:
    """Does `cause` help to predict `effect`: for 1 to `most` lags the F test of the cause's lags beside the effect's own
    (keys, lag, statistic, p), for markets of `least` complete rows."""
    s = df.select(*keys, at, F.col(effect).cast("double").alias("y"), F.col(cause).cast("double").alias("x")).dropna(subset=["y", "x"])
    s = _standard(s, keys, ["y", "x"])
    w = Window.partitionBy(*keys).orderBy(at)
    lags = [F.lag(c, j).over(w).alias(f"{c}{j}") for c in "yx" for j in range(1, most + 1)]
    s = s.where(F.col("_n") >= least).select("*", F.row_number().over(w).alias("i"), *lags)
    per = s.withColumn("lag", F.explode(F.array(*map(F.lit, range(1, most + 1))))).where("i > lag")
    g = gram(per, [*keys, "lag"], [F.col("y"), F.lit(1.0), *(F.col(f"{c}{j}") for c in "yx" for j in range(1, most + 1))])
    size = 2 + 2 * most

    def solve(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                m, lag = np.asarray(r["gram"], float).reshape(size, size), r["lag"]
                own = [1, *range(2, 2 + lag)]
                alone, both = regression(m, 0, own)[2], regression(m, 0, [*own, *range(2 + most, 2 + most + lag)])[2]
                free = r["rows"] - 2 * lag - 1
                if free > 0 and both > 0:
                    f = (alone - both) / lag / (both / free)
                    out.append([*(r[c] for c in keys), lag, f, f_tail(f, lag, free)])
            yield pd.DataFrame(out, columns=[*keys, "lag", "statistic", "p"])

    return g.mapInPandas(solve, f"{_types(df, keys)}, lag long, statistic double, p double")


# ----------------------------------------------------------------- autocorrelation


def _series(df: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """(keys, n, e): a market's values in order, less their mean."""
    g = df.select(*keys, at, F.col(value).cast("double").alias("y")).where("y IS NOT NULL").groupBy(*keys).agg(F.count("*").alias("n"), F.avg("y").alias("_mean"), F.array_sort(F.collect_list(F.struct(F.col(at).alias("_at"), "y"))).alias("_rows"))
    return g.select(*keys, F.col("n").cast("int").alias("n"), F.transform("_rows", lambda x: x["y"] - F.col("_mean")).alias("e"))


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def _products(lag: Column) -> Column:
    """Sum of e_t e_(t - lag)."""
    left, right = F.slice("e", lag + 1, F.col("n") - lag), F.slice("e", F.lit(1), F.col("n") - lag)
    return _sum(F.zip_with(left, right, lambda a, b: a * b))


def ljung_box(df: DataFrame, keys: list[str], at: str, value: str, lags: tuple[int, ...] = (4, 8, 12)) -> DataFrame:
    """Is the series free of autocorrelation up to each of `lags`: (keys, lag, statistic, p), for lags below the rows."""
    s = _series(df, keys, at, value).withColumn("own", _products(F.lit(0))).where("own > 0")
    r2 = lambda k: F.pow(_products(k) / F.col("own"), 2) / (F.col("n") - k)
    s = s.withColumn("r", F.transform(F.sequence(F.lit(1), F.least(F.lit(max(lags)), F.greatest(F.col("n") - 1, F.lit(1)))), r2))
    one = [F.struct(F.lit(k).cast("long").alias("lag"), (F.col("n") * (F.col("n") + 2) * _sum(F.slice("r", 1, k))).alias("q")) for k in lags]
    out = s.withColumn("x", F.explode(F.array(*one))).where("x.lag < n").select(*keys, "x.lag", F.col("x.q").alias("statistic"))
    p = F.lit(None).cast("double")
    for k in lags:
        p = F.when(F.col("lag") == k, chi2_tail(F.col("statistic"), k)).otherwise(p)
    return out.withColumn("p", p)


def kpss(df: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """Stationarity around a constant: (keys, statistic, p, lags). The window of the long-run variance is chosen from the
    data [Hobijn et al. 1998]; p is interpolated between the published values and stays within them."""
    s = _series(df, keys, at, value).withColumn("own", _products(F.lit(0))).where("own > 0 AND n > 2")
    few = F.floor(F.pow(F.col("n").cast("double"), F.lit(2 / 9))).cast("int")
    s = s.withColumn("c", F.transform(F.sequence(F.lit(1), few), lambda i: F.struct(i.alias("i"), (_products(i) / (F.col("n") / 2)).alias("v"))))
    s0 = F.col("own") / F.col("n") + _sum(F.transform("c", lambda x: x["v"]))
    s1 = _sum(F.transform("c", lambda x: x["i"] * x["v"]))
    wide = F.floor(1.1447 * F.cbrt(F.pow(s1 / s0, 2)) * F.cbrt(F.col("n").cast("double"))).cast("int")
    s = s.withColumn("lags", F.greatest(F.lit(0), F.least(wide, F.col("n") - 1)))
    some = F.when(F.col("lags") > 0, F.sequence(F.lit(1), F.col("lags"))).otherwise(F.array().cast("array<int>"))
    long_run = (F.col("own") + 2 * _sum(F.transform(some, lambda i: _products(i) * (1 - i / (F.col("lags") + 1))))) / F.col("n")
    walk = F.aggregate("e", F.struct(F.lit(0.0).alias("at"), F.lit(0.0).alias("sum")), lambda a, x: F.struct((a["at"] + x).alias("at"), (a["sum"] + F.pow(a["at"] + x, 2)).alias("sum")), lambda a: a["sum"])
    s = s.withColumn("statistic", walk / F.pow("n", F.lit(2)) / long_run)
    x, p = F.col("statistic"), F.lit(KPSS_P[-1])
    for (a, pa), (b, pb) in reversed(list(zip(zip(KPSS_STATISTIC, KPSS_P, strict=True), zip(KPSS_STATISTIC[1:], KPSS_P[1:], strict=True), strict=False))):
        p = F.when(x <= b, pa + (x - a) / (b - a) * (pb - pa)).otherwise(p)
    return s.select(*keys, "statistic", F.when(x <= KPSS_STATISTIC[0], KPSS_P[0]).otherwise(p).alias("p"), F.col("lags").cast("long").alias("lags"))


def diagnose(df: DataFrame, keys: list[str], at: str, value: str, cause: str | None = None) -> DataFrame:
    """All tests of a panel, one row a market and test: (keys, test, lag, statistic, p)."""
    from .models import jarque_bera

    none = F.lit(None).cast("long")
    parts = [
        adf(df, keys, at, value).select(*keys, F.lit("adf").alias("test"), F.col("lags").alias("lag"), "statistic", "p"),
        kpss(df, keys, at, value).select(*keys, F.lit("kpss").alias("test"), F.col("lags").alias("lag"), "statistic", "p"),
        ljung_box(df, keys, at, value).select(*keys, F.lit("ljung_box").alias("test"), "lag", "statistic", "p"),
        jarque_bera(df, keys, value).select(*keys, F.lit("jarque_bera").alias("test"), none.alias("lag"), F.col("jb").alias("statistic"), "p"),
    ]
    if cause:
        parts.append(granger(df, keys, at, value, cause).select(*keys, F.lit("granger").alias("test"), "lag", "statistic", "p"))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


# ----------------------------------------------------------------- forecasts


def accuracy(bt: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Accuracy of backtests (keys, model, at, actual, predicted, lo, hi) by model: n, rmse, mae, bias, autocorrelation of
    successive errors, Ljung-Box p at 5 lags from 10 errors on, share of actuals within the band."""
    by = [*keys, "model"]
    e = bt.withColumn("e", F.col("actual") - F.col("predicted")).withColumn("e1", F.lag("e").over(Window.partitionBy(*by).orderBy(at)))
    own = F.when(F.col("e1").isNotNull(), F.col("e"))
    g = e.groupBy(*by).agg(
        F.count("e").alias("n"), F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"), F.avg(F.abs("e")).alias("mae"), F.avg("e").alias("bias"),
        F.coalesce(F.covar_samp(own, F.col("e1")) / F.nullif(F.stddev_samp(own) * F.stddev_samp("e1"), F.lit(0.0)), F.lit(0.0)).alias("acf1"),
        F.avg(F.col("actual").between(F.col("lo"), F.col("hi")).cast("double")).alias("coverage"),
    )
    out = beside(g, ljung_box(e, by, at, "e", (5,)).select(*by, F.col("p").alias("ljung_box_p")), by, "left")
    return out.select(*by, "n", "rmse", "mae", "bias", F.when(F.col("n") >= 2, F.col("acf1")).alias("acf1"), F.when(F.col("n") >= 10, F.col("ljung_box_p")).alias("ljung_box_p"), "coverage")


def diebold_mariano(bt: DataFrame, keys: list[str], at: str, against: str = "Naive") -> DataFrame:
    """Every model's squared errors against those of one model at the same origins: (keys, model, n, statistic, p), positive
    where the model is better. Models with other origins than `against`, or equal losses, have no row."""
    by, loss = [*keys, "model"], bt.select(*keys, "model", at, F.pow(F.col("actual") - F.col("predicted"), 2).alias("loss"))
    base = loss.where(F.col("model") == against)
    d = beside(loss.where(F.col("model") != against), base.select(*keys, at, F.col("loss").alias("base")), [*keys, at])
    d = d.groupBy(*by).agg(F.count("*").alias("n"), F.avg(F.col("base") - F.col("loss")).alias("m"), F.var_samp(F.col("base") - F.col("loss")).alias("v"))
    d = beside(d, base.groupBy(*keys).agg(F.count("*").alias("of_base")), keys)
    d = beside(d, loss.groupBy(*by).agg(F.count("*").alias("own")), by)
    z = F.col("m") / F.sqrt(F.col("v") / F.col("n"))
    return d.where("n = of_base AND n = own AND v > 0").select(*by, "n", z.alias("statistic"), normal_two_sided(z).alias("p"))
