"""Models of one path: exponential smoothing, theta and autoregression.

Every operator takes rows with a regular history ``y array<double>`` and a ``horizon``,
and adds an array of forecasts. A history holds one value per period, so its length is
that of the calendar whatever the size of the fact tables behind it.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import freq_params, period_add
from tidemark.operators import gram as G
from tidemark.operators.differencing import differencing
from tidemark.operators.recursion import recursive_path

# Smoothing grid (level, trend, season) and the half-widths of the local second pass.
ETS_GRID = tuple(product((0.05, 0.2, 0.4, 0.6, 0.8), (0.0, 0.05, 0.2), (0.0, 0.1, 0.3)))
ETS_STEP = (0.1, 0.025, 0.05)
# One-sided 90 % normal quantile of the seasonality test.
SEASON_TEST = 1.645


def series_arrays(long: DataFrame, keys: Sequence[str] = ("series_id", "variable")) -> DataFrame:
    """(keys, y, first_period, last_period): known values in time order, one per period."""
    points = F.array_sort(F.collect_list(F.struct("period", "value")))
    known = long.filter("value IS NOT NULL").groupBy(*keys).agg(
        points.alias("_points"), F.min("period").alias("first_period"), F.max("period").alias("last_period"))
    return known.withColumn("y", F.col("_points.value")).withColumn("_periods", F.col("_points.period")).drop("_points")


# Paths of one length that a task computes side by side.
TOGETHER = 256


def _by_length(ys: pd.Series):
    """(positions, matrix) of the paths of equal length, a bounded number at a time; empty and missing ones are left out."""
    sizes = np.array([0 if y is None else len(y) for y in ys])
    for n in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == n)
        for low in range(0, len(at), TOGETHER):
            part = at[low : low + TOGETHER]
            yield part, np.stack([np.asarray(ys.iloc[i], dtype=float) for i in part])


def _smooth(y: np.ndarray, m: int, grid: np.ndarray):
    """Additive smoothing of every path (row of y) for its points of the grid (paths or 1, points, 3).

    Returns the one-step sse (paths, points) and the final states; season is (paths, slots, points).
    """
    a, b, g = np.moveaxis(grid, -1, 0)
    n, shape = y.shape[1], (len(y), grid.shape[1])
    sse = np.zeros(shape)
    seasonal = m >= 2 and n >= 2 * m + 5
    if seasonal:
        first = y[:, :m].mean(axis=1)
        level = np.repeat(first[:, None], shape[1], axis=1)
        trend = np.repeat(((y[:, m : 2 * m].mean(axis=1) - first) / m)[:, None], shape[1], axis=1)
        season = np.repeat((y[:, :m] - first[:, None])[:, :, None], shape[1], axis=2)
        start = m
    else:
        level = np.repeat(y[:, :1], shape[1], axis=1)
        trend = np.repeat(y[:, 1:2] - y[:, :1], shape[1], axis=1) if n > 1 else np.zeros(shape)
        season = np.zeros((shape[0], 1, shape[1]))
        start = 1
    for t in range(start, n):
        slot, now = t % season.shape[1], y[:, t : t + 1]
        s = season[:, slot]
        expected = level + trend
        sse += (now - expected - s) ** 2
        new = a * (now - s) + (1 - a) * expected
        trend = b * (new - level) + (1 - b) * trend
        if seasonal:
            season[:, slot] = g * (now - new) + (1 - g) * s
        level = new
    return sse, level, trend, season


def _ets_udf(m: int):
    grid = np.array(ETS_GRID)
    near = np.array(list(product(*[(-s, 0.0, s) for s in ETS_STEP])))

    @F.pandas_udf("struct<alpha:double,beta:double,gamma:double,sse:double,path:array<double>>")
    def ets(ys: pd.Series, horizons: pd.Series) -> pd.DataFrame:
        out: list = [(None,) * 5] * len(ys)
        for at, y in _by_length(ys):
            coarse = grid[np.argmin(_smooth(y, m, grid[None])[0], axis=1)]
            local = np.clip(coarse[:, None, :] + near, 0.0, 1.0)
            sse, level, trend, season = _smooth(y, m, local)
            best, rows = np.argmin(sse, axis=1), np.arange(len(y))
            steps = np.arange(1, int(horizons.iloc[at].max()) + 1)
            path = level[rows, best][:, None] + steps * trend[rows, best][:, None] + season[
                rows[:, None], (y.shape[1] + steps - 1) % season.shape[1], best[:, None]]
            for i, row, h in zip(at, rows, horizons.iloc[at]):
                out[i] = (*local[row, best[row]], sse[row, best[row]], path[row, : int(h)])
        return pd.DataFrame(out, columns=["alpha", "beta", "gamma", "sse", "path"])

    return ets


def ets_forecast(arrays: DataFrame, freq: str, name: str = "ets") -> DataFrame:
    """Adds a struct column: smoothing constants, in-sample sse and the forecast path.

    Level, trend and (given two seasons and five values) season are additive; constants
    come from a coarse grid refined once around its best point. The state update runs
    over many paths and the whole grid at once in numpy: the same loop as a higher-order
    function is interpreted per grid point and measured two orders of magnitude slower.
    """
    return arrays.withColumn(name, _ets_udf(freq_params(freq)["season"])("y", "horizon"))


def _season_index(y: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seasonal index of every path (paths, slots), whether a path has a season, and whether it multiplies.

    The autocorrelation at one season must exceed its 90 % bound; the index comes from
    ratios to (or differences from) a centred moving average over one season.
    """
    n, positive = y.shape[1], y.min(axis=1) > 0
    dev = y - y.mean(axis=1, keepdims=True)
    total = (dev * dev).sum(axis=1)
    if m < 2 or n < 2 * m:
        return np.zeros((len(y), 1)), np.zeros(len(y), bool), positive
    safe = np.where(total > 0, total, 1.0)
    r = np.stack([(dev[:, k:] * dev[:, : n - k]).sum(axis=1) for k in range(1, m + 1)], axis=1) / safe[:, None]
    found = (total > 0) & (np.abs(r[:, -1]) > SEASON_TEST * np.sqrt((1 + 2 * (r[:, :-1] ** 2).sum(axis=1)) / n))
    half = m // 2
    weights = np.r_[0.5, np.ones(m - 1), 0.5] / m
    trend = sum(w * y[:, i : n - m + i] for i, w in enumerate(weights))
    inner = y[:, half : n - half]
    ratio = np.where(positive[:, None], inner / np.where(trend != 0, trend, np.nan), inner - trend)
    slot = np.arange(half, n - half) % m
    raw = np.stack([ratio[:, slot == s].mean(axis=1) for s in range(m)], axis=1)
    middle = raw.mean(axis=1, keepdims=True)
    return np.where(positive[:, None], raw / middle, raw - middle), found, positive


def _theta_udf(m: int):
    alphas = np.arange(1, 50) / 50.0

    @F.pandas_udf("struct<alpha:double,path:array<double>>")
    def theta(ys: pd.Series, horizons: pd.Series) -> pd.DataFrame:
        out: list = [(None, None)] * len(ys)
        for at, y in _by_length(ys):
            n = y.shape[1]
            index, found, positive = _season_index(y, m)
            whole = index[:, np.arange(n) % index.shape[1]]
            with np.errstate(divide="ignore", invalid="ignore"):
                d = np.where(found[:, None], np.where(positive[:, None], y / whole, y - whole), y)
            t = np.arange(n) - (n - 1) / 2
            slope = d @ t / (t @ t) if n > 1 else np.zeros(len(y))
            level, sse = np.repeat(d[:, :1], len(alphas), axis=1), np.zeros((len(y), len(alphas)))
            for k in range(1, n):
                sse += (d[:, k : k + 1] - level) ** 2
                level = level + alphas * (d[:, k : k + 1] - level)
            best, rows = np.argmin(sse, axis=1), np.arange(len(y))
            a, steps = alphas[best][:, None], np.arange(1, int(horizons.iloc[at].max()) + 1)
            path = level[rows, best][:, None] + slope[:, None] / 2 * (steps - 1 + 1 / a - (1 - a) ** n / a)
            s = index[:, (n + steps - 1) % index.shape[1]]
            path = np.where(found[:, None], np.where(positive[:, None], path * s, path + s), path)
            for i, row, h in zip(at, rows, horizons.iloc[at]):
                out[i] = (alphas[best[row]], path[row, : int(h)])
        return pd.DataFrame(out, columns=["alpha", "path"])

    return theta


def theta_forecast(arrays: DataFrame, freq: str, name: str = "theta") -> DataFrame:
    """Adds a struct column: the smoothing constant and the theta path.

    Smoothing of the deseasonalised history plus half its linear trend; positive data are
    treated multiplicatively.
    """
    return arrays.withColumn(name, _theta_udf(freq_params(freq)["season"])("y", "horizon"))


def _lagged_sums(w: np.ndarray, max_p: int, m: int, seasonal: bool) -> np.ndarray:
    """Cross-product of [1, w(t-1)..w(t-p), w(t-m), w(t)] over the common sample."""
    first = min(max(m, max_p) if seasonal else max_p, len(w) - 1)
    t = np.arange(first, len(w))
    lags = [np.where(t - k >= 0, w[np.maximum(t - k, 0)], 0.0) for k in range(1, max_p + 1)]
    far = w[t - m] if seasonal else np.zeros(len(t))
    x = np.column_stack([np.ones(len(t)), *lags, far, w[t]])
    return x.T @ x


def _best_order(full: np.ndarray, max_p: int, seasonal: bool, intercept: bool):
    """(p, P, aic, coefficients) of the least AIC among sub-models of one cross-product."""
    last, best = len(full) - 1, None
    for p, s in product(range(max_p + 1), (0, 1) if seasonal else (0,)):
        cols = [0, *range(1, p + 1), *([max_p + 1] if s else [])]
        sub = full[np.ix_([*cols, last], [*cols, last])]
        b = np.zeros(len(cols))
        if intercept:
            b = G.min_norm(sub) if len(cols) > 1 else np.array([sub[0, 1] / sub[0, 0]])
        elif len(cols) > 1:
            b[1:] = np.linalg.pinv(sub[1:-1, 1:-1], rcond=1e-10, hermitian=True) @ sub[1:-1, -1]
        sse = max(sub[-1, -1] - 2 * b @ sub[:-1, -1] + b @ sub[:-1, :-1] @ b, 1e-300)
        aic = sub[0, 0] * np.log(sse / sub[0, 0]) + 2 * (len(cols) + 1)
        if best is None or aic < best[2] - 1e-9:
            best = (p, s, aic, b)
    return best


def _ar_udf(m: int, max_p: int):
    @F.pandas_udf("struct<p:int,d:int,seasonal_p:int,seasonal_d:int,aic:double,intercept:double,phi:array<double>>")
    def choose(ys: pd.Series, plain: pd.Series, seasons: pd.Series) -> pd.DataFrame:
        out = []
        for y, d, big in zip(ys, plain, seasons):
            y = np.asarray(y, dtype=float)
            if len(y) < 4:
                out.append((None,) * 7)
                continue
            d, big = int(d), int(big)
            w = np.diff(y[m:] - y[:-m] if big else y, d)
            while len(w) < 3:
                d -= 1
                w = np.diff(y[m:] - y[:-m] if big else y, d)
            # The seasonal lag needs more rows than a full model has columns.
            seasonal = m > 1 and len(w) - max(m, max_p) > max_p + 2
            p, s, aic, b = _best_order(_lagged_sums(w, max_p, m, seasonal), max_p, seasonal, d + big < 2)
            poly = np.zeros(max(p, m if s else 0) + 1)
            poly[0] = 1
            poly[1:p + 1] = -b[1:p + 1]
            if s:
                poly[m] -= b[-1]
            for _ in range(d):
                poly = np.convolve(poly, [1, -1])
            if big:
                poly = np.convolve(poly, np.r_[1, np.zeros(m - 1), -1])
            out.append((p, d, s, big, aic, b[0], -poly[1:] if len(poly) > 1 else np.zeros(1)))
        return pd.DataFrame(out, columns=["p", "d", "seasonal_p", "seasonal_d", "aic", "intercept", "phi"])

    return choose


def ar_search_forecast(arrays: DataFrame, freq: str, name: str = "arima", keys: Sequence[str] = ("series_id", "variable")) -> DataFrame:
    """Adds the path of the best autoregression by AIC: p, one seasonal lag, differencing.

    Differencing (d, D) is that of the tests in ``differencing``; orders compete on one common
    sample through sub-matrices of a single cross-product per path. The winner is turned
    into weights on past levels and rolled forward by the shared recursion. ``keys`` name a path.
    """
    m = freq_params(freq)["season"]
    max_p, max_d = (3, 1) if m >= 52 else (5, 2)
    fit, keys = f"{name}_fit", list(keys)
    rows = arrays.select(*keys, F.posexplode("y").alias("_i", "value"))
    orders = differencing(rows, keys, m, max_d, "_i").select(*keys, F.col("d").alias("_d"), F.col("seasonal_d").alias("_big"))
    out = arrays.join(orders, keys, "left").withColumn(
        fit, _ar_udf(m, max_p)("y", F.coalesce("_d", F.lit(0)), F.coalesce("_big", F.lit(0)))).drop("_d", "_big")
    effects = F.when(F.col("horizon") > 0, F.array_repeat(F.col(f"{fit}.intercept"), F.col("horizon")))
    return out.withColumn(name, recursive_path("y", f"{fit}.phi", effects))


def driver_models(arrays: DataFrame, freq: str, keys: Sequence[str]) -> DataFrame:
    """All three models: (keys, model, step, period, yhat). ``last_period`` anchors step 0."""
    df = theta_forecast(ets_forecast(ar_search_forecast(arrays, freq, keys=keys), freq), freq)
    paths = F.create_map(F.lit("ets"), F.col("ets.path"), F.lit("arima"), F.col("arima"), F.lit("theta"), F.col("theta.path"))
    rows = df.select(*keys, "last_period", F.explode(paths).alias("model", "path"))
    rows = rows.select(*keys, "last_period", "model", F.posexplode("path").alias("pos", "yhat"))
    step = (F.col("pos") + 1).cast("bigint")
    return rows.select(*keys, "model", step.alias("step"), period_add(F.col("last_period"), step, freq).alias("period"), "yhat")
