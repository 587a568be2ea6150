"""Non-linear target models: trees per series, and kernel features pooled over the panel.

Trees are fitted per series and fold on log targets (see ``trees``). The kernel model is one Huber fit of Spark over all series
per fold position; there, targets enter as log deviations from the mean of their series, so no column of ids is needed. Its
weights are a few dozen numbers and travel with the task. Either way one task rolls the forecasts of a batch of paths
forward together, and no step needs a job or a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import calendar_features, calendar_names, freq_params
from tidemark.operators import trees as T
from tidemark.operators.features import (
    ROLLING, history_array, lag_names, make_target_features)
from tidemark.operators.folds import training_rows
from tidemark.operators.linear_models import center_constants, center_future
from tidemark.session import materialize, spread
from tidemark.settings import DEFAULTS, Settings

TREE_MODELS = ("gbt_lgbm", "gbt_catboost", "gbt_xgboost", "rf")
POOLED_MODELS = ("rff_regression",)
RFF_SIZE = 64


def _kernel(scale: list[tuple[float, float]], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and phases of random cosines that approximate a radial kernel of width sqrt(n)."""
    m, s = np.array(scale).T
    rng = np.random.default_rng(seed)
    w = rng.normal(scale=1 / np.sqrt(len(m)), size=(RFF_SIZE, len(m))) / s
    return w, rng.uniform(0, 2 * np.pi, RFF_SIZE) - w @ m


def _cosines(w: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.cos(x @ w.T + b) * np.sqrt(2.0 / RFF_SIZE)


def _fit_kernel(rows: DataFrame, n: int, settings: Settings) -> Callable[[np.ndarray], np.ndarray]:
    """Fit on Spark (columns x, label); returns the fitted function of a feature matrix."""
    x = F.col("x")
    stats = rows.agg(F.array(*[F.avg(x[i]) for i in range(n)]).alias("m"),
                     F.array(*[F.stddev_pop(x[i]) for i in range(n)]).alias("s")).first()
    w, b = _kernel([(m, s or 1.0) for m, s in zip(stats["m"], stats["s"])], settings.seed)

    @F.pandas_udf("array<double>")
    def cosines(xs: pd.Series) -> pd.Series:
        return pd.Series(list(_cosines(w, b, np.stack(xs.to_numpy()))))

    estimator = LinearRegression(featuresCol="features", labelCol="label", loss="huber", regParam=0.01, maxIter=60, standardization=False)
    fit = estimator.fit(rows.select("label", array_to_vector(cosines("x")).alias("features")))
    coef, intercept = fit.coefficients.toArray(), fit.intercept
    return lambda x: _cosines(w, b, x) @ coef + intercept


def roll(predict: Callable[[np.ndarray], np.ndarray], past: np.ndarray, exog: np.ndarray, lo: np.ndarray, hi: np.ndarray,
         n_lags: int, short: int, long: int) -> np.ndarray:
    """Paths of several series side by side, each prediction fed back; a path that meets a missing value has none from there on."""
    steps = exog.shape[1]
    for t in range(steps):
        a, b = past[:, -short:], past[:, -long:]
        stats = np.column_stack([a.mean(1), b.mean(1), a.std(1, ddof=1), b.std(1, ddof=1)])
        y = predict(np.column_stack([past[:, :-n_lags - 1:-1], exog[:, t], stats]))
        past = np.column_stack([past, np.where(np.isfinite(y), np.clip(y, lo, hi), np.nan)])
    return past[:, -steps:]


def _roll_udf(n_lags: int, short: int, long: int, clamp: float | None, fitted: dict | None = None):
    """Column function of (ensemble or fold position, history, known, mean, deviation) that returns the path."""
    def batches(known: pd.Series):
        for idx in known.groupby(known.map(len)).groups.values():
            for low in range(0, len(idx), T.TOGETHER):
                yield idx[low : low + T.TOGETHER]

    def run(pick, history: pd.Series, known: pd.Series, mean: pd.Series, sd: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(history), index=history.index, dtype=object)
        for idx in batches(known):
            past = np.stack(history[idx].to_numpy())
            exog = np.stack([np.stack(k).astype(float) for k in known[idx]])
            reach = (clamp or np.inf) * np.maximum(sd[idx].to_numpy(), 1e-6)
            path = roll(pick(idx), past, exog, mean[idx].to_numpy() - reach, mean[idx].to_numpy() + reach, n_lags, short, long)
            out[idx] = pd.Series([p if np.isfinite(p).all() else None for p in path], index=idx)
        return out

    if fitted is None:
        @F.pandas_udf("array<double>")
        def trees(ensemble: pd.DataFrame, history: pd.Series, known: pd.Series, mean: pd.Series, sd: pd.Series) -> pd.Series:
            def pick(idx):
                own = ensemble.loc[idx].to_dict("records")
                return lambda x: T.predict_together(own, x, np.arange(len(x)))

            return run(pick, history, known, mean, sd)

        return trees

    @F.pandas_udf("array<double>")
    def pooled(pos: pd.Series, history: pd.Series, known: pd.Series, mean: pd.Series, sd: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(pos), index=pos.index, dtype=object)
        for p, idx in pos.groupby(pos).groups.items():
            out[idx] = run(lambda _, p=p: fitted[p], history[idx], known[idx], mean[idx], sd[idx])
        return out

    return pooled


def tree_rows(centered: DataFrame, folds: DataFrame, drivers: Sequence[str], freq: str, settings: Settings = DEFAULTS) -> DataFrame:
    """(series_id, fold, period, x, label): the rows that trees and kernels learn from."""
    zs = [f"z_{d}" for d in drivers]
    names = [*lag_names(settings.n_lags), *zs, *calendar_names(freq), *ROLLING]
    feats = make_target_features(centered.select("series_id", "period", "y", *zs), zs, freq, "y", settings.n_lags)
    train = training_rows(feats.filter("y IS NOT NULL"), folds)
    return train.select("series_id", "fold", "period", F.array(*[F.col(n).cast("double") for n in names]).alias("x"), F.col("y").alias("label"))


def fit_trees(train: DataFrame, presets: dict[str, T.TreeParams], keys: Sequence[str] = ("series_id", "fold")) -> DataFrame:
    """(keys, model, trees): one ensemble per key and preset. A key has one row per period, so its rows fit in arrays."""
    rows = train.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("period", "x", "label"))).alias("_r"))
    rows = rows.select(*keys, F.col("_r.x").alias("x"), F.col("_r.label").alias("y"),
                       F.explode(F.array(*[F.lit(m) for m in presets])).alias("model"))
    fit = T.fit_udf(presets)
    return spread(rows, *keys, "model").select(*keys, "model", fit("model", "x", "y").alias("trees"))


def _paths(train: DataFrame, centered: DataFrame, folds: DataFrame, future: DataFrame, drivers: Sequence[str], freq: str,
           settings: Settings) -> DataFrame:
    """(series_id, fold, mu, history, mean and deviation in training, step, period, known): what a path needs to roll."""
    bands = train.groupBy("series_id", "fold").agg(F.avg("label").alias("_m"), F.stddev_pop("label").alias("_s"))
    k = max(settings.n_lags, freq_params(freq)["roll_long"])
    history = history_array(training_rows(centered.select("series_id", "period", "y"), folds), "y", k, ("series_id", "fold"))
    fut = center_future(future, center_constants(centered, drivers), drivers)
    known = F.array(*[f"z_{d}" for d in drivers], *[c.cast("double") for c in calendar_features(F.col("period"), freq)])
    steps = fut.groupBy("series_id", "fold").agg(
        F.first("mu").alias("mu"), F.array_sort(F.collect_list(F.struct("step", "period", known.alias("known")))).alias("steps"))
    return steps.join(history, ["series_id", "fold"]).join(bands, ["series_id", "fold"]).filter(F.size("history") == k).select(
        "series_id", "fold", "mu", "history", "_m", "_s", F.col("steps.step").alias("step"),
        F.col("steps.period").alias("period"), F.col("steps.known").alias("known"))


def _path_rows(paths: DataFrame) -> DataFrame:
    rows = paths.select("series_id", "fold", "model", "mu", F.inline(F.arrays_zip("step", "period", "path")))
    return rows.select("series_id", "fold", "model", "step", "period", F.exp(F.col("path") + F.col("mu")).alias("yhat")
                       ).filter("yhat IS NOT NULL")


def forecast_trees(centered: DataFrame, folds: DataFrame, future: DataFrame, drivers: Sequence[str], freq: str,
                   models: Sequence[str] = TREE_MODELS, settings: Settings = DEFAULTS, clamp: bool = True,
                   failures: list[DataFrame] | None = None) -> DataFrame:
    """(series_id, fold, model, step, period, yhat): one ensemble per series, fold and model.

    Fits that fail are added to ``failures`` as (series_id, fold, model, reason).
    """
    train = materialize(tree_rows(centered, folds, drivers, freq, settings))
    presets = {m: T.PRESETS[m].with_(n_trees=settings.n_trees, seed=settings.seed) for m in models}
    fits = fit_trees(train, presets)
    if failures is not None:
        fits = materialize(fits)
        failures.append(fits.filter("trees.reason IS NOT NULL").select("series_id", "fold", "model", "trees.reason"))
    fits = fits.filter("trees.reason IS NULL")
    p = freq_params(freq)
    step = _roll_udf(settings.n_lags, p["roll_short"], p["roll_long"], settings.clamp_sigmas if clamp else None)
    paths = _paths(train, centered, folds, future, drivers, freq, settings).join(fits, ["series_id", "fold"])
    return _path_rows(paths.withColumn("path", step("trees", "history", "known", "_m", "_s")))


def forecast_pooled(centered: DataFrame, folds: DataFrame, future: DataFrame, drivers: Sequence[str], freq: str,
                    settings: Settings = DEFAULTS, clamp: bool = True) -> DataFrame:
    """(series_id, fold, model, step, period, yhat) of the kernel model: one fit per fold position over all series."""
    # Folds are numbered from the oldest; series with one fold share the latest position.
    places = folds.select("series_id", "fold", (F.col("n_folds") - F.col("fold")).alias("_pos"))
    train = materialize(tree_rows(centered, folds, drivers, freq, settings).join(places, ["series_id", "fold"]))
    n = settings.n_lags + len(drivers) + len(calendar_names(freq)) + len(ROLLING)
    fitted = {r["_pos"]: _fit_kernel(train.filter(F.col("_pos") == r["_pos"]), n, settings) for r in places.select("_pos").distinct().collect()}
    p = freq_params(freq)
    step = _roll_udf(settings.n_lags, p["roll_short"], p["roll_long"], settings.clamp_sigmas if clamp else None, fitted)
    paths = _paths(train, centered, folds, future, drivers, freq, settings).join(places, ["series_id", "fold"])
    paths = spread(paths, "series_id", "fold").withColumn("model", F.lit("rff_regression"))
    return _path_rows(paths.withColumn("path", step("_pos", "history", "known", "_m", "_s")))
