"""Univariate models of the log target, and the registry of all target models."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import freq_params
from tidemark.operators import gram as G
from tidemark.operators.linear_models import LINEAR_MODELS, fit_linear, forecast_linear
from tidemark.operators.recursion import explode_path
from tidemark.operators.tree_models import POOLED_MODELS, TREE_MODELS, forecast_pooled, forecast_trees
from tidemark.operators.univariate import ets_forecast, theta_forecast
from tidemark.session import materialize
from tidemark.settings import DEFAULTS, UNIVARIATE_MODELS, Settings

KEYS = ("series_id", "fold")
TREND_KNOTS, RIDGE = 5, 0.05


def training_arrays(centered: DataFrame, folds: DataFrame, future: DataFrame) -> DataFrame:
    """(series_id, fold, mu, y, periods, horizon): centred log history and the periods to forecast."""
    points = F.array_sort(F.collect_list(F.struct("period", "y")))
    arrays = centered.filter("y IS NOT NULL").groupBy("series_id").agg(F.first("mu").alias("mu"), points.alias("_p"))
    steps = future.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("step", "period"))).getField("period").alias("periods"))
    cut = F.filter("_p", lambda r: r["period"] <= F.col("train_end"))
    rows = arrays.join(folds.select(*KEYS, "train_end"), "series_id").join(steps, list(KEYS)).withColumn("_cut", cut)
    return rows.select(*KEYS, "mu", F.col("_cut.y").alias("y"), "periods", F.size("periods").alias("horizon"))


def _rows(df: DataFrame, path: str, model: str) -> DataFrame:
    flat = explode_path(df, path, [*KEYS, "mu"])
    return flat.select(*KEYS, F.lit(model).alias("model"), "step", "period", F.exp(F.col("yhat") + F.col("mu")).alias("yhat"))


def fourier_trend(arrays: DataFrame, freq: str, name: str = "fourier_trend") -> DataFrame:
    """Adds the path of a piecewise-linear trend with yearly cycles, by ridge regression.

    Index rows are expanded from the arrays, their cross-products go through the shared
    Gram aggregation, and one small solve per path returns the coefficients.
    """
    m = freq_params(freq)["season"]
    pairs = 3 if m > 1 else 0
    knots = [0.8 * (i + 1) / (TREND_KNOTS + 1) for i in range(TREND_KNOTS)]

    def regressors(i):
        t = i / F.col("n")
        hinges = [F.greatest(t - c, F.lit(0.0)) for c in knots]
        waves = [f(i * float(2 * np.pi * k / m)) for k in range(1, pairs + 1) for f in (F.sin, F.cos)]
        return F.array(t, *hinges, *waves)

    rows = arrays.withColumn("n", F.size("y")).filter("n > 2")
    obs = rows.select(*KEYS, "n", F.posexplode("y").alias("i", "v"))
    sums = G.gram(obs.select(*KEYS, F.concat(regressors(F.col("i")), F.array("v")).alias("x")), list(KEYS))

    @F.pandas_udf("array<double>")
    def solve(grams: pd.Series) -> pd.Series:
        return pd.Series([G.min_norm(G.unpack(g), ridge=RIDGE) for g in grams])

    def point(j):
        dot = F.zip_with(regressors(F.col("n") + j), F.slice("_b", F.lit(2), F.size("_b")), lambda a, b: a * b)
        return F.aggregate(dot, F.col("_b")[0], lambda a, v: a + v)

    fits = sums.select(*KEYS, solve("g").alias("_b"))
    return rows.join(fits, list(KEYS)).withColumn(
        name, F.transform(F.sequence(F.lit(0), F.col("horizon") - 1), point)).drop("_b", "n")


def forecast_univariate(centered: DataFrame, folds: DataFrame, future: DataFrame, freq: str,
                        models: Sequence[str] = UNIVARIATE_MODELS) -> DataFrame:
    """Forecasts of the target-only models in the units of the target."""
    arrays = training_arrays(centered, folds, future)
    parts = []
    if "holtwinters" in models:
        parts.append(_rows(ets_forecast(arrays, freq).withColumn("_path", F.col("ets.path")), "_path", "holtwinters"))
    if "theta" in models:
        # The season test chooses its form by the sign of the log target itself.
        logs = arrays.withColumnRenamed("mu", "_mean").withColumn("y", F.transform("y", lambda v: v + F.col("_mean"))).withColumn("mu", F.lit(0.0))
        parts.append(_rows(theta_forecast(logs, freq).withColumn("_path", F.col("theta.path")), "_path", "theta"))
    if "fourier_trend" in models:
        parts.append(_rows(fourier_trend(arrays, freq), "fourier_trend", "fourier_trend"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Extra models: name -> (centered, folds, future, drivers, freq, settings) -> forecast rows.
REGISTRY: dict[str, Callable[..., DataFrame]] = {}


def register_model(name: str, forecast: Callable[..., DataFrame]) -> None:
    """Add a target model to the catalogue."""
    REGISTRY[name] = forecast


def forecast_models(centered: DataFrame, folds: DataFrame, future: DataFrame, drivers: Sequence[str], freq: str,
                    settings: Settings = DEFAULTS, clamp: bool = True, failures: list[DataFrame] | None = None) -> DataFrame:
    """All enabled models over all series and folds: (series_id, fold, model, step, period, yhat).

    A fit that fails costs its own rows only; it is added to ``failures`` as (series_id, fold, model, reason).
    """
    parts = []
    linear = [m for m in LINEAR_MODELS if m in settings.models]
    if linear:
        fits = fit_linear(centered, folds, drivers, freq, linear, settings)
        if failures is not None:
            fits = materialize(fits)
            failures.append(fits.filter("reason IS NOT NULL").select("series_id", "fold", "model", "reason"))
        parts.append(forecast_linear(fits, centered, folds, future, drivers, freq, settings, clamp, linear))
    trees = [m for m in TREE_MODELS if m in settings.models]
    if trees:
        parts.append(forecast_trees(centered, folds, future, drivers, freq, trees, settings, clamp, failures))
    if set(POOLED_MODELS) & set(settings.models):
        parts.append(forecast_pooled(centered, folds, future, drivers, freq, settings, clamp))
    univariate = [m for m in UNIVARIATE_MODELS if m in settings.models]
    if univariate:
        parts.append(forecast_univariate(centered, folds, future, freq, univariate))
    parts += [REGISTRY[m](centered, folds, future, drivers, freq, settings) for m in settings.models if m in REGISTRY]
    if not parts:
        raise ValueError("no model is enabled")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
