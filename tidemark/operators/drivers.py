"""Driver forecasts: backtested weights, ensemble paths and the future window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import freq_params, period_add, period_ordinal, period_range
from tidemark.functions.scores import driver_ape, finite
from tidemark.operators.ensemble import ape_sums, attach_weights, inverse_mape_weights, weighted_ensemble
from tidemark.operators.impute import time_interpolate
from tidemark.operators.panel import first_last_valid
from tidemark.operators.univariate import driver_models, series_arrays

KEYS = ("series_id", "variable")


def clean_history(long: DataFrame, freq: str) -> DataFrame:
    """Each driver on every period of its own known range, gaps interpolated in time."""
    ends = first_last_valid(long).filter("first_valid IS NOT NULL")
    spine = ends.select(*KEYS, F.explode(period_range(F.col("first_valid"), F.col("last_valid"), freq)).alias("period"))
    rows = spine.join(long.select(*KEYS, "period", "value"), [*KEYS, "period"], "left")
    return time_interpolate(rows, ["value"], KEYS)


def driver_folds(arrays: DataFrame, horizon: int, n_folds: int = 2) -> DataFrame:
    """Training and holdout slices anchored at each driver's own end; no row is copied,
    every fold is a slice of the same array."""
    n = F.size("y")
    folds = arrays.filter(n > n_folds * horizon).withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(n_folds))))
    start = n - (n_folds - F.col("fold") + 1) * horizon
    return folds.select(
        *KEYS, F.col("fold").cast("bigint").alias("fold"), F.slice("y", F.lit(1), start).alias("y"),
        F.slice("y", start + 1, F.lit(horizon)).alias("actual"), F.slice("_periods", start + 1, F.lit(horizon)).alias("holdout"),
        F.element_at("_periods", start).alias("last_period"), F.lit(horizon).alias("horizon"))


def driver_backtest(long: DataFrame, freq: str, horizon: int, n_folds: int = 2) -> DataFrame:
    """(series_id, variable, fold, model, step, period, actual, yhat, ape)."""
    folds = driver_folds(series_arrays(clean_history(long, freq)), horizon, n_folds)
    keys = (*KEYS, "fold")
    forecasts = driver_models(folds, freq, keys)
    points = F.arrays_zip(F.col("holdout").alias("period"), F.col("actual").alias("actual"))
    actual = folds.select(*keys, F.explode(points).alias("r")).select(*keys, "r.period", "r.actual")
    joined = forecasts.join(actual, [*keys, "period"])
    return joined.withColumn("ape", driver_ape(F.col("actual"), F.col("yhat")))


def driver_backtest_weights(long: DataFrame, freq: str, horizon: int, n_folds: int = 2) -> DataFrame:
    """(series_id, variable, model, err, n, mape, weight) from the pooled errors of all folds."""
    return inverse_mape_weights(ape_sums(driver_backtest(long, freq, horizon, n_folds)))


def weights_table(weights: DataFrame) -> DataFrame:
    """One row per driver with MAPE, weight and count columns per model."""
    cols = []
    for field, label in (("mape", "mape"), ("weight", "weight"), ("n", "count")):
        for model in ("ets", "arima", "theta"):
            cols.append(F.max(F.when(F.col("model") == model, F.col(field))).alias(f"{label}_{model}"))
    return weights.groupBy(*KEYS).agg(*cols)


def driver_ensemble(forecasts: DataFrame, weights: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Weighted path per driver; without weights every model counts the same."""
    clean = forecasts.withColumn("yhat", finite(F.col("yhat")))
    if weights is None:
        weighted = clean.withColumn("weight", F.lit(1.0 / 3))
    else:
        weighted = attach_weights(clean, weights, (*KEYS, "model"))
    return weighted_ensemble(weighted, keys)


def driver_holdout(long: DataFrame, folds: DataFrame, weights: DataFrame | None, freq: str, horizon: int) -> DataFrame:
    """Driver paths over each target holdout: (series_id, variable, fold, step, period, yhat).

    Trains on the rows up to the target's training end; a driver without a usable
    forecast repeats its last value.
    """
    arrays = series_arrays(long).join(folds.select("series_id", "fold", "train_end"), "series_id")
    pairs = F.arrays_zip(F.col("_periods").alias("p"), F.col("y").alias("v"))
    cut = F.filter(pairs, lambda r: r["p"] <= F.col("train_end"))
    keys = (*KEYS, "fold")
    train = arrays.withColumn("_cut", cut).filter(F.size("_cut") > 0).select(
        *keys, F.col("_cut.v").alias("y"), F.col("train_end").alias("last_period"), F.lit(horizon).alias("horizon"))
    return _with_fallback(train, driver_models(train, freq, keys), weights, keys, freq)


def _with_fallback(train: DataFrame, forecasts: DataFrame, weights: DataFrame | None, keys: Sequence[str], freq: str
                   ) -> DataFrame:
    ens = driver_ensemble(forecasts, weights, (*keys, "step", "period"))
    steps = train.filter("horizon > 0").select(
        *keys, "last_period", F.element_at("y", -1).alias("last_value"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("horizon").cast("bigint"))).alias("step"))
    grid = steps.withColumn("period", period_add(F.col("last_period"), F.col("step"), freq)).drop("last_period")
    return grid.join(ens, [*keys, "step", "period"], "left").select(
        *keys, "step", "period", F.coalesce("yhat", "last_value").alias("yhat"))


def horizon_steps(long: DataFrame, target_ends: DataFrame, freq: str, horizon: int) -> DataFrame:
    """Per driver: its gap to the target's end, and the steps that cover gap and horizon."""
    ends = long.filter("value IS NOT NULL").groupBy(*KEYS).agg(F.max("period").alias("driver_end"))
    gap = period_ordinal(F.col("target_end"), freq) - period_ordinal(F.col("driver_end"), freq)
    return ends.join(target_ends, "series_id").withColumn("gap", gap).withColumn(
        "steps", F.greatest(F.col("gap") + horizon, F.lit(0)))


def gap_periods(steps: DataFrame, freq: str) -> DataFrame:
    """The periods each driver must be forecast for."""
    need = period_range(period_add(F.col("driver_end"), 1, freq), period_add(F.col("driver_end"), F.col("steps"), freq), freq)
    return steps.select(*KEYS, F.explode(need).alias("period"))


def driver_future(long: DataFrame, target_ends: DataFrame, weights: DataFrame | None, freq: str, horizon: int,
                  history: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Future-only rows and the history+future window (series_id, variable, period, value).

    Actual values win over forecasts; the window ends its history at the target's last period.
    """
    history = history or freq_params(freq)["history"]
    clean = clean_history(long, freq)
    steps = horizon_steps(clean, target_ends, freq, horizon)
    train = series_arrays(clean).join(steps.select(*KEYS, F.col("steps").cast("int").alias("horizon")), list(KEYS))
    forecasts = _with_fallback(train, driver_models(train.filter("horizon > 0"), freq, KEYS), weights, KEYS, freq)
    both = clean.select(*KEYS, "period", "value").unionByName(
        forecasts.select(*KEYS, "period", F.col("yhat").alias("value")))
    first = period_add(F.col("target_end"), 1 - history, freq)
    last = period_add(F.col("target_end"), horizon, freq)
    window = steps.select(*KEYS, "target_end", F.explode(period_range(first, last, freq)).alias("period"))
    filled = window.join(both, [*KEYS, "period"], "left")
    return (filled.filter("period > target_end").drop("target_end"), filled.drop("target_end"))
