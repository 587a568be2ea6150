"""Lag, rolling, calendar and driver features of the target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import calendar_features, calendar_names, freq_params

ROLLING = ("rolling_short", "rolling_long", "std_short", "std_long")


def lag_names(n_lags: int) -> list[str]:
    return [f"target_lag_{i}" for i in range(1, n_lags + 1)]


def _by_time(keys: Sequence[str] = ("series_id",)):
    return Window.partitionBy(*keys).orderBy("period")


def target_lags(target: str = "target", n_lags: int = 12) -> list[Column]:
    w = _by_time()
    return [F.lag(target, i).over(w).alias(f"target_lag_{i}") for i in range(1, n_lags + 1)]


def rolling_stats(target: str, freq: str) -> list[Column]:
    """Mean and sample deviation of the previous k periods; NULL until k values exist."""
    p = freq_params(freq)
    w = _by_time()
    out = []
    for fn, stat in ((F.avg, "rolling"), (F.stddev_samp, "std")):
        for size in ("short", "long"):
            k = p[f"roll_{size}"]
            frame = w.rowsBetween(-k, -1)
            out.append(F.when(F.count(target).over(frame) == k, fn(target).over(frame)).alias(f"{stat}_{size}"))
    return out


def feature_names(drivers: Sequence[str], freq: str, n_lags: int = 12) -> list[str]:
    return lag_names(n_lags) + list(drivers) + calendar_names(freq) + list(ROLLING)


def driver_columns(columns: Sequence[str], n_lags: int = 12) -> list[str]:
    """Feature names that are neither lags, calendar nor rolling statistics."""
    known = {"month", "week", "year", "season_sin", "season_cos", *ROLLING}
    return [c for c in columns if c not in known and not c.startswith("target_lag_")]


def drop_incomplete(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(features))


def make_target_features(panel: DataFrame, drivers: Sequence[str], freq: str = "M", target: str = "target",
                         n_lags: int = 12, keep: Sequence[str] = (), drop: bool = True) -> DataFrame:
    """All features in one select, so the plan holds a single sort and window per series."""
    keep = [c for c in dict.fromkeys(["series_id", "period", target, *keep])]
    out = panel.select(
        *keep,
        *target_lags(target, n_lags),
        *[F.col(d) for d in drivers],
        *calendar_features(F.col("period"), freq),
        *rolling_stats(target, freq),
    )
    return drop_incomplete(out, feature_names(drivers, freq, n_lags)) if drop else out


def history_array(panel: DataFrame, target: str, k: int, keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """The last k target values of each series, oldest first (k rows per series at most)."""
    w = Window.partitionBy(*keys).orderBy(F.desc("period"))
    recent = panel.filter(F.col(target).isNotNull()).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
    pairs = F.array_sort(F.collect_list(F.struct("period", F.col(target).alias("v"))))
    return recent.groupBy(*keys).agg(pairs.getField("v").alias("history"))


def history_lag(i: int, history: str = "history") -> Column:
    return F.element_at(history, F.lit(-i))


def history_mean(k: int, history: str = "history") -> Column:
    last = F.slice(history, -k, k)
    return F.aggregate(last, F.lit(0.0), lambda a, v: a + v) / k


def history_std(k: int, history: str = "history", population: bool = False) -> Column:
    m = history_mean(k, history)
    ss = F.aggregate(F.slice(history, -k, k), F.lit(0.0), lambda a, v: a + (v - m) * (v - m))
    return F.sqrt(ss / (k if population else k - 1))


def next_feature_row(state: DataFrame, drivers: Sequence[str], freq: str = "M", n_lags: int = 12,
                     keep: Sequence[str] = ("series_id", "period", "history"), compat: bool = False) -> DataFrame:
    """Features of the next period from a ``history`` array and that period's drivers.

    ``compat`` uses population deviations and lets windows longer than the lags fall
    back to the whole twelve-value history; the default matches the training features.
    """
    p = freq_params(freq)
    short, long = ((min(p["roll_short"], n_lags), min(p["roll_long"], n_lags)) if compat
                   else (p["roll_short"], p["roll_long"]))
    return state.select(
        *keep,
        *[history_lag(i).alias(n) for i, n in enumerate(lag_names(n_lags), 1)],
        *[F.col(d) for d in drivers],
        *calendar_features(F.col("period"), freq),
        history_mean(short).alias("rolling_short"), history_mean(long).alias("rolling_long"),
        history_std(short, population=compat).alias("std_short"),
        history_std(long, population=compat).alias("std_long"),
    )
