"""Multi-step forecasts that feed each prediction back, as one JVM-side fold over the steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.features import history_std


def recursive_path(history: Column | str, phi: Column | str, effects: Column | str, lo: Column | None = None,
                   hi: Column | None = None, std_terms: list[tuple[Column, int]] = ()) -> Column:
    """Array of predictions: effect_t + sum_i phi_i * y_(t-i) + deviation terms.

    ``effects`` holds everything known in advance (intercept, drivers, calendar), one
    value per step; ``phi`` weighs the latest values first. The growing history is the
    only state. Predictions are clipped to [lo, hi] before they are fed back;
    one that is missing or not finite becomes the middle of the band.
    """
    history, phi, effects = (F.col(c) if isinstance(c, str) else c for c in (history, phi, effects))
    k = F.size(phi)

    def step(h: Column, effect: Column) -> Column:
        recent = F.reverse(F.slice(h, -k, k))
        y = effect + F.aggregate(F.zip_with(recent, phi, lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
        for coef, window in std_terms:
            y = y + coef * history_std(window, h)
        if lo is not None:
            lost = y.isNull() | F.isnan(y) | (F.abs(y) == F.lit(float("inf")))
            y = F.when(lost, (lo + hi) / 2).otherwise(F.greatest(F.least(y, hi), lo))
        return F.concat(h, F.array(y))

    grown = F.aggregate(effects, history, step)
    return F.when(F.size(history) >= k, F.slice(grown, F.size(history) + 1, F.size(effects)))


def explode_path(df: DataFrame, path: str, keep: list[str], periods: str = "periods") -> DataFrame:
    """(keep, step, period, yhat) rows of an array of predictions and its array of periods."""
    rows = df.select(*keep, F.posexplode(F.arrays_zip(F.col(periods).alias("period"), F.col(path).alias("yhat"))).alias("step", "r"))
    return rows.select(*keep, (F.col("step") + 1).cast("bigint").alias("step"), "r.period", "r.yhat")
