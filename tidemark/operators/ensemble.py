"""Choice of models, weights and weighted forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scores import percent_error
from tidemark.operators.metrics import is_multivariate, model_position, rank_models
from tidemark.settings import DEFAULTS, DRIVER_MODELS, MODEL_ORDER, UNIVARIATE_MODELS, Settings


def enabled_models(models: DataFrame, enabled: Sequence[str]) -> DataFrame:
    return models.filter(F.col("model").isin(*enabled))


def top_k_models(scores: DataFrame, settings: Settings = DEFAULTS, univariate=UNIVARIATE_MODELS, order=MODEL_ORDER
                 ) -> DataFrame:
    """Top K by score; when no multivariate model is among them the best one takes the last place."""
    k = settings.top_k
    ranked = rank_models(scores, order).withColumn("_multi", is_multivariate(F.col("model"), univariate))
    w = Window.partitionBy("series_id")
    best_multi = F.min(F.when(F.col("_multi"), F.col("model_rank"))).over(w)
    forced = best_multi > k
    last_free = F.when(forced, F.least(F.lit(k - 1), F.count(F.lit(1)).over(w))).otherwise(F.lit(k))
    chosen = ranked.withColumn("_pick", (F.col("model_rank") <= last_free) | (forced & (F.col("model_rank") == best_multi)))
    again = w.orderBy(F.desc("fq_score"), model_position(F.col("model"), order), "model")
    return chosen.filter("_pick").drop("_pick", "_multi").withColumn(
        "model_rank", F.row_number().over(again).cast("bigint"))


def score_weights(chosen: DataFrame, floor: float = 1e-6) -> DataFrame:
    """Weights proportional to the quality score."""
    s = F.greatest(F.col("fq_score"), F.lit(floor))
    return chosen.withColumn("weight", s / F.sum(s).over(Window.partitionBy("series_id")))


def select_ensemble(metrics: DataFrame, settings: Settings = DEFAULTS, univariate=UNIVARIATE_MODELS, order=MODEL_ORDER,
                    require_all_folds: bool = True) -> DataFrame:
    """Fold metrics to chosen models with weights."""
    from tidemark.operators.metrics import aggregate_folds

    scores = aggregate_folds(metrics, settings).filter("fq_score IS NOT NULL")
    if require_all_folds:
        most = F.max("n_folds").over(Window.partitionBy("series_id"))
        scores = scores.withColumn("_most", most).filter("n_folds = _most").drop("_most")
    return score_weights(top_k_models(scores, settings, univariate, order))


def inverse_mape_weights(errors: DataFrame, keys: Sequence[str] = ("series_id", "variable"), n_models: int = len(DRIVER_MODELS)
                         ) -> DataFrame:
    """(keys, model, mape) to weights 1/MAPE; no usable MAPE at all gives equal weights."""
    inverse = F.when(F.col("mape") > 0, 1 / F.col("mape")).otherwise(0.0)
    total = F.sum(inverse).over(Window.partitionBy(*keys))
    return errors.withColumn("weight", F.when(total > 0, inverse / total).otherwise(1.0 / n_models))


def ape_sums(scored: DataFrame, keys: Sequence[str] = ("series_id", "variable", "model")) -> DataFrame:
    """Sum and count of absolute percentage errors over all folds, and their ratio."""
    sums = scored.groupBy(*keys).agg(F.sum("ape").alias("err"), F.count("ape").alias("n"))
    return sums.withColumn("mape", F.when(F.col("n") > 0, F.col("err") / F.col("n")))


def attach_weights(forecasts: DataFrame, weights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Forecasts joined with their weights; Spark broadcasts the weights only when they are small."""
    return forecasts.join(weights.select(*keys, "weight"), list(keys), "left")


def weighted_ensemble(weighted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Weighted mean over the models present; weights that sum to nothing mean equal weights."""
    usable = F.col("yhat").isNotNull()
    w = F.when(usable, F.coalesce("weight", F.lit(0.0)))
    total = F.sum(w)
    mean = F.sum(w * F.col("yhat")) / total
    return weighted.groupBy(*keys).agg(F.when(total > 0, mean).otherwise(F.avg("yhat")).alias("yhat"))


def flat_fallback(forecasts: DataFrame, last_values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeat the last known value where no forecast exists."""
    return forecasts.join(last_values, list(keys), "left").withColumn(
        "yhat", F.coalesce("yhat", "last_value")).drop("last_value")


def holdout_results(forecasts: DataFrame, chosen: DataFrame, panel: DataFrame, folds: DataFrame,
                    models: Sequence[str]) -> DataFrame:
    """Latest fold as one row per date: actual, every model, the ensemble and percent errors."""
    latest = forecasts.join(folds.filter("fold = n_folds").select("series_id", "fold"), ["series_id", "fold"])
    ens = weighted_ensemble(
        latest.join(chosen.select("series_id", "model", "weight"), ["series_id", "model"]), ("series_id", "period"))
    cols = [F.max(F.when(F.col("model") == m, F.col("yhat"))).alias(f"forecast_{m}") for m in models]
    wide = latest.groupBy("series_id", "period").agg(*cols)
    out = wide.join(ens.withColumnRenamed("yhat", "forecast_ensemble"), ["series_id", "period"], "left").join(
        panel.select("series_id", "period", F.col("target").alias("actual")), ["series_id", "period"])
    names = [*models, "ensemble"]
    return out.select("series_id", "period", "actual", *[f"forecast_{m}" for m in names],
                      *[percent_error(F.col("actual"), F.col(f"forecast_{m}")).alias(f"pe_{m}") for m in names])


def future_table(forecasts: DataFrame, chosen: DataFrame, settings: Settings = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """Forecast table (one column per model rank plus ensemble) and the table of chosen models."""
    ranked = forecasts.join(chosen.select("series_id", "model", "model_rank", "weight"), ["series_id", "model"])
    # Ranks close up over the models that produced a forecast.
    w = Window.partitionBy("series_id", "period").orderBy("model_rank")
    ranked = ranked.filter("yhat IS NOT NULL").withColumn("_rank", F.row_number().over(w))
    ens = weighted_ensemble(ranked, ("series_id", "period"))
    tops = [F.max(F.when(F.col("_rank") == i, F.col("yhat"))).alias(f"forecast_top_{i}")
            for i in range(1, settings.top_k + 1)]
    wide = ranked.groupBy("series_id", "period", F.col("step").alias("step_id")).agg(*tops)
    table = wide.join(ens.withColumnRenamed("yhat", "forecast_ensemble"), ["series_id", "period"]).withColumn(
        "created_at", F.current_timestamp())
    names = ranked.select("series_id", F.col("_rank").cast("bigint").alias("model_rank"),
                          F.col("model").alias("model_name")).distinct()
    return table, names
