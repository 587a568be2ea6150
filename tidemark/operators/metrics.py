"""Forecast scoring: error, direction, band accuracy, fold means and the quality score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import period_add
from tidemark.functions.scores import absolute_percentage, finite, fqs
from tidemark.operators.folds import last_train_values
from tidemark.settings import DEFAULTS, MODEL_ORDER, UNIVARIATE_MODELS, Settings

GROUP = ("series_id", "fold", "model")


def score_rows(forecasts: DataFrame, panel: DataFrame, folds: DataFrame) -> DataFrame:
    """Forecasts beside the actual, the previous actual and the last training value."""
    actual = panel.select("series_id", "period", F.col("target").alias("actual"))
    return forecasts.join(actual, ["series_id", "period"]).join(
        last_train_values(panel, folds), ["series_id", "fold"])


def with_previous_actual(scored: DataFrame) -> DataFrame:
    w = Window.partitionBy(*GROUP).orderBy("period")
    return scored.withColumn("prev_actual", F.coalesce(F.lag("actual").over(w), F.col("last_train")))


def _errors(compat: bool) -> tuple[Column, Column]:
    """Forecast used for errors, and a flag that a group holds an unusable forecast."""
    usable = finite(F.col("yhat"))
    return (F.coalesce(usable, F.col("actual")), F.lit(False)) if compat else (usable, F.max(usable.isNull()))


def regression_metrics(scored: DataFrame, compat: bool = False) -> DataFrame:
    """MAE, MSE, RMSE, MAPE per group. A non-finite forecast makes them NULL
    (``compat``: it scores no error instead)."""
    f, broken = _errors(compat)
    err = F.col("actual") - f
    mse = F.avg(err * err)

    def unless_broken(c: Column) -> Column:
        return F.when(~broken, c)

    return scored.groupBy(*GROUP).agg(
        unless_broken(F.avg(F.abs(err))).alias("mae"), unless_broken(mse).alias("mse"),
        unless_broken(F.sqrt(mse)).alias("rmse"),
        unless_broken(F.avg(absolute_percentage(F.col("actual"), f))).alias("mape"),
    )


def _direction(f: Column) -> Column:
    true_delta = F.col("actual") - F.col("prev_actual")
    hit = F.signum(true_delta) == F.signum(f - F.col("prev_actual"))
    return F.coalesce(F.avg(F.when(true_delta != 0, F.coalesce(hit, F.lit(False)).cast("double"))), F.lit(1.0))


def _band(f: Column, band: float) -> Column:
    rel = F.abs(F.col("actual") - f) / F.greatest(F.abs(F.col("actual")), F.lit(1e-9))
    return F.avg(F.coalesce(rel <= band, F.lit(False)).cast("double"))


def directional_accuracy(scored: DataFrame) -> DataFrame:
    """Share of steps that move the right way from the previous actual."""
    return with_previous_actual(scored).groupBy(*GROUP).agg(_direction(finite(F.col("yhat"))).alias("da"))


def within_band_accuracy(scored: DataFrame, band: float = 0.10) -> DataFrame:
    return scored.groupBy(*GROUP).agg(_band(finite(F.col("yhat")), band).alias("wba"))


def forecast_metrics(scored: DataFrame, settings: Settings = DEFAULTS, compat: bool = False) -> DataFrame:
    """All metrics of every (series, fold, model) in one window and one aggregate."""
    f, broken = _errors(compat)
    err = F.col("actual") - f
    raw = finite(F.col("yhat"))
    out = with_previous_actual(scored).groupBy(*GROUP).agg(
        broken.alias("_broken") if not compat else F.first(F.lit(False)).alias("_broken"),
        F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(absolute_percentage(F.col("actual"), f)).alias("mape"),
        _direction(raw).alias("da"), _band(raw, settings.band).alias("wba"),
    )
    keep = {m: F.when(~F.col("_broken"), F.col(m)) for m in ("mae", "rmse", "mape")}
    return out.withColumns(keep).drop("_broken")


def per_fold_report(metrics: DataFrame, folds: DataFrame) -> DataFrame:
    return metrics.join(folds, ["series_id", "fold"]).select(
        "series_id", "fold", F.col("n_folds").alias("n_folds_total"), F.col("model").alias("model_name"),
        "train_start", "train_end", "holdout_start", "holdout_end", "mae", "rmse", "mape", "da", "wba")


def aggregate_folds(metrics: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Fold means per model, the number of folds, and the quality score."""
    means = metrics.groupBy("series_id", "model").agg(
        *[F.avg(m).alias(m) for m in ("mae", "rmse", "mape", "da", "wba")], F.count("mape").alias("n_folds"))
    return means.withColumn("fq_score", fqs(F.col("da"), F.col("mape"), F.col("wba"), settings))


def model_position(model: Column, order=MODEL_ORDER) -> Column:
    known = F.array_position(F.array(*[F.lit(m) for m in order]), model)
    return F.when(known > 0, known).otherwise(len(order) + 1)


def rank_models(scores: DataFrame, order=MODEL_ORDER) -> DataFrame:
    """Rank by score; ties keep the training order."""
    w = Window.partitionBy("series_id").orderBy(F.desc("fq_score"), model_position(F.col("model"), order), "model")
    return scores.withColumn("model_rank", F.row_number().over(w).cast("bigint"))


def is_multivariate(model: Column, univariate=UNIVARIATE_MODELS) -> Column:
    return ~model.isin(*univariate)


def split_report(scores: DataFrame, univariate=UNIVARIATE_MODELS, order=MODEL_ORDER) -> DataFrame:
    """Ranking inside the multivariate and the univariate family."""
    family = F.when(is_multivariate(F.col("model"), univariate), "multivariate").otherwise("univariate")
    w = Window.partitionBy("series_id", "section").orderBy(
        F.desc("fq_score"), model_position(F.col("model"), order), "model")
    return scores.withColumn("section", family).withColumn("section_rank", F.row_number().over(w).cast("bigint"))


def naive_last(panel: DataFrame, folds: DataFrame) -> DataFrame:
    """The last training value repeated over each holdout."""
    from tidemark.operators.folds import holdout_rows

    steps = holdout_rows(panel.select("series_id", "period"), folds)
    return steps.join(last_train_values(panel, folds), ["series_id", "fold"]).select(
        "series_id", "fold", F.lit("naive_last").alias("model"), "step", "period", F.col("last_train").alias("yhat"))


def naive_seasonal(panel: DataFrame, folds: DataFrame, freq: str, season: int) -> DataFrame:
    """The value one season earlier; only when every holdout period has one."""
    from tidemark.operators.folds import holdout_rows

    steps = holdout_rows(panel.select("series_id", "period"), folds)
    old = panel.select("series_id", period_add(F.col("period"), season, freq).alias("period"), F.col("target").alias("yhat"))
    w = Window.partitionBy("series_id", "fold")
    joined = steps.join(old, ["series_id", "period"], "left").withColumn(
        "_all", F.count_if(F.col("yhat").isNull()).over(w) == 0)
    return joined.filter("_all").select(
        "series_id", "fold", F.lit("naive_seasonal").alias("model"), "step", "period", "yhat")


def naive_mape(panel: DataFrame, folds: DataFrame, freq: str, season: int) -> DataFrame:
    """MAPE of both baselines on the latest fold."""
    latest = folds.filter("fold = n_folds")
    both = naive_last(panel, latest).unionByName(naive_seasonal(panel, latest, freq, season))
    scored = score_rows(both, panel, latest)
    return regression_metrics(scored).select("series_id", "fold", "model", "mape")


def metrics_report(scores: DataFrame, ensemble: DataFrame, naive: DataFrame, panel_mean: DataFrame,
                   univariate=UNIVARIATE_MODELS, order=MODEL_ORDER) -> DataFrame:
    """The ranked text report as rows (series_id, section, rank, model, mape, fq_score, line)."""
    ranked = split_report(scores, univariate, order).select(
        "series_id", "section", F.col("section_rank").alias("rank"), "model", "mape", "fq_score")
    none = F.lit(None).cast("double")
    one = F.lit(1).cast("bigint")
    ens = ensemble.select("series_id", F.lit("ensemble").alias("section"), one.alias("rank"),
                          F.lit("ensemble").alias("model"), "mape", none.alias("fq_score"))
    base = naive.select("series_id", F.lit("naive").alias("section"), one.alias("rank"), "model", "mape",
                        none.alias("fq_score"))
    mean = panel_mean.select("series_id", F.lit("mean_actual").alias("section"), one.alias("rank"),
                             F.lit("mean_actual").alias("model"), F.col("mean_actual").alias("mape"), none.alias("fq_score"))
    rows = ranked.unionByName(ens).unionByName(base).unionByName(mean)
    text = F.when(F.col("section") == "mean_actual", F.format_string("mean actual %.4f", F.col("mape"))).when(
        F.col("fq_score").isNotNull(), F.format_string("%d. %s MAPE %.4f FQS %.4f", "rank", "model", "mape", "fq_score")
    ).otherwise(F.format_string("%s MAPE %.4f", F.col("model"), F.col("mape")))
    return rows.withColumn("line", F.when(F.col("mape").isNotNull(), text).otherwise(F.concat("model", F.lit(" without score"))))
