"""Job 2: backtest of all target models and the choice of an ensemble per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import freq_params
from tidemark.operators import ensemble as E
from tidemark.operators import metrics as M
from tidemark.operators.drivers import driver_backtest_weights, driver_holdout, weights_table
from tidemark.operators.folds import make_folds, sufficiency
from tidemark.operators.linear_models import center_panel
from tidemark.operators.panel import to_long, to_wide
from tidemark.operators.target_models import forecast_models
from tidemark.plans.feature_selection import mask_unselected
from tidemark.session import materialize
from tidemark.sources.sinks import write_csv, write_keyed
from tidemark.settings import DEFAULTS, Settings


def selected_long(panel: DataFrame, selected: DataFrame, drivers: Sequence[str]) -> DataFrame:
    return to_long(panel, drivers).join(selected.select("series_id", "variable"), ["series_id", "variable"], "left_semi")


def fill_unselected(future: DataFrame, selected: DataFrame, drivers: Sequence[str]) -> DataFrame:
    """Zero for the drivers a series does not use, as in training; a used driver without forecast stays NULL."""
    own = selected.groupBy("series_id").agg(F.collect_set("variable").alias("_own"))
    rows = future.join(own, "series_id", "left")
    return rows.withColumns({d: F.when(F.array_contains("_own", d), F.col(d)).otherwise(0.0) for d in drivers}).drop("_own")


def failure_table(short: DataFrame, future: DataFrame, selected: DataFrame, drivers: Sequence[str], fits: Sequence[DataFrame],
                  lost: DataFrame) -> DataFrame:
    """(series_id, fold, model, item, reason) of everything that dropped out: series, driver forecasts, fits, model forecasts.

    ``fits`` hold the reasons of failed fits, ``lost`` the models without a usable forecast.
    """
    columns = ["series_id", "fold", "model", "item", "reason"]
    series = short.select("series_id", F.lit(None).cast("bigint").alias("fold"), F.lit(None).cast("string").alias("model"),
                          F.lit("series").alias("item"), F.concat(F.lit("too short: "), "n_rows", F.lit(" rows")).alias("reason"))
    empty = F.array_compact(F.array(*[F.when(F.col(d).isNull(), F.lit(d)) for d in drivers]))
    paths = future.groupBy("series_id", "fold").agg(F.array_distinct(F.flatten(F.collect_list(empty))).alias("_d"))
    missing = paths.select("series_id", "fold", F.explode("_d").alias("item")).join(
        selected.select("series_id", F.col("variable").alias("item")), ["series_id", "item"], "left_semi")
    missing = missing.select("series_id", "fold", F.lit(None).cast("string").alias("model"), "item", F.lit("no forecast for this driver").alias("reason"))
    out = series.unionByName(missing)
    known = None
    for one in fits:
        known = one if known is None else known.unionByName(one)
    if known is not None:
        out = out.unionByName(known.withColumn("item", F.lit("fit")).select(*columns))
        lost = lost.join(known, ["series_id", "fold", "model"], "left_anti")
    without = missing.select("series_id", "fold", F.lit(True).alias("_gap")).distinct()
    rest = lost.join(without, ["series_id", "fold"], "left").withColumn(
        "reason", F.when(F.col("_gap"), "a driver has no forecast").otherwise("no finite forecast"))
    return out.unionByName(rest.withColumn("item", F.lit("forecast")).select(*columns))


def run_model_selection(panel: DataFrame, drivers: Sequence[str], selected: DataFrame | None = None, freq: str = "M",
                        horizon: int = 12, settings: Settings = DEFAULTS, history: DataFrame | None = None
                        ) -> dict[str, DataFrame]:
    """Weights, driver holdouts, forecasts, metrics, chosen models and reports.

    ``history`` may hold the drivers' full untrimmed past (long) for the driver weights.
    What fails drops out alone and is listed in ``failures``: short series, drivers without forecast, fits, model forecasts.
    """
    drivers = list(drivers)
    if selected is None:
        names = F.explode(F.array(*[F.lit(d) for d in drivers])).alias("variable")
        selected = panel.select("series_id").distinct().select("series_id", names)
    panel = materialize(mask_unselected(panel, selected, drivers))
    short = sufficiency(panel, horizon, settings).filter("NOT sufficient").select("series_id", "n_rows")
    folds = materialize(make_folds(panel, horizon, settings))
    long = materialize(selected_long(panel, selected, drivers))
    weights = materialize(driver_backtest_weights(history if history is not None else long, freq, horizon, settings.max_folds))
    driver_paths = materialize(driver_holdout(long, folds, weights, freq, horizon))
    future = to_wide(driver_paths.withColumnRenamed("yhat", "value"), drivers, ("series_id", "fold", "step", "period"))
    future = fill_unselected(future, selected, drivers)
    centered = materialize(center_panel(panel, drivers, folds))
    future, failed = materialize(future), []
    forecasts = materialize(forecast_models(centered, folds, future, drivers, freq, settings, failures=failed))
    scored = M.score_rows(forecasts, panel, folds)
    metrics = materialize(M.forecast_metrics(scored, settings))
    scores = materialize(M.aggregate_folds(metrics, settings))
    chosen = materialize(E.select_ensemble(metrics, settings))
    season = freq_params(freq)["season"]
    naive = M.naive_mape(panel, folds, freq, season)
    results = materialize(E.holdout_results(forecasts, chosen, panel, folds, settings.models))
    ens = results.select("series_id", "period", F.lit(0).alias("fold"), F.lit("ensemble").alias("model"), "actual",
                         F.col("forecast_ensemble").alias("yhat"))
    ens_metrics = M.regression_metrics(ens)
    mean = results.groupBy("series_id").agg(F.avg("actual").alias("mean_actual"))
    expected = folds.select("series_id", "fold", F.explode(F.array(*[F.lit(m) for m in settings.models])).alias("model"))
    lost = expected.join(metrics.filter("mape IS NOT NULL"), ["series_id", "fold", "model"], "left_anti")
    failures = failure_table(short, future, selected, drivers, failed, lost)
    return {
        "folds": folds, "insufficient": short, "driver_weights": weights, "driver_weights_table": weights_table(weights),
        "driver_holdout": driver_paths, "forecasts": forecasts, "metrics": metrics,
        "per_fold": M.per_fold_report(metrics, folds), "scores": scores, "chosen": chosen, "holdout": results,
        "ensemble_metrics": ens_metrics, "report": M.metrics_report(scores, ens_metrics, naive, mean), "failures": failures,
    }


def write_model_selection(tables: dict[str, DataFrame], folder: str, run_id: str | None = None) -> None:
    """Hand-over tables, beside those of other runs if the run has a name, and the reports."""
    for name in ("driver_weights", "driver_holdout", "chosen", "per_fold", "holdout", "failures"):
        write_keyed(tables[name], f"{folder}/{name}", run_id)
    write_csv(tables["driver_weights_table"], f"{folder}/driver_weights_csv")
    write_csv(tables["per_fold"], f"{folder}/per_fold_csv", rounded=False)
    write_csv(tables["report"], f"{folder}/report_csv", rounded=False)
