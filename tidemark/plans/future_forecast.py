"""Job 3: driver futures, refit on the whole history, ensemble forecast and risk report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import ensemble as E
from tidemark.operators.anomalies import driver_anomalies, series_risk
from tidemark.operators.drivers import driver_future
from tidemark.operators.folds import final_fold
from tidemark.operators.linear_models import center_panel
from tidemark.operators.panel import to_wide
from tidemark.operators.target_models import forecast_models
from tidemark.plans.feature_selection import mask_unselected
from tidemark.plans.model_selection import fill_unselected, selected_long
from tidemark.session import materialize
from tidemark.sources.sinks import append_risk_summary, write_csv, write_keyed
from tidemark.settings import DEFAULTS, Settings


def run_future_forecast(panel: DataFrame, drivers: Sequence[str], chosen: DataFrame, weights: DataFrame | None = None,
                        selected: DataFrame | None = None, freq: str = "M", horizon: int = 12,
                        settings: Settings = DEFAULTS, compat: bool = False) -> dict[str, DataFrame]:
    """Forecast table, chosen models, driver futures and the anomaly report.

    Only models chosen by some series are fitted; each series keeps its own. ``compat``
    leaves out the clamp of the recursion.
    """
    drivers = list(drivers)
    if selected is None:
        names = F.explode(F.array(*[F.lit(d) for d in drivers])).alias("variable")
        selected = panel.select("series_id").distinct().select("series_id", names)
    panel = materialize(mask_unselected(panel, selected, drivers))
    long = materialize(selected_long(panel, selected, drivers))
    ends = panel.groupBy("series_id").agg(F.max("period").alias("target_end"))
    future, window = driver_future(long, ends, weights, freq, horizon)
    future = materialize(future)
    folds = materialize(final_fold(panel))
    wide = fill_unselected(to_wide(future, drivers), selected, drivers).join(folds.select("series_id", "fold", "train_end"), "series_id")
    steps = F.row_number().over(_steps()).cast("bigint")
    wide = wide.withColumn("step", steps).drop("train_end")
    # At most the names of the catalogue come back.
    used = [r["model"] for r in chosen.select("model").distinct().collect()]
    forecasts = forecast_models(center_panel(panel, drivers, folds), folds, wide, drivers, freq,
                                settings.with_(models=tuple(m for m in settings.models if m in used)), clamp=not compat)
    forecasts = materialize(forecasts.join(chosen.select("series_id", "model"), ["series_id", "model"], "left_semi"))
    table, names = E.future_table(forecasts, chosen, settings)
    anomalies = materialize(driver_anomalies(long, future, settings))
    return {
        "future_drivers": future, "history_future": window, "forecasts": forecasts, "forecast_table": table,
        "model_selected": names, "anomalies": anomalies, "risk": series_risk(anomalies),
    }


def _steps():
    from pyspark.sql import Window

    return Window.partitionBy("series_id", "fold").orderBy("period")


def write_future_forecast(tables: dict[str, DataFrame], folder: str, run_id: str) -> None:
    for name in ("future_drivers", "history_future", "forecast_table", "model_selected", "anomalies"):
        write_keyed(tables[name], f"{folder}/{name}", run_id)
    write_csv(tables["anomalies"], f"{folder}/anomalies_csv", rounded=False)
    append_risk_summary(tables["risk"], f"{folder}/risk", run_id)
