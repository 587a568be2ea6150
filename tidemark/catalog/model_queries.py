"""Queries over folds, forecasts, scores, weights, models and the three jobs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.catalog import solve_sql as Q
from tidemark.catalog.base import DRIVERS, cte, nation_panel, panel, query
from tidemark.functions.scores import clamp, risk_label
from tidemark.operators import drivers as D
from tidemark.operators import ensemble as E
from tidemark.operators import folds as FO
from tidemark.operators import gram as G
from tidemark.operators import importance as I
from tidemark.operators import metrics as M
from tidemark.operators import selection as S
from tidemark.operators import univariate as U
from tidemark.operators.differencing import differencing, seasonal_strength
from tidemark.operators.anomalies import driver_anomalies, path_stats, series_risk
from tidemark.operators.features import history_array
from tidemark.operators.linear_models import LINEAR_MODELS, center_panel, fit_linear, forecast_linear
from tidemark.operators.panel import to_long
from tidemark.operators.recursion import explode_path, recursive_path
from tidemark.operators.target_models import forecast_univariate
from tidemark.operators import trees as TR
from tidemark.operators.tree_models import TREE_MODELS, fit_trees, forecast_pooled, forecast_trees, tree_rows
from tidemark.plans.feature_selection import run_feature_selection
from tidemark.plans.future_forecast import run_future_forecast
from tidemark.plans.model_selection import run_model_selection
from tidemark.session import materialize, scratch_path
from tidemark.settings import DEFAULTS
from tidemark.sources import sinks
from tidemark.sources import tables as T

H = 12
SERIES = ("naive_last", "naive_seasonal")
_SCORES = "mae:5 rmse:3 mape:8 da:8 wba:8"


# ---- folds ---------------------------------------------------------------------------------


@query("fold_index", "series_id period:d fold:i", "SELECT * FROM fold_rows", "fold_rows")
def _(spark, sf):
    return FO.fold_index(panel(spark, sf), H)


@query("make_folds", "series_id fold:i n_folds:i train_start:d train_end:d holdout_start:d holdout_end:d", "SELECT * FROM folds", "folds")
def _(spark, sf):
    return FO.make_folds(panel(spark, sf), H)


@query("sufficiency_check", "series_id n_rows:i n_folds:i sufficient", """
SELECT series_id, count(*) AS n_rows, greatest(least(2, (count(*) - 18) // 12), 0) AS n_folds,
  count(*) > 30 AND (count(*) - 18) // 12 >= 1 AS sufficient FROM nation GROUP BY 1""", "nation")
def _(spark, sf):
    return FO.sufficiency(nation_panel(spark, sf), H)


@query("train_holdout_cross", "series_id fold:i role n:i", """
SELECT p.series_id, fold, CASE WHEN period <= train_end THEN 'train' ELSE 'holdout' END AS role, count(*) AS n
FROM panel p JOIN folds f ON p.series_id = f.series_id AND period <= holdout_end GROUP BY 1, 2, 3""", "folds")
def _(spark, sf):
    p = panel(spark, sf)
    return FO.train_holdout(p, FO.make_folds(p, H)).groupBy("series_id", "fold", "role").agg(F.count(F.lit(1)).alias("n"))


# ---- baselines and recursion ---------------------------------------------------------------


def _setup(spark, sf):
    p = panel(spark, sf)
    return p, FO.make_folds(p, H)


@query("naive_last", "series_id fold:i step:i period:d yhat", "SELECT * FROM naive WHERE model = 'naive_last'", "naive")
def _(spark, sf):
    return M.naive_last(*_setup(spark, sf))


@query("seasonal_offset_join", "series_id fold:i step:i period:d yhat", "SELECT * FROM naive WHERE model = 'naive_seasonal'", "naive")
def _(spark, sf):
    return M.naive_seasonal(*_setup(spark, sf), "M", H)


@query("naive_mape", "series_id fold:i model mape:8", "SELECT * FROM met JOIN folds USING (series_id, fold) WHERE fold = n_folds AND model <> 'fixed'", "met")
def _(spark, sf):
    return M.naive_mape(*_setup(spark, sf), "M", H)


def _fixed(p, folds):
    """A linear recursion with given coefficients on the log target."""
    log = p.withColumn("y", F.ln("target"))
    train = FO.training_rows(log.select("series_id", "period", "y"), folds)
    band = train.groupBy("series_id", "fold").agg(F.avg("y").alias("m"), F.stddev_pop("y").alias("s"))
    steps = FO.holdout_rows(p.select("series_id", "period"), folds).groupBy("series_id", "fold").agg(
        F.array_sort(F.collect_list("period")).alias("periods"))
    state = history_array(train, "y", H, ("series_id", "fold")).join(band, ["series_id", "fold"]).join(steps, ["series_id", "fold"])
    third = 0.5 / 3
    phi = F.array(*[F.lit(v) for v in (0.2 + third, third, third, *[0.0] * 8, 0.3)])
    reach = 5 * F.greatest("s", F.lit(1e-6))
    path = recursive_path("history", phi, F.array_repeat(F.lit(0.0), H), F.col("m") - reach, F.col("m") + reach, [(F.lit(-0.05), 3)])
    rows = explode_path(state.withColumn("path", path), "path", ["series_id", "fold"])
    return rows.select("series_id", "fold", F.lit("fixed").alias("model"), "step", "period", F.exp("yhat").alias("yhat"))


@query("recursive_forecast", "series_id fold:i step:i period:d yhat:2", "SELECT * FROM fixed", "fixed")
def _(spark, sf):
    return _fixed(*_setup(spark, sf))


def _forecasts(p, folds):
    return M.naive_last(p, folds).unionByName(M.naive_seasonal(p, folds, "M", H)).unionByName(_fixed(p, folds))


def _scored(spark, sf):
    p, folds = _setup(spark, sf)
    return M.score_rows(_forecasts(p, folds), p, folds)


@query("union_models", "series_id fold:i model step:i period:d yhat:2", "SELECT * FROM fc", "fc")
def _(spark, sf):
    return _forecasts(*_setup(spark, sf))


@query("model_enable_filter", "series_id model n:i", "SELECT series_id, model, count(*) AS n FROM fc WHERE model <> 'fixed' GROUP BY 1, 2", "fc")
def _(spark, sf):
    return E.enabled_models(_forecasts(*_setup(spark, sf)), SERIES).groupBy("series_id", "model").agg(F.count(F.lit(1)).alias("n"))


@query("clamp_to_training_band", "series_id fold:i period:d value:8", """
SELECT h.series_id, h.fold, h.period, greatest(least(3 * ln(h.target) - 2 * b.m, b.m + 5 * b.s), b.m - 5 * b.s) AS value
FROM hold h JOIN bands b USING (series_id, fold)""", "hold bands")
def _(spark, sf):
    p, folds = _setup(spark, sf)
    log = p.withColumn("y", F.ln("target"))
    band = FO.training_rows(log, folds).groupBy("series_id", "fold").agg(F.avg("y").alias("m"), F.stddev_pop("y").alias("s"))
    rows = FO.holdout_rows(log, folds).join(band, ["series_id", "fold"])
    return rows.withColumn("value", clamp(3 * F.col("y") - 2 * F.col("m"), F.col("m"), F.col("s")))


# ---- scores --------------------------------------------------------------------------------


@query("prev_actual", "series_id fold:i model step:i prev_actual", "SELECT *, prev AS prev_actual FROM scored", "scored")
def _(spark, sf):
    return M.with_previous_actual(_scored(spark, sf))


@query("regression_metrics", "series_id fold:i model mae:5 mse:-3 rmse:3 mape:8", "SELECT * FROM met", "met")
def _(spark, sf):
    return M.regression_metrics(_scored(spark, sf))


@query("directional_accuracy", "series_id fold:i model da:8", "SELECT * FROM met", "met")
def _(spark, sf):
    return M.directional_accuracy(_scored(spark, sf))


@query("within_band_accuracy", "series_id fold:i model wba:8", "SELECT * FROM met", "met")
def _(spark, sf):
    return M.within_band_accuracy(_scored(spark, sf))


@query("forecast_metrics", f"series_id fold:i model {_SCORES}", "SELECT * FROM met", "met")
def _(spark, sf):
    return M.forecast_metrics(_scored(spark, sf))


@query("per_fold_report", f"series_id fold:i n_folds_total:i model_name train_end:d holdout_start:d {_SCORES}", """
SELECT *, n_folds AS n_folds_total, model AS model_name FROM met JOIN folds USING (series_id, fold)""", "met")
def _(spark, sf):
    p, folds = _setup(spark, sf)
    return M.per_fold_report(M.forecast_metrics(M.score_rows(_forecasts(p, folds), p, folds)), folds)


def _metrics(spark, sf):
    return M.forecast_metrics(_scored(spark, sf))


@query("aggregate_folds", f"series_id model n_folds:i {_SCORES}", "SELECT * FROM agg", "agg")
def _(spark, sf):
    return M.aggregate_folds(_metrics(spark, sf))


@query("fqs", "series_id model fq_score:8", "SELECT * FROM agg", "agg")
def _(spark, sf):
    return M.aggregate_folds(_metrics(spark, sf))


_ORDER = ("fixed", *SERIES)


@query("rank_models", "series_id model fq_score:8 model_rank:i", "SELECT * FROM ranked", "ranked")
def _(spark, sf):
    return M.rank_models(M.aggregate_folds(_metrics(spark, sf)), _ORDER)


@query("split_report", "series_id section model section_rank:i", """
SELECT *, CASE WHEN multi THEN 'multivariate' ELSE 'univariate' END AS section,
  row_number() OVER (PARTITION BY series_id, multi ORDER BY fq_score DESC, model) AS section_rank FROM ranked""", "ranked")
def _(spark, sf):
    return M.split_report(M.aggregate_folds(_metrics(spark, sf)), SERIES, _ORDER)


@query("top_k_with_forced_family", "series_id model model_rank:i", "SELECT series_id, model, new_rank AS model_rank FROM chosen", "chosen")
def _(spark, sf):
    return E.top_k_models(M.aggregate_folds(_metrics(spark, sf)), DEFAULTS, SERIES, _ORDER)


@query("select_ensemble", "series_id model model_rank:i fq_score:8 weight:8", "SELECT * EXCLUDE (model_rank), new_rank AS model_rank FROM chosen", "chosen")
def _(spark, sf):
    return E.select_ensemble(_metrics(spark, sf), DEFAULTS, SERIES, _ORDER)


cte("ens", "SELECT series_id, fold, period, sum(weight * yhat) / sum(weight) AS yhat FROM fc JOIN chosen USING (series_id, model) GROUP BY 1, 2, 3", "fc chosen")


def _chosen(p, folds):
    forecasts = _forecasts(p, folds)
    metrics = M.forecast_metrics(M.score_rows(forecasts, p, folds))
    return forecasts, E.select_ensemble(metrics, DEFAULTS, SERIES, _ORDER)


@query("weighted_ensemble", "series_id fold:i period:d yhat:2", "SELECT * FROM ens", "ens")
def _(spark, sf):
    forecasts, chosen = _chosen(*_setup(spark, sf))
    return E.weighted_ensemble(forecasts.join(chosen.select("series_id", "model", "weight"), ["series_id", "model"]), ("series_id", "fold", "period"))


@query("attach_weights", "series_id fold:i model step:i weight:8", "SELECT f.*, c.weight FROM fc f LEFT JOIN chosen c USING (series_id, model)", "fc chosen")
def _(spark, sf):
    forecasts, chosen = _chosen(*_setup(spark, sf))
    return E.attach_weights(forecasts, chosen, ("series_id", "model"))


cte("results", """
SELECT h.series_id, h.period, h.target AS actual, max(f.yhat) FILTER (WHERE f.model = 'fixed') AS forecast_fixed,
  max(f.yhat) FILTER (WHERE f.model = 'naive_last') AS forecast_naive_last, max(f.yhat) FILTER (WHERE f.model = 'naive_seasonal') AS forecast_naive_seasonal,
  max(e.yhat) AS forecast_ensemble
FROM hold h JOIN fc f USING (series_id, fold, period) JOIN ens e USING (series_id, fold, period)
WHERE h.fold = h.n_folds GROUP BY 1, 2, 3""", "ens hold")


@query("holdout_results", "series_id period:d actual forecast_fixed:2 forecast_naive_last forecast_naive_seasonal forecast_ensemble:2 pe_fixed:6 pe_ensemble:6", """
SELECT *, abs(actual - forecast_fixed) / actual * 100 AS pe_fixed, abs(actual - forecast_ensemble) / actual * 100 AS pe_ensemble FROM results""", "results")
def _(spark, sf):
    p, folds = _setup(spark, sf)
    forecasts, chosen = _chosen(p, folds)
    return E.holdout_results(forecasts, chosen, p, folds, _ORDER)


@query("metrics_report", "series_id section rank:i model mape:6 fq_score:8", """
SELECT series_id, CASE WHEN multi THEN 'multivariate' ELSE 'univariate' END AS section,
  row_number() OVER (PARTITION BY series_id, multi ORDER BY fq_score DESC, model) AS rank, model, mape, fq_score FROM ranked
UNION ALL SELECT series_id, 'ensemble', 1, 'ensemble', avg(abs(actual - forecast_ensemble) / actual), NULL FROM results GROUP BY 1
UNION ALL SELECT series_id, 'naive', 1, model, mape, NULL FROM met JOIN folds USING (series_id, fold) WHERE fold = n_folds AND model <> 'fixed'
UNION ALL SELECT series_id, 'mean_actual', 1, 'mean_actual', avg(actual), NULL FROM results GROUP BY 1""", "results ranked")
def _(spark, sf):
    p, folds = _setup(spark, sf)
    forecasts = _forecasts(p, folds)
    metrics = materialize(M.forecast_metrics(M.score_rows(forecasts, p, folds)))
    chosen = E.select_ensemble(metrics, DEFAULTS, SERIES, _ORDER)
    results = materialize(E.holdout_results(forecasts, chosen, p, folds, _ORDER))
    ens = results.select("series_id", "period", F.lit(0).alias("fold"), F.lit("ensemble").alias("model"), "actual", F.col("forecast_ensemble").alias("yhat"))
    mean = results.groupBy("series_id").agg(F.avg("actual").alias("mean_actual"))
    return M.metrics_report(M.aggregate_folds(metrics), M.regression_metrics(ens), M.naive_mape(p, folds, "M", H), mean, SERIES, _ORDER)


@query("write_selected_models", "series_id model model_rank:i weight:8", "SELECT series_id, model, new_rank AS model_rank, weight FROM chosen", "chosen")
def _(spark, sf):
    _, chosen = _chosen(*_setup(spark, sf))
    return T.read_selected_models(spark, sinks.write_table(chosen, scratch_path(spark, "chosen")))


@query("write_future_forecast", "series_id step_id:i period:d forecast_top_1:2 forecast_top_2:2 forecast_ensemble:2", """
SELECT series_id, step AS step_id, period, max(f.yhat) FILTER (WHERE new_rank = 1) AS forecast_top_1,
  max(f.yhat) FILTER (WHERE new_rank = 2) AS forecast_top_2, max(e.yhat) AS forecast_ensemble
FROM fc f JOIN chosen c USING (series_id, model) JOIN ens e USING (series_id, fold, period) JOIN folds USING (series_id, fold)
WHERE fold = folds.n_folds GROUP BY 1, 2, 3""", "ens")
def _(spark, sf):
    p, folds = _setup(spark, sf)
    forecasts, chosen = _chosen(p, folds)
    latest = forecasts.join(folds.filter("fold = n_folds").select("series_id", "fold"), ["series_id", "fold"]).drop("fold")
    return E.future_table(latest, chosen)[0]


# ---- driver side ---------------------------------------------------------------------------

# Three simple driver forecasts over the last 24 rows: one season back, two seasons back, their mean.
cte("drv", """
SELECT series_id, variable, period, value AS actual, unnest(['ets', 'arima', 'theta']) AS model, unnest([a, b, (a + b) / 2]) AS yhat
FROM (SELECT *, lag(value, 12) OVER (PARTITION BY series_id, variable ORDER BY period) AS a,
    lag(value, 24) OVER (PARTITION BY series_id, variable ORDER BY period) AS b,
    row_number() OVER (PARTITION BY series_id, variable ORDER BY period DESC) AS rn FROM nlong) WHERE rn <= 24""", "nlong")
cte("nlong", f"SELECT series_id, period, variable, value FROM nation UNPIVOT INCLUDE NULLS (value FOR variable IN ({', '.join(DRIVERS)}))", "nation")
cte("ape", """
SELECT series_id, variable, model, sum(abs(actual - yhat) / abs(actual)) FILTER (WHERE actual <> 0) AS err,
  count(abs(actual - yhat)) FILTER (WHERE actual <> 0) AS n FROM drv GROUP BY 1, 2, 3""", "drv")
cte("inv", """
SELECT *, CASE WHEN total > 0 THEN i / total ELSE 1.0 / 3 END AS weight FROM (
  SELECT *, sum(i) OVER (PARTITION BY series_id, variable) AS total FROM (
    SELECT *, CASE WHEN n > 0 AND err > 0 THEN n / err ELSE 0 END AS i, CASE WHEN n > 0 THEN err / n END AS mape FROM ape))""", "ape")


def _driver_forecasts(spark, sf):
    w = Window.partitionBy("series_id", "variable")
    by = w.orderBy("period")
    long = to_long(nation_panel(spark, sf), DRIVERS)
    rows = long.withColumns({"a": F.lag("value", 12).over(by), "b": F.lag("value", 24).over(by),
                             "rn": F.row_number().over(w.orderBy(F.desc("period")))}).filter("rn <= 24")
    paths = F.create_map(F.lit("ets"), F.col("a"), F.lit("arima"), F.col("b"), F.lit("theta"), (F.col("a") + F.col("b")) / 2)
    return rows.select("series_id", "variable", "period", F.col("value").alias("actual"), F.explode(paths).alias("model", "yhat"))


def _driver_errors(spark, sf):
    from tidemark.functions.scores import driver_ape

    return E.ape_sums(_driver_forecasts(spark, sf).withColumn("ape", driver_ape(F.col("actual"), F.col("yhat"))))


@query("ape_accumulate", "series_id variable model err:8 n:i", "SELECT * FROM ape", "ape")
def _(spark, sf):
    return _driver_errors(spark, sf)


@query("inverse_mape_weights", "series_id variable model mape:8 weight:8", "SELECT * FROM inv", "inv")
def _(spark, sf):
    return E.inverse_mape_weights(_driver_errors(spark, sf))


@query("weights_table", "series_id variable mape_ets:8 weight_arima:8 count_theta:i", """
SELECT series_id, variable, max(mape) FILTER (WHERE model = 'ets') AS mape_ets, max(weight) FILTER (WHERE model = 'arima') AS weight_arima,
  max(n) FILTER (WHERE model = 'theta') AS count_theta FROM inv GROUP BY 1, 2""", "inv")
def _(spark, sf):
    return D.weights_table(E.inverse_mape_weights(_driver_errors(spark, sf)))


@query("read_weights", "series_id variable model weight:8", "SELECT * FROM inv", "inv")
def _(spark, sf):
    w = E.inverse_mape_weights(_driver_errors(spark, sf))
    return T.read_weights(spark, sinks.write_table(w, scratch_path(spark, "weights")))


cte("dens", """
SELECT series_id, variable, period, CASE WHEN sum(weight) > 0 THEN sum(weight * yhat) / sum(weight) ELSE avg(yhat) END AS yhat
FROM (SELECT d.*, CASE WHEN d.yhat IS NOT NULL THEN i.weight END AS weight FROM drv d JOIN inv i USING (series_id, variable, model)) GROUP BY 1, 2, 3""", "inv")


@query("driver_ensemble", "series_id variable period:d yhat:7", "SELECT * FROM dens", "dens")
def _(spark, sf):
    f = _driver_forecasts(spark, sf)
    return D.driver_ensemble(f, E.inverse_mape_weights(_driver_errors(spark, sf)), ("series_id", "variable", "period"))


@query("flat_fallback", "series_id variable period:d yhat:7", """
SELECT d.series_id, d.variable, d.period, coalesce(d.yhat, l.v) AS yhat FROM dens d JOIN (
  SELECT series_id, variable, arg_max(value, period) AS v FROM nlong GROUP BY 1, 2) l USING (series_id, variable)""", "dens")
def _(spark, sf):
    keys = ("series_id", "variable")
    ens = D.driver_ensemble(_driver_forecasts(spark, sf), E.inverse_mape_weights(_driver_errors(spark, sf)), (*keys, "period"))
    last = to_long(nation_panel(spark, sf), DRIVERS).filter("value IS NOT NULL").groupBy(*keys).agg(F.max_by("value", "period").alias("last_value"))
    return E.flat_fallback(ens, last, keys)


_CUT = "2000-07-01"
cte("hist", f"SELECT * FROM long WHERE period <= DATE '{_CUT}'", "long")
cte("fut", f"SELECT * FROM long WHERE period > DATE '{_CUT}'", "long")
cte("anom", """
SELECT *, CASE WHEN n_out > 0 THEN 40.0 ELSE 0 END + CASE WHEN abs(jump) > 0.5 THEN 40.0 ELSE 0 END
  + CASE WHEN CASE WHEN hs > 0 THEN fs < 0.05 * hs ELSE fs = 0 END THEN 20.0 ELSE 0 END AS risk_score
FROM (SELECT h.series_id, h.variable, hm, hs, hlo, hhi, avg(value) AS fm, stddev_pop(value) AS fs, min(value) AS flo, max(value) AS fhi, count(*) AS n,
    count(*) FILTER (WHERE value < hlo - 0.2 * (hhi - hlo) OR value > hhi + 0.2 * (hhi - hlo)) AS n_out,
    (arg_min(value, period) - any_value(hl)) / greatest(abs(any_value(hl)), 1e-9) AS jump
  FROM fut f JOIN (SELECT series_id, variable, avg(value) AS hm, stddev_pop(value) AS hs, min(value) AS hlo, max(value) AS hhi,
      arg_max(value, period) AS hl FROM hist GROUP BY 1, 2) h USING (series_id, variable) GROUP BY h.series_id, h.variable, hm, hs, hlo, hhi)""", "hist fut")


def _hist_future(spark, sf):
    long = to_long(panel(spark, sf), DRIVERS)
    return long.filter(F.col("period") <= _CUT), long.filter(F.col("period") > _CUT)


@query("hist_future_stats", "series_id variable hist_mean:5 hist_std:5 hist_min hist_max", "SELECT series_id, variable, hm AS hist_mean, hs AS hist_std, hlo AS hist_min, hhi AS hist_max FROM anom", "anom")
def _(spark, sf):
    return path_stats(_hist_future(spark, sf)[0], "hist")


@query("driver_anomalies", "series_id variable future_mean:5 future_std:5 rel_jump_first_future_vs_last_hist:8 n_future_points:i "
       "n_future_out_of_hist_range:i flag_out_of_range flag_large_jump risk_score:2", """
SELECT series_id, variable, fm AS future_mean, fs AS future_std, jump AS rel_jump_first_future_vs_last_hist, n AS n_future_points,
  n_out AS n_future_out_of_hist_range, n_out > 0 AS flag_out_of_range, abs(jump) > 0.5 AS flag_large_jump, risk_score FROM anom""", "anom")
def _(spark, sf):
    return driver_anomalies(*_hist_future(spark, sf))


_LABEL = "CASE WHEN {0} <= 20 THEN 'Low' WHEN {0} <= 40 THEN 'Moderate' WHEN {0} <= 70 THEN 'High' ELSE 'Critical' END"


@query("series_risk", "series_id risk_score:6 risk_label", f"""
SELECT *, {_LABEL.format('risk_score')} AS risk_label FROM (SELECT series_id, avg(risk_score) AS risk_score FROM anom GROUP BY 1)""", "anom")
def _(spark, sf):
    return series_risk(driver_anomalies(*_hist_future(spark, sf)))


@query("risk_label", "event_type label n:i", f"""
SELECT event_type, {_LABEL.format('value')} AS label, count(*) AS n FROM events GROUP BY 1, 2""")
def _(spark, sf):
    return T.load(spark, sf, "events").groupBy("event_type", risk_label(F.col("value")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("append_risk_summary", "run_id series_id risk_score:6", """
SELECT unnest(['a', 'b']) AS run_id, series_id, avg(risk_score) AS risk_score FROM anom GROUP BY 2""", "anom")
def _(spark, sf):
    risk = materialize(series_risk(driver_anomalies(*_hist_future(spark, sf))))
    path = scratch_path(spark, "risk")
    sinks.append_risk_summary(risk, path, "a")
    return spark.read.parquet(sinks.append_risk_summary(risk, path, "b"))


@query("append_risk_retry", "run_id series_id risk_score:6", """
SELECT unnest(['a', 'b']) AS run_id, series_id, avg(risk_score) AS risk_score FROM anom GROUP BY 2""", "anom")
def _(spark, sf):
    """Run a is written, fails half way, and is written once more; run b stays beside it."""
    risk = materialize(series_risk(driver_anomalies(*_hist_future(spark, sf))))
    path = scratch_path(spark, "risk")
    sinks.append_risk_summary(risk.withColumn("risk_score", F.col("risk_score") + 1), path, "a")
    sinks.append_risk_summary(risk, path, "b")
    sinks.append_risk_summary(risk, path, "a")
    return sinks.read_run(spark, path, risk.schema)


def _written(spark, table, name, csv=False):
    """The table, written as the jobs do and read back."""
    path = scratch_path(spark, name)
    if csv:
        return spark.read.schema(table.schema).option("header", True).csv(sinks.write_csv(table, path, rounded=False))
    return spark.read.parquet(sinks.write_table(table, path))


def _read_back(name, of, csv=False, layout=None):
    """A sink as a query: the rows of another query, through a file."""
    from tidemark.catalog.base import QUERIES

    source = QUERIES[of]
    query(name, layout or source.layout, source.body, " ".join(source.ctes))(lambda spark, sf: _written(spark, source.plan(spark, sf), name, csv))


_read_back("write_anomaly_report", "driver_anomalies", csv=True)
_read_back("write_per_fold_metrics", "per_fold_report", csv=True)
_read_back("write_holdout_results", "holdout_results")
_read_back("write_indep_weights", "weights_table", csv=True)
_read_back("write_future_table", "write_future_forecast")


@query("write_hist_future", "series_id variable n:i last_value:4", """
SELECT series_id, variable, count(*) AS n, arg_max(value, period) AS last_value FROM long GROUP BY 1, 2""", "long")
def _(spark, sf):
    path = scratch_path(spark, "hist_future")
    for part, rows in zip(("past", "future"), _hist_future(spark, sf)):
        sinks.write_run(rows, path, part, by_series=True)
    back = sinks.read_run(spark, path, rows.schema)
    return back.groupBy("series_id", "variable").agg(F.count(F.lit(1)).alias("n"), F.max_by("value", "period").alias("last_value"))


@query("union_hist_future", "series_id variable n:i", "SELECT series_id, variable, count(*) AS n FROM long GROUP BY 1, 2", "long")
def _(spark, sf):
    h, f = _hist_future(spark, sf)
    return h.unionByName(f).groupBy("series_id", "variable").agg(F.count(F.lit(1)).alias("n"))


# ---- univariate models ---------------------------------------------------------------------

cte("arr", "SELECT series_id, variable, list(value ORDER BY period) AS y FROM long WHERE value IS NOT NULL GROUP BY 1, 2", "long")


def _values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(repr(v) for v in r) + ")" for r in rows)


def _ets_sql(name: str, grid: str) -> None:
    cte(name, f"""
SELECT r.series_id, r.variable, g.id, g.a, g.b, g.g, 12 AS t, list_avg(y[1:12]) AS lvl, (list_avg(y[13:24]) - list_avg(y[1:12])) / 12 AS tr,
  list_transform(y[1:12], lambda v: v - list_avg(y[1:12])) AS seas, CAST(0 AS DOUBLE) AS sse FROM arr r JOIN {grid} g ON g.series_id = r.series_id AND g.variable = r.variable
UNION ALL
SELECT series_id, variable, id, a, b, g, t + 1, new, b * (new - lvl) + (1 - b) * tr, list_append(seas[2:], g * (yt - new) + (1 - g) * s), sse + (yt - ex - s) ** 2
FROM (SELECT *, a * (yt - s) + (1 - a) * ex AS new FROM (
  SELECT c.*, lvl + tr AS ex, seas[1] AS s, y[t + 1] AS yt FROM {name} c JOIN arr r ON r.series_id = c.series_id AND r.variable = c.variable WHERE t < len(y)))""",
        f"arr {grid}")
    cte(f"{name}_best", f"""
SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY c.series_id, c.variable ORDER BY sse, id) AS k FROM {name} c JOIN arr r
  ON r.series_id = c.series_id AND r.variable = c.variable WHERE t = len(y)) WHERE k = 1""", name)


cte("grid1", f"SELECT r.series_id, r.variable, g.* FROM arr r, ({_values([(i, *p) for i, p in enumerate(U.ETS_GRID)])}) g(id, a, b, g)", "arr")
_ets_sql("ets1", "grid1")
_NEAR = [(i * 9 + j * 3 + k, (i - 1) * U.ETS_STEP[0], (j - 1) * U.ETS_STEP[1], (k - 1) * U.ETS_STEP[2]) for i in range(3) for j in range(3) for k in range(3)]
cte("grid2", f"""SELECT e.series_id, e.variable, n.id, least(greatest(e.a + n.a, 0.0), 1.0) AS a, least(greatest(e.b + n.b, 0.0), 1.0) AS b,
  least(greatest(e.g + n.g, 0.0), 1.0) AS g FROM ets1_best e, ({_values(_NEAR)}) n(id, a, b, g)""", "ets1_best")
_ets_sql("ets2", "grid2")


def _arrays(spark, sf):
    return U.series_arrays(to_long(panel(spark, sf), DRIVERS)).withColumn("horizon", F.lit(H))


@query("ets_forecast", "series_id variable step:i alpha:6 gamma:6 yhat:4", """
SELECT series_id, variable, step, a AS alpha, g AS gamma, lvl + step * tr + seas[(step - 1) % 12 + 1] AS yhat
FROM ets2_best, (SELECT unnest(range(1, 13)) AS step)""", "ets2_best")
def _(spark, sf):
    e = U.ets_forecast(_arrays(spark, sf), "M")
    rows = e.select("series_id", "variable", "ets.alpha", "ets.gamma", F.posexplode("ets.path").alias("step", "yhat"))
    return rows.withColumn("step", F.col("step") + 1)


@query("grid_cross", "series_id variable n:i", "SELECT series_id, variable, count(*) AS n FROM grid1 GROUP BY 1, 2", "grid1")
def _(spark, sf):
    grid = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip("abg", p)]) for p in U.ETS_GRID])
    return _arrays(spark, sf).select("series_id", "variable", F.inline(grid)).groupBy("series_id", "variable").agg(F.count(F.lit(1)).alias("n"))


cte("obs", """
SELECT series_id, variable, value AS v, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY series_id, variable) AS n,
  avg(value) OVER (PARTITION BY series_id, variable) AS m, min(value) OVER (PARTITION BY series_id, variable) > 0 AS mult
FROM long WHERE value IS NOT NULL WINDOW w AS (PARTITION BY series_id, variable ORDER BY period)""", "long")
cte("acf", """
SELECT a.series_id, a.variable, b.i - a.i AS k, any_value(a.n) AS n, sum((a.v - a.m) * (b.v - b.m)) AS s FROM obs a
JOIN obs b ON a.series_id = b.series_id AND a.variable = b.variable AND b.i - a.i BETWEEN 0 AND 12 GROUP BY 1, 2, 3""", "obs")
cte("seasonal", """
SELECT series_id, variable, max(n) >= 24 AND abs(max(s) FILTER (WHERE k = 12) / max(s) FILTER (WHERE k = 0)) >
  1.645 * sqrt((1 + 2 * sum((s / s0) ** 2) FILTER (WHERE k BETWEEN 1 AND 11)) / max(n)) AS yes FROM (
  SELECT *, max(s) FILTER (WHERE k = 0) OVER (PARTITION BY series_id, variable) AS s0 FROM acf) GROUP BY 1, 2""".replace(
    "abs(max(s) FILTER (WHERE k = 12) / max(s) FILTER (WHERE k = 0))", "abs(sum(s / s0) FILTER (WHERE k = 12))"), "acf")
cte("ratios", """
SELECT series_id, variable, i % 12 AS slot, CASE WHEN mult THEN v / ma ELSE v - ma END AS r, mult FROM (
  SELECT *, (sum(v) OVER (PARTITION BY series_id, variable ORDER BY i ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)
    + (lag(v, 6) OVER (PARTITION BY series_id, variable ORDER BY i) + lead(v, 6) OVER (PARTITION BY series_id, variable ORDER BY i)) / 2) / 12 AS ma FROM obs)
WHERE ma IS NOT NULL""", "obs")
cte("slots", """
SELECT series_id, variable, slot, CASE WHEN mult THEN raw / avg(raw) OVER w ELSE raw - avg(raw) OVER w END AS s FROM (
  SELECT series_id, variable, slot, mult, avg(r) AS raw FROM ratios GROUP BY 1, 2, 3, 4) WINDOW w AS (PARTITION BY series_id, variable)""", "ratios")
cte("adj", """
SELECT o.series_id, o.variable, o.i, o.n, CASE WHEN NOT q.yes THEN o.v WHEN o.mult THEN o.v / s.s ELSE o.v - s.s END AS d
FROM obs o JOIN seasonal q USING (series_id, variable) LEFT JOIN slots s ON s.series_id = o.series_id AND s.variable = o.variable AND s.slot = o.i % 12""", "seasonal slots")
cte("adj_arr", "SELECT series_id, variable, list(d ORDER BY i) AS d, regr_slope(d, i) AS slope FROM adj GROUP BY 1, 2", "adj")
cte("ses", """
SELECT series_id, variable, k / 50.0 AS alpha, 1 AS t, d[1] AS lvl, CAST(0 AS DOUBLE) AS sse FROM adj_arr, (SELECT unnest(range(1, 50)) AS k)
UNION ALL
SELECT s.series_id, s.variable, alpha, t + 1, lvl + alpha * (d[t + 1] - lvl), sse + (d[t + 1] - lvl) ** 2
FROM ses s JOIN adj_arr a ON a.series_id = s.series_id AND a.variable = s.variable WHERE t < len(d)""", "adj_arr")
cte("ses_best", """
SELECT *, len(d) AS n FROM (SELECT s.*, a.slope, a.d, row_number() OVER (PARTITION BY s.series_id, s.variable ORDER BY sse, alpha) AS rk FROM ses s
  JOIN adj_arr a ON a.series_id = s.series_id AND a.variable = s.variable WHERE t = len(d)) WHERE rk = 1""", "ses")


@query("theta_forecast", "series_id variable step:i alpha:4 yhat:4", """
SELECT b.series_id, b.variable, step, alpha, CASE WHEN NOT q.yes THEN base WHEN mult THEN base * s ELSE base + s END AS yhat
FROM (SELECT *, lvl + slope / 2 * (step - 1 + 1 / alpha - (1 - alpha) ** n / alpha) AS base FROM ses_best, (SELECT unnest(range(1, 13)) AS step)) b
JOIN seasonal q ON q.series_id = b.series_id AND q.variable = b.variable
JOIN (SELECT DISTINCT series_id, variable, mult FROM obs) o ON o.series_id = b.series_id AND o.variable = b.variable
LEFT JOIN slots s ON s.series_id = b.series_id AND s.variable = b.variable AND s.slot = (b.n + step - 1) % 12""", "ses_best slots seasonal")
def _(spark, sf):
    a = _arrays(spark, sf)
    t = U.theta_forecast(a, "M")
    rows = t.select("series_id", "variable", F.col("theta.alpha").alias("alpha"), F.posexplode("theta.path").alias("step", "yhat"))
    return rows.withColumn("step", F.col("step") + 1)


# Two-sided moving averages of twelve months, ends halved; only rows with half a year on either side have one.
cte("season_d", """
SELECT series_id, variable, rn % 12 AS slot, v - ma AS d FROM (
  SELECT *, i + 1 AS rn, (sum(v) OVER (PARTITION BY series_id, variable ORDER BY i ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)
    + (lag(v, 6) OVER (PARTITION BY series_id, variable ORDER BY i) + lead(v, 6) OVER (PARTITION BY series_id, variable ORDER BY i)) / 2) / 12 AS ma FROM obs)
WHERE ma IS NOT NULL""", "obs")
cte("strength", """
SELECT series_id, variable, CASE WHEN count(DISTINCT slot) = 12 THEN greatest(1 - var_pop(r) / nullif(var_pop(d), 0), 0) END AS strength
FROM (SELECT *, d - avg(d) OVER (PARTITION BY series_id, variable, slot) AS r FROM season_d) GROUP BY 1, 2""", "season_d")
cte("diffed", """
WITH zero AS (
  SELECT o.series_id, o.variable, i, CASE WHEN strength > 0.64 THEN v - lag(v, 12) OVER (PARTITION BY o.series_id, o.variable ORDER BY i) ELSE v END AS w0
  FROM obs o JOIN strength s USING (series_id, variable)),
one AS (SELECT *, w0 - lag(w0) OVER (PARTITION BY series_id, variable ORDER BY i) AS w1 FROM zero),
two AS (SELECT *, w1 - lag(w1) OVER (PARTITION BY series_id, variable ORDER BY i) AS w2 FROM one)
SELECT series_id, variable, i, unnest([0, 1, 2]) AS d, unnest([w0, w1, w2]) AS w FROM two""", "obs strength")
cte("kpss", """
WITH e AS (
  SELECT series_id, variable, d, w, row_number() OVER (PARTITION BY series_id, variable, d ORDER BY i) AS t, w - avg(w) OVER (PARTITION BY series_id, variable, d) AS e
  FROM diffed WHERE w IS NOT NULL),
c AS (SELECT *, sum(e) OVER (PARTITION BY series_id, variable, d ORDER BY t) AS s FROM e),
lagged AS (
  SELECT a.series_id, a.variable, a.d, b.t - a.t AS k, sum(a.e * b.e) AS g FROM e a JOIN e b ON a.series_id = b.series_id AND a.variable = b.variable
  AND a.d = b.d AND b.t - a.t BETWEEN 1 AND 9 GROUP BY 1, 2, 3, 4),
sums AS (
  SELECT series_id, variable, d, count(*) AS n, sum(s * s) AS ss, sum(e * e) AS ee, floor(3 * sqrt(count(*)) / 13) AS l, max(abs(e)) <= 1e-9 * (1 + max(abs(w))) AS still
  FROM c GROUP BY 1, 2, 3)
SELECT series_id, variable, d, any_value(n) AS n, CASE WHEN any_value(still) THEN 0 ELSE
  any_value(ss) / (any_value(n) * (any_value(ee) + 2 * coalesce(sum((1 - k / (l + 1)) * g) FILTER (WHERE k <= l), 0))) END AS kpss
FROM sums LEFT JOIN lagged USING (series_id, variable, d) GROUP BY 1, 2, 3""", "diffed")


@query("seasonal_strength", "series_id variable strength:6", "SELECT * FROM strength", "strength")
def _(spark, sf):
    return seasonal_strength(to_long(panel(spark, sf), DRIVERS), ["series_id", "variable"], 12)


@query("kpss_statistics", "series_id variable d:i kpss:6", "SELECT * FROM kpss", "kpss")
def _(spark, sf):
    found = differencing(to_long(panel(spark, sf), DRIVERS), ["series_id", "variable"], 12)
    return found.select("series_id", "variable", F.posexplode("kpss").alias("d", "kpss"))


@query("differencing_order", "series_id variable seasonal_d:i d:i", """
SELECT series_id, variable, CASE WHEN any_value(strength) > 0.64 THEN 1 ELSE 0 END AS seasonal_d, coalesce(min(d) FILTER (WHERE kpss <= 0.463), 2) AS d
FROM kpss JOIN strength USING (series_id, variable) GROUP BY 1, 2""", "kpss strength")
def _(spark, sf):
    return differencing(to_long(panel(spark, sf), DRIVERS), ["series_id", "variable"], 12)


@query("ar_search_forecast", "series_id variable p:i d:i seasonal_p:i seasonal_d:i aic:3 step:i yhat:4")
def _(spark, sf):
    a = U.ar_search_forecast(_arrays(spark, sf), "M")
    f = F.col("arima_fit")
    return a.select("series_id", "variable", f["p"].alias("p"), f["d"].alias("d"), f["seasonal_p"].alias("seasonal_p"), f["seasonal_d"].alias("seasonal_d"),
                    f["aic"].alias("aic"), F.posexplode("arima").alias("step", "yhat"))


@query("driver_models", "series_id variable model step:i period:d yhat:4")
def _(spark, sf):
    return U.driver_models(_arrays(spark, sf), "M", ("series_id", "variable"))


@query("driver_backtest_weights", "series_id variable model mape:6 n:i weight:6")
def _(spark, sf):
    return D.driver_backtest_weights(to_long(panel(spark, sf), DRIVERS), "M", H)


@query("driver_future", "series_id variable period:d value:4")
def _(spark, sf):
    p = panel(spark, sf)
    ends = p.groupBy("series_id").agg(F.max("period").alias("target_end"))
    return D.driver_future(to_long(p, DRIVERS), ends, None, "M", H)[1]


# ---- linear algebra and importance ---------------------------------------------------------


@query("gram", "series_id i:i j:i s:3", """
WITH z AS (SELECT series_id, [1.0, n_orders, mean_qty, share_filled, sum_qty] AS x FROM panel)
SELECT series_id, i, j, sum(x[i + 1] * x[j + 1]) AS s FROM z, (SELECT unnest(range(0, 5)) AS i), (SELECT unnest(range(0, 5)) AS j)
WHERE j >= i GROUP BY 1, 2, 3""", "panel")
def _(spark, sf):
    design = panel(spark, sf).select("series_id", F.array("n_orders", "mean_qty", "share_filled", "sum_qty").alias("x"))
    return G.gram_entries(design, ["series_id"])


cte("trend", "SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY period) AS t FROM panel", "panel")


def _trend_fit(spark, sf):
    p = panel(spark, sf).withColumn("t", F.row_number().over(Window.partitionBy("series_id").orderBy("period")).cast("double"))
    sums = G.gram(p.select("series_id", F.array("t", "n_orders").alias("x")), ["series_id"])

    @F.pandas_udf("array<double>")
    def solve(grams: pd.Series) -> pd.Series:
        return pd.Series([G.min_norm(G.unpack(g)) for g in grams])

    return p, sums.withColumn("b", solve("g"))


@query("ols_trend", "series_id intercept:5 slope:6", """
SELECT series_id, regr_intercept(n_orders, t) AS intercept, regr_slope(n_orders, t) AS slope FROM trend GROUP BY 1""", "trend")
def _(spark, sf):
    fit = _trend_fit(spark, sf)[1]
    return fit.select("series_id", F.col("b")[0].alias("intercept"), F.col("b")[1].alias("slope"))


@query("linear_attribution", "series_id score:6", """
SELECT series_id, avg(abs(slope * (t - m))) AS score FROM (SELECT *, avg(t) OVER (PARTITION BY series_id) AS m FROM trend)
JOIN (SELECT series_id, regr_slope(n_orders, t) AS slope FROM trend GROUP BY 1) USING (series_id) GROUP BY 1""", "trend")
def _(spark, sf):
    p, fit = _trend_fit(spark, sf)
    long = p.select("series_id", F.lit("t").alias("variable"), F.col("t").alias("value"))
    coef = fit.select("series_id", F.lit("t").alias("variable"), F.col("b")[1].alias("coef"))
    return I.linear_attribution(long, coef)


@query("vif", "series_id variable vif:6", Q.VIF_SQL, "drv_inv")
def _(spark, sf):
    return I.vif(S.corr_matrix(panel(spark, sf), DRIVERS), DRIVERS)


@query("vif_prune", "series_id variable vif:6", Q.VIF_KEPT_SQL, "drv_drop")
def _(spark, sf):
    return I.vif_prune(S.corr_matrix(panel(spark, sf), DRIVERS), DRIVERS)


@query("vif_drops", "series_id step:i variable vif:4", Q.VIF_DROPS_SQL, "drv_drop")
def _(spark, sf):
    return I.vif_drops(S.corr_matrix(panel(spark, sf), DRIVERS), DRIVERS).filter("step IS NOT NULL")


@query("elasticnet_rank", "series_id variable score:2")
def _(spark, sf):
    return I.elasticnet_rank(panel(spark, sf), DRIVERS)


@query("elasticnet_optimality", "series_id variable optimal", """
SELECT DISTINCT series_id, variable, true AS optimal FROM long""", "long")
def _(spark, sf):
    """The conditions of the optimum, checked on the rows for every series and driver; the twin lists what must hold."""
    return I.elasticnet_optimality(panel(spark, sf), DRIVERS).withColumn("optimal", F.col("excess") < 1e-6)


@query("elasticnet_gap", "series_id exact", "SELECT DISTINCT series_id, true AS exact FROM panel", "panel")
def _(spark, sf):
    return I.elasticnet_fits(panel(spark, sf), DRIVERS).withColumn("exact", F.col("gap") <= G.GAP)


@query("tree_importance_rank", "series_id variable score:2")
def _(spark, sf):
    return I.tree_importance_rank(materialize(panel(spark, sf)), DRIVERS)


# ---- target models: holdout forecasts over all series and folds ----------------------------

_FC = "series_id fold:i model step:i period:d yhat:2"


def _centered(spark, sf):
    p = materialize(panel(spark, sf))
    folds = materialize(FO.make_folds(p, H))
    return center_panel(p, DRIVERS, folds), folds, FO.holdout_rows(p, folds)


def _linear(model):
    def plan(spark, sf):
        c, folds, future = _centered(spark, sf)
        fits = materialize(fit_linear(c, folds, DRIVERS, "M", [model]))
        return forecast_linear(fits, c, folds, future, DRIVERS, "M", models=[model])

    return plan


for _m in LINEAR_MODELS:
    query(f"model_{_m}", _FC, *Q.LINEAR_SQL.get(_m, ()))(_linear(_m))


def _univariate(model):
    return lambda spark, sf: forecast_univariate(*_centered(spark, sf), "M", [model])


query("model_fourier_trend", _FC, Q.FOURIER_SQL, "ft_fit hold")(_univariate("fourier_trend"))
Q.on_log_target()
query("model_holtwinters", _FC, """
SELECT h.series_id, h.fold, 'holtwinters' AS model, h.step, h.period, exp(lvl + h.step * tr + seas[(h.step - 1) % 12 + 1]) AS yhat
FROM hold h JOIN t_ets2_best e ON e.series_id = h.series_id AND e.variable = CAST(h.fold AS VARCHAR)""", "t_ets2_best hold")(_univariate("holtwinters"))
query("model_theta", _FC, """
SELECT h.series_id, h.fold, 'theta' AS model, h.step, h.period, exp(CASE WHEN NOT q.yes THEN base WHEN o.mult THEN base * s ELSE base + s END) AS yhat
FROM (SELECT h.*, b.n, lvl + slope / 2 * (h.step - 1 + 1 / alpha - (1 - alpha) ** b.n / alpha) AS base FROM hold h JOIN t_ses_best b
  ON b.series_id = h.series_id AND b.variable = CAST(h.fold AS VARCHAR)) h
JOIN t_seasonal q ON q.series_id = h.series_id AND q.variable = CAST(h.fold AS VARCHAR)
JOIN (SELECT DISTINCT series_id, variable, mult FROM t_obs) o ON o.series_id = h.series_id AND o.variable = q.variable
LEFT JOIN t_slots s ON s.series_id = h.series_id AND s.variable = q.variable AND s.slot = (h.n + h.step - 1) % 12""",
      "t_ses_best t_slots t_seasonal hold")(_univariate("theta"))
for _m in TREE_MODELS:
    query(f"model_{_m}", _FC)(lambda spark, sf, m=_m: forecast_trees(*_centered(spark, sf), DRIVERS, "M", [m]))
query("model_gbt", _FC)(lambda spark, sf: forecast_trees(*_centered(spark, sf), DRIVERS, "M", TREE_MODELS[:3]))
query("model_rff_regression", _FC)(lambda spark, sf: forecast_pooled(*_centered(spark, sf), DRIVERS, "M"))


@query("tree_nodes", "series_id fold:i model tree:i node:i feature:i threshold:6 child:i value:6")
def _(spark, sf):
    c, folds, _ = _centered(spark, sf)
    presets = {m: TR.PRESETS[m] for m in TREE_MODELS}
    return TR.node_table(fit_trees(tree_rows(c, folds, DRIVERS, "M"), presets), ["series_id", "fold", "model"])


def _log_rows(spark, sf):
    """Drivers and log target of the training rows of every fold, long."""
    p = panel(spark, sf)
    rows = FO.training_rows(p, FO.make_folds(p, H)).withColumn("label", F.log("target"))
    return rows.select("series_id", "fold", "period", "label", F.inline(F.array(*[
        F.struct(F.lit(d).alias("variable"), F.col(d).alias("value")) for d in DRIVERS])))


@query("tree_root_split", "series_id fold:i variable threshold:6 gain:6", """
WITH samples AS (
  SELECT l.series_id, f.fold, l.variable, round(l.value, 9) AS v, ln(p.target) AS y FROM long l JOIN panel p USING (series_id, period)
  JOIN folds f ON f.series_id = l.series_id AND l.period <= f.train_end),
bins AS (
  SELECT series_id, fold, variable, v, m * count(*) - sum(y) AS g, count(*) AS h
  FROM (SELECT *, avg(y) OVER (PARTITION BY series_id, fold, variable) AS m FROM samples) GROUP BY series_id, fold, variable, v, m),
sums AS (
  SELECT *, sum(g) OVER w AS gl, sum(h) OVER w AS hl, lead(v) OVER w AS nx, sum(g) OVER a AS gt, sum(h) OVER a AS ht FROM bins
  WINDOW w AS (PARTITION BY series_id, fold, variable ORDER BY v), a AS (PARTITION BY series_id, fold, variable)),
gains AS (
  SELECT *, greatest(abs(gl) - 0.1, 0) ** 2 / (hl + 1) + greatest(abs(gt - gl) - 0.1, 0) ** 2 / (ht - hl + 1)
    - greatest(abs(gt) - 0.1, 0) ** 2 / (ht + 1) AS gain FROM sums WHERE hl >= 3 AND ht - hl >= 3 AND nx IS NOT NULL)
SELECT series_id, fold, variable, (v + nx) / 2 AS threshold, gain FROM gains
QUALIFY row_number() OVER (PARTITION BY series_id, fold, variable ORDER BY round(gain, 9) DESC, v) = 1""", "long folds")
def _(spark, sf):
    return TR.root_splits(_log_rows(spark, sf), ["series_id", "fold"], TR.PRESETS["gbt_xgboost"])


# ---- jobs ----------------------------------------------------------------------------------


def _step_1(spark, sf):
    return run_feature_selection(panel(spark, sf), DRIVERS, strict=False)


def _step_2(spark, sf):
    one = _step_1(spark, sf)
    return one, run_model_selection(one["panel"], DRIVERS, one["selected"])


@query("run_feature_selection", "series_id variable corr_value:3 vif:4 composite:4 rank:i")
def _(spark, sf):
    return _step_1(spark, sf)["selected"]


@query("run_model_selection", "series_id model model_rank:i mape:6 fq_score:6 weight:6")
def _(spark, sf):
    return _step_2(spark, sf)[1]["chosen"]


@query("run_future_forecast", "series_id step_id:i period:d forecast_top_1:2 forecast_top_2:2 forecast_ensemble:2")
def _(spark, sf):
    one, two = _step_2(spark, sf)
    return run_future_forecast(one["panel"], DRIVERS, two["chosen"], two["driver_weights"], one["selected"])["forecast_table"]


@query("percent_error", "series_id fold:i model step:i pe:6", """
SELECT *, abs(actual - yhat) / actual * 100 AS pe FROM scored WHERE actual <> 0""", "scored")
def _(spark, sf):
    from tidemark.functions.scores import percent_error

    return _scored(spark, sf).withColumn("pe", percent_error(F.col("actual"), F.col("yhat"))).filter("pe IS NOT NULL")


@query("finite_nonzero_mask", "series_id variable model n:i", """
SELECT series_id, variable, model, count(*) AS n FROM drv WHERE actual <> 0 AND yhat IS NOT NULL GROUP BY 1, 2, 3""", "drv")
def _(spark, sf):
    from tidemark.functions.scores import driver_ape

    rows = _driver_forecasts(spark, sf).withColumn("ape", driver_ape(F.col("actual"), F.col("yhat"))).filter("ape IS NOT NULL")
    return rows.groupBy("series_id", "variable", "model").agg(F.count(F.lit(1)).alias("n"))
