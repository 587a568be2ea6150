"""Failures stay with the series they belong to, and writers leave each row once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_operators import make_panel
from tidemark.operators import folds as FO
from tidemark.operators import trees as T
from tidemark.operators.linear_models import center_panel, fit_linear, forecast_linear
from tidemark.plans.feature_selection import run_feature_selection, write_feature_selection
from tidemark.plans.future_forecast import run_future_forecast, write_future_forecast
from tidemark.plans.model_selection import failure_table, run_model_selection, write_model_selection
from tidemark.settings import DEFAULTS
from tidemark.sources import sinks

SMALL = DEFAULTS.with_(n_trees=5, models=("ols", "elasticnet", "theta", "gbt_xgboost", "rf"))


@pytest.fixture(scope="module")
def broken(spark):
    """Series a and b are sound, one has an infinite target, one is short."""
    good = make_panel(spark)
    extra = make_panel(spark, series=("huge",), seed=5).withColumn(
        "target", F.when(F.col("period") == "2018-03-01", float("inf")).otherwise(F.col("target")))
    short = make_panel(spark, n=25, series=("short",), seed=6)
    return good.unionByName(extra).unionByName(short).cache()


def test_what_fails_drops_out_alone(spark, broken):
    out = run_model_selection(broken, ["x1", "x2"], settings=SMALL)
    fails = {(r.series_id, r.fold, r.model): (r.item, r.reason) for r in out["failures"].collect()}
    assert fails["short", None, None][0] == "series" and "25 rows" in fails["short", None, None][1]
    linear = {k: v for k, v in fails.items() if k[0] == "huge" and k[2] in ("ols", "elasticnet", "gbt_xgboost", "rf")}
    assert len(linear) == 8 and all(item in ("fit", "forecast") and reason for item, reason in linear.values())
    assert not any(k[0] in ("a", "b") for k in fails)
    assert {r.series_id for r in out["chosen"].select("series_id").collect()} >= {"a", "b"}
    sound = run_model_selection(broken.filter("series_id IN ('a', 'b')"), ["x1", "x2"], settings=SMALL)["metrics"]
    key = ["series_id", "fold", "model"]
    both = sound.select(*key, "mape").join(out["metrics"].select(*key, F.col("mape").alias("other")), key)
    assert both.count() == 20 and both.filter(F.abs(F.col("mape") - F.col("other")) > 1e-9).count() == 0


def test_a_singular_fit_is_a_row_with_its_reason(spark):
    panel = make_panel(spark)
    folds = FO.make_folds(panel, 12)
    c = center_panel(panel, ["x1", "x2"], folds)
    models = ["ols", "elasticnet", "mg", "arx"]
    sound = fit_linear(c, folds, ["x1", "x2"], "M", models)
    # Sums of squares overflow for one series.
    broken = fit_linear(c.withColumn("z_x1", F.when(F.col("series_id") == "b", F.col("z_x1") * 1e200).otherwise(F.col("z_x1"))),
                        folds, ["x1", "x2"], "M", models)
    got = {(r.series_id, r.fold, r.model): r for r in broken.collect()}
    assert len(got) == 16 and all((r.reason is None) == (k[0] == "a") and (r.phi is None) == (k[0] == "b") for k, r in got.items())
    for r in sound.filter("series_id = 'a'").collect():
        assert got[r.series_id, r.fold, r.model].phi == pytest.approx(r.phi, abs=1e-7)
    paths = forecast_linear(broken, c, folds, FO.holdout_rows(panel, folds), ["x1", "x2"], "M", models=models)
    assert {r.series_id for r in paths.select("series_id").distinct().collect()} == {"a"}


def test_reasons_of_missing_driver_forecasts(spark):
    future = spark.createDataFrame([("a", 1, 1, None, 2.0), ("a", 1, 2, 1.0, 2.0), ("b", 1, 1, 1.0, None)],
                                   "series_id string, fold long, step long, x1 double, x2 double")
    selected = spark.createDataFrame([("a", "x1"), ("b", "x1")], "series_id string, variable string")
    lost = spark.createDataFrame([("a", 1, "ols"), ("a", 1, "rf"), ("b", 1, "ols")], "series_id string, fold long, model string")
    fits = spark.createDataFrame([("a", 1, "rf", "why")], "series_id string, fold long, model string, reason string")
    none = spark.createDataFrame([], "series_id string, n_rows long")
    got = {(r.series_id, r.model, r.item): r.reason for r in failure_table(none, future, selected, ["x1", "x2"], [fits], lost).collect()}
    assert got == {("a", None, "x1"): "no forecast for this driver", ("a", "rf", "fit"): "why",
                   ("a", "ols", "forecast"): "a driver has no forecast", ("b", "ols", "forecast"): "no finite forecast"}


def test_a_tree_fit_without_numbers_is_a_reason(spark):
    rows = [("s", 0, [1.0, 2.0], 1.0), ("s", 1, [None, 2.0], 2.0), ("t", 0, [1.0, 2.0], 1.0), ("t", 1, [2.0, 3.0], 2.0)]
    from tidemark.operators.tree_models import fit_trees

    got = fit_trees(spark.createDataFrame(rows, "series_id string, period int, x array<double>, label double"),
                    {"gbt_xgboost": T.PRESETS["gbt_xgboost"].with_(n_trees=2)}, ["series_id"]).collect()
    by = {r.series_id: r.trees for r in got}
    assert by["s"].reason and by["s"].feature is None and by["t"].reason is None and len(by["t"].root) == 2


def test_jobs_are_written_and_retried(spark, tmp_path):
    panel, drivers = make_panel(spark, series=("a", "b")), ["x1", "x2"]
    few = SMALL.with_(models=("ols", "theta"), min_selected=1)
    one = run_feature_selection(panel, drivers, settings=few, strict=False)
    two = run_model_selection(one["panel"], drivers, one["selected"], settings=few)
    three = run_future_forecast(one["panel"], drivers, two["chosen"], two["driver_weights"], one["selected"], settings=few)
    folder = str(tmp_path)
    for run in ("first", "second", "first"):
        write_feature_selection(one, f"{folder}/1", run)
        write_model_selection(two, f"{folder}/2", run)
        write_future_forecast(three, f"{folder}/3", run)
    for table, path in ((one["selected"], "1/selected"), (two["chosen"], "2/chosen"), (two["per_fold"], "2/per_fold"), (two["holdout"], "2/holdout"),
                        (three["forecast_table"], "3/forecast_table"), (three["anomalies"], "3/anomalies"), (three["future_drivers"], "3/future_drivers")):
        back = sinks.read_run(spark, f"{folder}/{path}", table.schema)
        assert back.count() == 2 * table.count() > 0, path
        assert back.filter("run_id = 'first'").drop("run_id", "created_at").exceptAll(table.drop("created_at")).count() == 0, path
    scores = sinks.read_run(spark, f"{folder}/1/mi_scores", sinks.three_decimals(one["scores"].select("series_id", "variable", F.col("mi").alias("score"))).schema, "second", csv=True)
    assert scores.count() == one["scores"].count()


def test_one_series_of_a_run_is_rewritten(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 2.0)], "series_id string, variable string, score double")
    path = sinks.write_scores(rows, str(tmp_path / "s"), "r")
    sinks.write_scores(rows.filter("series_id = 'b'").withColumn("score", F.lit(5.0)), path, "r")
    back = sinks.read_run(spark, path, sinks.three_decimals(rows).schema, "r", csv=True)
    assert {(r.series_id, r.score) for r in back.collect()} == {("a", "1.000"), ("b", "5.000")}
    assert np.isfinite([float(r.score) for r in back.collect()]).all()
