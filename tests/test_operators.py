"""Properties, edge cases and numpy twins of the operators."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.functions.text import clean_name, sanitize_columns
from tidemark.operators import ensemble as E
from tidemark.operators import features as feat
from tidemark.operators import folds as FO
from tidemark.operators import gram as G
from tidemark.operators import importance as I
from tidemark.operators import metrics as M
from tidemark.operators import panel as P
from tidemark.operators import selection as S
from tidemark.operators import univariate as U
from tidemark.operators.drivers import driver_backtest_weights, driver_future
from tidemark.operators.impute import time_interpolate
from tidemark.operators.linear_models import center_panel, fit_linear, forecast_linear
from tidemark.operators.target_models import forecast_models
from tidemark.settings import DEFAULTS
from tidemark.sources.config import read_config


def months(n, start=2015):
    return [dt.date(start + i // 12, i % 12 + 1, 1) for i in range(n)]


def make_panel(spark, n=84, series=("a", "b"), seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for k, s in enumerate(series):
        t = np.arange(n)
        x1 = 10 + 0.05 * t + rng.normal(0, 1, n)
        x2 = 5 + np.sin(2 * np.pi * t / 12) + rng.normal(0, 0.2, n)
        y = np.exp(3 + 0.004 * t + 0.05 * x1 + 0.15 * x2 + rng.normal(0, 0.01, n))
        rows += [(s, m, float(a), float(b), float(c)) for m, a, b, c in zip(months(n), y, x1, x2)]
    return spark.createDataFrame(rows, "series_id string, period date, target double, x1 double, x2 double")


@pytest.fixture(scope="module")
def panel(spark):
    p = make_panel(spark)
    p.cache()
    return p


def test_names(spark):
    assert clean_name("Price (USD), [t]") == "Price_USD_t"
    df, names = sanitize_columns(spark.range(1).select(F.col("id").alias("a b<c>")))
    assert df.columns == ["a_b_c"] and names == {"a b<c>": "a_b_c"}


def test_freq_guard():
    with pytest.raises(ValueError):
        cal.check_freq("D")


def test_iso_week_keeps_calendar_year(spark):
    row = spark.range(1).select(*cal.calendar_features(F.lit("2024-12-30").cast("date"), "W")).first()
    assert (row["week"], row["year"]) == (1.0, 2024.0)


def test_read_config(spark, tmp_path):
    head = "Series_Name, Input_File_Name,Target_Column_Name,Date_Column_Name,Frequency,Minimum_Observations,Model_Selection_Period,Forecasting_Period"
    good = tmp_path / "good.csv"
    good.write_text("﻿" + head + "\nS,f.parquet,Target,Date, m ,60,12,12\n", encoding="utf-8")
    row = read_config(spark, str(good)).first()
    assert (row["series_id"], row["freq"], row["min_obs"]) == ("S", "M", 60)
    bad = tmp_path / "bad.csv"
    bad.write_text(head + "\nS,f.parquet,Target,Date,D,60,0,12\n")
    with pytest.raises(ValueError, match="freq"):
        read_config(spark, str(bad))


def test_resample_last_skips_nulls_per_column(spark):
    df = spark.createDataFrame([("s", dt.datetime(2020, 1, 3), 1.0, 7.0), ("s", dt.datetime(2020, 1, 20), 2.0, None)],
                               "series_id string, ts timestamp_ntz, a double, b double")
    row = P.resample_last(df, "M", ["a", "b"]).first()
    assert (row["a"], row["b"]) == (2.0, 7.0)


def test_interpolation_is_linear_in_time_and_flat_outside(spark):
    ms = months(6)
    days = [(m - ms[0]).days for m in ms]
    vals = [None, float(days[1]), None, None, float(days[4]), None]
    df = spark.createDataFrame([("s", m, v) for m, v in zip(ms, vals)], "series_id string, period date, v double")
    got = [r["v"] for r in time_interpolate(df, ["v"]).orderBy("period").collect()]
    assert got == pytest.approx([days[1], days[1], days[2], days[3], days[4], days[4]], abs=1e-9)


def test_trim_falls_back_to_last_n_and_reports_short_series(spark):
    rows = [("long", m, 1.0, 1.0 if m.year >= 2020 else None) for m in months(84)] + [("short", m, 1.0, 1.0) for m in months(59)]
    df = spark.createDataFrame(rows, "series_id string, period date, target double, x double")
    plan = {r["series_id"]: r["strategy"] for r in P.trim_plan(df, ["x"], "M", 0.75, 60).collect()}
    assert plan == {"long": "last_n", "short": "insufficient"}
    assert P.trim_series(df, ["x"], "M").count() == 60
    with pytest.raises(ValueError, match="short"):
        P.trim_series(df, ["x"], "M", strict=True)


def test_validation_raises_on_request(spark):
    df = spark.createDataFrame([("s", m, 1.0) for m in months(5) if m.month != 3], "series_id string, period date, target double")
    assert [r["rule"] for r in P.validate_series(df, "M").collect()] == ["missing_period"]
    with pytest.raises(ValueError, match="missing_period"):
        P.validate_series(df, "M", strict=True)


def test_lags_never_see_the_future(panel):
    last = panel.agg(F.max("period")).first()[0]
    changed = panel.withColumn("target", F.when(F.col("period") == last, F.lit(1e9)).otherwise(F.col("target")))
    names = ["series_id", "period", *feat.lag_names(12), *feat.ROLLING]
    a, b = (feat.make_target_features(p, ["x1"]).select(names).orderBy("series_id", "period").collect() for p in (panel, changed))
    assert a == b


def test_next_row_equals_training_row(panel):
    cut = panel.filter("period < '2021-12-01'")
    state = feat.history_array(cut, "target", 12).join(panel.filter("period = '2021-12-01'"), "series_id")
    names = feat.feature_names(["x1"], "M")
    new = feat.next_feature_row(state, ["x1"]).orderBy("series_id").select(names).collect()
    old = feat.make_target_features(panel, ["x1"]).filter("period = '2021-12-01'").orderBy("series_id").select(names).collect()
    for a, b in zip(new, old):
        assert list(a) == pytest.approx(list(b), rel=1e-9)


def test_flat_holdout_counts_as_perfect_direction(spark):
    rows = [("s", 1, "m", m, 5.0, 4.0, 5.0) for m in months(3)]
    df = spark.createDataFrame(rows, "series_id string, fold bigint, model string, period date, actual double, yhat double, last_train double")
    assert M.forecast_metrics(df).first()["da"] == 1.0


def test_broken_forecast_gives_null_errors(spark):
    rows = [("s", 1, "m", m, 5.0, v, 5.0) for m, v in zip(months(2), (5.0, float("nan")))]
    df = spark.createDataFrame(rows, "series_id string, fold bigint, model string, period date, actual double, yhat double, last_train double")
    row = M.forecast_metrics(df).first()
    assert row["mape"] is None and row["wba"] == 0.5
    assert M.forecast_metrics(df, compat=True).first()["mape"] == 0.0


def test_ties_keep_training_order_and_family_is_forced(spark):
    rows = [("s", m, 0.1, 0.1, 0.1, s, s, 2, s) for m, s in (("theta", 0.9), ("holtwinters", 0.9), ("mg", 0.5), ("lasso", 0.4))]
    df = spark.createDataFrame(rows, "series_id string, model string, mae double, rmse double, mape double, da double, wba double, n_folds bigint, fq_score double")
    ranked = [r["model"] for r in M.rank_models(df).orderBy("model_rank").collect()]
    assert ranked == ["holtwinters", "theta", "mg", "lasso"]
    assert [r["model"] for r in E.top_k_models(df).orderBy("model_rank").collect()] == ["holtwinters", "mg"]


def test_gram_is_independent_of_partitioning(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 4))
    df = spark.createDataFrame([("k", [float(v) for v in r]) for r in x], "series_id string, x array<double>")
    z = np.column_stack([np.ones(300), x])
    for parts in (1, 7):
        g = G.unpack(G.gram(df.repartition(parts), ["series_id"]).first()["g"])
        assert np.allclose(g, z.T @ z)


def test_min_norm_matches_lstsq_with_dependent_columns():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(50, 5))
    x = np.column_stack([x, x[:, 0] + x[:, 1]])
    y = x @ rng.normal(size=6) + rng.normal(size=50)
    z = np.column_stack([np.ones(50), x, y])
    b = G.min_norm(z.T @ z)
    want = z[:, :-1] @ np.linalg.lstsq(z[:, :-1], y, rcond=None)[0]
    assert np.allclose(z[:, :-1] @ b, want, atol=1e-8)


def test_elastic_net_meets_optimality_conditions():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 6))
    y = x[:, 0] * 2 - x[:, 1] + rng.normal(size=120) * 0.1
    z = np.column_stack([np.ones(120), x, y])
    b = G.elastic_net_cv([z[i:i + 20].T @ z[i:i + 20] for i in range(0, 120, 20)], (0.5, 1.0))
    assert np.allclose(b[1:3], [2 * x[:, 0].std(), -x[:, 1].std()], atol=0.05)
    assert np.abs(b[3:]).max() < 0.05


def test_ols_forecast_matches_row_level_solution(panel):
    """First holdout step of OLS from sums equals least squares on the rows."""
    folds = FO.make_folds(panel, 12).filter("fold = 2")
    future = FO.holdout_rows(panel, folds)
    c = center_panel(panel, ["x1", "x2"], folds)
    fits = fit_linear(c, folds, ["x1", "x2"], "M", ["ols"])
    got = {r["series_id"]: r["yhat"] for r in forecast_linear(fits, c, folds, future, ["x1", "x2"], "M").filter("step = 1").collect()}
    log = panel.withColumn("target", F.log("target"))
    names = feat.feature_names(["x1", "x2"], "M")
    rows = feat.make_target_features(log, ["x1", "x2"]).orderBy("series_id", "period").toPandas()
    for s, part in rows.groupby("series_id"):
        x = np.column_stack([np.ones(len(part)), part[names].to_numpy()])
        y = part["target"].to_numpy()
        scale = np.maximum(np.abs(x).max(0), 1e-9)
        b = np.linalg.lstsq(x[:-12] / scale, y[:-12], rcond=1e-11)[0]
        assert got[s] == pytest.approx(np.exp(x[-12] / scale @ b), rel=1e-5)


def test_every_model_beats_the_naive_forecast(spark, panel):
    folds = FO.make_folds(panel, 12)
    future = FO.holdout_rows(panel, folds)
    c = center_panel(panel, ["x1", "x2"], folds)
    settings = DEFAULTS.with_(models=("elasticnet", "lasso", "ccemg", "sysgmm", "twfe", "arx", "holtwinters", "theta", "fourier_trend", "rf"), n_trees=10)
    fc = forecast_models(c, folds, future, ["x1", "x2"], "M", settings)
    both = fc.unionByName(M.naive_last(panel, folds))
    scored = M.score_rows(both, panel, folds)
    mape = {r["model"]: r["mape"] for r in M.aggregate_folds(M.forecast_metrics(scored)).groupBy("model").agg(F.avg("mape").alias("mape")).collect()}
    assert set(settings.models) < set(mape)
    worse = [m for m in mape if m not in ("naive_last", "rf", "twfe") and mape[m] > mape["naive_last"]]
    assert not worse, mape


def test_copies_of_a_series_get_equal_answers(spark):
    one = make_panel(spark, series=("a",))
    two = one.unionByName(one.withColumn("series_id", F.lit("copy"))).repartition(5)
    rows = driver_backtest_weights(P.to_long(two, ["x1", "x2"]), "M", 12).collect()
    by = {(r["series_id"], r["variable"], r["model"]): r["weight"] for r in rows}
    for (s, v, m), w in by.items():
        assert w == pytest.approx(by["a", v, m], rel=1e-9)
    for v in ("x1", "x2"):
        assert sum(by["a", v, m] for m in ("ets", "arima", "theta")) == pytest.approx(1.0)


def test_driver_future_prefers_actuals_and_covers_the_gap(spark, panel):
    late = panel.withColumn("x2", F.when(F.col("period") < "2021-06-01", F.col("x2")))
    long = P.to_long(late, ["x1", "x2"])
    ends = panel.groupBy("series_id").agg(F.max("period").alias("target_end"))
    future, window = driver_future(long, ends, None, "M", 6)
    assert future.count() == 2 * 2 * 6 and window.count() == 2 * 2 * 30
    assert window.filter("value IS NULL").count() == 0
    same = window.join(long.withColumnRenamed("value", "v"), ["series_id", "variable", "period"]).filter("v IS NOT NULL AND v <> value")
    assert same.count() == 0


def test_smoothing_follows_a_clean_path(spark):
    y = [10 + 0.5 * t + 3 * np.sin(2 * np.pi * t / 12) for t in range(72)]
    df = spark.createDataFrame([("s", "v", [float(v) for v in y], 12)], "series_id string, variable string, y array<double>, horizon int")
    want = [10 + 0.5 * t + 3 * np.sin(2 * np.pi * t / 12) for t in range(72, 84)]
    ets = U.ets_forecast(df, "M").first()["ets"]["path"]
    ar = U.ar_search_forecast(df, "M").first()["arima"]
    theta = U.theta_forecast(df, "M").first()["theta"]["path"]
    assert np.abs(np.array(ets) - want).max() < 1.5
    assert np.abs(np.array(ar) - want).max() < 0.5
    assert np.abs(np.array(theta) - want).max() < 6


def test_vif_prune_removes_copies_and_keeps_the_rest(spark, panel):
    wide = panel.withColumns({"copy": F.col("x1"), "flat": F.lit(1.0)})
    names = ["x1", "copy", "x2", "flat"]
    values = {r["variable"]: r["vif"] for r in I.vif(S.corr_matrix(wide, names), names).filter("series_id = 'a'").collect()}
    assert values["x1"] == values["copy"] == float("inf") and values["flat"] == 1.0
    kept = {r["variable"] for r in I.vif_prune(S.corr_matrix(wide, names), names).filter("series_id = 'a'").collect()}
    assert kept == {"copy", "x2", "flat"}
