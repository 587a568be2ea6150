"""Replays of published run figures: small tables in, known tables out."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ensemble as E
from tidemark.operators import metrics as M
from tidemark.operators import selection as S
from tidemark.operators.anomalies import driver_anomalies, series_risk
from tidemark.settings import DEFAULTS, MODEL_ORDER

# Fold metrics (fold, model, mae, rmse, mape, da, wba).
FOLDS = [
    (1, "elasticnet", 5.309173204, 6.563960537, 0.06165693556, 0.75, 0.75),
    (1, "theta", 5.818609274, 6.314680805, 0.07001694227, 0.8333333333, 0.8333333333),
    (1, "lasso", 4.459462733, 6.105490737, 0.05100190071, 0.6666666667, 0.8333333333),
    (1, "svr", 3.174422401, 3.926442964, 0.0367726118, 0.8333333333, 1.0),
    (1, "sysgmm", 6.995564942, 7.989332113, 0.08266251892, 0.75, 0.5833333333),
    (2, "elasticnet", 4.948265713, 6.2529744, 0.0711126934, 0.5, 0.75),
    (2, "theta", 9.592579289, 10.65976919, 0.1363696856, 0.25, 0.4166666667),
    (2, "lasso", 4.932970378, 6.239023451, 0.07089550736, 0.5, 0.75),
    (2, "svr", 3.361430137, 4.094910378, 0.04681368914, 0.5833333333, 0.8333333333),
    (2, "sysgmm", 5.34986201, 6.991918749, 0.07701493275, 0.5, 0.6666666667),
]
ACTUAL = [74.16, 76.3, 73.99, 73.84, 79.69, 75.44, 72.73, 68.63, 64.45, 71.44, 70.67, 67.87]
SVR = [79.37368777, 77.18634981, 76.80009698, 72.93167357, 71.62205714, 73.32706377, 70.22463317, 70.77827602,
       71.65196777, 72.6224549, 72.87562715, 72.9641289]
LASSO = [77.05184664, 76.6605054, 75.93458699, 75.11643656, 76.71335943, 76.86960232, 76.18808869, 75.07415713,
         76.54911905, 78.02186305, 79.05138071, 79.22141743]
ENSEMBLE = [78.28166462, 76.93903131, 76.39302479, 73.95922526, 74.01663096, 74.99321313, 73.02940367, 72.79874227,
            73.95522724, 75.16193904, 75.78024702, 75.90709681]
MONTHS = [dt.date(2024 + (8 + i) // 12, (8 + i) % 12 + 1, 1) for i in range(12)]


@pytest.fixture(scope="module")
def metrics(spark):
    return spark.createDataFrame([("s", *r) for r in FOLDS],
                                 "series_id string, fold bigint, model string, mae double, rmse double, mape double, da double, wba double")


def test_scores_weights_and_choice(metrics):
    order = (*MODEL_ORDER, "svr")
    rows = {r["model"]: r for r in E.select_ensemble(metrics, DEFAULTS, order=order).collect()}
    assert set(rows) == {"svr", "lasso"}
    assert rows["svr"]["fq_score"] == pytest.approx(0.8753875283, abs=1e-9)
    assert rows["lasso"]["fq_score"] == pytest.approx(0.7773048262, abs=1e-9)
    assert rows["svr"]["weight"] == pytest.approx(0.5296736116, abs=1e-9)


def test_ensemble_and_metrics_of_the_latest_fold(spark):
    fc = [("s", 2, m, i + 1, MONTHS[i], v) for m, path in (("svr", SVR), ("lasso", LASSO)) for i, v in enumerate(path)]
    fc = spark.createDataFrame(fc, "series_id string, fold bigint, model string, step bigint, period date, yhat double")
    weights = spark.createDataFrame([("s", "svr", 0.5296736116), ("s", "lasso", 0.4703263884)], "series_id string, model string, weight double")
    ens = E.weighted_ensemble(fc.join(weights, ["series_id", "model"]), ("period",)).orderBy("period").collect()
    assert [r["yhat"] for r in ens] == pytest.approx(ENSEMBLE, abs=1e-7)
    actual = spark.createDataFrame(list(zip(MONTHS, ACTUAL)), "period date, actual double")
    scored = fc.join(actual, "period").withColumn("last_train", F.lit(74.0))
    got = {r["model"]: r for r in M.forecast_metrics(scored).collect()}
    assert got["svr"]["mae"] == pytest.approx(3.361430137, abs=1e-8)
    assert got["svr"]["rmse"] == pytest.approx(4.094910378, abs=1e-8)
    assert got["svr"]["mape"] == pytest.approx(0.04681368914, abs=1e-9)
    assert got["svr"]["wba"] == pytest.approx(0.8333333333, abs=1e-9)


def test_inverse_mape_weights(spark):
    rows = [("V94", 0.258, 0.223, 0.259, 0.318, 0.366, 0.316), ("V1", 0.073, 0.208, 0.074, 0.428, 0.15, 0.422),
            ("V57", 0.968, 0.845, 0.99, 0.32, 0.367, 0.313), ("V35", 3.437, 0.938, 1.378, 0.14, 0.512, 0.348)]
    errors = spark.createDataFrame([("s", r[0], m, e) for r in rows for m, e in zip(("ets", "arima", "theta"), r[1:4])],
                                   "series_id string, variable string, model string, mape double")
    got = {(r["variable"], r["model"]): r["weight"] for r in E.inverse_mape_weights(errors).collect()}
    for r in rows:
        for m, w in zip(("ets", "arima", "theta"), r[4:]):
            assert got[r[0], m] == pytest.approx(w, abs=2e-2)


def test_composite_score(spark):
    rows = [("V94", 0.78, 0.833, 5.755, 9.56, 1.0), ("V1", 0.611, 0.612, 4.732, 3.322, 0.655), ("V108", 0.386, 0.268, 4.74, 0.584, 0.429),
            ("V57", 0.438, 0.563, 1.982, 0.231, 0.358), ("V35", 0.506, 0.373, 2.235, 0.531, 0.353), ("V2", 0.513, 0.444, 0.626, 2.19, 0.34)]
    df = spark.createDataFrame([("s", *r[:5]) for r in rows], "series_id string, variable string, corr double, mi double, elasticnet double, tree double")
    got = {r["variable"]: r["composite"] for r in S.composite_score(df).collect()}
    for r in rows:
        assert got[r[0]] == pytest.approx(r[5], abs=1e-3)


def test_flat_driver_future(spark):
    future = [3216.279871, 3264.562057, 3280.457899, 3260.039305, 3246.36354, 3217.28698, 3212.607202, 3196.632467,
              3210.453038, 3213.983825, 3213.559329, 3228.432946]
    f = spark.createDataFrame([("s", "V2", m, v) for m, v in zip(MONTHS, future)], "series_id string, variable string, period date, value double")
    hist = [1653.0, 5746.0, 2930.0, 3178.0]
    h = spark.createDataFrame([("s", "V2", dt.date(2020, i + 1, 1), v) for i, v in enumerate(hist)], f.schema)
    row = driver_anomalies(h, f).first()
    assert row["future_std"] == pytest.approx(25.14581131, abs=1e-6)
    assert row["future_mean"] == pytest.approx(3230.054872, abs=1e-5)
    assert row["flag_flat"] and not row["flag_out_of_range"] and row["risk_score"] == 20
    assert series_risk(driver_anomalies(h, f)).first()["risk_label"] == "Low"
