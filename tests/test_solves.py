"""Pruning by downdating, and the band of the differenced regression."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_operators import make_panel
from tidemark.operators import folds as FO
from tidemark.operators import importance as I
from tidemark.operators.linear_models import center_panel, fit_linear, forecast_linear


def plain_prune(r, most):
    left, drops = list(range(len(r))), []
    while len(left) > 1:
        v = np.diag(np.linalg.pinv(r[np.ix_(left, left)]))
        if v.max() <= most:
            break
        drops.append(left.pop(int(np.argmax(v))))
    return drops, left


@pytest.mark.parametrize("seed", range(6))
def test_downdated_pruning_is_that_of_new_inverses(seed):
    rng = np.random.default_rng(seed)
    hidden = rng.normal(size=(300, 6))
    x = hidden @ rng.normal(size=(6, 25)) + 0.3 * rng.normal(size=(300, 25))
    r = np.corrcoef(x.T)
    drops, left, values = I._prune_order(r, 10.0)
    assert ([c for c, _ in drops], left) == plain_prune(r, 10.0)
    assert len(drops) > 5 and all(v > 10 for _, v in drops) and values.max() <= 10
    assert values == pytest.approx(np.diag(np.linalg.inv(r[np.ix_(left, left)])))


def test_exact_copies_go_first_and_wide_panels_are_fast():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    drops, left, _ = I._prune_order(np.corrcoef(np.column_stack([x, x[:, 1], x[:, 0] + x[:, 2]]).T), 10.0)
    assert [v for _, v in drops] == [np.inf, np.inf] and len(left) == 5
    wide = rng.normal(size=(1560, 12)) @ rng.normal(size=(12, 128)) + 0.5 * rng.normal(size=(1560, 128))
    start = time.perf_counter()
    drops, left, _ = I._prune_order(np.corrcoef(wide.T), 10.0)
    assert len(drops) > 30 and time.perf_counter() - start < 20


def test_drops_are_listed_in_order(spark):
    pairs = [("s", a, b, 1.0 if a == b else c) for a, b, c in [("a", "a", 1), ("b", "b", 1), ("c", "c", 1), ("a", "b", 0.97), ("a", "c", 0.2), ("b", "c", 0.1)]]
    got = I.vif_drops(spark.createDataFrame(pairs, "series_id string, a string, b string, corr double"), ["a", "b", "c"]).collect()
    steps = {r.variable: r.step for r in got}
    assert sorted(steps.values(), key=str) == [1, None, None] and steps["c"] is None


def test_differenced_regression_follows_a_trend_out_of_its_differences_band(spark):
    """Levels may leave the range that differences have; a path held in it would end far below half of the target."""
    panel = make_panel(spark, series=("a",)).withColumn(
        "target", F.col("target") * F.exp(0.05 * F.months_between("period", F.lit("2015-01-01").cast("date"))))
    folds = FO.make_folds(panel, 12)
    c = center_panel(panel, ["x1", "x2"], folds)
    fits = fit_linear(c, folds, ["x1", "x2"], "M", ["arx"])
    got = forecast_linear(fits, c, folds, FO.holdout_rows(panel, folds), ["x1", "x2"], "M", models=["arx"]).join(panel, ["series_id", "period"])
    assert got.agg(F.max(F.abs(F.col("yhat") / F.col("target") - 1))).first()[0] < 0.45


def test_elastic_net_gap_certifies_the_optimum():
    from tidemark.operators import gram as G

    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 8)) @ (np.eye(8) + 0.4 * rng.normal(size=(8, 8)))
    y = x[:, 0] - 2 * x[:, 3] + rng.normal(size=200)
    z = np.column_stack([(x - x.mean(0)) / x.std(0), y - y.mean()])
    parts = [np.column_stack([np.ones(len(p)), p]) for p in np.array_split(z, 6)]
    coef, penalty, ratio, gap = G.elastic_net_fit([p.T @ p for p in parts], (0.1, 0.5, 0.9))
    cov = z.T @ z / len(z)
    assert 0 <= gap + 1e-15 and gap <= G.GAP
    assert G.duality_gap(cov, coef[1:] + 0.05, penalty, ratio) > 1e-5

    def loss(w):
        return 0.5 * np.mean((z[:, -1] - z[:, :-1] @ w) ** 2) + penalty * (ratio * np.abs(w).sum() + (1 - ratio) / 2 * w @ w)

    best = loss(coef[1:])
    assert all(loss(coef[1:] + 1e-3 * rng.normal(size=8)) >= best - 1e-12 for _ in range(200))
