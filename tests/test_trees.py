"""Trees per series: against a plain recursive version, and the same whatever the order and company of rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import folds as FO
from tidemark.operators import importance as I
from tidemark.operators import trees as T
from tidemark.operators.linear_models import center_panel
from tidemark.operators.tree_models import TREE_MODELS, fit_trees, forecast_trees
from tidemark.settings import DEFAULTS
from test_operators import make_panel

FEW = DEFAULTS.with_(n_trees=12)


@pytest.fixture(scope="module")
def panel(spark):
    return make_panel(spark).cache()


def score(g, h, p):
    return max(abs(g) - p.l1, 0) ** 2 / (h + p.l2)


def plain_tree(x, g, p, depth, cuts):
    """(feature, threshold, left, right) or a leaf value, by trying every split between two values of the whole fit."""
    def leaf():
        return -p.rate * np.sign(g.sum()) * max(abs(g.sum()) - p.l1, 0) / (len(g) + p.l2)

    best = (1e-12, None)
    for f in range(x.shape[1] if depth else 0):
        for threshold in cuts[f]:
            left = x[:, f] <= threshold
            if min(left.sum(), (~left).sum()) >= p.min_rows:
                gain = score(g[left].sum(), left.sum(), p) + score(g[~left].sum(), (~left).sum(), p) - score(g.sum(), len(g), p)
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, (f, threshold, left))
    if best[1] is None:
        return leaf()
    f, threshold, left = best[1]
    return f, threshold, plain_tree(x[left], g[left], p, depth - 1, cuts), plain_tree(x[~left], g[~left], p, depth - 1, cuts)


def plain_predict(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def plain_boost(x, y, p):
    trees, base = [], y.mean()
    cuts = [(np.unique(c)[1:] + np.unique(c)[:-1]) / 2 for c in x.T]
    prediction = np.full(len(y), base)
    for _ in range(p.n_trees):
        trees.append(plain_tree(x, prediction - y, p, p.depth, cuts))
        prediction = prediction + [plain_predict(trees[-1], r) for r in x]
    return lambda rows: np.array([base + sum(plain_predict(t, r) for t in trees) for r in rows])


def fits(n=5, seed=0, columns=4):
    rng = np.random.default_rng(seed)
    xs = [np.round(rng.normal(size=(30 + 3 * i, columns)), 6) for i in range(n)]
    return xs, [x[:, 0] * 2 + np.sin(3 * x[:, 1]) + 0.1 * rng.normal(size=len(x)) for x in xs]


@pytest.mark.parametrize("p", [
    T.TreeParams(n_trees=6, rate=0.3, depth=3, min_rows=3, l1=0.1, rows=1.0, columns=1.0),
    T.TreeParams(n_trees=4, rate=0.5, depth=20, min_rows=4, l2=0.5, rows=1.0, columns=1.0)])
def test_boosting_is_the_plain_one(p):
    xs, ys = fits()
    new = np.random.default_rng(9).normal(size=(50, 4))
    for fit, x, y in zip(T.fit_together(xs, ys, p), xs, ys):
        assert np.allclose(T.predict_together([fit], new, np.zeros(50, int)), plain_boost(x, y, p)(new), atol=1e-9)


@pytest.mark.parametrize("name", sorted(T.PRESETS))
def test_a_fit_does_not_depend_on_its_company_or_on_noise(name):
    p = T.PRESETS[name].with_(n_trees=8)
    xs, ys = fits(seed=3, columns=6)
    together = T.fit_together(xs, ys, p)
    for fit, x, y in zip(together, xs, ys):
        alone = T.fit_together([x + 1e-13], [y - 1e-13], p)[0]
        assert all(np.array_equal(fit[k], alone[k]) for k in fit)
        assert len(fit["root"]) == 8
    assert np.allclose(T.predict_together(together, np.stack([x[0] for x in xs]), np.arange(5)),
                       [T.predict_together([f], x[:1], np.zeros(1, int))[0] for f, x in zip(together, xs)], atol=0)


def test_leaves_are_capped_and_symmetric_trees_share_their_splits():
    xs, ys = fits(1, seed=4)
    capped = T.fit_together(xs, ys, T.TreeParams(n_trees=3, depth=10, leaves=5, rows=1.0, columns=1.0))[0]
    assert [int((part < 0).sum()) for part in np.split(capped["feature"], capped["root"][1:])] == [5, 5, 5]
    even = T.fit_together(xs, ys, T.TreeParams(n_trees=1, depth=3, symmetric=True, rows=1.0, columns=1.0))[0]
    level = [0]
    for _ in range(3):
        assert len({(even["feature"][i], even["threshold"][i]) for i in level}) == 1
        level = [even["child"][i] + k for i in level for k in (0, 1)]
    assert len(even["feature"]) == 15


def test_many_values_are_binned_and_missing_ones_have_no_prediction():
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=2000), rng.integers(0, 3, 2000)]).astype(float)
    fit = T.fit_together([x], [np.sign(x[:, 0]) + x[:, 1]], T.PRESETS["gbt_xgboost"].with_(n_trees=60, columns=1.0))[0]
    got = T.predict_together([fit], np.array([[1.0, 2], [-1.0, 0], [np.nan, 1]]), np.zeros(3, int))
    assert got[:2] == pytest.approx([3, -1], abs=0.2) and np.isnan(got[2])


def test_forest_is_an_average_within_the_range():
    xs, ys = fits(2, seed=6)
    for fit, x, y in zip(T.fit_together(xs, ys, T.PRESETS["rf"].with_(n_trees=40)), xs, ys):
        got = T.predict_together([fit], x, np.zeros(len(x), int))
        assert y.min() < got.min() and got.max() < y.max() and np.corrcoef(got, y)[0, 1] > 0.6


def test_first_split_is_that_of_the_query(spark):
    xs, ys = fits(3, seed=7)
    p = T.TreeParams(n_trees=1, depth=1, min_rows=3, l1=0.1, rows=1.0, columns=1.0)
    rows = [(f"s{i}", f"v{c}", float(v), float(y)) for i, (x, ys_) in enumerate(zip(xs, ys)) for r, y in zip(x, ys_) for c, v in enumerate(r)]
    best = T.root_splits(spark.createDataFrame(rows, "series_id string, variable string, value double, label double"), ["series_id"], p)
    for i, fit in enumerate(T.fit_together(xs, ys, p)):
        own = {r.variable: r for r in best.filter(F.col("series_id") == f"s{i}").collect()}
        top = max(own.values(), key=lambda r: r.gain)
        assert fit["feature"][0] == int(top.variable[1:]) and fit["threshold"][0] == pytest.approx(top.threshold, abs=1e-9)


def test_forecasts_ignore_row_order_and_holdout_targets(spark, panel):
    drivers = ["x1", "x2"]
    folds = FO.make_folds(panel, 12)
    ends = folds.groupBy("series_id").agg(F.min("train_end").alias("_end"))

    def run(p):
        got = forecast_trees(center_panel(p, drivers, folds), folds, FO.holdout_rows(panel, folds), drivers, "M", TREE_MODELS, FEW)
        return {(r.series_id, r.fold, r.model, r.step): r.yhat for r in got.collect()}

    base = run(panel)
    assert {k[2] for k in base} == set(TREE_MODELS) and all(np.isfinite(v) for v in base.values())
    assert run(panel.repartition(7).orderBy(F.desc("period"))) == base
    # Rows after the first fold's training slice only matter to later folds.
    tripled = panel.join(ends, "series_id").withColumn("target", F.when(F.col("period") > F.col("_end"), F.col("target") * 3).otherwise(F.col("target"))).drop("_end")
    first = {k: v for k, v in run(tripled).items() if k[1] == 1}
    assert first == {k: v for k, v in base.items() if k[1] == 1}


def test_node_table_and_importance(spark):
    xs, ys = fits(2, seed=8)
    rows = [(f"s{i}", n, [float(v) for v in r], float(y)) for i, (x, ys_) in enumerate(zip(xs, ys)) for n, (r, y) in enumerate(zip(x, ys_))]
    train = spark.createDataFrame(rows, "series_id string, period int, x array<double>, label double")
    fitted = fit_trees(train, {"gbt_xgboost": T.PRESETS["gbt_xgboost"].with_(n_trees=5)}, ["series_id"])
    nodes = T.node_table(fitted, ["series_id", "model"])
    want = T.fit_together(xs, ys, T.PRESETS["gbt_xgboost"].with_(n_trees=5))
    for i, fit in enumerate(want):
        own = nodes.filter(F.col("series_id") == f"s{i}").orderBy("node").collect()
        assert [r.feature if r.feature is not None else -1 for r in own] == fit["feature"].tolist()
        assert sorted({r.tree for r in own}) == list(range(5))
        assert [r.value is None for r in own] == [r.feature is not None for r in own]
    flat = spark.createDataFrame([(s, n, *x, y) for s, n, x, y in rows], "series_id string, period int, a double, b double, c double, d double, target double")
    top = I.tree_importance_rank(flat, ["a", "b", "c", "d"], FEW)
    scores = {(r.series_id, r.variable): r.score for r in top.collect()}
    assert all(scores[s, "a"] > max(scores[s, "c"], scores[s, "d"]) for s in ("s0", "s1"))
