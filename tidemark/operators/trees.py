"""Histogram trees, one fit per series and fold, many fits at once.

Rows of a fit are one per period, so the calendar bounds them (80 months, 1,560 weeks in thirty years). They are grouped into
arrays by period order, Spark spreads the fits, and a task grows the trees of all its fits together: gradient sums by (fit, node,
feature, bin) are one ``bincount`` per level. A fitted ensemble is a row of node arrays; ``node_table`` turns it into one row per node.

Results do not depend on the order or the partitions of rows: values are rounded, rows sorted by period, samples drawn by tree
and row number, and of equally good splits the first one (by feature, then bin) is taken.

``root_splits`` is the search for the first split as a query of its own: sums by bin, running sums, best gain.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 64
# Fits that are grown together in one task at a time.
TOGETHER = 64
DIGITS = 9
TIE = 1e-9


@dataclass(frozen=True)
class TreeParams:
    """``rate`` 0 makes a forest: bagged rows, features drawn per node, means in the leaves."""

    n_trees: int = 500
    rate: float = 0.05
    depth: int = 4
    min_rows: float = 1.0
    l1: float = 0.0
    l2: float = 1.0
    rows: float = 0.8
    columns: float = 0.8
    leaves: int = 1 << 30
    symmetric: bool = False
    seed: int = 42

    def with_(self, **changes) -> "TreeParams":
        return replace(self, **changes)


# Parameters of the ensembles being matched.
PRESETS = {
    "gbt_lgbm": TreeParams(rate=0.03, depth=30, leaves=31, min_rows=10, l1=0.1, l2=1.0, rows=0.8, columns=0.8),
    "gbt_catboost": TreeParams(rate=0.05, depth=4, l2=5.0, rows=0.8, columns=1.0, symmetric=True),
    "gbt_xgboost": TreeParams(rate=0.05, depth=4, min_rows=3, l1=0.1, l2=1.0, rows=0.8, columns=0.8),
    "rf": TreeParams(rate=0.0, depth=8, min_rows=10, l2=0.0, rows=1.0, columns=0.7),
    "importance": TreeParams(rate=0.05, depth=4, rows=0.8, columns=0.8),
}

NODES = "struct<feature:array<int>,threshold:array<double>,child:array<int>,value:array<double>,root:array<int>,base:double,reason:string>"


def draw(*parts) -> np.ndarray:
    """Uniform numbers in [0, 1) that depend on the given whole numbers alone."""
    h = np.full(1, 0x9E3779B97F4A7C15, np.uint64)
    for p in parts:
        h = h ^ np.asarray(p).astype(np.uint64)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h = h ^ (h >> np.uint64(31))
    return (h >> np.uint64(11)).astype(np.float64) / (1 << 53)


def binned(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin of every value and the upper threshold of every bin, for each column of one fit."""
    codes, cuts = np.zeros(x.shape, np.int64), np.full((x.shape[1], BINS), np.inf)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        if len(values) > BINS:
            values = np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS, method="lower"))
            codes[:, f] = np.searchsorted(values, x[:, f], side="left")
            cuts[f, : len(values)] = values
        else:
            codes[:, f] = np.searchsorted(values, x[:, f])
            cuts[f, : len(values) - 1] = (values[1:] + values[:-1]) / 2
    return codes, cuts


def _score(g: np.ndarray, h: np.ndarray, p: TreeParams) -> np.ndarray:
    soft = np.sign(g) * np.maximum(np.abs(g) - p.l1, 0)
    return np.divide(soft * soft, h + p.l2, out=np.zeros_like(g), where=h + p.l2 > 0)


def _first_best(gain: np.ndarray) -> np.ndarray:
    """For every row the first place whose gain is the largest, up to rounding."""
    best = gain.max(axis=1, keepdims=True)
    return np.argmax(gain >= best - TIE * np.abs(best), axis=1)


class _Tree:
    """One tree of every fit while it grows; node i < n_fits is the root of fit i."""

    def __init__(self, n_fits: int):
        self.fit = np.arange(n_fits)
        self.feature, self.threshold = np.full(n_fits, -1), np.zeros(n_fits)
        self.child, self.value = np.zeros(n_fits, np.int64), np.zeros(n_fits)
        self.path = np.ones(n_fits, np.int64)

    def split(self, nodes: np.ndarray, feature: np.ndarray, threshold: np.ndarray) -> np.ndarray:
        """Both children of every node, side by side; returns the left ones."""
        left = len(self.fit) + 2 * np.arange(len(nodes))
        self.feature[nodes], self.threshold[nodes], self.child[nodes] = feature, threshold, left
        n = 2 * len(nodes)
        self.fit = np.concatenate([self.fit, np.repeat(self.fit[nodes], 2)])
        self.path = np.concatenate([self.path, (2 * self.path[nodes][:, None] + np.arange(2)).reshape(-1)])
        self.feature, self.threshold = np.concatenate([self.feature, np.full(n, -1)]), np.concatenate([self.threshold, np.zeros(n)])
        self.child, self.value = np.concatenate([self.child, np.zeros(n, np.int64)]), np.concatenate([self.value, np.zeros(n)])
        return left


def _grow(code, cuts, fit, g, w, columns, p: TreeParams, tree_number: int) -> tuple[_Tree, np.ndarray]:
    """One tree of every fit, level by level, and the leaf of every row."""
    tree = _Tree(len(cuts))
    node, active, leaves = fit.copy(), np.arange(len(cuts)), np.ones(len(cuts), np.int64)
    gw, n_columns = g * w, len(columns)
    for _ in range(p.depth):
        place = np.full(len(tree.fit), -1)
        place[active] = np.arange(len(active))
        rows = np.flatnonzero(place[node] >= 0)
        if not len(rows):
            break
        key = ((place[node[rows]][:, None] * n_columns + np.arange(n_columns)) * BINS + code[np.ix_(rows, columns)]).reshape(-1)
        shape = (len(active), n_columns, BINS)
        gl = np.cumsum(np.bincount(key, np.repeat(gw[rows], n_columns), np.prod(shape)).reshape(shape), axis=2)
        hl = np.cumsum(np.bincount(key, np.repeat(w[rows], n_columns), np.prod(shape)).reshape(shape), axis=2)
        gt, ht = gl[:, :, -1:], hl[:, :, -1:]
        gain = _score(gl, hl, p) + _score(gt - gl, ht - hl, p) - _score(gt, ht, p)
        if p.symmetric:
            # All nodes of a fit take the split with the largest sum of gains; a side may be empty.
            begins = np.flatnonzero(np.diff(tree.fit[active], prepend=-1))
            gain = np.add.reduceat(gain, begins, axis=0)
            one = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(active))))
        else:
            enough = (hl >= p.min_rows) & (ht - hl >= p.min_rows) & (hl > 0) & (ht > hl)
            if not p.rate and p.columns < 1:
                score = draw(p.seed, tree_number, tree.path[active][:, None], 1 + columns[None, :])
                take = max(1, int(p.columns * n_columns))
                enough &= (score <= np.sort(score, axis=1)[:, take - 1 : take])[:, :, None]
            gain, one = np.where(enough, gain, -np.inf), np.arange(len(active))
        flat = gain.reshape(len(gain), -1)
        at = _first_best(flat)
        best = flat[np.arange(len(flat)), at][one]
        column, bin_ = at[one] // BINS, at[one] % BINS
        good = best > 1e-12
        if p.leaves < 1 << 29:
            # The best splits first, as long as a fit may have more leaves.
            order = np.lexsort((-best, tree.fit[active]))
            order = order[good[order]]
            owner = tree.fit[active][order]
            rank = np.arange(len(order)) - np.searchsorted(owner, owner)
            good = np.zeros(len(active), bool)
            good[order[leaves[owner] + rank < p.leaves]] = True
        if not good.any():
            break
        nodes = active[good]
        np.add.at(leaves, tree.fit[nodes], 1)
        feature = columns[column[good]]
        left = tree.split(nodes, feature, cuts[tree.fit[nodes], feature, bin_[good]])
        at = np.full(len(tree.fit), -1)
        at[nodes] = np.arange(len(nodes))
        rows = np.flatnonzero(at[node] >= 0)
        own = at[node[rows]]
        node[rows] = left[own] + (code[rows, feature[own]] > bin_[good][own])
        active = np.sort(np.concatenate([left, left + 1]))
    sums, weights = np.bincount(node, gw, len(tree.fit)), np.bincount(node, w, len(tree.fit))
    if p.rate:
        soft = np.sign(sums) * np.maximum(np.abs(sums) - p.l1, 0)
        tree.value = -p.rate * np.divide(soft, weights + p.l2, out=np.zeros_like(soft), where=weights + p.l2 > 0)
    else:
        tree.value = np.divide(-sums, weights, out=np.zeros_like(sums), where=weights > 0) / p.n_trees
    tree.value[tree.feature >= 0] = 0.0
    return tree, node


def fit_together(xs: Sequence[np.ndarray], ys: Sequence[np.ndarray], p: TreeParams) -> list[dict]:
    """The ensembles of several fits; each gets the trees it would get alone."""
    coded = [binned(np.round(x, DIGITS)) for x in xs]
    code, cuts = np.concatenate([c for c, _ in coded]), np.stack([c for _, c in coded])
    ys = [np.round(y, DIGITS) for y in ys]
    sizes = np.array([len(y) for y in ys])
    fit, y = np.repeat(np.arange(len(ys)), sizes), np.concatenate(ys)
    number = np.concatenate([np.arange(n) for n in sizes])
    base = np.array([v.mean() for v in ys])
    prediction, every = base[fit], np.arange(code.shape[1])
    trees = []
    for t in range(p.n_trees):
        if p.rate:
            w = (draw(p.seed, t, 1, number) < p.rows).astype(float)
            chosen = np.sort(np.argsort(draw(p.seed, t, 2, every), kind="stable")[: max(1, int(p.columns * len(every)))])
        else:
            # As many draws with replacement as the fit has rows.
            drawn = (draw(p.seed, t, 1, number) * sizes[fit]).astype(np.int64) + (np.cumsum(sizes) - sizes)[fit]
            w, chosen = np.bincount(drawn, minlength=len(y)).astype(float), every
        tree, leaf = _grow(code, cuts, fit, prediction - y, w, chosen, p, t)
        if p.rate:
            prediction = prediction + tree.value[leaf]
        trees.append(tree)
    step = np.cumsum([0, *(len(t.fit) for t in trees)])
    owner = np.concatenate([t.fit for t in trees])
    child = np.concatenate([t.child + s for t, s in zip(trees, step)])
    is_root = np.concatenate([np.arange(len(t.fit)) < len(ys) for t in trees])
    feature, threshold, value = (np.concatenate([getattr(t, n) for t in trees]) for n in ("feature", "threshold", "value"))
    order = np.argsort(owner, kind="stable")
    first = np.searchsorted(owner[order], np.arange(len(ys) + 1))
    renumbered = np.empty(len(order), np.int64)
    renumbered[order] = np.arange(len(order)) - first[owner[order]]
    out = []
    for i in range(len(ys)):
        own = order[first[i] : first[i + 1]]
        inner = feature[own] >= 0
        out.append({"feature": feature[own].astype(np.int32), "threshold": threshold[own],
                    "child": np.where(inner, renumbered[np.where(inner, child[own], 0)], 0).astype(np.int32),
                    "value": value[own], "root": np.flatnonzero(is_root[own]).astype(np.int32), "base": float(base[i])})
    return out


def predict_together(ensembles: Sequence[dict], x: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Predictions for rows of ``x``, row i by ensemble owner[i]; a row with a missing value has none."""
    sizes = np.array([len(e["feature"]) for e in ensembles])
    start = np.cumsum(sizes) - sizes
    feature, threshold, child, value = (np.concatenate([np.asarray(e[n]) for e in ensembles]) for n in ("feature", "threshold", "child", "value"))
    child = child + np.repeat(start, sizes)
    trees = max(len(e["root"]) for e in ensembles)
    roots = np.stack([np.resize(np.asarray(e["root"]), trees) + s for e, s in zip(ensembles, start)])
    used = np.array([len(e["root"]) for e in ensembles])[owner][:, None] > np.arange(trees)
    at, rows = roots[owner], np.arange(len(x))[:, None]
    rounded = np.round(x, DIGITS)
    while True:
        f = feature[at]
        inner = f >= 0
        if not inner.any():
            break
        at = np.where(inner, child[at] + (rounded[rows, np.maximum(f, 0)] > threshold[at]), at)
    total = np.where(used, value[at], 0.0).sum(axis=1) + np.array([e["base"] for e in ensembles])[owner]
    return np.where(np.isfinite(x).all(axis=1), total, np.nan)


def exchange_importance(ensemble: dict, x: np.ndarray, seed: int) -> np.ndarray:
    """For each column the mean |change of the prediction| when its values are exchanged between rows."""
    n, columns = x.shape
    other = x[np.argsort(draw(seed, 3, np.arange(n)), kind="stable")]
    # The rows as they are, then the rows with one column exchanged, column by column.
    mixed = np.concatenate([x, *(np.where(np.arange(columns) == f, other, x) for f in range(columns))])
    y = predict_together([ensemble], mixed, np.zeros(len(mixed), np.int64)).reshape(columns + 1, n)
    return np.abs(y[1:] - y[0]).mean(axis=1)


def fit_udf(presets: dict[str, TreeParams]):
    """Column function (preset name, x: array of rows, y) -> node arrays."""
    names = ["feature", "threshold", "child", "value", "root", "base", "reason"]

    def checked(x, y) -> tuple[np.ndarray, np.ndarray]:
        x, y = np.stack(x).astype(float), np.asarray(y, dtype=float)
        if not (np.isfinite(x).all() and np.isfinite(y).all()):
            raise ValueError("a training value is missing or not finite")
        return x, y

    @F.pandas_udf(NODES)
    def fit(name: pd.Series, xs: pd.Series, ys: pd.Series) -> pd.DataFrame:
        out: list = [None] * len(name)
        ready: dict = {}
        for i, (x, y) in enumerate(zip(xs, ys)):
            try:
                ready[i] = checked(x, y)
            except (TypeError, ValueError) as e:
                out[i] = {"reason": f"{type(e).__name__}: {e}"}
        for preset in sorted(name.unique()):
            at = [i for i in np.flatnonzero((name == preset).to_numpy()) if i in ready]
            for low in range(0, len(at), TOGETHER):
                part = at[low : low + TOGETHER]
                for i, one in zip(part, fit_together([ready[i][0] for i in part], [ready[i][1] for i in part], presets[preset])):
                    out[i] = one
        return pd.DataFrame(out, columns=names).astype(object).where(lambda v: v.map(lambda e: isinstance(e, (np.ndarray, str)) or e == e), None)

    return fit


def node_table(fits: DataFrame, keys: Sequence[str], column: str = "trees") -> DataFrame:
    """(keys, tree, node, feature, threshold, child, value): one row per node; a leaf has no feature."""
    n = F.col(f"{column}.feature")
    nodes = F.arrays_zip(n.alias("feature"), F.col(f"{column}.threshold").alias("threshold"), F.col(f"{column}.child").alias("child"),
                         F.col(f"{column}.value").alias("value"))
    rows = fits.select(*keys, F.col(f"{column}.root").alias("_roots"), F.posexplode(nodes).alias("node", "_n"))
    rows = rows.withColumn("tree", F.size(F.filter("_roots", lambda r: r <= F.col("node"))) - 1)
    leaf = F.col("_n.feature") < 0
    return rows.select(*keys, "tree", "node", *[F.when(~leaf, F.col(f"_n.{c}")).alias(c) for c in ("feature", "threshold", "child")],
                       F.when(leaf, F.col("_n.value")).alias("value"))


def root_splits(long: DataFrame, keys: Sequence[str], params: TreeParams, value: str = "value", label: str = "label") -> DataFrame:
    """(keys, variable, threshold, gain): each variable's best first split, over all rows of a key.

    ``long`` has keys, variable, value, label. Rows are summed by (key, variable, distinct value) before anything is ordered.
    """
    by = [*keys, "variable"]
    rows = long.withColumn("_v", F.round(value, DIGITS))
    means = rows.groupBy(*by).agg(F.avg(label).alias("_m"))
    bins = rows.groupBy(*by, "_v").agg(F.sum(label).alias("_y"), F.count(F.lit(1)).alias("_n")).join(means, by)
    bins = bins.withColumn("_g", F.col("_m") * F.col("_n") - F.col("_y"))
    w = Window.partitionBy(*by).orderBy("_v")
    run = bins.withColumns({"gl": F.sum("_g").over(w), "hl": F.sum("_n").over(w), "next": F.lead("_v").over(w),
                            "gt": F.sum("_g").over(Window.partitionBy(*by)), "ht": F.sum("_n").over(Window.partitionBy(*by))})

    def score(g: Column, h: Column) -> Column:
        soft = F.greatest(F.abs(g) - params.l1, F.lit(0.0))
        return soft * soft / (h + params.l2)

    gl, hl, gt, ht = (F.col(c) for c in ("gl", "hl", "gt", "ht"))
    gain = score(gl, hl) + score(gt - gl, ht - hl) - score(gt, ht)
    able = run.filter((hl >= params.min_rows) & (ht - hl >= params.min_rows) & F.col("next").isNotNull()).withColumn("gain", gain)
    best = F.max_by(F.struct(((F.col("_v") + F.col("next")) / 2).alias("threshold"), "gain"),
                    F.struct(F.round("gain", DIGITS), -F.col("_v")))
    return able.groupBy(*by).agg(best.alias("b")).select(*by, "b.threshold", "b.gain")
