"""Importance of drivers: elastic net, boosted trees by permutation, linear attribution."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import gram as G
from tidemark.operators import trees as T
from tidemark.operators.linear_models import CV_SLICES, L1_RATIOS
from tidemark.operators.selection import standardize
from tidemark.session import spread
from tidemark.settings import DEFAULTS, Settings


def _names(variables: Sequence[str]):
    return F.array(*[F.lit(v) for v in variables])


def _unstack(df: DataFrame, variables: Sequence[str], column: str) -> DataFrame:
    """(series_id, variable, score) from an array that is aligned with the variables."""
    pairs = F.arrays_zip(_names(variables).alias("variable"), F.col(column).alias("score"))
    return df.select("series_id", F.explode(pairs).alias("r")).select("series_id", "r.variable", "r.score")


def time_slices(panel: DataFrame, n_slices: int = CV_SLICES) -> DataFrame:
    """Adds ``cv_slice``: 0 starts the first training slice, k is the k-th test slice."""
    w = Window.partitionBy("series_id")
    n, rn = F.count(F.lit(1)).over(w), F.row_number().over(w.orderBy("period")) - 1
    test = F.greatest(F.floor(n / (n_slices + 1)), F.lit(1))
    first = n - n_slices * test
    return panel.withColumn("cv_slice", F.when(rn < first, 0).otherwise(1 + F.floor((rn - first) / test)).cast("int"))


def elasticnet_fits(panel: DataFrame, variables: Sequence[str], ratios: Sequence[float] = L1_RATIOS) -> DataFrame:
    """(series_id, coef, penalty, ratio, gap): cross-validated elastic nets on standardised drivers, and how exact they are."""
    z = standardize(panel.filter("target IS NOT NULL"), variables)
    centred = z.withColumn("_y", F.col("target") - F.avg("target").over(Window.partitionBy("series_id")))
    design = time_slices(centred).select("series_id", "cv_slice", F.array(*variables, "_y").alias("x"))
    sums = spread(G.gram(design, ["series_id", "cv_slice"]), "series_id")
    cells = sums.groupBy("series_id").agg(F.array_sort(F.collect_list(F.struct("cv_slice", "g"))).getField("g").alias("g"))
    ratios = tuple(ratios)

    @F.pandas_udf("struct<coef:array<double>,penalty:double,ratio:double,gap:double>")
    def fit(grams: pd.Series) -> pd.DataFrame:
        rows = []
        for gs in grams:
            coef, penalty, ratio, gap = G.elastic_net_fit([G.unpack(g) for g in gs], ratios)
            rows.append((coef[1:], penalty, ratio, gap))
        return pd.DataFrame(rows, columns=["coef", "penalty", "ratio", "gap"])

    return cells.select("series_id", fit("g").alias("f")).select("series_id", "f.*")


def elasticnet_rank(panel: DataFrame, variables: Sequence[str], ratios: Sequence[float] = L1_RATIOS) -> DataFrame:
    """|coefficient| per standardised driver of a cross-validated elastic net, per series."""
    fits = elasticnet_fits(panel, variables, ratios).withColumn("score", F.transform("coef", F.abs))
    return _unstack(fits, variables, "score")


def elasticnet_optimality(panel: DataFrame, variables: Sequence[str]) -> DataFrame:
    """(series_id, variable, coef, excess): by how much a driver's slope breaks the conditions of the optimum.

    Computed from the rows, not from the solver's sums: the mean product of driver and residual must not exceed the
    penalty, and must equal it, with the coefficient's sign, where the coefficient isn't zero. ``excess`` is a share of the target's deviation.
    """
    z = standardize(panel.filter("target IS NOT NULL"), variables)
    names = _names(variables)
    rows = z.join(elasticnet_fits(panel, variables), "series_id").withColumn("_x", F.array(*variables))
    w = Window.partitionBy("series_id")
    fitted = F.aggregate(F.zip_with("_x", "coef", lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
    rows = rows.withColumn("_r", F.col("target") - F.avg("target").over(w) - fitted)
    each = rows.select("series_id", "target", "_r", "penalty", "ratio", F.explode(F.arrays_zip(names.alias("variable"), F.col("_x").alias("x"), F.col("coef").alias("coef"))).alias("v"))
    sums = each.groupBy("series_id", "v.variable", "v.coef", "penalty", "ratio").agg(
        F.avg(F.col("v.x") * F.col("_r")).alias("_g"), F.stddev_pop("target").alias("_sd"))
    slope = F.col("_g") - F.col("penalty") * (1 - F.col("ratio")) * F.col("coef")
    most = F.col("penalty") * F.col("ratio")
    excess = F.when(F.col("coef") == 0, F.greatest(F.abs(slope) - most, F.lit(0.0))).otherwise(F.abs(slope - most * F.signum("coef")))
    return sums.select("series_id", "variable", "coef", (excess / F.col("_sd")).alias("excess"))


def tree_importance_rank(panel: DataFrame, variables: Sequence[str], settings: Settings = DEFAULTS) -> DataFrame:
    """Mean |change of the prediction| when one driver is exchanged between periods of a series, per series.

    Every series has boosted trees of its own. The exchange pairs the k-th period with the k-th one in a drawn order, so it is
    repeatable and stays inside the series.
    """
    params = T.PRESETS["importance"].with_(n_trees=settings.n_trees, seed=settings.seed)
    rows = panel.filter("target IS NOT NULL").select("series_id", "period", F.array(*[F.col(v).cast("double") for v in variables]).alias("x"),
                                                     F.col("target").alias("label"))
    rows = rows.filter(F.forall("x", lambda v: v.isNotNull()))
    series = rows.groupBy("series_id").agg(F.array_sort(F.collect_list(F.struct("period", "x", "label"))).alias("_r"))
    series = spread(series.select("series_id", F.col("_r.x").alias("x"), F.col("_r.label").alias("y")), "series_id")

    @F.pandas_udf("array<double>")
    def score(xs: pd.Series, ys: pd.Series) -> pd.Series:
        out: list = []
        for low in range(0, len(xs), T.TOGETHER):
            x = [np.stack(v) for v in xs.iloc[low : low + T.TOGETHER]]
            fits = T.fit_together(x, [np.asarray(v) for v in ys.iloc[low : low + T.TOGETHER]], params)
            out += [T.exchange_importance(fit, own, settings.seed) for fit, own in zip(fits, x)]
        return pd.Series(out)

    return _unstack(series.withColumn("score", score("x", "y")), variables, "score")


def linear_attribution(long: DataFrame, coefficients: DataFrame) -> DataFrame:
    """Mean |coefficient x deviation from the mean| of each driver of a linear model."""
    rows = long.join(coefficients.select("series_id", "variable", "coef"), ["series_id", "variable"])
    dev = F.col("value") - F.avg("value").over(Window.partitionBy("series_id", "variable"))
    return rows.withColumn("_c", F.abs(F.col("coef") * dev)).groupBy("series_id", "variable").agg(F.avg("_c").alias("score"))


def corr_rank(corr: DataFrame) -> DataFrame:
    return corr.select("series_id", "variable", F.col("corr_abs").alias("score"))


# ---- redundancy ----------------------------------------------------------------------------


def _vif_values(r: np.ndarray, cutoff: float = 1e-10) -> np.ndarray:
    """Diagonal of the inverse correlation matrix; columns in an exact dependency are infinite."""
    r = np.where(np.eye(len(r)) > 0, 1.0, r)
    values, vectors = np.linalg.eigh(r)
    null = values <= cutoff * max(values[-1], 1.0)
    diag = ((vectors[:, ~null] ** 2) / values[~null]).sum(axis=1)
    trapped = (vectors[:, null] ** 2).sum(axis=1) > 1e-12
    return np.where(trapped, np.inf, np.maximum(diag, 1.0))


def _matrix(pdf: pd.DataFrame, order: Sequence[str]) -> tuple[list[str], np.ndarray]:
    names = [v for v in order if v in set(pdf["a"])]
    at = {v: i for i, v in enumerate(names)}
    r = np.zeros((len(names), len(names)))
    i, j = pdf["a"].map(at).to_numpy(), pdf["b"].map(at).to_numpy()
    r[i, j] = r[j, i] = pdf["corr"].to_numpy()
    return names, r


def vif(pairs: DataFrame, variables: Sequence[str]) -> DataFrame:
    """(series_id, variable, vif) from the correlation pairs (one small matrix per series)."""
    order = list(variables)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        names, r = _matrix(pdf, order)
        return pd.DataFrame({"series_id": pdf["series_id"].iloc[0], "variable": names, "vif": _vif_values(r)})

    return pairs.groupBy("series_id").applyInPandas(solve, "series_id string, variable string, vif double")


def _downdated(inverse: np.ndarray, at: int) -> np.ndarray:
    """The inverse after row and column ``at`` of the matrix are gone: a rank-one change of what is left."""
    keep = np.arange(len(inverse)) != at
    return inverse[np.ix_(keep, keep)] - np.outer(inverse[keep, at], inverse[at, keep]) / inverse[at, at]


def _prune_order(r: np.ndarray, vif_max: float) -> tuple[list[tuple[int, float]], list[int], np.ndarray]:
    """(column, VIF) of every drop in order, the columns that stay and their VIF."""
    left, drops = list(range(len(r))), []
    values = _vif_values(r)
    # Exact dependencies first: there is no inverse to change yet.
    while len(left) > 1 and np.isinf(values.max()):
        worst = int(np.argmax(values))
        drops.append((left.pop(worst), float(values[worst])))
        values = _vif_values(r[np.ix_(left, left)])
    if len(left) > 1 and values.max() > vif_max:
        inverse = np.linalg.inv(np.where(np.eye(len(left)) > 0, 1.0, r[np.ix_(left, left)]))
        while len(left) > 1 and np.diag(inverse).max() > vif_max:
            worst = int(np.argmax(np.diag(inverse)))
            drops.append((left.pop(worst), float(inverse[worst, worst])))
            inverse = _downdated(inverse, worst)
        values = _vif_values(r[np.ix_(left, left)])
    return drops, left, values


def vif_drops(pairs: DataFrame, variables: Sequence[str], vif_max: float = 10.0) -> DataFrame:
    """(series_id, variable, vif, step): the worst driver goes until all are at most ``vif_max``.

    ``step`` numbers the drops and is NULL for the drivers that stay; ``vif`` is the value at the drop, or the last one.
    """
    order = list(variables)

    def prune(pdf: pd.DataFrame) -> pd.DataFrame:
        names, r = _matrix(pdf, order)
        drops, left, values = _prune_order(r, vif_max)
        rows = [(names[c], v, i + 1) for i, (c, v) in enumerate(drops)] + [(names[c], v, None) for c, v in zip(left, values)]
        out = pd.DataFrame(rows, columns=["variable", "vif", "step"]).astype({"step": "Int64"})
        return out.assign(series_id=pdf["series_id"].iloc[0])[["series_id", "variable", "vif", "step"]]

    return pairs.groupBy("series_id").applyInPandas(prune, "series_id string, variable string, vif double, step long")


def vif_prune(pairs: DataFrame, variables: Sequence[str], vif_max: float = 10.0) -> DataFrame:
    """(series_id, variable, vif) of the drivers that stay when the worst one goes until all are at most ``vif_max``."""
    return vif_drops(pairs, variables, vif_max).filter("step IS NULL").drop("step")
