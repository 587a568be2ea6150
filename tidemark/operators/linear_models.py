"""Linear target models over all series and folds at once.

One stream of design rows feeds one cross-product pass. Three layouts cover eight
models: their blocks (mean-group windows, cross-validation slices) and their extra
regressors that are combinations of existing ones are recovered from the same sums.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import calendar_features, freq_params
from tidemark.functions.scores import log_target
from tidemark.operators import gram as G
from tidemark.operators.features import ROLLING, history_array, lag_names, make_target_features
from tidemark.operators.folds import training_rows
from tidemark.operators.recursion import explode_path, recursive_path
from tidemark.session import spread
from tidemark.settings import DEFAULTS, Settings

LAYOUT_MODELS = {
    "base": ("ols", "ccemg", "sysgmm", "mg", "amg", "elasticnet", "lasso"),
    "lagged_mean": ("dccemg",),
    "dummies": ("twfe",),
    "differenced": ("arx",),
}
LINEAR_MODELS = tuple(m for models in LAYOUT_MODELS.values() for m in models)
# Mixing ratios of the cross-validated elastic net, mean-group window rules.
L1_RATIOS = (0.1, 0.3, 0.5, 0.7, 0.9)
MG_SPLITS, MG_MIN_WINDOW = 5, 20
CV_SLICES = 5


def center_panel(panel: DataFrame, drivers: Sequence[str], folds: DataFrame) -> DataFrame:
    """Adds ``y`` (log target minus the series mean ``mu``), z-scored drivers ``z_*`` and the
    z-scored row mean ``z__mean``. Linear fits do not change under these shifts; they keep
    the cross-products well conditioned. Returns also the constants per series. They come from
    the rows that every fold trains on, so no holdout row moves a forecast."""
    # Summed by period: the order of rows does not move the last digit.
    w = Window.partitionBy("series_id").orderBy("period").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    common = folds.groupBy("series_id").agg(F.min("train_end").alias("_common"))
    mean = sum((F.col(d) for d in drivers[1:]), F.col(drivers[0])) / len(drivers) if drivers else F.lit(0.0)
    p = panel.join(common, "series_id").withColumn("_mean", mean).withColumn("_log", log_target(F.col("target")))

    def trained(c: str) -> Column:
        return F.when(F.col("period") <= F.col("_common"), F.col(c))

    consts = {"mu": F.avg(trained("_log")).over(w)}
    for d in [*drivers, "_mean"]:
        consts[f"_m_{d}"] = F.avg(trained(d)).over(w)
        consts[f"_s_{d}"] = F.stddev_pop(trained(d)).over(w)
    return _apply_center(p.withColumns(consts), drivers).withColumn("y", F.col("_log") - F.col("mu"))


def _apply_center(df: DataFrame, drivers: Sequence[str]) -> DataFrame:
    return df.withColumns({
        f"z_{d}": F.when(F.col(f"_s_{d}") > 0, (F.col(d) - F.col(f"_m_{d}")) / F.col(f"_s_{d}")).otherwise(0.0)
        for d in [*drivers, "_mean"]
    })


def center_constants(centered: DataFrame, drivers: Sequence[str]) -> DataFrame:
    cols = ["mu"] + [f"_{k}_{d}" for d in [*drivers, "_mean"] for k in "ms"]
    return centered.groupBy("series_id").agg(*[F.first(c).alias(c) for c in cols])


def center_future(future: DataFrame, constants: DataFrame, drivers: Sequence[str]) -> DataFrame:
    """The same shifts on future driver values (wide: series_id, fold, step, period, drivers)."""
    mean = sum((F.col(d) for d in drivers[1:]), F.col(drivers[0])) / len(drivers) if drivers else F.lit(0.0)
    return _apply_center(future.withColumn("_mean", mean).join(constants, "series_id"), drivers)


def _calendar_array(freq: str) -> Column:
    cols = calendar_features(F.col("period"), freq)
    return F.array(*[(c - 2000.0) / 10 if i == len(cols) - 3 else c for i, c in enumerate(cols)])


def _dummy_array(freq: str) -> Column:
    """Season dummies (first is the reference) and year dummies of the training years."""
    year = F.year("period")
    years = F.when(F.col("y1") > F.col("y0"), F.transform(
        F.sequence(F.col("y0") + 1, F.greatest(F.col("y0") + 1, F.col("y1"))), lambda v: (v == year).cast("double")))
    years = F.coalesce(years, F.array().cast("array<double>"))
    if freq == "Y":
        return years
    slot, count = (F.month("period"), 12) if freq == "M" else (F.weekofyear("period"), 53)
    return F.concat(F.array(*[(slot == i).cast("double") for i in range(2, count + 1)]), years)


def exog_array(layout: str, drivers: Sequence[str], freq: str) -> Column:
    """Regressors known ahead of time, for training and future rows alike."""
    z = F.array(*[F.col(f"z_{d}") for d in drivers]) if drivers else F.array().cast("array<double>")
    if layout == "dummies":
        return F.concat(z, _dummy_array(freq))
    if layout == "lagged_mean":
        return F.concat(z, _calendar_array(freq), F.array("z__mean", "lag_mean"))
    if layout == "differenced":
        return F.array(*[F.col(f"d_{d}") for d in drivers]) if drivers else F.array().cast("array<double>")
    return F.concat(z, _calendar_array(freq))


def fold_sizes(feats: DataFrame, folds: DataFrame) -> DataFrame:
    """(series_id, fold, n, mg_size, cv_first, cv_test): how many rows a fold trains on, and how they part."""
    rows = feats.select("series_id", "period").join(folds.select("series_id", "fold", "train_end"), "series_id")
    out = rows.groupBy("series_id", "fold").agg(F.count_if(F.col("period") <= F.col("train_end")).alias("n")).filter("n > 0")
    test = F.greatest(F.floor(F.col("n") / (CV_SLICES + 1)), F.lit(1))
    return out.withColumns({"mg_size": F.greatest(F.lit(MG_MIN_WINDOW), F.floor(F.col("n") / MG_SPLITS)), "cv_test": test,
                            "cv_first": F.col("n") - CV_SLICES * test})


def design_rows(centered: DataFrame, folds: DataFrame, drivers: Sequence[str], freq: str, layouts: Sequence[str],
                settings: Settings = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """(series_id, layout, segment, x) with y as the last entry of x, and the sizes of the folds.

    A row belongs to one stretch of time between two cuts; cuts are the ends of folds, mean-group windows and
    cross-validation slices of all folds of a series. So each row is summed once, whatever the number of folds; ``segment`` is
    the number of the stretch's first row.
    """
    season = freq_params(freq)["season"]
    w = Window.partitionBy("series_id").orderBy("period")
    zs = [f"z_{d}" for d in drivers]
    base = centered.select("series_id", "period", "y", *zs, "z__mean")
    if "differenced" in layouts:
        dy = F.col("y") - F.lag("y").over(w)
        base = base.withColumns({"dy": dy, **{f"d_{d}": F.col(f"z_{d}") - F.lag(f"z_{d}").over(w) for d in drivers}})
        base = base.withColumns({"dy_1": F.lag("dy").over(w), "dy_m": F.lag("dy", season).over(w) if season > 1 else F.lit(0.0)})
        extra = ["dy", "dy_1", "dy_m", *[f"d_{d}" for d in drivers]]
    else:
        extra = []
    feats = make_target_features(base, zs, freq, "y", settings.n_lags, keep=["z__mean", *extra])
    feats = feats.filter("y IS NOT NULL").withColumn(
        "lag_mean", F.coalesce(F.lag("z__mean").over(w), F.col("z__mean")))
    sizes = fold_sizes(feats, folds)
    cuts = sizes.groupBy("series_id").agg(F.max("n").alias("_n"), F.array_distinct(F.flatten(F.collect_list(F.concat(
        F.array("n"), F.transform(F.sequence(F.lit(0), F.floor(F.col("n") / F.col("mg_size"))), lambda k: k * F.col("mg_size")),
        F.transform(F.sequence(F.lit(0), F.lit(CV_SLICES)), lambda k: F.col("cv_first") + k * F.col("cv_test")))))).alias("_cuts"))
    rows = feats.join(cuts, "series_id").withColumn("_rn", F.row_number().over(w) - 1).filter(F.col("_rn") < F.col("_n"))
    whole = Window.partitionBy("series_id")
    rows = rows.withColumns({
        "segment": F.array_max(F.filter("_cuts", lambda c: c <= F.col("_rn"))),
        "y0": F.min(F.year("period")).over(whole), "y1": F.max(F.year("period")).over(whole),
    })
    own = F.array(*lag_names(settings.n_lags), *ROLLING)
    variants = []
    for layout in layouts:
        known = exog_array(layout, drivers, freq)
        x = (F.concat(F.array("dy_1", "dy_m"), known, F.array("dy")) if layout == "differenced"
             else F.concat(own, known, F.array("y")))
        variants.append(F.struct(F.lit(layout).alias("layout"), x.alias("x")))
    return rows.select("series_id", "segment", F.inline(F.array(*variants))), sizes


def fold_cells(sums: DataFrame, sizes: DataFrame) -> DataFrame:
    """(series_id, fold, layout, cells): the sums of every fold's stretches, with their window and slice."""
    rows = sums.join(sizes, "series_id").filter("segment < n")
    late = 1 + F.floor((F.col("segment") - F.col("cv_first")) / F.col("cv_test"))
    cell = F.struct(F.floor(F.col("segment") / F.col("mg_size")).cast("int").alias("mg_block"),
                    F.when(F.col("segment") < F.col("cv_first"), 0).otherwise(late).cast("int").alias("cv_slice"), "segment", "g")
    return rows.groupBy("series_id", "fold", "layout").agg(F.array_sort(F.collect_list(cell)).alias("cells"))


def _sum_by(labels, sums: list[np.ndarray]) -> list[np.ndarray]:
    out: dict = {}
    for label, s in zip(labels, sums):
        out[label] = out.get(label, 0) + s
    return [out[k] for k in sorted(out)]


def fit_one(model: str, mg_blocks, cv_slices, sums: list[np.ndarray], n_lags: int, n_drivers: int) -> np.ndarray:
    """Coefficients [intercept, x...] of one model from the sums of its cells."""
    total = np.sum(sums, axis=0)
    size = len(total) - 1
    first = 1 + n_lags + len(ROLLING)
    drivers = np.arange(first, first + n_drivers)
    if model in ("elasticnet", "lasso"):
        slices = _sum_by(cv_slices, sums)
        return G.unscale(G.elastic_net_cv(slices, L1_RATIOS if model == "elasticnet" else (1.0,)), total)
    if model in ("mg", "amg"):
        extra = np.zeros(size)
        if model == "amg" and n_drivers:
            mean, sd, corr = G.moments(total)
            cols = drivers - 1
            pc = np.linalg.eigh(corr[np.ix_(cols, cols)])[1][:, -1] / np.where(sd[cols] > 0, sd[cols], 1.0)
            extra[drivers] = pc
            extra[0] = -pc @ mean[cols]
        windows = [s for s in _sum_by(mg_blocks, sums) if s[0, 0] >= MG_MIN_WINDOW] or [total]
        if not extra.any():
            return np.mean([G.min_norm(s) for s in windows], axis=0)
        fits = [G.fold_back(G.min_norm(G.with_combination(s, extra)), extra) for s in windows]
        return np.mean(fits, axis=0)
    if model == "ccemg" and n_drivers:
        mean_of_drivers = np.zeros(size)
        mean_of_drivers[drivers] = 1 / n_drivers
        return G.fold_back(G.min_norm(G.with_combination(total, mean_of_drivers)), mean_of_drivers)
    if model == "sysgmm":
        # First stage: lag 1 on everything else (deeper lags are the instruments).
        others = [0, *range(2, size)]
        stage = total[np.ix_([*others, 1], [*others, 1])]
        gamma = G.min_norm(stage)
        second = total[np.ix_([*others, size], [*others, size])]
        beta = G.fold_back(G.min_norm(G.with_combination(second, gamma)), gamma)
        return np.insert(beta, 1, 0.0)
    if model == "arx":
        # No intercept: solve on the raw second moments.
        a, b = total[1:-1, 1:-1], total[1:-1, -1]
        return np.concatenate([[0.0], np.linalg.pinv(a, rcond=1e-10, hermitian=True) @ b])
    return G.min_norm(total)


_FIT = "struct<intercept:double,phi:array<double>,std_coef:array<double>,exog:array<double>,y_mean:double,y_sd:double,reason:string>"


def _fit_udf(freq: str, n_lags: int, n_drivers: int):
    p = freq_params(freq)
    short, long, season = p["roll_short"], p["roll_long"], p["season"]

    def one(name, b, c, sums):
        if not all(np.isfinite(s).all() for s in sums):
            raise ArithmeticError("the sums of its columns are not finite")
        beta = fit_one(name, b, c, sums, n_lags, n_drivers)
        if not np.isfinite(beta).all():
            raise ArithmeticError("a coefficient is not finite")
        mean, sd, _ = G.moments(np.sum(sums, axis=0))
        if name == "arx":
            phi = np.zeros(season + 1 if season > 1 else 2)
            phi[0], phi[1] = 1 + beta[1], -beta[1]
            if season > 1:
                phi[season - 1] += beta[2]
                phi[season] -= beta[2]
            # The sums are of differences, so they hold no band for levels: this path is not clipped.
            return 0.0, phi, np.zeros(2), beta[3:], 0.0, np.inf, None
        phi = np.zeros(max(n_lags, long))
        phi[:n_lags] = beta[1:n_lags + 1]
        r = beta[n_lags + 1:n_lags + 5]
        phi[:short] += r[0] / short
        phi[:long] += r[1] / long
        return beta[0], phi, r[2:4], beta[n_lags + 5:], mean[-1], sd[-1], None

    @F.pandas_udf(_FIT)
    def fit(model: pd.Series, mg: pd.Series, cv: pd.Series, grams: pd.Series) -> pd.DataFrame:
        rows = []
        for name, b, c, g in zip(model, mg, cv, grams):
            try:
                with np.errstate(all="ignore"):
                    rows.append(one(name, b, c, [G.unpack(x) for x in g]))
            except (ArithmeticError, ValueError, np.linalg.LinAlgError) as e:
                rows.append((*[None] * 6, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(rows, columns=["intercept", "phi", "std_coef", "exog", "y_mean", "y_sd", "reason"])

    return fit


def fit_linear(centered: DataFrame, folds: DataFrame, drivers: Sequence[str], freq: str,
               models: Sequence[str] = LINEAR_MODELS, settings: Settings = DEFAULTS) -> DataFrame:
    """(series_id, fold, model, layout, intercept, phi, std_coef, exog, y_mean, y_sd, reason).

    A fit that fails is a row with its reason and nothing else. Rolling means are linear in the lags, so their weights are merged into ``phi``.
    """
    layouts = [la for la, ms in LAYOUT_MODELS.items() if set(ms) & set(models)]
    design, sizes = design_rows(centered, folds, drivers, freq, layouts, settings)
    cells = spread(fold_cells(G.gram(design, ["series_id", "layout", "segment"]), sizes), "series_id", "fold", "layout")
    wanted = F.create_map(*[x for la in layouts for x in (
        F.lit(la), F.array(*[F.lit(m) for m in LAYOUT_MODELS[la] if m in models]))])
    jobs = cells.select("*", F.explode(F.element_at(wanted, F.col("layout"))).alias("model"))
    fit = _fit_udf(freq, settings.n_lags, len(drivers))
    out = jobs.withColumn("f", fit("model", F.col("cells.mg_block"), F.col("cells.cv_slice"), F.col("cells.g")))
    return out.select("series_id", "fold", "model", "layout", "f.*")


def forecast_linear(fits: DataFrame, centered: DataFrame, folds: DataFrame, future: DataFrame, drivers: Sequence[str],
                    freq: str, settings: Settings = DEFAULTS, clamp: bool = True,
                    models: Sequence[str] = LINEAR_MODELS) -> DataFrame:
    """(series_id, fold, model, step, period, yhat) in the units of the target.

    ``future`` holds the drivers of the steps to forecast: series_id, fold, step, period, drivers.
    """
    p = freq_params(freq)
    k = max(settings.n_lags, p["roll_long"], p["season"] + 1)
    fut = center_future(future, center_constants(centered, drivers), drivers).withColumn("lag_mean", F.col("z__mean"))
    train = training_rows(centered.select("series_id", "period", "y", *[f"z_{d}" for d in drivers]), folds)
    history = history_array(train, "y", k, ("series_id", "fold"))
    last = train.groupBy("series_id", "fold").agg(
        F.max_by(F.struct(F.lit(0).alias("_"), *[F.col(f"z_{d}").alias(d) for d in drivers]), "period").alias("last"))
    # Year range of the rows that have all lags, over all folds of a series, as in the design.
    ready = train.withColumn("_rn", F.row_number().over(Window.partitionBy("series_id", "fold").orderBy("period")))
    lost = max(settings.n_lags, p["roll_long"])
    years = ready.filter(F.col("_rn") > lost).groupBy("series_id").agg(
        F.min(F.year("period")).alias("y0"), F.max(F.year("period")).alias("y1"))
    w = Window.partitionBy("series_id", "fold").orderBy("step")
    fut = fut.join(years, "series_id").join(last, ["series_id", "fold"])
    fut = fut.withColumns({
        f"d_{d}": F.col(f"z_{d}") - F.coalesce(F.lag(f"z_{d}").over(w), F.col(f"last.{d}")) for d in drivers})
    layouts = [la for la, ms in LAYOUT_MODELS.items() if set(ms) & set(models)]
    steps = fut.groupBy("series_id", "fold").agg(
        F.first("mu").alias("mu"),
        F.array_sort(F.collect_list(F.struct(
            "step", "period", *[exog_array(la, drivers, freq).alias(la) for la in layouts]))).alias("steps"))
    jobs = fits.filter("phi IS NOT NULL").join(steps, ["series_id", "fold"]).join(history, ["series_id", "fold"])
    rows = F.element_at(F.create_map(*[x for la in layouts for x in (F.lit(la), F.col("steps")[la])]), F.col("layout"))

    def effect(known: Column) -> Column:
        return F.aggregate(F.zip_with(known, F.col("exog"), lambda a, b: a * b), F.col("intercept"), lambda a, v: a + v)

    reach = settings.clamp_sigmas * F.greatest("y_sd", F.lit(1e-6))
    lo, hi = (F.col("y_mean") - reach, F.col("y_mean") + reach) if clamp else (None, None)
    std = [(F.col("std_coef")[0], p["roll_short"]), (F.col("std_coef")[1], p["roll_long"])]
    path = recursive_path("history", "phi", F.transform(rows, effect), lo, hi, std)
    out = jobs.select("series_id", "fold", "model", "mu", F.col("steps.period").alias("periods"), path.alias("path"))
    flat = explode_path(out, "path", ["series_id", "fold", "model", "mu"])
    return flat.select("series_id", "fold", "model", "step", "period", F.exp(F.col("yhat") + F.col("mu")).alias("yhat"))
