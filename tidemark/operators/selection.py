"""Driver screening: missing share, correlation, redundancy, information and composite score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.settings import DEFAULTS, Settings

KEYS = ("series_id", "variable")


def missing_fraction(long: DataFrame) -> DataFrame:
    return long.groupBy(*KEYS).agg(F.avg(F.col("value").isNull().cast("double")).alias("missing_fraction"))


def drop_high_missing(long: DataFrame, threshold: float = 0.25) -> tuple[DataFrame, DataFrame]:
    """Rows of the drivers whose missing share is at most the threshold, and the full report."""
    report = missing_fraction(long).withColumn("dropped", F.col("missing_fraction") * 100 > threshold * 100)
    kept = long.join(report.filter("NOT dropped").select(*KEYS), list(KEYS), "left_semi")
    return kept, report


def corr_with_target(long: DataFrame, target: DataFrame, threshold: float = 0.2) -> DataFrame:
    """Pearson correlation over complete pairs; a missing correlation is neither kept nor rejected."""
    pairs = long.join(target.select("series_id", "period", "target"), ["series_id", "period"])
    return _corr_report(pairs.groupBy(*KEYS).agg(_corr("value", "target").alias("corr")), threshold)


def corr_with_target_wide(panel: DataFrame, variables: Sequence[str], threshold: float = 0.2) -> DataFrame:
    """The same from the wide panel: one partial aggregate per series, no unpivot of the rows."""
    corrs = panel.groupBy("series_id").agg(*[_corr(v, "target").alias(v) for v in variables])
    return _corr_report(corrs.unpivot("series_id", list(variables), "variable", "corr"), threshold)


def _corr(a: str, b: str) -> Column:
    """Pearson correlation over complete pairs; NULL, not an error, where either side has no variance."""
    x, y = (F.when(F.col(other).isNotNull(), F.col(c)) for c, other in ((a, b), (b, a)))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(x) * F.stddev_pop(y))


def _corr_report(corrs: DataFrame, threshold: float) -> DataFrame:
    r = F.nanvl("corr", F.lit(None).cast("double"))
    return corrs.withColumn("corr", r).withColumn("corr_value", F.round("corr", 3)).withColumn(
        "corr_abs", F.abs("corr")).withColumn("keep", F.col("corr_abs") >= threshold)


def standardize(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """Population z-scores; a constant column becomes zero."""
    w = Window.partitionBy(*keys)

    def z(c: str) -> Column:
        sd = F.stddev_pop(c).over(w)
        return F.when(sd > 0, (F.col(c) - F.avg(c).over(w)) / sd).otherwise(F.lit(0.0)).alias(c)

    return df.select(*[z(c) if c in set(columns) else F.col(c) for c in df.columns])


def corr_matrix(panel: DataFrame, variables: Sequence[str]) -> DataFrame:
    """(series_id, a, b, corr) for a <= b, from the Gram sums of the z-scores."""
    from tidemark.operators.gram import gram_entries

    z = standardize(panel, variables)
    entries = gram_entries(z.select("series_id", F.array(*variables).alias("x")), ["series_id"])
    names = F.array(*[F.lit(v) for v in variables])
    n = F.max(F.when((F.col("i") == 0) & (F.col("j") == 0), F.col("s"))).over(Window.partitionBy("series_id"))
    return entries.withColumn("n", n).filter("i > 0").select(
        "series_id", F.element_at(names, F.col("i")).alias("a"), F.element_at(names, F.col("j")).alias("b"),
        (F.col("s") / F.col("n")).alias("corr"))


def mutual_information(long: DataFrame, target: DataFrame, bins: int = 5) -> DataFrame:
    """Information (nats) between equal-count bins of each driver and of the target."""
    pairs = long.join(target.select("series_id", "period", "target"), ["series_id", "period"]).filter(
        "value IS NOT NULL AND target IS NOT NULL")
    w = Window.partitionBy(*KEYS)
    binned = pairs.withColumn("bx", F.ntile(bins).over(w.orderBy("value", "period"))).withColumn(
        "by", F.ntile(bins).over(w.orderBy("target", "period")))
    cells = binned.groupBy(*KEYS, "bx", "by").agg(F.count(F.lit(1)).cast("double").alias("n"))
    joint = cells.withColumns({
        "nx": F.sum("n").over(Window.partitionBy(*KEYS, "bx")),
        "ny": F.sum("n").over(Window.partitionBy(*KEYS, "by")),
        "total": F.sum("n").over(w),
    })
    term = F.col("n") / F.col("total") * F.ln(F.col("n") * F.col("total") / (F.col("nx") * F.col("ny")))
    return joint.groupBy(*KEYS).agg(F.sum(term).alias("score"))


def normalize_importance(scores: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Scores over their maximum in [0, 1]; unknown names score 0, a useless maximum zeroes all."""
    if names is not None:
        scores = names.select(*KEYS).join(scores, list(KEYS), "left")
    s = F.coalesce(F.nanvl("score", F.lit(None).cast("double")), F.lit(0.0))
    top = F.max(s).over(Window.partitionBy("series_id"))
    return scores.withColumn("score", F.when((top > 0) & (top < float("inf")), s / top).otherwise(0.0))


def align_scores(names: DataFrame, **scores: DataFrame) -> DataFrame:
    """Left join of several score tables to one list of names; missing scores are 0."""
    out = names.select(*KEYS)
    for label, table in scores.items():
        out = out.join(table.select(*KEYS, F.col("score").alias(label)), list(KEYS), "left")
    return out.withColumns({k: F.coalesce(F.col(k), F.lit(0.0)) for k in scores})


def composite_score(aligned: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Weighted sum of the four normalised importances (columns corr, mi, elasticnet, tree)."""
    w = Window.partitionBy("series_id")

    def norm(c: str) -> Column:
        s = F.coalesce(F.col(c), F.lit(0.0))
        top = F.max(s).over(w)
        return F.when((top > 0) & (top < float("inf")), s / top).otherwise(0.0)

    total = (
        settings.weight_corr * norm("corr") + settings.weight_mi * norm("mi")
        + settings.weight_elasticnet * norm("elasticnet") + settings.weight_tree * norm("tree")
    )
    return aligned.withColumn("composite", total)


def threshold_or_topk(scores: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Rows at or above the threshold when there are enough of them, else the best few."""
    w = Window.partitionBy("series_id")
    enough = F.count_if(F.col("composite") >= settings.min_composite).over(w) >= settings.min_selected
    ranked = scores.withColumn("rank", F.row_number().over(w.orderBy(F.desc("composite"), "variable")).cast("bigint"))
    keep = F.when(enough, F.col("composite") >= settings.min_composite).otherwise(F.col("rank") <= settings.min_selected)
    return ranked.withColumn("_keep", keep).filter("_keep").drop("_keep")


def selection_report(selected: DataFrame, corr: DataFrame, vif: DataFrame) -> DataFrame:
    """Selected drivers with their correlation and VIF (left joins by name)."""
    return selected.join(corr.select(*KEYS, "corr_value"), list(KEYS), "left").join(
        vif.select(*KEYS, "vif"), list(KEYS), "left")
