"""Rolling-origin folds as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.settings import DEFAULTS, Settings


def sufficiency(panel: DataFrame, horizon: int, settings: Settings = DEFAULTS) -> DataFrame:
    """Rows, possible folds and whether a series is long enough for a backtest."""
    need = settings.n_lags + settings.train_buffer
    n = F.count(F.lit(1))
    folds = F.least(F.lit(settings.max_folds), F.floor((n - need) / horizon)).cast("bigint")
    return panel.groupBy("series_id").agg(
        n.alias("n_rows"), F.greatest(folds, F.lit(0)).alias("n_folds"),
        ((n > horizon + need) & (folds >= 1)).alias("sufficient"),
    )


def fold_index(panel: DataFrame, horizon: int, settings: Settings = DEFAULTS) -> DataFrame:
    """Adds ``fold`` (1 = oldest holdout; NULL for rows before every holdout) and ``n_folds``."""
    need = settings.n_lags + settings.train_buffer
    w = Window.partitionBy("series_id")
    n = F.count(F.lit(1)).over(w)
    block = F.floor((F.row_number().over(w.orderBy(F.desc("period"))) - 1) / horizon)
    possible = F.least(F.lit(settings.max_folds), F.floor((n - need) / horizon))
    n_folds = F.when(n > horizon + need, possible).otherwise(F.lit(0)).cast("bigint")
    return panel.withColumn("n_folds", n_folds).withColumn(
        "fold", F.when(block < F.col("n_folds"), F.col("n_folds") - block).cast("bigint"))


def make_folds(panel: DataFrame, horizon: int, settings: Settings = DEFAULTS) -> DataFrame:
    """(series_id, fold, n_folds, train_start, train_end, holdout_start, holdout_end)."""
    w = Window.partitionBy("series_id").orderBy("period")
    rows = fold_index(panel.select("series_id", "period"), horizon, settings)
    rows = rows.withColumn("before", F.lag("period").over(w)).withColumn(
        "train_start", F.min("period").over(Window.partitionBy("series_id")))
    return rows.filter("fold IS NOT NULL").groupBy("series_id", "fold").agg(
        F.first("n_folds").alias("n_folds"),
        F.first("train_start").alias("train_start"),
        F.min_by("before", "period").alias("train_end"),
        F.min("period").alias("holdout_start"),
        F.max("period").alias("holdout_end"),
    )


def final_fold(panel: DataFrame) -> DataFrame:
    """One fold 0 per series that trains on the whole history, for the future forecast."""
    return panel.groupBy("series_id").agg(
        F.lit(0).cast("bigint").alias("fold"), F.lit(1).cast("bigint").alias("n_folds"),
        F.min("period").alias("train_start"), F.max("period").alias("train_end"))


def training_rows(panel: DataFrame, folds: DataFrame) -> DataFrame:
    """Every row once per fold whose training slice holds it."""
    ends = folds.select("series_id", "fold", "train_end")
    return panel.join(ends, "series_id").filter("period <= train_end").drop("train_end")


def holdout_rows(panel: DataFrame, folds: DataFrame) -> DataFrame:
    """Rows of each holdout with their step 1..h."""
    spans = folds.select("series_id", "fold", "holdout_start", "holdout_end")
    rows = panel.join(spans, "series_id").filter("period BETWEEN holdout_start AND holdout_end")
    w = Window.partitionBy("series_id", "fold").orderBy("period")
    return rows.withColumn("step", F.row_number().over(w).cast("bigint")).drop("holdout_start", "holdout_end")


def train_holdout(panel: DataFrame, folds: DataFrame) -> DataFrame:
    """Every row x fold with its role; rows after the holdout are left out."""
    spans = folds.select("series_id", "fold", "train_end", "holdout_end")
    role = F.when(F.col("period") <= F.col("train_end"), "train").otherwise("holdout")
    return panel.join(spans, "series_id").filter("period <= holdout_end").withColumn("role", role).drop(
        "train_end", "holdout_end")


def last_train_values(panel: DataFrame, folds: DataFrame, value: str = "target") -> DataFrame:
    return training_rows(panel.select("series_id", "period", value), folds).groupBy("series_id", "fold").agg(
        F.max_by(value, "period").alias("last_train"))
