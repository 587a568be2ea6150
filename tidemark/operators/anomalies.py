"""Comparison of driver futures with their history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scores import risk_label
from tidemark.settings import DEFAULTS, Settings

KEYS = ("series_id", "variable")


def path_stats(long: DataFrame, prefix: str) -> DataFrame:
    """Mean, population deviation, range, first and last known value of each driver."""
    known = long.filter("value IS NOT NULL")
    return known.groupBy(*KEYS).agg(
        F.avg("value").alias(f"{prefix}_mean"), F.stddev_pop("value").alias(f"{prefix}_std"),
        F.min("value").alias(f"{prefix}_min"), F.max("value").alias(f"{prefix}_max"),
        F.min_by("value", "period").alias(f"{prefix}_first"), F.max_by("value", "period").alias(f"{prefix}_last"),
        F.count(F.lit(1)).alias(f"{prefix}_n"),
    )


def driver_anomalies(hist: DataFrame, future: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Range, jump and flatness flags with a 0-100 risk score per driver."""
    h = path_stats(hist, "hist").drop("hist_first", "hist_n")
    margin = settings.range_margin * (F.col("hist_max") - F.col("hist_min"))
    bounds = h.select(*KEYS, (F.col("hist_min") - margin).alias("_lo"), (F.col("hist_max") + margin).alias("_hi"))
    outside = (F.col("value") < F.col("_lo")) | (F.col("value") > F.col("_hi"))
    out = future.filter("value IS NOT NULL").join(bounds, list(KEYS)).groupBy(*KEYS).agg(
        F.count_if(outside).alias("n_future_out_of_hist_range"))
    both = h.join(path_stats(future, "future").drop("future_last"), list(KEYS)).join(out, list(KEYS))
    jump = (F.col("future_first") - F.col("hist_last")) / F.greatest(F.abs("hist_last"), F.lit(1e-9))
    flat = F.when(F.col("hist_std") > 0, F.col("future_std") < settings.flat_ratio * F.col("hist_std")).otherwise(
        F.col("future_std") == 0)

    def points(flag: str, worth: int) -> Column:
        return F.when(F.col(flag), float(worth)).otherwise(0.0)

    return (
        both.withColumn("rel_jump_first_future_vs_last_hist", jump)
        .withColumn("flag_out_of_range", F.col("n_future_out_of_hist_range") > 0)
        .withColumn("flag_large_jump", F.abs("rel_jump_first_future_vs_last_hist") > settings.jump_ratio)
        .withColumn("flag_flat", flat)
        .withColumn("risk_score", points("flag_out_of_range", 40) + points("flag_large_jump", 40) + points("flag_flat", 20))
        .withColumnRenamed("future_n", "n_future_points")
        .drop("future_first", "hist_last")
    )


def series_risk(report: DataFrame) -> DataFrame:
    """Mean risk over the drivers of a series, with its label."""
    return report.groupBy("series_id").agg(F.avg("risk_score").alias("risk_score")).withColumn(
        "risk_label", risk_label(F.col("risk_score")))
