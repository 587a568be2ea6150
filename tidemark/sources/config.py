"""Per-series job parameters from a CSV file: one row per series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The column names of the parameter file.
REQUIRED = (
    "Input_File_Name", "Target_Column_Name", "Date_Column_Name", "Frequency",
    "Minimum_Observations", "Model_Selection_Period", "Forecasting_Period",
)
_COUNTS = {"Minimum_Observations": "min_obs", "Model_Selection_Period": "holdout", "Forecasting_Period": "horizon"}


def config_problems() -> Column:
    """Names of the rules a parameter row breaks (empty array when it is fine)."""
    checks = [F.when(~F.col("freq").isin("M", "W", "Y") | F.col("freq").isNull(), F.lit("frequency"))]
    for name in _COUNTS.values():
        checks.append(F.when(F.col(name).isNull() | (F.col(name) <= 0), F.lit(name)))
    return F.array_compact(F.array(*checks))


def validate_config(raw: DataFrame) -> DataFrame:
    """Trimmed, typed parameters with a ``problems`` array per row."""
    named = raw.withColumnsRenamed({c: c.replace("﻿", "").strip() for c in raw.columns})
    missing = [c for c in REQUIRED if c not in named.columns]
    if missing:
        raise ValueError(f"parameter table lacks columns: {missing}")
    series = F.col("Series_Name") if "Series_Name" in named.columns else F.lit(None)
    typed = named.select(
        F.coalesce(series.cast("string"), F.lit("Sample Series")).alias("series_id"),
        F.col("Input_File_Name").cast("string").alias("input"),
        F.trim("Target_Column_Name").alias("target_column"),
        F.trim("Date_Column_Name").alias("date_column"),
        F.upper(F.trim(F.col("Frequency").cast("string"))).alias("freq"),
        *[F.expr(f"try_cast({old} AS int)").alias(new) for old, new in _COUNTS.items()],
    )
    return typed.withColumn("problems", config_problems())


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """Read and check the parameter file; raises when it is empty or any row breaks a rule."""
    raw = spark.read.csv(path, header=True, inferSchema=False, encoding="UTF-8")
    configs = validate_config(raw)
    first = configs.orderBy(F.size("problems").desc()).limit(1).collect()
    if not first:
        raise ValueError("parameter file has no rows")
    if first[0]["problems"]:
        raise ValueError(f"series {first[0]['series_id']!r} breaks rules {list(first[0]['problems'])}")
    return configs.drop("problems")
