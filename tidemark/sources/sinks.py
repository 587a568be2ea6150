"""Writers of the three jobs: Parquet hand-over tables, three-decimal CSV, JSON and text.

Tables that collect several runs are keyed: writing a run again, or some of its series, replaces what that run wrote
for them, and everything else stays. So a job that is retried leaves each row once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Hand-over table between jobs."""
    df.write.mode(mode).parquet(path)
    return path


def three_decimals(df: DataFrame) -> DataFrame:
    """Doubles as plain three-decimal text, the format of the score files."""
    out = [F.when(F.col(c).isNotNull(), F.format_string("%.3f", F.col(c))).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return df.select(*out)


def write_csv(df: DataFrame, path: str, rounded: bool = True, mode: str = "overwrite") -> str:
    (three_decimals(df) if rounded else df).write.mode(mode).option("header", True).csv(path)
    return path


def write_run(df: DataFrame, path: str, run_id: str, by_series: bool = False, csv: bool = False) -> str:
    """The rows of one run beside those of others, one folder per run (and per series, where single series are rewritten)."""
    keys = ["run_id", "series_id"] if by_series else ["run_id"]
    # A folder is written by as many tasks as its rows need, not by all.
    rows = df.withColumn("run_id", F.lit(run_id)).repartition(*keys) if by_series else df.withColumn("run_id", F.lit(run_id))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys)
    writer.option("header", True).csv(path) if csv else writer.parquet(path)
    return path


def write_keyed(df: DataFrame, path: str, run_id: str | None) -> str:
    """A hand-over table: of the run alone, or beside other runs."""
    return write_table(df, path) if run_id is None else write_run(df, path, run_id)


def read_run(spark: SparkSession, path: str, schema: StructType, run_id: str | None = None, csv: bool = False) -> DataFrame:
    """What ``write_run`` wrote, with the types of ``schema`` and the run's name; of one run or of all."""
    whole = StructType([*schema.fields, *([] if "run_id" in schema.names else [StructField("run_id", StringType())])])
    reader = spark.read.schema(whole)
    rows = reader.option("header", True).csv(path) if csv else reader.parquet(path)
    return rows if run_id is None else rows.filter(F.col("run_id") == run_id)


def write_scores(scores: DataFrame, path: str, run_id: str | None = None) -> str:
    """One CSV folder per ranking method; with a run's name, one folder per run and series in it."""
    rows = scores.select("series_id", "variable", "score")
    return write_csv(rows, path) if run_id is None else write_run(three_decimals(rows), path, run_id, by_series=True, csv=True)


def summary_document(panel_shape: DataFrame, dropped: DataFrame, selected: DataFrame, settings) -> DataFrame:
    """One nested row per series: size, thresholds, dropped and selected names."""
    gone = dropped.groupBy("series_id").agg(F.array_sort(F.collect_list("variable")).alias("dropped_columns"))
    kept = selected.groupBy("series_id").agg(
        F.array_sort(F.collect_list("variable")).alias("selected_features"),
        F.count(F.lit(1)).alias("num_selected_features"),
    )
    none = F.array().cast("array<string>")
    return (
        panel_shape.join(gone, "series_id", "left").join(kept, "series_id", "left")
        .withColumn("dropped_columns", F.coalesce("dropped_columns", none))
        .withColumn("selected_features", F.coalesce("selected_features", none))
        .withColumn("num_selected_features", F.coalesce("num_selected_features", F.lit(0)))
        .withColumn("column_missing_threshold", F.lit(settings.max_missing))
        .withColumn("corr_threshold", F.lit(settings.min_correlation))
        .withColumn("vif_threshold", F.lit(settings.max_vif))
        .withColumn("composite_score_min_threshold", F.lit(settings.min_composite))
    )


def write_summary_json(document: DataFrame, path: str) -> str:
    document.write.mode("overwrite").json(path)
    return path


def append_risk_summary(risk: DataFrame, path: str, run_id: str) -> str:
    """This run's series risk rows; earlier runs stay, and the same run written again replaces itself."""
    return write_run(risk, path, run_id)
