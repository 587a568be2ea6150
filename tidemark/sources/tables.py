"""Readers: wide series tables, and panels aggregated from transactional tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.calendar import period_start
from tidemark.functions.text import clean_name, clean_value

# The driver columns that panel_from_facts produces.
FACT_DRIVERS = (
    "n_orders", "n_customers", "mean_acctbal", "share_filled", "sum_qty", "mean_qty",
    "mean_discount", "mean_tax", "mean_price", "share_returned",
)


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def wide_series(raw: DataFrame, date_col: str, target_col: str, tiebreak: str,
                series: str | None = None) -> DataFrame:
    """Date + target + driver columns as (series_id, ts, target, drivers); first row per timestamp.

    Duplicates are resolved by an aggregate, so a timestamp with very many rows is
    reduced on the map side and never gathered in one window partition.
    """
    names = {c: c.strip() for c in raw.columns}
    raw = raw.withColumnsRenamed(names)
    for needed in (date_col, target_col, tiebreak):
        if needed not in raw.columns:
            raise ValueError(f"column {needed!r} not found")
    if target_col != "target" and "target" in raw.columns:
        raise ValueError("a driver column is already called 'target'")
    series = series or ("series_id" if "series_id" in raw.columns else None)
    drivers = [c for c in raw.columns if c not in (date_col, target_col, tiebreak, series)]
    named = raw.select(
        (F.col(series) if series else F.lit("Sample Series")).cast("string").alias("series_id"),
        F.col(date_col).cast("timestamp_ntz").alias("ts"),
        F.col(tiebreak).alias("_order"),
        F.col(target_col).cast("double").alias("target"),
        *[F.col(c).cast("double").alias(c) for c in drivers],
    )
    first = F.min_by(F.struct("target", *drivers), F.col("_order"))
    return named.groupBy("series_id", "ts").agg(first.alias("r")).select("series_id", "ts", "r.*")


def read_wide_series(spark: SparkSession, path: str, date_col: str, target_col: str, tiebreak: str,
                     fmt: str = "parquet", **kwargs) -> DataFrame:
    """Read a wide table (Parquet or CSV) as series rows."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", True)
    return wide_series(reader.load(path), date_col, target_col, tiebreak, **kwargs)


def panel_from_facts(spark: SparkSession, folder: str, keys: Sequence[str] = ("c_mktsegment",), freq: str = "M",
                     until: str | None = None) -> DataFrame:
    """Wide panel (series_id, period, target, drivers) from orders, line items and customers.

    Line items are summed per order before the join, so the large join carries one row
    per order; series with a dominant share of the orders are reduced on the map side.
    Money and quantity sums are rounded back to the two decimals of their inputs, which
    makes every value independent of the order of addition.
    """
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    if until:
        orders = orders.filter(F.col("o_orderdate") < F.lit(until).cast("timestamp_ntz"))
    items = (
        load(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.sum("l_quantity").alias("qty"),
            F.sum("l_discount").alias("discount"),
            F.sum("l_tax").alias("tax"),
            F.sum("l_extendedprice").alias("price"),
            F.count_if(F.col("l_returnflag") == "R").alias("returned"),
            F.count(F.lit(1)).alias("n_items"),
        )
    )
    customers = load(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", *keys)
    rows = orders.join(items, "o_orderkey", "left").join(customers, "o_custkey")
    series = F.concat_ws("-", *[F.col(k).cast("string") for k in keys])
    rows = rows.select(series.alias("series_id"), period_start(F.col("o_orderdate"), freq).alias("period"),
                       "o_custkey", "o_totalprice", "o_orderstatus", "c_acctbal",
                       "qty", "discount", "tax", "price", "returned", "n_items")

    def cents(name: str) -> Column:
        return F.round(F.sum(name), 2)

    # Two steps instead of count(distinct): the customer level spreads a dominant series over
    # all tasks and keeps one partial row per customer and period.
    per_customer = rows.groupBy("series_id", "period", "o_custkey").agg(
        cents("o_totalprice").alias("total"),
        F.count(F.lit(1)).alias("orders"),
        cents("c_acctbal").alias("balance"),
        F.count_if(F.col("o_orderstatus") == "F").alias("filled"),
        cents("qty").alias("qty"), cents("discount").alias("discount"), cents("tax").alias("tax"),
        cents("price").alias("price"), F.sum("returned").alias("returned"), F.sum("n_items").alias("items"),
    )
    items_n, orders_n = F.sum("items"), F.sum("orders")
    return per_customer.groupBy("series_id", "period").agg(
        cents("total").alias("target"),
        orders_n.cast("double").alias("n_orders"),
        F.count(F.lit(1)).cast("double").alias("n_customers"),
        (cents("balance") / orders_n).alias("mean_acctbal"),
        (F.sum("filled") / orders_n).alias("share_filled"),
        cents("qty").alias("sum_qty"),
        (cents("qty") / items_n).alias("mean_qty"),
        (cents("discount") / items_n).alias("mean_discount"),
        (cents("tax") / items_n).alias("mean_tax"),
        (cents("price") / items_n).alias("mean_price"),
        (F.sum("returned") / items_n).alias("share_returned"),
    )


def event_series(spark: SparkSession, folder: str) -> DataFrame:
    """The event stream table as raw (series_id, ts, order, value) rows."""
    return load(spark, folder, "events").select(
        F.col("event_type").alias("series_id"), "ts", F.col("event_id").alias("order"), "value")


def read_selected_features(spark: SparkSession, path: str) -> DataFrame:
    """Step-1 output: one cleaned driver name per (series_id, variable)."""
    return spark.read.parquet(path).withColumn("variable", clean_value(F.col("variable")))


def select_variables(panel: DataFrame, selected: Sequence[str], fixed: Sequence[str] = ("series_id", "period", "target")
                     ) -> DataFrame:
    """Keep the chosen driver columns, in the order of the table; both sides are cleaned first."""
    wanted = {clean_name(s) for s in selected}
    return panel.select(*[c for c in panel.columns if c in fixed or clean_name(c) in wanted])


def read_weights(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("series_id", "variable", "model", "weight")


def read_selected_models(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).orderBy("series_id", "model_rank")
