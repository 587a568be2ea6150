"""Filling of gaps along time, for any number of columns in one sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _specs(keys: Sequence[str], ts: str):
    w = Window.partitionBy(*keys).orderBy(ts)
    return w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)


def ffill(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("series_id",), ts: str = "period") -> DataFrame:
    before, _ = _specs(keys, ts)
    return df.withColumns({c: F.last(c, True).over(before) for c in columns})


def bfill(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("series_id",), ts: str = "period") -> DataFrame:
    _, after = _specs(keys, ts)
    return df.withColumns({c: F.first(c, True).over(after) for c in columns})


def time_interpolate(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("series_id",), ts: str = "period"
                     ) -> DataFrame:
    """Linear in elapsed time between neighbours; ends take the nearest known value."""
    before, after = _specs(keys, ts)

    def point(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(F.unix_date(F.col(ts).cast("date")).alias("t"), F.col(c).alias("v")))

    around = {}
    for c in columns:
        around[f"_l_{c}"] = F.last(point(c), True).over(before)
        around[f"_r_{c}"] = F.first(point(c), True).over(after)
    now = F.unix_date(F.col(ts).cast("date"))

    def filled(c: str) -> Column:
        lv, lt = F.col(f"_l_{c}.v"), F.col(f"_l_{c}.t")
        rv, rt = F.col(f"_r_{c}.v"), F.col(f"_r_{c}.t")
        between = lv + (rv - lv) * ((now - lt) / (rt - lt))
        return F.coalesce(F.col(c), F.when(lv.isNull(), rv).when(rv.isNull(), lv).otherwise(between)).alias(c)

    wide = df.withColumns(around)
    return wide.select(*[filled(c) if c in set(columns) else F.col(c) for c in df.columns])
