"""How often to difference a path: seasonal strength decides one seasonal difference, the KPSS test the plain ones.

Both statistics are running sums over windows of a path's rows, so they need no Python. Critical values are fixed: a season is
differenced away when it explains more than SEASON_STRENGTH of the detrended variance; a path counts as level-stationary when its
KPSS statistic is at most KPSS_CRITICAL (5 %).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KPSS_CRITICAL = 0.463
SEASON_STRENGTH = 0.64
# The Bartlett window of a path of n values has trunc(3 sqrt(n) / 13) lags; thirty years of weeks have nine.
MOST_LAGS = 9


def seasonal_strength(rows: DataFrame, keys: Sequence[str], m: int, order: str = "period", value: str = "value") -> DataFrame:
    """(keys, strength): share of the detrended variance that the mean season explains; NULL without two full seasons.

    The trend is a centred moving average over one season, ends halved.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    half = m // 2
    inner = F.sum(value).over(w.rowsBetween(-(half - 1), half - 1) if m % 2 == 0 else w.rowsBetween(-half, half))
    ends = (F.lag(value, half).over(w) + F.lead(value, half).over(w)) / 2 if m % 2 == 0 else F.lag(value, half).over(w) * 0
    known = rows.filter(F.col(value).isNotNull())
    out = known.withColumns({"_d": F.col(value) - (inner + ends) / m, "_slot": F.pmod(F.row_number().over(w), F.lit(m)),
                             "_far": F.lead(value, half).over(w)})
    out = out.filter("_d IS NOT NULL AND _far IS NOT NULL")
    out = out.withColumn("_r", F.col("_d") - F.avg("_d").over(Window.partitionBy(*keys, "_slot")))
    strength = F.greatest(1 - F.var_pop("_r") / F.nullif(F.var_pop("_d"), F.lit(0.0)), F.lit(0.0))
    found = out.groupBy(*keys).agg(F.when(F.count_distinct("_slot") == m, strength).alias("strength"))
    return known.select(*keys).distinct().join(found, list(keys), "left")


def kpss(rows: DataFrame, keys: Sequence[str], order: str = "period", value: str = "value") -> DataFrame:
    """(keys, n, kpss): the level-stationarity statistic, with Bartlett weights; zero for a constant path."""
    w, whole = Window.partitionBy(*keys).orderBy(order), Window.partitionBy(*keys)
    e = rows.filter(F.col(value).isNotNull()).withColumn("_e", F.col(value) - F.avg(value).over(whole))
    e = e.withColumns({"_s": F.sum("_e").over(w.rowsBetween(Window.unboundedPreceding, 0)),
                       **{f"_c{k}": F.col("_e") * F.lag("_e", k).over(w) for k in range(1, MOST_LAGS + 1)}})
    n = F.count(F.lit(1))
    lags = F.floor(3 * F.sqrt(n) / 13)

    def weighted(k: int) -> Column:
        return F.when(lags >= k, (1 - k / (lags + 1)) * F.coalesce(F.sum(f"_c{k}"), F.lit(0.0))).otherwise(0.0)

    spread = F.sum(F.col("_e") * F.col("_e"))
    long_run = (spread + 2 * sum((weighted(k) for k in range(2, MOST_LAGS + 1)), weighted(1))) / n
    stat = F.sum(F.col("_s") * F.col("_s")) / (n * n * long_run)
    # A path that does not move leaves rounding errors only.
    still = F.max(F.abs("_e")) <= 1e-9 * (1 + F.max(F.abs(value)))
    return e.groupBy(*keys).agg(n.alias("n"), F.when(still, 0.0).otherwise(stat).alias("kpss"))


def differencing(rows: DataFrame, keys: Sequence[str], m: int, max_d: int = 2, order: str = "period", value: str = "value") -> DataFrame:
    """(keys, strength, seasonal_d, kpss, d): first the season, then the least order that the KPSS test accepts.

    ``kpss`` holds the statistics for 0 to ``max_d`` differences. ``d`` is ``max_d`` if none is accepted.
    """
    keys = list(keys)
    known = rows.filter(F.col(value).isNotNull()).select(*keys, order, F.col(value).alias("_v"))
    strength = (seasonal_strength(known, keys, m, order, "_v") if m > 1
                else known.select(*keys).distinct().withColumn("strength", F.lit(None).cast("double")))
    strength = strength.withColumn("seasonal_d", F.coalesce((F.col("strength") > SEASON_STRENGTH).cast("int"), F.lit(0)))
    w = Window.partitionBy(*keys).orderBy(order)
    out = known.join(strength, keys).withColumn("_0", F.when(F.col("seasonal_d") == 1, F.col("_v") - F.lag("_v", m).over(w)).otherwise(F.col("_v")))
    for d in range(1, max_d + 1):
        out = out.withColumn(f"_{d}", F.col(f"_{d - 1}") - F.lag(f"_{d - 1}").over(w))
    each = out.select(*keys, order, F.posexplode(F.array(*[f"_{d}" for d in range(max_d + 1)])).alias("_order", "_w"))
    stats = kpss(each, [*keys, "_order"], order, "_w")
    found = stats.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("_order", "kpss"))).getField("kpss").alias("kpss"),
        F.coalesce(F.min(F.when(F.col("kpss") <= KPSS_CRITICAL, F.col("_order"))), F.lit(max_d)).cast("int").alias("d"))
    return strength.join(found, keys)
