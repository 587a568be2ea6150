"""Panel hygiene: one row per period, spines, coverage, trimming and validation.

Every operator that sees raw rows aggregates them; windows run only over
(series, period)-unique rows, whose group size is the length of the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import period_range, period_start, period_add


def dedupe(df: DataFrame, keys: Sequence[str], order: str, keep: str = "first") -> DataFrame:
    """Keep the first or last row of every key by an explicit order column."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by if keep == "first" else F.max_by
    return df.groupBy(*keys).agg(pick(F.struct(*rest), F.col(order)).alias("r")).select(*keys, "r.*")


def resample_last(df: DataFrame, freq: str, values: Sequence[str], ts: str = "ts", tiebreak: str | None = None,
                  keys: Sequence[str] = ("series_id",)) -> DataFrame:
    """One row per period holding, per column, the last non-null value."""
    def last_known(c: str):
        known = F.col(c).isNotNull()
        order = F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.col(ts)
        return F.max_by(F.col(c), F.when(known, order)).alias(c)

    return df.groupBy(*keys, period_start(F.col(ts), freq).alias("period")).agg(*[last_known(c) for c in values])


def to_long(panel: DataFrame, variables: Sequence[str], keys: Sequence[str] = ("series_id", "period")) -> DataFrame:
    return panel.unpivot(list(keys), list(variables), "variable", "value")


def to_wide(long: DataFrame, variables: Sequence[str], keys: Sequence[str] = ("series_id", "period")) -> DataFrame:
    cols = [F.max(F.when(F.col("variable") == v, F.col("value"))).alias(v) for v in variables]
    return long.groupBy(*keys).agg(*cols)


def count_distinct_periods(df: DataFrame, freq: str, ts: str = "ts") -> DataFrame:
    """Distinct periods per series; a dominant series is spread over its periods first."""
    seen = df.select("series_id", period_start(F.col(ts), freq).alias("period")).distinct()
    return seen.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_periods"))


def period_spine(df: DataFrame, freq: str) -> DataFrame:
    """Every period from the first to the last of each series."""
    ends = df.groupBy("series_id").agg(F.min("period").alias("a"), F.max("period").alias("b"))
    return ends.select("series_id", F.explode(period_range(F.col("a"), F.col("b"), freq)).alias("period"))


def future_spine(df: DataFrame, freq: str, horizon: int) -> DataFrame:
    """The next ``horizon`` periods of each series with their step number."""
    ends = df.groupBy("series_id").agg(F.max("period").alias("b"))
    steps = period_range(period_add(F.col("b"), 1, freq), period_add(F.col("b"), horizon, freq), freq)
    return ends.select("series_id", F.posexplode(steps).alias("step", "period")).withColumn(
        "step", (F.col("step") + 1).cast("bigint"))


def reindex_to_spine(df: DataFrame, freq: str) -> DataFrame:
    """Add the missing periods as rows of NULL."""
    return period_spine(df, freq).join(df, ["series_id", "period"], "left")


def missing_periods(df: DataFrame, freq: str) -> DataFrame:
    """Expected periods that have no row."""
    return period_spine(df, freq).join(df.select("series_id", "period").distinct(), ["series_id", "period"], "left_anti")


def year_coverage(panel: DataFrame, variables: Sequence[str], ts: str = "period") -> DataFrame:
    """Per calendar year, the share of drivers with at least one value."""
    seen = [F.max(F.col(v).isNotNull().cast("int")) for v in variables]
    share = sum(seen[1:], seen[0]) / len(variables)
    return panel.groupBy("series_id", F.year(ts).alias("year")).agg(share.alias("coverage"))


def cutoff_year(coverage: DataFrame, threshold: float) -> DataFrame:
    """Earliest well-covered year (NULL when there is none)."""
    good = F.when(F.col("coverage") >= threshold, F.col("year"))
    return coverage.groupBy("series_id").agg(F.min(good).alias("cutoff_year"))


def last_n_periods(df: DataFrame, n: int, freq: str, ts: str = "period") -> DataFrame:
    """Rows in the last n distinct periods of each series."""
    period = period_start(F.col(ts), freq)
    periods = df.select("series_id", period.alias("_p")).distinct()
    w = Window.partitionBy("series_id").orderBy(F.desc("_p"))
    recent = periods.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")
    return df.withColumn("_p", period).join(recent, ["series_id", "_p"], "left_semi").drop("_p")


def trim_plan(panel: DataFrame, variables: Sequence[str], freq: str, threshold: float, min_obs: int,
              ts: str = "period") -> DataFrame:
    """Per series: strategy ('trimmed', 'last_n' or 'insufficient') and the first period to keep."""
    cut = cutoff_year(year_coverage(panel, variables, ts), threshold)
    start = F.make_date(F.coalesce(F.col("cutoff_year"), F.lit(1)), F.lit(1), F.lit(1))
    # The cut is by timestamp, so a week that straddles New Year counts when it holds a later row.
    day = F.col(ts).cast("date")
    periods = (
        panel.groupBy("series_id", period_start(F.col(ts), freq).alias("p")).agg(F.max(day).alias("last_day"))
        .join(cut, "series_id")
        .withColumn("rn", F.row_number().over(Window.partitionBy("series_id").orderBy(F.desc("p"))))
    )
    per_series = periods.groupBy("series_id").agg(
        F.min(start).alias("cut_start"),
        F.count(F.lit(1)).alias("n_periods"),
        F.count_if(F.col("last_day") >= start).alias("n_after_cut"),
        F.min(F.when(F.col("rn") <= min_obs, F.col("p"))).alias("last_n_start"),
    )
    return per_series.select(
        "series_id", "n_periods", "n_after_cut",
        F.when(F.col("n_after_cut") >= min_obs, "trimmed")
        .when(F.col("n_periods") >= min_obs, "last_n").otherwise("insufficient").alias("strategy"),
        F.when(F.col("n_after_cut") >= min_obs, F.col("cut_start")).otherwise(F.col("last_n_start")).alias("start"),
    )


def trim_series(panel: DataFrame, variables: Sequence[str], freq: str, threshold: float = 0.75, min_obs: int = 60,
                ts: str = "period", strict: bool = False) -> DataFrame:
    """Cut at the coverage year, or keep the last ``min_obs`` periods; adds ``strategy``.

    Series that are too short are left out (and reported by :func:`trim_plan`), or
    raise when ``strict``.
    """
    plan = trim_plan(panel, variables, freq, threshold, min_obs, ts)
    if strict:
        short = plan.filter(F.col("strategy") == "insufficient").limit(1).collect()
        if short:
            raise ValueError(f"series {short[0]['series_id']!r} has {short[0]['n_periods']} of {min_obs} periods")
    ok = plan.filter(F.col("strategy") != "insufficient").select("series_id", "strategy", "start")
    return panel.join(ok, "series_id").filter(F.col(ts).cast("date") >= F.col("start")).drop("start")


def validate_series(panel: DataFrame, freq: str, ts: str = "period", strict: bool = False) -> DataFrame:
    """Violations (series_id, rule, period): duplicated periods, missing periods, missing target."""
    rows = panel.select("series_id", period_start(F.col(ts), freq).alias("period"), "target")
    counts = rows.groupBy("series_id", "period").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("target").isNull()).alias("n_null"))
    duplicated = counts.filter("n > 1").select("series_id", F.lit("duplicate_period").alias("rule"), "period")
    null_target = counts.filter("n_null > 0").select("series_id", F.lit("missing_target").alias("rule"), "period")
    gaps = missing_periods(counts, freq).select("series_id", F.lit("missing_period").alias("rule"), "period")
    out = duplicated.unionByName(gaps).unionByName(null_target)
    if strict:
        bad = out.limit(5).collect()
        if bad:
            raise ValueError("; ".join(f"{b['series_id']}: {b['rule']} at {b['period']}" for b in bad))
    return out


def valid_range(long: DataFrame, keys: Sequence[str] = ("series_id", "variable")) -> DataFrame:
    """Rows between the first and the last known value of each driver."""
    w = Window.partitionBy(*keys)
    known = F.when(F.col("value").isNotNull(), F.col("period"))
    return (
        long.withColumn("_a", F.min(known).over(w)).withColumn("_b", F.max(known).over(w))
        .filter("period >= _a AND period <= _b").drop("_a", "_b")
    )


def first_last_valid(long: DataFrame, keys: Sequence[str] = ("series_id", "variable")) -> DataFrame:
    known = F.when(F.col("value").isNotNull(), F.col("period"))
    return long.groupBy(*keys).agg(F.min(known).alias("first_valid"), F.max(known).alias("last_valid"))
