"""Queries over panels: sources, hygiene, features, screening."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.base import DRIVERS, cte, nation_panel, panel, query
from tidemark.functions import calendar as cal
from tidemark.functions import text
from tidemark.functions.scores import exp_back, log_target
from tidemark.operators import features as feat
from tidemark.operators import panel as P
from tidemark.operators import selection as S
from tidemark.operators.drivers import gap_periods, horizon_steps
from tidemark.operators.impute import bfill, ffill, time_interpolate
from tidemark.session import materialize, scratch_path
from tidemark.settings import DEFAULTS
from tidemark.sources.config import validate_config
from tidemark.sources import tables as T
from tidemark.sources import sinks

# Panel values are exact in both engines (cent sums over counts), so they are compared unrounded.
_ALL = "series_id period:d target " + " ".join(DRIVERS)


@query("read_config", "series_id freq min_obs:i holdout:i horizon:i n_problems:i", """
SELECT c_mktsegment AS series_id, CASE WHEN n > 250 THEN 'M' ELSE 'X' END AS freq, n AS min_obs, n - 300 AS holdout, 12 AS horizon,
  CASE WHEN n > 250 THEN 0 ELSE 1 END + CASE WHEN n - 300 <= 0 THEN 1 ELSE 0 END AS n_problems
FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1)""")
def _(spark, sf):
    n = F.col("n").cast("string")
    raw = T.load(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("c_mktsegment").alias("Series_Name"), F.lit("t.parquet").alias("Input_File_Name"),
        F.lit(" target ").alias("Target_Column_Name"), F.lit("day").alias("Date_Column_Name"),
        F.when(F.col("n") > 250, " m ").otherwise("X").alias("Frequency"), n.alias("Minimum_Observations"),
        (F.col("n") - 300).cast("string").alias(" Model_Selection_Period"), F.lit("12").alias("Forecasting_Period"))
    return validate_config(raw).withColumn("n_problems", F.size("problems"))


@query("read_wide_series", "series_id ts:d target:2 c_acctbal:2", """
SELECT c_mktsegment AS series_id, o_orderdate AS ts, arg_min(o_totalprice, o_orderkey) AS target,
  arg_min(c_acctbal, o_orderkey) AS c_acctbal FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2""")
def _(spark, sf):
    raw = T.load(spark, sf, "orders").join(T.load(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return T.wide_series(raw.select("c_mktsegment", "o_orderkey", "o_orderdate", "o_totalprice", "c_acctbal"),
                         "o_orderdate", "o_totalprice", "o_orderkey", "c_mktsegment")


query("panel_from_facts", _ALL, "SELECT * FROM panel", "panel")(panel)
query("panel_nation_segment", _ALL, "SELECT * FROM nation", "nation")(nation_panel)


@query("panel_weekly", _ALL, "SELECT * FROM weekly", "weekly")
def _(spark, sf):
    return T.panel_from_facts(spark, sf, freq="W")


@query("panel_yearly", _ALL, "SELECT * FROM yearly", "yearly")
def _(spark, sf):
    return T.panel_from_facts(spark, sf, freq="Y")


@query("resample_last", "series_id period:d value:2 odd:2", """
SELECT event_type AS series_id, date_trunc('week', ts) AS period, last(value ORDER BY ts, event_id) AS value,
  last(value ORDER BY ts, event_id) FILTER (WHERE event_id % 2 = 1) AS odd FROM events GROUP BY 1, 2""")
def _(spark, sf):
    rows = T.event_series(spark, sf).withColumn("odd", F.when(F.col("order") % 2 == 1, F.col("value")))
    return P.resample_last(rows, "W", ["value", "odd"], tiebreak="order")


@query("dedupe_first", "user_id:i day:d value:2", """
SELECT user_id, CAST(ts AS DATE) AS day, arg_min(value, event_id) AS value FROM events GROUP BY 1, 2""")
def _(spark, sf):
    e = T.load(spark, sf, "events").select("user_id", F.to_date("ts").alias("day"), "event_id", "value")
    return P.dedupe(e, ["user_id", "day"], "event_id")


@query("dedupe_last", "user_id:i day:d value:2", """
SELECT user_id, CAST(ts AS DATE) AS day, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2""")
def _(spark, sf):
    e = T.load(spark, sf, "events").select("user_id", F.to_date("ts").alias("day"), "event_id", "value")
    return P.dedupe(e, ["user_id", "day"], "event_id", keep="last")


@query("count_distinct_periods", "series_id n_periods:i", """
SELECT event_type AS series_id, count(DISTINCT date_trunc('week', ts)) AS n_periods FROM events GROUP BY 1""")
def _(spark, sf):
    return P.count_distinct_periods(T.event_series(spark, sf), "W")


@query("sanitize_columns", "o_total_price:2 Key_t:i", """
SELECT o_totalprice AS o_total_price, o_orderkey AS Key_t FROM orders""")
def _(spark, sf):
    odd = T.load(spark, sf, "orders").select(F.col("o_totalprice").alias("o total (price)"), F.col("o_orderkey").alias("_Key, [t]"))
    return text.sanitize_columns(odd)[0]


@query("sanitize_values", "p_type brand n:i", r"""
SELECT trim(regexp_replace(regexp_replace(trim(p_type), '[ ,()\[\]<>]', '_', 'g'), '_+', '_', 'g'), '_') AS p_type,
  trim(regexp_replace(regexp_replace(trim('(' || p_brand || ') [' || p_size || ']'), '[ ,()\[\]<>]', '_', 'g'), '_+', '_', 'g'), '_') AS brand,
  count(*) AS n FROM part GROUP BY 1, 2""")
def _(spark, sf):
    p = T.load(spark, sf, "part")
    p = p.withColumn("brand", F.concat(F.lit("("), "p_brand", F.lit(") ["), F.col("p_size").cast("string"), F.lit("]")))
    return text.sanitize_values(text.sanitize_values(p, "brand"), "p_type").groupBy("p_type", "brand").agg(F.count(F.lit(1)).alias("n"))


@query("slugify", "slug n:i", r"""
SELECT trim(regexp_replace(regexp_replace(lower(trim(o_orderpriority || ' / ' || o_orderstatus)), '[^a-z0-9]', '_', 'g'), '_+', '_', 'g'), '_') AS slug,
  count(*) AS n FROM orders GROUP BY 1""")
def _(spark, sf):
    name = F.concat_ws(" / ", "o_orderpriority", "o_orderstatus")
    return T.load(spark, sf, "orders").groupBy(text.slugify(name).alias("slug")).agg(F.count(F.lit(1)).alias("n"))


@query("select_variables", "series_id period:d target:2 n_orders mean_qty", "SELECT * FROM panel", "panel")
def _(spark, sf):
    return T.select_variables(panel(spark, sf), ["mean qty", "n_orders", "unknown"])


@query("split_target_drivers", "series_id variable total:2", """
SELECT series_id, variable, round(sum(value), 6) AS total FROM long GROUP BY 1, 2""", "long")
def _(spark, sf):
    return P.to_long(panel(spark, sf), DRIVERS).groupBy("series_id", "variable").agg(F.sum("value").alias("total"))


@query("period_spine", "series_id period:d", "SELECT * FROM nation_spine", "nation_spine")
def _(spark, sf):
    return P.period_spine(nation_panel(spark, sf), "M")


@query("future_spine", "series_id step:i period:d", """
SELECT series_id, step, max_p + to_months(CAST(step AS INTEGER)) AS period FROM (
  SELECT series_id, max(period) AS max_p FROM nation GROUP BY 1), (SELECT unnest(range(1, 13)) AS step)""", "nation")
def _(spark, sf):
    return P.future_spine(nation_panel(spark, sf), "M", 12)


@query("reindex_to_spine", "series_id period:d target:2 n_orders:0", "SELECT * FROM nation_grid", "nation_grid")
def _(spark, sf):
    return P.reindex_to_spine(nation_panel(spark, sf), "M")


@query("anti_missing_periods", "series_id period:d", """
SELECT series_id, period FROM nation_spine EXCEPT SELECT series_id, period FROM nation""", "nation_spine")
def _(spark, sf):
    return P.missing_periods(nation_panel(spark, sf), "M")


@query("semi_last_periods", "series_id period:d target:2", """
SELECT * FROM (SELECT *, dense_rank() OVER (PARTITION BY series_id ORDER BY period DESC) AS r FROM nation) WHERE r <= 24""", "nation")
def _(spark, sf):
    return P.last_n_periods(nation_panel(spark, sf), 24, "M")


@query("year_coverage", "series_id year:i coverage:6", f"""
SELECT series_id, year(period) AS year, ({' + '.join(f'max(CASE WHEN {d} IS NOT NULL THEN 1 ELSE 0 END)' for d in DRIVERS)}) / {len(DRIVERS)}.0 AS coverage
FROM sparse GROUP BY 1, 2""", "sparse")
def _(spark, sf):
    return P.year_coverage(sparse_panel(spark, sf), DRIVERS)


# Drivers that start late: four of them are unknown in the first years of a series.
_LATE = {"mean_acctbal": 1996, "sum_qty": 1997, "mean_tax": 1998, "mean_price": 1998}
cte("sparse", "SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN year(period) >= {y} AND n_orders > 2 THEN {d} END AS {d}" for d, y in _LATE.items()) + ") FROM nation_grid", "nation_grid")


def sparse_panel(spark, sf):
    grid = P.reindex_to_spine(nation_panel(spark, sf), "M")
    return grid.withColumns({
        d: F.when((F.year("period") >= y) & (F.col("n_orders") > 2), F.col(d)) for d, y in _LATE.items()})


cte("coverage", f"""
SELECT series_id, year(period) AS year, ({' + '.join(f'max(CASE WHEN {d} IS NOT NULL THEN 1 ELSE 0 END)' for d in DRIVERS)}) / {len(DRIVERS)}.0 AS coverage
FROM sparse GROUP BY 1, 2""", "sparse")
cte("cutoff", "SELECT series_id, min(year) FILTER (WHERE coverage >= 0.75) AS cutoff_year FROM coverage GROUP BY 1", "coverage")


@query("cutoff_year", "series_id cutoff_year:i", "SELECT * FROM cutoff", "cutoff")
def _(spark, sf):
    return P.cutoff_year(P.year_coverage(sparse_panel(spark, sf), DRIVERS), 0.75)


cte("trim", """
SELECT series_id, n_periods, n_after_cut, CASE WHEN n_after_cut >= 60 THEN 'trimmed' WHEN n_periods >= 60 THEN 'last_n'
  ELSE 'insufficient' END AS strategy, CASE WHEN n_after_cut >= 60 THEN cut ELSE last_start END AS start
FROM (SELECT series_id, count(*) AS n_periods, count(*) FILTER (WHERE period >= cut) AS n_after_cut, min(cut) AS cut,
    min(period) FILTER (WHERE rn <= 60) AS last_start
  FROM (SELECT s.series_id, s.period, make_date(CAST(coalesce(cutoff_year, 1) AS BIGINT), 1, 1) AS cut,
      row_number() OVER (PARTITION BY s.series_id ORDER BY s.period DESC) AS rn
    FROM sparse s JOIN cutoff c ON c.series_id = s.series_id) GROUP BY 1)""", "sparse cutoff")


@query("trim_plan", "series_id n_periods:i n_after_cut:i strategy", "SELECT * FROM trim", "trim")
def _(spark, sf):
    return P.trim_plan(sparse_panel(spark, sf), DRIVERS, "M", 0.75, 60)


@query("trim_series", "series_id period:d target:2 strategy", """
SELECT s.series_id, s.period, s.target, t.strategy FROM sparse s JOIN trim t ON t.series_id = s.series_id
WHERE strategy <> 'insufficient' AND period >= start""", "trim")
def _(spark, sf):
    return P.trim_series(sparse_panel(spark, sf), DRIVERS, "M", 0.75, 60)


@query("filter_ts_range", "series_id period:d target:2", """
SELECT * FROM panel WHERE period >= DATE '1998-01-01'""", "panel")
def _(spark, sf):
    return panel(spark, sf).filter(F.col("period") >= F.make_date(F.lit(1998), F.lit(1), F.lit(1)))


@query("validate_series", "series_id rule period:d", """
SELECT series_id, 'missing_period' AS rule, period FROM (SELECT series_id, period FROM nation_spine EXCEPT SELECT series_id, period FROM nation)
UNION ALL SELECT series_id, 'missing_target', period FROM nation WHERE target IS NULL OR n_orders = 1
UNION ALL SELECT series_id, 'duplicate_period', period FROM nation WHERE n_orders = 2""", "nation_spine")
def _(spark, sf):
    # Periods with one order lose their target and periods with two orders appear twice.
    p = nation_panel(spark, sf).withColumn("target", F.when(F.col("n_orders") != 1, F.col("target")))
    return P.validate_series(p.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("n_orders") == 2, 2).otherwise(1)))), "M")


cte("nation_range", """
SELECT * FROM (SELECT *, min(period) FILTER (WHERE value IS NOT NULL) OVER (PARTITION BY series_id, variable) AS a,
  max(period) FILTER (WHERE value IS NOT NULL) OVER (PARTITION BY series_id, variable) AS b FROM nation_long)
WHERE period BETWEEN a AND b""", "nation_long")


def nation_long(spark, sf):
    return P.to_long(P.reindex_to_spine(nation_panel(spark, sf), "M"), DRIVERS)


@query("valid_range_slice", "series_id variable period:d value", "SELECT * FROM nation_range", "nation_range")
def _(spark, sf):
    return P.valid_range(nation_long(spark, sf))


@query("first_last_valid", "series_id variable first_valid:d last_valid:d", """
SELECT series_id, variable, min(period) FILTER (WHERE value IS NOT NULL) AS first_valid,
  max(period) FILTER (WHERE value IS NOT NULL) AS last_valid FROM nation_long GROUP BY 1, 2""", "nation_long")
def _(spark, sf):
    return P.first_last_valid(nation_long(spark, sf))


_W = "PARTITION BY series_id, variable ORDER BY period"
for _name, _fn, _sql in (
    ("ffill", ffill, f"last_value(value IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"),
    ("bfill", bfill, f"first_value(value IGNORE NULLS) OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"),
):
    query(_name, "series_id variable period:d value", f"SELECT series_id, variable, period, {_sql} AS value FROM nation_long", "nation_long")(
        lambda spark, sf, fn=_fn: fn(nation_long(spark, sf), ["value"], ("series_id", "variable")))

cte("neighbours", f"""
SELECT *, last_value(CASE WHEN value IS NOT NULL THEN period END IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lt,
  last_value(value IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lv,
  first_value(CASE WHEN value IS NOT NULL THEN period END IGNORE NULLS) OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rt,
  first_value(value IGNORE NULLS) OVER ({_W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rv FROM nation_long""", "nation_long")


@query("time_interpolate", "series_id variable period:d value", """
SELECT series_id, variable, period, coalesce(value, CASE WHEN lv IS NULL THEN rv WHEN rv IS NULL THEN lv
  ELSE lv + (rv - lv) * (date_diff('day', lt, period) / date_diff('day', lt, rt)) END) AS value FROM neighbours""", "neighbours")
def _(spark, sf):
    return P.to_long(time_interpolate(P.reindex_to_spine(nation_panel(spark, sf), "M"), DRIVERS), DRIVERS)


@query("missing_fraction", "series_id variable missing_fraction:8", """
SELECT series_id, variable, avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) AS missing_fraction FROM nation_long GROUP BY 1, 2""", "nation_long")
def _(spark, sf):
    return S.missing_fraction(nation_long(spark, sf))


cte("sparse_long", f"SELECT series_id, period, variable, value FROM sparse UNPIVOT INCLUDE NULLS (value FOR variable IN ({', '.join(DRIVERS)}))", "sparse")


@query("drop_high_missing", "series_id variable n:i", """
SELECT series_id, variable, count(*) AS n FROM sparse_long GROUP BY 1, 2
HAVING avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) * 100 <= 25""", "sparse_long")
def _(spark, sf):
    kept, _ = S.drop_high_missing(P.to_long(sparse_panel(spark, sf), DRIVERS), 0.25)
    return kept.groupBy("series_id", "variable").agg(F.count(F.lit(1)).alias("n"))


@query("log_exp_target", "series_id period:d log_target:8 back:2", """
SELECT series_id, period, ln(target) AS log_target, exp(ln(target)) AS back FROM panel""", "panel")
def _(spark, sf):
    p = panel(spark, sf).withColumn("log_target", log_target(F.col("target")))
    return p.withColumn("back", exp_back(F.col("log_target")))


@query("calendar_features", "series_id period:d month:0 year:0 season_sin:8 season_cos:8 week:0 week_sin:8 ordinal:i", """
SELECT series_id, period, month(period) AS month, year(period) AS year, sin(2 * pi() * month(period) / 12) AS season_sin,
  cos(2 * pi() * month(period) / 12) AS season_cos, weekofyear(period) AS week, sin(2 * pi() * weekofyear(period) / 52) AS week_sin,
  date_diff('day', DATE '1970-01-05', period) // 7 AS ordinal FROM weekly""", "weekly")
def _(spark, sf):
    w = T.panel_from_facts(spark, sf, freq="W")
    cols = cal.calendar_features(F.col("period"), "M")
    wk = cal.calendar_features(F.col("period"), "W")
    return w.select("series_id", "period", *cols, wk[0], wk[2].alias("week_sin"), cal.period_ordinal(F.col("period"), "W").alias("ordinal"))


_LAG = "OVER (PARTITION BY series_id ORDER BY period)"


def _feature_sql(source: str, target: str, freq: str, drivers, short: int, long: int) -> str:
    lags = ", ".join(f"lag({target}, {i}) {_LAG} AS target_lag_{i}" for i in range(1, 13))
    rolls = []
    for fn, stat in (("avg", "rolling"), ("stddev_samp", "std")):
        for size, k in (("short", short), ("long", long)):
            over = f"OVER (PARTITION BY series_id ORDER BY period ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
            rolls.append(f"CASE WHEN count({target}) {over} = {k} THEN {fn}({target}) {over} END AS {stat}_{size}")
    slot, cycle, name = ("month(period)", 12, "month") if freq == "M" else ("weekofyear(period)", 52, "week")
    return f"""SELECT series_id, period, {target}, {lags}, {', '.join(drivers)}, {slot} AS {name}, year(period) AS year,
  sin(2 * pi() * {slot} / {cycle}) AS season_sin, cos(2 * pi() * {slot} / {cycle}) AS season_cos, {', '.join(rolls)} FROM {source}"""


_FEATS = "series_id period:d " + " ".join(f"target_lag_{i}:2" for i in range(1, 13)) + " rolling_short:3 rolling_long:3 std_short:1 std_long:1"
cte("feats", _feature_sql("panel", "target", "M", DRIVERS, 3, 6), "panel")


@query("target_lags", "series_id period:d " + " ".join(f"target_lag_{i}:2" for i in range(1, 13)), "SELECT * FROM feats", "feats")
def _(spark, sf):
    return panel(spark, sf).select("series_id", "period", *feat.target_lags())


@query("rolling_mean_std", "series_id period:d rolling_short:3 rolling_long:3 std_short:1 std_long:1", "SELECT * FROM feats", "feats")
def _(spark, sf):
    return panel(spark, sf).select("series_id", "period", *feat.rolling_stats("target", "M"))


@query("make_target_features", _FEATS + " month:0 year:0 season_sin:8 season_cos:8 " + " ".join(DRIVERS),
       "SELECT * FROM feats WHERE target_lag_12 IS NOT NULL AND rolling_long IS NOT NULL AND std_short IS NOT NULL AND " +
       " AND ".join(f"{d} IS NOT NULL" for d in DRIVERS), "feats")
def _(spark, sf):
    return feat.make_target_features(panel(spark, sf), DRIVERS)


@query("make_target_features_weekly", _FEATS + " week:0 season_cos:8", "SELECT * FROM (" + _feature_sql("weekly", "target", "W", ["n_orders"], 13, 26) +
       ") WHERE rolling_long IS NOT NULL AND target_lag_12 IS NOT NULL", "weekly")
def _(spark, sf):
    return feat.make_target_features(T.panel_from_facts(spark, sf, freq="W"), ["n_orders"], "W")


@query("drop_incomplete_features", "series_id n:i", """
SELECT series_id, count(*) AS n FROM feats WHERE target_lag_12 IS NOT NULL AND rolling_long IS NOT NULL GROUP BY 1""", "feats")
def _(spark, sf):
    f = feat.make_target_features(panel(spark, sf), [], drop=False)
    return feat.drop_incomplete(f, feat.feature_names([], "M")).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"))


@query("last_k_history", "series_id i:i v:2", """
SELECT series_id, 13 - rn AS i, target AS v FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY period DESC) AS rn FROM panel) WHERE rn <= 12""", "panel")
def _(spark, sf):
    h = feat.history_array(panel(spark, sf), "target", 12)
    return h.select("series_id", F.posexplode("history").alias("i", "v")).withColumn("i", F.col("i") + 1)


@query("next_feature_row", "series_id period:d target_lag_1:2 target_lag_12:2 rolling_short:3 rolling_long:3 std_short:1 std_long:1 month:0", """
SELECT series_id, CAST(max(period) + INTERVAL 1 MONTH AS DATE) AS period, arg_max(target, period) AS target_lag_1,
  max(target) FILTER (WHERE rn = 12) AS target_lag_12, avg(target) FILTER (WHERE rn <= 3) AS rolling_short,
  avg(target) FILTER (WHERE rn <= 6) AS rolling_long, stddev_samp(target) FILTER (WHERE rn <= 3) AS std_short,
  stddev_samp(target) FILTER (WHERE rn <= 6) AS std_long, month(CAST(max(period) + INTERVAL 1 MONTH AS DATE)) AS month
FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY period DESC) AS rn FROM panel) GROUP BY 1""", "panel")
def _(spark, sf):
    p = panel(spark, sf)
    state = feat.history_array(p, "target", 12).join(P.future_spine(p, "M", 1), "series_id")
    return feat.next_feature_row(state, [])


@query("lag_cce_mean", "series_id period:d m:4 lag_m:4", """
SELECT series_id, period, m, coalesce(lag(m) OVER (PARTITION BY series_id ORDER BY period), m) AS lag_m
FROM (SELECT *, (n_orders + n_customers + mean_acctbal) / 3 AS m FROM panel)""", "panel")
def _(spark, sf):
    from pyspark.sql import Window

    p = panel(spark, sf).withColumn("m", (F.col("n_orders") + F.col("n_customers") + F.col("mean_acctbal")) / 3)
    return p.withColumn("lag_m", F.coalesce(F.lag("m").over(Window.partitionBy("series_id").orderBy("period")), F.col("m")))


cte("target_end", "SELECT series_id, max(period) AS target_end FROM nation WHERE n_orders > 1 GROUP BY 1", "nation")
cte("driver_end", """
SELECT series_id, variable, max(period) AS driver_end FROM (
  SELECT * FROM nation_long WHERE value IS NOT NULL AND (variable <> 'mean_tax' OR period < DATE '2001-02-01')) GROUP BY 1, 2""", "nation_long")
cte("need", """
SELECT series_id, variable, driver_end, target_end, date_diff('month', driver_end, target_end) AS gap,
  greatest(date_diff('month', driver_end, target_end) + 12, 0) AS steps FROM driver_end JOIN target_end USING (series_id)""", "driver_end target_end")


def _need(spark, sf):
    long = nation_long(spark, sf).withColumn(
        "value", F.when((F.col("variable") != "mean_tax") | (F.col("period") < "2001-02-01"), F.col("value")))
    ends = nation_panel(spark, sf).filter("n_orders > 1").groupBy("series_id").agg(F.max("period").alias("target_end"))
    return horizon_steps(long, ends, "M", 12)


@query("horizon_steps", "series_id variable gap:i steps:i", "SELECT * FROM need", "need")
def _(spark, sf):
    return _need(spark, sf)


@query("gap_range_join", "series_id variable period:d", """
SELECT series_id, variable, CAST(unnest(generate_series(driver_end + INTERVAL 1 MONTH, driver_end + to_months(CAST(steps AS INTEGER)), INTERVAL 1 MONTH)) AS DATE) AS period
FROM need WHERE steps > 0""", "need")
def _(spark, sf):
    return gap_periods(_need(spark, sf), "M")


@query("freq_params", "series_id freq season:i roll_short:i roll_long:i history:i n:i", """
SELECT series_id, freq, season, roll_short, roll_long, history, n FROM (
  SELECT series_id, 'M' AS freq, 12 AS season, 3 AS roll_short, 6 AS roll_long, 24 AS history, count(*) AS n FROM panel GROUP BY 1
  UNION ALL SELECT series_id, 'W', 52, 13, 26, 104, count(*) FROM weekly GROUP BY 1
  UNION ALL SELECT series_id, 'Y', 1, 2, 3, 2, count(*) FROM yearly GROUP BY 1)""", "panel weekly yearly")
def _(spark, sf):
    parts = []
    for f in "MWY":
        p = T.panel_from_facts(spark, sf, freq=f).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"))
        parts.append(p.select("series_id", "n", *[F.lit(v).alias(k) for k, v in cal.freq_params(f).items()]))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- screening -----------------------------------------------------------------------------

cte("corrs", """
SELECT series_id, variable, corr(value, target) AS corr FROM long JOIN (SELECT series_id, period, target FROM panel) USING (series_id, period)
GROUP BY 1, 2""", "long")


@query("corr_with_target", "series_id variable corr:6 corr_value:3 keep", """
SELECT series_id, variable, corr, round(corr, 3) AS corr_value, abs(corr) >= 0.2 AS keep FROM corrs""", "corrs")
def _(spark, sf):
    return S.corr_with_target_wide(panel(spark, sf), DRIVERS)


@query("corr_with_target_gappy", "series_id variable corr:6 keep", """
SELECT series_id, variable, c AS corr, abs(c) >= 0.2 AS keep FROM (
  SELECT series_id, variable, CASE WHEN isnan(corr(value, target)) THEN NULL ELSE corr(value, target) END AS c
  FROM nation_long JOIN (SELECT series_id, period, target FROM nation) USING (series_id, period) GROUP BY 1, 2)""", "nation_long")
def _(spark, sf):
    p = nation_panel(spark, sf)
    return S.corr_with_target(P.to_long(p, DRIVERS), p)


@query("standardize", "series_id period:d n_orders:6 mean_price:6", """
SELECT series_id, period, (n_orders - avg(n_orders) OVER w) / stddev_pop(n_orders) OVER w AS n_orders,
  (mean_price - avg(mean_price) OVER w) / stddev_pop(mean_price) OVER w AS mean_price FROM panel WINDOW w AS (PARTITION BY series_id)""", "panel")
def _(spark, sf):
    return S.standardize(panel(spark, sf), ["n_orders", "mean_price"])


cte("cpairs", """
SELECT a.series_id, a.variable AS a, b.variable AS b, corr(a.value, b.value) AS corr
FROM long a JOIN long b ON a.series_id = b.series_id AND a.period = b.period GROUP BY 1, 2, 3""", "long")


_ORDER = "CASE {} " + " ".join(f"WHEN '{d}' THEN {i}" for i, d in enumerate(DRIVERS)) + " END"


@query("corr_matrix", "series_id a b corr:6", f"""
SELECT * FROM cpairs WHERE {_ORDER.format('a')} <= {_ORDER.format('b')}""", "cpairs")
def _(spark, sf):
    return S.corr_matrix(panel(spark, sf), DRIVERS)


@query("vif_two_drivers", "series_id variable vif:6", """
SELECT series_id, unnest(['mean_qty', 'mean_price']) AS variable, 1 / (1 - corr * corr) AS vif
FROM cpairs WHERE a = 'mean_qty' AND b = 'mean_price'""", "cpairs")
def _(spark, sf):
    from tidemark.operators.importance import vif

    return vif(S.corr_matrix(panel(spark, sf), ["mean_qty", "mean_price"]), ["mean_qty", "mean_price"])


@query("argmax_driver", "series_id variable", """
SELECT series_id, arg_max(variable, abs(corr)) AS variable FROM corrs GROUP BY 1""", "corrs")
def _(spark, sf):
    c = S.corr_with_target_wide(panel(spark, sf), DRIVERS)
    return c.groupBy("series_id").agg(F.max_by("variable", "corr_abs").alias("variable"))


cte("mi", """
SELECT series_id, variable, sum(n / total * ln(n * total / (nx * ny))) AS score FROM (
  SELECT *, sum(n) OVER (PARTITION BY series_id, variable, bx) AS nx, sum(n) OVER (PARTITION BY series_id, variable, by_) AS ny,
    sum(n) OVER (PARTITION BY series_id, variable) AS total FROM (
    SELECT series_id, variable, bx, by_, CAST(count(*) AS DOUBLE) AS n FROM (
      SELECT series_id, variable, ntile(5) OVER (PARTITION BY series_id, variable ORDER BY value, period) AS bx,
        ntile(5) OVER (PARTITION BY series_id, variable ORDER BY target, period) AS by_
      FROM long JOIN (SELECT series_id, period, target FROM panel) USING (series_id, period)) GROUP BY ALL)) GROUP BY 1, 2""", "long")


@query("binned_mutual_information", "series_id variable score:8", "SELECT * FROM mi", "mi")
def _(spark, sf):
    p = panel(spark, sf)
    return S.mutual_information(P.to_long(p, DRIVERS), p)


@query("normalize_importance", "series_id variable score:8", """
SELECT series_id, variable, score / max(score) OVER (PARTITION BY series_id) AS score FROM mi""", "mi")
def _(spark, sf):
    p = panel(spark, sf)
    return S.normalize_importance(S.mutual_information(P.to_long(p, DRIVERS), p))


# Composite from two rankings; the other two enter as zero vectors.
cte("comp", """
SELECT series_id, variable, 0.2 * c / max(c) OVER w + 0.2 * coalesce(m, 0) / max(coalesce(m, 0)) OVER w AS composite FROM (
  SELECT series_id, variable, abs(corr) AS c, score AS m FROM corrs LEFT JOIN (SELECT * FROM mi WHERE variable <> 'mean_tax') USING (series_id, variable))
WINDOW w AS (PARTITION BY series_id)""", "corrs mi")


def _composite(spark, sf, settings=DEFAULTS):
    p = panel(spark, sf)
    corr = S.corr_with_target_wide(p, DRIVERS)
    mi = S.mutual_information(P.to_long(p, DRIVERS), p).filter("variable <> 'mean_tax'")
    from tidemark.operators.importance import corr_rank

    none = corr.select("series_id", "variable", F.lit(0.0).alias("score"))
    return S.composite_score(S.align_scores(corr, corr=corr_rank(corr), mi=mi, elasticnet=none, tree=none), settings)


@query("composite_score", "series_id variable composite:8", "SELECT * FROM comp", "comp")
def _(spark, sf):
    return _composite(spark, sf)


@query("threshold_or_topk", "series_id variable rank:i", """
SELECT series_id, variable, rank FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY composite DESC, variable) AS rank,
  count(*) FILTER (WHERE composite >= 0.25) OVER (PARTITION BY series_id) AS good FROM comp)
WHERE CASE WHEN good >= 3 THEN composite >= 0.25 ELSE rank <= 3 END""", "comp")
def _(spark, sf):
    return S.threshold_or_topk(_composite(spark, sf), DEFAULTS.with_(min_selected=3))


@query("join_left_equi", "series_id variable rank:i corr_value:3 vif:3", """
SELECT series_id, variable, rank, round(corr, 3) AS corr_value, CASE WHEN variable IN ('n_orders', 'n_customers') THEN 1 / (1 - r * r) END AS vif FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY composite DESC, variable) AS rank FROM comp) JOIN corrs USING (series_id, variable)
  JOIN (SELECT series_id, corr AS r FROM cpairs WHERE a = 'n_orders' AND b = 'n_customers') USING (series_id) WHERE rank <= 5""", "comp cpairs")
def _(spark, sf):
    from tidemark.operators.importance import vif

    p = panel(spark, sf)
    two = ["n_orders", "n_customers"]
    selected = S.threshold_or_topk(_composite(spark, sf), DEFAULTS.with_(min_selected=5, min_composite=9.0))
    return S.selection_report(selected, S.corr_with_target_wide(p, DRIVERS), vif(S.corr_matrix(p, two), two))


@query("read_selected_features", "series_id variable", "SELECT series_id, variable FROM corrs WHERE abs(corr) >= 0.2", "corrs")
def _(spark, sf):
    c = S.corr_with_target_wide(panel(spark, sf), DRIVERS).filter("keep")
    path = sinks.write_table(c.withColumn("variable", F.regexp_replace("variable", "_", " ")), scratch_path(spark, "selected"))
    return T.read_selected_features(spark, path)


@query("write_scores", "series_id variable score", """
SELECT series_id, variable, format('{:.3f}', score) AS score FROM mi""", "mi")
def _(spark, sf):
    p = panel(spark, sf)
    path = sinks.write_scores(S.mutual_information(P.to_long(p, DRIVERS), p), scratch_path(spark, "scores"))
    return spark.read.option("header", True).csv(path)


@query("write_scores_by_run", "run_id series_id variable score", """
SELECT run_id, series_id, variable, format('{:.3f}', CASE WHEN run_id = 'two' THEN 2 * score ELSE score END) AS score
FROM mi, (SELECT unnest(['one', 'two']) AS run_id)""", "mi")
def _(spark, sf):
    """Two runs in one folder; the second is written wrongly for a series first, then that series again."""
    p = panel(spark, sf)
    scores = materialize(S.mutual_information(P.to_long(p, DRIVERS), p))
    path, double = scratch_path(spark, "scores"), scores.withColumn("score", F.col("score") * 2)
    sinks.write_scores(scores, path, "one")
    sinks.write_scores(double.withColumn("score", F.when(F.col("series_id") == "BUILDING", -1.0).otherwise(F.col("score"))), path, "two")
    sinks.write_scores(double.filter("series_id = 'BUILDING'"), path, "two")
    return sinks.read_run(spark, path, sinks.three_decimals(scores).schema, csv=True)


@query("write_rejected", "series_id variable corr_value", """
SELECT series_id, variable, format('{:.3f}', round(corr, 3)) AS corr_value FROM corrs WHERE abs(corr) < 0.2""", "corrs")
def _(spark, sf):
    c = S.corr_with_target_wide(panel(spark, sf), DRIVERS)
    path = sinks.write_csv(c.filter("NOT keep").select("series_id", "variable", "corr_value"), scratch_path(spark, "rejected"))
    return spark.read.option("header", True).csv(path)


@query("write_selected_features", "series_id variable rank:i composite", """
SELECT series_id, variable, rank, format('{:.3f}', composite) AS composite FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY composite DESC, variable) AS rank,
    count(*) FILTER (WHERE composite >= 0.25) OVER (PARTITION BY series_id) AS good FROM comp)
WHERE CASE WHEN good >= 3 THEN composite >= 0.25 ELSE rank <= 3 END""", "comp")
def _(spark, sf):
    chosen = S.threshold_or_topk(_composite(spark, sf), DEFAULTS.with_(min_selected=3)).select("series_id", "variable", "rank", "composite")
    return spark.read.option("header", True).csv(sinks.write_csv(chosen, scratch_path(spark, "selected_csv")))


@query("write_summary_json", "series_id rows:i n_dropped:i num_selected_features:i first_selected", """
SELECT series_id, (SELECT count(*) FROM panel p WHERE p.series_id = c.series_id) AS rows, count(*) FILTER (WHERE abs(corr) < 0.2) AS n_dropped,
  count(*) FILTER (WHERE abs(corr) >= 0.2) AS num_selected_features, min(variable) FILTER (WHERE abs(corr) >= 0.2) AS first_selected
FROM corrs c GROUP BY 1""", "corrs")
def _(spark, sf):
    p = panel(spark, sf)
    c = S.corr_with_target_wide(p, DRIVERS)
    shape = p.groupBy("series_id").agg(F.count(F.lit(1)).alias("rows"))
    doc = sinks.summary_document(shape, c.filter("NOT keep"), c.filter("keep"), DEFAULTS)
    back = spark.read.json(sinks.write_summary_json(doc, scratch_path(spark, "summary")))
    return back.withColumn("n_dropped", F.size("dropped_columns")).withColumn("first_selected", F.col("selected_features")[0])
