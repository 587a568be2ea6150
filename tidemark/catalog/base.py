"""Registry of queries: each has one output layout, a Spark plan and (mostly) a plain SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import FACT_DRIVERS, panel_from_facts

DRIVERS = list(FACT_DRIVERS)


@dataclass(frozen=True)
class Query:
    layout: str
    plan: Callable[[SparkSession, str], DataFrame]
    body: str | None
    ctes: tuple[str, ...]


QUERIES: dict[str, Query] = {}
CTES: dict[str, str] = {}


def _fields(layout: str) -> list[tuple[str, str]]:
    """'name', 'name:d' (date as text), 'name:i' (bigint) or 'name:4' (rounded double)."""
    return [tuple((f + ":").split(":")[:2]) for f in layout.split()]


def shape(df: DataFrame, layout: str) -> DataFrame:
    cols = []
    for name, kind in _fields(layout):
        c = F.col(name)
        if kind == "d":
            c = c.cast("date").cast("string")
        elif kind == "i":
            c = c.cast("bigint")
        elif kind:
            c = F.round(c.cast("double"), int(kind))
            c = F.when(c == 0, F.lit(0.0)).otherwise(c)
        cols.append(c.alias(name))
    return df.select(*cols)


def _shape_sql(layout: str) -> str:
    cols = []
    for name, kind in _fields(layout):
        if kind == "d":
            cols.append(f"CAST(CAST({name} AS DATE) AS VARCHAR) AS {name}")
        elif kind == "i":
            cols.append(f"CAST({name} AS BIGINT) AS {name}")
        elif kind:
            r = f"round(CAST({name} AS DOUBLE), {kind})"
            cols.append(f"CASE WHEN {r} = 0 THEN CAST(0 AS DOUBLE) ELSE {r} END AS {name}")
        else:
            cols.append(name)
    return ", ".join(cols)


def query(name: str, layout: str, body: str | None = None, ctes: str = ""):
    """Register a Spark plan under a name; ``ctes`` lists the shared SQL fragments of its twin."""
    def keep(plan):
        QUERIES[name] = Query(layout, plan, body, tuple(ctes.split()))
        return plan

    return keep


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(q: Query):
        return lambda spark, folder: shape(q.plan(spark, folder), q.layout)

    return {name: bind(q) for name, q in QUERIES.items()}


def sql_queries() -> dict[str, str]:
    out = {}
    for name, q in QUERIES.items():
        if q.body is None:
            continue
        needed: list[str] = []

        def need(cte: str) -> None:
            deps, _ = CTES[cte]
            for d in deps:
                need(d)
            if cte not in needed:
                needed.append(cte)

        for c in q.ctes:
            need(c)
        head = ",\n".join(f"{c} AS ({CTES[c][1]})" for c in needed)
        out[name] = (f"WITH RECURSIVE {head}\n" if head else "") + f"SELECT {_shape_sql(q.layout)} FROM (\n{q.body}\n) AS result"
    return out


def cte(name: str, sql: str, needs: str = "") -> None:
    CTES[name] = (tuple(needs.split()), sql.strip())


# ---- panels --------------------------------------------------------------------------------


def panel(spark: SparkSession, folder: str) -> DataFrame:
    return panel_from_facts(spark, folder)


def nation_panel(spark: SparkSession, folder: str) -> DataFrame:
    return panel_from_facts(spark, folder, ("c_nationkey", "c_mktsegment"))


def _panel_sql(series: str, unit: str) -> str:
    return f"""
SELECT {series} AS series_id, CAST(date_trunc('{unit}', o_orderdate) AS DATE) AS period,
  round(sum(o_totalprice), 2) AS target, CAST(count(*) AS DOUBLE) AS n_orders,
  CAST(count(DISTINCT o_custkey) AS DOUBLE) AS n_customers,
  round(sum(c_acctbal), 2) / count(*) AS mean_acctbal,
  count(*) FILTER (WHERE o_orderstatus = 'F') / count(*) AS share_filled,
  round(sum(qty), 2) AS sum_qty, round(sum(qty), 2) / sum(items) AS mean_qty,
  round(sum(discount), 2) / sum(items) AS mean_discount, round(sum(tax), 2) / sum(items) AS mean_tax,
  round(sum(price), 2) / sum(items) AS mean_price, sum(returned) / sum(items) AS share_returned
FROM orders LEFT JOIN items ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
GROUP BY 1, 2"""


cte("items", """
SELECT l_orderkey, sum(l_quantity) AS qty, sum(l_discount) AS discount, sum(l_tax) AS tax,
  sum(l_extendedprice) AS price, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, count(*) AS items
FROM lineitem GROUP BY 1""")
cte("panel", _panel_sql("c_mktsegment", "month"), "items")
cte("nation", _panel_sql("CAST(c_nationkey AS VARCHAR) || '-' || c_mktsegment", "month"), "items")
cte("weekly", _panel_sql("c_mktsegment", "week"), "items")
cte("yearly", _panel_sql("c_mktsegment", "year"), "items")
_NAMES = ", ".join(DRIVERS)
cte("long", f"SELECT series_id, period, variable, value FROM panel UNPIVOT INCLUDE NULLS (value FOR variable IN ({_NAMES}))", "panel")
cte("nation_long", f"SELECT series_id, period, variable, value FROM nation_grid UNPIVOT INCLUDE NULLS (value FOR variable IN ({_NAMES}))", "nation_grid")
cte("nation_spine", """
SELECT series_id, CAST(unnest(generate_series(min(period), max(period), INTERVAL 1 MONTH)) AS DATE) AS period
FROM nation GROUP BY series_id""", "nation")
cte("nation_grid", "SELECT s.series_id, s.period, n.* EXCLUDE (series_id, period) FROM nation_spine s LEFT JOIN nation n "
    "ON n.series_id = s.series_id AND n.period = s.period", "nation_spine")
cte("fold_rows", """
SELECT *, CASE WHEN block < n_folds THEN n_folds - block END AS fold FROM (
  SELECT *, (rn - 1) // 12 AS block, CASE WHEN n > 30 THEN least(2, (n - 18) // 12) ELSE 0 END AS n_folds FROM (
    SELECT *, count(*) OVER (PARTITION BY series_id) AS n,
      row_number() OVER (PARTITION BY series_id ORDER BY period DESC) AS rn FROM panel))""", "panel")
cte("folds", """
SELECT f.*, (SELECT max(p.period) FROM panel p WHERE p.series_id = f.series_id AND p.period < f.holdout_start) AS train_end,
  (SELECT min(p.period) FROM panel p WHERE p.series_id = f.series_id) AS train_start
FROM (SELECT series_id, fold, max(n_folds) AS n_folds, min(period) AS holdout_start, max(period) AS holdout_end
      FROM fold_rows WHERE fold IS NOT NULL GROUP BY 1, 2) f""", "fold_rows")
cte("hold", """
SELECT p.*, f.fold, f.n_folds, row_number() OVER (PARTITION BY p.series_id, f.fold ORDER BY p.period) AS step
FROM panel p JOIN folds f ON p.series_id = f.series_id AND p.period BETWEEN f.holdout_start AND f.holdout_end""", "folds")
cte("last_train", """
SELECT f.series_id, f.fold, arg_max(p.target, p.period) AS last_train FROM panel p
JOIN folds f ON p.series_id = f.series_id AND p.period <= f.train_end GROUP BY 1, 2""", "folds")
cte("naive", """
SELECT h.series_id, h.fold, 'naive_last' AS model, h.step, h.period, l.last_train AS yhat
FROM hold h JOIN last_train l USING (series_id, fold)
UNION ALL
SELECT series_id, fold, 'naive_seasonal', step, period, yhat FROM (
  SELECT h.series_id, h.fold, h.step, h.period, o.target AS yhat,
    count(*) FILTER (WHERE o.target IS NULL) OVER (PARTITION BY h.series_id, h.fold) AS holes
  FROM hold h LEFT JOIN panel o ON o.series_id = h.series_id AND o.period = CAST(h.period - INTERVAL 12 MONTH AS DATE))
WHERE holes = 0""", "hold last_train")
# Fixed linear recursion on the log target: 0.2 lag 1 + 0.3 lag 12 + 0.5 mean of three - 0.05 deviation of three.
cte("bands", """
SELECT f.series_id, f.fold, avg(ln(target)) AS m, greatest(stddev_pop(ln(target)), 1e-6) AS s,
  list(ln(target) ORDER BY period) AS hist
FROM panel p JOIN folds f ON p.series_id = f.series_id AND p.period <= f.train_end GROUP BY 1, 2""", "folds")
cte("rolled", """
SELECT series_id, fold, 0 AS t, m, s, hist FROM bands
UNION ALL
SELECT series_id, fold, t + 1, m, s, list_append(hist, greatest(least(
  0.2 * hist[-1] + 0.3 * hist[-12] + 0.5 * (hist[-1] + hist[-2] + hist[-3]) / 3
  - 0.05 * sqrt(((hist[-1] - (hist[-1] + hist[-2] + hist[-3]) / 3) ** 2 + (hist[-2] - (hist[-1] + hist[-2] + hist[-3]) / 3) ** 2
    + (hist[-3] - (hist[-1] + hist[-2] + hist[-3]) / 3) ** 2) / 2), m + 5 * s), m - 5 * s))
FROM rolled WHERE t < 12""", "bands")
cte("fixed", """
SELECT h.series_id, h.fold, 'fixed' AS model, h.step, h.period, exp(r.hist[len(r.hist) - 12 + h.step]) AS yhat
FROM hold h JOIN rolled r ON r.series_id = h.series_id AND r.fold = h.fold AND r.t = 12""", "rolled hold")
cte("fc", "SELECT * FROM naive UNION ALL SELECT * FROM fixed", "naive fixed")
cte("scored", """
SELECT f.*, h.target AS actual, l.last_train, coalesce(lag(h.target) OVER (PARTITION BY f.series_id, f.fold, f.model
  ORDER BY f.period), l.last_train) AS prev
FROM fc f JOIN hold h USING (series_id, fold, period, step) JOIN last_train l USING (series_id, fold)""", "fc")
cte("met", """
SELECT series_id, fold, model, avg(abs(actual - yhat)) AS mae, avg((actual - yhat) ** 2) AS mse,
  sqrt(avg((actual - yhat) ** 2)) AS rmse, avg(abs(actual - yhat) / greatest(abs(actual), 2.220446049250313e-16)) AS mape,
  coalesce(avg(CASE WHEN sign(actual - prev) = sign(yhat - prev) THEN 1.0 ELSE 0.0 END) FILTER (WHERE actual <> prev), 1.0) AS da,
  avg(CASE WHEN abs(actual - yhat) / greatest(abs(actual), 1e-9) <= 0.1 THEN 1.0 ELSE 0.0 END) AS wba
FROM scored GROUP BY 1, 2, 3""", "scored")
cte("agg", """
SELECT *, 0.25 * da + 0.25 / (1 + mape) + 0.5 * wba AS fq_score FROM (
  SELECT series_id, model, avg(mae) AS mae, avg(rmse) AS rmse, avg(mape) AS mape, avg(da) AS da, avg(wba) AS wba,
    count(*) AS n_folds FROM met GROUP BY 1, 2)""", "met")
cte("ranked", """
SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY fq_score DESC, model) AS model_rank,
  model = 'fixed' AS multi FROM agg""", "agg")
cte("chosen", """
SELECT * EXCLUDE (best, fq), row_number() OVER (PARTITION BY series_id ORDER BY fq DESC, model) AS new_rank,
  fq / sum(fq) OVER (PARTITION BY series_id) AS weight
FROM (SELECT *, greatest(fq_score, 1e-6) AS fq FROM (
  SELECT *, min(model_rank) FILTER (WHERE multi) OVER (PARTITION BY series_id) AS best FROM ranked)
WHERE CASE WHEN best > 2 THEN model_rank <= 1 OR model_rank = best ELSE model_rank <= 2 END)""", "ranked")
