"""SQL fragments that solve small linear systems: Gauss-Jordan elimination as a recursive query over a matrix in a list of rows.

Regressors are standardised and columns that are combinations of others (rolling means of lags, means of drivers) are left
out, which changes no fitted value. What is left has full rank, so no pivoting is needed.
"""

from __future__ import annotations

import re

from tidemark.catalog.base import CTES, DRIVERS, cte
from tidemark.catalog.panel_queries import _feature_sql
from tidemark.operators.target_models import RIDGE, TREND_KNOTS

LAGS = [f"target_lag_{i}" for i in range(1, 13)]
CALENDAR = ["month", "year", "season_sin", "season_cos"]
ROW_MEAN = "(" + " + ".join(DRIVERS) + f") / {len(DRIVERS)}"


def gauss(name: str, source: str, keys: str) -> None:
    """Reduces the leading square of every matrix ``m`` to the unit matrix; the last step holds the solutions."""
    cte(name, f"""
SELECT {keys}, 0 AS k, m FROM {source}
UNION ALL
SELECT {keys}, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k + 1 THEN list_transform(r, lambda x: x / r[k + 1])
  ELSE list_transform(r, lambda x, j: x - m[k + 1][j] * (r[k + 1] / m[k + 1][k + 1])) END)
FROM {name} WHERE k < len(m)""", source)


def regression(name: str, rows: str, keys: str, ridge: float = 0.0, centred: bool = True) -> None:
    """``{name}_fit``: slopes per unit of the raw regressors, intercept, and the target's mean and deviation.

    ``rows`` has the keys, a row number r, regressors x (a list) and y. Without ``centred`` there is no intercept.
    """
    mean = "avg(v)" if centred else "0.0"
    spread = "stddev_pop(v)" if centred else "sqrt(avg(v * v))"
    cte(f"{name}_cells", f"SELECT {keys}, r, len(x) AS p, unnest(range(1, len(x) + 2)) AS j, unnest(list_append(x, y)) AS v FROM {rows}", rows)
    cte(f"{name}_stats", f"SELECT {keys}, j, any_value(p) AS p, {mean} AS m, {spread} AS s FROM {name}_cells GROUP BY {keys}, j", f"{name}_cells")
    cte(f"{name}_z", f"SELECT {keys}, r, j, c.p, CASE WHEN s > 0 THEN (v - m) / s ELSE 0 END AS z FROM {name}_cells c JOIN {name}_stats USING ({keys}, j)",
        f"{name}_stats")
    cte(f"{name}_corr", f"""
SELECT {keys}, a.j AS i, b.j AS j, avg(a.z * b.z) + CASE WHEN a.j = b.j THEN {ridge!r} ELSE 0 END AS c
FROM {name}_z a JOIN {name}_z b USING ({keys}, r) WHERE a.j <= a.p GROUP BY {keys}, a.j, b.j""", f"{name}_z")
    cte(f"{name}_m", f"""
SELECT {keys}, list(row ORDER BY i) AS m FROM (SELECT {keys}, i, list(c ORDER BY j) AS row FROM {name}_corr GROUP BY {keys}, i) GROUP BY {keys}""",
        f"{name}_corr")
    gauss(f"{name}_gj", f"{name}_m", keys)
    cte(f"{name}_fit", f"""
SELECT {keys}, b, my - list_sum(list_transform(b, lambda v, i: v * mx[i])) AS b0, my, sy FROM (
  SELECT *, list_transform(m, lambda r, i: CASE WHEN sx[i] > 0 THEN r[len(m) + 1] * sy / sx[i] ELSE 0 END) AS b FROM {name}_gj
  JOIN (SELECT {keys}, list(m ORDER BY j) FILTER (WHERE j <= p) AS mx, list(s ORDER BY j) FILTER (WHERE j <= p) AS sx, max(m) FILTER (WHERE j > p) AS my,
    max(s) FILTER (WHERE j > p) AS sy FROM {name}_stats GROUP BY {keys}) USING ({keys}) WHERE k = len(m))""", f"{name}_gj {name}_stats")


# ---- features of the log target, per fold ---------------------------------------------------

cte("logs", "SELECT *, ln(target) AS y FROM panel", "panel")
cte("log_feats", "SELECT *, " + ROW_MEAN + " AS row_mean FROM (" + _feature_sql("logs", "y", "M", DRIVERS, 3, 6) + ")", "logs")
_FULL = " AND ".join(f"{c} IS NOT NULL" for c in ["y", LAGS[-1], "rolling_long", "std_short", *DRIVERS])
cte("log_rows", f"""
SELECT f.fold, d.*, row_number() OVER (PARTITION BY d.series_id, f.fold ORDER BY d.period) AS r FROM (
  SELECT *, coalesce(lag(row_mean) OVER (PARTITION BY series_id ORDER BY period), row_mean) AS lag_mean FROM log_feats WHERE {_FULL}) d
JOIN folds f ON f.series_id = d.series_id AND d.period <= f.train_end""", "log_feats folds")
cte("log_hist", """
SELECT f.series_id, f.fold, list(l.y ORDER BY l.period) AS hist FROM logs l JOIN folds f ON f.series_id = l.series_id AND l.period <= f.train_end
GROUP BY 1, 2""", "logs folds")
_KNOWN = ["std_short", "std_long", *DRIVERS, *CALENDAR]


def _hold_list(extra: str = "") -> str:
    angle = "2 * pi() * month(period) / 12"
    return "[" + ", ".join([*DRIVERS, "month(period)", "year(period)", f"sin({angle})", f"cos({angle})", *([extra] if extra else [])]) + "]"


def _deviation(k: int) -> str:
    return f"list_stddev_samp(hist[-{k}:])"


def lagged_model(name: str, extra_row: str = "", extra_hold: str = "") -> str:
    """Least squares on lags, deviations, drivers and calendar, rolled forward; returns the body of a model's twin."""
    columns = [*LAGS, *_KNOWN, *([extra_row] if extra_row else [])]
    cte(f"{name}_rows", f"SELECT series_id, fold, r, [{', '.join(columns)}] AS x, y FROM log_rows", "log_rows")
    regression(name, f"{name}_rows", "series_id, fold")
    cte(f"{name}_known", f"SELECT series_id, fold, step, period, {_hold_list(extra_hold)} AS known FROM hold", "hold")
    lags = ", ".join(f"hist[-{i}]" for i in range(1, 13))
    cte(f"{name}_roll", f"""
SELECT series_id, fold, 0 AS t, hist FROM log_hist
UNION ALL
SELECT series_id, fold, t + 1, list_append(hist, greatest(least(yhat, my + 5 * greatest(sy, 1e-6)), my - 5 * greatest(sy, 1e-6))) FROM (
  SELECT q.series_id, q.fold, t, hist, my, sy, b0 + list_inner_product(b, list_concat([{lags}, {_deviation(3)}, {_deviation(6)}], known)) AS yhat
  FROM {name}_roll q JOIN {name}_fit f ON f.series_id = q.series_id AND f.fold = q.fold
  JOIN {name}_known n ON n.series_id = q.series_id AND n.fold = q.fold AND n.step = t + 1)""", f"log_hist {name}_fit {name}_known")
    return f"""
SELECT h.series_id, h.fold, '{{model}}' AS model, h.step, h.period, exp(q.hist[len(q.hist) - 12 + h.step]) AS yhat
FROM hold h JOIN {name}_roll q ON q.series_id = h.series_id AND q.fold = h.fold AND q.t = 12"""


LINEAR_SQL: dict[str, tuple[str, str]] = {}
_base = lagged_model("lin")
# Means of drivers and first-stage fits of a lag lie in the span of the other columns.
for _m in ("ols", "ccemg", "sysgmm"):
    LINEAR_SQL[_m] = (_base.format(model=_m), "lin_roll hold")
LINEAR_SQL["dccemg"] = (lagged_model("dcc", "lag_mean", ROW_MEAN).format(model="dccemg"), "dcc_roll hold")

# Differenced regression: lag 1, lag 12 and drivers, all as differences; no intercept.
_DIFF = [f"{d} - lag({d}) OVER o AS d_{d}" for d in DRIVERS]
cte("diffs", f"""
SELECT *, lag(dy) OVER o AS dy_1, lag(dy, 12) OVER o AS dy_12 FROM (SELECT series_id, period, y, y - lag(y) OVER o AS dy, {', '.join(_DIFF)} FROM logs
WINDOW o AS (PARTITION BY series_id ORDER BY period)) WINDOW o AS (PARTITION BY series_id ORDER BY period)""", "logs")
cte("arx_rows", f"""
SELECT l.series_id, l.fold, l.r, [dy_1, dy_12, {', '.join('d_' + d for d in DRIVERS)}] AS x, dy AS y FROM log_rows l JOIN diffs d
ON d.series_id = l.series_id AND d.period = l.period WHERE dy_12 IS NOT NULL""", "log_rows diffs")
regression("arx", "arx_rows", "series_id, fold", centred=False)
cte("arx_known", f"""
SELECT series_id, fold, step, [{', '.join(f'{d} - before_{d}' for d in DRIVERS)}] AS known FROM (
  SELECT h.*, {', '.join(f'coalesce(lag(h.{d}) OVER (PARTITION BY h.series_id, h.fold ORDER BY h.step), p.{d}) AS before_{d}' for d in DRIVERS)}
  FROM hold h JOIN folds f ON f.series_id = h.series_id AND f.fold = h.fold JOIN panel p ON p.series_id = f.series_id AND p.period = f.train_end)""", "hold folds")
cte("arx_roll", """
SELECT series_id, fold, 0 AS t, hist FROM log_hist
UNION ALL
SELECT q.series_id, q.fold, t + 1, list_append(hist, hist[-1] + list_inner_product(b, list_concat([hist[-1] - hist[-2], hist[-12] - hist[-13]], known)))
FROM arx_roll q JOIN arx_fit f ON f.series_id = q.series_id AND f.fold = q.fold
JOIN arx_known n ON n.series_id = q.series_id AND n.fold = q.fold AND n.step = t + 1""", "log_hist arx_fit arx_known")
LINEAR_SQL["arx"] = ("""
SELECT h.series_id, h.fold, 'arx' AS model, h.step, h.period, exp(q.hist[len(q.hist) - 12 + h.step]) AS yhat
FROM hold h JOIN arx_roll q ON q.series_id = h.series_id AND q.fold = h.fold AND q.t = 12""", "arx_roll hold")


# ---- the univariate models of the drivers, on the log target of every fold ------------------

_CHAIN = ("long", "arr", "grid1", "ets1", "ets1_best", "grid2", "ets2", "ets2_best", "obs", "acf", "seasonal", "ratios", "slots", "adj", "adj_arr",
          "ses", "ses_best")


def on_log_target() -> None:
    """Copies of the fragments above that read the log target per fold in place of a driver's values."""
    cte("t_long", """
SELECT l.series_id, CAST(f.fold AS VARCHAR) AS variable, l.period, l.y AS value FROM logs l JOIN folds f ON f.series_id = l.series_id AND l.period <= f.train_end""",
        "logs folds")
    named = re.compile(r"\b(" + "|".join(_CHAIN) + r")\b(?!\()")
    for name in _CHAIN[1:]:
        needs, sql = CTES[name]
        cte(f"t_{name}", named.sub(r"t_\1", sql), " ".join(f"t_{n}" if n in _CHAIN else n for n in needs))


# ---- a piecewise trend with yearly cycles, by ridge regression ------------------------------

_KNOTS = [0.8 * (i + 1) / (TREND_KNOTS + 1) for i in range(TREND_KNOTS)]


def _trend_list(i: str) -> str:
    waves = [f"{f}(2 * pi() * {k} / 12 * ({i}))" for k in range(1, 4) for f in ("sin", "cos")]
    return "[" + ", ".join([f"({i}) / n", *(f"greatest(({i}) / n - {c!r}, 0)" for c in _KNOTS), *waves]) + "]"


cte("ft_obs", """
SELECT l.series_id, f.fold, l.y, row_number() OVER w - 1 AS r, CAST(count(*) OVER (PARTITION BY l.series_id, f.fold) AS DOUBLE) AS n
FROM logs l JOIN folds f ON f.series_id = l.series_id AND l.period <= f.train_end WINDOW w AS (PARTITION BY l.series_id, f.fold ORDER BY l.period)""", "logs folds")
cte("ft_rows", f"SELECT series_id, fold, r, {_trend_list('r')} AS x, y FROM ft_obs", "ft_obs")
regression("ft", "ft_rows", "series_id, fold", ridge=RIDGE)
FOURIER_SQL = f"""
SELECT h.series_id, h.fold, 'fourier_trend' AS model, h.step, h.period, exp(b0 + list_inner_product(b, {_trend_list('n + h.step - 1')})) AS yhat
FROM hold h JOIN ft_fit f ON f.series_id = h.series_id AND f.fold = h.fold
JOIN (SELECT series_id, fold, max(n) AS n FROM ft_obs GROUP BY 1, 2) o ON o.series_id = h.series_id AND o.fold = h.fold"""

# ---- variance inflation: the inverse of the correlation matrix ------------------------------

cte("drv_z", f"""
SELECT series_id, period, variable, CASE WHEN stddev_pop(value) OVER w > 0 THEN (value - avg(value) OVER w) / stddev_pop(value) OVER w ELSE 0 END AS z,
  list_position([{', '.join(repr(d) for d in DRIVERS)}], variable) AS j FROM long WINDOW w AS (PARTITION BY series_id, variable)""", "long")
cte("drv_m", f"""
SELECT series_id, list(row ORDER BY i) AS m FROM (
  SELECT series_id, i, list_concat(list(c ORDER BY j), list_transform(range(1, {len(DRIVERS) + 1}), lambda q: CASE WHEN q = i THEN 1.0 ELSE 0.0 END)) AS row FROM (
    SELECT series_id, a.j AS i, b.j AS j, avg(a.z * b.z) AS c FROM drv_z a JOIN drv_z b USING (series_id, period) GROUP BY 1, 2, 3) GROUP BY 1, 2) GROUP BY 1""", "drv_z")
gauss("drv_gj", "drv_m", "series_id")
cte("drv_inv", f"SELECT series_id, list_transform(m, lambda r: r[{len(DRIVERS) + 1}:]) AS inv FROM drv_gj WHERE k = {len(DRIVERS)}", "drv_gj")
# Dropping a driver takes its row and column out of the inverse: a rank-one change of the others.
cte("drv_drop", f"""
SELECT series_id, 0 AS step, [{', '.join(repr(d) for d in DRIVERS)}] AS names, inv, CAST(NULL AS VARCHAR) AS gone, CAST(NULL AS DOUBLE) AS gone_vif FROM drv_inv
UNION ALL
SELECT series_id, step + 1, list_filter(names, lambda v, i: i <> w),
  list_transform(list_filter(range(1, len(names) + 1), lambda i: i <> w), lambda i: list_transform(list_filter(range(1, len(names) + 1), lambda j: j <> w),
    lambda j: inv[i][j] - inv[i][w] * inv[w][j] / inv[w][w])), names[w], worst
FROM (SELECT *, list_position(diag, list_max(diag)) AS w, list_max(diag) AS worst FROM (SELECT *, list_transform(inv, lambda r, i: r[i]) AS diag FROM drv_drop))
WHERE worst > 10 AND len(names) > 1""", "drv_inv")
VIF_SQL = f"SELECT series_id, unnest([{', '.join(repr(d) for d in DRIVERS)}]) AS variable, unnest(list_transform(inv, lambda r, i: greatest(r[i], 1.0))) AS vif FROM drv_inv"
VIF_KEPT_SQL = """
SELECT series_id, unnest(names) AS variable, unnest(list_transform(inv, lambda r, i: greatest(r[i], 1.0))) AS vif FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY step DESC) AS last FROM drv_drop) WHERE last = 1"""
VIF_DROPS_SQL = "SELECT series_id, step, gone AS variable, gone_vif AS vif FROM drv_drop WHERE step > 0"
