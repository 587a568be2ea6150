"""Calendar periods as DATE columns: a period is stamped with its first day (weeks on Monday)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.settings import HISTORY_WINDOW, ROLLING_WINDOWS, SEASON_LENGTH

_UNIT = {"M": "month", "W": "week", "Y": "year"}
_STEP = {"M": "INTERVAL 1 MONTH", "W": "INTERVAL 7 DAY", "Y": "INTERVAL 1 YEAR"}


def check_freq(freq: str) -> str:
    """Upper-case and accept M, W or Y only."""
    code = str(freq).strip().upper()
    if code not in _UNIT:
        raise ValueError(f"frequency must be one of M, W, Y, not {freq!r}")
    return code


def freq_params(freq: str) -> dict:
    """Season length, rolling windows and report window of a frequency."""
    code = check_freq(freq)
    short, long = ROLLING_WINDOWS[code]
    return {"freq": code, "season": SEASON_LENGTH[code], "roll_short": short, "roll_long": long,
            "history": HISTORY_WINDOW[code]}


def period_start(ts: Column, freq: str) -> Column:
    return F.trunc(ts.cast("date"), _UNIT[check_freq(freq)])


def period_ordinal(period: Column, freq: str) -> Column:
    """A running number of the period, so that differences count periods."""
    code = check_freq(freq)
    if code == "M":
        n = F.year(period) * 12 + F.month(period) - 1
    elif code == "W":
        n = F.floor(F.datediff(period, F.lit("1970-01-05").cast("date")) / 7)
    else:
        n = F.year(period)
    return n.cast("bigint")


def period_add(period: Column, n: Column | int, freq: str) -> Column:
    code = check_freq(freq)
    n = (n if isinstance(n, Column) else F.lit(n)).cast("int")
    if code == "W":
        return F.date_add(period, n * 7)
    return F.add_months(period, n if code == "M" else n * 12)


def period_range(start: Column, end: Column, freq: str) -> Column:
    """Array of all periods from start to end; empty when end lies before start."""
    steps = F.sequence(start, F.greatest(start, end), F.expr(_STEP[check_freq(freq)]))
    return F.when(end >= start, steps).otherwise(F.array().cast("array<date>"))


def calendar_names(freq: str) -> list[str]:
    return {"M": ["month"], "W": ["week"], "Y": []}[check_freq(freq)] + ["year", "season_sin", "season_cos"]


def calendar_features(period: Column, freq: str) -> list[Column]:
    """Calendar position and its cyclic encoding (ISO week is paired with the calendar year)."""
    code = check_freq(freq)
    year = F.year(period).cast("double").alias("year")
    if code == "Y":
        return [year, F.lit(0.0).alias("season_sin"), F.lit(0.0).alias("season_cos")]
    slot, cycle = (F.month(period), 12) if code == "M" else (F.weekofyear(period), 52)
    angle = slot * F.lit(2 * math.pi) / cycle
    name = "month" if code == "M" else "week"
    return [slot.cast("double").alias(name), year, F.sin(angle).alias("season_sin"), F.cos(angle).alias("season_cos")]
