"""Scalar scoring expressions."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.settings import DEFAULTS, Settings


def finite(value: Column) -> Column:
    """The value, or NULL where it is NaN or infinite."""
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(~bad, value)


def log_target(value: Column) -> Column:
    return F.when(value > 0, F.ln(value))


def exp_back(value: Column) -> Column:
    return F.exp(value)


def percent_error(actual: Column, forecast: Column) -> Column:
    """Absolute error in percent of the signed actual."""
    return F.when(actual != 0, F.abs(actual - forecast) / actual * 100)


def absolute_percentage(actual: Column, forecast: Column) -> Column:
    """Absolute error over the actual, with the machine-epsilon floor on the denominator."""
    return F.abs(actual - forecast) / F.greatest(F.abs(actual), F.lit(sys.float_info.epsilon))


def driver_ape(actual: Column, forecast: Column) -> Column:
    """Driver-side error: zero actuals do not count."""
    return F.when(actual != 0, F.abs(actual - finite(forecast)) / F.abs(actual))


def fqs(da: Column, mape: Column, wba: Column, settings: Settings = DEFAULTS) -> Column:
    """Forecast quality score of fold means."""
    return settings.weight_da * da + settings.weight_mape / (1 + mape) + settings.weight_wba * wba


def clamp(value: Column, mean: Column, sigma: Column, settings: Settings = DEFAULTS) -> Column:
    """Clip to the training band; a non-finite value becomes the mean."""
    reach = settings.clamp_sigmas * F.greatest(sigma, F.lit(1e-6))
    inside = F.least(F.greatest(value, mean - reach), mean + reach)
    return F.when(F.isnan(value) | value.isNull() | (F.abs(value) == F.lit(float("inf"))), mean).otherwise(inside)


def risk_label(score: Column) -> Column:
    return (
        F.when(score <= 20, "Low").when(score <= 40, "Moderate").when(score <= 70, "High").otherwise("Critical")
    )
