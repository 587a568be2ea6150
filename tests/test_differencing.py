"""KPSS and seasonal strength against plain versions, and the orders they choose."""

import datetime as dt

import numpy as np
import pytest

from tidemark.operators import differencing as D


def plain_kpss(y):
    n, e = len(y), y - y.mean()
    lags = int(3 * np.sqrt(n) / 13)
    long_run = (e @ e + 2 * sum((1 - k / (lags + 1)) * (e[k:] @ e[:-k]) for k in range(1, lags + 1))) / n
    return (np.cumsum(e) ** 2).sum() / (n * n * long_run)


def paths():
    rng = np.random.default_rng(2)
    t, wave = np.arange(96), np.sin(np.arange(96) * np.pi / 6)
    return {"noise": rng.normal(size=96), "walk": np.cumsum(rng.normal(size=96)), "season": 5 * wave + rng.normal(size=96) * 0.3,
            "trend": 0.5 * t + rng.normal(size=96) * 0.2, "curve": 0.02 * t**2 + 0.01 * rng.normal(size=96), "flat": np.full(96, 7.0), "short": np.array([1.0, 2, 4, 3, 5])}


@pytest.fixture(scope="module")
def rows(spark):
    flat = [(k, dt.date(2015 + i // 12, i % 12 + 1, 1), float(v)) for k, y in paths().items() for i, v in enumerate(y)]
    return spark.createDataFrame(flat + [("noise", dt.date(2040, 1, 1), None)], "id string, period date, value double")


def test_statistics_are_the_plain_ones(rows):
    got = {r.id: r for r in D.kpss(rows, ["id"]).collect()}
    for k, y in paths().items():
        assert got[k].n == len(y) and got[k].kpss == pytest.approx(0.0 if k == "flat" else plain_kpss(y), rel=1e-9)


def test_strength_of_seasons(rows):
    got = {r.id: r.strength for r in D.seasonal_strength(rows, ["id"], 12).collect()}
    assert got["season"] > 0.9 and got["noise"] < 0.5 and got["flat"] in (None, 0.0) and got["short"] is None
    y, m = paths()["season"], 12
    trend = np.convolve(y, np.r_[0.5, np.ones(11), 0.5] / 12, "valid")
    d = y[6:-6] - trend
    slots = np.arange(6, 90) % m
    r = d - np.array([d[slots == s].mean() for s in slots])
    assert got["season"] == pytest.approx(1 - r.var() / d.var(), rel=1e-9)


def test_orders(rows):
    got = {r.id: (r.seasonal_d, r.d) for r in D.differencing(rows, ["id"], 12).collect()}
    assert got["noise"] == (0, 0) and got["walk"] == (0, 1) and got["trend"] == (0, 1) and got["curve"][1] == 2
    assert got["season"] == (1, 0) and got["flat"] == (0, 0) and got["short"][0] == 0
    odd = {r.id: r.strength for r in D.seasonal_strength(rows, ["id"], 3).collect()}
    assert odd["noise"] is not None and 0 <= odd["noise"] < 0.64
