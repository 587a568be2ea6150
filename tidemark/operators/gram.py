"""Sufficient statistics of linear fits.

Each design row becomes its packed cross-product, and Spark adds these vectors up (map-side first, in the JVM), so only
one sum per key and task travels. The number of rows behind a key therefore never matters to a single task. Entry (0, 0) is
the row count: a leading 1 stands for the intercept.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _triangle(z: str) -> Column:
    """Upper triangle of the products of an array's entries, row by row."""
    return F.flatten(F.transform(z, lambda a, i: F.transform(F.slice(z, i + 1, F.size(z)), lambda b: a * b)))


def gram(design: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, g): the packed upper triangle of the cross-product of [1, x] per key."""
    clean = design.filter("x IS NOT NULL AND NOT exists(x, v -> v IS NULL)")
    rows = clean.select(*keys, F.concat(F.array(F.lit(1.0)), "x").alias("_z")).select(*keys, array_to_vector(_triangle("_z")).alias("_t"))
    return rows.groupBy(*keys).agg(Summarizer.sum(F.col("_t")).alias("_s")).select(*keys, vector_to_array("_s").alias("g"))


def gram_entries(design: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, p, pos, i, j, s): the same sums, one row per entry."""
    p = (F.sqrt(8 * F.size("g") + 1) - 1) / 2
    sums = gram(design, keys).select(*keys, F.round(p).cast("bigint").alias("p"), F.posexplode("g").alias("pos", "s"))
    # Row i of the triangle starts at i*p - i(i-1)/2.
    b = 2 * F.col("p") + 1
    i = F.floor((b - F.sqrt(b * b - 8 * F.col("pos"))) / 2).cast("int")
    sums = sums.withColumn("i", i)
    j = F.col("pos") - (F.col("i") * F.col("p") - F.col("i") * (F.col("i") - 1) / 2) + F.col("i")
    return sums.withColumn("j", j.cast("int"))


# ---- small dense algebra on one key's sums -------------------------------------------------


def unpack(g) -> np.ndarray:
    g = np.asarray(g, dtype=float)
    p = int((np.sqrt(8 * len(g) + 1) - 1) / 2)
    full = np.zeros((p, p))
    full[np.triu_indices(p)] = g
    return full + np.triu(full, 1).T


def moments(full: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, population deviation and correlation-scaled covariance of the columns."""
    mean = full[0, 1:] / full[0, 0]
    cov = full[1:, 1:] / full[0, 0] - np.outer(mean, mean)
    floor = 1e-12 * np.maximum(np.diag(full)[1:] / full[0, 0], 1e-300)
    var = np.diag(cov)
    sd = np.where(var > floor, np.sqrt(np.maximum(var, 0)), 0.0)
    safe = np.where(sd > 0, sd, 1.0)
    corr = np.where(np.outer(sd, sd) > 0, cov / np.outer(safe, safe), 0.0)
    return mean, sd, corr


def min_norm(full: np.ndarray, cutoff: float = 1e-10, ridge: float = 0.0) -> np.ndarray:
    """Least squares of the last column on the others (intercept first); the least-norm
    solution in standardised units when columns are dependent."""
    mean, sd, corr = moments(full)
    p = len(mean) - 1
    values, vectors = np.linalg.eigh(corr[:p, :p])
    keep = values > cutoff * max(values[-1], 1e-300)
    inverse = (vectors[:, keep] / (values[keep] + ridge)) @ vectors[:, keep].T
    beta = inverse @ corr[:p, p] * sd[p] / np.where(sd[:p] > 0, sd[:p], 1.0)
    return np.concatenate([[mean[p] - beta @ mean[:p]], beta])


def with_combination(full: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums after adding a column that is a linear combination of [1, x] before y."""
    size = len(full)
    t = np.insert(np.eye(size), size - 1, np.append(weights, 0.0), axis=0)
    return t @ full @ t.T


def fold_back(beta: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Coefficients on [1, x] that are equivalent to those on [1, x, combination]."""
    return beta[:-1] + beta[-1] * weights


def duality_gap(cov: np.ndarray, w: np.ndarray, lam: float, ratio: float) -> float:
    """How far the penalised loss of w can be above the least one, as a share of the target's variance.

    ``cov`` holds the second moments of [columns, target]; the loss is half the mean squared residual plus
    lam * (ratio * |w|_1 + (1 - ratio) / 2 * |w|_2^2).
    """
    c, b, yy = cov[:-1, :-1], cov[:-1, -1], cov[-1, -1]
    residual = max(yy - 2 * b @ w + w @ c @ w, 0.0)
    l1, l2 = lam * ratio, lam * (1 - ratio)
    slope = np.max(np.abs(b - c @ w - l2 * w)) if len(w) else 0.0
    # The largest multiple of the residual that is feasible in the dual problem.
    scale = min(1.0, l1 / slope) if slope > 0 else 1.0
    gap = 0.5 * residual * (1 + scale * scale) + l1 * np.abs(w).sum() - scale * (yy - b @ w) + 0.5 * l2 * (1 + scale * scale) * (w @ w)
    return float(gap / max(yy, 1e-300))


def polished(cov: np.ndarray, w: np.ndarray, lam: float, ratio: float) -> np.ndarray:
    """The exact solution for the signs of w, if it keeps them; else w."""
    active = np.flatnonzero(w)
    if not len(active):
        return w
    c = cov[np.ix_(active, active)] + lam * (1 - ratio) * np.eye(len(active))
    out = np.zeros_like(w)
    out[active] = np.linalg.lstsq(c, cov[active, -1] - lam * ratio * np.sign(w[active]), rcond=None)[0]
    return out if (np.sign(out) == np.sign(w)).all() else w


GAP = 1e-8


def elastic_net_cv(segments: list[np.ndarray], ratios: Sequence[float], **limits) -> np.ndarray:
    """Intercept and coefficients of ``elastic_net_fit``."""
    return elastic_net_fit(segments, ratios, **limits)[0]


def elastic_net_fit(segments: list[np.ndarray], ratios: Sequence[float], n_alphas: int = 100, eps: float = 1e-3,
                    steps: int = 500, tol: float = 1e-6) -> tuple[np.ndarray, float, float, float]:
    """Cross-validated elastic net on standardised columns from the sums of time segments.

    Returns intercept and coefficients, the penalty, its mixing ratio and the duality gap. The last fit goes on until the
    gap is at most GAP of the target's variance. Segment 0 starts the first training slice and segment k is the k-th test slice, so
    every slice is a running total. All penalties and slices advance together.
    """
    total = np.sum(segments, axis=0)
    mean, sd, _ = moments(total)
    p = len(mean) - 1
    scale = np.ones(p + 2)
    scale[1:-1] = 1 / np.where(sd[:p] > 0, sd[:p], 1.0)
    shift = np.eye(p + 2)
    shift[1:-1, 0] = -mean[:p]
    to_std = np.diag(scale) @ shift
    std = [to_std @ s @ to_std.T for s in segments]

    def centred(s):
        m = s[0, 1:] / s[0, 0]
        return s[1:, 1:] / s[0, 0] - np.outer(m, m), m

    full_cov, full_mean = centred(np.sum(std, axis=0))
    peak = np.max(np.abs(full_cov[:p, p]))
    if not peak > 0:
        return np.concatenate([[full_mean[p]], np.zeros(p)]), 0.0, 1.0, 0.0
    grid = np.array([(r, a) for r in ratios for a in np.geomspace(peak / r, peak / r * eps, n_alphas)])
    trains = [np.sum(std[: k + 1], axis=0) for k in range(len(std) - 1)]
    covs, means = zip(*[centred(s) for s in trains]) if trains else ((), ())

    def descend(cov, lam, ratio, steps):
        """Accelerated proximal gradient for every (slice, penalty) at once, with restarts."""
        c, target = cov[:, :p, :p], cov[:, :p, p, None]
        rate = 1 / np.maximum(np.linalg.eigvalsh(c)[:, -1], 1e-12)[:, None, None]
        l1, shrink = rate * (lam * ratio), 1 / (1 + rate * (lam * (1 - ratio)))
        out = np.zeros((len(cov), p, len(lam)))
        live, limit = np.arange(len(lam)), tol * np.sqrt(max(full_cov[p, p], 1e-300))
        w = out.copy()
        v, t = w, np.ones((len(cov), 1, len(lam)))
        for turn in range(1, steps + 1):
            u = v - rate * (c @ v - target)
            new = np.sign(u) * np.maximum(np.abs(u) - l1, 0) * shrink
            delta = new - w
            back = np.sum((v - new) * delta, axis=1, keepdims=True) > 0
            t_new = np.where(back, 1.0, (1 + np.sqrt(1 + 4 * t * t)) / 2)
            v = new + np.where(back, 0.0, (t - 1) / t_new) * delta
            w, t = new, t_new
            if turn % 10 == 0 or turn == steps:
                open_ = np.max(np.abs(delta), axis=(0, 1)) > limit
                out[:, :, live[~open_]] = w[:, :, ~open_]
                if not open_.any():
                    return out
                live, w, v, t, l1, shrink = live[open_], *[a[..., open_] for a in (w, v, t, l1, shrink)]
        out[:, :, live] = w
        return out

    best = 0
    if trains:
        w = descend(np.stack(covs), grid[:, 1], grid[:, 0], steps)
        mse = np.zeros(len(grid))
        for k, test in enumerate(std[1:]):
            b = np.vstack([means[k][p] - means[k][:p] @ w[k], w[k]])
            sse = test[-1, -1] - 2 * b.T @ test[:-1, -1] + np.einsum("ib,ij,jb->b", b, test[:-1, :-1], b)
            mse += sse / test[0, 0] / len(trains)
        best = int(np.argmin(mse))
    ratio, lam = grid[best]
    for more in (1, 4, 20, 80):
        coef = descend(full_cov[None], np.array([lam]), np.array([ratio]), more * steps)[0, :, 0]
        exact = polished(full_cov, coef, lam, ratio)
        gap, coef = min(((duality_gap(full_cov, v, lam, ratio), v) for v in (exact, coef)), key=lambda x: x[0])
        if gap <= GAP:
            break
        tol /= 100
    return np.concatenate([[full_mean[p] - full_mean[:p] @ coef], coef]), float(lam), float(ratio), gap


def unscale(beta: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Coefficients on standardised columns to coefficients on the columns themselves."""
    mean, sd, _ = moments(total)
    raw = beta[1:] / np.where(sd[:-1] > 0, sd[:-1], 1.0)
    return np.concatenate([[beta[0] - raw @ mean[:-1]], raw])
