"""Defaults of the three jobs. Values are fixed by the behaviour being matched."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Season length and (short, long) rolling windows per frequency code.
SEASON_LENGTH = {"M": 12, "W": 52, "Y": 1}
ROLLING_WINDOWS = {"M": (3, 6), "W": (13, 26), "Y": (2, 3)}
HISTORY_WINDOW = {"M": 24, "W": 104, "Y": 2}

# Model names in training order (ties keep this order) and their family.
MODEL_ORDER = (
    "gbt_lgbm", "elasticnet", "gbt_catboost", "gbt_xgboost", "arx", "holtwinters", "theta", "fourier_trend", "twfe", "sysgmm",
    "mg", "amg", "ccemg", "dccemg", "lasso", "rf", "rff_regression",
)
UNIVARIATE_MODELS = ("holtwinters", "theta", "fourier_trend")

DRIVER_MODELS = ("ets", "arima", "theta")


@dataclass(frozen=True)
class Settings:
    """One immutable bundle of thresholds; pass a changed copy with :meth:`with_`."""

    completeness: float = 0.75
    min_observations: int = 60
    max_missing: float = 0.25
    min_correlation: float = 0.2
    max_vif: float = 10.0
    weight_corr: float = 0.20
    weight_mi: float = 0.20
    weight_elasticnet: float = 0.30
    weight_tree: float = 0.30
    min_composite: float = 0.25
    min_selected: int = 5
    n_lags: int = 12
    train_buffer: int = 6
    max_folds: int = 2
    weight_da: float = 0.25
    weight_mape: float = 0.25
    weight_wba: float = 0.50
    band: float = 0.10
    top_k: int = 2
    clamp_sigmas: float = 5.0
    range_margin: float = 0.20
    flat_ratio: float = 0.05
    jump_ratio: float = 0.5
    mi_bins: int = 5
    n_trees: int = 500
    models: tuple[str, ...] = MODEL_ORDER
    seed: int = 42

    def with_(self, **changes) -> "Settings":
        return replace(self, **changes)


DEFAULTS = Settings()
