"""Typed settings of a deployment."""

from __future__ import annotations

from dataclasses import dataclass, field

# The published defaults of the forecasting job.
LAGS_H = (48, 72, 168, 336, 504)
MIN_LAG_H = 48
ROLL_WIDTH_H = 168
ROLL_LEAST_H = 120
COOLING_BASE_C = 20.0
HEATING_BASE_C = 12.0
COOLING_KNOT_C = 24.4
TREND_ORIGIN = "2024-01-01"
MIN_GROWTH_DAYS = 548
EVENT_TYPES = ("structural", "operational", "weather")


@dataclass(frozen=True)
class Quality:
    demand_min: float = 0.0
    demand_max: float = 200000.0
    temperature_min: float = 0.0
    temperature_max: float = 50.0
    max_missing_pct: float = 2.0
    max_missing_hours: int = 3
    stuck_hours: int = 3


@dataclass(frozen=True)
class Decisions:
    min_improvement_pct: float = 1.0
    max_acceptable_mape: float = 15.0
    degradation_factor: float = 1.25
    degradation_days: int = 3
    min_fresh_days: int = 7


@dataclass(frozen=True)
class Forecast:
    timezone: str = "Asia/Dubai"
    issue_hour: int = 5
    horizon_hours: int = 24
    min_lag_hours: int = MIN_LAG_H


@dataclass(frozen=True)
class Training:
    candidates: tuple[str, ...] = ("seasonal_naive_168", "ridge_fourier", "gbt", "gbt_trend",
                                   "ridge_interactions", "blend_ridge_gbt")
    holdout_days: int = 28
    ridge_alpha: float = 1.0
    gbt: dict = field(default_factory=lambda: {"maxIter": 40, "stepSize": 0.1, "maxDepth": 5,
                                               "subsamplingRate": 0.8, "seed": 42})


@dataclass(frozen=True)
class Project:
    """``root`` is the folder of all tables; ``series_keys`` name the series columns ([] = one series)."""

    root: str
    env: str = "dev"
    model_name: str = "demand_forecast"
    series_keys: tuple[str, ...] = ()
    history_start: str = "2024-01-01"
    history_end: str = "2026-09-19"
    quality: Quality = field(default_factory=Quality)
    decisions: Decisions = field(default_factory=Decisions)
    forecast: Forecast = field(default_factory=Forecast)
    training: Training = field(default_factory=Training)

    def path(self, table: str) -> str:
        """Folder of a ``layer.name`` table."""
        layer, name = table.split(".", 1)
        return f"{self.root}/{layer}/{name}"


# The three deployments and the history each one starts from.
ENVIRONMENTS = {
    "dev": {"history_start": "2026-01-01", "history_end": "2026-06-30", "refresh_days": 180},
    "qa": {"history_start": "2024-09-15", "history_end": "2026-09-19", "refresh_days": 730},
    "prod": {"history_start": "2024-01-01", "history_end": "2026-09-19", "refresh_days": 0},
}


def load(root: str, env: str = "dev", **overrides) -> Project:
    """The project settings of an environment; an unknown environment raises."""
    if env not in ENVIRONMENTS:
        raise ValueError(f"unknown environment {env!r}; use one of {sorted(ENVIRONMENTS)}")
    span = {k: ENVIRONMENTS[env][k] for k in ("history_start", "history_end")}
    return Project(root=root, env=env, **{**span, **overrides})
