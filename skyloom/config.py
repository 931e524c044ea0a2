"""Settings of the engine: typed, with defaults, optionally overridden from a YAML file."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from hashlib import sha256
from typing import Any

import yaml


@dataclass(frozen=True)
class Variable:
    """A measured quantity in SI units with its plausible (warning) and hard (blocking) range, both inclusive."""

    name: str
    unit: str
    plausible: tuple[float, float]
    hard: tuple[float, float]


#: The ranges of the four quantities.
VARIABLES = (
    Variable("temperature_2m", "K", (183.15, 333.15), (150.0, 360.0)),
    Variable("dew_point_2m", "K", (173.15, 308.15), (150.0, 330.0)),
    Variable("wind_speed_10m", "m/s", (0.0, 60.0), (0.0, 120.0)),
    Variable("pressure_msl", "Pa", (87_000.0, 108_500.0), (50_000.0, 120_000.0)),
)
#: Thresholds of the three rules, by quantity.
RUN_CHANGE = {"temperature_2m": 3.0, "dew_point_2m": 3.0, "wind_speed_10m": 3.0, "pressure_msl": 500.0}
MODEL_SPREAD = {"temperature_2m": 4.0, "dew_point_2m": 4.0, "wind_speed_10m": 4.0, "pressure_msl": 600.0}
OBSERVATION_MISS = {"temperature_2m": 6.0, "dew_point_2m": 6.0, "wind_speed_10m": 8.0, "pressure_msl": 800.0}


@dataclass(frozen=True)
class Settings:
    tolerance_minutes: int = 30
    min_lead_hours: int = 1
    lookback_hours: int = 1
    lead_days: tuple[int, ...] = (1, 2, 3, 4, 5, 6, 7)
    horizon_hours: int = 48
    min_overlap_hours: int = 24
    critical_factor: float = 2.0
    cadence_hours: int = 6
    miss_max_lead_hours: int = 24
    max_elevation_m: float = 300.0
    observation_stale_hours: float = 3.0
    forecast_stale_hours: float = 14.0
    accuracy_window_days: int = 30
    alert_active_hours: int = 24
    high_confidence_spread: float = 1.5
    medium_confidence_spread: float = 3.0
    retention_months: int | None = None
    run_change: dict[str, float] = field(default_factory=lambda: dict(RUN_CHANGE))
    model_spread: dict[str, float] = field(default_factory=lambda: dict(MODEL_SPREAD))
    observation_miss: dict[str, float] = field(default_factory=lambda: dict(OBSERVATION_MISS))
    variables: tuple[Variable, ...] = VARIABLES

    def fingerprint(self, stations: dict[str, str] | None = None) -> str:
        """Twelve hexadecimal digits that change with whatever changes a verification: tolerance, least lead, place -> station."""
        text = f"{self.tolerance_minutes}|{self.min_lead_hours}|{sorted((stations or {}).items())}"
        return sha256(text.encode()).hexdigest()[:12]


def load_settings(path: str) -> Settings:
    """Settings from a YAML mapping of the same names; an unknown name is an error. ``variables`` is a list of mappings."""
    with open(path) as f:
        raw: dict[str, Any] = yaml.safe_load(f) or {}
    known = {f.name for f in fields(Settings)}
    if unknown := set(raw) - known:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    if "variables" in raw:
        raw["variables"] = tuple(Variable(v["name"], v["unit"], tuple(map(float, v["plausible"])), tuple(map(float, v["hard"]))) for v in raw["variables"])
    if "lead_days" in raw:
        raw["lead_days"] = tuple(raw["lead_days"])
    return replace(Settings(), **raw)


def load_dimension(spark, path: str, key: str):
    """A dimension from a YAML list of mappings (a few hundred rows at most), or from Parquet, CSV or JSON by its ending."""
    if path.endswith((".yaml", ".yml")):
        with open(path) as f:
            rows = yaml.safe_load(f)
        rows = rows if isinstance(rows, list) else next(v for v in rows.values() if isinstance(v, list))
        return spark.createDataFrame(rows).dropDuplicates([key])
    if path.endswith(".csv"):
        return spark.read.csv(path, header=True)
    return spark.read.json(path) if path.endswith(".json") else spark.read.parquet(path)
