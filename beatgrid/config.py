"""Typed parameters with the published defaults."""

from __future__ import annotations

from dataclasses import dataclass, field


# The published hotspot defaults.
@dataclass(frozen=True)
class HotspotParams:
    z_threshold: float = 1.5
    quantile: float = 0.75
    window_rows: int = 24
    min_rows: int = 12
    z_digits: int = 9  # z is rounded before the threshold so equal inputs decide equally


# The published cleaning defaults.
@dataclass(frozen=True)
class CleaningParams:
    drop: tuple[str, ...] = ("Crm Cd 1", "Crm Cd 2", "Crm Cd 3", "Crm Cd 4", "Cross Street")
    fill: dict[str, str] = field(
        default_factory=lambda: {
            "Weapon Used Cd": "Weapon Usage Not Known",
            "Weapon Desc": "Unknown",
            "Vict Descent": "X",
            "Premis Desc": "Unknown",
        }
    )
    mode_fill: str = "Mocodes"
    sex_column: str = "Vict Sex"
    sex_values: tuple[str, ...] = ("M", "F", "X")
    sex_unknown: str = "X"
    sex_invalid: str = "-"
    required: tuple[str, ...] = ("Premis Cd", "Status")
    dates: tuple[str, ...] = ("DATE OCC", "Date Rptd")
    date_formats: tuple[str, ...] = (
        "MM/dd/yyyy hh:mm:ss a",
        "yyyy-MM-dd HH:mm:ss",
        "yyyy-MM-dd",
    )
    age_column: str = "Vict Age"
    age_default: float = 30.0
    age_max: float = 100.0
    max_year: int = 2023
    upper: tuple[str, ...] = ("AREA NAME", "Crm Cd Desc", "Status", "Status Desc")


@dataclass(frozen=True)
class WeatherParams:
    features: tuple[str, ...] = ("temp", "wspeed")
    keys: tuple[str, ...] = ("incident_id",)
    fill: str | float = "median"


@dataclass(frozen=True)
class SplitParams:
    train_ratio: float = 0.8
    validation_ratio: float = 0.2


@dataclass(frozen=True)
class GateParams:
    f1_threshold: float = 0.7
    high_risk_below: float = 0.6
