"""Fixed values of the domain and the parameters of the analysis."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from decimal import Decimal

# Fixed value: marks an event whose zone could not be trusted.
INCONSISTENT_ZONE = "INCONSISTENT"

# Percentiles every duration is reported at.
REPORTED_QUANTILES = (0.5, 0.9, 0.95)


@dataclass(frozen=True)
class WorkingHours:
    """Daily opening time, team-local, the same on every business day."""

    start_hour: int = 8
    end_hour: int = 18

    @property
    def open_minute(self) -> int:
        return self.start_hour * 60

    @property
    def minutes_per_day(self) -> int:
        return (self.end_hour - self.start_hour) * 60


@dataclass(frozen=True)
class Targets:
    """Service targets in business minutes; more than this is a breach. Fixed values."""

    first_touch_minutes: int = 120
    first_resolution_minutes: int = 1440


@dataclass(frozen=True)
class Staffing:
    """Planned coverage; agents are listed Monday to Sunday. Fixed values.

    Each shift has its share of the day's agents; the shares sum to 1.
    """

    planned_agents: tuple[int, ...] = (38, 36, 34, 34, 30, 6, 4)
    # name, first hour, last hour, share
    shifts: tuple[tuple[str, int, int, float], ...] = (
        ("DAY", 8, 16, 0.65),
        ("SWING", 10, 18, 0.35),
    )
    shrinkage_rate: float = 0.22
    deterioration_days: int = 60
    deterioration_floor: float = 0.85

    def __post_init__(self) -> None:
        total = math.fsum(share for *_, share in self.shifts)
        if not math.isclose(total, 1.0):
            raise ValueError(f"the shares of the shifts sum to {total}, not to 1")


@dataclass(frozen=True)
class Scenarios:
    """What-if levers. Decimals keep the arithmetic exact."""

    tier: str = "TIER_3"
    review_cut: Decimal = Decimal("0.20")
    reopen_cut: Decimal = Decimal("0.25")


@dataclass(frozen=True)
class Settings:
    hours: WorkingHours = field(default_factory=WorkingHours)
    targets: Targets = field(default_factory=Targets)
    staffing: Staffing = field(default_factory=Staffing)
    scenarios: Scenarios = field(default_factory=Scenarios)
    exposure_days: int = 10
    congestion_tiles: int = 10
    # Cases without a customer wait leave the stage table, as published figures expect.
    stages_require_wait: bool = True
    # "inner" drops cases lacking triage or resolution from the SLA table, "left" keeps them.
    sla_mode: str = "inner"
