"""Settings of a deployment, passed into the jobs; nothing reads the clock or the environment."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    as_of: dt.date = dt.date(2024, 1, 16)
    city: str = "Springfield"
    geocode_suffix: str = "Springfield, UK"
    timezone: str = "Europe/London"
    window_weeks: int = 6
    cost_limit: float = 30.0
    cheap_limit: float = 15.0
    far_minutes: int = 45
    park_minutes: int = 50
    cache_days: int = 90
    cycle_shown: int = 25
    walk_shown: int = 20
    borderline_share: float = 0.30
    borderline_least: int = 10
    review_batch: int = 20
    enrich_batch: int = 10
    warn_volume: int = 300
    abort_volume: int = 600
    thin_chars: int = 200
    match_confidence: float = 0.70
    blocked_domains: tuple[str, ...] = ("example.net",)
    extra_personal: tuple[str, ...] = field(default=())


DEFAULT = Settings()
