"""The few numbers the results depend on."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    """Thresholds and allowances, read at query time and stored in no row."""

    # A record that vanished further than this ahead of its prediction was
    # pulled, not reached.
    arrival_grace_seconds: int = 120
    # Gaps outside this range are not headways. Both ends are inclusive.
    min_headway_minutes: float = 0.5
    max_headway_minutes: float = 60.0
    # How far an incremental run steps back to pick up rows that landed late.
    incremental_lookback_hours: int = 3
    # The wall clock riders read.
    service_zone: str = "America/New_York"

    @property
    def lookback_seconds(self) -> int:
        return self.incremental_lookback_hours * 3600


DEFAULTS = Params()
