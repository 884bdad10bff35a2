"""Column names and bar interval shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class BarSpec:
    """Names the columns of a bar table; ``interval_ms`` is the grid spacing of ``time``."""

    key: str = "symbol"
    time: str = "open_time"
    open: str = "open"
    high: str = "high"
    low: str = "low"
    close: str = "close"
    volume: str = "volume"
    month: str = "year_month"
    interval_ms: int = 60_000

    @property
    def key_fields(self) -> list[str]:
        """The columns a sound bar must have."""
        return [self.key, self.time, self.open, self.high, self.low, self.close, self.volume]
