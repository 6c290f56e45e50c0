"""Parameters of the edge scorer."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ScorerConfig:
    """Everything that decides a score.

    counts   "exact" keeps one counter per entity, "sketch" a fixed number of Count-Min cells.
    decay    "floor" rounds decayed counters down to whole numbers, "none" keeps them real.
    order    "event_time" scores by (timestamp, event_id); "arrival" by the column ``arrival`` alone, so
             an event whose timestamp lies in an earlier tick is late and counts towards the newest tick.
    arrival  the column that orders arrivals; its values are unique and can be compared.
    hash_fn  hash of the sketch rows, "xxhash64" or "md5".
    """

    width: int = 2000
    depth: int = 5
    tick_seconds: int = 10
    alpha: float = 0.98
    threshold: float = 3.0
    filter_anomalies: bool = False
    filter_cutoff: float = 1e6
    seed: int = 42
    counts: str = "exact"
    decay: str = "floor"
    order: str = "event_time"
    arrival: str = "event_id"
    hash_fn: str = "xxhash64"

    def __post_init__(self) -> None:
        if self.width <= 0 or self.depth <= 0:
            raise ValueError("width and depth must be positive")
        if not 0 <= self.alpha < 1:
            raise ValueError("alpha must lie in [0, 1)")
        if self.tick_seconds <= 0:
            raise ValueError("tick_seconds must be positive")
        if self.threshold < 0:
            raise ValueError("threshold must not be negative")
        for name, allowed in (
            ("counts", ("exact", "sketch")),
            ("decay", ("floor", "none")),
            ("order", ("event_time", "arrival")),
            ("hash_fn", ("xxhash64", "md5")),
        ):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}")
