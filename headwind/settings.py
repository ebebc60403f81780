"""Every threshold of the library in one immutable value that callers may replace."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Area:
    """Box a plausible position has to lie in."""

    min_lat: float = 39.3
    max_lat: float = 40.4
    min_lon: float = -105.5
    max_lon: float = -104.4


@dataclass(frozen=True)
class Settings:
    local_zone: str = "America/Denver"
    # labels
    label_max_lead_s: int = 120
    late_after_s: int = 300
    # of the quantile sketches in the hourly report; larger is more exact
    sketch_size: int = 200
    max_abs_delay_s: int = 7200
    area: Area = Area()
    rail_route_types: tuple[int, ...] = (0, 1, 2)
    # features
    horizons: tuple[int, ...] = (1, 5, 10, 20)
    trend_stops: int = 3
    history_days: int = 7
    no_ahead_age_s: int = 3600
    # fixed values: public holidays inside the collection window
    holidays: tuple[str, ...] = (
        "2026-10-12",
        "2026-11-11",
        "2026-11-26",
        "2026-12-25",
        "2027-01-01",
    )
    # evaluation
    test_days: int = 7
    min_days: int = 21
    # blocks before the held-out window on which candidate models are compared, and their days
    selection_blocks: int = 2
    selection_days: int = 5
    # model fits that run side by side; many small jobs each, which leave executors waiting
    fits_at_once: int = 4
    # live serving
    live_anchor_max_age_s: int = 1800
    live_vehicle_max_age_s: int = 900
    monitoring_days: int = 30
    # coverage
    gap_after_s: int = 300
    # streaming
    watermark: str = "2 hours"
    # snapshot files that one micro-batch decodes; paces a backlog, never drops
    files_per_batch: int = 1000
    # hash buckets of the alert history; a burst rewrites those that its alerts fall into
    alert_buckets: int = 64
    # service dates that are labelled together; paces a backlog of dates, never drops
    days_per_pass: int = 31
    # width of one time slice in the hot-key-safe ordered operators
    slice_s: int = 3600


DEFAULTS = Settings()
