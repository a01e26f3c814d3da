"""Configuration objects passed to operators.

Everything that the original tool hard-coded for 10-minute telecom bins
(step, bins per day / week, time zone, split dates, thresholds) is a field
here, so the same operator runs on 10-minute cells, hourly event counts or
daily order totals.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime


@dataclass(frozen=True)
class SeriesSpec:
    """Column names and calendar of a long-format series table.

    A series table has one row per (entity, ts) with a numeric value.
    ``step`` is the bin width in seconds, ``daily`` / ``weekly`` the number of
    bins in a day / week (144 / 1008 for 10-minute bins, 24 / 168 hourly).
    ``long`` says that a series may be too long for one task (more than some millions of
    steps): windows then work on chunks of it, at the price of one more shuffle; rows are the same.
    """

    entity: str = "square_id"
    ts: str = "ts"
    value: str = "value"
    step: int = 600
    daily: int = 144
    weekly: int = 1008
    tz: str = "Europe/Rome"
    long: bool = False

    def with_(self, **kw) -> "SeriesSpec":
        return replace(self, **kw)


TELECOM = SeriesSpec()
HOURLY = SeriesSpec(entity="entity", ts="ts", value="value", step=3600, daily=24, weekly=168, tz="UTC")
DAILY = SeriesSpec(entity="entity", ts="ts", value="value", step=86400, daily=1, weekly=7, tz="UTC")


@dataclass(frozen=True)
class Split:
    """Inclusive train / validation / test windows (wall-clock bounds)."""

    train_start: datetime
    train_end: datetime
    val_start: datetime
    val_end: datetime
    test_start: datetime
    test_end: datetime


# Default evaluation calendar of the telecom data set.
TELECOM_SPLIT = Split(
    train_start=datetime(2013, 11, 1, 0, 0),
    train_end=datetime(2013, 12, 9, 23, 50),
    val_start=datetime(2013, 12, 10, 0, 0),
    val_end=datetime(2013, 12, 15, 23, 50),
    test_start=datetime(2013, 12, 16, 0, 0),
    test_end=datetime(2013, 12, 22, 23, 50),
)

# Split used on the driver's events table (hourly bins, 2024-01-01..30).
EVENTS_SPLIT = Split(
    train_start=datetime(2024, 1, 1, 0, 0),
    train_end=datetime(2024, 1, 20, 23, 0),
    val_start=datetime(2024, 1, 21, 0, 0),
    val_end=datetime(2024, 1, 23, 23, 0),
    test_start=datetime(2024, 1, 24, 0, 0),
    test_end=datetime(2024, 1, 30, 23, 0),
)


@dataclass(frozen=True)
class IngestConfig:
    tz: str = "Europe/Rome"
    # Expected calendar for the manifest and the missing days; None: first to last file.
    expected_first_date: str | None = None
    expected_last_date: str | None = None
    max_square_id: int | None = None  # None: any id from 0 on
    on_bad_row: str = "quarantine"  # skip | quarantine | fail (the default config enables quarantine)
    compression: str = "snappy"


# Fixed value: expected calendar of the published archive.
ARCHIVE_INGEST = IngestConfig(expected_first_date="2013-11-01", expected_last_date="2013-12-30")


# The defaults below (EDA windows and thresholds, evaluation
# settings, Fourier + ARMA orders and terms) are those of the original
# configuration, so default runs compute the same quantities.
@dataclass(frozen=True)
class EdaConfig:
    rolling_window: int = 144
    outlier_z: float = 4.0
    drop_threshold: float = 0.6
    drop_min_run: int = 6


@dataclass(frozen=True)
class EvalConfig:
    mape_epsilon: float = 1e-3
    metric_decimals: int = 4
    failure_window: int = 6
    failure_multiplier: float = 2.0


@dataclass(frozen=True)
class DhrConfig:
    """Fourier + ARMA(p, d, q) dynamic harmonic regression settings."""

    p: int = 2
    d: int = 0
    q: int = 2
    daily_terms: int = 4
    weekly_terms: int = 3
    use_log1p: bool = True
    intercept: bool = True
    css_iterations: int = 20


@dataclass(frozen=True)
class Config:
    ingest: IngestConfig = field(default_factory=IngestConfig)
    eda: EdaConfig = field(default_factory=EdaConfig)
    eval: EvalConfig = field(default_factory=EvalConfig)
    dhr: DhrConfig = field(default_factory=DhrConfig)
    split: Split = TELECOM_SPLIT
    seed: int = 20251201
