"""Column roles and time settings passed to the operators.

The reference keeps these as notebook globals; here they are explicit values
handed to each operator so that nothing is read from a global.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Roles:
    """Which wide-table columns are sensors, alarm words and engines."""

    sensors: tuple[str, ...] = ()
    alarms: tuple[str, ...] = ()
    engines: tuple[str, ...] = ()
    device_col: str = "hwid"
    time_col: str = "when"

    @property
    def all_metrics(self) -> tuple[str, ...]:
        return tuple(self.sensors) + tuple(self.alarms) + tuple(self.engines)


@dataclass(frozen=True)
class Settings:
    """Time settings in seconds (minutes where the name says so)."""

    grid_interval: int = 60
    block_gap: int = 30 * 60
    fill_gap: int = 4 * 60
    switch_separator: int = 30 * 60
    switch_threshold: int = 8
    lookahead_minutes: int = 30
    min_heat_block: int = 31
    rolling_minutes: int = 4 * 60
    # Rows of one key are split into time buckets of this width for the
    # sequential operators (see operators/sequence.py).
    split_seconds: int = 7 * 24 * 3600
    extra: dict = field(default_factory=dict)


# Fixed values of the reference: the alarm bits that mean overheating
# (bit 1 is the least significant bit) and the alarm words they are read from.
OVERHEATING_BITS = (6, 7, 8)
ALARM_WORDS = ("A5", "A9")

# Fixed values of the reference: row-count labels of the event-block size
# report, in report order, with their closed ranges.
SIZE_BUCKETS = (
    ("1-30", 1, 30),
    ("31-100", 31, 100),
    ("101-500", 101, 500),
    ("501-1000", 501, 1000),
    ("1001-1500", 1001, 1500),
    ("1501-2000", 1501, 2000),
    ("2001-4000", 2001, 4000),
)
SIZE_BUCKET_OVER = ">4000"
SIZE_BUCKET_OTHER = "Other"
