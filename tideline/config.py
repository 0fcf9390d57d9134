"""Names and widths that describe one series table."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Level:
    """One aggregate level: its name, bucket width and stored chunk width.

    ``refresh_start`` / ``refresh_end`` are the offsets of a scheduled refresh
    window behind the reference time (``as_of``).
    """

    name: str
    width: str
    chunk_width: str = "1 day"
    refresh_start: str | None = None
    refresh_end: str | None = None


@dataclass(frozen=True)
class SeriesConfig:
    """Column names and storage intervals of one series table."""

    table: str
    time_col: str = "time"
    series_cols: tuple[str, ...] = ("device_id",)
    value_col: str = "value"
    volume_col: str | None = None
    tiebreak: str | None = None
    chunk_interval: str = "1 day"
    retention: str | None = None
    levels: tuple[Level, ...] = field(default_factory=tuple)

    def level(self, name: str) -> Level:
        for lv in self.levels:
            if lv.name == name:
                return lv
        raise KeyError(f"{self.table} has no level {name!r}")

    def parent_of(self, name: str) -> Level | None:
        """The next coarser level, or None for the coarsest."""
        names = [lv.name for lv in self.levels]
        i = names.index(name)
        return self.levels[i + 1] if i + 1 < len(names) else None


def chain_levels(
    periods: list[str], suffixes: list[str], chunk_widths: list[str] | None = None
) -> tuple[Level, ...]:
    """Levels from parallel lists of bucket widths and name suffixes, fine to coarse."""
    if len(periods) != len(suffixes):
        raise ValueError("periods and suffixes must have the same length")
    chunk_widths = chunk_widths or ["1 day"] * len(periods)
    return tuple(Level(s, p, c) for p, s, c in zip(periods, suffixes, chunk_widths))


TICK_LEVELS = (
    Level("1m", "1 minute", "1 day", "6 minutes", "3 minutes"),
    Level("1h", "1 hour", "1 week", "2 hours", "1 hour"),
    Level("1d", "1 day", "1 month", "36 hours", "12 hours"),
)

SAMPLE_LEVELS = (
    Level("1m", "1 minute", "1 day", "5 minutes", "1 minute"),
    Level("1h", "1 hour", "1 week", "3 hours", "1 hour"),
    Level("1d", "1 day", "1 month", "3 days", "1 hour"),
    Level("monthly", "1 month", "1 month", "3 months", "1 hour"),
)

TICKS = SeriesConfig(
    table="ticks",
    series_cols=("symbol",),
    value_col="price",
    volume_col="volume",
    tiebreak="tick_id",
    chunk_interval="1 day",
    retention="6 months",
    levels=TICK_LEVELS,
)

RATE_LEVELS = chain_levels(
    ["30 seconds", "10 minutes", "1 hour", "6 hours", "2 days"],
    ["30s", "10m", "1h", "6h", "2d"],
    ["1 day", "1 day", "1 week", "1 month", "1 month"],
)

RATES = SeriesConfig(
    table="rates",
    time_col="timestamp",
    series_cols=("from", "to"),
    value_col="ask",
    levels=RATE_LEVELS,
)

SWAPS = SeriesConfig(
    table="swap_events",
    series_cols=("wallet_address", "token_address"),
    value_col="usd_in",
    tiebreak="id",
    chunk_interval="1 week",
    levels=(Level("1h", "1 hour", "1 week", "1 day", "1 hour"),),
)

SAMPLES = SeriesConfig(
    table="sample",
    series_cols=("device_id",),
    value_col="value",
    chunk_interval="1 week",
    retention="5 years",
    levels=SAMPLE_LEVELS,
)
