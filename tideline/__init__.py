"""Time-series analytics for market ticks and device samples, as Spark jobs."""

from tideline.config import Level, SeriesConfig

__all__ = ["Level", "SeriesConfig"]
