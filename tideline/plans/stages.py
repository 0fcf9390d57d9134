"""Levels stored step by step, for reports that read several of them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from tideline.session import stored


def stored_levels(
    raw: DataFrame,
    widths: Sequence[str],
    build: Callable[[DataFrame, str], DataFrame],
    merge: Callable[[DataFrame, str], DataFrame],
) -> list[DataFrame]:
    """Finest level from the raw rows, every next one from the level before it."""
    levels = [stored(build(raw, widths[0]), "level")]
    for width in widths[1:]:
        levels.append(stored(merge(levels[-1], width), "level"))
    return levels
