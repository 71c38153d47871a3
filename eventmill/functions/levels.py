"""Log levels, lowest first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Level names in rank order, 0 to 5.
LEVELS = ("Verbose", "Debug", "Information", "Warning", "Error", "Fatal")


def level_rank(level: Column) -> Column:
    """Rank of a level name; null for an unknown name."""
    rank = F.when(level == LEVELS[0], 0)
    for number, name in enumerate(LEVELS[1:], start=1):
        rank = rank.when(level == name, number)
    return rank


def levels_from(minimum: str) -> list[str]:
    """The names at or above ``minimum``."""
    return list(LEVELS[LEVELS.index(minimum):])


def level_at_least(level: Column, minimum: str) -> Column:
    """As a name list, so that it reaches a scan that stores level names."""
    return level.isin(levels_from(minimum))
