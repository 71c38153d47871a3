"""Event times, date patterns and index-name formats."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date pattern letters that mean the same in both notations.
DATE_TOKENS = ("yyyy", "yy", "MM", "dd", "HH", "mm", "ss")

# Rolling interval, its date pattern and the digits of its date in a file name.
ROLLING_INTERVALS = {
    "Infinite": ("", 0),
    "Year": ("yyyy", 4),
    "Month": ("yyyyMM", 6),
    "Day": ("yyyyMMdd", 8),
    "Hour": ("yyyyMMddHH", 10),
    "Minute": ("yyyyMMddHHmm", 12),
}

_HOLE = re.compile(r"\{0(?::([^{}]+))?\}")


def iso_time(ts: Column, offset_minutes: Column) -> Column:
    """ISO time with seven fraction digits in the event's own offset."""
    local = ts + F.make_dt_interval(mins=offset_minutes)
    size = F.abs(offset_minutes)
    sign = F.when(offset_minutes < 0, "-").otherwise("+")
    two = lambda number: F.lpad(number.cast("string"), 2, "0")
    return F.concat(
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("0"),
        sign, two(F.floor(size / 60)), F.lit(":"), two(size % 60),
    )


def date_pattern(pattern: str) -> str:
    """Check a date pattern and quote its literal characters for ``date_format``."""
    out, rest = [], pattern
    while rest:
        token = next((t for t in DATE_TOKENS if rest.startswith(t)), None)
        if token:
            out.append(token)
            rest = rest[len(token):]
            if token[-1] == rest[:1]:
                raise ValueError(f"unsupported date pattern {pattern!r}")
        elif rest[0].isalpha():
            raise ValueError(f"unsupported date pattern {pattern!r}")
        else:
            out.append("''" if rest[0] == "'" else f"'{rest[0]}'" if rest[0] in "[]{}#\"" else rest[0])
            rest = rest[1:]
    return "".join(out)


def formatted_name(name_format: str, ts: Column) -> Column:
    """A name such as ``logs-{0:yyyy.MM.dd}`` for a UTC time."""
    parts, at = [], 0
    for hole in _HOLE.finditer(name_format):
        if hole.group(1) is None:
            raise ValueError(f"the date in {name_format!r} needs a pattern")
        parts += [F.lit(name_format[at:hole.start()]), F.date_format(ts, date_pattern(hole.group(1)))]
        at = hole.end()
    return F.concat(*parts, F.lit(name_format[at:]))


def wildcard_of(name_format: Column) -> Column:
    """The pattern that covers every name a format can give."""
    return F.regexp_replace(name_format, r"^(.*)(?:\{0:.+\})(.*)$", "$1*$2")


def file_date(file_name: Column, interval: str = "Day") -> Column:
    """The date in ``<anything>-<date>[_n].json``; null when the name is not of that form."""
    pattern, digits = ROLLING_INTERVALS[interval]
    last = F.element_at(F.split(file_name, "-"), -1)
    named = F.lower(last).endswith(".json")
    return F.when(named, F.try_to_timestamp(F.substring(last, 1, digits), F.lit(pattern)))
