"""Time-of-day and timestamp expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_from_prefix(col: Column) -> Column:
    """Hour from the first two characters of ``HH.mm.ss`` text; null when they are not a number."""
    return F.substring(col, 1, 2).try_cast("int")


def hour_from_parts(col: Column, separator: str = ".", default: int | None = None) -> Column:
    """Hour from the part before the first separator; ``default`` (if given) replaces a bad value."""
    hour = F.trim(F.split_part(col, F.lit(separator), F.lit(1))).try_cast("int")
    return hour if default is None else F.coalesce(hour, F.lit(default))


def hour_from_iso(col: Column) -> Column:
    """Hour of an ISO-like text such as ``2024-01-05T18:00``; null when it does not parse."""
    return F.hour(F.try_to_timestamp(col))


def in_hour_ranges(hour: Column, ranges: Sequence[tuple[int, int]]) -> Column:
    """True inside any of the inclusive ranges; a null hour is outside all of them."""
    hit = F.lit(False)
    for low, high in ranges:
        hit = hit | hour.between(low, high)
    return F.coalesce(hit, F.lit(False))


def rush_flag(hour: Column, ranges: Sequence[tuple[int, int]]) -> Column:
    """1 inside the given hour ranges, else 0 (also for a null hour)."""
    return in_hour_ranges(hour, ranges).cast("int")


def parse_timestamp(date: Column, time: Column, pattern: str = "dd/MM/yyyy HH.mm.ss") -> Column:
    """Timestamp from separate date and time text; null when they do not parse."""
    return F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit(pattern))
