"""Cleaning jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import presets
from ..functions import clock, numbers
from ..operators import filters, quality, schema
from ..operators.schema import quoted


@dataclass(frozen=True)
class ColumnProfile:
    """Row count, and per column the null fraction and the mean, from one aggregate job."""

    rows: int
    fractions: Mapping[str, float]
    means: Mapping[str, float | None]


def profile_columns(df: DataFrame, columns: Sequence[str]) -> ColumnProfile:
    measures = [F.count(F.lit(1))]
    for name in columns:
        c = F.col(quoted(name))
        measures += [F.count(c), F.avg(c)]
    rows, *values = df.agg(*[m.alias(f"m{i}") for i, m in enumerate(measures)]).first()
    present, means = values[0::2], values[1::2]
    return ColumnProfile(
        rows,
        {c: (1 - n / rows if rows else 0.0) for c, n in zip(columns, present)},
        dict(zip(columns, means)),
    )


def clean_readings(
    raw: DataFrame,
    numeric: Sequence[str] = tuple(presets.SENSOR_NUMERIC),
    renames: Mapping[str, str] = presets.SENSOR_RENAMES,
    target: str | None = "CO_GT",
    time_column: str = "Time",
    sentinel: float = presets.SENTINEL,
    threshold: float = presets.SPARSE_THRESHOLD,
    rush_ranges: Sequence[tuple[int, int]] = tuple(presets.RUSH_PIPELINE),
    filter_first: bool = True,
) -> tuple[DataFrame, ColumnProfile]:
    """Raw text readings to a typed, imputed table with ``Hour`` and ``IsRushHour``.

    With ``filter_first`` blank rows and rows without a target are removed before the profile.
    ``filter_first=False`` imputes first, which fills the target of such rows with its mean and makes
    the later target filter a no-op. Two passes over the input: one profile aggregate, one write.
    """
    df = schema.drop_unnamed(schema.rename_columns(raw, renames))
    df = quality.null_out_sentinel(quality.repair_decimals(df, numeric), numeric, sentinel)
    if filter_first:
        df = filters.drop_blank_rows(df)
        if target is not None:
            df = filters.require_target(df, target)
    listed = quality.present(df, numeric)
    profile = profile_columns(df, listed)
    sparse = [c for c in listed if profile.fractions[c] > threshold]
    kept = [c for c in listed if c not in sparse]
    hour = clock.hour_from_prefix(F.col(quoted(time_column)))
    filled = {
        c: numbers.default_for_missing(F.col(quoted(c)), profile.means[c])
        for c in kept
        if profile.means[c] is not None
    }
    df = df.drop(*sparse).withColumns({**filled, "Hour": hour, "IsRushHour": clock.rush_flag(hour, rush_ranges)})
    if not filter_first and target is not None and target in df.columns:
        df = filters.require_target(df, target)
    return df, profile


def clean_for_exploration(
    raw: DataFrame,
    numeric: Sequence[str],
    time_column: str = "Time",
    sentinel: float = presets.SENTINEL,
    rush_ranges: Sequence[tuple[int, int]] = tuple(presets.RUSH_SERVICE),
) -> tuple[DataFrame, dict[str, int]]:
    """Cleaning that keeps sparse columns: drop empty columns and rows, impute, flag rush hours.

    Returns the frame and the missing count of each column that has missing values, blank rows not
    counted. ``numeric`` columns must be numeric already (see ``read_decimal_comma``).
    """
    named = schema.drop_all_null_columns(raw)
    kept = quality.present(named, numeric)
    df = quality.null_out_sentinel(filters.drop_blank_rows(named), kept, sentinel)
    profile = profile_columns(df, kept)
    missing = {c: round(profile.fractions[c] * profile.rows) for c in kept}
    filled = {
        c: numbers.default_for_missing(F.col(quoted(c)), profile.means[c]) for c in kept if profile.means[c] is not None
    }
    hour = clock.hour_from_parts(F.col(quoted(time_column)))
    df = df.withColumns({**filled, "is_rush_hour": clock.rush_flag(hour, rush_ranges)})
    return df, {c: n for c, n in missing.items() if n}
