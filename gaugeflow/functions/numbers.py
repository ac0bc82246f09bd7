"""Numeric column expressions: parsing, missing markers, clamps, rounding, display."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def locale_double(col: Column, decimal: str = ",") -> Column:
    """Text with a locale decimal mark to double; anything unparsable becomes null.

    Uses ``try_cast``: under ANSI mode a plain cast would fail the job. NaN text is treated as
    missing too, so null is the only missing marker downstream.
    """
    number = F.replace(F.trim(col), F.lit(decimal), F.lit(".")).try_cast("double")
    return nan_to_null(number)


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def sentinel_to_null(col: Column, sentinel: float) -> Column:
    return F.nullif(col, F.lit(sentinel))


def default_for_missing(col: Column, default) -> Column:
    return F.coalesce(col, F.lit(default))


def clamp(col: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit to ``[low, high]``; null stays null (``least``/``greatest`` would skip it)."""
    out = None
    for edge, outside in ((high, lambda e: col > e), (low, lambda e: col < e)):
        if edge is not None:
            limit = F.lit(float(edge))
            out = F.when(outside(limit), limit) if out is None else out.when(outside(limit), limit)
    return col if out is None else out.otherwise(col)


#: From here on every double is a whole number.
ALL_WHOLE = 2.0**52


def _nearest_integer(x: Column, digits: int, ties: str) -> Column:
    """Whole number nearest to ``x * 10**digits`` (as a double), decided on the exact binary value.

    Only where the product lands on a half does its rounding error matter. The error is recovered
    there by splitting ``x`` in two halves that multiply exactly, so 2.675 (which is really
    2.67499...) counts as below the tie. ``ties`` settles exact ties: ``even`` or ``up``.
    """
    if ties not in ("even", "up"):
        raise ValueError("ties is 'even' or 'up'")
    scale = F.lit(10.0**digits)

    def settle(v: Column) -> Column:
        product = v * scale
        split = v * F.lit(134217729.0)
        high = split - (split - v)
        error = (high * scale - product) + (v - high) * scale
        exact = F.rint(product) if ties == "even" else product + 0.5
        return F.when(error > 0, product + 0.5).when(error < 0, product - 0.5).otherwise(exact)

    # A lambda binds its argument, so the rare branch holds one copy of ``x`` instead of dozens;
    # repeated copies make generated methods too long for the JIT compiler.
    rare = F.get(F.transform(F.array(x), settle), F.lit(0))
    return F.when(F.abs(x * scale - F.rint(x * scale)) != 0.5, F.rint(x * scale)).otherwise(rare)


def _split_text(size: Column, digits: int, ties: str) -> Column:
    """Decimal text of a number in ``[0, ALL_WHOLE)`` by its whole part and its fraction, both exact; right
    even where ``size * 10**digits`` no longer shows halves."""

    def settle(v: Column) -> Column:
        whole = F.floor(v)
        fraction = v - whole.cast("double")
        if not digits:
            up = (fraction > 0.5) | ((fraction == 0.5) & (F.lit(True) if ties == "up" else whole % 2 == 1))
            return (whole + F.when(up, 1).otherwise(0)).cast("string")
        units = _nearest_integer(fraction, digits, ties).cast("long")  # whole * 10**digits is even: ties hold
        over = units == 10**digits
        shown = F.when(over, 0).otherwise(units).cast("string")
        return F.concat((whole + F.when(over, 1).otherwise(0)).cast("string"), F.lit("."), F.lpad(shown, digits, "0"))

    return F.get(F.transform(F.array(size), settle), F.lit(0))


def round_half_even(col: Column, digits: int) -> Column:
    """Python's ``round`` for ``digits`` >= 0: nearest decimal to the exact binary value, exact ties to even."""
    size = F.abs(col)
    small = size < F.lit(ALL_WHOLE / 10.0**digits)
    by_parts = _split_text(size, digits, "even").cast("double") * F.signum(col)
    return (
        F.when(small, _nearest_integer(col, digits, "even") / F.lit(10.0**digits))
        .when(size < F.lit(ALL_WHOLE), by_parts)
        .otherwise(col)
    )


def round_half_up_integer(col: Column) -> Column:
    """``floor(x + 0.5)``, the browser's integer rounding (so -2.5 becomes -2)."""
    return F.floor(col + F.lit(0.5))


def fixed_text(col: Column, digits: int, ties: str = "up") -> Column:
    """Fixed-point text such as ``3.10``, correctly rounded on the exact binary value; null stays null.

    ``format_string`` alone rounds the shortest decimal text instead, which turns 30.95 (really
    30.9499...) into 31.0 where the browser and Python show 30.9. It serves only numbers without a
    fraction, NaN and infinity; from 2**63 on it fills up with zeros after the shortest digits.
    """
    size = F.abs(col)
    sign = F.when(col < 0, F.lit("-")).otherwise(F.lit(""))
    nearest = _nearest_integer(size, digits, ties) / F.lit(10.0**digits)
    whole = size.try_cast("long").cast("string")
    zeros = F.lit("." + "0" * digits if digits else "")
    return F.when(
        col.isNotNull(),
        F.when(size < F.lit(ALL_WHOLE / 10.0**digits), F.concat(sign, nearest.cast(f"decimal(38,{digits})").cast("string")))
        .when(size < F.lit(ALL_WHOLE), F.concat(sign, _split_text(size, digits, ties)))
        .when(size < F.lit(2.0**63), F.concat(sign, whole, zeros))
        .otherwise(F.format_string(f"%.{digits}f", col)),
    )


def percent_text(col: Column, digits: int = 1) -> Column:
    """Ratio as percent text, ``0.9031 -> 90.3%``."""
    return F.concat(fixed_text(col * F.lit(100.0), digits, "even"), F.lit("%"))


def padded(col: Column, width: int, right_align: bool = False) -> Column:
    """Pad with blanks to ``width``; text longer than ``width`` is kept whole."""
    text = col.cast("string")
    size = F.greatest(F.lit(width), F.length(text))
    return F.lpad(text, size, F.lit(" ")) if right_align else F.rpad(text, size, F.lit(" "))


def display_value(col: Column) -> Column:
    """Two decimals below 10, a whole number from 10 on, ``N/A`` when missing."""
    return (
        F.when(col.isNull(), F.lit("N/A"))
        .when(col < 10, fixed_text(col, 2))
        .otherwise(round_half_up_integer(col).cast("string"))
    )


def scaled(col: Column, factor: float) -> Column:
    """Unit conversion or fixed-ratio proxy."""
    return col * F.lit(float(factor))


def linear_combination(terms: Mapping[str, float], intercept: float = 0.0) -> Column:
    """``intercept + sum(coefficient * column)`` as one plain expression."""
    out = F.lit(float(intercept))
    for name, weight in terms.items():
        out = out + F.col(name) * F.lit(float(weight))
    return out
