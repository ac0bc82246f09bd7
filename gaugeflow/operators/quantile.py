"""Exact order statistics by radix: four histograms of 16 bits, whatever the values."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise, release, ship_package
from .schema import quoted

#: Bits settled by a scan.
DIGIT = 16


def _ordered(x: np.ndarray) -> np.ndarray:
    """Doubles as longs in the same order."""
    bits = (x + 0.0).view(np.int64)  # one zero
    return np.where(bits < 0, bits ^ np.int64(2**63 - 1), bits)


def _double(bits: int) -> float:
    return float(np.array([bits if bits >= 0 else bits ^ (2**63 - 1)], np.int64).view(np.float64)[0])


def _to_longs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.record_batch([pa.array(_ordered(batch.column(0).to_numpy()))], names=["bits"])


def _values_at(narrow: DataFrame, total: int, ranks: Sequence[int]) -> list[float]:
    """Values at 0-based ranks of the longs in ``narrow``. A scan counts the next digit of the values that
    agree with a rank's digits so far; tasks count before anything is shuffled, and at most ``2 ** DIGIT``
    counts per rank come back."""
    found = [(0, rank) for rank in ranks]  # digits so far, rank among the values that have them
    for turn in range(64 // DIGIT):
        shift = 64 - DIGIT * (turn + 1)
        high, digit = F.shiftright("bits", shift + DIGIT), F.shiftright("bits", shift)
        digit = digit if not turn else digit.bitwiseAND(F.lit((1 << DIGIT) - 1))  # the first has the sign
        prefixes = sorted({p for p, _ in found})
        group = F.lit(0) if not turn else F.when(high == prefixes[0], 0).when(high == prefixes[-1], len(prefixes) - 1)
        counts = narrow.groupBy(group.alias("g"), digit.alias("digit")).agg(F.count(F.lit(1)).alias("n")).where("g IS NOT NULL").toArrow()
        g, digits, n = (counts.column(c).to_numpy() for c in ("g", "digit", "n"))
        for i, (prefix, rank) in enumerate(found):
            own = g == prefixes.index(prefix)
            order = np.argsort(digits[own])
            upto = np.cumsum(n[own][order])
            at = int(np.searchsorted(upto, rank, "right"))
            found[i] = ((prefix << DIGIT if turn else 0) + int(digits[own][order][at]), rank - int(upto[at - 1] if at else 0))
    return [_double(bits) for bits, _ in found]


def exact_median(df: DataFrame, column: str) -> float | None:
    """Median with the two middle values averaged; nulls and NaN are ignored; ``None`` without values.

    ``percentile``/``median`` keep every distinct value of the group in one reducer, which a large column
    does not survive. Here the input is scanned once, into a table of one long per value that keeps the order
    of doubles, and four counting scans of that table find both middle values bit by bit: the same number of
    jobs for any number of rows and any values, ties and infinities included.
    """
    ship_package(df.sparkSession)
    x = F.col(quoted(column)).cast("double")
    values = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    narrow = materialise(values.mapInArrow(_to_longs, "bits long"), "values")
    try:
        n = narrow.count()  # from the footers
        if not n:
            return None
        lower, upper = _values_at(narrow, n, [(n - 1) // 2, n // 2])
    finally:
        release(narrow)
    if lower == upper:
        return lower
    middle = (lower + upper) / 2
    return middle if math.isfinite(middle) else lower / 2 + upper / 2
