"""Fixed-width little-endian unsigned integers as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_UINT32 = 2**32 - 1


def _swap(hex_text: Column) -> Column:
    return F.concat(*[F.substring(hex_text, start, 2) for start in (7, 5, 3, 1)])


def uint32_to_bytes(col: Column) -> Column:
    """Integer to four little-endian bytes; out-of-range input fails the job."""
    packed = F.unhex(_swap(F.lpad(F.hex(col.cast("long")), 8, "0")))
    message = F.concat(F.lit("not an unsigned 32-bit value: "), col.cast("string"))
    return (
        F.when(col.isNull(), F.lit(None).cast("binary"))
        .when(col.between(0, MAX_UINT32), packed)
        .otherwise(F.raise_error(message).cast("binary"))
    )


def bytes_to_uint32(col: Column) -> Column:
    """Four little-endian bytes to a long; another length fails the job."""
    value = F.conv(_swap(F.hex(col)), 16, 10).cast("long")
    message = F.concat(F.lit("not a 4-byte record: "), F.hex(col))
    return (
        F.when(col.isNull(), F.lit(None).cast("long"))
        .when(F.octet_length(col) == 4, value)
        .otherwise(F.raise_error(message).cast("long"))
    )
