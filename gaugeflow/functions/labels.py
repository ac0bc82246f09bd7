"""Labels from numbers and keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_label(col: Column, edges: Sequence[float], labels: Sequence, closed: str = "left") -> Column:
    """Label of the interval that ``col`` falls in.

    ``closed="left"``: a value equal to an edge belongs to the upper interval (``x < edge`` picks the
    lower label). ``closed="right"``: it belongs to the lower interval (``x <= edge``). Null in, null out.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need exactly one label more than edges")
    if list(edges) != sorted(edges):
        raise ValueError("edges must ascend")
    if closed not in ("left", "right"):
        raise ValueError("closed is 'left' or 'right'")
    out = F.when(col.isNull(), F.lit(None))
    for edge, label in zip(edges, labels):
        out = out.when(col < edge if closed == "left" else col <= edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def lookup(col: Column, mapping: Mapping, default=None) -> Column:
    """Value for a key from a fixed mapping, with a default (a literal or a Column).

    For mappings that grow with data use :func:`gaugeflow.operators.schema.lookup_join`.
    """
    literal_map = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    found = F.try_element_at(literal_map, col)
    if default is None:
        return found
    return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def yes_no(condition: Column, labels: tuple[str, str]) -> Column:
    """First label where the condition holds, second otherwise (also when it is null)."""
    return F.when(condition, F.lit(labels[0])).otherwise(F.lit(labels[1]))
