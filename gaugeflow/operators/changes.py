"""Inserts, updates and deletes as copy-on-write DataFrame operators.

Each returns the new content of the table. Write it to a new path; overwriting the path that the same
plan reads would destroy the input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import number_rows


def insert_rows(base: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows by column name; fields missing on either side become null."""
    return base.unionByName(rows, allowMissingColumns=True)


def insert_with_keys(base: DataFrame, rows: DataFrame, key: str, order: str) -> DataFrame:
    """Append rows with generated keys: the largest key so far, plus 1, 2, ... in the unique ``order``."""
    start = base.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    keyed = number_rows(rows.drop(key) if key in rows.columns and key != order else rows, order, "__n")
    return insert_rows(base, keyed.withColumn(key, start + F.col("__n")).drop("__n"))


def _true(predicate: Column) -> Column:
    return F.coalesce(predicate, F.lit(False))


def _assign(df: DataFrame, condition: Column, values: Mapping[str, object]) -> DataFrame:
    fields = {f.name: f.dataType for f in df.schema}
    cast = lambda c, v: (v if isinstance(v, Column) else F.lit(v)).cast(fields[c])
    return df.withColumns({c: F.when(condition, cast(c, v)).otherwise(F.col(c)) for c, v in values.items()})


def update_all(df: DataFrame, predicate: Column, values: Mapping[str, object]) -> DataFrame:
    """Set columns on every matching row. A null predicate does not match."""
    return _assign(df, _true(predicate), values)


def delete_all(df: DataFrame, predicate: Column) -> DataFrame:
    """Remove every matching row. A row whose predicate is null stays."""
    return df.filter(~_true(predicate))


def _first_key(df: DataFrame, predicate: Column, key: str, order: Sequence[str]) -> Column:
    """Key of the first match, as a one-row scalar subquery: an aggregate, not a sort or a window."""
    return df.filter(_true(predicate)).agg(F.min_by(F.col(key), F.struct(*order, key))).scalar()


def update_first(
    df: DataFrame, predicate: Column, values: Mapping[str, object], key: str, order: Sequence[str]
) -> DataFrame:
    """Set columns on the first matching row by ``order``; ``key`` identifies a row."""
    return _assign(df, _true(F.col(key) == _first_key(df, predicate, key, order)), values)


def delete_first(df: DataFrame, predicate: Column, key: str, order: Sequence[str]) -> DataFrame:
    """Remove the first matching row by ``order``; ``key`` identifies a row."""
    return df.filter(~_true(F.col(key) == _first_key(df, predicate, key, order)))


def apply_changes(base: DataFrame, changes: DataFrame, key: str, op: str = "op", seq: str = "seq") -> DataFrame:
    """Apply an ordered batch of changes in one pass, as if run one by one in ``seq`` order per key.

    ``op`` is ``insert`` (the row becomes exactly the change's columns), ``update`` (non-null columns
    are set, null means unchanged; nothing happens on a missing row) or ``delete``. ``seq`` is unique
    per key. The batch is folded to one row per key by mergeable aggregates, so a key with very many
    changes is reduced on every task first; then one full outer join on the unique key applies it.
    """
    columns = [c for c in base.columns if c != key]
    kind, at = F.col(op), F.col(seq)
    is_reset = kind.isin("insert", "delete")
    folds = [F.max_by(kind, F.when(is_reset, at)).alias("reset_op"), F.max(F.when(is_reset, at)).alias("reset_at")]
    for c in columns:
        change = F.when((kind == "update") & F.col(c).isNotNull(), at)
        folds.append(F.max_by(F.col(c), F.when(kind == "insert", at)).alias(f"ins_{c}"))
        folds.append(F.max_by(F.col(c), change).alias(f"upd_{c}"))
        folds.append(F.max(change).alias(f"at_{c}"))
    folded = changes.groupBy(F.col(key).alias("change_key")).agg(*folds)

    joined = base.withColumn("in_base", F.lit(True)).join(folded, F.col(key) == F.col("change_key"), "full_outer")
    inserted, deleted = F.col("reset_op") == "insert", F.col("reset_op") == "delete"
    alive = F.coalesce(inserted, F.col("in_base"), F.lit(False)) & ~_true(deleted)
    out = [F.coalesce(F.col(key), F.col("change_key")).alias(key)]
    for c in columns:
        start = F.when(_true(inserted), F.col(f"ins_{c}")).otherwise(F.col(c))
        newer = F.col(f"at_{c}").isNotNull() & _true(
            F.col("reset_at").isNull() | (F.col(f"at_{c}") > F.col("reset_at"))
        )
        out.append(F.when(newer, F.col(f"upd_{c}")).otherwise(start).alias(c))
    return joined.filter(alive).select(*out).select(*base.columns)
