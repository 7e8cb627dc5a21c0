"""Folding row changes into dimension rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apply_changes(
    changes: DataFrame,
    columns: Sequence[str],
    current: DataFrame | None = None,
    keys: Sequence[str] = ("row_key",),
    seq: str = "seq",
    kind: str = "type",
) -> DataFrame:
    """Dimension rows after all changes: ``keys``, ``columns`` and the ``seq`` of the last put.

    A put writes the columns that are not NULL, so setting a column to NULL keeps its old value. A delete
    removes the row; a later put starts a new one. ``current`` holds the rows from before, in the form this
    function returns them, and counts as puts.

    One aggregation does it all: each column keeps its latest value with the ``seq`` it came from, and is
    shown only if that is after the last delete. The partial step runs before the shuffle, so a key with
    many changes sends one row per task.
    """
    changes = changes.select(*keys, seq, kind, *columns)
    if current is not None:
        rows = current.select(*keys, seq, F.lit("put").alias(kind), *columns)
        changes = rows.unionByName(changes)
    is_put = F.col(kind) != "delete"
    folded = changes.groupBy(*keys).agg(
        F.max(F.when(is_put, F.col(seq))).alias("_put"),
        F.max(F.when(~is_put, F.col(seq))).alias("_delete"),
        *(
            F.max(F.when(is_put & F.col(name).isNotNull(), F.struct(seq, name))).alias(name)
            for name in columns
        ),
    )
    return folded.where(_after_delete(F.col("_put"))).select(
        *keys,
        *(
            F.when(_after_delete(F.col(name)[seq]), F.col(name)[name]).alias(name)
            for name in columns
        ),
        F.col("_put").alias(seq),
    )


def deleted_keys(
    changes: DataFrame, keys: Sequence[str] = ("row_key",), seq: str = "seq"
) -> DataFrame:
    """Keys whose row is gone, with the ``seq`` of the delete."""
    is_delete = F.col("type") == "delete"
    folded = changes.groupBy(*keys).agg(
        F.max(F.when(~is_delete, F.col(seq))).alias("_put"),
        F.max(F.when(is_delete, F.col(seq))).alias("_delete"),
    )
    gone = F.col("_delete").isNotNull() & ~F.coalesce(F.col("_put") > F.col("_delete"), F.lit(False))
    return folded.where(gone).select(*keys, F.col("_delete").alias("deleted_seq"))


def _after_delete(moment: Column) -> Column:
    return moment.isNotNull() & (F.col("_delete").isNull() | (moment > F.col("_delete")))
