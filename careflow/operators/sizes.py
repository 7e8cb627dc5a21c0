"""Helpers against keys that outgrow one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def spread(df: DataFrame, salts: int) -> Column:
    """A number below ``salts`` from the values of the row, the same when a lost task runs again."""
    plain = [
        F.col(f"`{field.name}`")
        for field in df.schema.fields
        if not isinstance(field.dataType, T.MapType)
    ]
    return F.pmod(F.xxhash64(*plain), F.lit(salts)).cast("int")


def each_salt(salts: int) -> Column:
    """One row per salt, to meet every row that :func:`spread` sent there."""
    return F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
