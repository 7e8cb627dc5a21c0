"""Masking of personal fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_email(email: Column) -> Column:
    """``ab@c.d`` becomes ``*@c.d``; an address without ``@`` becomes NULL."""
    return F.concat(F.lit("*@"), F.get(F.split(email, "@"), F.lit(1)))


def mask_phone(phone: Column) -> Column:
    """First three characters, then eight stars."""
    return F.concat(F.substring(phone, 1, 3), F.lit("*" * 8))


def mask_name(name: Column) -> Column:
    """First character, then one star."""
    return F.concat(F.substring(name, 1, 1), F.lit("*"))
