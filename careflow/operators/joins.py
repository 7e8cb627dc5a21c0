"""Joins of two change streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow.operators.sizes import each_salt, spread

# Bounds of the two stream joins and how far events may be out of order.
JOIN_TTL = dt.timedelta(seconds=5)
PAY_AFTER = dt.timedelta(minutes=15)
PAY_BEFORE = dt.timedelta(seconds=5)
OUT_OF_ORDER = dt.timedelta(seconds=5)


def delay_text(delay: dt.timedelta) -> str:
    return f"{int(delay.total_seconds() * 1000)} milliseconds"


def ttl_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_time: str,
    right_time: str,
    ttl: dt.timedelta | None = JOIN_TTL,
    out_of_order: dt.timedelta = OUT_OF_ORDER,
    salts: int = 1,
) -> DataFrame:
    """Inner join on a key of rows whose event times lie at most ``ttl`` apart, in streams and in batches.

    The bound lets Spark forget old rows of a stream. Without it (None) every pair with equal keys is a match,
    which only batches can have.

    With ``salts`` above 1 the rows of one hot ``right`` key are spread over that many tasks, each with
    its own copy of the ``left`` row. A batch join does without: adaptive execution splits the key.
    """
    stream = left.isStreaming and right.isStreaming
    if stream and ttl is None:
        raise ValueError("a join of streams needs a ttl")
    if stream:
        left = left.withWatermark(left_time, delay_text(out_of_order))
        right = right.withWatermark(right_time, delay_text(out_of_order))
    condition = F.col(left_key) == F.col(right_key)
    if salts > 1:
        left = left.withColumn("_left_salt", each_salt(salts))
        right = right.withColumn("_right_salt", spread(right, salts))
        condition = condition & (F.col("_left_salt") == F.col("_right_salt"))
    if ttl is not None:
        condition = condition & _within(left_time, right_time, ttl, ttl)
    return left.join(right, condition, "inner").drop("_left_salt", "_right_salt")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_time: str,
    right_time: str,
    before: dt.timedelta = PAY_AFTER,
    after: dt.timedelta = PAY_BEFORE,
    out_of_order: dt.timedelta = OUT_OF_ORDER,
    salts: int = 1,
) -> DataFrame:
    """Inner join on a key where ``left_time`` lies in ``[right_time - before, right_time + after]``.

    Time is cut into slices as long as the whole interval. The right row goes to the one or two slices its
    interval touches and the left row to its own, so that key and slice together are an equality. Without
    it, a key with many rows on both sides would meet itself over all of history in one task. ``salts``
    spreads the left rows of one key and slice further, as in :func:`ttl_join`.
    """
    if left.isStreaming:
        left = left.withWatermark(left_time, delay_text(out_of_order))
    if right.isStreaming:
        right = right.withWatermark(right_time, delay_text(out_of_order))
    slice_micros = max(_micros(before + after), 1_000_000)
    moment = F.unix_micros(F.col(right_time))
    touched = F.sequence(
        _slice(moment - _micros(before), slice_micros),
        _slice(moment + _micros(after), slice_micros),
    )
    left = left.withColumn("_left_slice", _slice(F.unix_micros(F.col(left_time)), slice_micros))
    right = right.where(F.col(right_time).isNotNull()).withColumn("_right_slice", F.explode(touched))
    condition = (
        (F.col(left_key) == F.col(right_key))
        & (F.col("_left_slice") == F.col("_right_slice"))
        & _within(left_time, right_time, before, after)
    )
    if salts > 1:
        left = left.withColumn("_left_salt", spread(left, salts))
        right = right.withColumn("_right_salt", each_salt(salts))
        condition = condition & (F.col("_left_salt") == F.col("_right_salt"))
    return left.join(right, condition, "inner").drop(
        "_left_slice", "_right_slice", "_left_salt", "_right_salt"
    )


def _within(left_time: str, right_time: str, before: dt.timedelta, after: dt.timedelta) -> Column:
    left, right = F.col(left_time), F.col(right_time)
    return (left >= right - F.lit(before)) & (left <= right + F.lit(after))


def _micros(span: dt.timedelta) -> int:
    return span // dt.timedelta(microseconds=1)


def _slice(micros: Column, length: int) -> Column:
    """Number of the slice; the division leaves no rest and is exact."""
    return ((micros - F.pmod(micros, F.lit(length))) / length).cast("long")
