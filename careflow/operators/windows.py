"""Tumbling event-time windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow.functions import date_text, second_text

WINDOW = "10 seconds"
DELAY = "5 seconds"


def tumbling(
    df: DataFrame,
    aggregates: Sequence[Column],
    keys: Sequence[str] = (),
    size: str = WINDOW,
    delay: str = DELAY,
    time: str = "event_time",
    start: str | None = None,
) -> DataFrame:
    """``aggregates`` per window of ``size`` and ``keys``, with the window as column ``window``.

    A stream gives each window once, when the latest time seen is ``delay`` past its end, and drops rows
    that come later; the last windows stay open. A batch gives every window. Rows without a time count
    nowhere. Batch windows follow the wall clock. Those of a stream start at whole multiples of ``size``
    since 1970 in UTC, the same thing for sizes that divide the zone's offset; for local days pass the
    offset as ``start``.
    """
    if df.isStreaming:
        if time not in watermarked(df):
            df = df.withWatermark(time, delay)
        when = F.col(time)
    else:
        when = F.col(time).cast("timestamp_ntz")
    bounds = F.window(when, size, startTime=start) if start else F.window(when, size)
    return df.groupBy(bounds.alias("window"), *keys).agg(*aggregates)


def with_bounds(windowed: DataFrame) -> DataFrame:
    """Text columns ``stt``, ``edt`` and ``cur_date`` in place of ``window``."""
    others = [name for name in windowed.columns if name != "window"]
    return windowed.select(
        second_text(F.col("window.start")).alias("stt"),
        second_text(F.col("window.end")).alias("edt"),
        date_text(F.col("window.start")).alias("cur_date"),
        *others,
    )


def watermarked(df: DataFrame) -> set[str]:
    """Columns that carry a watermark already."""
    return {
        field.name for field in df.schema.fields if "spark.watermarkDelayMs" in field.metadata
    }
