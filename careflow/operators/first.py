"""First row per key and the flag that marks it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careflow.operators.sizes import spread


def first_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    within_watermark: bool = False,
) -> DataFrame:
    """One row per key: in a batch the first by ``order`` and then by all columns, in a stream the first
    to arrive.

    The batch form is a minimum over whole rows. Each task keeps one row per key before the shuffle, so a
    hot key sends a row per task and not its whole group. The stream form keeps every key it saw;
    ``within_watermark`` forgets keys that the watermark has passed, for logs where a key does not come
    back.
    """
    if df.isStreaming:
        if within_watermark:
            return df.dropDuplicatesWithinWatermark(list(keys))
        return df.dropDuplicates(list(keys))
    if within_watermark:
        raise ValueError("a batch has no watermark and forgets no key")
    rest = [*order, *(name for name in df.columns if name not in (*order, *keys))]
    firsts = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_first"))
    return firsts.select(*keys, "_first.*").select(*df.columns)


def first_flag(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    flag: str,
    salts: int = 32,
    within_watermark: bool = False,
) -> DataFrame:
    """All rows, with 1 in ``flag`` on the first row of each key and 0 on the others.

    In a batch the first is the least by ``order`` and then by all columns. Each key is spread over ``salts`` parts by
    the values of its rows. A row that is not first in its part cannot be first of all; the heads of the parts, at most
    ``salts`` for each key, then decide among themselves. So no task ranks a whole hot key.

    In a stream the first is the first to arrive. ``order`` then names a row within its key and begins with a time
    that has a watermark. The rows meet the first rows of their keys in an outer join by that name: first ones come out
    at once, the others when the watermark has passed their time, up to which the join remembers rows. What keys were
    seen is remembered as :func:`first_row` does.
    """
    if df.isStreaming:
        return _stream_flag(df, keys, order, flag, within_watermark)
    order = [*order, *(name for name in df.columns if name not in (*order, *keys))]
    parts = df.withColumn("_salt", spread(df, salts))
    in_part = F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order))
    ranked = parts.withColumn("_rank", in_part)
    overall = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    heads = ranked.where("_rank = 1").withColumn(flag, (overall == 1).cast("long"))
    others = ranked.where("_rank > 1").withColumn(flag, F.lit(0).cast("long"))
    return heads.unionByName(others).drop("_salt", "_rank")


def _stream_flag(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str, within_watermark: bool
) -> DataFrame:
    time, *rest = order
    # As text, keys with nulls are equal too.
    named = df.withColumn("_key", F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}))
    named = named.withColumn("_row", F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}))
    firsts = first_row(named.select("_key", time, "_row"), ["_key"], within_watermark=within_watermark)
    firsts = firsts.select(F.col("_key").alias("_first_key"), F.col(time).alias("_first_time"), F.col("_row").alias("_first_row"))
    same = (F.col("_key") == F.col("_first_key")) & (F.col(time) == F.col("_first_time")) & (F.col("_row") == F.col("_first_row"))
    joined = named.join(firsts, same, "left_outer")
    return joined.select(*df.columns, F.col("_first_key").isNotNull().cast("long").alias(flag))
