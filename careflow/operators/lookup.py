"""Adding dimension columns by id."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow.operators.sizes import each_salt, spread


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    columns: Mapping[str, str],
    key: str = "id",
    salts: int = 1,
) -> DataFrame:
    """``df`` with columns of the row of ``dim`` whose ``key`` equals ``df[on]``.

    ``columns`` maps dimension columns to new names. A row without a match stays, with nulls. ``dim`` has
    one row per key, which is what the dimension tables hold.

    No broadcast is forced. Spark broadcasts a dimension it measures to be under
    ``spark.sql.autoBroadcastJoinThreshold`` and joins by shuffle beyond it, where adaptive execution
    splits hot keys. A streaming plan has no adaptive execution: with ``salts`` above 1 every key of
    ``df`` is spread over that many tasks, at the price of ``dim`` being repeated as often.
    """
    picked = dim.select(
        F.col(key).alias("_key"), *(F.col(have).alias(name) for have, name in columns.items())
    )
    condition = df[on] == picked["_key"]
    if salts > 1:
        df = df.withColumn("_salt", spread(df, salts))
        picked = picked.withColumn("_dim_salt", each_salt(salts))
        condition = (df[on] == picked["_key"]) & (df["_salt"] == picked["_dim_salt"])
    return df.join(picked, condition, "left").drop("_key", "_salt", "_dim_salt")


def hot_keys(df: DataFrame, on: str, share: float = 0.01) -> list:
    """Keys that hold about a ``share`` of the rows or more, at most twice as many as can.

    They come from a sketch of frequent items, which each task builds over its rows and the shuffle merges.
    """
    most = int(2 / share)
    top, n = df.agg(F.expr(f"approx_top_k(`{on}`, {most}, {max(10_000, 10 * most)})"), F.count(F.lit(1))).first()
    return [item for item, count in top if item is not None and count >= share * n]


def lookup_hot(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    columns: Mapping[str, str],
    key: str = "id",
    share: float = 0.01,
    salts: int = 32,
) -> DataFrame:
    """:func:`lookup` for a batch, or a micro-batch, in which some keys hold much of the rows.

    Only keys with a ``share`` of the rows are spread over ``salts`` tasks, and only their rows of ``dim`` are repeated; all
    others meet once. Which keys those are changes no result. ``df`` is read twice: keep it if it is costly.
    """
    hot = hot_keys(df, on, share)
    if not hot:
        return lookup(df, dim, on, columns, key)
    picked = dim.select(
        F.col(key).alias("_key"), *(F.col(have).alias(name) for have, name in columns.items())
    )
    every = F.when(F.col("_key").isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    picked = picked.withColumn("_dim_salt", F.explode(every))
    salted = df.withColumn("_salt", F.when(F.col(on).isin(hot), spread(df, salts)).otherwise(F.lit(0)))
    condition = (salted[on] == picked["_key"]) & (salted["_salt"] == picked["_dim_salt"])
    return salted.join(picked, condition, "left").drop("_key", "_salt", "_dim_salt")
