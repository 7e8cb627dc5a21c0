"""Reading the routing table, as a snapshot or as its own change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.schemas import ROUTE_COLUMNS, ROUTE_COLUMNS_CAMEL
from careflow.sinks.runs import without_place

_IMAGE = T.StructType(
    [T.StructField(name, T.StringType()) for name in (*ROUTE_COLUMNS, *ROUTE_COLUMNS_CAMEL)]
)
_RECORD = T.StructType(
    [
        T.StructField("op", T.StringType()),
        T.StructField("before", _IMAGE),
        T.StructField("after", _IMAGE),
    ]
)


def read_routes(spark: SparkSession, format: str = "parquet", **options: str) -> DataFrame:
    """The routing table as it is now, its first five columns taken by position.

    ``format`` may be ``jdbc`` (with ``url``, ``dbtable``, ...) or any file format of Spark.
    """
    table = spark.read.format(format).options(**options).load()
    return table.select(
        *(
            F.col(f"`{have}`").cast("string").alias(name)
            for have, name in zip(table.columns, ROUTE_COLUMNS)
        )
    )


def read_landed_config(spark: SparkSession, path: str) -> DataFrame:
    """The routing changes that :func:`careflow.sources.land_topic` keeps, decoded."""
    return decode_config(without_place(spark.read.parquet(path)))


def decode_config(topic: DataFrame) -> DataFrame:
    """Routing changes from their JSON text: ``op`` (r, c, u or d), ``before`` and ``after``.

    Field names may be in snake or camel case. Other columns, such as ``seq``, stay.
    """
    others = [name for name in topic.columns if name != "value"]
    rows = topic.where(F.length("value") > 0).select(
        *others, F.from_json("value", _RECORD).alias("_row")
    )
    return rows.select(
        *others,
        F.col("_row.op").alias("op"),
        _route("_row.before").alias("before"),
        _route("_row.after").alias("after"),
    )


def _route(image: str) -> Column:
    fields = [
        F.coalesce(f"{image}.{snake}", f"{image}.{camel}").alias(snake)
        for snake, camel in zip(ROUTE_COLUMNS, ROUTE_COLUMNS_CAMEL)
    ]
    return F.when(F.col(image).isNotNull(), F.struct(*fields))
