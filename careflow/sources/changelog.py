"""Reading the change log and the detail topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from careflow.schemas import ENVELOPE, ORDER
from careflow.functions import event_time
from careflow.sinks.runs import Turn, in_batches, without_place, write_once


def read_topic(
    spark: SparkSession,
    format: str = "kafka",
    path: str | None = None,
    streaming: bool = False,
    order: str | None = None,
    arrival: str | None = None,
    **options: str,
) -> DataFrame:
    """Raw text records in a column ``value``, from the earliest one, without tombstones.

    ``format`` is ``kafka`` (options as Spark's Kafka source takes them) or ``text`` with a folder of
    line-delimited files. Kafka adds ``seq``, the order of the record among those of all partitions, see
    :func:`record_order`. With text, name the field of the records that holds their ``order``, a whole number that
    counts up over the whole log; it becomes ``seq``.

    ``arrival`` names a further column with the time at which a record came in: Kafka's own, and else that of the
    micro-batch that reads it, which stays the same if it runs again.
    """
    reader = spark.readStream if streaming else spark.read
    if format == "kafka":
        options = {"startingOffsets": "earliest", **options}
    raw = reader.format(format).options(**options).load(path)
    columns = [F.col("value").cast("string").alias("value")]
    if order is not None:
        columns.append(F.get_json_object("value", f"$.{order}").try_cast("long").alias("seq"))
    elif format == "kafka":
        columns.append(record_order().alias("seq"))
    if arrival is not None:
        columns.append((F.col("timestamp") if format == "kafka" else F.current_timestamp()).alias(arrival))
    return drop_tombstones(raw.select(*columns))


def record_order() -> Column:
    """One number that orders the records of all partitions of a topic: by their time, then partition and offset.

    Records of one partition with times that do not go back, as brokers give them, keep their order; a row or a route
    whose changes lie in several partitions has them in the order of their times.
    """
    parts = ((F.unix_millis("timestamp"), 13), (F.col("partition"), 6), (F.col("offset"), 19))
    return F.concat(*(F.lpad(part.cast("string"), digits, "0") for part, digits in parts)).cast(ORDER)


def drop_tombstones(topic: DataFrame) -> DataFrame:
    return topic.where(F.length("value") > 0)


def decode_envelope(topic: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Replaces ``value`` by the envelope fields; other columns stay.

    Without ``keys`` the payload is a map of whatever fields the row has. Given the ``keys`` that will be
    read, it is a struct of those alone: the parser then skips every other field and builds no map. Both
    are read as ``data['key']``. A record that is not an envelope gives nulls, see :func:`rejected`.
    """
    schema = ENVELOPE
    if keys is not None:
        payload = T.StructType([T.StructField(key, T.StringType()) for key in keys])
        fixed = [field for field in ENVELOPE.fields if field.name not in ("data", "old")]
        schema = T.StructType(
            [*fixed, T.StructField("data", payload), T.StructField("old", payload)]
        )
    others = [name for name in topic.columns if name != "value"]
    return topic.select(*others, F.from_json("value", schema).alias("_row")).select(
        *others, "_row.*"
    )


def rejected(decoded: DataFrame) -> DataFrame:
    """Records that could not be read as an envelope; every job leaves them out."""
    return decoded.where(F.col("table").isNull() | F.col("type").isNull())


def read_ods(
    spark: SparkSession, keys: Sequence[str] | None = None, streaming: bool = False, **source: str
) -> DataFrame:
    """The decoded change log. ``source`` as in :func:`read_topic`."""
    return decode_envelope(read_topic(spark, streaming=streaming, **source), keys)


def land_ods(
    ods: DataFrame,
    path: str,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    run: str | None = None,
) -> StreamingQuery | None:
    """Keeps the decoded log as parquet, one folder per source table and change kind.

    A fact job that reads the landed log lists and scans only the folders of its own table and kind, so
    eight jobs do not parse the whole log eight times. Records that could not be read land in the folders
    without a table: a filter on parsed fields would parse every record once more.

    A batch is rebalanced first. Adaptive execution then cuts it into files of the advisory size, also
    where most of the log is one table; without that, each task would leave a file in every folder.

    Batches and streams may land in one folder: each run and micro-batch has a folder of its own, which appears whole
    and does not change when it runs again, see :func:`careflow.sinks.runs.write_once`. So streams that read the landed
    log see every row once.
    """

    def save(rows: DataFrame, turn: Turn) -> None:
        spark = rows.sparkSession
        rows = rows.hint("rebalance", "table", "type") if spark.conf.get("spark.sql.adaptive.enabled") == "true" else rows
        reader = spark.read.schema(rows.schema)
        write_once(spark, path, turn, lambda folder: rows.write.partitionBy("table", "type").parquet(folder), reader.parquet)

    return in_batches(ods, save, checkpoint, trigger, run)


def land_topic(
    topic: DataFrame,
    path: str,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    run: str | None = None,
) -> StreamingQuery | None:
    """Keeps raw records (``value``, ``seq``) as parquet, as the routing changes are kept for the dimension job."""

    def save(rows: DataFrame, turn: Turn) -> None:
        rows = rows.select("value", "seq")
        write_once(rows.sparkSession, path, turn, rows.write.parquet, rows.sparkSession.read.schema(rows.schema).parquet)

    return in_batches(in_order(topic), save, checkpoint, trigger, run)


def in_order(log: DataFrame) -> DataFrame:
    """The log, if it has the order of its records."""
    if "seq" not in log.columns:
        raise ValueError("the log has no order: name the field of its records that holds it")
    return log


def read_landed(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """The log that :func:`land_ods` keeps."""
    if not streaming:
        return without_place(spark.read.parquet(path))
    schema = spark.read.parquet(path).schema
    return without_place(spark.readStream.schema(schema).parquet(path))


def decode_fact(topic: DataFrame, schema: T.StructType, time: str) -> DataFrame:
    """Rows of a detail topic with their types, and ``event_time`` from the column named ``time``.

    All fields arrive as text. A value that does not fit its type becomes NULL.
    """
    as_text = T.StructType([T.StructField(name, T.StringType()) for name in schema.fieldNames()])
    rows = drop_tombstones(topic).select(F.from_json("value", as_text).alias("_row"))
    return typed(rows.select("_row.*"), schema, time)


def typed(fact: DataFrame, schema: T.StructType, time: str) -> DataFrame:
    """The typed form of a fact whose columns are all text."""
    columns = []
    for field in schema.fields:
        column = F.col(field.name)
        if not isinstance(field.dataType, T.StringType):
            column = column.try_cast(field.dataType).alias(field.name)
        columns.append(column)
    return fact.select(*columns, event_time(F.col(time)).alias("event_time"))
