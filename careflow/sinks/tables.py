"""Writing facts to topics and summaries to tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from careflow.sinks.runs import ONCE, Turn, in_batches, without_place, write_once


def json_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One JSON object per row in a column ``value``; null fields are left out."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias("value"))


def write_topic(
    df: DataFrame,
    format: str = "kafka",
    path: str | None = None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    run: str | None = None,
    files: int | None = None,
    **options: str,
) -> StreamingQuery | None:
    """Appends the rows of a fact as JSON text, to a Kafka topic or to text files.

    Text files lie in a folder for each run and micro-batch, see :func:`careflow.sinks.runs.in_batches`, so runs of
    any kind may write to one topic. The folder appears whole and keeps its files when it is written again, so a stream that
    reads the topic gets every row once; Kafka may get rows of a failed micro-batch twice. A micro-batch writes
    ``files`` files, or one for each task.
    """
    rows = json_rows(df)
    if path is not None:

        def save(part: DataFrame, turn: Turn) -> None:
            part = part.repartition(files) if files else part
            reader = part.sparkSession.read.format(format).options(**options).schema(part.schema)
            write_once(part.sparkSession, path, turn, part.write.format(format).options(**options).save, reader.load)

        return in_batches(rows, save, checkpoint, trigger, run)
    if not rows.isStreaming:
        rows.write.format(format).options(**options).mode("append").save()
        return None
    writer = rows.writeStream.format(format).options(**options).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**(trigger or ONCE)).start()


def write_summary(
    df: DataFrame,
    path: str,
    checkpoint: str | None = None,
    format: str = "parquet",
    trigger: dict | None = None,
    run: str | None = None,
    files: int | None = None,
    finish: Callable[[DataFrame, Turn], DataFrame] | None = None,
    **options: str,
) -> StreamingQuery | None:
    """Appends the rows of a summary to a table, one folder for each run and micro-batch.

    The folder of a micro-batch appears whole and stays as it is when the micro-batch runs again after a failure, so its
    rows are kept once; a batch given the same ``run`` again replaces its own rows where they differ. With ``format="jdbc"`` the rows are appended to the table named ``path``
    instead, at least once.

    A micro-batch writes a file per shuffle partition, or ``files`` of them. ``finish`` is applied to each
    micro-batch before it is written, with its turn; it may read the rows more than once.
    """

    def save(rows: DataFrame, turn: Turn) -> None:
        if finish is None:
            put(rows, turn)
            return
        rows.persist()
        try:
            put(finish(rows, turn), turn)
        finally:
            rows.unpersist()

    def put(rows: DataFrame, turn: Turn) -> None:
        rows = rows.repartition(files) if files else rows
        writer = rows.write.format(format).options(**options)
        if format == "jdbc":
            writer.option("dbtable", path).mode("append").save()
        else:
            reader = rows.sparkSession.read.format(format).schema(rows.schema)
            write_once(rows.sparkSession, path, turn, writer.save, reader.load)

    return in_batches(df, save, checkpoint, trigger, run)


def read_summary(spark: SparkSession, path: str, schema=None, format: str = "parquet") -> DataFrame:
    reader = spark.read.format(format)
    if schema is not None:
        reader = reader.schema(schema)
    return without_place(reader.load(path))
