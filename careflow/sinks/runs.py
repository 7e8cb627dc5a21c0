"""Output that every run, and every micro-batch of a run, keeps in a folder of its own."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from careflow.sinks.files import Folders

ONCE = {"availableNow": True}

#: Columns that the folders' names add to what is read back.
PLACE = ("run", "batch_id")

#: Folders that are being written lie here, where readers do not look.
STAGING = "_staging"


@dataclass(frozen=True)
class Turn:
    """A run, one of its batches, and whether it is a stream, whose batches hold the same rows however often they run."""

    run: str
    batch: int = 0
    streamed: bool = False


def in_batches(
    df: DataFrame,
    save: Callable[[DataFrame, Turn], None],
    checkpoint: str | None = None,
    trigger: dict | None = None,
    run: str | None = None,
) -> StreamingQuery | None:
    """Calls ``save`` with the rows and the turn of each micro-batch, or once for a batch.

    The run of a stream is the id that its checkpoint keeps. A batch takes the ``run`` given, which names the
    output to replace if it has run before, or else a new one. So only the same run and batch are ever replaced.
    """
    if not df.isStreaming:
        save(df, Turn(run or f"batch-{uuid.uuid4().hex}"))
        return None

    def each(rows: DataFrame, batch: int) -> None:
        save(rows, Turn(query_id(rows), batch, streamed=True))

    return (
        df.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or ONCE))
        .start()
    )


def query_id(rows: DataFrame) -> str:
    """The id of the stream that a micro-batch belongs to; it stays the same with the checkpoint."""
    return rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def folder_of(path: str, run: str, batch: int) -> str:
    return f"{path}/run={run}/batch_id={batch}"


def write_once(
    spark: SparkSession,
    path: str,
    turn: Turn,
    write: Callable[[str], None],
    read: Callable[[str], DataFrame],
) -> None:
    """Lets ``write`` fill a hidden folder and renames that to the folder of the turn, so readers see all of it or nothing.

    A folder that is there already is kept, with its files: a stream further down that has read them would take new files
    for new rows. So a micro-batch that runs again adds nothing. A batch that runs again under its name keeps
    what it wrote if that holds the same rows (``read`` opens a folder), and else replaces it.
    """
    folders, name = Folders(spark), folder_of(path, turn.run, turn.batch)
    attempts = f"{path}/{STAGING}/{turn.run}-{turn.batch}"
    staged = f"{attempts}/{uuid.uuid4().hex}"
    try:
        write(staged)
        if not folders.publish(staged, name) and not turn.streamed and not _same_rows(read(staged), read(name)):
            folders.remove(name)
            folders.publish(staged, name)
    finally:
        folders.remove(attempts)


def _same_rows(one: DataFrame, other: DataFrame) -> bool:
    """Whether two tables hold the same rows, however often each, by sums of two hashes of the rows."""

    def digest(rows: DataFrame) -> tuple:
        text = F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"})
        halves = rows.select(F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit(1)).alias("b"))
        sums = (F.sum(F.col(name).cast("decimal(38,0)")) for name in ("a", "b"))
        return tuple(halves.agg(F.count(F.lit(1)), *sums).first())

    return sorted(one.columns) == sorted(other.columns) and digest(one) == digest(other)


def without_place(df: DataFrame) -> DataFrame:
    return df.drop(*(F.col(name) for name in PLACE if name in df.columns))
