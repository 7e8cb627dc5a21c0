"""Streaming runs over the test tables, each ending in a table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.session import working_folder
from careflow.sinks.files import Folders
from careflow.workload.bindings import table


#: Rows that a stream in time order takes at a time, and that are worth a partition of its own.
ROWS_AT_ONCE = 4_000_000
ROWS_APART = 50_000

#: Slices of one stream, where its rows can be dealt by key.
SLICES_AT_MOST = 8

# A replay is never taken up again, so of its checkpoints the last ones do. Older ones would keep all rows once more, in
# memory and on disk, and sums beside them would double the files that each partition writes at each micro-batch.
REPLAY_SETTINGS = {
    "spark.sql.streaming.maxBatchesToRetainInMemory": "1",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.checkpoint.fileChecksum.enabled": "false",
}

# Days on which the second and third slice begin.
SLICE_DAYS = ("2024-01-11", "2024-01-21")


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table as a stream of its files. The pattern matches one file as well as a folder."""
    schema = table(spark, folder, name).schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parquet*")


def run_to_table(stream: DataFrame, purpose: str) -> DataFrame:
    """Runs a stream over everything there is and reads back what it wrote."""
    spark = stream.sparkSession
    base = working_folder(spark, purpose)
    _run(stream, base)
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def run_in_time_order(
    tables: list[tuple[DataFrame, str]], build, purpose: str, at_once: int = ROWS_AT_ONCE, keys: list[str] | None = None
) -> DataFrame:
    """Feeds tables, each with the column of its times, in slices by time to the stream that ``build`` makes of their streams.

    A slice has about ``at_once`` rows, those of equal times together. The stream runs on from slice to slice, so its
    watermark follows and a join remembers the rows within its bound and not all of history. Rows come no later than the
    watermark, and rows without a time come first. Each table is moved once, to lie by slices, in files of equal size.

    What a join remembers grows with the tables all the same, and every micro-batch goes through all of it. With ``keys``, a
    column of each table without which rows never meet, tables of more than ``SLICES_AT_MOST`` slices are dealt into groups
    by key. Each has a stream of its own, one after the other, so the time grows with the rows and the memory does not; its
    input and state are removed when it is done.

    Every partition of a stream writes files of state at every micro-batch, however few its rows are. So there are two for
    each core and no more, whatever number the session has for its shuffles.
    """
    spark, base = tables[0][0].sparkSession, working_folder(tables[0][0].sparkSession, purpose)
    folders = Folders(spark)
    total = sum(rows.count() for rows, _ in tables)
    groups = total // (at_once * SLICES_AT_MOST) + 1 if keys else 1
    marked = []
    for number, (rows, time) in enumerate(tables):
        group = F.pmod(F.xxhash64(F.col(keys[number]).cast("string")), F.lit(groups)) if groups > 1 else F.lit(0)
        marked.append(rows.withColumns({"_at": F.unix_micros(F.col(time).cast("timestamp")), "_group": group.cast("int")}))
    cuts = _cuts(marked, groups, total, at_once)
    firsts = [sum(len(ours) + 1 for ours in cuts[:group]) for group in range(groups + 1)]
    at, placing = F.col("_at"), F.lit(None)
    for group in reversed(range(groups)):
        placed = F.when(at.isNull(), firsts[group]).otherwise(_slice_of(at, cuts[group], firsts[group]))
        placing = placed if group == groups - 1 else F.when(F.col("_group") == group, placed).otherwise(placing)
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = min(shuffled, 2 * spark.sparkContext.defaultParallelism, total // ROWS_APART + 1)
    for number, (rows, _) in enumerate(tables):
        placed = marked[number].withColumn("_slice", placing).drop("_at", "_group")
        part = F.pmod(F.xxhash64(*rows.columns), F.lit(parts)).cast("int")
        placed = placed.repartitionById(firsts[-1] * parts, F.col("_slice") * parts + part)
        placed.write.partitionBy("_slice").parquet(f"{base}/slices/{number}")
    results = []
    for group in range(groups):
        own = f"{base}/{group}" if groups > 1 else base
        streams = []
        for number, (rows, _) in enumerate(tables):
            folders.make(f"{own}/input/{number}/start")
            streams.append(spark.readStream.schema(rows.schema).parquet(f"{own}/input/{number}/*"))
        stream = build(*streams)
        writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{own}/checkpoint").outputMode("append")
        with _settings(spark, REPLAY_SETTINGS | {"spark.sql.shuffle.partitions": str(parts)}):
            query = writer.start(f"{own}/rows")  # keeps the settings of this moment
        try:
            for k in range(firsts[group], firsts[group + 1]):
                for number in range(len(tables)):
                    if folders.exists(f"{base}/slices/{number}/_slice={k}"):
                        folders.publish(f"{base}/slices/{number}/_slice={k}", f"{own}/input/{number}/{k}")
                query.processAllAvailable()
        finally:
            query.stop()
        results.append(spark.read.schema(stream.schema).parquet(f"{own}/rows"))
        if groups > 1:
            folders.remove(f"{own}/checkpoint")
            folders.remove(f"{own}/input")
    return reduce(DataFrame.unionAll, results)


def _cuts(marked: list[DataFrame], groups: int, total: int, at_once: int) -> list[list[int]]:
    """For each group the moments at which its slices after the first begin. A group with hot keys has more of them."""
    steps = 8 * (total // at_once + 1)
    shares = F.array(*(F.lit(k / steps) for k in range(1, steps + 1)))
    moments = reduce(DataFrame.unionAll, (rows.select("_group", "_at") for rows in marked))
    found = moments.groupBy("_group").agg(F.count(F.lit(1)).alias("rows"), F.percentile_approx("_at", shares).alias("moments"))
    cuts = [[] for _ in range(groups)]
    for group, rows, at in found.collect():
        slices = rows // at_once + 1
        cuts[group] = sorted({at[k * steps // slices - 1] for k in range(1, slices)} if at else ())
    return cuts


def _slice_of(at: Column, cuts: list[int], before: int = 0) -> Column:
    """Number of the cuts up to a moment, found by halving them; ``before`` more have been left out."""
    if not cuts:
        return F.lit(before)
    half = len(cuts) // 2
    return F.when(at < cuts[half], _slice_of(at, cuts[:half], before)).otherwise(
        _slice_of(at, cuts[half + 1 :], before + half + 1)
    )


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of a session for a while."""
    former = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in former.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def run_in_slices(slices: list[DataFrame], build, purpose: str) -> DataFrame:
    """Feeds one slice after the other to the stream that ``build`` makes of its input.

    The stream is started once per slice with the same checkpoint, so its watermark has moved past a slice
    before the next one comes.
    """
    spark = slices[0].sparkSession
    base = working_folder(spark, purpose)
    schema = slices[0].schema
    for rows in slices:
        rows.write.mode("append").parquet(f"{base}/input")
        stream = build(spark.readStream.schema(schema).parquet(f"{base}/input"))
        _run(stream, base)
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def _run(stream: DataFrame, base: str) -> None:
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{base}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start(f"{base}/rows")
    )
    query.awaitTermination()


def slices_in_order(events: DataFrame) -> list[DataFrame]:
    """The events in three slices by time, each as one file in which they are in order."""
    first, second = (F.lit(day).cast("timestamp_ntz") for day in SLICE_DAYS)
    at = F.col("ts")
    parts = (events.where(at < first), events.where((at >= first) & (at < second)), events.where(at >= second))
    return [part.coalesce(1).sortWithinPartitions("ts", "event_id") for part in parts]


def late_slices(events: DataFrame) -> list[DataFrame]:
    """The events in three slices by time, the third with old events coming a second time, far too late."""
    at = F.col("ts")
    first, second = (F.lit(day).cast("timestamp_ntz") for day in SLICE_DAYS)
    late = events.where(at < F.lit("2024-01-06").cast("timestamp_ntz"))
    return [
        events.where(at < first),
        events.where((at >= first) & (at < second)),
        reduce(DataFrame.unionByName, [events.where(at >= second), late]),
    ]
