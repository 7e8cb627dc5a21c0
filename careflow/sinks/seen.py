"""Keys that earlier micro-batches have seen, in a table that micro-batches add to."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.sinks.files import Folders
from careflow.sinks.runs import STAGING, Turn, folder_of, write_once

#: Parts of the table by a hash of the key. A micro-batch of few keys reads the parts of these only.
BUCKETS = 64

#: Folders of single micro-batches from which on they are merged.
MERGE_FROM = 50

_MERGED = "merged"


class SeenKeys:
    """The keys under one folder, each with the micro-batch that saw it first.

    What a micro-batch adds is worked out and written once, so a micro-batch that runs again gets the same answer.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str]):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self.folders = Folders(spark)

    def new(self, rows: DataFrame, turn: Turn) -> DataFrame:
        """The ``rows`` (one for each key) whose key no other micro-batch has seen; they count as seen from now on."""
        own = folder_of(self.root, turn.run, turn.batch)
        fresh = rows.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(BUCKETS)).cast("int"))
        reader = self.spark.read.schema(fresh.schema)
        if not (turn.streamed and self.folders.exists(own)):
            known = self._open([part for part in self._parts() if part != (turn.run, turn.batch)], fresh.schema)
            same = [fresh[name].eqNullSafe(known[name]) for name in self.keys]
            # The bucket as an equality lets Spark leave out buckets that no key of these rows is in.
            met = known.join(fresh.select("bucket").distinct(), "bucket", "left_semi")
            fresh = fresh.join(met, [fresh["bucket"] == met["bucket"], *same], "left_anti")
            write_once(self.spark, self.root, turn, fresh.write.partitionBy("bucket").parquet, reader.parquet)
        self._merge(fresh.schema)
        return reader.parquet(own).drop("bucket")

    def _open(self, parts: Sequence[tuple[str, int]], schema: T.StructType) -> DataFrame:
        schema = T.StructType([field for field in schema.fields if field.name in (*self.keys, "bucket")])
        if not parts:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.root)
        return reader.parquet(*(folder_of(self.root, *part) for part in parts)).select(*self.keys, "bucket")

    def _parts(self) -> list[tuple[str, int]]:
        return [
            (run.removeprefix("run="), int(batch.removeprefix("batch_id=")))
            for run in self.folders.children(self.root)
            for batch in self.folders.children(f"{self.root}/{run}")
        ]

    def _merge(self, schema: T.StructType) -> None:
        """Puts the folders of micro-batches that are over, all but the last of each run, into one.

        Keys that stand in both for a moment do no harm.
        """
        parts = self._parts()
        last = {run: max(batch for other, batch in parts if other == run) for run, _ in parts}
        over = [(run, batch) for run, batch in parts if run == _MERGED or batch < last[run]]
        if len(over) < MERGE_FROM:
            return
        staged = f"{self.root}/{STAGING}/{uuid.uuid4().hex}"
        self._open(over, schema).repartition("bucket").write.partitionBy("bucket").parquet(staged)
        if self.folders.publish(staged, folder_of(self.root, _MERGED, last.get(_MERGED, 0) + 1)):
            for part in over:
                self.folders.remove(folder_of(self.root, *part))
