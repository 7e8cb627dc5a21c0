"""Dimension tables kept as a log of routed changes and snapshots of it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.operators.routing import route_versions, table_lifecycle
from careflow.operators.upsert import apply_changes
from careflow.schemas import ORDER
from careflow.sinks.files import Folders
from careflow.sinks.runs import PLACE, STAGING, Turn, folder_of, write_once

_ROUTED = f"row_key string, type string, data map<string,string>, seq {ORDER.simpleString()}, born {ORDER.simpleString()}"
_CHANGES = f"{_ROUTED}, sink_table string"

# Changes that carry no column: what is left of a put whose columns have all been written later.
_PUT = "update"

# Tables that were never dropped.
_FROM_THE_START = -1

# Folders of a table's snapshot, by a hash of the row key. A read of a few keys opens the folders of these only.
BUCKETS = 16


class DimensionStore:
    """Dimension tables under one folder.

    A micro-batch only appends its routed changes, so its cost follows the batch and not the table. Its folder
    appears by one rename and is named by run and micro-batch, so nothing else has to be kept about it, and a
    micro-batch that runs again finds it there.

    The routing table and the drops of tables are kept for every position of the config log at which a micro-batch
    was routed, folded once. A micro-batch notes its position before it is routed; if it runs again, it takes the
    routes of that position, whatever has come since. A change is marked with the drop that its table was born
    after, and counts as long as there is no later drop.

    A snapshot is the log so far, shortened: the last value of every column with its order, and the order of
    the last put and the last delete of every row. It folds together with changes of any order, old or new, as
    the whole log would. It lists the folders that it covers and appears by one rename as well. Its tables are parted by a
    hash of the row key, into ``buckets`` folders, and sorted by it there.

    A read opens the last snapshot, or the parts of it that the keys asked for are in, and the folders that it does not
    cover.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.folders = Folders(spark)

    def append(self, routed: DataFrame, batch: int, run: str = "", lifecycle: DataFrame | None = None, streamed: bool = False) -> None:
        """Keeps what :func:`careflow.operators.route` gives. ``lifecycle`` tells the drops known when it was routed."""
        rows = routed.select("sink_table", "row_key", "type", "data", F.col("seq").cast(ORDER).alias("seq"))
        never = F.lit(_FROM_THE_START).cast(ORDER)
        if lifecycle is None:
            rows = rows.withColumn("born", never)
        else:
            drops = lifecycle.select(F.col("sink_table").alias("_table"), F.col("last_drop_seq").cast(ORDER).alias("_drop"))
            rows = rows.join(drops, F.col("sink_table") == F.col("_table"), "left").withColumn("born", F.coalesce("_drop", never))
        turn = Turn(run or "direct", batch, streamed)
        write = lambda folder: rows.select(*_names(_CHANGES)).write.partitionBy("sink_table").parquet(folder)
        write_once(self.spark, f"{self.root}/changes", turn, write, self.spark.read.schema(_CHANGES).parquet)

    def config_of(
        self, turn: Turn, read_config: Callable[[], DataFrame], preloaded: DataFrame | None = None
    ) -> tuple[DataFrame, DataFrame]:
        """Routes and lifecycle for a turn: those it was first routed with, or else those of now.

        A position of the config log is the order of its last change and how many there are.
        """
        notes = folder_of(f"{self.root}/routed", turn.run, turn.batch)
        noted = self.folders.children(notes)
        if noted:
            position = noted[0].removeprefix("position=")
        else:
            config = read_config()
            last = config.agg(F.max("seq"), F.count(F.lit(1))).first()
            position = f"{-1 if last[0] is None else int(last[0]):039d}-{last[1]:012d}"
            self._keep_config(position, config, preloaded)
            self.folders.make(f"{notes}/position={position}")
            self._forget_notes(turn)
        kept = f"{self.root}/config/position={position}"
        versions = self.spark.read.parquet(f"{kept}/routes")
        return versions.where("until_seq IS NULL"), self.spark.read.parquet(f"{kept}/lifecycle")

    def read(
        self,
        table: str,
        columns: Sequence[str],
        key: str = "id",
        only: DataFrame | None = None,
    ) -> DataFrame:
        """The rows of a dimension: its row key as ``key``, and ``columns``. A store without any batch does not
        exist, which is an error.

        ``only`` is a DataFrame with one column of row keys; rows of other keys are left out before the fold, and so are
        the parts of the snapshot that none of the keys is in.
        """
        others = [name for name in columns if name != key]
        log = self._log(self._last_snapshot(), self._parts(), only).where(F.col("sink_table") == table)
        flat = log.select(
            F.col("row_key").alias("_row_key"),
            F.col("seq").alias("_seq"),
            F.col("type").alias("_kind"),
            *(F.col("data")[name].alias(name) for name in others),
        )
        if only is not None:
            wanted = only.select(F.col(only.columns[0]).alias("_row_key")).distinct()
            flat = flat.join(wanted, "_row_key", "left_semi")
        rows = apply_changes(flat, others, keys=["_row_key"], seq="_seq", kind="_kind")
        return rows.select(F.col("_row_key").alias(key), *others)

    def log(self) -> DataFrame:
        """All changes that count: those of the last snapshot and those after it, without dropped tables' past."""
        return self._log(self._last_snapshot(), self._parts())

    def compact(self) -> int | None:
        """Writes a snapshot of all tables and removes what the snapshot before it covers.

        What the new one covers stays until the next, so readers that started from the old one still find theirs. A
        batch that is not complete is not seen and comes after the snapshot whenever it ends. Returns the snapshot's
        number, or None if there is nothing to do.
        """
        last, parts = self._last_snapshot(), self._parts()
        covered = self._covered(last)
        if not set(parts) - covered:
            return None
        log = self._log(last, parts)
        text = F.lit(None).cast("string")
        step = lambda kind, name, value: F.struct(F.lit(kind).alias("type"), name.alias("name"), value.alias("value"))
        cells = F.coalesce(F.filter(F.map_entries("data"), lambda cell: cell["value"].isNotNull()), F.array().cast("array<struct<key:string,value:string>>"))
        put = F.concat(F.array(step(_PUT, text, text)), F.transform(cells, lambda cell: step(_PUT, cell["key"], cell["value"])))
        steps = F.when(F.col("type") != "delete", put).otherwise(F.array(step("delete", text, text)))
        folded = (
            log.select("sink_table", "born", "row_key", "seq", F.explode(steps).alias("_step"))
            .groupBy("sink_table", "born", "row_key", F.col("_step.type").alias("type"), F.col("_step.name").alias("name"))
            .agg(F.max(F.struct("seq", F.col("_step.value").alias("value"))).alias("last"))
        )
        data = F.when(F.col("name").isNotNull(), F.create_map("name", "last.value")).otherwise(F.create_map().cast("map<string,string>"))
        rows = folded.select("sink_table", "row_key", "type", data.alias("data"), F.col("last.seq").alias("seq"), "born")
        number = 1 if last is None else last + 1
        staged = f"{self.root}/{STAGING}/snapshot-{uuid.uuid4().hex}"
        parted = rows.withColumn("bucket", self._bucket("row_key")).repartition("sink_table", "bucket")
        parted.sortWithinPartitions("sink_table", "bucket", "row_key").write.partitionBy("sink_table", "bucket").parquet(f"{staged}/changes")
        self.folders.make(f"{staged}/layout/buckets={self.buckets}")
        self.spark.createDataFrame(parts, "run string, batch_id long").coalesce(1).write.parquet(f"{staged}/covered")
        if not self.folders.publish(staged, self._snapshot(number)):
            self.folders.remove(staged)
            return None
        for part in covered.intersection(parts):
            self.folders.remove(folder_of(f"{self.root}/changes", *part))
        for old in self._snapshots():
            if old < number - 1:
                self.folders.remove(self._snapshot(old))
        return number

    def _bucket(self, key: str, buckets: int | None = None) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets or self.buckets)).cast("int")

    def _open_snapshot(self, number: int, only: DataFrame | None) -> DataFrame:
        rows = self.spark.read.schema(f"{_CHANGES}, bucket int").parquet(f"{self._snapshot(number)}/changes")
        if only is not None:
            (layout,) = self.folders.children(f"{self._snapshot(number)}/layout")
            buckets = int(layout.removeprefix("buckets="))
            wanted = only.select(self._bucket(only.columns[0], buckets).alias("bucket")).distinct().collect()  # at most all buckets
            rows = rows.where(F.col("bucket").isin([row.bucket for row in wanted]))
        return rows.drop("bucket")

    def _log(self, snapshot: int | None, parts: Sequence[tuple[str, int]], only: DataFrame | None = None) -> DataFrame:
        covered = self._covered(snapshot)
        later = [folder_of(f"{self.root}/changes", *part) for part in parts if part not in covered]
        if snapshot is None and not parts and not self.folders.exists(f"{self.root}/config"):
            raise FileNotFoundError(f"there is no dimension store at {self.root}")
        reader = self.spark.read.schema(_CHANGES)
        opened = [self._open_snapshot(snapshot, only)] if snapshot is not None else []
        if later:
            opened.append(reader.option("basePath", f"{self.root}/changes").parquet(*later).drop(*PLACE))
        if not opened:
            return self.spark.createDataFrame([], _CHANGES)
        log = opened[0] if len(opened) == 1 else opened[0].unionByName(opened[1])
        positions = self.folders.children(f"{self.root}/config")
        if not positions:
            return log
        lifecycle = self.spark.read.parquet(f"{self.root}/config/{positions[-1]}/lifecycle")
        drops = lifecycle.where("last_drop_seq IS NOT NULL").select(F.col("sink_table").alias("_dropped"), F.col("last_drop_seq").alias("_drop"))
        joined = log.join(drops, F.col("sink_table") == F.col("_dropped"), "left")
        return joined.where("_drop IS NULL OR born >= _drop").drop("_dropped", "_drop")

    def _keep_config(self, position: str, config: DataFrame, preloaded: DataFrame | None) -> None:
        """Folds the config log up to a position, unless that has been done."""
        name = f"{self.root}/config/position={position}"
        if self.folders.exists(name):
            return
        staged = f"{self.root}/{STAGING}/config-{uuid.uuid4().hex}"
        config = config.persist()
        try:
            route_versions(config, preloaded=preloaded).coalesce(1).write.parquet(f"{staged}/routes")
            table_lifecycle(config).coalesce(1).write.parquet(f"{staged}/lifecycle")
        finally:
            config.unpersist()
        if not self.folders.publish(staged, name):
            self.folders.remove(staged)

    def _forget_notes(self, turn: Turn) -> None:
        """Earlier micro-batches of a stream are over when the next one begins; the last one's note stays."""
        for name in self.folders.children(f"{self.root}/routed/run={turn.run}"):
            if int(name.removeprefix("batch_id=")) < turn.batch - 1:
                self.folders.remove(f"{self.root}/routed/run={turn.run}/{name}")

    def _parts(self) -> list[tuple[str, int]]:
        """Run and number of every complete batch whose folder is there."""
        root = f"{self.root}/changes"
        return [
            (run.removeprefix("run="), int(batch.removeprefix("batch_id=")))
            for run in self.folders.children(root)
            for batch in self.folders.children(f"{root}/{run}")
        ]

    def _covered(self, snapshot: int | None) -> set[tuple[str, int]]:
        if snapshot is None:
            return set()
        listed = self.spark.read.schema("run string, batch_id long").parquet(f"{self._snapshot(snapshot)}/covered")
        return {tuple(row) for row in listed.collect()}

    def _snapshots(self) -> list[int]:
        return [int(name.removeprefix("number=")) for name in self.folders.children(f"{self.root}/snapshots")]

    def _last_snapshot(self) -> int | None:
        return max(self._snapshots(), default=None)

    def _snapshot(self, number: int) -> str:
        return f"{self.root}/snapshots/number={number}"


def _names(schema: str) -> list[str]:
    return [field.name for field in T.StructType.fromDDL(schema).fields]
