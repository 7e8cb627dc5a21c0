"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# The wall-clock zone in which the change log writes its times.
DEFAULT_ZONE = "Asia/Shanghai"

# Keeps the state of a stream on disk and checkpoints only what changed.
DISK_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app: str = "careflow",
    master: str | None = None,
    zone: str = DEFAULT_ZONE,
    settings: dict[str, str] | None = None,
    state_on_disk: bool = False,
) -> SparkSession:
    """A session with adaptive execution on. ``settings`` go on top.

    ``state_on_disk`` is for streams with first-row tests, whose keys pile up over their life. Spark's own
    store holds all state in executor memory; it is faster for windows, which come and go.

    The number of shuffle partitions is left to the cluster; on a local master it follows the cores,
    because the default of 200 is mostly scheduling cost there.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", zone)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if state_on_disk:
        builder = builder.config(
            "spark.sql.streaming.stateStore.providerClass", DISK_STATE_STORE
        ).config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            cores = master[master.find("[") + 1 : -1] if "[" in master else "1"
            cores = str(os.cpu_count()) if cores == "*" else cores
            builder = (
                builder.config("spark.sql.shuffle.partitions", cores)
                .config("spark.ui.enabled", "false")
                .config("spark.ui.showConsoleProgress", "false")
                .config("spark.driver.memory", "8g")
            )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name for checkpoints and intermediate tables.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``, or else in the warehouse. A warehouse on
    a machine's own disk serves a local master only.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = f"{warehouse}/_work"
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
