"""Config-driven routing of row changes to dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careflow.operators.sizes import each_salt, spread
from careflow.schemas import CONTROL_TYPES, ROUTE_COLUMNS


def latest_routes(
    config: DataFrame, seq: str = "seq", preloaded: DataFrame | None = None
) -> DataFrame:
    """The routing table after all changes: one row per ``source_table``.

    ``preloaded`` is the routing table as read before (:func:`careflow.sources.read_routes`); every change
    in ``config`` overrules it. A delete removes the route of its ``before`` image. An update that renames the source table removes
    the old route too.
    """
    last = (
        _route_steps(config, seq, preloaded)
        .groupBy("step.source_table")
        .agg(F.max(F.struct("_seq", "step.live", "step.route")).alias("last"))
    )
    return last.where("last.live = 1").select("source_table", "last.route.*")


def route_versions(
    config: DataFrame, seq: str = "seq", preloaded: DataFrame | None = None
) -> DataFrame:
    """Every route that ever held: ``from_seq`` (NULL for a preloaded one) up to before ``until_seq``, the order of
    the change that replaced or removed it, NULL if it still holds. Routes of now are as in :func:`latest_routes`."""
    steps = _route_steps(config, seq, preloaded).select("_seq", "step.*")
    by_order = Window.partitionBy("source_table").orderBy("_seq", "live", "route")
    versions = steps.withColumn("until_seq", F.lead("_seq").over(by_order))
    held = (F.col("live") == 1) & (F.col("until_seq").isNull() | ~F.col("until_seq").eqNullSafe(F.col("_seq")))
    return versions.where(held).select("source_table", "route.*", F.col("_seq").alias("from_seq"), "until_seq")


def _route_steps(config: DataFrame, seq: str, preloaded: DataFrame | None) -> DataFrame:
    """Routes that go (``live`` 0) and come, with the order of the change: ``_seq`` and ``step``."""
    config = config.select(F.col(seq).alias("_seq"), "op", "before", "after")
    if preloaded is not None:
        known = preloaded.select(
            F.lit(None).cast(config.schema["_seq"].dataType).alias("_seq"),
            F.lit("r").alias("op"),
            F.lit(None).cast(config.schema["before"].dataType).alias("before"),
            F.struct(*ROUTE_COLUMNS).alias("after"),
        )
        config = known.unionByName(config)
    before, after = F.col("before.source_table"), F.col("after.source_table")
    gone = (F.col("op") == "d") | ((F.col("op") == "u") & ~before.eqNullSafe(after))
    removal = F.struct(before.alias("source_table"), F.lit(0).alias("live"), _route_of("before"))
    arrival = F.struct(after.alias("source_table"), F.lit(1).alias("live"), _route_of("after"))
    steps = F.filter(
        F.array(F.when(gone, removal), F.when(F.col("op") != "d", arrival)),
        lambda step: step["source_table"].isNotNull(),
    )
    return config.select("_seq", F.explode(steps).alias("step"))


def table_lifecycle(config: DataFrame, seq: str = "seq") -> DataFrame:
    """Per dimension table: whether it exists and the ``seq`` of the last change that dropped it.

    A new or first-read route creates its table, a deleted one drops it, and an updated one drops the
    table of its ``before`` image and creates that of ``after``. Rows from before a drop are lost.
    """
    drop = F.struct(
        F.col("before.sink_table").alias("sink_table"), F.lit(0).alias("turn"), F.lit(0).alias("live")
    )
    create = F.struct(
        F.col("after.sink_table").alias("sink_table"), F.lit(1).alias("turn"), F.lit(1).alias("live")
    )
    steps = F.filter(
        F.array(F.when(F.col("op").isin("u", "d"), drop), F.when(F.col("op") != "d", create)),
        lambda step: step["sink_table"].isNotNull(),
    )
    turns = config.select(F.col(seq).alias("_seq"), F.explode(steps).alias("step"))
    return (
        turns.groupBy("step.sink_table")
        .agg(
            F.max(F.struct("_seq", "step.turn", "step.live")).alias("last"),
            F.max(F.when(F.col("step.live") == 0, F.col("_seq"))).alias("last_drop_seq"),
        )
        .select("sink_table", (F.col("last.live") == 1).alias("is_live"), "last_drop_seq")
    )


def prune(data: Column, sink_columns: Column) -> Column:
    """The entries of a map whose keys are in a comma-separated list."""
    wanted = F.split(sink_columns, ",")
    return F.map_filter(data, lambda key, _: F.array_contains(wanted, key))


def route(changes: DataFrame, routes: DataFrame, salts: int = 1) -> DataFrame:
    """Changes of tables that have a route: ``sink_table``, ``row_key``, ``type``, ``data``, ``seq``.

    Control messages and tables without a route are dropped. Puts keep the routed columns only; deletes
    carry the image of the deleted row, from ``old`` or else from ``data``. Changes without a row key
    address no row and are dropped.

    Routes are few, so Spark broadcasts them by their size; where they outgrow that, adaptive execution splits a
    source table that holds most of the log. Without it, ``salts`` spreads each table over that many tasks.
    """
    changes = changes.where(~F.col("type").isin(*CONTROL_TYPES))
    wanted = routes.select(*ROUTE_COLUMNS)
    if salts == 1:
        joined = changes.join(wanted, F.col("table") == F.col("source_table"))
    else:
        joined = changes.withColumn("_salt", spread(changes, salts)).join(
            wanted.withColumn("_route_salt", each_salt(salts)),
            (F.col("table") == F.col("source_table")) & (F.col("_salt") == F.col("_route_salt")),
        )
    is_delete = F.col("type") == "delete"
    key = F.col("sink_row_key")
    image_key = F.coalesce(F.col("old")[key], F.col("data")[key])
    return joined.select(
        "sink_table",
        F.when(is_delete, image_key).otherwise(F.col("data")[key]).alias("row_key"),
        "type",
        F.when(is_delete, F.coalesce("old", "data"))
        .otherwise(prune(F.col("data"), F.col("sink_columns")))
        .alias("data"),
        "seq",
    ).where(F.col("row_key").isNotNull())


def _route_of(image: str) -> Column:
    return F.struct(*(F.col(f"{image}.{name}") for name in ROUTE_COLUMNS[1:])).alias("route")
