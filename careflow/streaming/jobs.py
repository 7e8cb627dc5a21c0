"""The jobs of the warehouse: one for the dimensions, one per fact, one per summary.

Each runs as a stream when its input is one (by default until everything available is processed, see
``trigger``) and as a batch otherwise. All progress is in the checkpoint folder, so a job that is
started again goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from careflow.operators.lookup import lookup_hot
from careflow.operators.routing import route
from careflow.plans.facts import FACTS, build_fact
from careflow.plans.summaries import (
    SUMMARIES,
    Dimensions,
    ReviewSummary,
    Windowing,
    build_summary,
    summary_input,
)
from careflow.schemas import texts
from careflow.sinks.dimensions import DimensionStore
from careflow.sinks.files import Folders
from careflow.sinks.runs import Turn, in_batches, without_place, write_once
from careflow.sinks.seen import SeenKeys
from careflow.sinks.tables import json_rows, write_summary, write_topic
from careflow.sources.changelog import in_order


def dimension_job(
    ods: DataFrame,
    read_config: Callable[[], DataFrame],
    store: DimensionStore,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    run: str | None = None,
    preloaded: DataFrame | None = None,
) -> StreamingQuery | None:
    """Routes row changes into the dimension store.

    ``read_config`` gives the routing changes so far, as :func:`careflow.sources.decode_config`. It is
    called for every micro-batch, so a new route applies to the next data, and it is read before the data.
    ``preloaded`` is the routing table as read before the log of its changes begins. A micro-batch that runs again
    takes the routes of its first try.
    """

    def save(batch: DataFrame, turn: Turn) -> None:
        routes, lifecycle = store.config_of(turn, read_config, preloaded)
        store.append(route(batch, routes), turn.batch, turn.run, lifecycle, turn.streamed)

    return in_batches(in_order(ods), save, checkpoint, trigger, run)


def fact_job(name: str, ods: DataFrame, options: dict | None = None, **sink) -> StreamingQuery | None:
    """Builds a fact and appends it to its topic. ``sink`` as in :func:`careflow.sinks.write_topic`."""
    if sink.get("format", "kafka") == "kafka":
        sink.setdefault("topic", FACTS[name].topic)
    return write_topic(build_fact(name, ods, **(options or {})), **sink)


def facts_job(
    log: DataFrame,
    path: str,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    run: str | None = None,
    options: dict[str, dict] | None = None,
) -> list[StreamingQuery]:
    """All eight facts from a decoded log that is parsed once, each to its topic as text under ``path``.

    Each micro-batch is parsed once and gives the facts of single tables to their topics; rows of prescriptions are
    kept as they are, and the two facts that join them read them there. A topic gets a micro-batch whole and
    once, whatever has failed in between. ``options`` are those of single facts. With a ``trigger`` of its own a stream
    keeps running; without, its three queries run one after the other.
    """
    spark, options = log.sparkSession, options or {}
    joined = ("prescription", "prescription_paid")
    landed = f"{path}/prescriptions_landed"

    def topic(name: str) -> str:
        return f"{path}/{FACTS[name].topic}"

    def save(rows: DataFrame, turn: Turn) -> None:
        rows.persist()
        try:
            for name in (name for name in FACTS if name not in joined):
                records = json_rows(build_fact(name, rows, **options.get(name, {})))
                write_once(spark, topic(name), turn, records.write.text, spark.read.schema(records.schema).text)
            prescriptions = rows.where(F.col("table").startswith("prescription"))
            write_once(spark, landed, turn, prescriptions.write.partitionBy("table", "type").parquet, spark.read.schema(rows.schema).parquet)
        finally:
            rows.unpersist()

    Folders(spark).make(landed)
    queries = [in_batches(log, save, f"{checkpoint}/parse", trigger, run)]
    for name in joined:
        if log.isStreaming and not trigger:
            queries[-1].awaitTermination()
        reader = spark.readStream if log.isStreaming else spark.read
        rows = without_place(reader.schema(log.schema).parquet(landed))
        how = {"checkpoint": f"{checkpoint}/{name}", "trigger": trigger, "run": run}
        queries.append(fact_job(name, rows, options.get(name), format="text", path=topic(name), **how))
    return [query for query in queries if query is not None]


def lookup_job(
    rows: DataFrame,
    read_dim: Callable[[], DataFrame],
    on: str,
    columns: Mapping[str, str],
    path: str,
    key: str = "id",
    checkpoint: str | None = None,
    trigger: dict | None = None,
    run: str | None = None,
    **how,
) -> StreamingQuery | None:
    """Adds dimension columns to a stream and keeps the rows as parquet for streams further down.

    Dimensions are read anew for every micro-batch, by ``read_dim``, and the hot keys of each micro-batch are spread, see
    :func:`careflow.operators.lookup_hot`, which ``how`` goes to.
    """

    def save(batch: DataFrame, turn: Turn) -> None:
        batch.persist()
        try:
            found = lookup_hot(batch, read_dim(), on, columns, key, **how)
            write_once(batch.sparkSession, path, turn, found.write.parquet, batch.sparkSession.read.schema(found.schema).parquet)
        finally:
            batch.unpersist()

    return in_batches(rows, save, checkpoint, trigger, run)


def summary_job(
    name: str,
    topic: DataFrame,
    dims: Dimensions | Callable[[DataFrame], Dimensions] | None,
    path: str,
    how: Windowing = Windowing(),
    **sink,
) -> StreamingQuery | None:
    """Builds a summary from the records of its fact's topic and appends it under ``path``.

    Given as tables, the dimensions stay as they were when a stream started; start it again (it goes on
    from its checkpoint) for newer ones. The trade summaries and that of reviews also take a function, which is called
    with the rows of each micro-batch that gives out windows: the stream then sums by doctor and patient, or user, and
    hospitals, age bands and names are those of the moment the window closes. Users and hospitals that have
    met are then kept in a table beside that of the summary.
    """
    summary, fact = SUMMARIES[name], read_fact(name, topic)
    table = f"{path}/{summary.table}"
    if not callable(dims):
        return write_summary(build_summary(name, fact, dims, how), table, **sink)
    if summary.by_ids is None:
        raise ValueError(f"{name} needs no dimensions")

    def finish(windows: DataFrame, turn: Turn) -> DataFrame:
        more = []
        if isinstance(summary.by_ids, ReviewSummary):
            seen = SeenKeys(windows.sparkSession, f"{table}_seen", summary.by_ids.visitor)
            more.append(lambda met: seen.new(met, turn))
        return summary.by_ids.from_ids(windows, dims(windows), how, *more).select(*summary.columns)

    by_ids = summary.by_ids.by_ids(summary_input(name, fact), how)
    return write_summary(by_ids, table, finish=finish, **sink)


def store_dimensions(store: DimensionStore, windows: DataFrame | None = None) -> Dimensions:
    """The dimensions in a store; with the ``windows`` of a summary, of the doctors and patients in them."""

    def ids(name: str) -> DataFrame | None:
        return None if windows is None or name not in windows.columns else windows.select(name)

    return Dimensions(
        doctor=store.read("dim_doctor", ["hospital_id"], only=ids("doctor_id")),
        patient=store.read("dim_patient", ["gender", "birthday"], only=ids("patient_id")),
        hospital=store.read("dim_hospital", ["name"]),
        dictionary=store.read("dim_dict", ["value"]),
    )


def read_fact(name: str, topic: DataFrame) -> DataFrame:
    """A fact, as text, from the records of its topic."""
    schema = texts(*FACTS[SUMMARIES[name].fact].columns)
    return topic.select(F.from_json("value", schema).alias("_row")).select("_row.*")
