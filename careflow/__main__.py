"""Runs one job of the warehouse: ``python -m careflow --help``, or this file with spark-submit."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from careflow.plans import FACTS, SUMMARIES
from careflow.plans.facts import PAYLOAD_KEYS
from careflow.plans.summaries import Windowing
from careflow.session import DEFAULT_ZONE, build_session
from careflow.sinks import DimensionStore
from careflow.sources import (
    decode_envelope,
    in_order,
    land_ods,
    land_topic,
    read_landed,
    read_landed_config,
    read_routes,
    read_topic,
)
from careflow.streaming import dimension_job, fact_job, store_dimensions, summary_job


# Summaries that remember every prescription, or every user of a hospital.
KEEPS_KEYS = ("prescription", "prescription_paid", "review")

# Column with the time at which a record came in.
ARRIVED = "arrived"


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="careflow", description="Healthcare change-log warehouse")
    top.add_argument("--master", help="Spark master; spark-submit sets its own")
    top.add_argument("--zone", default=DEFAULT_ZONE, help="zone of the times in the log")
    jobs = top.add_subparsers(dest="job", required=True)

    land = jobs.add_parser("land", help="keep the decoded change log as partitioned parquet")
    land_config = jobs.add_parser("land-config", help="keep the changes of the routing table")
    compact = jobs.add_parser("compact", help="shorten the log of the dimension store")
    dimensions = jobs.add_parser("dimensions", help="route row changes into the dimension store")
    fact = jobs.add_parser("fact", help="build one detail fact")
    summary = jobs.add_parser("summary", help="build one windowed summary")
    fact.add_argument("name", choices=FACTS)
    summary.add_argument("name", choices=SUMMARIES)

    for job in (land, land_config, dimensions, fact, summary):
        job.add_argument("--order", help="field of the records that counts them; text needs one")
        job.add_argument("--run", help="name of a batch, to replace what it wrote before")
        job.add_argument("--format", default="kafka", help="of the input: kafka or text")
        job.add_argument("--path", help="of text input")
        job.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
        job.add_argument("--batch", action="store_true", help="one batch over everything")
        job.add_argument("--every", help="keep running, with this time between micro-batches")
        job.add_argument("--checkpoint", help="progress of a stream")
    for job in (land, fact):
        job.add_argument("--by-arrival", action="store_true", help="keep the time that records come in, and join prescriptions by it")
    for job in (dimensions, fact):
        job.add_argument("--landed", help="read the log that the land job keeps")
    for job in (land, land_config, summary):
        job.add_argument("--out", required=True)
    for job in (dimensions, summary, compact):
        job.add_argument("--store", help="folder of the dimension store")
    fact.add_argument("--out", help="folder of a text topic")
    fact.add_argument("--sink-format", default="kafka", help="of the topic: kafka or text")
    fact.add_argument("--sink-option", action="append", default=[], metavar="KEY=VALUE")
    for job in (fact, summary):
        job.add_argument("--files", type=int, help="files of a micro-batch")
    for job in (fact, summary):
        job.add_argument("--salts", type=int, default=1, help="tasks that a hot key of a stream is spread over")
    fact.add_argument("--on-transition", action="store_true", help="count changes of status only")
    summary.add_argument("--forget-keys", action="store_true", help="bound the state of first rows by the watermark")
    summary.add_argument("--start", help="offset of the windows, as '16 hours'")
    dimensions.add_argument("--config", required=True, help="folder that land-config keeps")
    dimensions.add_argument("--routes", help="folder of the routing table before its first change")
    dimensions.add_argument("--routes-format", default="parquet", help="of the routing table: parquet, json, csv, jdbc, ...")
    dimensions.add_argument("--routes-option", action="append", default=[], metavar="KEY=VALUE", help="as url=jdbc:..., dbtable=...")
    summary.add_argument("--live", action="store_true", help="read dimensions when windows close")
    summary.add_argument("--window", default=Windowing.size)
    summary.add_argument("--delay", default=Windowing.delay)
    summary.add_argument("--as-of", help="day that ages are taken at")
    return top


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(arguments)
    keeps_keys = args.job == "summary" and args.name in KEEPS_KEYS
    spark = spark or build_session(
        f"careflow-{args.job}", args.master, args.zone, state_on_disk=keeps_keys
    )
    stream = {
        "checkpoint": args.checkpoint,
        "trigger": {"processingTime": args.every} if args.every else None,
        "run": args.run,
    } if args.job != "compact" else {}
    query = _start(args, spark, stream)
    if query is not None:
        query.awaitTermination()


def _start(args: argparse.Namespace, spark: SparkSession, stream: dict):
    if args.job == "compact":
        DimensionStore(spark, args.store).compact()
        return None
    if args.job == "land":
        return land_ods(decode_envelope(in_order(_topic(args, spark))), args.out, **stream)
    if args.job == "land-config":
        return land_topic(_topic(args, spark), args.out, **stream)
    if args.job == "dimensions":
        store = DimensionStore(spark, args.store)
        config = lambda: read_landed_config(spark, args.config)
        source = _pairs(args.routes_option) | ({"path": args.routes} if args.routes else {})
        routes = read_routes(spark, args.routes_format, **source) if source else None
        return dimension_job(_log(args, spark), config, store, preloaded=routes, **stream)
    if args.job == "fact":
        sink = {"format": args.sink_format, "path": args.out, "files": args.files, **_pairs(args.sink_option)}
        options = {"salts": args.salts} if args.salts > 1 else {}
        options |= {"on_transition": True} if args.on_transition else {}
        options |= {"arrival": ARRIVED} if args.by_arrival else {}
        return fact_job(args.name, _log(args, spark, PAYLOAD_KEYS), options, **sink, **stream)
    dims = None
    if args.store:
        store = DimensionStore(spark, args.store)
        dims = (lambda rows: store_dimensions(store, rows)) if args.live else store_dimensions(store)
    how = Windowing(size=args.window, delay=args.delay, as_of=args.as_of, salts=args.salts, forget_keys=args.forget_keys, start=args.start)
    return summary_job(args.name, _topic(args, spark), dims, args.out, how, files=args.files, **stream)


def _topic(args: argparse.Namespace, spark: SparkSession) -> DataFrame:
    arrival = {"arrival": ARRIVED} if getattr(args, "by_arrival", False) else {}
    return read_topic(
        spark,
        format=args.format,
        path=args.path,
        streaming=not args.batch,
        order=args.order,
        **_pairs(args.option),
        **arrival,
    )


def _log(
    args: argparse.Namespace, spark: SparkSession, keys: Sequence[str] | None = None
) -> DataFrame:
    if args.landed:
        return read_landed(spark, args.landed, streaming=not args.batch)
    return decode_envelope(_topic(args, spark), keys)


def _pairs(options: Sequence[str]) -> dict[str, str]:
    return dict(option.split("=", 1) for option in options)


if __name__ == "__main__":
    main()
