"""One query per operator and pipeline, over the test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.functions import (
    age_group,
    age_years,
    date_text,
    event_time,
    mask_email,
    mask_name,
    mask_phone,
    second_text,
)
from careflow.operators import (
    apply_changes,
    deleted_keys,
    first_flag,
    first_row,
    interval_join,
    latest_routes,
    lookup,
    prune,
    route,
    route_versions,
    table_lifecycle,
    ttl_join,
    tumbling,
    with_bounds,
)
from careflow.plans import FACTS, SUMMARIES, Dimensions, build_fact, build_summary
from careflow.plans.facts import PAYLOAD_KEYS
from careflow.plans.summaries import Windowing, with_age_group
from careflow.session import working_folder
from careflow.sinks import DimensionStore, json_rows, read_summary, write_summary
from careflow.sinks.runs import without_place
from careflow.sources import (
    decode_config,
    decode_envelope,
    decode_fact,
    drop_tombstones,
    land_ods,
    land_topic,
    read_landed,
    read_landed_config,
    read_routes,
    read_topic,
    record_order,
    rejected,
)
from careflow.schemas import ROUTE_COLUMNS, texts
from careflow.streaming.jobs import dimension_job, fact_job, facts_job, lookup_job, read_fact, summary_job
from careflow.workload.bindings import (
    AS_OF,
    MICROS,
    config_changes,
    dimension_changes,
    dimensions,
    json_log,
    ods,
    ods_payments,
    ods_prescriptions,
    ods_treatments,
    routes,
    table,
)
from careflow.workload.streams import late_slices, run_in_slices, run_in_time_order, run_to_table, slices_in_order, stream_table

Query = Callable[[SparkSession, str], DataFrame]

DAY = dt.timedelta(days=1)
HOUR = dt.timedelta(hours=1)
WIDE = {"before": DAY, "after": HOUR}


def event_topic(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON envelopes, with some empty, missing and unreadable records."""
    return table(spark, folder, "events").select(
        "event_id",
        "event_type",
        F.expr(
            f"""CASE WHEN event_id % 19 = 0 THEN '' WHEN event_id % 23 = 0 THEN NULL
                WHEN event_id % 17 = 0 THEN 'not json'
                ELSE to_json(named_struct('database', 'clinic', 'table', event_type, 'type', 'insert',
                    'data', named_struct('id', event_id, 'time', date_format(ts, '{MICROS}'),
                                         'value', value, 'absent', CAST(NULL AS STRING)),
                    'other', props)) END"""
        ).alias("value"),
    )


def ods_decode(spark, folder):
    decoded = decode_envelope(drop_tombstones(event_topic(spark, folder)))
    return decoded.where(F.col("table").isNotNull()).select(
        "event_id",
        F.col("table").alias("source_table"),
        F.col("type").alias("change_type"),
        F.col("data")["id"].alias("id"),
        F.col("data")["time"].alias("time"),
        F.col("data")["value"].cast("double").alias("amount"),
        F.col("data")["nothing"].alias("nothing"),
        F.col("old").isNull().alias("no_old"),
    )


def ods_decode_keys(spark, folder):
    decoded = decode_envelope(drop_tombstones(event_topic(spark, folder)), keys=["id", "value"])
    return decoded.where(F.col("table").isNotNull()).select(
        "event_id",
        F.col("data")["id"].alias("id"),
        F.col("data")["value"].cast("double").alias("amount"),
    )


def ods_rejected(spark, folder):
    decoded = decode_envelope(drop_tombstones(event_topic(spark, folder)))
    return rejected(decoded).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def ods_drop_tombstones(spark, folder):
    kept = drop_tombstones(event_topic(spark, folder))
    return kept.select("event_id", "event_type")


def config_latest(spark, folder):
    return latest_routes(decode_config(config_changes(spark, folder)))


def config_preloaded(spark, folder):
    """The routing table read by position, and then the changes that go on top of it."""
    base = working_folder(spark, "routes")
    routes(spark, folder).write.parquet(base)
    changes = config_changes(spark, folder).where("seq % 2 = 0")
    return latest_routes(decode_config(changes), preloaded=read_routes(spark, path=base))


def config_lifecycle(spark, folder):
    return table_lifecycle(decode_config(config_changes(spark, folder)))


def dim_route(spark, folder):
    routed = route(dimension_changes(spark, folder), routes(spark, folder))
    return routed.select(
        "sink_table",
        "row_key",
        F.col("type").alias("change_type"),
        "seq",
        F.array_join(F.map_keys("data"), ",").alias("kept"),
        F.col("data")["a"].alias("a"),
        F.col("data")["b"].alias("b"),
    )


def dim_prune_columns(spark, folder):
    changes = dimension_changes(spark, folder).where(F.col("data").isNotNull())
    wanted = F.expr("CASE seq % 3 WHEN 0 THEN 'id,a' WHEN 1 THEN 'b,extra' ELSE 'absent,id' END")
    pruned = changes.select("seq", prune(F.col("data"), wanted).alias("data"))
    return pruned.select(
        "seq",
        F.array_join(F.map_keys("data"), ",").alias("kept"),
        F.col("data")["id"].alias("id"),
        F.col("data")["a"].alias("a"),
        F.col("data")["b"].alias("b"),
        F.col("data")["extra"].alias("extra"),
    )


def order_changes(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("row_key"),
        F.col("o_orderkey").alias("seq"),
        F.expr("CASE WHEN o_orderkey % 11 = 0 THEN 'delete' ELSE 'update' END").alias("type"),
        F.expr("CASE WHEN o_orderkey % 3 != 0 THEN o_orderpriority END").alias("a"),
        F.expr("CASE WHEN o_orderkey % 4 != 0 THEN o_orderstatus END").alias("b"),
    )


def dim_upsert_latest(spark, folder):
    return apply_changes(order_changes(spark, folder), ["a", "b"])


def partitioned(order: str, partition: str) -> Column:
    """Order of records in two partitions whose times count up together and whose offsets do not."""
    offset = F.expr(f"{order} + CASE {partition} WHEN 0 THEN 1000000000 ELSE 0 END")
    time = F.timestamp_millis(F.expr(order))
    return F.struct(time.alias("timestamp"), F.expr(partition).alias("partition"), offset.alias("offset"))


def config_two_partitions(spark, folder):
    """Routes whose changes lie in two partitions of their topic."""
    records = config_changes(spark, folder).select("value", partitioned("seq", "seq % 2").alias("r")).select("value", "r.*")
    return latest_routes(decode_config(records.select("value", record_order().alias("seq"))))


def dim_two_partitions(spark, folder):
    """Rows whose changes lie in two partitions of the log."""
    records = order_changes(spark, folder).select("*", partitioned("seq", "seq % 2").alias("r")).select("row_key", "type", "a", "b", "r.*")
    return apply_changes(records.withColumn("seq", record_order()), ["a", "b"]).drop("seq")


def dim_delete(spark, folder):
    return deleted_keys(order_changes(spark, folder))


def dim_tables(spark, folder):
    """Routing and folding together: the rows of every routed dimension."""
    routed = route(dimension_changes(spark, folder), routes(spark, folder)).select(
        "sink_table", "row_key", "type", "seq", F.col("data")["a"].alias("a"), F.col("data")["b"].alias("b")
    )
    return apply_changes(routed, ["a", "b"], keys=["sink_table", "row_key"])


def dim_store(spark, folder):
    """The same through the dimension store: two batches with a snapshot of each table in between."""
    store = DimensionStore(spark, working_folder(spark, "dimensions"))
    wanted, changes = routes(spark, folder), dimension_changes(spark, folder)
    middle = changes.agg(F.max("seq")).first()[0] // 2
    store.append(route(changes.where(F.col("seq") <= middle), wanted), 0)
    store.compact()
    store.append(route(changes.where(F.col("seq") > middle), wanted), 1)
    return tables_of(store)


def stream_dimensions(spark, folder):
    """The dimension job as a stream of two micro-batches, the second with a route more, from landed routing changes."""
    base = working_folder(spark, "stream-dimensions")
    store, changes = DimensionStore(spark, f"{base}/store"), dimension_changes(spark, folder)
    wanted = routes(spark, folder).withColumn("seq", F.expr("CAST(substring(source_table, 8) AS LONG)"))
    records = wanted.select(F.to_json(F.struct(F.lit("c").alias("op"), F.struct(*ROUTE_COLUMNS).alias("after"))).alias("value"), "seq")
    steps = (("seq <= 3", "seq % 2 = 1"), ("seq > 3", "seq % 2 = 0"))
    for number, (new_routes, new_rows) in enumerate(steps):
        land_topic(records.where(new_routes), f"{base}/config")
        changes.where(new_rows).write.mode("append").parquet(f"{base}/log")
        log = spark.readStream.schema(changes.schema).parquet(f"{base}/log")
        dimension_job(log, lambda: read_landed_config(spark, f"{base}/config"), store, f"{base}/checkpoint").awaitTermination()
        if number == 0:
            store.compact()
    return tables_of(store)


def stream_routes_replayed(spark, folder):
    """The same, but the first micro-batch fails after it was routed, and the routing table changes before it runs again."""
    base = working_folder(spark, "stream-replay")
    changes = dimension_changes(spark, folder)
    wanted = routes(spark, folder).withColumn("seq", F.expr("CAST(substring(source_table, 8) AS LONG)"))
    records = wanted.select(F.to_json(F.struct(F.lit("c").alias("op"), F.struct(*ROUTE_COLUMNS).alias("after"))).alias("value"), "seq")

    class Failing(DimensionStore):
        def append(self, *_, **__):
            raise ConnectionError("lost after routing")

    def run(store: DimensionStore) -> None:
        log = spark.readStream.schema(changes.schema).parquet(f"{base}/log")
        dimension_job(log, lambda: read_landed_config(spark, f"{base}/config"), store, f"{base}/checkpoint").awaitTermination()

    store = DimensionStore(spark, f"{base}/store")
    land_topic(records.where("seq <= 3"), f"{base}/config")
    changes.where("seq % 2 = 1").write.parquet(f"{base}/log")
    try:
        run(Failing(spark, f"{base}/store"))
    except StreamingQueryException as failure:
        if "lost after routing" not in str(failure):
            raise
    land_topic(records.where("seq > 3"), f"{base}/config")
    run(store)
    changes.where("seq % 2 = 0").write.mode("append").parquet(f"{base}/log")
    run(store)
    return tables_of(store)


def config_versions(spark, folder):
    """Every route with the order of the changes that it held between."""
    return route_versions(decode_config(config_changes(spark, folder)))


def tables_of(store: DimensionStore) -> DataFrame:
    """The rows of all tables of a store at once."""
    log = store.log().select(
        "sink_table", "row_key", "type", "seq", F.col("data")["a"].alias("a"), F.col("data")["b"].alias("b")
    )
    return apply_changes(log, ["a", "b"], keys=["sink_table", "row_key"]).drop("seq")


def dim_store_late_put(spark, folder):
    """The same with the older half of the log after a snapshot of the newer half."""
    store = DimensionStore(spark, working_folder(spark, "dimensions"))
    wanted, changes = routes(spark, folder), dimension_changes(spark, folder)
    store.append(route(changes.where("seq % 2 = 1"), wanted), 0)
    store.compact()
    store.append(route(changes.where("seq % 2 = 0"), wanted), 1)
    return tables_of(store)


def dim_store_some_keys(spark, folder):
    """One dimension's rows of some keys only, from the largest table of the routes."""
    store = DimensionStore(spark, working_folder(spark, "dimensions"))
    wanted, changes = routes(spark, folder), dimension_changes(spark, folder)
    store.append(route(changes, wanted), 0)
    name = wanted.agg(F.min("sink_table")).first()[0]
    keys = changes.where("seq % 7 = 0").select(F.coalesce(F.col("data")["id"], F.col("old")["id"]))
    return store.read(name, ["a", "b"], key="row_key", only=keys)


def fact(name: str, **options) -> Query:
    return lambda spark, folder: build_fact(name, ods(spark, folder), **options)


def fact_consultation_paid_transition(spark, folder):
    return build_fact("consultation_paid", ods(spark, folder), on_transition=True)


def fact_prescription_paid(spark, folder):
    return build_fact("prescription_paid", ods_payments(spark, folder))


def fact_prescription_paid_wide(spark, folder):
    return build_fact("prescription_paid", ods_payments(spark, folder), **WIDE)


def fact_from_landed_log(spark, folder):
    """A fact from the log kept by source table and change kind."""
    path = working_folder(spark, "landed")
    land_ods(ods(spark, folder), path)
    return build_fact("consultation", read_landed(spark, path))


def fact_through_topic(spark, folder):
    """A fact written to its topic as JSON text and read back."""
    path = working_folder(spark, "topic")
    fact_job("doctor_register", ods(spark, folder), format="text", path=path)
    return read_fact("doctor_register", read_topic(spark, format="text", path=path))


def fact_typed_decode(spark, folder):
    topic = json_rows(build_fact("prescription", ods(spark, folder), ttl=None))
    schema = SUMMARIES["prescription"].input_schema(FACTS["prescription"].columns)
    rows = decode_fact(topic, schema, "prescription_time")
    return rows.select(
        "id",
        "prescription_id",
        "count",
        F.col("total_amount").cast("double").alias("total_amount"),
        second_text(F.col("event_time")).alias("event_time"),
    )


def interval_join_events(spark, folder):
    events = table(spark, folder, "events")
    details = events.where("event_type = 'click'").select(
        F.col("event_id").alias("detail_id"),
        F.col("user_id").alias("detail_user"),
        F.col("ts").cast("timestamp").alias("detail_time"),
    )
    payments = events.where("event_type = 'purchase'").select(
        F.col("event_id").alias("payment_id"),
        F.col("user_id").alias("payment_user"),
        F.col("ts").cast("timestamp").alias("payment_time"),
    )
    joined = interval_join(
        details, payments, "detail_user", "payment_user", "detail_time", "payment_time", **WIDE
    )
    return joined.select("detail_id", "payment_id", F.col("detail_user").alias("user_id"))


def lookup_doctor_hospital(spark, folder):
    visits = build_fact("consultation", ods(spark, folder)).select("id", "doctor_id")
    return lookup(
        visits, dimensions(spark, folder).doctor, "doctor_id", {"hospital_id": "hospital_id"}
    )


def lookup_salted(spark, folder):
    visits = build_fact("consultation", ods(spark, folder)).select("id", "doctor_id")
    doctors = dimensions(spark, folder).doctor
    return lookup(visits, doctors, "doctor_id", {"hospital_id": "hospital_id"}, salts=8)


def lookup_patient_age_group(spark, folder):
    visits = build_fact("consultation", ods(spark, folder)).select("id", "patient_id")
    patients = with_age_group(dimensions(spark, folder).patient, AS_OF)
    return lookup(
        visits, patients, "patient_id", {"gender": "gender", "age_group": "age_group"}
    )


def customer_mask(name: str, source: str, mask) -> Query:
    def query(spark, folder):
        customers = table(spark, folder, "customer")
        return customers.select("c_custkey", mask(F.expr(source)).alias(name))

    return query


def parse_event_time(spark, folder):
    parsed = event_time(F.date_format("ts", MICROS))
    return table(spark, folder, "events").select(
        "event_id",
        second_text(parsed).alias("event_time"),
        event_time(F.col("props")).isNull().alias("other_is_null"),
    )


def window_bounds(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", F.window("ts", "10 seconds").alias("window")
    )
    return with_bounds(events)


def age_groups(spark, folder):
    born = F.expr("date_add(DATE '1930-01-01', CAST(c_custkey * 7919 % 34000 AS INT))")
    age = age_years(born.cast("string"), AS_OF)
    return table(spark, folder, "customer").select(
        "c_custkey",
        age.alias("age"),
        age_group(age).alias("age_group"),
        age_group(age, strict=False).alias("age_group_repaired"),
    )


def tumbling_keyed(size: str) -> Query:
    def query(spark, folder):
        events = table(spark, folder, "events").withColumn("event_time", F.col("ts"))
        counted = tumbling(events, [F.count(F.lit(1)).alias("n")], ["event_type"], size)
        return with_bounds(counted)

    return query


def tumbling_global(size: str) -> Query:
    def query(spark, folder):
        events = table(spark, folder, "events").select(F.col("ts").alias("event_time"))
        return with_bounds(tumbling(events, [F.count(F.lit(1)).alias("n")], (), size))

    return query


def first_detail_per_prescription(spark, folder):
    details = table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.col("l_shipdate").cast("string").alias("shipped"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
    )
    return first_row(details, ["l_orderkey"], ["shipped", "l_linenumber"])


def first_review_flag(spark, folder):
    reviews = build_fact("review", ods(spark, folder)).select(
        "id", "review_time", "doctor_id", "user_id"
    )
    reviews = lookup(
        reviews, dimensions(spark, folder).doctor, "doctor_id", {"hospital_id": "hospital_id"}
    )
    return first_flag(reviews, ["user_id", "hospital_id"], ["review_time", "id"], "is_first")


def summary(name: str, size: str, source=ods, **options) -> Query:
    def query(spark, folder):
        how = Windowing(size=size, as_of=AS_OF)
        rows = build_fact(SUMMARIES[name].fact, source(spark, folder), **options)
        return plain(build_summary(name, rows, dimensions(spark, folder), how))

    return query


def summary_consultation_ids_first(spark, folder):
    """Sums by doctor and patient before any lookup."""
    how = Windowing(size="1 day", as_of=AS_OF, ids_first=True)
    rows = build_fact("consultation", ods(spark, folder))
    return plain(build_summary("consultation", rows, dimensions(spark, folder), how))


def summary_table(spark, folder):
    """A summary written to its table and read back."""
    path = working_folder(spark, "summary")
    how = Windowing(size="1 day", as_of=AS_OF)
    rows = build_fact("review", ods(spark, folder))
    write_summary(build_summary("review", rows, dimensions(spark, folder), how), path)
    return read_summary(spark, path)


def summary_two_runs(spark, folder):
    """A summary from two batches into one table, the second run twice under its name."""
    path = working_folder(spark, "summary")
    how = Windowing(size="1 day", as_of=AS_OF)
    built = build_summary("review", build_fact("review", ods(spark, folder)), dimensions(spark, folder), how)
    first = F.col("stt") < "2024-01-15"
    write_summary(built.where(first), path)
    for _ in range(2):
        write_summary(built.where(~first), path, run="second")
    return read_summary(spark, path)


def plain(rows: DataFrame) -> DataFrame:
    """Sums of money as doubles, for comparison with another engine."""
    return rows.select(
        *(
            F.col(name).cast("double").alias(name) if kind.startswith("decimal") else name
            for name, kind in rows.dtypes
        )
    )


def summary_json(spark, folder):
    how = Windowing(size="1 day", as_of=AS_OF)
    rows = build_fact("review", ods(spark, folder))
    return json_rows(build_summary("review", rows, dimensions(spark, folder), how))


def stream_tumbling(spark, folder):
    events = stream_table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("event_time"), "event_type"
    )
    counted = tumbling(events, [F.count(F.lit(1)).alias("n")], ["event_type"])
    return run_to_table(with_bounds(counted), "tumbling")


def stream_late_drop(spark, folder):
    def build(events: DataFrame) -> DataFrame:
        timed = events.select(F.col("ts").cast("timestamp").alias("event_time"))
        return with_bounds(tumbling(timed, [F.count(F.lit(1)).alias("n")], size="1 hour"))

    slices = late_slices(table(spark, folder, "events").select("ts"))
    return run_in_slices(slices, build, "late")


def stream_summary_consultation(spark, folder):
    """Stateless lookups on a stream, windowed sums, and names after them."""
    events = stream_table(spark, folder, "events")
    rows = build_fact("consultation", ods(spark, folder, events))
    how = Windowing(as_of=AS_OF)
    built = build_summary("consultation", rows, dimensions(spark, folder), how)
    return run_to_table(plain(built), "consultation")


def stream_fact_prescription_paid(spark, folder):
    """Interval join of two streams, bounded by watermarks."""

    def build(events: DataFrame) -> DataFrame:
        return build_fact("prescription_paid", ods_payments(spark, folder, events), **WIDE)

    return run_in_time_order([(table(spark, folder, "events"), "ts")], build, "paid")


def stream_summary_of_treatments(name: str) -> Query:
    """From a stream of changes over the fact's topic to the summary's table."""

    def query(spark, folder):
        base, fact = working_folder(spark, name), SUMMARIES[name].fact
        log = ods_treatments(stream_table(spark, folder, "events"))
        fact_job(fact, log, format="text", path=f"{base}/topic", checkpoint=f"{base}/fact").awaitTermination()
        topic = read_topic(spark, format="text", path=f"{base}/topic", streaming=True)
        dims = dimensions(spark, folder)
        summary_job(name, topic, dims, base, Windowing(as_of=AS_OF), checkpoint=f"{base}/summary").awaitTermination()
        return plain(read_summary(spark, f"{base}/{SUMMARIES[name].table}"))

    return query


def stream_summary_reviews(spark, folder):
    """Reviews as they arrive, first ones told by the keys that the stream remembers."""
    dims = dimensions(spark, folder)

    def build(events: DataFrame) -> DataFrame:
        return build_summary("review", build_fact("review", ods(spark, folder, events)), dims)

    return run_in_slices(slices_in_order(table(spark, folder, "events")), build, "reviews")


def stream_summary_reviews_live(spark, folder):
    """The same while every doctor moves to the next hospital after each slice: hospitals are those of the moment a window
    closes, and users are new where they never were."""
    base, dims, moved = working_folder(spark, "live"), dimensions(spark, folder), []

    def now(windows: DataFrame) -> Dimensions:
        hospital = F.expr(f"CAST((CAST(hospital_id AS INT) + {len(moved)}) % 25 AS STRING)")
        return replace(dims, doctor=dims.doctor.withColumn("hospital_id", hospital))

    for number, events in enumerate(slices_in_order(table(spark, folder, "events"))):
        fact_job("review", ods(spark, folder, events), format="text", path=f"{base}/topic")
        topic = read_topic(spark, format="text", path=f"{base}/topic", streaming=True)
        summary_job("review", topic, now, base, checkpoint=f"{base}/checkpoint").awaitTermination()
        moved.append(number)
    return read_summary(spark, f"{base}/{SUMMARIES['review'].table}")


def stream_first_review_flag(spark, folder):
    """Reviews as they arrive with a flag on each user's first one at a hospital; the last others wait for the watermark."""
    doctors = dimensions(spark, folder).doctor

    def build(events: DataFrame) -> DataFrame:
        reviews = build_fact("review", ods(spark, folder, events)).select("id", "review_time", "doctor_id", "user_id")
        reviews = lookup(reviews, doctors, "doctor_id", {"hospital_id": "hospital_id"})
        timed = reviews.withColumn("event_time", event_time(F.col("review_time"))).withWatermark("event_time", "5 seconds")
        return first_flag(timed, ["user_id", "hospital_id"], ["event_time", "id"], "is_first").drop("event_time")

    return run_in_slices(slices_in_order(table(spark, folder, "events")), build, "flag")


def facts_from_json(spark, folder):
    """All eight facts from a log of JSON text that a stream parses once, as one table of their rows."""
    base = working_folder(spark, "facts")
    json_log(spark, folder).write.text(f"{base}/log")
    log = decode_envelope(read_topic(spark, format="text", path=f"{base}/log", streaming=True), PAYLOAD_KEYS)
    for query in facts_job(log, f"{base}/topics", f"{base}/checkpoint"):
        query.awaitTermination()
    parts = []
    for name, fact in FACTS.items():
        rows = read_topic(spark, format="text", path=f"{base}/topics/{fact.topic}")
        rows = rows.select(F.from_json("value", texts(*fact.columns)).alias("r")).select("r.*")
        parts.append(rows.select(F.lit(name).alias("fact"), "id", F.concat_ws("|", *(F.coalesce(c, F.lit("")) for c in fact.columns)).alias("fields")))
    return reduce(DataFrame.unionByName, parts)


def stream_first_row(spark, folder):
    """The first event of each user and kind as they arrive in a stream, whole rows."""

    def build(events: DataFrame) -> DataFrame:
        named = events.select("user_id", "event_type", "event_id", F.date_format("ts", MICROS).alias("seen"), "value")
        return first_row(named, ["user_id", "event_type"])

    return run_in_slices(slices_in_order(table(spark, folder, "events")), build, "first")


def stream_fact_prescription(spark, folder):
    """Prescriptions and details of two streams, written at most 60 days apart."""

    def build(orders: DataFrame, details: DataFrame) -> DataFrame:
        return build_fact("prescription", ods_prescriptions(orders, details), ttl=60 * DAY)

    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    details = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"
    )
    tables = [(orders, "o_orderdate"), (details, "l_shipdate")]
    return run_in_time_order(tables, build, "prescription", keys=["o_orderkey", "l_orderkey"])


def fact_prescription_within(spark, folder):
    """The same bound in a batch."""
    return build_fact("prescription", ods(spark, folder), ttl=60 * DAY)


def stream_lookup_hot_keys(spark, folder):
    """Visits of a stream with their doctor's hospital; ten doctors hold all of them and are spread."""
    base, doctors = working_folder(spark, "hot"), dimensions(spark, folder).doctor
    visits = build_fact("consultation", ods(spark, folder, stream_table(spark, folder, "events"))).select("id", "doctor_id")
    columns = {"hospital_id": "hospital_id"}
    lookup_job(visits, lambda: doctors, "doctor_id", columns, f"{base}/rows", checkpoint=f"{base}/checkpoint", salts=8).awaitTermination()
    return without_place(spark.read.parquet(f"{base}/rows"))


def stream_arrival_ttl(spark, folder):
    """Prescriptions and details that arrive within 5 seconds of each other, whatever their own times, which lie three months apart."""

    def build(events: DataFrame) -> DataFrame:
        return build_fact("prescription", ods_treatments(events, details_after="90 DAYS", arrived=True), arrival="arrived")

    return run_in_time_order([(table(spark, folder, "events"), "ts")], build, "arrival")


def stream_ttl_join(spark, folder):
    """Join of two streams that keep each row for a day."""

    def build(events: DataFrame) -> DataFrame:
        clicks = events.where("event_type = 'click'").select(
            F.col("event_id").alias("click_id"),
            F.col("user_id").alias("click_user"),
            F.col("ts").cast("timestamp").alias("click_time"),
        )
        views = events.where("event_type = 'view'").select(
            F.col("event_id").alias("view_id"),
            F.col("user_id").alias("view_user"),
            F.col("ts").cast("timestamp").alias("view_time"),
        )
        joined = ttl_join(
            clicks, views, "click_user", "view_user", "click_time", "view_time", ttl=DAY, salts=2
        )
        return joined.select("click_id", "view_id")

    return run_in_time_order([(table(spark, folder, "events"), "ts")], build, "ttl")


QUERIES: dict[str, Query] = {
    "ods_decode": ods_decode,
    "ods_decode_keys": ods_decode_keys,
    "ods_rejected": ods_rejected,
    "ods_drop_tombstones": ods_drop_tombstones,
    "config_latest": config_latest,
    "config_lifecycle": config_lifecycle,
    "fact_typed_decode": fact_typed_decode,
    "dim_route": dim_route,
    "dim_prune_columns": dim_prune_columns,
    "dim_upsert_latest": dim_upsert_latest,
    "dim_delete": dim_delete,
    "dim_tables": dim_tables,
    "dim_store": dim_store,
    "dim_store_late_put": dim_store_late_put,
    "dim_store_some_keys": dim_store_some_keys,
    "config_preloaded": config_preloaded,
    "config_versions": config_versions,
    "config_two_partitions": config_two_partitions,
    "dim_two_partitions": dim_two_partitions,
    "stream_routes_replayed": stream_routes_replayed,
    "stream_dimensions": stream_dimensions,
    "summary_two_runs": summary_two_runs,
    "fact_consultation": fact("consultation"),
    "fact_consultation_paid": fact("consultation_paid"),
    "fact_consultation_paid_transition": fact_consultation_paid_transition,
    "fact_prescription": fact("prescription", ttl=None),
    "fact_prescription_paid": fact_prescription_paid,
    "fact_prescription_paid_wide": fact_prescription_paid_wide,
    "fact_user_register": fact("user_register"),
    "fact_patient_add": fact("patient_add"),
    "fact_doctor_register": fact("doctor_register"),
    "fact_review": fact("review"),
    "fact_from_landed_log": fact_from_landed_log,
    "fact_through_topic": fact_through_topic,
    "mask_email": customer_mask(
        "email",
        "concat(lower(c_name), CASE WHEN c_custkey % 10 = 0 THEN '' ELSE '@' END, "
        "lower(c_mktsegment), '.example')",
        mask_email,
    ),
    "mask_phone": customer_mask("phone", "CAST(13000000000 + c_custkey AS STRING)", mask_phone),
    "mask_name": customer_mask("name", "c_name", mask_name),
    "parse_event_time": parse_event_time,
    "window_bounds": window_bounds,
    "age_group": age_groups,
    "interval_join_events": interval_join_events,
    "lookup_doctor_hospital": lookup_doctor_hospital,
    "lookup_salted": lookup_salted,
    "lookup_patient_age_group": lookup_patient_age_group,
    "tumbling_keyed": tumbling_keyed("10 seconds"),
    "tumbling_keyed_daily": tumbling_keyed("1 day"),
    "tumbling_global": tumbling_global("10 seconds"),
    "tumbling_global_daily": tumbling_global("1 day"),
    "first_detail_per_prescription": first_detail_per_prescription,
    "first_review_flag": first_review_flag,
    "summary_consultation": summary("consultation", "10 seconds"),
    "summary_consultation_daily": summary("consultation", "1 day"),
    "summary_consultation_paid": summary("consultation_paid", "10 seconds"),
    "summary_consultation_paid_daily": summary("consultation_paid", "1 day"),
    "summary_prescription": summary("prescription", "10 seconds", ttl=None),
    "summary_prescription_monthly": summary("prescription", "30 days", ttl=None),
    "summary_prescription_paid": summary("prescription_paid", "10 seconds", ods_payments),
    "summary_prescription_paid_daily": summary("prescription_paid", "1 day", ods_payments, **WIDE),
    "summary_user_register": summary("user_register", "10 seconds"),
    "summary_user_register_daily": summary("user_register", "1 day"),
    "summary_patient_add": summary("patient_add", "10 seconds"),
    "summary_patient_add_daily": summary("patient_add", "1 day"),
    "summary_doctor_register": summary("doctor_register", "10 seconds"),
    "summary_doctor_register_daily": summary("doctor_register", "1 day"),
    "summary_reviews": summary("review", "10 seconds"),
    "summary_reviews_daily": summary("review", "1 day"),
    "summary_consultation_ids_first": summary_consultation_ids_first,
    "summary_json": summary_json,
    "summary_table": summary_table,
    "stream_tumbling": stream_tumbling,
    "stream_late_drop": stream_late_drop,
    "stream_summary_consultation": stream_summary_consultation,
    "stream_fact_prescription_paid": stream_fact_prescription_paid,
    "stream_first_row": stream_first_row,
    "stream_ttl_join": stream_ttl_join,
    "stream_fact_prescription": stream_fact_prescription,
    "stream_arrival_ttl": stream_arrival_ttl,
    "stream_lookup_hot_keys": stream_lookup_hot_keys,
    "stream_summary_prescription": stream_summary_of_treatments("prescription"),
    "stream_summary_prescription_paid": stream_summary_of_treatments("prescription_paid"),
    "stream_summary_reviews": stream_summary_reviews,
    "stream_summary_reviews_live": stream_summary_reviews_live,
    "stream_first_review_flag": stream_first_review_flag,
    "facts_from_json": facts_from_json,
    "fact_prescription_within": fact_prescription_within,
}
