"""Streams against batches: from the change log through topics to summaries."""

import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from careflow.functions import event_time
from careflow.operators import first_flag, first_row, interval_join, ttl_join, tumbling, with_bounds
from careflow.plans import FACTS, SUMMARIES, Dimensions, build_fact, build_summary
from careflow.plans.facts import PAYLOAD_KEYS
from careflow.plans.summaries import Windowing
from careflow.sinks import read_summary, write_summary
from careflow.sinks.runs import Turn, write_once
from careflow.sinks.seen import SeenKeys
from careflow.sources import decode_envelope, land_ods, read_landed, read_topic
from careflow.streaming import fact_job, summary_job
from careflow.streaming.jobs import read_fact
from careflow.workload import streams
from careflow.workload.bindings import AS_OF, dimensions, ods, table
from tests.conftest import rows

HOW = Windowing(as_of=AS_OF)


def prescriptions(events):
    """For each click a prescription, two details two seconds later and a payment a minute later."""
    form = "'yyyy-MM-dd HH:mm:ss'"
    data = {
        "prescription": "'id', id, 'create_time', t0, 'total_amount', '9.50', 'consultation_id', id, "
        "'doctor_id', string(event_id % 10), 'patient_id', string(user_id)",
        "prescription_detail": "'id', concat(id, '-', d), 'create_time', t2, 'count', '1', 'medicine_id', 'm', "
        "'prescription_id', id",
    }
    data["payment"] = data["prescription"] + ", 'status', '203', 'update_time', t60"
    clicks = events.where("event_type = 'click'").selectExpr(
        "event_id",
        "user_id",
        "string(event_id) AS id",
        "ts AS time",
        f"date_format(ts, {form}) AS t0",
        f"date_format(ts + INTERVAL 2 SECONDS, {form}) AS t2",
        f"date_format(ts + INTERVAL 60 SECONDS, {form}) AS t60",
    )

    def change(source, name, kind, fields, delay):
        return source.selectExpr(
            f"to_json(named_struct('database', 'clinic', 'table', '{name}', 'type', '{kind}', "
            f"'data', named_struct({fields}))) AS value",
            f"time + INTERVAL {delay} SECONDS AS time",
        )

    details = clicks.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("d"))
    return (
        change(clicks, "prescription", "insert", data["prescription"], 0)
        .unionAll(change(details, "prescription_detail", "insert", data["prescription_detail"], 2))
        .unionAll(change(clicks, "prescription", "update", data["payment"], 60))
    )


@pytest.fixture(scope="module")
def log(spark, small, tmp_path_factory):
    """The change log as text files, each later than the one before."""
    folder = str(tmp_path_factory.mktemp("log"))
    events = table(spark, small, "events")
    visits = ods(spark, small).where("table NOT LIKE 'prescription%'")
    timed = visits.select(
        F.to_json(F.struct("database", "table", "type", "data", "old")).alias("value"),
        F.coalesce("data.update_time", "data.create_time").cast("timestamp_ntz").alias("time"),
    ).unionAll(prescriptions(events))
    cuts = ["2024-01-01", "2024-01-10", "2024-01-20", "2024-03-01"]
    for start, end in zip(cuts, cuts[1:]):
        part = timed.where(f"time >= TIMESTAMP_NTZ '{start}' AND time < TIMESTAMP_NTZ '{end}'")
        part.coalesce(1).sortWithinPartitions("time").select("value").write.mode("append").text(folder)
    return folder


def read_log(spark, path, streaming, by_file=True):
    options = {"maxFilesPerTrigger": "1"} if streaming and by_file else {}
    return read_topic(spark, format="text", path=path, streaming=streaming, **options)


@pytest.mark.parametrize("name", FACTS)
def test_stream_equals_batch(spark, small, log, folder, name):
    batch_fact = build_fact(name, decode_envelope(read_log(spark, log, False), PAYLOAD_KEYS))
    fact_job(
        name,
        decode_envelope(read_log(spark, log, True), PAYLOAD_KEYS),
        format="text",
        path=f"{folder}/topic",
        checkpoint=f"{folder}/fact",
    ).awaitTermination()
    streamed_fact = read_fact(name, read_log(spark, f"{folder}/topic", False))
    assert rows(streamed_fact) == rows(batch_fact)

    dims = dimensions(spark, small)
    # A join writes its matches of ten days in several files, none in order: these are read at once.
    in_order = not name.startswith("prescription")
    summary_job(
        name,
        read_log(spark, f"{folder}/topic", True, in_order),
        dims,
        f"{folder}/out",
        HOW,
        checkpoint=f"{folder}/summary",
    ).awaitTermination()
    last = batch_fact.select(F.max(event_time(F.col(FACTS[name].time))).alias("last"))
    expected = build_summary(name, batch_fact, dims, HOW).where(
        F.col("edt").cast("timestamp") <= F.lit(last.first()["last"]) - F.expr("INTERVAL 5 SECONDS")
    )
    got = read_summary(spark, f"{folder}/out/{SUMMARIES[name].table}")
    assert got.columns == list(SUMMARIES[name].columns)
    assert rows(got) == rows(expected)
    assert got.count() > 0


def forget_last_commit(checkpoint):
    """As if the job had failed between its last micro-batch's output and the end of that micro-batch."""
    commits = sorted(Path(checkpoint, "commits").glob("[0-9]*"), key=lambda file: int(file.name))
    for part in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        part.unlink(missing_ok=True)


@pytest.mark.parametrize("name", ["consultation", "prescription"])
def test_dimensions_read_when_windows_close(spark, small, log, folder, name):
    fact = build_fact(name, decode_envelope(read_log(spark, log, False), PAYLOAD_KEYS))
    fact_job(name, decode_envelope(read_log(spark, log, False), PAYLOAD_KEYS), format="text", path=f"{folder}/topic")
    dims = dimensions(spark, small)
    seen = []

    def read_dims(windows):
        seen.append(windows.select("patient_id").distinct().count())
        return dims

    summary_job(
        name,
        read_log(spark, f"{folder}/topic", True, by_file=False),
        read_dims,
        f"{folder}/out",
        HOW,
        checkpoint=f"{folder}/summary",
        files=1,
    ).awaitTermination()
    last = fact.select(F.max(event_time(F.col(FACTS[name].time))).alias("last")).first()["last"]
    expected = build_summary(name, fact, dims, HOW).where(
        F.col("edt").cast("timestamp") <= F.lit(last) - F.expr("INTERVAL 5 SECONDS")
    )
    assert rows(read_summary(spark, f"{folder}/out/{SUMMARIES[name].table}")) == rows(expected)
    assert max(seen) > 0


def test_reviews_of_a_running_summary(spark, folder):
    """A doctor changes hospital: later reviewers are new there, whoever they reviewed before; a repeated batch changes nothing."""
    reviews = [
        [(0, "d", "u"), (1, "d", "u"), (2, "d", "v"), (15, "d", "u"), (30, "e", "w")],
        [(100, "d", "u"), (101, "d", "x"), (102, "e", "u"), (103, None, "u"), (104, None, None)],
        [(200, "d", "u"), (205, "e", "v"), (300, "d", "u")],
    ]
    hospital_of = {"d": "1", "e": "2"}
    names_of = spark.createDataFrame([("1", "One"), ("2", "Two")], "id string, name string")

    def read_dims(windows):
        doctors = spark.createDataFrame(list(hospital_of.items()), "id string, hospital_id string")
        return Dimensions(doctors, None, names_of, None)

    def run():
        summary_job("review", read_log(spark, f"{folder}/topic", True), read_dims, folder, HOW, checkpoint=f"{folder}/ckpt").awaitTermination()
        got = read_summary(spark, f"{folder}/{SUMMARIES['review'].table}").orderBy("stt", "hospital_id").collect()
        return [(r.stt[-5:], r.hospital_id, r.review_new_user_count, r.review_count) for r in got]

    for number, part in enumerate(reviews):
        made = [(json.dumps({"id": str(s), "review_time": f"2024-01-01 10:{s // 60:02d}:{s % 60:02d}", "rating": "5", "doctor_id": d, "user_id": u}),) for s, d, u in part]
        spark.createDataFrame(made, "value string").coalesce(1).write.mode("append").text(f"{folder}/topic")
        got = run()
        if number == 1:
            forget_last_commit(f"{folder}/ckpt")
            hospital_of["d"] = "2"  # the repeated batch gives out what it gave out before
            assert run() == got == [("00:00", "1", 2, 3), ("00:10", "1", 0, 1), ("00:30", "2", 1, 1)]
    assert got == [
        ("00:00", "1", 2, 3),
        ("00:10", "1", 0, 1),
        ("00:30", "2", 1, 1),
        ("01:40", None, 2, 2),
        ("01:40", "2", 2, 3),
        ("03:20", "2", 1, 2),
    ]


def test_only_summaries_with_dimensions_read_them_late(spark, folder):
    with pytest.raises(ValueError):
        summary_job("user_register", spark.createDataFrame([], "value string"), lambda rows: None, folder)


@pytest.mark.parametrize("join, options", [(interval_join, {}), (interval_join, {"salts": 3}), (ttl_join, {})])
def test_join_state_is_dropped_behind_the_watermark(spark, folder, join, options):
    for start in (0, 2000, 4000):
        made = spark.range(start, start + 2000).selectExpr("concat('k', id % 50) AS k", "timestamp_seconds(id * 60) AS t")
        made.coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def side(name):
        stream = spark.readStream.schema("k string, t timestamp").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        return stream.select(F.col("k").alias(f"{name}_k"), F.col("t").alias(f"{name}_t"))

    joined = join(side("left"), side("right"), "left_k", "right_k", "left_t", "right_t", **options)
    query = (
        joined.writeStream.format("noop")
        .option("checkpointLocation", f"{folder}/ckpt")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    kept = [progress["stateOperators"][0]["numRowsTotal"] for progress in query.recentProgress]
    assert kept[0] > 1000 and kept[-1] < 100


def clock(spark, *seconds):
    base = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return spark.createDataFrame([(float(s), f"k{int(s)}") for s in seconds], "s double, k string").select(
        (base + F.make_dt_interval(secs=F.col("s").cast("decimal(18,6)"))).alias("event_time"), "k"
    )


def count_stream(spark, folder, steps, deduplicate=False, **options):
    """Feeds the steps as one file each and counts per window."""
    for step in steps:
        clock(spark, *step).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = (
        spark.readStream.schema("event_time timestamp, k string")
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{folder}/in")
    )
    if deduplicate:
        stream = first_row(stream.withWatermark("event_time", "5 seconds"), ["k"], **options)
    counted = with_bounds(tumbling(stream, [F.count(F.lit(1)).alias("n")]))
    write_summary(counted, f"{folder}/out", f"{folder}/ckpt").awaitTermination()
    return [(row.stt[-5:], row.n) for row in read_summary(spark, f"{folder}/out").orderBy("stt").collect()]


def test_late_rows_are_dropped(spark, folder):
    got = count_stream(spark, folder, [(1, 2, 100), (200,), (3, 300)])
    assert got == [("00:00", 2), ("01:40", 1), ("03:20", 1)]


def test_rows_out_of_order_within_the_delay_count(spark, folder):
    assert count_stream(spark, folder, [(1, 14), (9,), (100,)]) == [("00:00", 2), ("00:10", 1)]


def test_last_window_stays_open(spark, folder):
    assert count_stream(spark, folder, [(1,), (12,)]) == []
    assert count_stream(spark, folder, [(15,)]) == [("00:00", 1)]


def test_first_row_of_a_stream(spark, folder):
    got = count_stream(spark, folder, [(1, 1.5), (1.7, 12), (12.5, 40)], deduplicate=True)
    assert got == [("00:00", 1), ("00:10", 1)]


def test_first_row_of_a_stream_with_bounded_state(spark, folder):
    got = count_stream(spark, folder, [(1, 1.5), (12,), (40,)], deduplicate=True, within_watermark=True)
    assert got == [("00:00", 1), ("00:10", 1)]


def test_a_batch_that_runs_again_keeps_its_rows_once(spark, folder):
    count_stream(spark, folder, [(1, 2), (30,)])
    before = rows(read_summary(spark, f"{folder}/out"))
    forget_last_commit(f"{folder}/ckpt")
    assert count_stream(spark, folder, [(31,)]) == [("00:00", 2)]
    assert rows(read_summary(spark, f"{folder}/out")) == before


def test_topic_stream_goes_on_from_its_checkpoint(spark, folder):
    def run():
        source = spark.readStream.schema(
            "database string, table string, type string, data map<string,string>, old map<string,string>"
        ).parquet(f"{folder}/ods")
        fact_job(
            "consultation", source, format="text", path=f"{folder}/topic", checkpoint=f"{folder}/ckpt"
        ).awaitTermination()
        return sorted(row.id for row in read_fact("consultation", read_log(spark, f"{folder}/topic", False)).collect())

    def add(number):
        spark.sql(
            f"SELECT 'clinic' AS database, 'consultation' AS table, 'insert' AS type, map('id', '{number}') AS data, "
            "CAST(NULL AS map<string,string>) AS old"
        ).write.mode("append").parquet(f"{folder}/ods")

    add(1)
    assert run() == ["1"]
    add(2)
    assert run() == ["1", "2"]


@pytest.mark.parametrize("form", ["landed", "topic"])
def test_what_lands_twice_is_read_once(spark, folder, form):
    """A named batch, and a micro-batch that runs again, between two reads of a stream further down."""
    made = spark.sql("SELECT 'clinic' AS database, 'user' AS table, 'insert' AS type, map('id', '1') AS data, CAST(NULL AS map<string,string>) AS old, 1L AS seq")

    def land(source, **how):
        if form == "landed":
            return land_ods(source, f"{folder}/out", **how)
        return fact_job("user_register", source, format="text", path=f"{folder}/out", **how)

    def downstream():
        stream = read_landed(spark, f"{folder}/out", streaming=True) if form == "landed" else read_log(spark, f"{folder}/out", True)
        names = stream.select(F.col("data")["id"] if form == "landed" else F.col("value"))
        writer = names.writeStream.format("parquet").option("checkpointLocation", f"{folder}/down").trigger(availableNow=True)
        writer.start(f"{folder}/read").awaitTermination()
        return spark.read.parquet(f"{folder}/read").count()

    land(made, run="r")
    assert downstream() == 1
    land(made, run="r")
    assert downstream() == 1
    made.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(made.schema).parquet(f"{folder}/in")
    for _ in range(2):
        land(stream, checkpoint=f"{folder}/ckpt").awaitTermination()
        assert downstream() == 2
        forget_last_commit(f"{folder}/ckpt")
    land(made.withColumn("data", F.create_map(F.lit("id"), F.lit("2"))), run="r")  # other rows under the name replace it
    back = read_landed(spark, f"{folder}/out") if form == "landed" else read_log(spark, f"{folder}/out", False)
    assert back.count() == 2 and not list(Path(folder, "out").glob("_staging/*"))


def test_a_failed_write_is_never_seen(spark, folder):
    turn, table = Turn("r", 0, streamed=True), spark.range(3)

    def fail(name):
        table.write.parquet(name)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        write_once(spark, folder, turn, fail, spark.read.parquet)
    assert not Path(folder, "run=r").exists()
    write_once(spark, folder, turn, table.write.parquet, spark.read.parquet)
    write_once(spark, folder, turn, spark.range(9).write.parquet, spark.read.parquet)
    assert spark.read.parquet(f"{folder}/run=r/batch_id=0").count() == 3


def test_seen_keys(spark, folder, monkeypatch):
    monkeypatch.setattr("careflow.sinks.seen.MERGE_FROM", 3)
    seen = SeenKeys(spark, folder, ["user", "place"])
    table = lambda *keys: spark.createDataFrame([(*key, 7) for key in keys], "user string, place string, n int")
    read = lambda df: rows(df.select("user", "place", "n"))
    assert read(seen.new(table(("a", "1"), (None, "1")), Turn("s", 0, True))) == [("a", "1", 7), (None, "1", 7)]
    assert read(seen.new(table(("a", "1")), Turn("s", 1, True))) == []
    for number in range(2, 9):
        added = seen.new(table(("a", "1"), (None, "1"), ("a", None), ("b", str(number))), Turn("s", number, True))
        assert len(read(added)) == 1 + (number == 2)
        assert read(seen.new(table(("zz", "9")), Turn("s", number, True))) == read(added)
    assert len(list(Path(folder).glob("run=*/batch_id=*"))) < 6


def test_first_flag_of_a_stream(spark, folder):
    """Flags by arrival; rows that are not first come out when the watermark has passed them."""
    steps = [[(1, "a", 1), (2, "a", 2), (3, None, 3)], [(4, "b", 4), (4, "b", 5), (5, "a", 6), (6, None, 7)], [(60, "c", 8)]]
    for step in steps:
        made = spark.createDataFrame(step, "s int, k string, id int")
        clocked = made.selectExpr("timestamp_seconds(1704067200 + s) AS event_time", "k", "id")
        clocked.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(clocked.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        flagged = first_flag(stream.withWatermark("event_time", "5 seconds"), ["k"], ["event_time", "id"], "is_first")
        assert flagged.columns == ["event_time", "k", "id", "is_first"]
        write_summary(flagged.drop("event_time"), f"{folder}/out", f"{folder}/ckpt").awaitTermination()
    got = {r.id: r.is_first for r in read_summary(spark, f"{folder}/out").collect()}
    assert got == {1: 1, 2: 0, 3: 1, 4: 1, 5: 0, 6: 0, 7: 0, 8: 1}


def test_a_join_in_time_order_forgets_old_rows(spark, folder, monkeypatch):
    """Slices by time of two tables out of order, with ties and null times: all pairs, and state of the last rows only."""
    monkeypatch.setattr(streams, "working_folder", lambda spark, purpose: f"{folder}/work")
    time = "CASE WHEN id % 97 != 0 THEN timestamp_seconds(1704067200 + floor(pmod(id * 7919, 2000) / 4) * 60) END"
    left = spark.range(2000).selectExpr("concat('k', id % 5) AS lk", f"{time} AS lt", "id AS li")
    right = spark.range(2000).selectExpr("concat('k', id % 5) AS rk", f"{time} + INTERVAL 3 SECONDS AS rt", "id AS ri")

    def build(a, b):
        return ttl_join(a, b, "lk", "rk", "lt", "rt").select("li", "ri")

    got = streams.run_in_time_order([(left, "lt"), (right, "rt")], build, "order", at_once=500)
    assert rows(got) == rows(build(left, right)) != []
    assert len(os.listdir(f"{folder}/work/input/0")) > 5
    for side in ("left", "right"):
        assert spark.read.format("statestore").option("joinSide", side).load(f"{folder}/work/checkpoint").count() < 200


def test_a_join_in_time_order_has_few_partitions_of_state(spark, folder, monkeypatch):
    """Each writes files at every micro-batch, so a session's many shuffle partitions are not taken over."""
    monkeypatch.setattr(streams, "working_folder", lambda spark, purpose: f"{folder}/work")
    left = spark.range(40).selectExpr("concat('k', id % 5) AS lk", "timestamp_seconds(1704067200 + id) AS lt", "id AS li")
    right = left.toDF("rk", "rt", "ri")
    former = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        build = lambda a, b: ttl_join(a, b, "lk", "rk", "lt", "rt").select("li", "ri")
        got = rows(streams.run_in_time_order([(left, "lt"), (right, "rt")], build, "few"))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "24"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", former)
    assert got == rows(build(left, right)) != []
    assert len([name for name in os.listdir(f"{folder}/work/checkpoint/state/0") if name.isdigit()]) < 24


def test_a_long_replay_is_dealt_by_key(spark, folder, monkeypatch):
    """A stream for each group of keys: all pairs with a hot key and with null keys and times, of keys in two types."""
    monkeypatch.setattr(streams, "working_folder", lambda spark, purpose: f"{folder}/work")
    monkeypatch.setattr(streams, "SLICES_AT_MOST", 2)
    key = "CASE WHEN id % 89 != 0 THEN CASE WHEN id % 2 = 0 THEN 7 ELSE id % 50 END END"
    time = "CASE WHEN id % 97 != 0 THEN timestamp_seconds(1704067200 + floor(pmod(id * 7919, 2000) / 4) * 60) END"
    left = spark.range(2000).selectExpr(f"CAST({key} AS INT) AS lk", f"{time} AS lt", "id AS li")
    right = spark.range(2000).selectExpr(f"{key} AS rk", f"{time} + INTERVAL 3 SECONDS AS rt", "id AS ri")

    def build(a, b):
        return ttl_join(a, b, "lk", "rk", "lt", "rt").select("li", "ri")

    got = streams.run_in_time_order([(left, "lt"), (right, "rt")], build, "dealt", at_once=800, keys=["lk", "rk"])
    assert rows(got) == rows(build(left, right)) != []
    assert len([name for name in os.listdir(f"{folder}/work") if name.isdigit()]) == 3


def test_slices_are_found_by_halving(spark):
    """The number of cuts up to a moment, which itself belongs to the slice after it."""
    cuts = [3, 5, 6, 11, 20, 21, 40]
    got = spark.range(45).select("id", streams._slice_of(F.col("id"), cuts, 100).alias("slice")).collect()
    assert [r.slice for r in got] == [100 + sum(cut <= r.id for cut in cuts) for r in got]
