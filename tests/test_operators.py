import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from careflow.operators import first_flag, first_row, hot_keys, interval_join, lookup, lookup_hot, ttl_join, tumbling, with_bounds
from tests.conftest import plan_of, rows

START = dt.datetime(2024, 1, 1, 12)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


LEFT = "det long, left_key string, left_time timestamp"
RIGHT = "pay long, right_key string, right_time timestamp"


def joined(left, right, **options):
    result = interval_join(left, right, "left_key", "right_key", "left_time", "right_time", **options)
    return rows(result.select("det", "pay"))


@pytest.mark.parametrize(
    "offset, matches",
    [(-900, True), (-901, False), (5, True), (6, False), (0, True), (-899.999999, True), (5.000001, False)],
)
def test_interval_bounds(spark, offset, matches):
    left = spark.createDataFrame([(1, "k", at(offset))], LEFT)
    right = spark.createDataFrame([(2, "k", START)], RIGHT)
    assert joined(left, right) == ([(1, 2)] if matches else [])


@pytest.mark.parametrize(
    "before, after, salts",
    [(900, 5, 1), (900, 5, 4), (30, 0, 1), (0, 0, 1), (0, 45, 1), (0.25, 0.25, 3), (7200, 7200, 1)],
)
def test_interval_join_equals_all_pairs(spark, before, after, salts):
    """One key holds a third of both sides; some keys and times are missing; times lie before 1970 too."""
    chance = random.Random(3)
    span = 3_000_000 if after + before > 1 else 100_000

    def side(count, base):
        made = []
        for number in range(count):
            key = "hot" if chance.random() < 0.33 else chance.choice(["a", "b", "c", None])
            time = base + dt.timedelta(milliseconds=chance.randrange(0, span, 250))
            made.append((number, key, None if chance.random() < 0.05 else time))
        return made

    for base in (START, dt.datetime(1969, 12, 31, 23, 30)):
        left, right = side(150, base), side(120, base)
        before_span, after_span = dt.timedelta(seconds=before), dt.timedelta(seconds=after)
        expected = sorted(
            (
                (det, pay)
                for det, key, time in left
                for pay, other, moment in right
                if key and key == other and time and moment
                and moment - before_span <= time <= moment + after_span
            ),
            key=repr,
        )
        assert expected
        assert joined(
            spark.createDataFrame(left, LEFT),
            spark.createDataFrame(right, RIGHT),
            before=before_span,
            after=after_span,
            salts=salts,
        ) == expected


def test_interval_join_meets_on_key_and_slice(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(10).selectExpr("id AS det", "concat('k', id) AS left_key", "timestamp_seconds(id) AS left_time")
        right = spark.range(10).selectExpr("id AS pay", "concat('k', id) AS right_key", "timestamp_seconds(id) AS right_time")
        plan = plan_of(interval_join(left, right, "left_key", "right_key", "left_time", "right_time"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "_left_slice" in plan.split("SortMergeJoin")[1].split("\n")[0]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("salts", [1, 4])
def test_ttl_join_of_batches_has_every_pair(spark, salts):
    heads = spark.createDataFrame([("p", START), ("q", START), (None, START)], "head string, head_time timestamp")
    details = spark.createDataFrame(
        [(n, "p" if n % 3 else "q", at(100 * n)) for n in range(60)] + [(99, "r", START), (98, None, START)],
        "det long, of string, det_time timestamp",
    )
    got = ttl_join(heads, details, "head", "of", "head_time", "det_time", ttl=None, salts=salts)
    assert got.columns == ["head", "head_time", "det", "of", "det_time"]
    assert rows(got.select("det", "head")) == sorted(
        ((n, "p" if n % 3 else "q") for n in range(60)), key=repr
    )
    near = ttl_join(heads, details, "head", "of", "head_time", "det_time", salts=salts)
    assert rows(near.select("det", "head")) == [(0, "q")]


def test_parameters_without_effect_are_refused(spark):
    batch = spark.createDataFrame([("k", START)], "k string, t timestamp")
    with pytest.raises(ValueError):
        first_row(batch, ["k"], within_watermark=True)
    streams = [spark.readStream.format("rate").load().selectExpr(f"value AS {n}", f"timestamp AS {n}_time") for n in "ab"]
    with pytest.raises(ValueError):
        ttl_join(*streams, "a", "b", "a_time", "b_time", ttl=None)


@pytest.mark.parametrize("salts", [1, 5])
def test_lookup(spark, salts):
    facts = spark.createDataFrame(
        [(n, "d1" if n % 3 else "d2") for n in range(30)] + [(97, "unknown"), (98, None)],
        "id long, doctor_id string",
    )
    doctors = spark.createDataFrame([("d1", "h1", "x"), ("d2", None, "x")], "id string, hospital_id string, name string")
    got = lookup(facts, doctors, "doctor_id", {"hospital_id": "hospital_id", "name": "label"}, salts=salts)
    assert got.columns == ["id", "doctor_id", "hospital_id", "label"]
    expected = [(n, "d1", "h1", "x") if n % 3 else (n, "d2", None, "x") for n in range(30)]
    expected += [(97, "unknown", None, None), (98, None, None, None)]
    assert rows(got) == sorted(expected, key=repr)


def test_lookup_broadcasts_only_what_is_small(spark):
    facts = spark.range(100).selectExpr("id", "CAST(id AS STRING) AS doctor_id")
    dim = spark.range(100).selectExpr("CAST(id AS STRING) AS id", "'h' AS hospital_id")
    build = lambda: lookup(facts, dim, "doctor_id", {"hospital_id": "hospital_id"})
    assert "BroadcastHashJoin" in plan_of(build())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert "SortMergeJoin" in plan_of(build())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


DETAIL = "prescription_id string, event_time timestamp, id string, amount double"


def details(count=300):
    chance = random.Random(5)
    made = []
    for number in range(count):
        key = "hot" if chance.random() < 0.33 else f"p{chance.randrange(20)}"
        made.append((key, at(chance.randrange(40)), str(number % 50), float(number % 3)))
    return made + made[:30]


def test_first_row(spark):
    made = details()
    frame = spark.createDataFrame(made, DETAIL).repartition(6)
    expected = {}
    for row in sorted(made, key=lambda r: (r[1], r[2], r[3])):
        expected.setdefault(row[0], row)
    got = first_row(frame, ["prescription_id"], ["event_time", "id"])
    assert rows(got) == sorted(expected.values(), key=repr)


def test_first_row_is_reduced_before_the_shuffle(spark):
    frame = spark.createDataFrame(details(), DETAIL)
    before_shuffle = plan_of(first_row(frame, ["prescription_id"], ["event_time"])).split("Exchange")[1]
    assert "partial_min" in before_shuffle


@pytest.mark.parametrize("salts", [1, 3, 32])
def test_first_flag(spark, salts):
    """Exactly one flag per key, on the first row, also among rows that are equal in every column."""
    made = details()
    frame = spark.createDataFrame(made, DETAIL).repartition(6)
    got = first_flag(frame, ["prescription_id"], ["event_time", "id"], "is_first", salts=salts)
    assert got.columns == [*frame.columns, "is_first"]
    flagged = [tuple(row) for row in got.collect()]
    assert sorted((row[:4] for row in flagged), key=repr) == sorted(made, key=repr)
    expected = {}
    for row in sorted(made, key=lambda r: (r[1], r[2], r[3])):
        expected.setdefault(row[0], row)
    assert sorted((row[:4] for row in flagged if row[4] == 1), key=repr) == sorted(
        expected.values(), key=repr
    )


def test_first_flag_for_each_pair(spark):
    visits = spark.createDataFrame(
        [("u", "h1", at(0), "1"), ("u", "h1", at(1), "2"), ("u", "h2", at(2), "3")],
        "user_id string, hospital_id string, event_time timestamp, id string",
    )
    got = first_flag(visits, ["user_id", "hospital_id"], ["event_time", "id"], "new")
    assert [row.new for row in got.orderBy("id").collect()] == [1, 0, 1]


def test_tumbling(spark):
    timed = spark.createDataFrame(
        [(at(0), "a", 1), (at(9.999), "a", 2), (at(10), "a", 4), (at(10), "b", 8), (None, "a", 16)],
        "event_time timestamp, k string, v int",
    )
    got = with_bounds(tumbling(timed, [F.sum("v").alias("v")], ["k"]))
    assert got.columns == ["stt", "edt", "cur_date", "k", "v"]
    zone_shift = F.date_format(F.lit(START), "yyyy-MM-dd HH:mm:ss")
    first = timed.select(zone_shift).first()[0]
    assert rows(got)[0] == (first, first[:-2] + "10", "2024-01-01", "a", 3)
    assert [row[3:] for row in rows(got)] == [("a", 3), ("a", 4), ("b", 8)]


def test_daily_batch_windows_follow_the_wall_clock(spark):
    timed = spark.createDataFrame([("2024-01-01 00:00:01",), ("2024-01-01 23:59:59",)], "t string").select(
        F.col("t").cast("timestamp").alias("event_time")
    )
    got = with_bounds(tumbling(timed, [F.count(F.lit(1)).alias("n")], size="1 day"))
    assert rows(got) == [("2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-01", 2)]


def test_window_aggregation_is_partial_before_the_shuffle(spark):
    timed = spark.range(10).select(F.timestamp_seconds("id").alias("event_time"))
    plan = plan_of(tumbling(timed, [F.count(F.lit(1)).alias("n")]))
    assert "partial_count" in plan.split("Exchange")[1]


def test_only_hot_keys_are_spread(spark):
    """Two keys with a third of the rows each, nulls, keys without a match; the rest of the dimension is not repeated."""
    made = [(n, "a" if n % 3 == 0 else "b" if n % 3 == 1 else None if n % 50 == 2 else f"k{n}") for n in range(3000)]
    rows_of = spark.createDataFrame(made, "n int, k string").repartition(5)
    dim = spark.createDataFrame([("a", 1), ("b", 2), *((f"k{n}", n) for n in range(0, 3000, 2))], "id string, v int")
    assert sorted(hot_keys(rows_of, "k", 0.1)) == ["a", "b"]
    got = lookup_hot(rows_of, dim, "k", {"v": "v"}, share=0.1, salts=16)
    assert rows(got) == rows(lookup(rows_of, dim, "k", {"v": "v"})) and got.columns == ["n", "k", "v"]
    assert hot_keys(rows_of.where("n < 0"), "k") == [] and lookup_hot(rows_of.limit(0), dim, "k", {"v": "v"}).count() == 0
    repeated = got._jdf.queryExecution().optimizedPlan().toString().split("Join")[1]
    assert "explode" in repeated and "CASE WHEN" in repeated
