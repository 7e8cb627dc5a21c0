import json
import random
import re

import pytest
from pyspark.sql import functions as F

from careflow.operators import apply_changes, deleted_keys, latest_routes, route, route_versions, table_lifecycle
from careflow.schemas import ROUTE_COLUMNS
from careflow.sinks import DimensionStore
from careflow.sources import decode_config
from careflow.streaming import dimension_job
from tests.conftest import plan_of, rows

CHANGE = "database string, table string, type string, data map<string,string>, old map<string,string>, seq long"
ROUTE = "source_table string, sink_table string, sink_family string, sink_columns string, sink_row_key string"


def image(source="patient", sink="dim_patient", columns="id,name"):
    return {
        "source_table": source,
        "sink_table": sink,
        "sink_family": "info",
        "sink_columns": columns,
        "sink_row_key": "id",
    }


def config(spark, *changes):
    """Each change is (op, before, after)."""
    records = [
        (json.dumps({"op": op, "before": before, "after": after}), seq)
        for seq, (op, before, after) in enumerate(changes)
    ]
    return decode_config(spark.createDataFrame(records, "value string, seq long"))


def changes(spark, *items):
    """Each item is (table, type, data, old); seq counts up."""
    return spark.createDataFrame(
        [("clinic", *item, seq) for seq, item in enumerate(items)], CHANGE
    )


@pytest.fixture
def routes(spark):
    return spark.createDataFrame(
        [tuple(image().values()), tuple(image("doctor", "dim_doctor", "id,hospital_id").values())], ROUTE
    )


@pytest.mark.parametrize("salts", [1, 8])
def test_routing(spark, routes, salts):
    log = changes(
        spark,
        ("patient", "insert", {"id": "1", "name": "a", "secret": "x"}, None),
        ("patient", "bootstrap-start", {"id": "2"}, None),
        ("patient", "bootstrap-complete", {"id": "2"}, None),
        ("patient", "bootstrap-insert", {"id": "3", "name": None}, None),
        ("unrouted", "insert", {"id": "4"}, None),
        ("doctor", "delete", None, {"id": "5", "secret": "x"}),
        ("doctor", "delete", {"id": "6"}, None),
        ("doctor", "update", {"hospital_id": "7"}, None),
    )
    assert rows(route(log, routes, salts)) == [
        ("dim_doctor", "5", "delete", {"id": "5", "secret": "x"}, 5),
        ("dim_doctor", "6", "delete", {"id": "6"}, 6),
        ("dim_patient", "1", "insert", {"id": "1", "name": "a"}, 0),
        ("dim_patient", "3", "bootstrap-insert", {"id": "3", "name": None}, 3),
    ]


def test_latest_routes(spark):
    log = config(
        spark,
        ("r", None, image("a", "dim_a")),
        ("c", None, image("b", "dim_b")),
        ("u", image("a", "dim_a"), image("a", "dim_a", "id")),
        ("d", image("b", "dim_b"), None),
        ("c", None, image("c", "dim_c")),
        ("u", image("c", "dim_c"), image("d", "dim_c")),
        ("d", image("e", "dim_e"), None),
        ("c", None, image("e", "dim_e", "id,x")),
    )
    got = latest_routes(log).select("source_table", "sink_table", "sink_columns")
    assert rows(got) == [("a", "dim_a", "id"), ("d", "dim_c", "id,name"), ("e", "dim_e", "id,x")]


def test_preloaded_routes_give_way_to_changes(spark):
    preloaded = spark.createDataFrame(
        [tuple(image(name, f"dim_{name}").values()) for name in "abcd"], ROUTE
    )
    log = config(
        spark,
        ("d", image("a", "dim_a"), None),
        ("u", image("b", "dim_b"), image("b", "dim_b", "id")),
        ("u", image("c", "dim_c"), image("e", "dim_c")),
    )
    got = latest_routes(log, preloaded=preloaded).select("source_table", "sink_columns")
    assert rows(got) == [("b", "id"), ("d", "id,name"), ("e", "id,name")]


def test_table_lifecycle(spark):
    log = config(
        spark,
        ("r", None, image("a", "dim_a")),
        ("u", image("a", "dim_a"), image("a", "dim_a2")),
        ("c", None, image("b", "dim_b")),
        ("d", image("b", "dim_b"), None),
        ("c", None, image("c", "dim_c")),
        ("u", image("c", "dim_c"), image("c", "dim_c")),
    )
    assert rows(table_lifecycle(log)) == [
        ("dim_a", False, 1),
        ("dim_a2", True, None),
        ("dim_b", False, 3),
        ("dim_c", True, 5),
    ]


PUTS = "row_key string, seq long, type string, a string, b string"


@pytest.mark.parametrize(
    "log, expected",
    [
        ([("k", 1, "insert", "1", None), ("k", 2, "update", None, None)], [("k", "1", None, 2)]),
        (
            [("k", 1, "insert", "1", "2"), ("k", 2, "delete", None, None), ("k", 3, "insert", "9", None)],
            [("k", "9", None, 3)],
        ),
        ([("k", 1, "insert", "1", "2"), ("k", 2, "delete", "1", "2")], []),
        ([("k", 5, "delete", None, None), ("k", 3, "insert", "1", None)], []),
        ([("k", 2, "update", "new", None), ("k", 1, "insert", "old", "b")], [("k", "new", "b", 2)]),
    ],
)
def test_upsert_cases(spark, log, expected):
    assert rows(apply_changes(spark.createDataFrame(log, PUTS), ["a", "b"])) == expected


def replay(log):
    """The same, one change after the other."""
    table, gone = {}, {}
    for key, seq, kind, a, b in sorted(log, key=lambda change: change[1]):
        if kind == "delete":
            table.pop(key, None)
            gone[key] = seq
        else:
            row = table.setdefault(key, {"a": None, "b": None})
            row.update({name: value for name, value in (("a", a), ("b", b)) if value is not None})
            row["seq"] = seq
            gone.pop(key, None)
    return table, gone


def random_log(seed, count):
    chance = random.Random(seed)
    seqs = chance.sample(range(10 * count), count)
    values = [None, "x", "y", "z"]
    return [
        (
            # One key holds a third of all changes.
            "hot" if chance.random() < 0.33 else f"k{chance.randrange(40)}",
            seq,
            "delete" if chance.random() < 0.15 else "update",
            chance.choice(values),
            chance.choice(values),
        )
        for seq in seqs
    ]


@pytest.mark.parametrize("seed", range(3))
def test_upsert_equals_replay(spark, seed):
    log = random_log(seed, 600)
    table, gone = replay(log)
    frame = spark.createDataFrame(log, PUTS).repartition(7)
    expected = sorted(((k, r["a"], r["b"], r["seq"]) for k, r in table.items()), key=repr)
    assert rows(apply_changes(frame, ["a", "b"])) == expected
    assert rows(deleted_keys(frame)) == sorted(gone.items(), key=repr)


def test_upsert_in_two_steps_equals_one(spark):
    log = sorted(random_log(9, 400), key=lambda change: change[1])
    early = apply_changes(spark.createDataFrame(log[:250], PUTS), ["a", "b"])
    both = apply_changes(spark.createDataFrame(log[250:], PUTS), ["a", "b"], current=early)
    assert rows(both) == rows(apply_changes(spark.createDataFrame(log, PUTS), ["a", "b"]))


def store_of(spark, folder, *batches):
    """A store with these batches of (kind, id, columns, seq) for patients."""
    store = DimensionStore(spark, folder)
    for number, batch in enumerate(batches):
        put(spark, store, number, *batch)
    return store


def put(spark, store, number, *items, run=""):
    rows_of = [("dim_patient", key, kind, data, seq) for kind, key, data, seq in items]
    schema = "sink_table string, row_key string, type string, data map<string,string>, seq long"
    store.append(spark.createDataFrame(rows_of, schema), number, run)


def names(store, *columns, **options):
    return rows(store.read("dim_patient", ["id", *(columns or ("name",))], **options))


def test_store_reads_what_was_put(spark, routes, folder):
    store = DimensionStore(spark, folder)
    first = changes(
        spark,
        ("patient", "insert", {"id": "1", "name": "a"}, None),
        ("patient", "insert", {"id": "2", "name": "b"}, None),
        ("doctor", "insert", {"id": "9", "hospital_id": "3"}, None),
    )
    later = changes(
        spark,
        ("patient", "update", {"id": "1", "name": None}, None),
        ("patient", "delete", None, {"id": "2"}),
        ("patient", "insert", {"id": "3", "name": "c"}, None),
    ).withColumn("seq", F.col("seq") + 10)
    store.append(route(first, routes), 0)
    store.append(route(later, routes), 1)
    expected = [("1", "a"), ("3", "c")]
    assert names(store) == expected
    assert rows(store.read("dim_doctor", ["id", "hospital_id"])) == [("9", "3")]

    # A batch that runs again changes nothing, neither does a snapshot of all tables.
    store.append(route(later, routes), 1)
    assert names(store) == expected
    assert store.compact() == 1 and store.compact() is None
    assert names(store) == expected
    assert rows(store.read("dim_doctor", ["id", "hospital_id"])) == [("9", "3")]
    store.append(route(later, routes), 1)
    assert names(store) == expected


def test_a_read_opens_only_what_follows_the_snapshot(spark, folder):
    store = store_of(spark, folder, *([("insert", str(n), {"name": f"n{n}"}, n)] for n in range(3)))
    store.compact()
    put(spark, store, 3, ("insert", "7", {"name": "n7"}, 7))
    opened = store.read("dim_patient", ["id", "name"]).inputFiles()
    folders = [re.search(r"(changes/run=direct/batch_id|snapshots/number)=(\d+)", name) for name in opened]
    assert {found.groups() for found in folders} == {("snapshots/number", "1"), ("changes/run=direct/batch_id", "3")}
    store.compact()  # what the first snapshot covers goes
    assert spark.read.parquet(f"{folder}/changes").select("batch_id").distinct().count() == 1
    assert names(store) == [("0", "n0"), ("1", "n1"), ("2", "n2"), ("7", "n7")]


def test_compaction_passes_a_batch_that_failed(spark, folder):
    """What a failed batch left is not in the way of snapshots; when it runs again, its changes count."""
    store = store_of(spark, folder, [("insert", "1", {"name": "a"}, 1)])
    broken = spark.range(1).selectExpr("'dim_patient' AS sink_table", "string(id) AS row_key", "raise_error('lost') AS type", "map('name', 'b') AS data", "id AS seq")
    with pytest.raises(Exception, match="lost"):
        store.append(broken, 1)
    for number in (2, 3, 4):
        put(spark, store, number, ("insert", str(number), {"name": "c"}, number))
        assert store.compact() == number - 1
    put(spark, store, 1, ("insert", "9", {"name": "late"}, 9))
    assert store.compact() == 4 and store.compact() is None
    assert names(store) == [("1", "a"), ("2", "c"), ("3", "c"), ("4", "c"), ("9", "late")]
    assert spark.read.parquet(f"{folder}/changes").select("batch_id").distinct().count() == 1


def test_a_snapshot_keeps_all_columns(spark, folder):
    store = store_of(spark, folder, [("insert", "1", {"name": "a", "gender": "101"}, 0)])
    store.compact()
    put(spark, store, 1, ("update", "1", {"age": "7"}, 5))
    assert names(store, "name", "gender", "age") == [("1", "a", "101", "7")]


@pytest.mark.parametrize("seed", range(2))
def test_snapshots_anywhere_change_nothing(spark, folder, seed):
    """Late puts stay behind deletes, and columns in their own order, whatever was snapshotted before."""
    log = random_log(seed, 60)
    items = [(kind, key, {k: v for k, v in (("a", a), ("b", b)) if v is not None}, seq) for key, seq, kind, a, b in log]
    plain, short = DimensionStore(spark, f"{folder}/plain"), DimensionStore(spark, f"{folder}/short")
    for number in range(3):
        for store in (plain, short):
            put(spark, store, number, *items[20 * number : 20 * number + 20])
        short.compact()
    table, _ = replay(log)
    assert names(short, "a", "b") == names(plain, "a", "b") == sorted(((k, r["a"], r["b"]) for k, r in table.items()), key=repr)


def test_late_put_after_a_delete_in_the_snapshot(spark, folder):
    store = store_of(spark, folder, [("insert", "1", {"name": "a"}, 1), ("delete", "1", {}, 5)])
    store.compact()
    put(spark, store, 1, ("update", "1", {"name": "late"}, 3))
    assert names(store) == []


def test_runs_do_not_replace_each_other(spark, folder):
    store = DimensionStore(spark, folder)
    put(spark, store, 0, ("insert", "1", {"name": "a"}, 1), run="one")
    put(spark, store, 0, ("insert", "2", {"name": "b"}, 2), run="two")
    put(spark, store, 0, ("insert", "3", {"name": "c"}, 3), run="two")
    assert names(store) == [("1", "a"), ("3", "c")]


def test_store_reads_only_some_keys(spark, folder):
    store = store_of(spark, folder, [("insert", str(n), {"name": f"n{n}"}, n) for n in range(9)])
    store.compact()
    put(spark, store, 1, *(("update", str(n), {"name": f"m{n}"}, n + 50) for n in range(4)))
    keys = spark.createDataFrame([("2",), ("7",), ("2",), (None,)], "patient string")
    assert names(store, only=keys) == [("2", "m2"), ("7", "n7")]
    plan = plan_of(store.read("dim_patient", ["name"], only=keys))
    assert "LeftSemi" in plan and "bucket" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_a_read_of_a_few_keys_opens_their_part_of_the_snapshot(spark, folder):
    store = store_of(spark, folder, [("insert", str(n), {"name": f"n{n}"}, n) for n in range(500)])
    store.compact()
    keys = spark.createDataFrame([("2",), ("7",)], "patient string")
    opened = lambda only: store._log(1, [], only).select(F.input_file_name().alias("f")).distinct().count()
    assert opened(keys) == len({r.b for r in keys.select(F.pmod(F.xxhash64("patient"), F.lit(16)).alias("b")).collect()}) <= 2
    assert opened(None) == 16
    assert names(store, only=keys) == [("2", "n2"), ("7", "n7")]
    other = DimensionStore(spark, folder, buckets=3)  # from the next snapshot on
    assert names(other, only=keys) == [("2", "n2"), ("7", "n7")]
    put(spark, other, 1, ("update", "7", {"name": "m7"}, 900))
    other.compact()
    assert names(store, only=keys) == [("2", "n2"), ("7", "m7")]
    assert names(store, only=keys.limit(0)) == []


def test_a_missing_store_is_an_error(spark, folder):
    with pytest.raises(FileNotFoundError):
        DimensionStore(spark, f"{folder}/mistyped").read("dim_patient", ["id", "name"])


def test_dimension_job_follows_its_config(spark, folder):
    """Data before its route is dropped; a changed route empties its table; a removed one stops."""
    store = DimensionStore(spark, f"{folder}/dims")
    steps = [("c", None, image("patient", "dim_patient"))]

    def run(batch, *items):
        data = changes(spark, *items).withColumn("seq", F.col("seq") + 100 * batch)
        data.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(CHANGE).parquet(f"{folder}/in")
        dimension_job(
            stream, lambda: config(spark, *steps), store, f"{folder}/ckpt"
        ).awaitTermination()

    read = lambda: rows(store.read("dim_patient", ["id", "name"]))
    run(0, ("patient", "insert", {"id": "1", "name": "a"}, None), ("doctor", "insert", {"id": "9"}, None))
    assert read() == [("1", "a")]
    steps.append(("c", None, image("doctor", "dim_doctor", "id")))
    run(1, ("doctor", "insert", {"id": "8"}, None))
    assert rows(store.read("dim_doctor", ["id"])) == [("8",)]
    steps.append(("u", image("patient", "dim_patient"), image("patient", "dim_patient", "id,name,age")))
    run(2, ("patient", "insert", {"id": "2", "name": "b", "age": "5"}, None))
    assert rows(store.read("dim_patient", ["id", "name", "age"])) == [("2", "b", "5")]
    steps.append(("d", image("patient", "dim_patient"), None))
    run(3, ("patient", "insert", {"id": "3", "name": "c"}, None))
    assert read() == []


def test_a_repeated_batch_takes_the_routes_of_its_first_try(spark, folder, monkeypatch):
    store = DimensionStore(spark, f"{folder}/dims")
    steps = [("c", None, image("patient", "dim_patient"))]
    changes(spark, ("patient", "insert", {"id": "1", "name": "a"}, None)).write.parquet(f"{folder}/in")

    def run():
        stream = spark.readStream.schema(CHANGE).parquet(f"{folder}/in")
        dimension_job(stream, lambda: config(spark, *steps), store, f"{folder}/ckpt").awaitTermination()

    def lost(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(store, "append", lost)
        with pytest.raises(Exception, match="lost"):
            run()
    steps.append(("d", image("patient", "dim_patient"), None))
    steps.append(("c", None, image("patient", "dim_other", "id")))
    run()
    assert {r.sink_table for r in spark.read.parquet(f"{folder}/dims/changes").collect()} == {"dim_patient"}
    more = changes(spark, ("patient", "insert", {"id": "2", "name": "b"}, None)).withColumn("seq", F.lit(50).cast("long"))
    more.write.mode("append").parquet(f"{folder}/in")
    run()
    assert rows(store.read("dim_other", ["id"])) == [("2",)]
    assert rows(store.read("dim_patient", ["id"])) == []  # dropped since


def test_route_versions(spark):
    steps = [("c", None, image("a", "one")), ("u", image("a", "one"), image("a", "two")), ("d", image("a", "two"), None), ("c", None, image("b", "three")), ("u", image("b", "three"), image("c", "three"))]
    known = spark.createDataFrame([("a", "zero", "f", "id", "id"), ("z", "zero", "f", "id", "id")], list(ROUTE_COLUMNS))
    log = config(spark, *steps)
    got = route_versions(log, preloaded=known).select("source_table", "sink_table", "from_seq", "until_seq")
    at = [r.seq for r in log.orderBy("seq").collect()]
    assert rows(got) == sorted([("a", "zero", None, at[0]), ("a", "one", at[0], at[1]), ("a", "two", at[1], at[2]), ("b", "three", at[3], at[4]), ("c", "three", at[4], None), ("z", "zero", None, None)], key=repr)
    now = got.where("until_seq IS NULL").select("source_table", "sink_table")
    assert rows(now) == rows(latest_routes(log, preloaded=known).select("source_table", "sink_table"))
