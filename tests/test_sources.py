import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.schemas import texts
from careflow.sources import (
    decode_config,
    decode_envelope,
    decode_fact,
    drop_tombstones,
    land_ods,
    read_landed,
    read_ods,
    read_routes,
    read_topic,
    record_order,
    rejected,
)
from tests.conftest import plan_of, rows

CHANGE = {
    "database": "clinic",
    "table": "consultation",
    "type": "update",
    "ts": 1,
    "data": {"id": 7, "fee": "12.50", "more": {"a": 1}, "none": None},
    "old": {"fee": "11.00"},
}


def topic(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "value string")


def test_tombstones_are_dropped(spark):
    kept = drop_tombstones(topic(spark, None, "", "x"))
    assert rows(kept) == [("x",)]


def test_envelope_as_map(spark):
    row = decode_envelope(topic(spark, json.dumps(CHANGE))).first()
    assert (row.database, row.table, row.type) == ("clinic", "consultation", "update")
    assert row.data["id"] == "7" and row.data["fee"] == "12.50" and row.data["none"] is None
    assert row.old == {"fee": "11.00"}


def test_envelope_with_known_keys_reads_the_same(spark):
    source = topic(spark, json.dumps(CHANGE))
    picked = [F.col("data")["id"].alias("id"), F.col("data")["fee"].alias("fee"), F.col("old")["fee"]]
    as_map = decode_envelope(source).select(*picked)
    as_struct = decode_envelope(source, keys=["id", "fee"]).select(*picked)
    assert rows(as_map) == rows(as_struct) == [("7", "12.50", "11.00")]


def test_missing_key_is_null(spark):
    decoded = decode_envelope(topic(spark, json.dumps(CHANGE)))
    assert decoded.select(F.col("data")["absent"]).first()[0] is None


def test_unreadable_records_are_rejected(spark):
    decoded = decode_envelope(topic(spark, "not json", json.dumps(CHANGE), "[1]"))
    assert rejected(decoded).count() == 2


def test_other_columns_stay(spark):
    source = topic(spark, json.dumps(CHANGE)).withColumn("seq", F.lit(5))
    assert decode_envelope(source).columns == ["seq", "database", "table", "type", "data", "old"]


def test_order_of_records_in_several_partitions(spark):
    """By time, then partition, then offset, in one number."""
    records = [(1704067200123, 0, 9), (1704067200123, 0, 10), (1704067200123, 1, 2), (1704067200124, 0, 3), (1704067200124, 999999, 9223372036854775807)]
    made = spark.createDataFrame(records, "ms long, partition int, offset long").withColumn("timestamp", F.timestamp_millis("ms"))
    got = made.repartition(3).withColumn("seq", record_order()).orderBy("seq").select("ms", "partition", "offset").collect()
    assert [tuple(r) for r in got] == records and made.where(record_order().isNull()).count() == 0


def test_text_files_as_topic(spark, folder):
    spark.createDataFrame([(json.dumps(CHANGE),), ("",)], "value string").write.text(f"{folder}/in")
    assert read_topic(spark, format="text", path=f"{folder}/in").count() == 1
    assert read_ods(spark, keys=["id"], format="text", path=f"{folder}/in").first().data.id == "7"
    stream = read_topic(spark, format="text", path=f"{folder}/in", streaming=True)
    assert stream.isStreaming and stream.columns == ["value"]


def test_landed_log_is_read_by_table_and_kind(spark, folder):
    ods = decode_envelope(
        topic(spark, *(json.dumps({**CHANGE, "table": t}) for t in ("consultation", "user", "user")))
    )
    land_ods(ods, f"{folder}/ods")
    users = read_landed(spark, f"{folder}/ods").where("table = 'user' AND type = 'update'")
    assert users.count() == 2
    assert "(table" in plan_of(users).split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_landing_as_a_stream(spark, folder):
    spark.createDataFrame(
        [(json.dumps(CHANGE),), ("not json",)], "value string"
    ).write.text(f"{folder}/in")
    ods = read_ods(spark, streaming=True, format="text", path=f"{folder}/in")
    land_ods(ods, f"{folder}/ods", f"{folder}/ckpt").awaitTermination()
    landed = read_landed(spark, f"{folder}/ods")
    assert landed.where("table = 'consultation'").count() == 1
    assert rejected(landed).count() == 1
    assert read_landed(spark, f"{folder}/ods", streaming=True).isStreaming


def test_fact_decode_types(spark):
    schema = texts("id", "time").add("fee", T.DecimalType(16, 2)).add("rating", T.IntegerType())
    source = topic(
        spark,
        '{"id": "1", "time": "2024-01-01 00:00:03.5", "fee": "12.5", "rating": "5"}',
        '{"id": "2", "time": "bad", "fee": "x"}',
        "",
    )
    got = decode_fact(source, schema, "time").orderBy("id").collect()
    assert str(got[0].fee) == "12.50" and got[0].rating == 5 and got[0].event_time.second == 3
    assert got[1].fee is None and got[1].rating is None and got[1].event_time is None


def test_config_in_both_spellings(spark):
    snake = {"op": "c", "after": {"source_table": "s", "sink_table": "d", "sink_columns": "id"}}
    camel = {"op": "d", "before": {"sourceTable": "s", "sinkTable": "d", "sinkRowKey": "id"}, "after": None}
    got = decode_config(topic(spark, json.dumps(snake), json.dumps(camel))).orderBy("op").collect()
    assert got[0].after.source_table == "s" and got[0].after.sink_columns == "id"
    assert got[0].before is None
    assert got[1].before.sink_row_key == "id" and got[1].after is None


def test_routes_are_read_by_position(spark, folder):
    spark.createDataFrame(
        [("src", "dim", "info", "id,name", "id", "ignored")], "a string, b string, c string, d string, e string, f string"
    ).write.parquet(f"{folder}/routes")
    row = read_routes(spark, path=f"{folder}/routes").first()
    assert row.source_table == "src" and row.sink_columns == "id,name" and row.sink_row_key == "id"
