"""The generic test tables read as a healthcare change log.

Everything is an expression over the tables, so a query on top reads only the columns and rows it needs:
an envelope built here is taken apart again by the optimizer.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.plans.facts import PAYLOAD_KEYS
from careflow.plans.summaries import Dimensions
from careflow.schemas import PAID, REVIEWED

AS_OF = "2024-02-01"
OLD_KEYS = ("status",)
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


# Reading a schema from file footers is a job of its own; one per table is enough.
_schemas: dict[str, T.StructType] = {}


def as_text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


WRITTEN = f"date_format(ts, '{MICROS}')"
FEE = as_text("CAST(value AS DECIMAL(16,2))")
BIRTHDAY = as_text("date_add(DATE '1930-01-01', CAST(event_id * 7919 % 34000 AS INT))")
VISIT = {
    "id": as_text("event_id"),
    "consultation_fee": FEE,
    "doctor_id": as_text("event_id % 10"),
    "patient_id": as_text("user_id"),
    "user_id": as_text("user_id"),
}
PERSON = {
    "id": as_text("event_id"),
    "create_time": WRITTEN,
    "birthday": BIRTHDAY,
    "gender": as_text("101 + event_id % 2"),
    "user_id": as_text("user_id"),
}


def ods(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """The change log of all source tables; with a stream of ``events``, of those in it."""
    streaming = events is not None and events.isStreaming
    events = table(spark, folder, "events") if events is None else events
    branches = [
        _rows(
            events.where("event_type = 'click'"),
            "consultation",
            "insert",
            {**VISIT, "create_time": WRITTEN, "status": "'201'"},
        ),
        _rows(
            events.where("event_type = 'purchase'"),
            "consultation",
            "update",
            {**VISIT, "update_time": WRITTEN, "status": f"'{PAID}'"},
            {"status": "CASE WHEN event_id % 4 != 0 THEN '202' END"},
        ),
        _rows(
            events.where("event_type = 'view'"),
            "consultation",
            "update",
            {
                **VISIT,
                "update_time": WRITTEN,
                "status": f"'{REVIEWED}'",
                "rating": as_text("1 + (event_id DIV 10) % 5"),
            },
            {"status": "'206'"},
        ),
        _rows(
            events.where("event_type = 'signup' AND event_id % 3 = 0"),
            "user",
            "insert",
            {
                "id": as_text("event_id"),
                "create_time": WRITTEN,
                "email": "concat('user', user_id, CASE WHEN event_id % 10 = 0 THEN '' ELSE '@' END, "
                "'mail', event_id % 7, '.example')",
                "telephone": as_text("13000000000 + event_id"),
                "username": "concat('user', user_id)",
            },
        ),
        _rows(
            events.where("event_type = 'signup' AND event_id % 3 = 1"),
            "patient",
            "insert",
            {**PERSON, "name": "concat(char(65 + event_id % 26), 'name', event_id)"},
        ),
        _rows(
            events.where("event_type = 'signup' AND event_id % 3 = 2"),
            "doctor",
            "insert",
            {
                **PERSON,
                "consultation_fee": FEE,
                "name": "concat('doctor', event_id)",
                "specialty": as_text("300 + event_id % 20"),
                "title": as_text("400 + event_id % 4"),
                "hospital_id": as_text("event_id % 25"),
            },
        ),
    ]
    if not streaming:
        branches.append(ods_prescriptions(table(spark, folder, "orders"), table(spark, folder, "lineitem")))
    return reduce(DataFrame.unionAll, branches)


def ods_prescriptions(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Orders as prescriptions and their lines as details, of tables or of streams of them."""
    heads = _rows(
        orders,
        "prescription",
        "insert",
        {
            "id": as_text("o_orderkey"),
            "create_time": f"date_format(o_orderdate, '{MICROS}')",
            "total_amount": as_text("CAST(o_totalprice AS DECIMAL(16,2))"),
            "consultation_id": as_text("o_orderkey"),
            "doctor_id": as_text("o_orderkey % 10"),
            "patient_id": as_text("o_custkey"),
            "status": "'201'",
        },
    )
    lines = _rows(
        details,
        "prescription_detail",
        "insert",
        {
            "id": "concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey)",
            "create_time": f"date_format(l_shipdate, '{MICROS}')",
            "count": as_text("CAST(l_quantity AS INT)"),
            "medicine_id": as_text("l_partkey"),
            "prescription_id": as_text("l_orderkey"),
        },
    )
    return heads.unionAll(lines)


def ods_payments(
    spark: SparkSession, folder: str, events: DataFrame | None = None
) -> DataFrame:
    """Prescription details and payments that lie close together in time."""
    events = table(spark, folder, "events") if events is None else events
    details = _rows(
        events.where("event_type = 'click'"),
        "prescription_detail",
        "insert",
        {
            "id": as_text("event_id"),
            "create_time": WRITTEN,
            "count": as_text("1 + event_id % 5"),
            "medicine_id": as_text("event_id % 97"),
            "prescription_id": as_text("user_id"),
        },
    )
    payments = _rows(
        events.where("event_type = 'purchase'"),
        "prescription",
        "update",
        {
            "id": as_text("user_id"),
            "update_time": WRITTEN,
            "total_amount": FEE,
            "consultation_id": as_text("event_id"),
            "doctor_id": as_text("event_id % 10"),
            "patient_id": as_text("user_id"),
            "status": f"'{PAID}'",
        },
        {"status": "'202'"},
    )
    return details.unionAll(payments)


def ods_treatments(events: DataFrame, details_after: str = "2 SECONDS", arrived: bool = False) -> DataFrame:
    """For each click a prescription, two details of it some time later and its payment a minute later.

    With ``arrived`` records have the time at which they came in: details 2 or 20 seconds after their prescription.
    """
    clicks = events.where("event_type = 'click'")
    later = lambda span: f"date_format(ts + INTERVAL {span}, '{MICROS}')"
    head = {
        "id": as_text("event_id"),
        "total_amount": FEE,
        "consultation_id": as_text("event_id"),
        "doctor_id": as_text("event_id % 10"),
        "patient_id": as_text("user_id"),
    }
    detail = {
        "id": "concat(event_id, '-', line)",
        "create_time": later(details_after),
        "count": as_text("line + event_id % 5"),
        "medicine_id": as_text("event_id % 97"),
        "prescription_id": as_text("event_id"),
    }
    lines = clicks.selectExpr("*", "explode(array(1, 2)) AS line")
    came = lambda time: {"arrived": f"CAST({time} AS TIMESTAMP)"} if arrived else {}
    with_details = "ts + make_interval(0, 0, 0, 0, 0, 0, CASE event_id % 2 WHEN 0 THEN 2 ELSE 20 END)"
    return (
        _rows(clicks, "prescription", "insert", {**head, "create_time": WRITTEN, "status": "'201'"}, more=came("ts"))
        .unionAll(_rows(lines, "prescription_detail", "insert", detail, more=came(with_details)))
        .unionAll(_rows(clicks, "prescription", "update", {**head, "update_time": later("60 SECONDS"), "status": f"'{PAID}'"}, {"status": "'202'"}, came("ts")))
    )


def json_log(spark: SparkSession, folder: str) -> DataFrame:
    """The change log of visits, registrations and treatments as JSON text, as a producer writes it."""
    visits = ods(spark, folder).where("table NOT LIKE 'prescription%'")
    log = visits.unionAll(ods_treatments(table(spark, folder, "events")))
    return log.select(F.to_json(F.struct("database", "table", "type", "data", "old")).alias("value"))


def dimensions(spark: SparkSession, folder: str) -> Dimensions:
    born = as_text("date_add(DATE '1930-01-01', CAST(c_custkey * 7919 % 34000 AS INT))")
    return Dimensions(
        doctor=table(spark, folder, "supplier").selectExpr(
            f"{as_text('s_suppkey')} AS id", f"{as_text('s_nationkey')} AS hospital_id"
        ),
        patient=table(spark, folder, "customer").selectExpr(
            f"{as_text('c_custkey')} AS id",
            f"{as_text('101 + c_custkey % 2')} AS gender",
            f"{born} AS birthday",
        ),
        hospital=table(spark, folder, "nation").selectExpr(
            f"{as_text('n_nationkey')} AS id", "n_name AS name"
        ),
        dictionary=spark.sql("SELECT * FROM VALUES ('101', '男'), ('102', '女') AS t(id, value)"),
    )


def dimension_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Order rows as changes of seven dimension source tables."""
    return table(spark, folder, "orders").selectExpr(
        "'clinic' AS database",
        "concat('source_', o_custkey % 7) AS table",
        "CASE WHEN o_orderkey % 11 = 0 THEN 'delete' WHEN o_orderkey % 13 = 0 THEN 'bootstrap-start' "
        "WHEN o_orderkey % 3 = 1 THEN 'update' ELSE 'insert' END AS type",
        f"CASE WHEN o_orderkey % 22 != 0 THEN {DIMENSION_ROW} END AS data",
        f"CASE WHEN o_orderkey % 22 = 0 THEN {DIMENSION_ROW} END AS old",
        "o_orderkey AS seq",
    )


def routes(spark: SparkSession, folder: str) -> DataFrame:
    """A routing table from the nations: sources 0 to 4 have a route, with different columns."""
    return table(spark, folder, "nation").where("n_nationkey < 5").select(
        F.expr("concat('source_', n_nationkey)").alias("source_table"),
        F.expr("concat('dim_', n_name)").alias("sink_table"),
        F.lit("info").alias("sink_family"),
        F.expr("CASE n_nationkey % 2 WHEN 0 THEN 'id,a' ELSE 'id,b,absent' END").alias(
            "sink_columns"
        ),
        F.lit("id").alias("sink_row_key"),
    )


def config_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Order rows as JSON changes of a large routing table: ``value`` and ``seq``."""
    image = "concat('source_', {key}) AS {source}, concat('dim_', o_orderstatus, '_', o_custkey % 50) AS {sink}, " \
        "'info' AS {family}, concat('id,c', o_orderkey % 9) AS {columns}, 'id' AS {row_key}"
    snake = dict(
        source="source_table", sink="sink_table", family="sink_family", columns="sink_columns",
        row_key="sink_row_key",
    )
    camel = dict(
        source="sourceTable", sink="sinkTable", family="sinkFamily", columns="sinkColumns",
        row_key="sinkRowKey",
    )
    before = image.format(key="o_custkey", **snake)
    after = image.format(key="CASE WHEN o_orderkey % 4 = 1 THEN o_custkey + 1 ELSE o_custkey END", **camel)
    return table(spark, folder, "orders").select(
        F.expr(
            f"""CASE o_orderkey % 5
                WHEN 0 THEN to_json(named_struct('op', 'c', 'after', struct({after})))
                WHEN 1 THEN to_json(named_struct('op', 'r', 'after', struct({after})))
                WHEN 4 THEN to_json(named_struct('op', 'd', 'before', struct({before})))
                ELSE to_json(named_struct('op', 'u', 'before', struct({before}), 'after', struct({after})))
            END"""
        ).alias("value"),
        F.col("o_orderkey").alias("seq"),
    )


DIMENSION_ROW = (
    "map('id', CAST(o_custkey AS STRING), 'a', CASE WHEN o_orderkey % 3 != 0 THEN o_orderpriority END, "
    "'b', CASE WHEN o_orderkey % 4 != 0 THEN o_orderstatus END, 'extra', CAST(o_orderkey AS STRING))"
)


def _rows(
    source: DataFrame,
    name: str,
    kind: str,
    data: dict[str, str],
    old: dict[str, str] | None = None,
    more: dict[str, str] | None = None,
) -> DataFrame:
    """An envelope in the form of ``decode_envelope(keys=PAYLOAD_KEYS)``, with the one old field used, and more columns."""
    return source.selectExpr(
        "'clinic' AS database",
        f"'{name}' AS table",
        f"'{kind}' AS type",
        f"{_payload(data)} AS data",
        f"{_payload(old or {}, OLD_KEYS)} AS old",
        *(f"{expression} AS {column}" for column, expression in (more or {}).items()),
    )


def _payload(fields: dict[str, str], keys: Sequence[str] = PAYLOAD_KEYS) -> str:
    entries = (f"'{key}', {fields.get(key, 'CAST(NULL AS STRING)')}" for key in keys)
    return f"named_struct({', '.join(entries)})"
