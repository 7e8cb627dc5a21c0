"""Facts and summaries on literal rows."""

import pytest
from pyspark.sql import functions as F

from careflow.plans import FACTS, SUMMARIES, Dimensions, build_fact, build_summary
from careflow.plans.facts import PAYLOAD_KEYS
from careflow.plans.summaries import Windowing
from careflow.sinks import json_rows
from tests.conftest import plan_of, rows

ODS = "database string, table string, type string, data map<string,string>, old map<string,string>"


def ods(spark, *changes):
    return spark.createDataFrame([("clinic", *change) for change in changes], ODS)


@pytest.fixture(scope="module")
def dims(spark):
    return Dimensions(
        doctor=spark.createDataFrame([("d1", "h1"), ("d2", "h1"), ("d3", "h2")], "id string, hospital_id string"),
        patient=spark.createDataFrame(
            [("p1", "101", "2000-02-29"), ("p2", "102", "1990-01-01"), ("p3", "101", None)],
            "id string, gender string, birthday string",
        ),
        hospital=spark.createDataFrame([("h1", "First"), ("h2", "Second")], "id string, name string"),
        dictionary=spark.createDataFrame([("101", "男"), ("102", "女")], "id string, value string"),
    )


HOW = Windowing(as_of="2024-02-01")


@pytest.mark.parametrize("name", FACTS)
def test_fact_columns_are_text_and_in_order(spark, name):
    empty = spark.createDataFrame([], ODS)
    fact = build_fact(name, empty)
    assert tuple(fact.columns) == FACTS[name].columns
    assert {kind for _, kind in fact.dtypes} == {"string"}


def test_payload_keys_cover_all_facts(spark):
    """Facts of the struct form read the same as those of the map form."""
    payload = ", ".join(f"{key}: string" for key in PAYLOAD_KEYS)
    struct = f"database string, table string, type string, data struct<{payload}>, old struct<{payload}>"
    for name in FACTS:
        assert build_fact(name, spark.createDataFrame([], struct)).columns == list(FACTS[name].columns)


def test_facts_take_inserts_only(spark):
    log = ods(
        spark,
        ("consultation", "insert", {"id": "1", "create_time": "t"}, None),
        ("consultation", "bootstrap-insert", {"id": "2"}, None),
        ("consultation", "update", {"id": "3"}, None),
        ("consultation", "delete", {"id": "4"}, None),
        ("user", "insert", {"id": "5"}, None),
    )
    assert rows(build_fact("consultation", log)) == [("1", "t", None, None, None, None)]


def test_every_update_in_a_status_counts_unless_told_otherwise(spark):
    paid = {"id": "1", "status": "203", "update_time": "t"}
    log = ods(
        spark,
        ("consultation", "update", paid, {"status": "202"}),
        ("consultation", "update", paid, {"description": "x"}),
        ("consultation", "update", {**paid, "status": "207", "rating": "5"}, {"status": "203"}),
    )
    assert build_fact("consultation_paid", log).count() == 2
    assert build_fact("consultation_paid", log, on_transition=True).count() == 1
    assert rows(build_fact("review", log)) == [("1", "t", "5", None, None, None)]


def test_masks_in_facts(spark):
    log = ods(
        spark,
        ("user", "insert", {"id": "1", "email": "ab@c.d", "telephone": "13812345678", "username": "u"}, None),
        ("patient", "insert", {"id": "2", "name": "张三丰", "gender": "101"}, None),
        ("doctor", "insert", {"id": "3", "name": "李四", "title": "t", "specialty": "s", "hospital_id": "h"}, None),
    )
    assert rows(build_fact("user_register", log)) == [("1", None, "*@c.d", "138********", "u")]
    assert build_fact("patient_add", log).first().name == "张*"
    doctor = build_fact("doctor_register", log).first()
    assert (doctor.name, doctor.specialty, doctor.title, doctor.hospital_id) == ("李四", "s", "t", "h")


def prescription_log(spark):
    def detail(number, time):
        data = {"id": number, "create_time": time, "count": "2", "medicine_id": "m", "prescription_id": "p"}
        return ("prescription_detail", "insert", data, None)

    head = {
        "id": "p",
        "create_time": "2024-01-01 10:00:00",
        "total_amount": "99.50",
        "consultation_id": "c",
        "doctor_id": "d1",
        "patient_id": "p1",
    }
    paid = {**head, "status": "203", "update_time": "2024-01-01 10:15:00"}
    return ods(
        spark,
        ("prescription", "insert", head, None),
        detail("1", "2024-01-01 09:59:59"),
        detail("2", "2024-01-01 10:00:00"),
        detail("3", "2024-01-01 10:15:05"),
        detail("4", "2024-01-01 10:15:06"),
        ("prescription", "update", paid, {"status": "202"}),
        ("prescription", "update", {**paid, "status": "204"}, None),
    )


def test_prescription_facts(spark):
    log = prescription_log(spark)
    assert [row[0] for row in rows(build_fact("prescription", log, ttl=None))] == ["1", "2", "3", "4"]
    assert [row[0] for row in rows(build_fact("prescription", log))] == ["1", "2"]  # within 5 seconds
    paid = rows(build_fact("prescription_paid", log))
    assert paid == [
        (n, "2024-01-01 10:15:00", "2", "m", "p", "99.50", "c", "d1", "p1") for n in ("2", "3")
    ]


def test_a_prescription_counts_once(spark, dims):
    summary = build_summary("prescription", build_fact("prescription", prescription_log(spark)), dims, HOW)
    (row,) = summary.collect()
    assert row.stt == "2024-01-01 09:59:50" and row.edt == "2024-01-01 10:00:00"
    assert row.prescription_count == 1 and str(row.prescription_amount) == "99.50"
    paid = build_summary(
        "prescription_paid", build_fact("prescription_paid", prescription_log(spark)), dims, HOW
    )
    (row,) = paid.collect()
    assert row.prescription_pay_suc_count == 1 and str(row.prescription_pay_suc_amount) == "99.50"


def consultations(spark, *items):
    return spark.createDataFrame(
        [(str(n), *item) for n, item in enumerate(items)],
        "id string, create_time string, consultation_fee string, doctor_id string, patient_id string, user_id string",
    )


def test_consultation_summary(spark, dims):
    fact = consultations(
        spark,
        ("2024-01-01 00:00:01", "10.25", "d1", "p1", "u"),
        ("2024-01-01 00:00:09.9", "5.00", "d2", "p1", "u"),
        ("2024-01-01 00:00:10", "1.00", "d1", "p1", "u"),
        ("2024-01-01 00:00:02", "7.00", "d3", "p2", "u"),
        ("2024-01-01 00:00:03", None, "d1", "p3", "u"),
        ("2024-01-01 00:00:04", "2.00", "unknown", "unknown", "u"),
    )
    got = build_summary("consultation", fact, dims, HOW)
    assert tuple(got.columns) == SUMMARIES["consultation"].columns
    plain = [(r.stt[-8:], *r[3:8], r.consultation_amount and float(r.consultation_amount), r[9]) for r in got.collect()]
    assert sorted(plain, key=repr) == sorted(
        [
            ("00:00:00", "h1", "First", "101", "男", "青年期", 15.25, 2),
            ("00:00:10", "h1", "First", "101", "男", "青年期", 1.0, 1),
            ("00:00:00", "h2", "Second", "102", "女", "中年期", 7.0, 1),
            ("00:00:00", "h1", "First", "101", "男", "年龄异常", None, 1),
            ("00:00:00", None, None, None, None, "年龄异常", 2.0, 1),
        ],
        key=repr,
    )


def test_review_summary(spark, dims):
    reviews = spark.createDataFrame(
        [
            ("1", "2024-01-01 00:00:01", "5", "d1", "p1", "u1"),
            ("2", "2024-01-01 00:00:02", "5", "d2", "p1", "u1"),
            ("3", "2024-01-01 00:00:03", "4", "d1", "p1", "u2"),
            ("4", "2024-01-01 00:00:12", None, "d1", "p1", "u1"),
            ("5", "2024-01-01 00:00:13", "5", "d3", "p1", "u1"),
            ("6", "unknown", "5", "d3", "p1", "u1"),
        ],
        "id string, review_time string, rating string, doctor_id string, patient_id string, user_id string",
    )
    got = build_summary("review", reviews, dims, HOW)
    assert [row[0][-2:] + str(row[3:]) for row in rows(got)] == [
        "00('h1', 'First', 2, 3, 2)",
        "10('h1', 'First', 0, 1, 0)",
        "10('h2', 'Second', 1, 1, 1)",
    ]


def test_registration_counts(spark):
    users = spark.createDataFrame(
        [("1", "2024-01-01 00:00:01"), ("2", "2024-01-01 00:00:02"), ("3", None)],
        "id string, register_time string",
    )
    got = build_summary("user_register", users, None, HOW)
    assert rows(got) == [("2024-01-01 00:00:00", "2024-01-01 00:00:10", "2024-01-01", 2)]


def test_summary_as_json_leaves_nulls_out(spark, dims):
    fact = consultations(spark, ("2024-01-01 00:00:04", "2.50", "unknown", "p1", "u"))
    (row,) = json_rows(build_summary("consultation", fact, dims, HOW)).collect()
    assert row.value == (
        '{"stt":"2024-01-01 00:00:00","edt":"2024-01-01 00:00:10","cur_date":"2024-01-01",'
        '"patient_gender_code":"101","patient_gender":"男","age_group":"青年期",'
        '"consultation_amount":2.50,"consultation_count":1}'
    )


def test_names_are_joined_after_the_aggregation(spark, dims):
    plan = plan_of(build_summary("consultation", consultations(spark, ("t", "1", "d", "p", "u")), dims, HOW))
    top, below = plan.split("HashAggregate", 1)
    assert "hospital_name" in top and "patient_gender" in top
    assert "hospital_name" not in below.split("Exchange")[1].split("Join")[0]


def test_hot_doctor_and_patient(spark, dims):
    """A third of all rows on one doctor and patient, looked up with and without spreading."""
    fact = spark.range(3000).select(
        F.col("id").cast("string"),
        F.lit("2024-01-01 00:00:01").alias("create_time"),
        F.lit("1.00").alias("consultation_fee"),
        F.expr("CASE WHEN id % 3 = 0 THEN 'd1' ELSE concat('d', id % 7) END").alias("doctor_id"),
        F.expr("CASE WHEN id % 3 = 0 THEN 'p1' ELSE concat('p', id % 11) END").alias("patient_id"),
        F.lit("u").alias("user_id"),
    )
    plain = rows(build_summary("consultation", fact, dims, HOW))
    assert sum(row[-1] for row in plain) == 3000
    spread = Windowing(as_of="2024-02-01", salts=8)
    assert rows(build_summary("consultation", fact, dims, spread)) == plain
    early = Windowing(as_of="2024-02-01", ids_first=True)
    assert rows(build_summary("consultation", fact, dims, early)) == plain
