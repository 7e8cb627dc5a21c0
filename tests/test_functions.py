import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from careflow.functions import (
    age_group,
    age_years,
    date_text,
    event_time,
    mask_email,
    mask_name,
    mask_phone,
    midnight,
    second_text,
)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "email, masked",
    [
        ("ab@c.d", "*@c.d"),
        ("abc", None),
        ("a@b@c", "*@b"),
        ("ab@", "*@"),
        ("", None),
        (None, None),
    ],
)
def test_mask_email(spark, email, masked):
    assert one(spark, mask_email(F.lit(email).cast("string"))) == masked


@pytest.mark.parametrize(
    "phone, masked", [("13812345678", "138********"), ("12", "12********"), (None, None)]
)
def test_mask_phone(spark, phone, masked):
    assert one(spark, mask_phone(F.lit(phone).cast("string"))) == masked


@pytest.mark.parametrize("name, masked", [("张三丰", "张*"), ("Lee", "L*"), ("", "*"), (None, None)])
def test_mask_name(spark, name, masked):
    assert one(spark, mask_name(F.lit(name).cast("string"))) == masked


@pytest.mark.parametrize(
    "age, strict, repaired",
    [
        (-1, "幼儿期", "年龄异常"),
        (0, "婴儿期", "婴儿期"),
        (2, "婴儿期", "婴儿期"),
        (3, "幼儿期", "幼儿期"),
        (5, "幼儿期", "幼儿期"),
        (6, "小学阶段", "小学阶段"),
        (11, "小学阶段", "小学阶段"),
        (12, "青少年期", "青少年期"),
        (17, "青少年期", "青少年期"),
        (18, "青年期", "青年期"),
        (29, "青年期", "青年期"),
        (30, "中年期", "中年期"),
        (59, "中年期", "中年期"),
        (60, "年龄异常", "老年期"),
        (61, "老年期", "老年期"),
        (None, "年龄异常", "年龄异常"),
    ],
)
def test_age_group(spark, age, strict, repaired):
    column = F.lit(age).cast("int")
    assert one(spark, age_group(column)) == strict
    assert one(spark, age_group(column, strict=False)) == repaired


def completed_years(born: dt.date, on: dt.date) -> int:
    """Anniversaries between two days, counted toward zero."""
    if on < born:
        return -completed_years_backwards(on, born)
    return on.year - born.year - ((on.month, on.day) < (born.month, born.day))


def completed_years_backwards(on: dt.date, born: dt.date) -> int:
    """How many whole years lie ahead from ``on`` to ``born``."""
    return born.year - on.year - ((born.month, born.day) < (on.month, on.day))


days = st.dates(dt.date(1900, 1, 1), dt.date(2100, 12, 31))


@settings(max_examples=4, deadline=None)
@given(pairs=st.lists(st.tuples(days, days), min_size=200, max_size=400))
def test_age_years_counts_anniversaries(spark, pairs):
    frame = spark.createDataFrame([(str(b), d) for b, d in pairs], "born string, day date")
    got = frame.select("born", "day", age_years(F.col("born"), F.col("day")).alias("age")).collect()
    for row in got:
        assert row.age == completed_years(dt.date.fromisoformat(row.born), row.day)


@pytest.mark.parametrize(
    "born, day, age",
    [
        ("2000-02-29", "2001-02-28", 0),
        ("2000-02-29", "2001-03-01", 1),
        ("2024-01-02", "2024-01-01", 0),
        ("2030-01-01", "2024-01-01", -6),
        (None, "2024-01-01", None),
        ("unknown", "2024-01-01", None),
    ],
)
def test_age_years(spark, born, day, age):
    assert one(spark, age_years(F.lit(born).cast("string"), day)) == age


def test_age_is_taken_today_by_default(spark):
    born = F.date_sub(F.current_date(), 366 * 30).cast("string")
    assert one(spark, age_years(born)) == 30


@pytest.mark.parametrize(
    "text, seconds",
    [
        ("2024-01-01 08:00:00", "2024-01-01 08:00:00"),
        ("2024-01-01 08:00:00.999", "2024-01-01 08:00:00"),
        ("2024-02-30 08:00:00", None),
        ("2024-01-01", None),
        ("2024-01-01T08:00:00", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_event_time(spark, text, seconds):
    assert one(spark, second_text(event_time(F.lit(text).cast("string")))) == seconds


def test_event_time_is_read_in_the_session_zone(spark):
    epoch = one(spark, F.unix_seconds(event_time(F.lit("1970-01-01 08:00:00"))))
    assert epoch == 0


def test_midnight_and_date_text(spark):
    assert one(spark, second_text(midnight(F.lit("2024-03-05")))) == "2024-03-05 00:00:00"
    assert one(spark, date_text(event_time(F.lit("2024-03-05 23:59:59")))) == "2024-03-05"
