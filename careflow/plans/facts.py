"""The eight detail facts, from the change log. All columns are text.

The change log comes as :func:`careflow.sources.decode_envelope` gives it, in batch or as a stream. Facts
take rows of kind ``insert`` or ``update`` only: history read by a bootstrap reaches the dimensions but
no fact.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow.functions import event_time, mask_email, mask_name, mask_phone
from careflow.operators.joins import JOIN_TTL, PAY_AFTER, PAY_BEFORE, interval_join, ttl_join
from careflow.schemas import PAID, REVIEWED

# Every payload field that a fact reads, for decode_envelope(keys=...).
PAYLOAD_KEYS = (
    "id",
    "create_time",
    "update_time",
    "status",
    "rating",
    "consultation_fee",
    "doctor_id",
    "patient_id",
    "user_id",
    "total_amount",
    "consultation_id",
    "count",
    "medicine_id",
    "prescription_id",
    "email",
    "telephone",
    "username",
    "birthday",
    "gender",
    "name",
    "specialty",
    "title",
    "hospital_id",
)


def consultation(ods: DataFrame) -> DataFrame:
    return _changes(ods, "consultation", "insert").select(
        *_data("id", "create_time", "consultation_fee", "doctor_id", "patient_id", "user_id")
    )


def consultation_paid(ods: DataFrame, on_transition: bool = False) -> DataFrame:
    """Updates in status paid. ``on_transition`` leaves out those where the status was not what changed."""
    return _in_status(ods, "consultation", PAID, on_transition).select(
        *_data("id"),
        _field("update_time", "consultation_pay_suc_time"),
        *_data("consultation_fee", "doctor_id", "patient_id", "user_id"),
    )


def review(ods: DataFrame, on_transition: bool = False) -> DataFrame:
    """Updates in status reviewed. ``on_transition`` as in :func:`consultation_paid`."""
    return _in_status(ods, "consultation", REVIEWED, on_transition).select(
        *_data("id"),
        _field("update_time", "review_time"),
        *_data("rating", "doctor_id", "patient_id", "user_id"),
    )


def user_register(ods: DataFrame) -> DataFrame:
    return _changes(ods, "user", "insert").select(
        *_data("id"),
        _field("create_time", "register_time"),
        mask_email(F.col("data")["email"]).alias("email"),
        mask_phone(F.col("data")["telephone"]).alias("telephone"),
        *_data("username"),
    )


def patient_add(ods: DataFrame) -> DataFrame:
    return _changes(ods, "patient", "insert").select(
        *_data("id"),
        _field("create_time", "add_time"),
        *_data("birthday", "gender"),
        mask_name(F.col("data")["name"]).alias("name"),
        *_data("user_id"),
    )


def doctor_register(ods: DataFrame) -> DataFrame:
    return _changes(ods, "doctor", "insert").select(
        *_data(
            "id",
            "create_time",
            "birthday",
            "consultation_fee",
            "gender",
            "name",
            "specialty",
            "title",
            "hospital_id",
        )
    )


def prescription(
    ods: DataFrame, ttl: dt.timedelta | None = JOIN_TTL, salts: int = 1, arrival: str | None = None
) -> DataFrame:
    """One row per prescription detail, with the columns of its prescription.

    Both were written no more than ``ttl`` apart, in a batch as in a stream. With None, which only a batch can have, they
    may lie any time apart. With ``arrival``, a column of the log with the time at which records came in (see
    :func:`careflow.sources.read_topic`), they came in no more than ``ttl`` apart, whenever they were written: what a
    stream remembers then ends with the time that passes and not with what its records say.
    """
    heads = _timed(
        _changes(ods, "prescription", "insert").select(
            _field("id", "_head_id"),
            _field("create_time", "_head_time_text"),
            *_data("total_amount", "consultation_id", "doctor_id", "patient_id"),
            *_arrival(arrival, "_head_time"),
        ),
        "_head_time_text",
        "_head_time",
        ttl is not None,
    )
    details = _timed(_details(ods, arrival), "create_time", "_detail_time", ttl is not None)
    joined = ttl_join(
        heads,
        details,
        "_head_id",
        "prescription_id",
        "_head_time",
        "_detail_time",
        ttl=ttl,
        salts=salts,
    )
    return joined.select(
        "id",
        F.col("create_time").alias("prescription_time"),
        *_PRESCRIPTION_COLUMNS,
    )


def prescription_paid(
    ods: DataFrame,
    before: dt.timedelta = PAY_AFTER,
    after: dt.timedelta = PAY_BEFORE,
    salts: int = 1,
) -> DataFrame:
    """One row per detail and payment of its prescription, where the detail was written no more than
    ``before`` ahead of the payment and no more than ``after`` behind it."""
    details = _details(ods).withColumn("_detail_time", _exact_time("create_time"))
    payments = (
        _in_status(ods, "prescription", PAID)
        .select(
            _field("id", "_head_id"),
            _field("update_time", "prescription_pay_suc_time"),
            *_data("total_amount", "consultation_id", "doctor_id", "patient_id"),
        )
        .withColumn("_pay_time", _exact_time("prescription_pay_suc_time"))
    )
    joined = interval_join(
        details,
        payments,
        "prescription_id",
        "_head_id",
        "_detail_time",
        "_pay_time",
        before=before,
        after=after,
        salts=salts,
    )
    return joined.select("id", "prescription_pay_suc_time", *_PRESCRIPTION_COLUMNS)


_PRESCRIPTION_COLUMNS = (
    "count",
    "medicine_id",
    "prescription_id",
    "total_amount",
    "consultation_id",
    "doctor_id",
    "patient_id",
)


@dataclass(frozen=True)
class Fact:
    build: Callable[..., DataFrame]
    topic: str
    time: str
    columns: tuple[str, ...]


# The topic of each fact, the column with its event time, and its columns in order.
FACTS = {
    "consultation": Fact(
        consultation,
        "medical_dwd_trade_consultation",
        "create_time",
        ("id", "create_time", "consultation_fee", "doctor_id", "patient_id", "user_id"),
    ),
    "consultation_paid": Fact(
        consultation_paid,
        "medical_dwd_trade_consultation_pay_suc",
        "consultation_pay_suc_time",
        (
            "id",
            "consultation_pay_suc_time",
            "consultation_fee",
            "doctor_id",
            "patient_id",
            "user_id",
        ),
    ),
    "prescription": Fact(
        prescription,
        "medical_dwd_trade_prescription",
        "prescription_time",
        ("id", "prescription_time", *_PRESCRIPTION_COLUMNS),
    ),
    "prescription_paid": Fact(
        prescription_paid,
        "medical_dwd_trade_prescription_pay_suc",
        "prescription_pay_suc_time",
        ("id", "prescription_pay_suc_time", *_PRESCRIPTION_COLUMNS),
    ),
    "user_register": Fact(
        user_register,
        "medical_dwd_user_register",
        "register_time",
        ("id", "register_time", "email", "telephone", "username"),
    ),
    "patient_add": Fact(
        patient_add,
        "medical_dwd_user_patient_add",
        "add_time",
        ("id", "add_time", "birthday", "gender", "name", "user_id"),
    ),
    "doctor_register": Fact(
        doctor_register,
        "medical_dwd_doctor_register",
        "create_time",
        (
            "id",
            "create_time",
            "birthday",
            "consultation_fee",
            "gender",
            "name",
            "specialty",
            "title",
            "hospital_id",
        ),
    ),
    "review": Fact(
        review,
        "medical_dwd_interaction_review",
        "review_time",
        ("id", "review_time", "rating", "doctor_id", "patient_id", "user_id"),
    ),
}


def build_fact(name: str, ods: DataFrame, **options) -> DataFrame:
    """The fact ``name`` with its published columns in order."""
    fact = FACTS[name]
    return fact.build(ods, **options).select(*fact.columns)


def _changes(ods: DataFrame, table: str, kind: str) -> DataFrame:
    return ods.where((F.col("table") == table) & (F.col("type") == kind))


def _in_status(
    ods: DataFrame, table: str, status: str, on_transition: bool = False
) -> DataFrame:
    rows = _changes(ods, table, "update").where(F.col("data")["status"] == status)
    if on_transition:
        rows = rows.where(F.col("old")["status"].isNotNull())
    return rows


def _details(ods: DataFrame, arrival: str | None = None) -> DataFrame:
    return _changes(ods, "prescription_detail", "insert").select(
        *_data("id", "create_time", "count", "medicine_id", "prescription_id"), *_arrival(arrival, "_detail_time")
    )


def _arrival(column: str | None, name: str) -> list[Column]:
    return [] if column is None else [F.col(column).alias(name)]


def _timed(rows: DataFrame, text: str, name: str, needed: bool) -> DataFrame:
    """Only a bounded join needs the times; those of arrival are there already."""
    if name in rows.columns:
        return rows
    return rows.withColumn(name, event_time(F.col(text)) if needed else F.lit(None).cast("timestamp"))


def _exact_time(text: str) -> Column:
    """The time with its fraction of a second, which the bounds of the interval join look at."""
    return F.col(text).try_cast("timestamp")


def _data(*names: str) -> list[Column]:
    return [_field(name, name) for name in names]


def _field(name: str, alias: str) -> Column:
    return F.col("data")[name].alias(alias)
