"""The eight windowed summaries, from the detail facts.

A fact comes with all its columns as text, in batch or as a stream. Hospital and patient columns that
form the groups are looked up before the aggregation, names after it, once per group.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careflow.functions import age_group, age_years
from careflow.functions.ages import NO_BAND
from careflow.operators.first import first_row
from careflow.operators.lookup import lookup
from careflow.operators.windows import DELAY, WINDOW, tumbling, with_bounds
from careflow.plans.facts import FACTS
from careflow.schemas import GOOD_RATING, MONEY
from careflow.sources.changelog import typed


@dataclass(frozen=True)
class Dimensions:
    """Dimension tables by id: doctors have ``hospital_id``, patients ``gender`` and ``birthday``,
    hospitals ``name`` and the dictionary ``value``."""

    doctor: DataFrame
    patient: DataFrame
    hospital: DataFrame
    dictionary: DataFrame


@dataclass(frozen=True)
class Windowing:
    """How facts are cut into windows and joined.

    ``as_of`` is the day ages are taken at (today by default), ``strict_ages`` as in
    :func:`careflow.functions.age_group`. ``salts`` spreads hot doctors and patients in streams.
    ``ids_first`` sums a batch by doctor and patient before looking anything up: worth its shuffle where
    the dimensions are too large to broadcast and the same pairs come back within a window.
    ``forget_keys`` bounds the state of first-row tests by the watermark, for streams whose keys do not
    come back.
    """

    size: str = WINDOW
    delay: str = DELAY
    start: str | None = None
    as_of: dt.date | str | None = None
    strict_ages: bool = True
    salts: int = 1
    ids_first: bool = False
    forget_keys: bool = False


_GROUP = ("hospital_id", "patient_gender_code", "age_group")


@dataclass(frozen=True)
class TradeSummary:
    """Sum of ``amount`` and row count per hospital, gender and age band; one row per ``once_per``."""

    amount: str
    measure: str
    once_per: str | None = None

    def build(self, fact: DataFrame, dims: Dimensions, how: Windowing) -> DataFrame:
        if how.ids_first and fact.isStreaming:
            raise ValueError("a stream sums by ids first only if its dimensions are read as windows close")
        if how.ids_first:
            return self.from_ids(self.by_ids(fact, how), dims, how)
        counted = enrich(self._rows(fact, how), dims, how)
        measures = [F.sum(self.amount), F.count(F.lit(1))]
        return self._named(self._windows(counted, measures, _GROUP, how), dims, how)

    def by_ids(self, fact: DataFrame, how: Windowing) -> DataFrame:
        """The same per doctor and patient, which needs no dimension."""
        measures = [F.sum(self.amount), F.count(F.lit(1))]
        return self._windows(self._rows(fact, how), measures, ("doctor_id", "patient_id"), how)

    def from_ids(self, windows: DataFrame, dims: Dimensions, how: Windowing) -> DataFrame:
        """The summary from :meth:`by_ids`. All rows of a window have to be there, which holds for the
        rows that a stream gives out together."""
        amount, count = self._measure_names()
        grouped = (
            enrich(windows, dims, how)
            .groupBy("window", *_GROUP)
            .agg(
                F.sum(amount).cast(windows.schema[amount].dataType).alias(amount),
                F.sum(count).alias(count),
            )
        )
        return self._named(grouped, dims, how)

    def _rows(self, fact: DataFrame, how: Windowing) -> DataFrame:
        rows = fact.withWatermark("event_time", how.delay) if fact.isStreaming else fact
        used = ["event_time", "doctor_id", "patient_id", self.amount]
        if self.once_per:
            rows = rows.select("id", self.once_per, *used)
            rows = first_row(rows, [self.once_per], ["event_time", "id"], how.forget_keys)
        return rows.select(*used)

    def _windows(
        self, rows: DataFrame, measures: Sequence[Column], keys: Sequence[str], how: Windowing
    ) -> DataFrame:
        named = [column.alias(name) for column, name in zip(measures, self._measure_names())]
        return tumbling(rows, named, keys, size=how.size, delay=how.delay, start=how.start)

    def _named(self, grouped: DataFrame, dims: Dimensions, how: Windowing) -> DataFrame:
        rows = with_hospital_name(with_bounds(grouped), dims)
        return lookup(rows, dims.dictionary, "patient_gender_code", {"value": "patient_gender"})

    def _measure_names(self) -> tuple[str, str]:
        return f"{self.measure}_amount", f"{self.measure}_count"


def _count_summary(measure: str) -> Callable:
    """Rows per window over everything; partial counts keep the single group small."""

    def build(fact: DataFrame, dims: Dimensions | None, how: Windowing) -> DataFrame:
        counted = tumbling(
            fact.select("event_time"),
            [F.count(F.lit(1)).alias(measure)],
            size=how.size,
            delay=how.delay,
            start=how.start,
        )
        return with_bounds(counted)

    return build


@dataclass(frozen=True)
class ReviewSummary:
    """Reviews, good reviews and first-time reviewers per hospital.

    A user is new to a hospital in the window of their first review there.
    """

    ids = ("doctor_id", "user_id")
    visitor = ("user_id", "hospital_id")

    def build(self, fact: DataFrame, dims: Dimensions, how: Windowing) -> DataFrame:
        """The first reviews are added to the reviews as rows of their own that count as no review, and one
        aggregation sums both."""
        rows = lookup(self._rows(fact, how), dims.doctor, "doctor_id", {"hospital_id": "hospital_id"}, salts=how.salts)
        timed = rows.where(F.col("event_time").isNotNull())
        if fact.isStreaming:
            firsts = first_row(timed.select("event_time", *self.visitor), self.visitor, (), how.forget_keys)
        else:
            firsts = timed.groupBy(*self.visitor).agg(F.min("event_time").alias("event_time"))
        zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
        counted = rows.select(
            "event_time", "hospital_id", zero.alias("new"), one.alias("all"), self._good().alias("good")
        ).unionByName(
            firsts.select(
                "event_time", "hospital_id", one.alias("new"), zero.alias("all"), zero.alias("good")
            )
        )
        grouped = tumbling(counted, self._sums(), keys=["hospital_id"], size=how.size, delay=how.delay, start=how.start)
        return with_hospital_name(with_bounds(grouped), dims)

    def by_ids(self, fact: DataFrame, how: Windowing) -> DataFrame:
        """Reviews per doctor and user, which needs no dimension. The state of a stream is that of its open windows."""
        measures = [F.count(F.lit(1)).alias("all"), F.sum(self._good()).alias("good")]
        return tumbling(self._rows(fact, how), measures, self.ids, size=how.size, delay=how.delay, start=how.start)

    def from_ids(
        self, windows: DataFrame, dims: Dimensions, how: Windowing, new: Callable[[DataFrame], DataFrame]
    ) -> DataFrame:
        """The summary from :meth:`by_ids` of windows that close together, with hospitals as they are now.

        ``new`` takes the users and hospitals that met in these windows, each with the ``start`` and ``end`` of the
        first one, and gives those that had not met before.
        """
        rows = lookup(windows, dims.doctor, "doctor_id", {"hospital_id": "hospital_id"})
        firsts = new(rows.groupBy(*self.visitor).agg(F.min("window.start").alias("start"), F.min("window.end").alias("end")))
        zero = F.lit(0).cast("long")
        counted = rows.select("window", "hospital_id", zero.alias("new"), "all", "good").unionByName(
            firsts.select(
                F.struct("start", "end").alias("window"), "hospital_id", F.lit(1).cast("long").alias("new"), zero.alias("all"), zero.alias("good")
            )
        )
        grouped = counted.groupBy("window", "hospital_id").agg(*self._sums())
        return with_hospital_name(with_bounds(grouped), dims)

    def _rows(self, fact: DataFrame, how: Windowing) -> DataFrame:
        rows = fact.withWatermark("event_time", how.delay) if fact.isStreaming else fact
        return rows.select("event_time", *self.ids, "rating")

    def _good(self) -> Column:
        return F.when(F.col("rating") == GOOD_RATING, 1).otherwise(0).cast("long")

    def _sums(self) -> list[Column]:
        names = {"new": "review_new_user_count", "all": "review_count", "good": "good_review_count"}
        return [F.sum(column).alias(name) for column, name in names.items()]


def enrich(rows: DataFrame, dims: Dimensions, how: Windowing) -> DataFrame:
    """Hospital of the doctor, gender code and age band of the patient."""
    rows = lookup(rows, dims.doctor, "doctor_id", {"hospital_id": "hospital_id"}, salts=how.salts)
    rows = lookup(
        rows,
        with_age_group(dims.patient, how.as_of, how.strict_ages),
        "patient_id",
        {"gender": "patient_gender_code", "age_group": "age_group"},
        salts=how.salts,
    )
    return rows.withColumn("age_group", F.coalesce("age_group", F.lit(NO_BAND)))


def with_age_group(
    patients: DataFrame, as_of: Column | dt.date | str | None = None, strict: bool = True
) -> DataFrame:
    """Patients with their age band: worked out once per patient, not once per fact."""
    return patients.withColumn("age_group", age_group(age_years(F.col("birthday"), as_of), strict))


def with_hospital_name(rows: DataFrame, dims: Dimensions) -> DataFrame:
    return lookup(rows, dims.hospital, "hospital_id", {"name": "hospital_name"})


@dataclass(frozen=True)
class Summary:
    fact: str
    table: str
    build: Callable
    columns: Sequence[str]
    input_types: dict[str, T.DataType]
    by_ids: TradeSummary | ReviewSummary | None = None

    def input_schema(self, names: Sequence[str]) -> T.StructType:
        return T.StructType(
            [T.StructField(name, self.input_types.get(name, T.StringType())) for name in names]
        )


_BOUNDS = ("stt", "edt", "cur_date")


def _trade(fact: str, table: str, trade: TradeSummary, types: dict[str, T.DataType]) -> Summary:
    group = ("hospital_id", "hospital_name", "patient_gender_code", "patient_gender", "age_group")
    columns = (*_BOUNDS, *group, f"{trade.measure}_amount", f"{trade.measure}_count")
    return Summary(fact, table, trade.build, columns, types, trade)


_FEE = {"consultation_fee": MONEY}
_REVIEWS = ReviewSummary()
_TOTAL = {"total_amount": MONEY, "count": T.IntegerType()}

# The table each summary is kept in, and its columns.
SUMMARIES = {
    "consultation": _trade(
        "consultation",
        "dws_trade_hosp_pat_gen_a_g_consul_win",
        TradeSummary("consultation_fee", "consultation"),
        _FEE,
    ),
    "consultation_paid": _trade(
        "consultation_paid",
        "dws_trade_hosp_pat_gen_a_g_consul_pay_suc_win",
        TradeSummary("consultation_fee", "consultation_pay_suc"),
        _FEE,
    ),
    "prescription": _trade(
        "prescription",
        "dws_trade_hosp_pat_gen_a_g_pres_win",
        TradeSummary("total_amount", "prescription", once_per="prescription_id"),
        _TOTAL,
    ),
    "prescription_paid": _trade(
        "prescription_paid",
        "dws_trade_hosp_pat_gen_a_g_pres_pay_suc_win",
        TradeSummary("total_amount", "prescription_pay_suc", once_per="prescription_id"),
        _TOTAL,
    ),
    "user_register": Summary(
        "user_register",
        "dws_user_register_win",
        _count_summary("register_user_count"),
        (*_BOUNDS, "register_user_count"),
        {},
    ),
    "patient_add": Summary(
        "patient_add",
        "dws_user_patient_add_win",
        _count_summary("patient_add_count"),
        (*_BOUNDS, "patient_add_count"),
        {},
    ),
    "doctor_register": Summary(
        "doctor_register",
        "dws_doc_register_win",
        _count_summary("register_count"),
        (*_BOUNDS, "register_count"),
        {},
    ),
    "review": Summary(
        "review",
        "dws_interaction_hos_review_win",
        _REVIEWS.build,
        (
            *_BOUNDS,
            "hospital_id",
            "hospital_name",
            "review_new_user_count",
            "review_count",
            "good_review_count",
        ),
        {"rating": T.IntegerType()},
        _REVIEWS,
    ),
}


def build_summary(
    name: str, fact: DataFrame, dims: Dimensions | None = None, how: Windowing = Windowing()
) -> DataFrame:
    """The summary ``name`` of a fact as text, with its published columns in order."""
    summary = SUMMARIES[name]
    return summary.build(summary_input(name, fact), dims, how).select(*summary.columns)


def summary_input(name: str, fact: DataFrame) -> DataFrame:
    """A fact as text with the types that the summary ``name`` works on."""
    summary = SUMMARIES[name]
    return typed(fact, summary.input_schema(fact.columns), FACTS[summary.fact].time)
