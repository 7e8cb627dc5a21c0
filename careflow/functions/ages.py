"""Age in whole years and the age band."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper age of each band, in order, and its label.
AGE_BANDS = (
    (2, "婴儿期"),
    (5, "幼儿期"),
    (11, "小学阶段"),
    (17, "青少年期"),
    (29, "青年期"),
    (59, "中年期"),
)
ELDERLY = "老年期"
NO_BAND = "年龄异常"


def age_years(birthday: Column, as_of: Column | dt.date | str | None = None) -> Column:
    """Completed calendar years from ``birthday`` to ``as_of`` (today by default).

    Truncates toward zero, so a birthday in the future gives zero or a negative age. ``months_between``
    counts the last day of a month as a full month and is not the same.
    """
    if as_of is None:
        as_of = F.current_date()
    elif not isinstance(as_of, Column):
        as_of = F.lit(as_of).cast("date")
    born = birthday.try_cast("date")
    months = (F.year(as_of) * 12 + F.month(as_of)) - (F.year(born) * 12 + F.month(born))
    days = F.day(as_of) - F.day(born)
    whole = (
        F.when((months > 0) & (days < 0), months - 1)
        .when((months < 0) & (days > 0), months + 1)
        .otherwise(months)
    )
    return (whole / 12).cast("int")


def age_group(age: Column, strict: bool = True) -> Column:
    """Label of an age.

    ``strict`` keeps the published bands as they are: exactly 60 has no band, and a negative age falls
    in the second one because only the first is bounded below. Otherwise 60 counts as elderly and a
    negative age has no band. A missing age never has a band.
    """
    (infant_to, infant), *rest = AGE_BANDS
    label = F.when((age >= 0) & (age <= infant_to), F.lit(infant))
    if not strict:
        label = label.when(age < 0, F.lit(NO_BAND))
    for upper, name in rest:
        label = label.when(age <= upper, F.lit(name))
    elderly = age > 60 if strict else age >= 60
    return label.when(elderly, F.lit(ELDERLY)).otherwise(F.lit(NO_BAND))
