"""Date helpers: weeks start on Monday."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col

# Fixed values of the data model.
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sept", "Oct", "Nov", "Dec"]


def week_start(c: Column | str) -> Column:
    return F.to_date(F.date_trunc("week", col(c)))


def day_name(c: Column | str) -> Column:
    return F.date_format(col(c), "EEEE")


def month_name(c: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(col(c)))


def each_day(start: Column | str, end: Column | str) -> Column:
    return F.explode(F.sequence(col(start), col(end), F.expr("interval 1 day")))
