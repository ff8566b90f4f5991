"""Calendar helpers: SQL expressions of dates in, SQL expressions out."""

from pyspark.sql import functions as F

from navspan.functions.fixed import CURRENT
from navspan.functions.keys import check_period

TEXT_FORMAT = "yyyyMMdd"


def period_start(date, period):
    """First day of the calendar period that holds ``date``."""
    return f"trunc({date}, '{check_period(period, current=False)}')"


def period_anchor(date, period):
    """The day a period is measured from: the day before it starts; the day before for current."""
    check_period(period)
    return f"date_sub({date if period == CURRENT else period_start(date, period)}, 1)"


def day_gap(end, start):
    return f"datediff({end}, {start})"


def parse_date(text):
    return f"to_date({text}, '{TEXT_FORMAT}')"


def format_date(date):
    return f"date_format({date}, '{TEXT_FORMAT}')"


def as_date(value):
    """A date column from a date, or from yyyyMMdd or yyyy-MM-dd text."""
    if isinstance(value, str):
        return F.to_date(F.lit(value), TEXT_FORMAT if value.isdigit() else "yyyy-MM-dd")
    return F.lit(value)
