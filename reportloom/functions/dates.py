"""Report dates, month labels and month windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names as the reports write them, in any locale.
MONTH_NAMES = (
    "Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
)

# Date spellings that a load accepts, as (shape, pattern). The
# shape is tested first, so that a value is parsed once and by the right pattern.
DATE_SPELLINGS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{4}$", "d MMM yyyy"),
    (r"^\d{8}$", "yyyyMMdd"),
)
TIME_SPELLINGS = (
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "yyyy-MM-dd HH:mm:ss"),
    (r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$", "yyyy-MM-dd'T'HH:mm:ss"),
    (r"^[A-Z][a-z]{2} \d{1,2}, \d{4} \d{1,2}:\d{2}:\d{2} [AP]M$", "MMM d, yyyy h:mm:ss a"),
)


def strict_report_date(c: Column) -> Column:
    """ISO date, one or two digits for month and day; anything else fails the job."""
    parsed = F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), c.try_cast("date"))
    message = F.concat(F.lit("bad report date: "), F.coalesce(c, F.lit("NULL")))
    return F.coalesce(parsed, F.raise_error(message).cast("date"))


def _by_spelling(c: Column, spellings, parse) -> Column:
    value = F.lit(None)
    for shape, pattern in reversed(spellings):
        value = F.when(c.rlike(shape), parse(c, pattern)).otherwise(value)
    return value


def parse_auto_date(c: Column) -> Column:
    """Date in any of the accepted spellings, NULL when none fits."""
    return _by_spelling(c, DATE_SPELLINGS, F.try_to_date).cast("date")


def parse_auto_time(c: Column) -> Column:
    """Timestamp in any of the accepted spellings, NULL when none fits."""
    return _by_spelling(
        c, TIME_SPELLINGS, lambda v, p: F.try_to_timestamp(v, F.lit(p))
    ).cast("timestamp")


def required_time(c: Column) -> Column:
    """Timestamp in any of the accepted spellings, NULL for NULL; any other text fails the job."""
    told = F.raise_error(F.concat(F.lit("bad report time: "), c)).cast("timestamp")
    return F.when(c.isNotNull(), F.coalesce(parse_auto_time(c), told))


def required_date(c: Column) -> Column:
    """Date in any of the accepted spellings, NULL for NULL; any other text fails the job."""
    told = F.raise_error(F.concat(F.lit("bad report date: "), c)).cast("date")
    return F.when(c.isNotNull(), F.coalesce(parse_auto_date(c), told))


def iso_date(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def month_label(d: Column) -> Column:
    return F.date_format(d, "yyyyMM")


def month_back_label(d: Column, months: int) -> Column:
    """``YYYYMM`` of the month ``months`` before ``d``."""
    return month_label(F.add_months(d, -months))


def previous_month_end(d: Column) -> Column:
    return F.date_sub(F.trunc(d, "MM"), 1)


def month_like_pattern(d: Column) -> Column:
    """LIKE pattern for text dates of the month before ``d``, such as ``Feb%2021``."""
    last = previous_month_end(d)
    return F.concat(F.date_format(last, "MMM"), F.lit("%"), F.date_format(last, "yyyy"))


def text_month(c: Column) -> Column:
    """``2021-Feb`` for any text that ``LIKE 'Feb%2021'`` accepts.

    The label is cut from the text itself, not from a parsed date: two texts get
    the same label exactly when the same month pattern accepts them.
    """
    return F.when(
        F.length(c) >= 7,
        F.concat(F.substring(c, -4, 4), F.lit("-"), F.substring(c, 1, 3)),
    )


def text_month_of(day: date) -> str:
    """The ``text_month`` label of the month that holds ``day``."""
    return f"{day.year:04d}-{MONTH_NAMES[day.month - 1]}"


def _labels(first: Column, last: Column) -> Column:
    months = F.sequence(first, last, F.expr("interval 1 month"))
    return F.transform(months, month_label)


def past_months(as_of: Column, n: int) -> Column:
    """Labels of the last ``n`` months up to that of ``as_of``; empty for n < 1."""
    if n < 1:
        return F.array().cast("array<string>")
    last = F.trunc(as_of, "MM")
    return _labels(F.add_months(last, 1 - n), last)


def range_months(first: Column, last: Column) -> Column:
    """Labels of every month from ``first`` to ``last``; empty when reversed."""
    start, stop = F.trunc(first, "MM"), F.trunc(last, "MM")
    return F.when(start <= stop, _labels(start, stop)).otherwise(
        F.array().cast("array<string>")
    )


def day_gate(d: Column, first: int = 1, last: int = 20) -> Column:
    """Whether the day of the month lies in the window in which a load may run."""
    return F.dayofmonth(d).between(first, last)
