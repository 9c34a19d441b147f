"""Status rules, enum labels and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Statuses of an available vehicle, names of the call types.
AVAILABLE_STATUSES = ("AVAILABLE", "FREE", "IDLE")
CALL_TYPE_LABELS = {"A": "Central dispatch", "B": "Taxi stand", "C": "Street hail"}
UUID_PATTERN = (
    "^[0-9a-fA-F]{1,8}-[0-9a-fA-F]{1,4}-[0-9a-fA-F]{1,4}-[0-9a-fA-F]{1,4}-[0-9a-fA-F]{1,12}$"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_available(status: Column | str) -> Column:
    """True for an available vehicle, whatever the letter case; null counts as unavailable."""
    return F.coalesce(F.upper(_col(status)).isin(*AVAILABLE_STATUSES), F.lit(False))


def call_type_label(call_type: Column | str) -> Column:
    """Name of a call type; unknown codes give null."""
    pairs = [F.lit(v) for item in CALL_TYPE_LABELS.items() for v in item]
    return F.element_at(F.create_map(*pairs), _col(call_type))


def is_uuid(text: Column | str) -> Column:
    return F.coalesce(_col(text).rlike(UUID_PATTERN), F.lit(False))


def hour_label(hour: Column | str) -> Column:
    """``9`` to ``09:00``."""
    return F.concat(F.lpad(_col(hour).cast("string"), 2, "0"), F.lit(":00"))


def iso_year_week(ts: Column | str) -> Column:
    """ISO year and week such as ``2013-W52``; late December may belong to next year's week 1."""
    ts = _col(ts)
    return F.concat(F.extract(F.lit("YEAROFWEEK"), ts).cast("string"), F.lit("-W"),
                    F.lpad(F.weekofyear(ts).cast("string"), 2, "0"))


def calendar_year_week(ts: Column | str) -> Column:
    """Calendar year with a Sunday-based week number in which week 1 holds January 1.

    The last days of December that share a week with January 1 are counted in
    week 1 *of the old year*, so the label is kept only for comparing with
    tables that were written that way.
    """
    ts = _col(ts)
    year = F.year(ts)
    # Days from the Sunday on or before January 1 to this date.
    jan1_shift = F.dayofweek(F.make_date(year, F.lit(1), F.lit(1))) - 1
    week = F.floor((F.dayofyear(ts) - 1 + jan1_shift) / 7) + 1
    next_jan1 = F.make_date(year + 1, F.lit(1), F.lit(1))
    wraps = F.datediff(next_jan1, ts.cast("date")) <= F.dayofweek(next_jan1) - 1
    number = F.when(wraps, F.lit(1)).otherwise(week.cast("int"))
    return F.concat(year.cast("string"), F.lit("-W"), F.lpad(number.cast("string"), 2, "0"))


def monday_based_weekday(ts: Column | str) -> Column:
    """0 = Monday to 6 = Sunday."""
    return (F.dayofweek(_col(ts)) + 5) % 7


def half_hour_slot(ts: Column | str, minutes: int = 30) -> Column:
    """Start of the time slot as TIMESTAMP."""
    width = minutes * 60
    epoch = F.unix_timestamp(_col(ts).cast("timestamp"))
    return F.timestamp_seconds(F.floor(epoch / width) * width)
