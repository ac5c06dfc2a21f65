"""Text conversions that give NULL instead of an error under ANSI mode."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"
TIMESTAMP_SHAPE = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?$"


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def lower_or_null(text: Column) -> Column:
    return blank_to_null(F.lower(text))


def to_double(text: Column) -> Column:
    # Java number syntax allows a type suffix such as "12d", which is not a number here.
    return F.when(~text.rlike("[dDfF]$"), text).try_cast("double")


def to_uint16(text: Column) -> Column:
    """Digits, with any number of zeros before them, whose value fits 16 bits."""
    digits = F.regexp_extract(text, r"^0*(\d+)$", 1)
    number = F.when(F.length(digits) <= 5, digits).try_cast("int")
    return F.when(number <= 65535, number)


def to_day(text: Column) -> Column:
    return F.when(text.rlike(DATE_SHAPE), text).try_cast("date")


def to_moment(text: Column) -> Column:
    """ISO or space separated date-time text, with optional fraction and zone."""
    return F.when(text.rlike(TIMESTAMP_SHAPE), text).try_cast("timestamp")


def at(moment: datetime | None) -> Column:
    """Timestamp of a run time, read in the session time zone; None is the current time.

    A datetime literal would be read in the time zone of the driver's machine.
    """
    if moment is None:
        return F.current_timestamp()
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def iso_text(moment: Column) -> Column:
    """ISO text of a timestamp; the fraction appears only when it is not zero."""
    full = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(full, r"\.000000$", "")


def null_if(value: Column, sentinel: object) -> Column:
    return F.when(value == F.lit(sentinel), None).otherwise(value)


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def monday_first(day: Column) -> Column:
    """Day of week with Monday = 1 and Sunday = 7."""
    return (F.dayofweek(day) + 5) % 7 + 1
