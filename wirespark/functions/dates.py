"""Date and time expressions. None reads the clock: ``as_of`` is an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QUARTER_HOUR = 900


def int_date(column: Column) -> Column:
    """Date of a yyyymmdd number or text; NULL when it is no date."""
    return F.try_to_date(column.cast("string"), "yyyyMMdd")


def stamp(column: Column) -> Column:
    """yyyyMMddHHmmss text of a timestamp."""
    return F.date_format(column, "yyyyMMddHHmmss")


def round_quarter_hour(column: Column, as_of: Column) -> Column:
    """Nearest quarter hour (half rounds up); NULL unless it lies before ``as_of``.

    ``column`` is TIMESTAMP_NTZ, so the result does not depend on the session zone.
    """
    start_of_day = column.cast("date").cast("timestamp_ntz")
    seconds = (
        F.extract(F.lit("HOUR"), column) * 3600
        + F.extract(F.lit("MINUTE"), column) * 60
        + F.floor(F.extract(F.lit("SECOND"), column))
    )
    shifted = F.floor((seconds + QUARTER_HOUR // 2) / QUARTER_HOUR).cast("int") * QUARTER_HOUR
    rounded = (start_of_day + F.make_dt_interval(secs=shifted)).cast("timestamp_ntz")
    return F.when(rounded < as_of, rounded)


def date_label(day: Column) -> Column:
    """``Jan 5, 2024`` for a date, 'Unknown date' for NULL."""
    return F.coalesce(F.date_format(day, "MMM d, yyyy"), F.lit("Unknown date"))


def text_date_label(text: Column) -> Column:
    """``date_label`` of a yyyymmdd or ISO text; 'Invalid Date' for other text."""
    day = F.when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd")).otherwise(
        text.try_cast("date")
    )
    return F.when((text != "") & day.isNull(), F.lit("Invalid Date")).otherwise(date_label(day))


def elapsed_label(seconds: Column) -> Column:
    """Elapsed seconds as ``H hours, M minutes, S seconds``."""
    whole = F.floor(seconds)
    return F.format_string(
        "%d hours, %d minutes, %d seconds",
        F.floor(whole / 3600).cast("bigint"),
        F.floor((whole % 3600) / 60).cast("bigint"),
        (whole % 60).cast("bigint"),
    )


def days_before(as_of: Column, days: int) -> Column:
    """yyyymmdd number of the day ``days`` before ``as_of``."""
    return F.date_format(F.date_sub(as_of, days), "yyyyMMdd").cast("int")
