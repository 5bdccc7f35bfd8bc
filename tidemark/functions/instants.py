"""Time expressions. Instants are UTC and parsing never fails, it yields null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_instant(text: Column) -> Column:
    """ISO-8601 text to timestamp; extended and basic form, null if unparseable.

    The fifth character tells the forms apart, so the regular expression runs for basic form only
    and clock-only text such as ``10:30`` is not read as a time of today.
    """
    basic = F.regexp_replace(
        text, r"^(\d{4})(\d{2})(\d{2})T(\d{2}):?(\d{2}):?(\d{2})(.*)$", "$1-$2-$3T$4:$5:$6$7"
    )
    day_only = F.regexp_replace(basic, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return F.when(F.substring(text, 5, 1) == "-", F.try_to_timestamp(text)).when(
        text.rlike(r"^\d{4}($|\d{4}($|T))"), F.try_to_timestamp(day_only)
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Signed difference with microseconds kept; null if either side is null."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)


def duration_seconds(start_text: Column, end_text: Column) -> Column:
    """Difference of two ISO-8601 texts in seconds."""
    return seconds_between(parse_instant(start_text), parse_instant(end_text))


def round_trip_ms(sent: Column, received: Column) -> Column:
    """Round trip of a request in milliseconds."""
    return (F.unix_micros(received) - F.unix_micros(sent)) / F.lit(1000.0)


def activity_date(creation_time: Column) -> Column:
    """UTC day of an ISO-8601 text."""
    return F.to_date(parse_instant(creation_time))


def day_bounds(day: Column) -> tuple[Column, Column]:
    """First and last requested second of a day, without offset."""
    text = F.date_format(day, "yyyy-MM-dd")
    return F.concat(text, F.lit("T00:00:00")), F.concat(text, F.lit("T23:59:59"))


def month_bucket(day: Column) -> Column:
    """Monthly file key, ``activity_events_YYYY_MM``."""
    return F.format_string("activity_events_%d_%02d", F.year(day), F.month(day))


def instant_text(instant: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS``, with six fraction digits where there is a fraction."""
    whole = F.date_format(instant, "yyyy-MM-dd HH:mm:ss")
    micros = F.date_format(instant, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.when(F.unix_micros(instant) % 1_000_000 == 0, whole).otherwise(micros)


def minutes(seconds: Column) -> Column:
    """Seconds as minutes with one digit."""
    return F.round(seconds / F.lit(60.0), 1)
