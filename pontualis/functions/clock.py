"""Clock arithmetic on zone-less timestamps, as native column expressions.

Everything stays in TIMESTAMP_NTZ and interval arithmetic: functions such as
``date_trunc``, ``date_format`` or ``unix_timestamp`` go through the session
time zone and would shift times inside a daylight-saving gap.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86400
QUARTERS_PER_DAY = 96


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz")


def midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def epoch_seconds(moment: Column) -> Column:
    """Whole seconds since 1970-01-01 00:00 on the zone-less clock."""
    return (moment - _epoch()).cast("interval second").cast("bigint")


def from_epoch_seconds(seconds: Column) -> Column:
    return _epoch() + plus_seconds(seconds)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Elapsed seconds, fractions included, as a double."""
    return (later - earlier).cast("interval second").cast("decimal(18,6)").cast("double")


def plus_seconds(seconds: Column) -> Column:
    return F.expr("INTERVAL '1' SECOND") * seconds


def plus_minutes(minutes: Column) -> Column:
    return F.expr("INTERVAL '1' MINUTE") * minutes


def floor_div(number: Column, divisor: Column | int) -> Column:
    """Integer quotient rounded down, exact on longs; the divisor is positive."""
    divisor = F.lit(divisor).cast("bigint") if isinstance(divisor, int) else divisor
    return F.call_function("div", number - F.pmod(number, divisor), divisor)


def ceil_div(number: Column, divisor: Column) -> Column:
    return -floor_div(-number, divisor)


def half_away(number: Column) -> Column:
    """Nearest integer, halves away from zero."""
    return F.round(number).cast("bigint")


# --- HH:MM:SS texts that may run past 24:00 ---------------------------------

def hms_part(text: Column, position: int) -> Column:
    """One part of ``HH:MM:SS``; NULL when it is missing or not a number."""
    return F.get(F.split(text, ":"), F.lit(position)).try_cast("int")


def hms_seconds(text: Column) -> Column:
    """Seconds since midnight of the service day; exceeds a day after 24:00."""
    hours, minutes, seconds = (hms_part(text, k).cast("bigint") for k in range(3))
    return hours * 3600 + minutes * 60 + seconds


def extended_departure(day: Column, text: Column) -> Column:
    """``25:00:00`` on a service day is 01:00 of the next calendar day."""
    return midnight(day) + plus_seconds(hms_seconds(text))


def wrapped_duration_seconds(start: Column, end: Column) -> Column:
    """End minus start once both are folded into one day; may be negative."""
    return (F.pmod(hms_seconds(end), F.lit(DAY_SECONDS))
            - F.pmod(hms_seconds(start), F.lit(DAY_SECONDS)))


def wrapped_duration_minutes(start: Column, end: Column) -> Column:
    """The same difference counted in minute boundaries."""
    def minute_of_day(text: Column) -> Column:
        return floor_div(F.pmod(hms_seconds(text), F.lit(DAY_SECONDS)), 60)

    return minute_of_day(end) - minute_of_day(start)


def headway_minutes(headway_secs: Column) -> Column:
    return half_away(headway_secs / F.lit(60.0))


def departure_count(duration_minutes: Column, headway: Column) -> Column:
    """Departures in a window; NULL when the headway rounds to zero."""
    return half_away(F.try_divide(duration_minutes.cast("double"), headway.cast("double")))


def departure_numbers(count: Column) -> Column:
    """1..count, and no array at all below one: ``sequence(1, 0)`` would count down."""
    return F.when(count >= 1, F.sequence(F.lit(1).cast("bigint"), count))


# --- time-of-day buckets -----------------------------------------------------

def hour_bucket(moment: Column) -> Column:
    return F.hour(moment).cast("bigint")


def quarter_hour_number(moment: Column) -> Column:
    """0 for the band that starts at midnight, 95 for the last of the day."""
    return floor_div(F.hour(moment).cast("bigint") * 60 + F.minute(moment), 15)


def quarter_hour_label(band: Column) -> Column:
    """Text of a 15-minute band, for instance ``23:45:00 - 00:00:00``."""
    def clock_text(number: Column) -> Column:
        minute = F.pmod(number, F.lit(QUARTERS_PER_DAY)) * 15
        return F.format_string("%02d:%02d:00", floor_div(minute, 60), F.pmod(minute, F.lit(60)))

    text = F.concat(clock_text(band), F.lit(" - "), clock_text(band + 1))
    return F.when(band.isNotNull(), text)


def quarter_hour_bucket(moment: Column) -> Column:
    return quarter_hour_label(quarter_hour_number(moment))
