"""Dates as columns: deadlines, work days, local days, shift clocks, parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def approval_deadline(day: Column) -> Column:
    """End of the half month (15th or last), then two working days later."""
    end = F.when(F.dayofmonth(day) <= 15, F.make_date(F.year(day), F.month(day), F.lit(15))).otherwise(F.last_day(day))
    dow = F.dayofweek(end) - 1  # Sunday 0
    return F.date_add(end, F.when(dow.isin(4, 5), 4).when(dow == 6, 3).otherwise(2))


def workdays(start: Column, end: Column, holidays: list[str] = ()) -> Column:
    """Weekdays from ``start`` up to but without ``end`` that are no holidays; 0 where end is not after start."""
    off = F.array(*[F.lit(h).cast("date") for h in holidays]).cast("array<date>")
    days = F.sequence(start, F.greatest(F.date_sub(end, 1), start))
    worked = F.size(F.filter(days, lambda d: ~F.dayofweek(d).isin(1, 7) & ~F.array_contains(off, d)))
    return F.when(end > start, worked).when(end <= start, 0)


def local_day(utc: Column, zone: str, day_starts: int = 0) -> Column:
    """Calendar day of a UTC timestamp in ``zone``, where a day begins at the hour ``day_starts``."""
    local = F.from_utc_timestamp(utc.cast("timestamp"), zone)
    return F.to_date(local - F.make_dt_interval(hours=F.lit(day_starts)))


def lateness(actual_seconds: Column, planned_seconds: Column) -> Column:
    """Minutes late, wrapped into -720 .. 719 so that a clock-in past midnight counts as near."""
    return F.pmod(F.floor((actual_seconds - planned_seconds) / 60) + 720, F.lit(1440)) - 720


def shift_minutes(c: Column) -> Column:
    """``9 PM``, ``9PM`` or ``9:00 pm`` as minutes since midnight; null for anything else, ``13 PM`` included."""
    form = r"^\s*(\d{1,2})(?::([0-5]\d))?\s*([AaPp])[Mm]\s*$"
    hour = F.regexp_extract(c, form, 1).try_cast("int")
    minute = F.coalesce(F.regexp_extract(c, form, 2).try_cast("int"), F.lit(0))
    evening = F.lower(F.regexp_extract(c, form, 3)) == "p"
    return F.when(hour.between(1, 12), (hour % 12 + F.when(evening, 12).otherwise(0)) * 60 + minute)


def epoch_or_iso(c: Column) -> Column:
    """Epoch milliseconds (beyond 9999999999), epoch seconds, or ISO text as a timestamp."""
    number = F.when(c.rlike(r"^\d+$"), c).try_cast("bigint")
    return F.when(number > 9_999_999_999, F.timestamp_millis(number)).when(number.isNotNull(),
        F.timestamp_seconds(number)).otherwise(F.try_to_timestamp(c))


def parse_day(c: Column) -> Column:
    """m/d/Y, m/d/y, ISO text or a spreadsheet's day number."""
    serial = F.when(c.rlike(r"^\d{5}(\.0+)?$"), F.regexp_extract(c, r"^(\d+)", 1)).try_cast("int")
    slashed = lambda p, f: F.when(c.rlike(p), F.to_date(F.try_to_timestamp(c, F.lit(f))))
    return F.coalesce(
        slashed(r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"), slashed(r"^\d{1,2}/\d{1,2}/\d{2}$", "M/d/yy"),
            F.date_add(F.lit("1899-12-30").cast("date"), serial),
        F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(c, 1, 10)).try_cast("date"),
    )


def filing_deadline(day: Column) -> Column:
    """Hours after the day's start until a report is late: 61 on a Friday, else 49."""
    return F.when(F.dayofweek(day) == 6, 61).otherwise(49)


def period_end(day: Column) -> Column:
    """Last day of the half month: the 15th or the month's last."""
    return F.when(F.dayofmonth(day) <= 15, F.make_date(F.year(day), F.month(day), F.lit(15))).otherwise(F.last_day(day))


def hours(c: Column) -> Column:
    """A number as hours, else the first number in the text; null without one."""
    return F.coalesce(F.trim(c).try_cast("double"), F.regexp_extract(c, r"(\d+\.?\d*)", 1).try_cast("double"))


# Fixed value: the 64 signs of chronological push ids, in the order of their values.
PUSH_SIGNS = "-0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"


def push_time(c: Column) -> Column:
    """Time in milliseconds that the first eight signs of a push id encode; null where one is no such sign."""
    value = F.aggregate(F.sequence(F.lit(1), F.lit(8)), F.lit(0).cast("long"), lambda s,
        i: s * 64 + F.instr(F.lit(PUSH_SIGNS), F.substr(c, i, F.lit(1))) - 1)
    return F.when(c.rlike(r"^[-0-9A-Z_a-z]{8}"), value)


def event_span(first: Column, end: Column, all_day: Column) -> tuple[Column, Column]:
    """Last day (an all-day event's end is exclusive) and number of days, one at least."""
    days = F.date_diff(end, first)
    return F.when(all_day & (days > 0), F.date_sub(end, 1)).otherwise(end), F.greatest(days, F.lit(1))
