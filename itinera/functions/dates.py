"""Date and time expressions.

Day and minute differences follow the source system's boundary counting:
``day_diff`` counts midnights crossed and ``minute_diff`` counts minute
boundaries crossed (so 10:00:59 -> 10:01:00 is one minute).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock (NTZ) time, independent
    of the session time zone (no cast to a zoned timestamp)."""
    c = _c(ts)
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            c.cast("timestamp_ntz"))


def minute_index(ts) -> Column:
    """Whole minutes since 1970-01-01 (floor), zone independent."""
    return F.floor(epoch_micros(ts) / F.lit(60000000)).cast("long")


def time_id(d) -> Column:
    """Calendar key yyyymmdd as int."""
    return F.date_format(_c(d), "yyyyMMdd").cast("int")


def day_diff(a, b) -> Column:
    """Midnights crossed from a to b (negative when b is earlier)."""
    return F.datediff(F.to_date(_c(b)), F.to_date(_c(a)))


def minute_diff(a, b) -> Column:
    """Minute boundaries crossed from a to b."""
    return minute_index(b) - minute_index(a)


def plausible_date(d, fallback, as_of) -> Column:
    """``d`` when within five years of ``as_of``, else ``fallback`` when
    within, else null.  ``as_of`` is a parameter, never now()."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    lo = F.add_months(F.to_date(as_of), -60)
    hi = F.add_months(F.to_date(as_of), 60)
    d, fb = _c(d), _c(fallback)
    return (F.when(F.to_date(d).between(lo, hi), d)
            .when(F.to_date(fb).between(lo, hi), fb))


def advance_days(booking_type, booking_date, issue_date, travel_start, previous,
                 purchase=1, exchange=5) -> Column:
    """Advance-purchase days.

    Purchase: outside +-365 days -> 0; booked after issue -> count from
    issue; else count from booking (or issue).  Exchange: booked after issue
    and travel before issue -> -1; booked after issue -> from issue; else from
    booking (or issue).  Other types keep ``previous``.
    """
    bt = _c(booking_type)
    bd, idt, ts = _c(booking_date), _c(issue_date), _c(travel_start)
    from_book = day_diff(F.coalesce(bd, idt), ts)
    booked_late = day_diff(bd, idt) < 0
    from_issue = day_diff(idt, ts)
    return (F.when((bt == purchase) & ((from_book < -365) | (from_book > 365)), F.lit(0))
            .when((bt == purchase) & booked_late, from_issue)
            .when(bt == purchase, from_book)
            .when((bt == exchange) & booked_late & (from_issue < 0), F.lit(-1))
            .when((bt == exchange) & booked_late, from_issue)
            .when(bt == exchange, from_book)
            .otherwise(_c(previous)))


def saturday_stay(start, end) -> Column:
    """1 when weekday(start) (Sunday = 1) plus nights >= 8, else 0."""
    return F.when(F.dayofweek(_c(start)) + day_diff(start, end) >= 8, 1).otherwise(0)


def to_utc(local_ts, offset_minutes) -> Column:
    """Local wall-clock time with a UTC offset in minutes -> UTC time."""
    return _c(local_ts) - F.make_dt_interval(F.lit(0), F.lit(0), _c(offset_minutes).cast("int"))


def duration_minutes(start_utc, end_utc, sign=None, max_days: int = 22) -> Column:
    """Minutes between two UTC times; null when |days| >= ``max_days``;
    multiplied by ``sign`` (e.g. -1 for refunds) when given."""
    m = F.when(F.abs(day_diff(start_utc, end_utc)) < max_days, minute_diff(start_utc, end_utc))
    return m * _c(sign) if sign is not None else m
