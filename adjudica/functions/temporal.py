"""Instants, and dates and hours in one stated zone. No function here reads the session's zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adjudica import vocabulary as V
from adjudica.functions.binding import let

# Naive input is read in this zone unless the caller names another.
DEFAULT_ZONE = "+05:30"
# --- fixed values: the date forms that are read ------------------------------------------------------------
_NAIVE_DATE = r"^\d{4}-\d{2}-\d{2}$"
_NAIVE_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?$"
_ZONED_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)? ?(Z|[+-]\d{2}:?\d{2})$"
_MAIL_DATE = r"^([A-Za-z]{3}, )?\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}(:\d{2})? [+-]\d{4}$"
_DAY_MONTH_YEAR = r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})(?:(?: |T|, )(\d{1,2}):(\d{2})(?::(\d{2}))?)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wall_clock(ts: Column | str, zone: str = DEFAULT_ZONE) -> Column:
    """The instant as read off a clock in ``zone`` (TIMESTAMP_NTZ)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), epoch)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def instant(ntz: Column | str, zone: str = DEFAULT_ZONE) -> Column:
    """The instant a wall clock in ``zone`` shows as ``ntz`` (TIMESTAMP)."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), _col(ntz))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, utc))


def parse_ts(
    c: Column | str,
    zone: str = DEFAULT_ZONE,
    day_first: bool = True,
    years: tuple[int, int] = (2000, 2100),
) -> Column:
    """An instant out of ISO, mail-header or day/month/year text, else null. Never fails a row.

    Day/month/year text may carry a time of day; other text behind it makes it unreadable.
    Text without an offset is read in ``zone``; years outside ``years`` (in ``zone``) give null.
    """


    def parse(s: Column) -> Column:
        # Spark's cast wants seconds wherever a zone follows, and a colon inside the offset.
        full = F.regexp_replace(s, r"([T ]\d{2}:\d{2})( ?(Z|[+-]).*)?$", "$1:00$2")
        offset = F.regexp_replace(full, r" ?([+-]\d{2}):?(\d{2})$", "$1:$2")
        # Spark refuses to parse a weekday name, so it comes off first.
        mail = F.regexp_replace(s, "^[A-Za-z]{3}, ", "")
        day, month = (1, 2) if day_first else (2, 1)
        dmy = F.concat(
            F.regexp_extract(s, _DAY_MONTH_YEAR, 3), F.lit("-"),
            F.lpad(F.regexp_extract(s, _DAY_MONTH_YEAR, month), 2, "0"), F.lit("-"),
            F.lpad(F.regexp_extract(s, _DAY_MONTH_YEAR, day), 2, "0"), F.lit("T"),
            *[x for k in (4, 5, 6) for x in (F.lpad(F.regexp_extract(s, _DAY_MONTH_YEAR, k), 2, "0"), F.lit(":" if k < 6 else zone))],
        )
        return (
            F.when(s.rlike(_NAIVE_DATE), F.concat(s, F.lit("T00:00:00" + zone)).try_cast("timestamp"))
            .when(s.rlike(_NAIVE_TIME), F.concat(full, F.lit(zone)).try_cast("timestamp"))
            .when(s.rlike(_ZONED_TIME), offset.try_cast("timestamp"))
            .when(
                s.rlike(_MAIL_DATE),
                F.coalesce(
                    F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm Z")),
                    F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss Z")),
                ),
            )
            .when(s.rlike(_DAY_MONTH_YEAR), dmy.try_cast("timestamp"))
        )

    in_range = lambda t: F.when(F.year(wall_clock(t, zone)).between(*years), t)
    return let(let(F.trim(_col(c)), parse), in_range)


def parse_date(c: Column | str, zone: str = DEFAULT_ZONE, years: tuple[int, int] = (2000, 2100)) -> Column:
    """The calendar date, in ``zone``, of text ``parse_ts`` reads; plain dates take a short way."""

    def parse(s: Column) -> Column:
        plain = s.try_cast("date")
        short = F.when(F.year(plain).between(*years), plain)
        return F.when(s.rlike(_NAIVE_DATE), short).otherwise(local_date(parse_ts(s, zone, years=years), zone))

    # A column by name costs little to name often, and plain dates then need no binding.
    return parse(F.trim(F.col(c))) if isinstance(c, str) else let(F.trim(_col(c)), parse)


def parse_serial(c: Column | str, zone: str = DEFAULT_ZONE) -> Column:
    """A spreadsheet day number between 20000 and 60000, as that many days after 1899-12-30 in ``zone``."""
    days = _col(c).cast("double")
    epoch = F.lit("1899-12-30 00:00:00").cast("timestamp_ntz")
    local = F.timestamp_add("SECOND", F.round(days * 86400).cast("long"), epoch)
    return F.when((days > 20000) & (days < 60000), instant(local, zone))


def local_date(ts: Column | str, zone: str = DEFAULT_ZONE) -> Column:
    """The calendar date of an instant in ``zone``."""
    return F.to_date(wall_clock(ts, zone))


def local_hour(ts: Column | str, zone: str = DEFAULT_ZONE) -> Column:
    """The hour, 0 to 23, of an instant in ``zone``."""
    return F.hour(wall_clock(ts, zone))


def utc_text(ts: Column | str) -> Column:
    """The instant as ISO text in UTC with milliseconds, the form exports carry."""
    return F.date_format(wall_clock(ts, "UTC"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Calendar days from one date to another; null if either is."""
    return F.datediff(_col(end), _col(start))


def is_night(hour: Column | str, start: int = V.NIGHT_FROM_HOUR, stop: int = V.NIGHT_TO_HOUR) -> Column:
    """Whether an hour falls in the night window, which wraps midnight."""
    return (_col(hour) >= start) | (_col(hour) < stop)


def tenure_months(joined: Column | str, on: Column | str, days: float = V.DAYS_PER_MONTH) -> Column:
    """Whole months from joining to a date; negative before joining, null if either is unknown."""
    return F.floor(days_between(joined, on) / F.lit(days)).cast("int")
