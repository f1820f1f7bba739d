"""Publication dates, week labels, digest windows and slots. Sessions run in UTC."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import let

# The editorial zone, the display formats and the hours that cut the day.
ZONE = "America/Argentina/Buenos_Aires"
DATE_FORMAT = "dd/MM/yyyy"
STAMP_FORMAT = "dd/MM/yyyy HH:mm"
DIGEST_HOUR = 9
SLOT_HOURS = (8, 13, 18)

# Shapes of dates and how each is read; `plain` is the text without a weekday, with single blanks.
_CLOCK = r"\d{1,2}:\d{2}"
_SHAPES = (
    (rf"^\d{{1,2}} [A-Za-z]{{3}} \d{{4}} {_CLOCK}:\d{{2}} [A-Za-z]", "d MMM yyyy H:mm:ss z"),
    (rf"^\d{{1,2}} [A-Za-z]{{3}} \d{{4}} {_CLOCK}:\d{{2}} [+-]", "d MMM yyyy H:mm:ss Z"),
    (rf"^\d{{1,2}} [A-Za-z]{{3}} \d{{4}} {_CLOCK}:\d{{2}}$", "d MMM yyyy H:mm:ss"),
    (rf"^\d{{1,2}} [A-Za-z]{{3}} \d{{4}} {_CLOCK}$", "d MMM yyyy H:mm"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{4,9} \d{4}$", "d MMMM yyyy"),
    (rf"^[A-Za-z]{{3}} \d{{1,2}}, \d{{4}} {_CLOCK}:\d{{2}}$", "MMM d, yyyy H:mm:ss"),
    (rf"^[A-Za-z]{{3}} \d{{1,2}}, \d{{4}} {_CLOCK}$", "MMM d, yyyy H:mm"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^[A-Za-z]{4,9} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (rf"^\d{{4}}/\d{{1,2}}/\d{{1,2}} {_CLOCK}:\d{{2}}$", "yyyy/M/d H:mm:ss"),
    (rf"^\d{{4}}/\d{{1,2}}/\d{{1,2}} {_CLOCK}$", "yyyy/M/d H:mm"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
)


def parse_utc(col: Column) -> Column:
    """A text date as an instant, NULL when it cannot be read.

    The text's shape chooses how it is read: ISO, `Mon, 05 Jan 2026 10:00:00 GMT` and other orders of day,
    month and year with a named month, dates with slashes that begin with the year. A time is optional, a
    date is not, so nothing depends on the clock; the session zone (UTC) holds where none is given.
    """
    raw = F.trim(col.cast("string"))
    plain = F.regexp_replace(F.regexp_replace(raw, r"^[A-Za-z]{3,9},\s*", ""), r"\s+", " ")

    def read(plain: Column) -> Column:
        found = F.lit(None).cast("timestamp")
        for shape, pattern in reversed(_SHAPES):
            found = F.when(plain.rlike(shape), F.try_to_timestamp(plain, F.lit(pattern))).otherwise(found)
        return found

    return F.when(raw.rlike(r"^\d{4}(?:-|$)"), raw.try_cast("timestamp")).otherwise(let(plain, read))


def to_local(instant: Column, zone: str = ZONE) -> Column:
    """The wall clock in `zone`, kept in a timestamp column."""
    return F.from_utc_timestamp(instant, zone)


def local_date_text(col: Column, zone: str = ZONE) -> Column:
    """A UTC text date as the local `dd/MM/yyyy`; unreadable and missing dates are empty."""
    return F.coalesce(F.date_format(to_local(parse_utc(col), zone), DATE_FORMAT), F.lit(""))


def format_scraped_at(col: Column) -> Column:
    """An ISO stamp as `dd/MM/yyyy HH:mm` on its own wall clock; unreadable stamps are empty."""
    wall = F.regexp_replace(F.trim(col.cast("string")), r"(?:Z|[+-]\d{2}:?\d{2})\z", "").try_cast("timestamp")
    return F.coalesce(F.date_format(wall, STAMP_FORMAT), F.lit(""))


def parse_scraped_at(col: Column) -> Column:
    """`dd/MM/yyyy HH:mm` as a local wall-clock timestamp; NULL when it cannot be read."""
    return F.try_to_timestamp(col, F.lit("d/M/yyyy H:mm"))


def week_label(day: Column) -> Column:
    """`dd/MM/yyyy` as its Monday-to-Sunday label; month and year are the Monday's."""
    parsed = F.to_date(F.try_to_timestamp(day, F.lit("d/M/yyyy")))
    monday = F.to_date(F.date_trunc("week", parsed))
    label = F.concat(
        F.date_format(monday, "dd"),
        F.lit("–"),
        F.date_format(F.date_add(monday, 6), "dd"),
        F.lit(" "),
        F.upper(F.date_format(monday, "MMM")),
        F.lit(" "),
        F.date_format(monday, "yyyy"),
    )
    return F.coalesce(label, F.lit(""))


@dataclass(frozen=True)
class DigestWindow:
    """The half-open local window of one digest and its label."""

    start: datetime
    end: datetime

    @property
    def label(self) -> str:
        return f"{self.start:%d/%m/%Y %H:%M} - {self.end:%d/%m/%Y %H:%M}"


def window_bounds(now: datetime, hour: int = DIGEST_HOUR) -> DigestWindow:
    """The window that closes on the day of `now`: one day long, three on Mondays."""
    end = now.replace(hour=hour, minute=0, second=0, microsecond=0)
    return DigestWindow(end - timedelta(days=3 if now.weekday() == 0 else 1), end)


def digest_day(local: Column, hour: int = DIGEST_HOUR) -> Column:
    """The day whose digest carries a local stamp; what closes on a weekend waits for Monday."""
    closes = F.to_date(local + F.make_dt_interval(hours=F.lit(24 - hour)))
    to_monday = F.when(F.weekday(closes) == 5, 2).when(F.weekday(closes) == 6, 1).otherwise(0)
    return F.date_add(closes, to_monday)


def digest_label(day: Column, hour: int = DIGEST_HOUR) -> Column:
    """The label of the window that closes on `day`."""
    back = F.when(F.weekday(day) == 0, 3).otherwise(1)
    clock = f"{hour:02d}:00"
    return F.concat(
        F.date_format(F.date_sub(day, back), DATE_FORMAT),
        F.lit(f" {clock} - "),
        F.date_format(day, DATE_FORMAT),
        F.lit(f" {clock}"),
    )


def digest_slot(local: Column) -> Column:
    """The daily slot of a local stamp: `18-08`, `08-13` or `13-18`."""
    early, noon, evening = SLOT_HOURS
    hour = F.hour(local)
    return (
        F.when((hour >= early) & (hour < noon), f"{early:02d}-{noon:02d}")
        .when((hour >= noon) & (hour < evening), f"{noon:02d}-{evening:02d}")
        .when(hour.isNotNull(), f"{evening:02d}-{early:02d}")
    )


def slot_date(local: Column) -> Column:
    """The day on which the slot is mailed: evening items belong to the next morning."""
    day = F.to_date(local)
    return F.when(F.hour(local) >= SLOT_HOURS[-1], F.date_add(day, 1)).otherwise(day)


def recent(day: Column, today: date, days_back: int = 1) -> Column:
    """True when the local date is `today` or at most `days_back` days before."""
    return day.between(F.lit(today - timedelta(days=days_back)), F.lit(today))
