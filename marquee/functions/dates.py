"""Dates as readers see them: weeks, zones, labels. ISO strings are naive local time; "" and null are missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee import model

from marquee.functions.listing import day

ISO_DAY = "yyyy-MM-dd"


def _iso(date: Column) -> Column:
    return F.date_format(date, ISO_DAY)


def coming_week(date: Column) -> Column:
    """(start, end) of the week to publish: a Sunday already belongs to the week that follows it."""
    monday = F.when(F.dayofweek(date) == 1, F.date_add(date, 1)).otherwise(F.date_trunc("week", date).cast("date"))
    return F.struct(_iso(monday).alias("start"), _iso(F.date_add(monday, 6)).alias("end"))


def start_of_week(date: Column) -> Column:
    return _iso(F.date_trunc("week", date))


def end_of_month(date: Column) -> Column:
    return _iso(F.last_day(date))


def weekend(date: Column) -> Column:
    """(start, end) of the weekend that is on or comes: on a Sunday that day alone."""
    n = F.dayofweek(date)
    start = F.when(n == 1, date).otherwise(F.date_add(date, (7 - n).cast("int")))
    return F.struct(_iso(start).alias("start"), _iso(F.when(n == 1, date).otherwise(F.date_add(start, 1))).alias("end"))


def to_instant(naive: Column, zone: Column | str) -> Column:
    """The instant of a local time; null in the gap where clocks go forward, the first of two where they go back."""
    local = naive.cast("timestamp")
    zone = F.lit(zone) if isinstance(zone, str) else zone
    instant = F.to_utc_timestamp(local, zone)
    return F.when(F.from_utc_timestamp(instant, zone) == local, instant)


def local_naive(instant: Column, zone: Column | str) -> Column:
    """Local ISO text of an instant, the date alone at midnight."""
    local = F.date_format(F.from_utc_timestamp(instant, zone), "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.endswith(local, F.lit("T00:00:00")), F.substring(local, 1, 10)).otherwise(local)


def clock(iso: Column) -> Column:
    return F.date_format(F.to_timestamp_ntz(iso), "h:mm a")


def _timed(iso: Column) -> Column:
    return F.length(iso) > 10


def human_datetime(start: Column, end: Column) -> Column:
    """`Wed 30 Sep, 7:00 PM`, with ` – Fri 2 Oct` for a later end, and years where they differ; "" without a start."""
    a, b = day(start).cast("date"), day(end).cast("date")
    label = lambda d: F.date_format(d, "EEE d MMM")
    time = F.when(_timed(start), F.concat(F.lit(", "), clock(start))).otherwise("")
    years = F.year(a) != F.year(b)
    year = lambda d: F.when(years, F.concat(F.lit(" "), F.year(d).cast("string"))).otherwise("")
    runs = F.concat(label(a), year(a), time, F.lit(" – "), label(b), year(b))
    return F.coalesce(F.when(b > a, runs), F.concat(label(a), time), F.lit(""))


def short_date(iso: Column) -> Column:
    return F.coalesce(F.date_format(F.try_to_date(F.substring(iso, 1, 10)), "d MMM"), iso)


def display_datetime(shown: Column, start: Column, end: Column, today: str) -> Column:
    """`On now — until 2 Oct` for a run that began before today and isn't over, else the text as given."""
    running = (day(start) < today) & (day(end) >= today)
    return F.when(running, F.concat(F.lit("On now — until "), short_date(end))).otherwise(F.coalesce(shown, F.lit("")))


def date_label(iso: Column, today: str) -> Column:
    date, now = iso.cast("date"), F.lit(today).cast("date")
    other = F.when(F.year(date) != F.year(now), F.concat(F.lit(" "), F.year(date).cast("string"))).otherwise("")
    return F.when(date == now, "Today").when(date == F.date_add(now, 1), "Tomorrow").otherwise(F.concat(F.date_format(date, "EEEE d MMM"), other))


def reminder(start: Column) -> Column:
    """One hour before a timed start, 08:00 on a day without a time."""
    timed = F.to_timestamp_ntz(start) - F.expr("INTERVAL 1 HOUR")
    return F.when(_timed(start), timed).when(start.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.to_timestamp_ntz(F.concat(start, F.lit("T08:00:00"))))


def start_minutes(start: Column) -> Column:
    return F.when(_timed(start), F.substring(start, 12, 2).cast("int") * 60 + F.substring(start, 15, 2).cast("int"))


#: A word's edge by ASCII letters, as the fixed patterns mean it; Java's own also knows other letters.
_EDGE = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"


def date_hits(text: Column) -> Column:
    """How many things in a text look like dates or times."""
    return sum((F.regexp_count(text, F.lit(p.replace(r"\b", _EDGE))) for p in model.DATE_HITS), F.lit(0))


def date_window(week_start: str, week_end: str, today: str) -> tuple[str, str]:
    """From today, or from the week's start once today is past the window, to a week after the week's end."""
    from datetime import date, timedelta

    last = (date.fromisoformat(week_end) + timedelta(days=7)).isoformat()
    return (today if today <= last else week_start), last


def lane_percent(minutes: Column, first_hour: Column, last_hour: Column) -> Column:
    """Where a minute of the day lies between two hours, in percent; 0 for an empty span."""
    span = (last_hour - first_hour) * 60
    return F.when(span <= 0, 0.0).otherwise((minutes - first_hour * 60) / span * 100)
