"""iCalendar, RSS and Markdown as columns of text, one row per city, and partitioned JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import listing as L
from marquee.functions.markup import escape_ical, escape_xml


def _stamp(iso: Column) -> Column:
    return F.regexp_replace(iso, "[-:]", "")


def ical_block(city: Column, title: Column, start: Column, end: Column, place: Column) -> Column:
    """A VEVENT with CRLF line ends; two hours where a timed listing has no end."""
    timed = F.length(start) > 10
    later = F.date_format(F.to_timestamp_ntz(start) + F.expr("INTERVAL 2 HOURS"), "yyyyMMdd'T'HHmmss")
    close = F.when(timed & (F.coalesce(end, F.lit("")) == ""), F.concat(F.lit("DTEND:"), later)).when(F.coalesce(end, F.lit("")) != "", F.concat(F.lit("DTEND;VALUE=DATE:"), _stamp(F.substring(end, 1, 10))))
    open_ = F.when(timed, F.concat(F.lit("DTSTART:"), _stamp(start))).otherwise(F.concat(F.lit("DTSTART;VALUE=DATE:"), _stamp(start)))
    lines = ["BEGIN:VEVENT", F.concat(F.lit("UID:"), L.event_hash(city, title, start, place)), open_, close, F.concat(F.lit("SUMMARY:"), escape_ical(title)), F.concat(F.lit("LOCATION:"), escape_ical(place)), "END:VEVENT"]
    return F.array_join(F.array_compact(F.array(*(F.lit(x) if isinstance(x, str) else x for x in lines))), "\r\n")


def _joined(events: DataFrame, block: Column, head: Column, tail: Column, by: str) -> DataFrame:
    """One text per `by`; a city's listings of a week are few enough for one value."""
    rows = events.select(by, F.struct("ord", block.alias("block")).alias("x")).groupBy(by).agg(F.array_sort(F.collect_list("x")).alias("xs"))
    return rows.select(by, F.concat_ws("\r\n", head, F.array_join(F.transform("xs", lambda x: x["block"]), "\r\n"), tail).alias("body"))


def ical(events: DataFrame, by: str = "city_key") -> DataFrame:
    block = ical_block(F.col(by), F.col("title"), F.col("datetime_iso"), F.col("datetime_end_iso"), F.col("location"))
    return _joined(events.filter("datetime_iso <> ''"), block, F.lit("BEGIN:VCALENDAR\r\nVERSION:2.0"), F.lit("END:VCALENDAR"), by)


def rss(events: DataFrame, by: str = "city_key") -> DataFrame:
    guid = L.event_hash(F.col(by), F.col("title"), F.col("datetime_iso"), F.col("location"))
    item = F.concat(F.lit("<item><title>"), escape_xml(F.col("title")), F.lit("</title><guid>"), guid, F.lit("</guid><category>"), escape_xml(F.col("category")), F.lit("</category></item>"))
    head = F.concat(F.lit('<rss version="2.0"><channel><title>'), escape_xml(F.col(by)), F.lit("</title>"))
    return _joined(events, item, head, F.lit("</channel></rss>"), by)


def markdown(events: DataFrame, by: str = "city_key") -> DataFrame:
    line = F.concat(F.lit("- **"), F.col("title"), F.lit("** "), F.col("datetime_iso"), F.lit(" "), F.col("location"))
    return _joined(events, line, F.concat(F.lit("# "), F.initcap(F.col(by))), F.lit(""), by)


def write_partitioned(events: DataFrame, path: str, *by: str) -> None:
    """JSON by city and week; only the partitions in events are replaced."""
    events.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).json(path)
