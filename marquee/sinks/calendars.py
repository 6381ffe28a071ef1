"""Calendar exports: events as VEVENTs, single files, deep links to calendars, links that carry a saved set.

Times are the city's wall clock and are written under its zone, never converted. `site` is the address that pages are published at.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from marquee.functions import listing as L
from marquee.functions.markup import escape_ical

TIMED = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2})?$"
DAY = r"^\d{4}-\d{2}-\d{2}$"
FLOOR = 4
SAVED, BETWEEN = "cal", "."


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _full(iso: Column) -> Column:
    return F.when(F.length(iso) == 16, F.concat(iso, F.lit(":00"))).otherwise(iso)


def stamp(iso: Column) -> Column:
    """20260905T193000 of a naive time, 20260905 of a day."""
    return F.regexp_replace(iso, "[-:]", "")


def span(start: Column, end: Column) -> Column:
    """Struct of start, end and all_day; null without a date. A day's end is the day after its last; without a later end a time takes two hours."""
    start, end = F.trim(_text(start)), F.trim(_text(end))
    timed, day = start.rlike(TIMED), start.rlike(DAY)
    later = F.date_format(F.when(timed, F.to_timestamp_ntz(_full(start))) + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss")
    stop = F.when(end.rlike(TIMED) & (end > start), _full(end)).otherwise(later)
    last = F.when(end.rlike(DAY) & (end > start), end).otherwise(start)
    after = F.date_format(F.date_add(F.when(day, F.to_date(last)), 1), "yyyy-MM-dd")
    return F.when(timed, F.struct(_full(start).alias("start"), stop.alias("end"), F.lit(False).alias("all_day"))).when(day, F.struct(start.alias("start"), after.alias("end"), F.lit(True).alias("all_day")))


def slug_of(city: Column, title: Column, start: Column, place: Column) -> Column:
    """The name of an event's page: its title and its frozen identity."""
    words, hashed = L.slug(title), L.event_hash(city, title, start, place)
    return F.when(words != "", F.concat_ws("-", words, hashed)).otherwise(hashed)


@F.pandas_udf(StringType())
def folded(text: pd.Series) -> pd.Series:
    """Every CRLF line in parts of at most 75 bytes, further ones after a space, never inside a character."""

    def line(s: str) -> str:
        raw, out, room = s.encode(), [], 75
        while len(raw) > room:
            cut = room
            while raw[cut] & 0xC0 == 0x80:
                cut -= 1
            out.append(raw[:cut])
            raw, room = raw[cut:], 74
        return b"\r\n ".join([*out, raw]).decode()

    return text.map(lambda t: None if t is None else "\r\n".join(line(x) for x in t.split("\r\n")))


def vevent(e: dict[str, Column], zone: str, site: str) -> Column:
    """The lines of one event, unfolded; null without a date. e: city, title, description, place, link, start, end."""
    s = span(e["start"], e["end"])
    page = F.concat(F.lit(site + "/"), e["city"], F.lit("/e/"), slug_of(e["city"], e["title"], e["start"], e["place"]), F.lit("/"))
    link = F.when(_text(e["link"]) != "", e["link"]).otherwise(page)
    at = lambda name, v: F.when(s["all_day"], F.concat(F.lit(f"{name};VALUE=DATE:"), stamp(v))).otherwise(F.concat(F.lit(f"{name};TZID={zone}:"), stamp(v)))
    about = F.when(_text(e["description"]) != "", F.concat(e["description"], F.lit("\n\n"), link)).otherwise(link)
    lines = F.array(
        F.lit("BEGIN:VEVENT"),
        F.concat(F.lit("UID:"), e["city"], F.lit("-"), L.event_hash(e["city"], e["title"], e["start"], e["place"])),
        at("DTSTART", s["start"]),
        at("DTEND", s["end"]),
        F.concat(F.lit("SUMMARY:"), escape_ical(_text(e["title"]))),
        F.when(_text(e["place"]) != "", F.concat(F.lit("LOCATION:"), escape_ical(e["place"]))),
        F.concat(F.lit("DESCRIPTION:"), escape_ical(about)),
        F.concat(F.lit("URL:"), link),
        F.lit("END:VEVENT"),
    )
    return F.when(s.isNotNull(), F.array_compact(lines))


def _columns(city: str) -> dict[str, Column]:
    return {"city": F.col(city), "title": F.col("title"), "description": F.col("description"), "place": F.col("location"), "link": F.col("link"), "start": F.col("datetime_iso"), "end": F.col("datetime_end_iso")}


def _calendar(name: Column, zone: str, lines: Column) -> Column:
    head = F.array(F.lit("BEGIN:VCALENDAR"), F.lit("VERSION:2.0"), F.lit("PRODID:-//listings//EN"), F.lit("CALSCALE:GREGORIAN"), F.concat(F.lit("X-WR-CALNAME:"), escape_ical(_text(name))), F.lit(f"X-WR-TIMEZONE:{zone}"))
    return folded(F.concat(F.array_join(F.concat(head, lines, F.array(F.lit("END:VCALENDAR"))), "\r\n"), F.lit("\r\n")))


def _shown(events: DataFrame) -> DataFrame:
    """Events without a low score; an unrated one is shown."""
    return events.filter(F.col("score").isNull() | (F.col("score") >= FLOOR))


def event_files(events: DataFrame, zone: str, site: str, city: str = "city_key") -> DataFrame:
    """name, body of one calendar file for each dated event, for the keyed file sink. Of events with one name the first by ord stays.

    events: the columns of listings with description and link, which may be null.
    """
    e = _columns(city)
    rows = _shown(events).withColumn("_lines", vevent(e, zone, site)).filter("_lines is not null")
    name = F.concat(F.col(city), F.lit("/e/"), slug_of(e["city"], e["title"], e["start"], e["place"]))
    one = rows.groupBy(name.alias("name")).agg(F.min_by(F.struct("title", "_lines"), "ord").alias("x"))
    return one.select("name", _calendar(F.col("x.title"), zone, F.col("x._lines")).alias("body"))


def city_feed(events: DataFrame, zone: str, site: str, city: str = "city_key") -> DataFrame:
    """city, body: one calendar for each city with its events by ord. A feed is one text, so a city's events meet in one group: pass what it publishes, a week."""
    rows = _shown(events).withColumn("_lines", vevent(_columns(city), zone, site)).filter("_lines is not null")
    blocks = rows.groupBy(city).agg(F.array_sort(F.collect_list(F.struct("ord", F.col("_lines").alias("lines")))).alias("_x"))
    return blocks.select(city, _calendar(F.initcap(F.col(city)), zone, F.flatten(F.transform("_x", lambda x: x["lines"]))).alias("body"))


def with_offset(iso: Column, zone: str) -> Column:
    """A naive time with the zone's offset at that time, Z for none; a day is its midnight."""
    full = F.when(F.length(iso) == 10, F.concat(iso, F.lit("T00:00:00"))).otherwise(_full(iso))
    wall = F.to_timestamp_ntz(full)
    minutes = F.timestamp_diff("MINUTE", F.convert_timezone(F.lit(zone), F.lit("UTC"), wall), wall)
    sign = F.when(minutes < 0, "-").otherwise("+")
    two = lambda n: F.lpad(n.cast("int").cast("string"), 2, "0")
    return F.concat(full, F.when(minutes == 0, "Z").otherwise(F.concat(sign, two(F.floor(F.abs(minutes) / 60)), F.lit(":"), two(F.abs(minutes) % 60))))


def _query(*pairs: tuple[str, Column]) -> Column:
    """key=value of those that aren't null, encoded as forms are."""
    return F.array_join(F.array_compact(F.array(*(F.when(v.isNotNull(), F.concat(F.lit(f"{k}="), F.url_encode(v))) for k, v in pairs))), "&")


def calendar_links(events: DataFrame, zone: str, site: str, city: str = "city_key") -> DataFrame:
    """The events with google, apple and outlook: links that add each to a calendar, null where there is no date."""
    e = _columns(city)
    s = span(e["start"], e["end"])
    page = F.concat(F.lit("/"), e["city"], F.lit("/e/"), slug_of(e["city"], e["title"], e["start"], e["place"]))
    link = F.when(_text(e["link"]) != "", e["link"]).otherwise(F.concat(F.lit(site), page, F.lit("/")))
    about = F.when(_text(e["description"]) != "", F.concat(e["description"], F.lit("\n\n"), link)).otherwise(link)
    place = F.when(_text(e["place"]) != "", e["place"])
    google = _query(("action", F.lit("TEMPLATE")), ("text", e["title"]), ("dates", F.concat(stamp(s["start"]), F.lit("/"), stamp(s["end"]))), ("details", about), ("ctz", F.lit(zone)), ("location", place))
    outlook = _query(("path", F.lit("/calendar/action/compose")), ("rru", F.lit("addevent")), ("subject", e["title"]), ("startdt", with_offset(s["start"], zone)), ("enddt", with_offset(s["end"], zone)), ("body", about), ("allday", F.when(s["all_day"], "true")), ("location", place))
    dated = lambda c: F.when(s.isNotNull(), c)
    return events.withColumns({
        "google": dated(F.concat(F.lit("https://calendar.google.com/calendar/render?"), google)),
        "apple": F.when(_text(e["start"]) != "", F.concat(page, F.lit(".ics"))),
        "outlook": dated(F.concat(F.lit("https://outlook.live.com/calendar/0/deeplink/compose?"), outlook)),
    })


def saved_link(saved: DataFrame, site: str, *by: str, city: str = "city_key") -> DataFrame:
    """by, link of each saved set (rows with by, ord and an event's columns): its identities by ord, in the fragment, which no server sees."""
    hashed = L.event_hash(F.col(city), F.col("title"), F.col("datetime_iso"), F.col("location"))
    ids = saved.groupBy(*dict.fromkeys((*by, city))).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", hashed.alias("id")))), lambda x: x["id"]).alias("_ids"))
    return ids.select(*by, F.concat(F.lit(site + "/"), F.col(city), F.lit(f"/#{SAVED}="), F.array_join("_ids", BETWEEN)).alias("link"))


def saved_ids(link: Column) -> Column:
    """The identities in a link's fragment, in order; null if it carries none, which is not an empty set."""
    fragment = F.regexp_extract(link, "#(.*)$", 1)
    raw = F.filter(F.split(fragment, "&"), lambda p: F.startswith(p, F.lit(f"{SAVED}=")))
    value = F.url_decode(F.substring(F.get(raw, F.lit(0)), len(SAVED) + 2, 1 << 30))
    return F.filter(F.split(value, r"\."), lambda x: x != "")


def saved_events(links: DataFrame, events: DataFrame, city: str = "city_key") -> DataFrame:
    """The links (key columns and link) with the events that their identities name and pos, the place in the link; what names nothing is left out.

    Of several events with one identity the last by ord counts. Columns that the links have too are theirs.
    """
    keyed = events.withColumn("_id", L.event_hash(F.col(city), F.col("title"), F.col("datetime_iso"), F.col("location")))
    last = keyed.groupBy("_id").agg(F.max_by(F.struct(*events.columns), "ord").alias("_e"))
    return links.select("*", F.posexplode(saved_ids(F.col("link"))).alias("pos", "_id")).join(last, "_id").select(*links.columns, "pos", *(f"_e.{c}" for c in events.columns if c not in (*links.columns, "pos")))
