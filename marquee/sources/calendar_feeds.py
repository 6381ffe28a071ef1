"""Events of iCalendar bodies: components are read in their task, recurrence sets are unrolled by Spark.

An event without a start or title, or with the status CANCELLED, gives nothing; a cancelled replacement leaves the instance it stands for.
Zones that are known by name count, others and none are the reader's own wall clock. One-off events are all kept, recurring
ones from a day before now to sixty days after it.
"""

from __future__ import annotations

import re
from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators import recurrence

COMPONENT = "page_id long, n int, uid string, title string, description string, place string, link string, zone string, all_day boolean, start timestamp_ntz, end timestamp_ntz, freq string, step int, count int, until timestamp_ntz, byday array<string>, bymonthday array<int>, rdates array<timestamp_ntz>, exdates array<timestamp_ntz>, replaces timestamp_ntz"
NAMES = [c.split()[0] for c in COMPONENT.split(", ")]
LENGTH = re.compile(r"^([+-]?)P(?:(\d+)W)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?$")


def _zone(name: str | None) -> str | None:
    try:
        return name if name and ZoneInfo(name) else None
    except (ValueError, OSError, KeyError):
        return None


def _time(value: str, zone: str | None) -> tuple[datetime, str | None, bool] | None:
    """Wall clock, zone and whether it is a day."""
    value = value.strip().split("/")[0]
    for form, n in (("%Y%m%dT%H%M%S", 15), ("%Y%m%d", 8)):
        try:
            if len(value.rstrip("Z")) == n:
                return datetime.strptime(value[:n], form), "UTC" if value.endswith("Z") else zone, n == 8
        except ValueError:
            return None
    return None


def _times(properties: list[tuple[dict, str]], zone: str | None) -> list[datetime]:
    """Wall clock times of list properties in the event's zone."""
    out = []
    for parameters, values in properties:
        for value in values.split(","):
            t = _time(value, _zone(parameters.get("TZID")))
            if t is None:
                continue
            at, own, _ = t
            if own and zone and own != zone:
                at = at.replace(tzinfo=ZoneInfo(own)).astimezone(ZoneInfo(zone)).replace(tzinfo=None)
            out.append(at)
    return out


def _plain(value: str) -> str:
    return re.sub(r"\\([nN,;\\])", lambda m: "\n" if m[1] in "nN" else m[1], value).strip()


def _number(rule: dict, name: str) -> int | None:
    try:
        return int(rule[name])
    except (KeyError, ValueError):
        return None


def components(body: str | None) -> list[tuple]:
    """The events of a body, without page_id; none if it is no calendar."""
    body = (body or "").lstrip("﻿ \t\r\n")
    if not body.startswith("BEGIN:VCALENDAR"):
        return []
    out, event, depth = [], None, 0
    for line in re.sub(r"\r?\n[ \t]", "", body).splitlines():
        name, _, value = line.partition(":")
        if name.count('"') % 2:  # a colon inside a quoted parameter
            head, _, value = line[line.index('"', len(name)) :].partition(":")
            name = line[: len(line) - len(value) - 1]
        key, *rest = name.upper().split(";") if '"' not in name else (name.split(";")[0].upper(), *name.split(";")[1:])
        if line.strip() == "BEGIN:VEVENT":
            event, depth = {}, 0
        elif key == "BEGIN" and event is not None:
            depth += 1
        elif key == "END" and value.strip() == "VEVENT" and event is not None:
            row = _component(event, len(out))
            out += [row] if row else []
            event = None
        elif key == "END" and event is not None:
            depth -= 1
        elif event is not None and not depth:
            original = dict(p.split("=", 1) for p in name.split(";")[1:] if "=" in p)
            event.setdefault(key, []).append(({k.upper(): v.strip('"') for k, v in original.items()}, value))
    return out


def _component(event: dict, n: int) -> tuple | None:
    one = lambda k: _plain(event[k][0][1]) if k in event else ""
    first = lambda k: _time(event[k][0][1], _zone(event[k][0][0].get("TZID"))) if k in event else None
    start = first("DTSTART")
    if start is None or not one("SUMMARY") or one("STATUS").upper() == "CANCELLED":
        return None
    at, zone, day = start
    end = _times(event.get("DTEND", [])[:1], zone)
    if not end and (m := LENGTH.match(one("DURATION"))):
        w, d, h, mi, s = (int(x or 0) for x in m.groups()[1:])
        end = [at + timedelta(weeks=w, days=d, hours=h, minutes=mi, seconds=s)]
    rule = {k.upper(): v for k, _, v in (x.partition("=") for x in one("RRULE").split(";")) if v}
    until = _times([({}, rule["UNTIL"])], zone)[:1] if "UNTIL" in rule else []
    if until and len(rule["UNTIL"]) == 8 and not day:
        until = [until[0] + timedelta(days=1, seconds=-1)]
    byday = [d.upper() for d in rule.get("BYDAY", "").split(",") if re.fullmatch(r"[+-]?\d*(MO|TU|WE|TH|FR|SA|SU)", d.upper())]
    monthday = [int(d) for d in rule.get("BYMONTHDAY", "").split(",") if re.fullmatch(r"[+-]?\d+", d)]
    replaces = _times(event.get("RECURRENCE-ID", [])[:1], zone)
    return (n, one("UID"), one("SUMMARY"), one("DESCRIPTION") or None, one("LOCATION") or None, one("URL") or None, zone, day, at, end[0] if end else None, rule.get("FREQ", "").upper() or None,
            _number(rule, "INTERVAL"), _number(rule, "COUNT"), until[0] if until else None, byday or None, monthday or None, _times(event.get("RDATE", []), zone) or None, _times(event.get("EXDATE", []), zone) or None,
            replaces[0] if replaces else None)


def read(pages: DataFrame, body: str = "html") -> DataFrame:
    """COMPONENT rows of the pages (page_id, body) that are calendars."""

    def run(batches):
        for batch in batches:
            rows = [(i, *c) for i, b in zip(batch["page_id"], batch[body], strict=True) for c in components(b)]
            frame = pd.DataFrame(rows, columns=NAMES)
            for c in ("step", "count"):
                frame[c] = frame[c].astype("Int32")
            yield frame

    return pages.filter(F.col(body).rlike(r"^[﻿\s]*BEGIN:VCALENDAR")).select("page_id", body).mapInPandas(run, COMPONENT)


def events(pages: DataFrame, now: datetime, body: str = "html") -> DataFrame:
    """page_id, id, title, description, start, end, place, link of every instance. Of one UID's masters the last in its body counts.

    Times without a zone are as written, days as days; zoned ones are instants in UTC. id is the UID, with the replaced or unrolled time for recurring events.
    """
    parts = read(pages, body)
    key = F.concat_ws("\0", F.col("page_id").cast("string"), "uid")
    parts = parts.withColumn("key", F.when(F.col("uid") != "", key).otherwise(F.concat_ws("\0", key, F.col("n").cast("string"))))
    masters = parts.filter("replaces is null").groupBy("key").agg(F.max_by(F.struct(*parts.columns), "n").alias("m")).select("m.*")
    low, high = now.astimezone(UTC).replace(tzinfo=None) - timedelta(days=1) if now.tzinfo else now - timedelta(days=1), None
    high = low + timedelta(days=1 + recurrence.AHEAD)
    series = masters.select(F.col("key").alias("uid"), *(c for c in NAMES if c not in ("page_id", "uid", "title", "description", "place", "link", "replaces", "n", "all_day")))
    moved = parts.filter("replaces is not null").select(F.col("key").alias("uid"), F.col("replaces").alias("recurrence_id"), "start", "end")
    found = recurrence.expand(series, moved, low.isoformat(sep=" "), high.isoformat(sep=" ")).withColumnsRenamed({"uid": "key", "start": "_start", "end": "_end"})
    words = ("title", "description", "place", "link")
    new = parts.filter("replaces is not null").groupBy("key", "replaces").agg(F.max_by(F.struct(*words), F.struct("start", "n")).alias("_new"))
    rows = found.join(masters, "key").join(new.withColumnRenamed("replaces", "recurrence_id"), ["key", "recurrence_id"], "left")
    recurring = F.coalesce(F.col("freq").isin("DAILY", "WEEKLY", "MONTHLY", "YEARLY"), F.lit(False)) | F.col("rdates").isNotNull()
    shown = lambda t: F.when(F.col("all_day"), F.date_format(t, "yyyy-MM-dd")).otherwise(recurrence.raw_time(t, F.col("zone")))
    pick = lambda c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
    return rows.select("page_id", F.when(recurring, F.concat_ws("@", "uid", F.date_format("recurrence_id", "yyyy-MM-dd'T'HH:mm:ss"))).otherwise(F.col("uid")).alias("id"), pick("title"), pick("description"), shown(F.col("_start")).alias("start"), shown(F.col("_end")).alias("end"), pick("place"), pick("link"))
