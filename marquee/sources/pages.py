"""Records out of pages: JSON-LD, hydration JSON, feeds, iCalendar. The first rung of the ladder that answers wins."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.sources import shapes, streams

FIELDS = ("title", "description", "start", "end", "venue", "address", "url", "price", "image", "organiser")
RECORD = "page_id long, rung int, via string, " + ", ".join(f"{f} string" for f in FIELDS)
DEPTH = 12
TITLE = re.compile(r"^(title|name|eventname|headline)$", re.I)
START = re.compile(r"^(start|startdate|start_date|startdatetime|datestart|date|begin|startsat)$", re.I)
END = re.compile(r"^(end|enddate|end_date|enddatetime|dateend|endsat)$", re.I)
PLACE = re.compile(r"^(venue|location|place|venuename)$", re.I)
LINK = re.compile(r"^(url|link|permalink|href)$", re.I)
DATE = re.compile(r"\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|^\d{10}(\d{3})?$")
SCRIPT = re.compile(r"<script([^>]*)>(.*?)</script>", re.I | re.S)
# How frameworks assign the state of a page.
HYDRATED = [re.compile(p + r"\s*=\s*(\{[\s\S]*?\});?\s*</script>", re.I) for p in (r"window\.__NUXT__", r"window\.__remixContext", r"__sveltekit_[a-z0-9]+")]
FLIGHT = re.compile(streams.CHUNK)
HORIZON, STEPS = timedelta(days=60), 5000


def text_of(value, depth: int = 0) -> str | None:
    """A string for a string, number, list or object with a name."""
    if isinstance(value, str):
        return value.strip() or None
    if isinstance(value, bool) or value is None or depth > 3:
        return None
    if isinstance(value, int | float):
        return f"{value:g}" if isinstance(value, float) else str(value)
    if isinstance(value, list):
        return ", ".join(filter(None, (text_of(v, depth + 1) for v in value))) or None
    if isinstance(value, dict):
        return next((t for k in ("name", "title", "text", "rendered", "value", "url", "streetAddress") if (t := text_of(value.get(k), depth + 1))), None)
    return None


def walk(value, depth: int = 0) -> Iterator[dict]:
    if depth > DEPTH:
        return
    if isinstance(value, dict):
        yield value
        value = list(value.values())
    if isinstance(value, list):
        for v in value:
            yield from walk(v, depth + 1)


def json_ld(node: dict) -> dict | None:
    kinds = node.get("@type")
    kinds = kinds if isinstance(kinds, list) else [kinds]
    if not any(isinstance(k, str) and k.lower().endswith(("event", "festival", "courseinstance")) for k in kinds):
        return None
    place, offers = node.get("location"), node.get("offers")
    place = place[0] if isinstance(place, list) and place else place
    offers = offers[0] if isinstance(offers, list) and offers else offers
    address = place.get("address") if isinstance(place, dict) else None
    if isinstance(address, dict):
        address = ", ".join(filter(None, (text_of(address.get(k)) for k in ("streetAddress", "addressLocality", "addressRegion", "postalCode"))))
    price = " ".join(filter(None, (text_of(offers.get(k)) for k in ("priceCurrency", "price")))) if isinstance(offers, dict) else None
    values = (node.get("name"), node.get("description"), node.get("startDate"), node.get("endDate"), place, address, node.get("url"), price, node.get("image"), node.get("organizer"))
    return dict(zip(FIELDS, map(text_of, values), strict=True))


def picked(node: dict) -> dict | None:
    """Fields of an object that looks like a listing: a title and a value that looks like a date."""
    find = lambda pattern: next((node[k] for k in node if pattern.match(k)), None)
    title, start = text_of(find(TITLE)), text_of(find(START))
    if not title or not start or not DATE.search(start):
        return None
    out = dict.fromkeys(FIELDS)
    return out | {"title": title, "start": start, "end": text_of(find(END)), "venue": text_of(find(PLACE)), "url": text_of(find(LINK)), "description": text_of(node.get("description"))}


def ical(body: str, now: datetime) -> list[dict]:
    """Events of a calendar: unfolded, cancelled ones dropped, daily, weekly and monthly rules unrolled up to a horizon."""
    lines = re.sub(r"\r?\n[ \t]", "", body).splitlines()
    out, event = [], None
    for line in lines:
        if line == "BEGIN:VEVENT":
            event = {}
        elif line == "END:VEVENT" and event is not None:
            out += _occurrences(event, now)
            event = None
        elif event is not None and ":" in line:
            name, value = line.split(":", 1)
            event.setdefault(name.split(";")[0].upper(), []).append(value)
    return out


def _stamp(value: str) -> datetime | None:
    for form, n in (("%Y%m%dT%H%M%S", 15), ("%Y%m%d", 8)):
        try:
            return datetime.strptime(value[:n], form)
        except ValueError:
            pass
    return None


def _occurrences(event: dict, now: datetime) -> list[dict]:
    one = lambda k: (event.get(k) or [""])[0].replace("\\n", "\n").replace("\\,", ",").replace("\\;", ";")
    start = _stamp(one("DTSTART"))
    if start is None or one("STATUS").upper() == "CANCELLED":
        return []
    rule = dict(x.split("=", 1) for x in one("RRULE").split(";") if "=" in x)
    if rule and rule.get("FREQ") not in ("DAILY", "WEEKLY", "MONTHLY"):
        rule = {}
    gone = {_stamp(v) for values in event.get("EXDATE", []) for v in values.split(",")}
    until = min(filter(None, [_stamp(rule.get("UNTIL", "")), now + HORIZON]))
    starts = [start]
    if rule:
        days = [["MO", "TU", "WE", "TH", "FR", "SA", "SU"].index(d) for d in rule.get("BYDAY", "").split(",") if d in ("MO", "TU", "WE", "TH", "FR", "SA", "SU")]
        step, most, starts = int(rule.get("INTERVAL", 1)), int(rule.get("COUNT", STEPS)), []
        for i in range(STEPS):
            if rule["FREQ"] == "DAILY":
                at = [start + timedelta(days=i * step)]
            elif rule["FREQ"] == "WEEKLY":
                monday = start - timedelta(days=start.weekday()) + timedelta(weeks=i * step)
                at = [monday + timedelta(days=d) for d in sorted(days or [start.weekday()])]
            else:
                month = start.month - 1 + i * step
                try:
                    at = [start.replace(year=start.year + month // 12, month=month % 12 + 1)]
                except ValueError:
                    at = []
            starts += [a for a in at if start <= a <= until]
            if len(starts) >= most or at and min(at) > until:
                break
        starts = starts[:most]
    length = (_stamp(one("DTEND")) or start) - start
    fields = dict.fromkeys(FIELDS) | {"title": one("SUMMARY"), "description": one("DESCRIPTION") or None, "venue": one("LOCATION") or None, "url": one("URL") or None}
    day_only = len(one("DTSTART")) == 8
    form = "%Y-%m-%d" if day_only else "%Y-%m-%dT%H:%M:%S"
    return [fields | {"start": s.strftime(form), "end": (s + length).strftime(form) if length else None} for s in starts if s not in gone]


def hydration(body: str) -> list:
    """The JSON that frameworks leave in scripts without a type of their own: assigned objects and streamed payloads."""
    out = []
    for pattern in HYDRATED:
        m = pattern.search(body)
        try:
            out += [json.loads(m[1])] if m else []
        except ValueError:
            pass
    chunks = []
    for chunk in FLIGHT.findall(body):
        try:
            chunks.append(json.loads(chunk))
        except ValueError:
            pass
    return out + [json.loads(v) for v in streams.values_of("".join(chunks))]


def records(body: str | None, now: datetime) -> list[tuple[int, str, dict]]:
    """(rung, via, fields) of everything a page yields on the first rung that answers."""
    body = body or ""
    if body.lstrip().startswith("BEGIN:VCALENDAR"):
        return [(1, "ical", r) for r in ical(body, now)]
    if body.lstrip()[:1] in ("{", "["):
        try:
            value = json.loads(body)
        except ValueError:
            return []
        known = shapes.from_json(value, FIELDS)
        if known is not None:
            return [(1, known[0], r) for r in known[1]]
        return [(1, "feed", r) for node in walk(value) if (r := picked(node))]
    if body.lstrip("\ufeff \n").startswith(("<?xml", "<feed")):
        atom = shapes.from_atom(body, FIELDS)
        if atom is not None:
            return [(1, "atom", r) for r in atom]
    blobs = {"jsonld": [], "embedded": []}
    for attributes, script in SCRIPT.findall(body):
        kind = "jsonld" if "ld+json" in attributes else "embedded" if "json" in attributes or "__NEXT_DATA__" in attributes else None
        if kind:
            try:
                blobs[kind].append(json.loads(script))
            except ValueError:
                pass
    blobs["embedded"] += hydration(body)
    for rung, kind, take in ((2, "jsonld", json_ld), (3, "embedded", picked)):
        found = [(rung, kind, r) for blob in blobs[kind] for node in walk(blob) if (r := take(node))]
        if found:
            return found
    return []


def extract(pages: DataFrame, now: datetime, body: str = "html") -> DataFrame:
    """One row per record of each page, repeated ones (title, start, url) once. pages: page_id and the body column."""

    def run(batches):
        for batch in batches:
            rows = [(i, rung, via, *(r[f] for f in FIELDS)) for i, b in zip(batch["page_id"], batch[body], strict=True) for rung, via, r in records(b, now)]
            yield pd.DataFrame(rows, columns=["page_id", "rung", "via", *FIELDS])

    out = pages.select("page_id", body).mapInPandas(run, RECORD)
    w = Window.partitionBy("page_id", "title", "start", "url").orderBy("rung", "description")
    return out.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def curated(spark, path: str) -> DataFrame:
    """Events of curated per-source JSON files, with provider taken from the path; broken files are skipped."""
    raw = spark.read.option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    good = raw.filter("events is not null").withColumn("provider", F.regexp_extract(F.input_file_name(), r"/([^/]+)/curated/", 1))
    return good.select("city_key", "week_start", "week_end", "provider", F.explode("events").alias("e")).select("city_key", "week_start", "week_end", "provider", "e.*")
