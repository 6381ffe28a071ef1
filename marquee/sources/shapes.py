"""Feed shapes as data: where a feed's items are, and for each field the paths to try in order.

A path is keys joined by dots; `[]` takes the first item of a list that gives a text; `label:X` takes the value of the
entry labelled X in a list of labelled values; `ms:` reads epoch milliseconds; `href:` the first link of a piece of HTML.
A feed that is recognised but empty answers too, with no records.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from datetime import UTC, datetime
from xml.etree import ElementTree


@dataclass(frozen=True)
class Shape:
    name: str
    items: tuple[str, ...]
    marks: tuple[str, ...]
    fields: dict[str, tuple[str, ...]]


SHAPES = (
    Shape("tribe", ("events",), ("start_date", "url"), {
        "title": ("title",), "description": ("description", "excerpt"), "start": ("start_date",), "end": ("end_date",), "venue": ("venue.venue",),
        "address": ("venue.address",), "url": ("url",), "price": ("cost",), "image": ("image.url",),
    }),
    Shape("modern", ("events", ""), ("permalink",), {
        "title": ("title", "post.post_title"), "description": ("content", "excerpt"), "start": ("start_date", "start", "meta.start.date", "meta.start", "date.start.date", "date.start"),
        "end": ("end_date", "meta.end.date", "date.end.date"), "url": ("permalink", "url"),
    }),
    Shape("collection", ("upcoming", "items", "past"), ("fullUrl",), {
        "title": ("title",), "description": ("excerpt", "body"), "start": ("ms:startDate",), "end": ("ms:endDate",), "venue": ("location.addressTitle",),
        "address": ("location.addressLine1",), "url": ("fullUrl",), "image": ("assetUrl",),
    }),
    Shape("calendar", ("",), ("eventID", "startDateTime"), {
        "title": ("title",), "description": ("description",), "start": ("startDateTime",), "end": ("endDateTime",), "venue": ("customFields.label:Venue", "location"),
        "address": ("customFields.label:Venue address",), "url": ("href:webLink", "webLink", "href:description", "permaLinkUrl"), "price": ("customFields.label:Cost",), "image": ("eventImage.url",),
    }),
    Shape("dataset", ("records",), ("recordid",), {
        "title": ("fields.subject",), "description": ("fields.description",), "start": ("fields.start_datetime",), "end": ("fields.end_datetime",), "venue": ("fields.venue", "fields.location"),
        "address": ("fields.venueaddress",), "url": ("href:fields.bookings", "href:fields.description", "fields.web_link"), "price": ("fields.cost",), "image": ("fields.eventimage",),
    }),
)

HREF = re.compile(r"""<a\s[^>]*href=["'](https?://[^"']+)["']""", re.I)


def plain(value) -> str | None:
    if isinstance(value, bool) or value is None or isinstance(value, dict | list):
        return None
    text = re.sub(r"\s+", " ", re.sub(r"<[^>]*>", " ", html.unescape(str(value)))).strip()
    return text or None


def at_path(item, path: str):
    kind, _, rest = path.partition(":") if path.startswith(("ms:", "href:")) else ("", "", path)
    value = item
    while rest and value is not None:
        if rest.startswith("label:"):
            label = rest.removeprefix("label:").lower()
            return next((plain(x.get("value")) for x in value if isinstance(x, dict) and str(x.get("label")).lower() == label), None) if isinstance(value, list) else None
        key, _, rest = rest.partition(".")
        value = value.get(key) if isinstance(value, dict) else None
    if kind == "ms":
        return datetime.fromtimestamp(value / 1000, UTC).strftime("%Y-%m-%dT%H:%M:%SZ") if isinstance(value, int | float) and not isinstance(value, bool) else None
    if kind == "href":
        found = HREF.search(value) if isinstance(value, str) else None
        return html.unescape(found[1]) if found else None
    return plain(value)


def read(item: dict, shape: Shape, names: tuple[str, ...]) -> dict | None:
    out = {n: next((v for p in shape.fields.get(n, ()) if (v := at_path(item, p))), None) for n in names}
    return out if out["title"] and out["start"] else None


def from_json(body, names: tuple[str, ...]) -> tuple[str, list[dict]] | None:
    """(shape, records) if the body has a known shape, else None."""
    for shape in SHAPES:
        items, known = [], False
        for key in shape.items:
            found = body if key == "" else body.get(key) if isinstance(body, dict) else None
            if isinstance(found, list):
                known = known or key != "" and len(found) == 0 and shape.name == "tribe"
                items += [x for x in found if isinstance(x, dict)]
        if known or any(all(m in x for m in shape.marks) for x in items):
            return shape.name, [r for x in items if (r := read(x, shape, names))]
    return None


def from_atom(body: str, names: tuple[str, ...]) -> list[dict] | None:
    """Records of an Atom feed whose entries say when they are, None for other XML."""
    try:
        root = ElementTree.fromstring(body.lstrip("﻿ \n\r\t"))
    except ElementTree.ParseError:
        return None
    local = lambda e: e.tag.rpartition("}")[2]
    if local(root) != "feed":
        return None
    out = []
    for entry in (e for e in root if local(e) == "entry"):
        first = {}
        for child in entry:
            first.setdefault(local(child), child)
        text = lambda k: plain(first[k].text) if k in first else None  # noqa: B023, E731
        when = first.get("when")
        link = next((e.get("href") for e in entry if local(e) == "link" and e.get("rel", "alternate") == "alternate"), None)
        if text("title") and when is not None and when.get("startTime"):
            record = dict.fromkeys(names) | {"title": text("title"), "start": when.get("startTime"), "end": when.get("endTime"), "description": text("notes") or text("content"), "url": link}
            record |= {"venue": text("venue") or (first["where"].get("valueString") if "where" in first else None), "address": text("venueaddress"), "price": text("cost"), "image": text("eventimage")}
            out.append(record)
    return out


def few_sessions(sessions: list[str], released: str | None, most: int = 2, days: int = 14) -> list[str]:
    """The sessions of a film that is an occasion: few of them, soon after its release; else none."""
    ordered = sorted(s for s in sessions if s)
    if not ordered or len(ordered) > most:
        return []
    if released and abs((datetime.fromisoformat(ordered[0][:10]) - datetime.fromisoformat(released[:10])).days) > days:
        return []
    return ordered
