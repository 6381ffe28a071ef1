import json
from datetime import datetime

import pytest

from marquee.sources import pages, shapes

NOW = datetime(2026, 9, 28)


@pytest.mark.parametrize(
    ("body", "via", "want"),
    [
        ({"events": [{"title": "Jazz &amp; Soul", "start_date": "2026-10-01 19:00:00", "url": "https://x.y/e", "cost": "$20", "venue": {"venue": "Hall", "address": "1 A St"}}]}, "tribe", ("Jazz & Soul", "2026-10-01 19:00:00", "Hall", "$20")),
        ([{"post": {"post_title": "Quiz"}, "meta": {"start": {"date": "2026-10-02"}}, "permalink": "https://x.y/q"}], "modern", ("Quiz", "2026-10-02", None, None)),
        ({"upcoming": [{"title": "Fair", "startDate": 1790000000000, "fullUrl": "/fair", "location": {"addressTitle": "Park"}}], "past": []}, "collection", ("Fair", "2026-09-21T14:13:20Z", "Park", None)),
        ([{"eventID": 4, "title": "Talk", "startDateTime": "2026-10-03T10:00:00", "customFields": [{"label": "Venue", "value": "<b>Library</b>"}, {"label": "Cost", "value": "Free"}]}], "calendar", ("Talk", "2026-10-03T10:00:00", "Library", "Free")),
        ({"records": [{"recordid": "r", "fields": {"subject": "Walk", "start_datetime": "2026-10-04", "venue": "Hill"}}]}, "dataset", ("Walk", "2026-10-04", "Hill", None)),
    ],
)
def test_shapes(body, via, want):
    [(rung, got, r)] = pages.records(json.dumps(body), NOW)
    assert (rung, got, (r["title"], r["start"], r["venue"], r["price"])) == (1, via, want)


def test_empty_feed_answers():
    assert shapes.from_json({"events": []}, pages.FIELDS) == ("tribe", [])
    assert shapes.from_json({"other": 1}, pages.FIELDS) is None


def test_atom():
    body = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom" xmlns:gd="http://g/2005"><entry><title>Choir</title><gd:when startTime="2026-10-05T18:00:00" endTime="2026-10-05T20:00:00"/><gd:where valueString="Church"/><link rel="alternate" href="https://x.y/c"/></entry><entry><title>No time</title></entry></feed>"""
    [(_, via, r)] = pages.records(body, NOW)
    assert (via, r["title"], r["start"], r["venue"], r["url"]) == ("atom", "Choir", "2026-10-05T18:00:00", "Church", "https://x.y/c")
    assert pages.records("<?xml version='1.0'?><rss/>", NOW) == []


def test_few_sessions():
    assert shapes.few_sessions(["2026-10-02T19:00:00", "2026-10-01T19:00:00"], "2026-09-30") == ["2026-10-01T19:00:00", "2026-10-02T19:00:00"]
    assert shapes.few_sessions(["2026-10-01"] * 3, None) == [] and shapes.few_sessions(["2026-10-01"], "2026-08-01") == []
