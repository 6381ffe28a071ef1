import os
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from marquee.operators.publish import write_pieces
from marquee.sinks.digests import digest_pieces, rss_pieces, utc_date

SCHEMA = "city_key string, ord long, title string, datetime_iso string, datetime_end_iso string, datetime string, location string, category string, score double, cost string, description string, link string, tags array<string>"
ROWS = [
    ("bay", 1, "A & <b>", "2026-09-08T19:30:00", "", "Tue 8 Sep", "Hall", "Concert / Music", 8.0, "Free", "tab\x0bgone", "https://a.example/?x=1&y=2", ["a", "b", None, "d", "e", "f", "g"]),
    ("bay", 2, None, None, None, None, None, None, None, None, None, None, None),
    ("bay", 3, "Run", "2026-09-08", "2026-12-01", "", "", "Arts / Exhibition", 9.0, "", "", "", []),
    ("bay", 4, "Low", "2026-09-09", "", "x", "y", "Arts / Exhibition", 1.0, "$5", None, None, None),
    ("bay", 5, "Odd", "2026-09-99", "", "x", "y", "Else", 7.0, "$5", None, None, None),
    ("bay", 4, "Low", "2026-09-09", "", "x", "y", "Arts / Exhibition", 1.0, "$5", None, None, None),
    ("gone", 6, "Elsewhere", "2026-09-09", "", "x", "y", "Else", 7.0, "$5", None, None, None),
]


@pytest.fixture(scope="module")
def told(spark):
    events = spark.createDataFrame(ROWS, SCHEMA).withColumn("slug", F.lit("clash")).withColumn("name", F.lit("clash"))
    cities = spark.createDataFrame([("bay", "B & Bay", "the-bay", "2026-09-07", "2026-09-13"), ("hush", "Hush", "hush", "2026-09-07", "2026-09-13")], "city_key string, city string, slug string, week_start string, week_end string")
    return events, cities


def written(pieces, folder, suffix):
    write_pieces(pieces, folder, suffix)
    return {os.path.relpath(os.path.join(at, n), folder): open(os.path.join(at, n), encoding="utf-8").read() for at, _, names in os.walk(folder) for n in names}


def test_rss(told, tmp_path):
    files = written(rss_pieces(*told, "Australia/Brisbane", "https://s.example", "now"), str(tmp_path), ".xml")
    assert set(files) == {"the-bay/feed.xml", "hush/feed.xml"}
    channel = ElementTree.fromstring(files["the-bay/feed.xml"].encode())[0]
    assert channel.findtext("title") == "B & Bay — this week's events" and channel.findtext("link") == "https://s.example/the-bay/"
    items = channel.findall("item")
    first = {x.tag: x.text for x in items[0]}
    assert (first["title"], first["link"], first["pubDate"], first["category"]) == ("A & <b>", "https://a.example/?x=1&y=2", "Tue, 08 Sep 2026 09:30:00 GMT", "Concert / Music")
    assert first["description"] == "Tue 8 Sep · Hall · Free\n\ntabgone" and first["guid"].startswith("https://s.example/the-bay#")
    assert [x.tag for x in items[1]] == ["title", "link", "guid", "description"] and items[1].findtext("link").startswith("https://s.example/the-bay/e/")
    assert [x.findtext("title") for x in items] == ["A & <b>", "", "Run", "Odd"] and items[3].find("pubDate") is None
    assert len({x.findtext("guid") for x in items}) == 4
    assert ElementTree.fromstring(files["hush/feed.xml"].encode())[0].findall("item") == []


def test_markdown(told, tmp_path):
    text = written(digest_pieces(*told), str(tmp_path), ".md")["THE-BAY.md"]
    assert text.startswith("# B & Bay — This Week's Events\n**7 September 2026 – 13 September 2026**  \n*1 top picks · 6 events total*\n\n## ⭐ Top Picks\n\n### 🎵 [A & <b>](https://a.example/?x=1&y=2)\n📆 Tue 8 Sep  \n📍 Hall  \n💰 Free  \n`a` `b` `d` `e` `f`\n\ntab")
    heads = [x for x in text.split("\n") if x.startswith("#")]
    assert heads[3:] == ["## 📋 All Events", "### 📌 Community / Other", "#### Untitled", "### 🎨 Arts / Exhibition", "#### Run", "#### Low", "#### Low", "### 📌 Else", "#### Odd"]
    assert "📆 —\n📍 —\n💰 See link\n\n" in text


def test_empty(told, tmp_path):
    events, cities = told
    files = written(digest_pieces(events.limit(0), cities), str(tmp_path), ".md")
    assert files["HUSH.md"] == "# Hush — This Week's Events\n**7 September 2026 – 13 September 2026**  \n*0 top picks · 0 events total*\n\n"
    assert digest_pieces(events, cities.limit(0)).collect() == [] and rss_pieces(events, cities.limit(0), "UTC", "x", "now").collect() == []


def test_dates_across_a_change_of_clocks(spark):
    rows = spark.createDataFrame([(1, "2026-10-04T01:30"), (2, "2026-10-04T03:30:00"), (3, "2026-10-05"), (4, None), (5, "soon")], "i int, x string")
    got = [r["y"] for r in rows.select("i", utc_date(F.col("x"), "Australia/Sydney").alias("y")).orderBy("i").collect()]
    assert got == ["Sat, 03 Oct 2026 15:30:00 GMT", "Sat, 03 Oct 2026 16:30:00 GMT", "Sun, 04 Oct 2026 13:00:00 GMT", None, None]
