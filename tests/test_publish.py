import json
import os

import pytest
from pyspark.sql import functions as F

from marquee.operators import publish

ZONE, SITE = "Australia/Sydney", "https://site.example"
SCHEMA = "city_key string, ord long, title string, datetime_iso string, datetime_end_iso string, location string, category string, score double, cost string, description string"
ROWS = [
    ("bay", 1, 'Late "show" \\ <b>one</b>', "2026-10-01T19:30", "", "Hall, 1 St", "Concert / Music", 8.0, "$25", "a " * 150),
    ("bay", 2, "Exhibition", "2026-02-14", "2027-01-03", None, "Arts / Exhibition", None, "Free", None),
    ("bay", 3, "Early", "2026-10-01T07:00:00", "2026-10-01T09:00:00", "Hall", "Concert / Music", 4.0, "$10 - $20", "line\nbreak\ttab"),
    ("bay", 4, "Low", "2026-10-01", "", "Hall", "Concert / Music", 3.0, None, None),
    ("bay", 5, "", "2026-10-01", "", "Hall", "Concert / Music", 9.0, None, None),
    ("bay", 6, None, "2026-10-01", "", "Hall", "Concert / Music", 9.0, None, None),
    ("bay", 7, "Undated", "", "", "Hall", "Concert / Music", 9.0, None, None),
    ("bay", 8, "Odd date", "2026-10-99", "", "Hall", "Concert / Music", 9.0, None, None),
    ("bay", 9, "After the change", "2026-10-04T12:00", None, "Hall", "Unknown kind", 9.0, "USD 12.50", ""),
    ("bay", 10, "Yesterday", "2026-09-29", "", "Hall", "Concert / Music", 9.0, None, None),
    ("bay", 1, "Early", "2026-10-01T07:00:00", "2026-10-01T09:00:00", "Hall", "Concert / Music", 4.0, "$10 - $20", "line\nbreak\ttab"),
    ("old", 11, "Gone", "2026-09-21", "", "Hall", "Concert / Music", 9.0, None, None),
    (None, 12, "Nowhere", "2026-10-01", "", "Hall", "Concert / Music", 9.0, None, None),
]


@pytest.fixture(scope="module")
def feed(spark):
    events = spark.createDataFrame(ROWS, SCHEMA).withColumn("slug", F.lit("clash")).withColumn("body", F.lit("clash"))
    cities = spark.createDataFrame(
        [("bay", "The Bay", "bay-town", "2026-09-28", "2026-10-04", None), ("old", "Old", "old", "2026-09-21", "2026-09-27", "2026-09-20"), ("hush", "Hush", "hush", "2026-09-28", "2026-10-04", "2026-09-27")],
        "city_key string, city string, slug string, week_start string, week_end string, generated_at string",
    )
    today = spark.createDataFrame([("bay", "2026-09-30"), ("old", "2026-09-30"), ("hush", "2026-10-04")], "city_key string, today string")
    return events, cities, today


def written(spark, feed, folder, split):
    events, cities, today = feed
    pieces = publish.feed_pieces(events, cities, today, ZONE, SITE, split)
    publish.write_pieces(pieces.unionByName(publish.index_pieces(pieces, cities, today, ZONE)), folder)
    return {os.path.relpath(os.path.join(at, n), folder): json.load(open(os.path.join(at, n))) for at, _, names in os.walk(folder) for n in names}


def test_files(spark, feed, tmp_path):
    folder = str(tmp_path / "ai")
    files = written(spark, feed, folder, 500)
    days = [f"bay-town/2026-{d}.json" for d in ("09-30", "10-01", "10-02", "10-03", "10-04")]
    week = "bay-town/week-2026-09-28"
    assert set(files) == {*days, f"{week}.json", f"{week}/arts.json", f"{week}/music.json", "hush/2026-10-04.json", "hush/week-2026-09-28.json", "index.json"}
    first = files[days[1]]
    assert {k: v for k, v in first.items() if k != "events"} == {"data_as_of": "2026-09-30", "city": "The Bay", "city_key": "bay", "timezone": ZONE, "date": "2026-10-01"}
    assert [e["title"] for e in first["events"]] == ["Exhibition", "Early", "Early", 'Late "show" \\ one']
    show, late, early = first["events"][0], first["events"][3], first["events"][2]
    assert (show["start"], show["end"], show["price"], show["free"], show["location"], show["description"]) == ("2026-02-14T00:00:00+11:00", "2027-01-03T00:00:00+11:00", 0, True, "", "")
    assert late["start"] == "2026-10-01T19:30:00+10:00" and late["end"] is None and late["price"] == 25 and not late["free"]
    assert late["description"].endswith("…") and len(late["description"]) <= 201
    assert late["url"].startswith(f"{SITE}/bay-town/e/late-show") and late["url"].endswith(f"-{late['id']}/")
    assert early["price"] is None and early["description"] == "line break tab"
    assert [e["title"] for e in files[days[4]]["events"]] == ["Exhibition", "After the change"]
    assert files[days[4]]["events"][1]["start"] == "2026-10-04T12:00:00+11:00" and files[days[4]]["events"][1]["price"] == 12.5
    assert len(files[f"{week}.json"]["events"]) == 6 and [e["title"] for e in files[f"{week}/arts.json"]["events"]] == ["Exhibition"]
    assert files["hush/2026-10-04.json"]["events"] == []
    index = {c["city_key"]: c for c in files["index.json"]["cities"]}
    assert files["index.json"]["data_as_of"] == "2026-10-04" and list(index) == ["bay", "hush", "old"]
    assert index["old"]["days"] == [] and index["old"]["week"] is None and index["old"]["week_categories"] == []
    assert index["bay"]["days"] == ["/ai/" + d for d in days] and [c["slug"] for c in index["bay"]["week_categories"]] == ["music", "arts"]
    assert publish.feed_faults(spark, folder, feed[2]).collect() == []

    # a larger limit: the split files of before go, all others come out the same
    again = written(spark, feed, folder, 10**6)
    assert set(files) - set(again) == {f"{week}/arts.json", f"{week}/music.json"}
    assert all(again[n] == files[n] for n in again if n != "index.json")
    sizes = {r["name"]: r["n_bytes"] for r in publish.file_sizes(publish.feed_pieces(*feed, ZONE, SITE, 10**6)).collect()}
    assert sizes == {n[:-5]: os.path.getsize(os.path.join(folder, n)) for n in again if n != "index.json"}


def test_faults(spark, feed, tmp_path):
    folder = str(tmp_path / "ai")
    written(spark, feed, folder, 10**6)
    day = lambda d: os.path.join(folder, f"bay-town/2026-{d}.json")
    os.remove(day("10-02"))
    open(day("10-03"), "w").write('{"city_key": "bay", "date": ')
    whole = json.load(open(day("10-01")))
    whole["events"][0]["id"] = ""
    whole["events"][1]["start"] = "2026-10-02T07:00:00+10:00"
    whole["events"][1]["end"] = None
    del whole["events"][2]["url"]
    json.dump(whole, open(day("10-01"), "w"))
    json.dump(dict(json.load(open(day("09-30"))), date="2026-09-29", events=None), open(day("09-30"), "w"))
    got = sorted((r["name"][9:-5], r["fault"]) for r in publish.feed_faults(spark, folder, feed[2]).collect())
    assert got == [("2026-09-30", "no events"), ("2026-09-30", "past"), ("2026-10-01", "no id"), ("2026-10-01", "no url"), ("2026-10-01", "not in its span"), ("2026-10-02", "missing"), ("2026-10-03", "not JSON")]


def test_nothing_to_publish(spark, feed):
    events, cities, today = feed
    assert publish.feed_pieces(events, cities.limit(0), today, ZONE, SITE).collect() == []
    pieces = publish.feed_pieces(events.limit(0), cities, today, ZONE, SITE)
    assert {r["n_events"] for r in publish.file_sizes(pieces).collect()} == {0} and pieces.filter("kind = 'category'").count() == 0


def test_sitemap(spark, feed):
    rows = publish.sitemap(feed[0], feed[1].filter("city_key = 'bay'"), feed[2], SITE).collect()
    assert len(rows) == 1 + 1 + 6 + 3 + 11 and all(r["loc"].endswith("/") for r in rows)
    by = {r["loc"]: (r["lastmod"], r["changefreq"], r["priority"]) for r in rows}
    assert by[f"{SITE}/"] == ("2026-09-30", "weekly", "1.0") and by[f"{SITE}/bay-town/tomorrow/"] == ("2026-09-30", "daily", "0.8")
    assert by[f"{SITE}/bay-town/talks/"] == ("2026-09-30", "weekly", "0.7")


def test_sizes_of_files_in_one_pass(spark, feed):
    events, cities, today = feed
    twice = events.unionByName(events)
    for split in (100, 10**6):
        sizes = publish.feed_sizes(twice, cities, today, ZONE, SITE, split)
        pieces = publish.feed_pieces(twice, cities, today, ZONE, SITE, split)
        assert sorted(sizes.collect()) == sorted(publish.file_sizes(pieces).collect())
        firsts = pieces.filter("part = 1 AND body LIKE '\n%'").groupBy("name").count().collect()
        assert len(firsts) == sizes.filter("n_events > 0").count() and all(r["count"] == 1 for r in firsts)
    index = lambda x: publish.city_entries(x, cities, today).orderBy("city_key").collect()
    assert index(sizes) == index(pieces)
    reads = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Generate explode(flatten(")
    assert reads(sizes) == 1 and reads(pieces) <= 4  # twice is a union of two
