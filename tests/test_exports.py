from datetime import datetime

from pyspark.sql import functions as F

from marquee.operators import corpus
from marquee.sinks import calendars
from marquee.sources import calendar_feeds

EVENT = "ord long, city_key string, title string, description string, location string, link string, datetime_iso string, datetime_end_iso string, score double"


def event(n, title="Gig", start="2026-09-05T19:30:00", end="", place="Hall, Level 1", about="Loud; live, and\nlong", link=None, score=8.0):
    return n, "brisbane", title, about, place, link, start, end, score


def spans(spark, pairs):
    rows = spark.createDataFrame(pairs, "s string, e string").select(calendars.span(F.col("s"), F.col("e")).alias("x")).collect()
    return [tuple(r.x) if r.x else None for r in rows]


def test_spans(spark):
    assert spans(spark, [("2026-09-05T19:30:00", ""), ("2026-09-05T23:30", "2026-09-05T22:00"), ("2026-09-05T19:30", "2026-09-06T01:00"), ("2026-09-05", None), ("2026-09-05", "2026-09-08"), ("2026-09-05", "2026-09-01"), ("", ""), (None, None), ("soon", "")]) == [
        ("2026-09-05T19:30:00", "2026-09-05T21:30:00", False), ("2026-09-05T23:30:00", "2026-09-06T01:30:00", False), ("2026-09-05T19:30:00", "2026-09-06T01:00:00", False),
        ("2026-09-05", "2026-09-06", True), ("2026-09-05", "2026-09-09", True), ("2026-09-05", "2026-09-06", True), None, None, None,
    ]


def test_event_files(spark):
    rows = [event(2), event(1, about=None, link="https://t.example"), event(3, "Fair", "2026-09-05", "2026-09-06"), event(4, "Low", score=1.0), event(5, "Unrated", score=None), event(6, "No date", ""), event(7, "ü" * 60)]
    files = {r.name: r.body for r in calendars.event_files(spark.createDataFrame(rows, EVENT), "Australia/Brisbane", "https://x.example").collect()}
    names = sorted(n.split("/e/")[1].rsplit("-", 1)[0] for n in files)
    assert names == ["fair", "gig", "unrated", "u" * 60]
    gig = next(b for n, b in files.items() if "/e/gig-" in n)
    lines = gig.split("\r\n")
    assert lines[0] == "BEGIN:VCALENDAR" and lines[-2:] == ["END:VCALENDAR", ""]
    # of two with one identity the first by ord
    assert "DESCRIPTION:https://t.example" in lines and "URL:https://t.example" in lines
    assert "DTSTART;TZID=Australia/Brisbane:20260905T193000" in lines and "DTEND;TZID=Australia/Brisbane:20260905T213000" in lines and "LOCATION:Hall\\, Level 1" in lines
    fair = next(b for n, b in files.items() if "/e/fair-" in n)
    assert "DTSTART;VALUE=DATE:20260905\r\nDTEND;VALUE=DATE:20260907" in fair and "DESCRIPTION:Loud\\; live\\, and\\nlong\\n\\nhttps://x.example/" in fair
    for body in files.values():
        assert all(len(x.encode()) <= 75 for x in body.split("\r\n"))
        body.encode().decode()
    long = next(b for b in files.values() if "ü" in b)
    assert "SUMMARY:" + "ü" * 60 in long.replace("\r\n ", "")


def test_city_feed(spark):
    rows = spark.createDataFrame([event(2, "B"), event(1, "A"), event(3, "C", "")], EVENT)
    body = calendars.city_feed(rows, "Australia/Brisbane", "https://x.example").first().body
    assert body.index("SUMMARY:A") < body.index("SUMMARY:B") and body.count("BEGIN:VEVENT") == 2 and "X-WR-CALNAME:Brisbane" in body
    assert calendars.city_feed(rows.limit(0), "UTC", "x").collect() == []


def test_links_to_calendars(spark):
    rows = calendars.calendar_links(spark.createDataFrame([event(1), event(2, "Fair & more", "2026-09-05", about=None, place=None), event(3, start="")], EVENT), "Australia/Sydney", "https://x.example").orderBy("ord").collect()
    assert rows[0].google.startswith("https://calendar.google.com/calendar/render?action=TEMPLATE&text=Gig&dates=20260905T193000%2F20260905T213000&details=Loud%3B+live%2C+and%0Along%0A%0Ahttps")
    assert rows[0].google.endswith("&ctz=Australia%2FSydney&location=Hall%2C+Level+1") and "startdt=2026-09-05T19%3A30%3A00%2B10%3A00" in rows[0].outlook
    assert "text=Fair+%26+more" in rows[1].google and "location" not in rows[1].google and "allday=true" in rows[1].outlook
    assert rows[2].google is None and rows[2].outlook is None and rows[2].apple is None


def test_offsets_follow_the_zone(spark):
    rows = spark.createDataFrame([("2026-01-05T10:00:00",), ("2026-07-05",), (None,)], "t string")
    at = lambda zone: [r.x for r in rows.select(calendars.with_offset(F.col("t"), zone).alias("x")).collect()]
    assert at("Australia/Sydney") == ["2026-01-05T10:00:00+11:00", "2026-07-05T00:00:00+10:00", None]
    assert at("America/St_Johns")[0] == "2026-01-05T10:00:00-03:30" and at("UTC")[0] == "2026-01-05T10:00:00Z"


def test_saved_sets_come_back_in_order(spark):
    events = spark.createDataFrame([event(1, "A"), event(2, "B"), event(3, "C"), event(4, "B")], EVENT)
    links = calendars.saved_link(events.filter("title <> 'A'").withColumn("ord", -F.col("ord")), "https://x.example", "city_key")
    back = calendars.saved_events(links.drop("city_key"), events).orderBy("pos").collect()
    assert [(r.pos, r.title, r.ord) for r in back] == [(0, "B", 4), (1, "C", 3), (2, "B", 4)]
    odd = spark.createDataFrame([("https://x/#cal=a.b..c",), ("https://x/#cal=",), ("https://x/#other=1",), ("https://x/",), ("https://x/#q=1&cal=z",), (None,)], "l string")
    assert [r.x for r in odd.select(calendars.saved_ids(F.col("l")).alias("x")).collect()] == [["a", "b", "c"], [], None, None, ["z"], None]


def test_stated_tags_come_before_taste(spark):
    profile = spark.createDataFrame([(1, "tag:jazz", 4.0), (1, "cat:music", 5.0), (1, "tag:rock", -2.0), (2, "tag:jazz", 1.0)], "user_id long, key string, weight double")
    prefs = spark.createDataFrame([(1, "folk", 1), (1, "rock", -1), (3, "folk", 1)], "user_id long, tag string, pref int")
    got = sorted(tuple(r) for r in corpus.effective_taste(profile, prefs).collect())
    assert got == [(1, "cat:__stated__", 3.0), (1, "cat:music", 5.0), (1, "tag:folk", 4.0), (1, "tag:jazz", 4.0), (2, "tag:jazz", 1.0), (3, "cat:__stated__", 3.0), (3, "tag:folk", 1.0)]
    events = spark.createDataFrame([(10, 1, 9.0, ["rock"]), (11, 2, 1.0, ["folk"]), (12, 3, None, []), (13, 4, 5.0, None), (14, 5, 5.0, ["jazz", "folk", "rock"])], "item long, ord long, score double, tags array<string>")
    keys = events.select("item", F.explode(F.transform("tags", lambda t: F.concat(F.lit("tag:"), t))).alias("key"))
    users = spark.createDataFrame([(1,), (4,), (1,)], "user_id long")
    places = {}
    for r in corpus.personal_order(users, events, profile, prefs, keys).orderBy("user_id", "place").collect():
        places.setdefault(r.user_id, []).append(r.item)
    assert places == {1: [11, 13, 12, 10, 14], 4: [10, 13, 14, 11, 12]}


def test_personal_order_without_a_shuffle_of_the_product(spark):
    scores = [None, 5.0, 7.5, 5.0, 1e8 / 7, 1234.5678912345, float("nan"), -0.0, 0.0]
    tags = [["jazz", "folk"], ["folk", "jazz", "jazz"], ["rock"], None, [], [None, "blues"], ["jazz", "rock"]]
    rows = [(i * 31 % 211, 1000 - i, scores[i * i % 9], tags[i % 7], i % 3) for i in range(211)]
    made = spark.createDataFrame(rows, "item long, ord long, score double, tags array<string>, c int")
    events = made.drop("c")
    keys = made.select("item", F.explode("tags").alias("t")).select("item", F.concat(F.lit("tag:"), "t").alias("key")).unionByName(made.filter("c < 2").select("item", F.concat(F.lit("cat:c"), "c").alias("key")))
    users = spark.createDataFrame([(1,), (2,), (3,), (4,), (5,), (5,)], "user_id long")
    profile = spark.createDataFrame([(u, k, float(w)) for u in (1, 2, 3, 9) for k, w in (("tag:jazz", u), ("tag:rock", 2 - u), ("tag:blues", 1), ("cat:c0", 3), ("cat:c1", 3 * (u - 1))) if w], "user_id long, key string, weight double")
    prefs = spark.createDataFrame([(2, "rock", -1), (2, "folk", 1), (4, "blues", 1), (9, "jazz", 1)], "user_id long, tag string, pref int")
    boosts = {(r.user_id, r.item): r.boost for r in corpus.taste_boost(corpus.effective_taste(profile, prefs), keys).collect()}
    whole = corpus.personal_order(users, events, profile, prefs, keys, block=37, group=2)
    got = {}
    for r in whole.collect():
        got.setdefault(r.user_id, []).append((r.place, r.item, r.tier, r.boost))
    assert set(got) == {1, 2, 3, 4, 5}
    for u in got:
        facts = []
        for item, order, score, t, _ in rows:
            tier = -1 if u == 2 and "rock" in (t or []) else 1 if (u == 2 and "folk" in (t or [])) or (u == 4 and "blues" in (t or [])) else 0
            rank = (score or 0.0) + boosts.get((u, item), 0.0)
            facts.append((-tier, -float("inf") if rank != rank else -round(rank, 9), order, item, boosts.get((u, item), 0.0)))
        assert sorted(got[u]) == [(n, f[3], -f[0], f[4]) for n, f in enumerate(sorted(facts), 1)]
    assert len({b for (u, _), b in boosts.items() if u == 1}) > 3
    one = {(r.user_id, r.item): (r.place, r.boost) for r in corpus.personal_order(users, events, profile, prefs, keys, digits=2).collect()}
    assert one == {(u, item): (n, round(b, 2)) for u, places in got.items() for n, item, _, b in places}
    assert corpus.personal_order(users, events.limit(0), profile, prefs, keys).collect() == corpus.personal_order(users.limit(0), events, profile, prefs, keys).collect() == []
    assert "windowspecdefinition(user_id" not in whole._jdf.queryExecution().optimizedPlan().toString()


BODY = """BEGIN:VCALENDAR\r
BEGIN:VTIMEZONE\r
TZID:Australia/Sydney\r
END:VTIMEZONE\r
BEGIN:VEVENT\r
UID:quiz\r
DTSTART;TZID=Australia/Sydney:20260803T190000\r
DURATION:PT2H\r
SUMMARY:Pub\\, quiz\r
 night\r
RRULE:FREQ=WEEKLY;BYDAY=MO,TH;UNTIL=20260820T090000Z\r
EXDATE;TZID=Australia/Sydney:20260806T190000\r
EXDATE:20260810T090000Z\r
RDATE;TZID=Australia/Sydney:20260815T120000\r
BEGIN:VALARM\r
SUMMARY:inner\r
END:VALARM\r
END:VEVENT\r
BEGIN:VEVENT\r
UID:quiz\r
RECURRENCE-ID;TZID=Australia/Sydney:20260813T190000\r
DTSTART;TZID=Australia/Sydney:20260814T200000\r
SUMMARY:Moved quiz\r
END:VEVENT\r
BEGIN:VEVENT\r
UID:quiz\r
RECURRENCE-ID;TZID=Australia/Sydney:20260817T190000\r
DTSTART;TZID=Australia/Sydney:20260818T200000\r
STATUS:CANCELLED\r
SUMMARY:Off\r
END:VEVENT\r
BEGIN:VEVENT\r
UID:old\r
DTSTART;VALUE=DATE:20200101\r
SUMMARY:Old day\r
END:VEVENT\r
BEGIN:VEVENT\r
UID:off\r
DTSTART:20260901T100000\r
STATUS:CANCELLED\r
SUMMARY:Off\r
END:VEVENT\r
BEGIN:VEVENT\r
DTSTART;TZID="Nowhere/Else":20260901T100000\r
SUMMARY:Floating\r
END:VEVENT\r
END:VCALENDAR\r
"""


def test_calendars_unroll_with_zones_and_replacements(spark):
    pages = spark.createDataFrame([(1, BODY), (2, "<html>BEGIN:VCALENDAR"), (3, None), (4, "BEGIN:VCALENDAR\nEND:VCALENDAR"), (5, "")], "page_id long, html string")
    got = sorted((r.id, r.title, r.start, r.end) for r in calendar_feeds.events(pages, datetime(2026, 8, 1)).collect())
    assert got == [
        ("", "Floating", "2026-09-01T10:00:00", None),
        ("old", "Old day", "2020-01-01", None),
        ("quiz@2026-08-03T19:00:00", "Pub, quiznight", "2026-08-03T09:00:00.000Z", "2026-08-03T11:00:00.000Z"),
        ("quiz@2026-08-13T19:00:00", "Moved quiz", "2026-08-14T10:00:00.000Z", None),
        ("quiz@2026-08-15T12:00:00", "Pub, quiznight", "2026-08-15T02:00:00.000Z", "2026-08-15T04:00:00.000Z"),
        ("quiz@2026-08-17T19:00:00", "Pub, quiznight", "2026-08-17T09:00:00.000Z", "2026-08-17T11:00:00.000Z"),
        ("quiz@2026-08-20T19:00:00", "Pub, quiznight", "2026-08-20T09:00:00.000Z", "2026-08-20T11:00:00.000Z"),
    ]
    assert calendar_feeds.events(pages.limit(0), datetime(2026, 8, 1)).collect() == []
