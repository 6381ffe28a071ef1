from pyspark.sql import functions as F

from marquee.functions.listing import implied_once
from marquee.operators.clean import clean_events, clean_url, council_url, currency_codes, one_currency, tag_steps


def column(spark, values, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r["y"] for r in rows.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_currency(spark):
    codes = currency_codes(spark)
    costs = ["USD 0", "usd 25 or EUR$30", "AUD 5", "Fab 5", "Eur", "see EUR", None, "", "XUSD 3", "GBP .50"]
    assert column(spark, costs, lambda c: one_currency(c, "AUD", codes)) == ["AUD 0", "AUD 25 or AUD$30", "AUD 5", "Fab 5", "Eur", "see EUR", "", "", "XUSD 3", "AUD .50"]
    assert column(spark, ["USD 1"], lambda c: one_currency(c, "AUD", [])) == ["USD 1"]


def test_links(spark):
    urls = [" https://a.example/?x=1&amp;amp;y=2 ", "HTTP://a.example", "java&#115;cript:x", "ftp://a", None, "", "https://a.example/<b>"]
    assert column(spark, urls, clean_url) == ["https://a.example/?x=1&y=2", "HTTP://a.example", "", "", "", "", "https://a.example/<b>"]
    urls = ["https://www.brisbane.qld.gov.au/trumba?trumbaEmbed=view%3Devent%26eventid%3D12", "http://brisbane.qld.gov.au/a/b?trumbaEmbed=view=event&eventid=7&x", "https://brisbane.qld.gov.au/trumba?x", None]
    page = "https://www.trumba.com/calendars/brisbane-city-council?eventid="
    assert column(spark, urls, council_url) == [page + "12", page + "7", urls[2], None]


def test_events(spark):
    schema = "ord long, title string, datetime string, datetime_iso string, datetime_end_iso string, cost string, link string, image string, tags array<string>, x string"
    rows = [
        (1, "A &lt;i&gt;b&lt;/i&gt;", "Fri", "2026-09-11T19:00:00", "", "USD 5", "https://a.example", "https://a.example/p.PNG?x", [" Live &amp; Loud ", "<b>", None, "a < b", "c > d"], "<kept>"),
        (2, None, " 7-13 &amp; Sept ", None, None, None, None, "https://a.example/p", None, None),
        (3, "", None, "2026-13-45", "soon", "", "mailto:x", None, [], None),
    ]
    got = [r.asDict() for r in clean_events(spark.createDataFrame(rows, schema)).orderBy("ord").collect()]
    assert got[0] == dict(ord=1, title="A b", datetime="Fri 11 Sep, 7:00 PM", datetime_iso="2026-09-11T19:00:00", datetime_end_iso="", cost="AUD 5", link="https://a.example", image="https://a.example/p.PNG?x", tags=["live & loud", "", "", "a < b", "c > d"], x="<kept>")
    assert got[1] == dict(ord=2, title="", datetime="7-13 & Sept", datetime_iso=None, datetime_end_iso=None, cost="", link="", image="", tags=None, x=None)
    assert got[2] == dict(ord=3, title="", datetime="", datetime_iso="2026-13-45", datetime_end_iso="soon", cost="", link="", image="", tags=[], x=None)
    only = clean_events(spark.createDataFrame([(1, "<p>x")], "ord long, description string"))
    assert only.columns == ["ord", "description"] and only.first()["description"] == "x"


def test_tag_steps(spark):
    rows = [
        (1, ["art", "arts", "orchestra", "free"], "Riverside Hall", "Free Entry"),
        (2, ["art", "gallery", "talks", "brisbane", "new farm", "riverside"], "Riverside Hall", "$0.00"),
        (3, ["crafts", "free"], None, None),
        (4, ["fitness", "business"], "", "$10"),
        (5, None, "", "free"),
        (6, [], "", "no charge"),
        (7, ["bass", "basss", "bas"], "", ""),
    ]
    events = spark.createDataFrame(rows, "ord long, tags array<string>, location string, cost string")
    got = {r["ord"]: r["tags"] for r in tag_steps(events, "Brisbane").collect()}
    assert got[1] == ["art", "orchestra", "live music", "classical", "music", "free"]
    assert got[2] == ["art", "gallery", "new farm", "free"]
    assert got[3] == ["crafts"] and got[4] == ["fitness", "business"] and got[5] is None and got[6] == ["free"]
    assert got[7] == ["bas", "bass"]
    assert tag_steps(events.limit(0), "Brisbane").collect() == []


def test_implied_in_order_of_tags(spark):
    rows = spark.createDataFrame([(["hiking", "band"],)], "tags array<string>")
    assert rows.select(implied_once(F.col("tags")).alias("t")).first()["t"] == ["hiking", "band", "walking", "nature", "live music"]
