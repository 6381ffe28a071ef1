"""RSS feeds and Markdown digests of cities, as pieces of files: a text is put together by the task that writes it, piece after piece.

Both give name, part, naive, ord, body, in the order that write_pieces (operators/publish.py) takes. cities: city_key, city, week_start, week_end
and, if it isn't the key, slug. events: the columns of listings with datetime (as shown), cost, description and link, which may be null. Events
of a city that isn't there are left out; a city without events has a file that says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import model
from marquee.functions import listing as L
from marquee.functions.markup import escape_xml
from marquee.sinks.calendars import slug_of

_LISTED = ("city_key", "ord", "title", "datetime_iso", "datetime_end_iso", "datetime", "location", "category", "score", "cost", "description", "link", "tags")
_DATE = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2})?)?$"


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _slug(cities: DataFrame) -> Column:
    return F.col("slug") if "slug" in cities.columns else F.col("city_key")


def utc_date(iso: Column, zone: str) -> Column:
    """A naive time of the zone as RSS says dates, in GMT; a day is its midnight. Null without a date that can be read."""
    good = F.when(iso.rlike(_DATE) & F.try_to_timestamp(F.substring(iso, 1, 10), F.lit("yyyy-MM-dd")).isNotNull(), iso)
    full = F.when(F.length(good) == 10, F.concat(good, F.lit("T00:00:00"))).when(F.length(good) == 16, F.concat(good, F.lit(":00"))).otherwise(good)
    return F.date_format(F.convert_timezone(F.lit(zone), F.lit("UTC"), F.to_timestamp_ntz(full)), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")


def rss_pieces(events: DataFrame, cities: DataFrame, zone: str, site: str, built: str) -> DataFrame:
    """`slug/feed` of each city: its events by ord without those of a low score. built: the date of the build, as RSS says dates.

    An item's guid is its identity and no address; pubDate is the start, left out if there is none; link is the event's own or its page."""
    own = cities.select("city_key", "city", "week_start", "week_end", _slug(cities).alias("_slug"))
    name, home = F.concat("_slug", F.lit("/feed")), F.concat(F.lit(f"{site}/"), "_slug")
    rows = events.select(*_LISTED).filter(f"score IS NULL OR score >= {model.LOW_SCORE}").join(own.select("city_key", "_slug"), "city_key")
    identity = [F.col("city_key"), *map(_text, ("title", "datetime_iso", "location"))]
    rows = rows.withColumn("_hash", L.event_hash(*identity)).withColumn("_page", F.concat(home, F.lit("/e/"), slug_of(*identity), F.lit("/")))
    about = F.array_join(F.filter(F.array(*map(_text, ("datetime", "location", "cost"))), lambda x: x != ""), " · ")
    about = F.array_join(F.filter(F.array(about, _text("description")), lambda x: x != ""), "\n\n")
    tag = lambda n, x, more="": F.concat(F.lit(f"\n      <{n}{more}>"), x, F.lit(f"</{n}>"))
    category = F.when(_text("category") != "", tag("category", escape_xml(F.col("category"))))
    lines = [
        F.lit("\n    <item>"), tag("title", escape_xml(_text("title"))), tag("link", escape_xml(F.when(_text("link") != "", F.col("link")).otherwise(F.col("_page")))),
        tag("guid", escape_xml(F.concat(home, F.lit("#"), "_hash")), ' isPermaLink="false"'), tag("pubDate", utc_date(F.col("datetime_iso"), zone)), category,
        tag("description", escape_xml(about)), F.lit("\n    </item>"),
    ]
    none = F.lit(None).cast("string").alias("naive")
    items = rows.select(name.alias("name"), F.lit(1).alias("part"), none, "ord", F.concat(*(F.coalesce(x, F.lit("")) for x in lines)).alias("body"))
    week = F.concat(F.lit("Events in "), "city", F.lit(" for the week of "), "week_start", F.lit(" to "), "week_end", F.lit(", ranked by fit."))
    head = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<rss version="2.0" xmlns:atom="http://www.w3.org/2005/Atom">\n  <channel>\n    <title>'), escape_xml(F.col("city")), F.lit(" — this week's events</title>\n    <link>"), home,
        F.lit('/</link>\n    <atom:link href="'), home, F.lit('/feed.xml" rel="self" type="application/rss+xml"/>\n    <description>'), escape_xml(week),
        F.lit(f"</description>\n    <language>en-AU</language>\n    <lastBuildDate>{built}</lastBuildDate>"),
    )
    end = lambda part, body: own.select(name.alias("name"), F.lit(part).alias("part"), none, F.lit(None).cast("long").alias("ord"), body.alias("body"))
    return items.unionByName(end(0, head)).unionByName(end(2, F.lit("\n  </channel>\n</rss>\n")))


def digest_pieces(events: DataFrame, cities: DataFrame) -> DataFrame:
    """`SLUG` of each city: its top picks, then all others by category, in order of a category's first event and of ord within.

    A pick scores 7 or more and lies in the week with both ends. Parts: 0 head, 1 and 2 the picks, 3 and 4 the others."""
    own = cities.select("city_key", "city", "week_start", "week_end", F.upper(_slug(cities)).alias("name"))
    rows = events.select(*_LISTED).join(own, "city_key").withColumn("category", F.coalesce("category", F.lit("Community / Other")))
    first, last = L.day(F.col("datetime_iso")), F.coalesce(L.day(F.col("datetime_end_iso")), L.day(F.col("datetime_iso")))
    pick = F.coalesce((F.col("score") >= model.TOP_PICK) & first.between(F.col("week_start"), F.col("week_end")) & (last <= F.col("week_end")), F.lit(False))
    rows = rows.withColumn("_pick", pick)
    cost = F.coalesce("cost", F.lit("See link"))
    emoji = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for pair in model.CATEGORY_EMOJI.items() for x in pair)), F.col("category")), F.lit("📌"))
    label = F.coalesce("title", F.lit("Untitled"))
    title = F.when(_text("link") != "", F.concat(F.lit("["), label, F.lit("]("), "link", F.lit(")"))).otherwise(label)
    shown = F.filter(F.slice(F.coalesce("tags", F.array().cast("array<string>")), 1, 6), lambda t: t.isNotNull())
    end = F.when(F.col("_pick"), "  \n").otherwise("\n")
    body = F.concat(
        F.when(F.col("_pick"), F.concat(F.lit("### "), emoji, F.lit(" "))).otherwise("#### "), title, F.lit("\n📆 "), F.coalesce("datetime", F.lit("—")), end, F.lit("📍 "), F.coalesce("location", F.lit("—")), end,
        F.lit("💰 "), F.when(F.lower(cost) == "free", "Free").otherwise(cost), end, F.when(F.size(shown) > 0, F.concat(F.lit("`"), F.array_join(shown, "` `"), F.lit("`\n"))).otherwise(""),
        F.when(_text("description") != "", F.concat(F.lit("\n"), "description", F.lit("\n"))).otherwise(""), F.lit("\n"),
    )
    number = lambda c: F.lpad(c.cast("string"), 20, "0")
    groups = rows.filter("NOT _pick").groupBy("name", "category").agg(F.min("ord").alias("_first"))
    group = groups.select(F.col("name").alias("_name"), F.col("category").alias("_category"), "_first")
    placed = rows.join(group, (F.col("name") == F.col("_name")) & (F.col("category") == F.col("_category")) & ~F.col("_pick"), "left")
    none = F.lit(None).cast("long").alias("ord")
    pieces = placed.select("name", F.when(F.col("_pick"), 2).otherwise(4).alias("part"), number(F.col("_first")).alias("naive"), "ord", body.alias("body"))
    heads = groups.select("name", F.lit(4).alias("part"), number(F.col("_first")).alias("naive"), none, F.concat(F.lit("### "), emoji, F.lit(" "), "category", F.lit("\n\n")).alias("body"))
    counts = rows.groupBy("name").agg(F.count_if("_pick").alias("_picks"), F.count(F.lit(1)).alias("_all"))
    said = own.join(counts, "name", "left").withColumns({"_picks": F.coalesce("_picks", F.lit(0)), "_all": F.coalesce("_all", F.lit(0))})
    day = lambda c: F.date_format(F.col(c).cast("date"), "d MMMM yyyy")
    top = F.concat(F.lit("# "), "city", F.lit(" — This Week's Events\n**"), day("week_start"), F.lit(" – "), day("week_end"), F.lit("**  \n*"), F.col("_picks").cast("string"), F.lit(" top picks · "), F.col("_all").cast("string"), F.lit(" events total*\n\n"))
    fixed = F.array_compact(F.array(
        F.struct(F.lit(0).alias("part"), top.alias("body")), F.when(F.col("_picks") > 0, F.struct(F.lit(1).alias("part"), F.lit("## ⭐ Top Picks\n\n").alias("body"))),
        F.when(F.col("_all") > F.col("_picks"), F.struct(F.lit(3).alias("part"), F.lit("## 📋 All Events\n\n").alias("body"))),
    ))
    said = said.select("name", F.explode(fixed).alias("x")).select("name", "x.part", F.lit(None).cast("string").alias("naive"), none, "x.body")
    return pieces.unionByName(heads).unionByName(said)
