"""Queries of what a site publishes: the week grid, the files for machines, the sitemap, cleaned events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import model
from marquee.operators import clean, layout, publish
from marquee.plans.exports import SITE, ZONE
from marquee.plans.queries import _SHOWN, A, B, registered
from marquee.plans.tables import SQL_LISTING, TODAY, listing, read, sql_implied
from marquee.sinks import digests

SPLIT = 16_000
_SIX = f"'{A}'::DATE"


@registered(
    f""", s AS (SELECT city_key, ord, d AS day, CAST(datetime_iso[12:13] AS INT) * 60 + CAST(datetime_iso[15:16] AS INT) AS minutes FROM v WHERE length(datetime_iso) > 10 AND NOT coalesce(nullif(datetime_end_iso, '') > d, false) AND d BETWEEN '{A}' AND '{B}'),
h AS (SELECT city_key, least(8, min(minutes // 60)) AS first_hour, least(24, greatest(23, max(minutes // 60) + 1)) AS last_hour FROM s GROUP BY 1)
SELECT *, round((minutes - first_hour * 60) / ((last_hour - first_hour) * 60.0)::DOUBLE * 100, 6) AS percent FROM s JOIN h USING (city_key)"""
)
def week_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The week's timed listings on the grid of their city."""
    return layout.timed_slots(listing(spark, sf_dir), A).withColumn("percent", F.round("percent", 6))


@registered(
    f""", r AS (SELECT city_key, ord, date_diff('day', {_SIX}, greatest(d, '{A}')::DATE) AS a, date_diff('day', {_SIX}, least(e, '{B}')::DATE) AS z FROM v
  WHERE d <= '{B}' AND e >= '{A}' AND NOT (length(datetime_iso) > 10 AND NOT coalesce(nullif(datetime_end_iso, '') > d, false))),
b AS (SELECT city_key, ord, a, greatest(a, z) AS z, row_number() OVER (PARTITION BY city_key ORDER BY a, greatest(a, z), ord) AS k FROM r),
f AS (SELECT DISTINCT city_key, 0::BIGINT AS k, NULL::BIGINT AS ord, NULL::BIGINT AS a, NULL::BIGINT AS z, 0::BIGINT AS lane, []::BIGINT[] AS ends FROM b
  UNION ALL SELECT city_key, k, ord, a, z, lane, list_concat(list_concat(ends[1:lane - 1], [z]), ends[lane + 1:]) FROM (
    SELECT b.*, f.ends, coalesce(list_position(list_transform(f.ends, lambda x: x < b.a), true), len(f.ends) + 1) AS lane FROM f JOIN b ON b.city_key = f.city_key AND b.k = f.k + 1))
SELECT city_key, ord, a + 2 AS start_col, z + 3 AS end_col, lane FROM f WHERE k > 0""",
    f"RECURSIVE {SQL_LISTING}",
)
def week_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listings that cover days of the week, each in the first row that is free."""
    bars = layout.day_bars(listing(spark, sf_dir), A)
    return bars.select("city_key", "ord", *(F.col(c).cast("long").alias(c) for c in ("start_col", "end_col", "lane")))


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.col("item")
    cost = F.when(item % 4 == 0, "Free entry").when(item % 4 == 1, F.concat(F.lit("$"), (item % 90 + 5).cast("string"))).otherwise("See link")
    about = F.concat(F.lit('**"'), F.col("title"), F.lit('"** at '), F.col("location"), F.lit(", with "), F.array_join("tags", " \\ "), F.lit(" , and <i>more</i>"))
    return listing(spark, sf_dir).withColumn("cost", cost).withColumn("description", F.when(item % 4 > 0, about))


def _cities(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The regions as cities, one of which is a day ahead of the others and one has a week that is over."""
    region = read(spark, sf_dir, "region")
    key, over = F.lower("r_name").alias("city_key"), F.col("r_regionkey") == 3
    cities = region.select(
        key, F.initcap("r_name").alias("city"), F.replace(F.lower("r_name"), F.lit(" "), F.lit("-")).alias("slug"), F.when(over, "1998-02-23").otherwise(A).alias("week_start"),
        F.when(over, "1998-03-01").otherwise(B).alias("week_end"), F.when(F.col("r_regionkey") != 1, "1998-03-01").alias("generated_at"),
    )
    return cities, region.select(key, F.when(F.col("r_regionkey") == 0, "1998-03-05").otherwise(TODAY).alias("today"))


def _json(x: str) -> str:
    return f"to_json({x})::VARCHAR"


_TEXT = f"""c AS (SELECT lower(r_name) AS city_key, list_aggregate(list_transform(string_split(lower(r_name), ' '), lambda x: upper(x[1]) || x[2:]), 'string_agg', ' ') AS city, replace(lower(r_name), ' ', '-') AS slug,
  CASE WHEN r_regionkey = 3 THEN '1998-02-23' ELSE '{A}' END AS week_start, CASE WHEN r_regionkey = 3 THEN '1998-03-01' ELSE '{B}' END AS week_end,
  CASE WHEN r_regionkey = 0 THEN '1998-03-05' ELSE '{TODAY}' END AS today, CASE WHEN r_regionkey = 1 THEN '{TODAY}' ELSE '1998-03-01' END AS made FROM region),
e AS (SELECT *, lower(to_base(list_reduce(list_prepend(0::BIGINT, list_transform(range(1, length(b) + 1), lambda i: ord(substr(b, i, 1))::BIGINT)), lambda h, u: (h * 31 + u) & 4294967295), 36)) AS id,
  CASE WHEN item % 4 > 0 THEN concat('"', title, '" at ', location, ', with ', array_to_string(tags, ' \\ '), ', and more') ELSE '' END AS about
  FROM (SELECT *, city_key || '|' || title || '|' || datetime_iso || '|' || location AS b FROM v)),
p AS (SELECT *, '/' || slug || '/e/' || replace(rtrim(trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g'))[1:60]), ' ', '-') || '-' || id || '/' AS page FROM e JOIN c USING (city_key)),
t AS (SELECT city_key, slug, ord, datetime_iso AS naive, category, d, e, week_start, week_end, greatest(week_start, today) AS lo, concat('    {{', chr(10), '      "id": ', {_json('id')}, ',', chr(10), '      "title": ', {_json('title')}, ',', chr(10),
  '      "start": ', {_json("CASE WHEN length(datetime_iso) = 10 THEN datetime_iso || 'T00:00:00' ELSE datetime_iso END || '+10:00'")}, ',', chr(10),
  '      "end": ', CASE WHEN datetime_end_iso = '' THEN 'null' ELSE {_json("datetime_end_iso || 'T00:00:00+10:00'")} END, ',', chr(10), '      "location": ', {_json('location')}, ',', chr(10), '      "category": ', {_json('category')}, ',', chr(10),
  '      "price": ', CASE item % 4 WHEN 0 THEN '0' WHEN 1 THEN (item % 90 + 5)::VARCHAR ELSE 'null' END, ',', chr(10), '      "free": ', (item % 4 = 0)::VARCHAR, ',', chr(10),
  '      "description": ', {_json("CASE WHEN length(about) <= 200 THEN about ELSE trim(CASE WHEN 200 - instr(reverse(about[1:200]), ' ') > 120 THEN about[1:200 - instr(reverse(about[1:200]), ' ')] ELSE about[1:200] END) || '…' END")}, ',', chr(10),
  '      "url": ', {_json(f"'{SITE}' || page")}, chr(10), '    }}') AS body FROM p WHERE (score IS NULL OR score >= 4) AND d <= week_end AND e >= week_start AND week_end >= today),
x AS (SELECT city_key, 'day' AS kind, strftime(g, '%Y-%m-%d') AS key, slug || '/' || strftime(g, '%Y-%m-%d') AS name, naive, ord, body FROM (SELECT *, unnest(generate_series(greatest(d, lo)::DATE, least(e, week_end)::DATE, INTERVAL 1 DAY)) AS g FROM t WHERE e >= lo)
  UNION ALL SELECT city_key, 'week', week_start, slug || '/week-' || week_start, naive, ord, body FROM t
  UNION ALL SELECT city_key, 'category', category, slug || '/week-' || week_start || '/' || {" ".join(f"CASE WHEN category = '{k}' THEN '{v}' ELSE" for k, v in model.CATEGORY_SLUGS.items())} 'community' {"END " * len(model.CATEGORY_SLUGS)}, naive, ord, body FROM t),
hs AS (SELECT *, concat('{{', chr(10), '  "data_as_of": "', made, '",', chr(10), '  "city": "', city, '",', chr(10), '  "city_key": "', city_key, '",', chr(10), '  "timezone": "{ZONE}",', chr(10)) AS top,
  concat('  "week_start": "', week_start, '",', chr(10), '  "week_end": "', week_end, '",', chr(10), '  "events": [') AS span FROM c WHERE week_end >= today),
h AS (SELECT city_key, 'week' AS kind, week_start AS key, slug || '/week-' || week_start AS name, top || span AS head FROM hs
  UNION ALL SELECT city_key, 'day', strftime(g, '%Y-%m-%d'), slug || '/' || strftime(g, '%Y-%m-%d'), concat(top, '  "date": "', strftime(g, '%Y-%m-%d'), '",', chr(10), '  "events": [') FROM (SELECT *, unnest(generate_series(greatest(week_start, today)::DATE, week_end::DATE, INTERVAL 1 DAY)) AS g FROM hs)
  UNION ALL SELECT DISTINCT city_key, 'category', x.key, x.name, top || span FROM hs JOIN x USING (city_key) WHERE kind = 'category'),
q AS (SELECT city_key, kind, key, name, 0 AS part, NULL AS naive, NULL AS ord, head AS body FROM h
  UNION ALL SELECT city_key, kind, key, name, 1, naive, ord, CASE WHEN row_number() OVER (PARTITION BY name ORDER BY naive, ord) = 1 THEN chr(10) ELSE ',' || chr(10) END || body FROM x
  UNION ALL SELECT city_key, kind, key, name, 2, NULL, NULL, CASE WHEN name IN (SELECT name FROM x) THEN chr(10) || '  ]' ELSE ']' END || chr(10) || '}}' FROM h),
n AS (SELECT city_key, kind, key, name, count(*) FILTER (part = 1) AS n_events, sum(strlen(body))::BIGINT AS n_bytes FROM q GROUP BY ALL),
k AS (SELECT * FROM n WHERE kind <> 'category' OR city_key IN (SELECT city_key FROM n WHERE kind = 'week' AND n_bytes > {SPLIT}))"""


def _feed(spark: SparkSession, sf_dir: str) -> tuple:
    return _priced(spark, sf_dir), *_cities(spark, sf_dir), ZONE, SITE, SPLIT


@registered(f", {_TEXT} SELECT name, part, ord, sha256(body) AS digest FROM q WHERE name IN (SELECT name FROM k)")
def feed_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of the week's files for machines."""
    return publish.feed_pieces(*_feed(spark, sf_dir)).select("name", "part", "ord", F.sha2("body", 256).alias("digest"))


@registered(f", {_TEXT} SELECT * FROM k")
def feed_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and bytes of each of these files; a week of too many bytes is split by category too."""
    return publish.feed_sizes(*_feed(spark, sf_dir))


@registered(
    f""", {_TEXT} SELECT city_key, city, slug, made AS data_as_of, coalesce(string_agg('/ai/' || name || '.json', ' ' ORDER BY name) FILTER (kind = 'day'), '') AS days, max('/ai/' || name || '.json') FILTER (kind = 'week') AS week,
coalesce(string_agg('/ai/' || name || '.json', ' ' ORDER BY list_position({list(model.CATEGORIES)}, key)) FILTER (kind = 'category'), '') AS categories FROM c LEFT JOIN k USING (city_key) GROUP BY 1, 2, 3, 4"""
)
def feed_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the index lists for each city."""
    feed = _feed(spark, sf_dir)
    rows = publish.city_entries(publish.feed_sizes(*feed), *feed[1:3])
    return rows.select("city_key", "city", "slug", "data_as_of", F.array_join("days", " ").alias("days"), "week", F.array_join("week_categories.file", " ").alias("categories"))


@registered(
    f""", {_TEXT}, y AS (SELECT '{SITE}/' || slug || '/' AS base, made FROM c)
SELECT '{SITE}/' AS loc, (SELECT max(today) FROM c) AS lastmod, 'weekly' AS changefreq, '1.0' AS priority UNION ALL SELECT base, made, 'weekly', '0.9' FROM y
UNION ALL SELECT base || unnest({list(model.CATEGORY_SLUGS.values())}) || '/', made, 'weekly', '0.7' FROM y UNION ALL SELECT base || unnest({list(model.TIMEFRAMES)}) || '/', (SELECT max(today) FROM c), 'daily', '0.8' FROM y
UNION ALL SELECT '{SITE}' || page, made, 'weekly', '0.5' FROM p"""
)
def sitemap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The address of every page of the site."""
    cities, today = _cities(spark, sf_dir)
    return publish.sitemap(listing(spark, sf_dir), cities, today, SITE)


_STEPS, _STEPPED = sql_implied("g", "tags")
_VACUOUS = list(model.VACUOUS_TAGS)


@registered(
    f""", sh AS ({_SHOWN}),
m AS (SELECT ord, title || ' & more' AS title, location, city_key, CASE WHEN item % 3 = 0 THEN '' ELSE 'It''s at "' || location || '" \\ now' END AS description,
  CASE item % 4 WHEN 0 THEN 'free entry' WHEN 1 THEN 'AUD 25' WHEN 2 THEN 'AUD $12.50 or Fab 5' ELSE '' END AS cost,
  CASE item % 4 WHEN 0 THEN 'https://x.example/?a=1&b=' || item WHEN 1 THEN '' WHEN 2 THEN 'https://www.trumba.com/calendars/brisbane-city-council?eventid=' || item ELSE '' END AS link,
  CASE item % 3 WHEN 0 THEN 'https://x.example/p' || item || '.jpg?w=1&h=2' ELSE '' END AS image,
  list_concat(tags, [CASE WHEN item % 3 = 0 THEN 'markets' ELSE 'market' END, 'food & wine', CASE WHEN item % 7 = 0 THEN 'gigs' ELSE 'gig' END, CASE WHEN item % 5 = 0 THEN 'brewery' ELSE 'free' END, 'workshop', 'supplier', '']) AS tags FROM v),
n AS (SELECT t, count(*) AS n FROM (SELECT unnest(tags) AS t FROM m) WHERE t <> '' GROUP BY 1),
y AS (SELECT p.t AS plural, s.t AS single, CASE WHEN s.n >= p.n THEN s.t ELSE p.t END AS win FROM n p JOIN n s ON p.t = s.t || 's'),
z AS (SELECT map_from_entries(list(ROW(plural, win)) || list(ROW(single, win))) AS spell FROM y),
g0 AS (SELECT m.* REPLACE (list_transform(tags, lambda t: coalesce(spell[t], t)) AS tags) FROM m CROSS JOIN z),
g AS (SELECT * REPLACE (list_filter(tags, lambda t, k: list_position(tags, t) = k AND t <> '' AND NOT list_contains({_VACUOUS}, t) AND (contains(t, ' ') OR NOT list_contains(list_filter(string_split_regex(lower('Old Town ' || location), '[^a-z0-9]+'), lambda w: length(w) >= 4), t))) AS tags) FROM g0),
{_STEPS}
SELECT q.ord, title, location, description, cost, link, image, coalesce(nullif(sh.shown, ''), 'some evening') AS datetime,
  array_to_string(list_concat(list_filter(tags, lambda t: t <> 'free'), CASE WHEN cost = 'free entry' THEN ['free'] ELSE [] END), '|') AS tags FROM {_STEPPED} q JOIN sh ON sh.ord = q.ord"""
)
def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All listings with markup, entities, foreign currencies and tags of many spellings put in, cleaned."""
    item, text = F.col("item"), lambda *xs: F.concat(*(F.lit(x) if isinstance(x, str) else x for x in xs))
    number = item.cast("string")
    more = [F.when(item % 3 == 0, "Markets ").otherwise("market"), F.lit("Food &amp;amp; <i>Wine</i>"), F.when(item % 7 == 0, "gigs").otherwise("gig"), F.when(item % 5 == 0, "Brewery").otherwise("free"), F.lit("Workshop"), F.lit("Supplier"), F.lit(None).cast("string")]
    rows = listing(spark, sf_dir).withColumns({
        "title": text("<b>", F.col("title"), "</b>&amp;amp; more\n"),
        "description": F.when(item % 3 != 0, text("It\\'s at &quot;", F.col("location"), '\\" \\\\ <br/>\\nnow')),
        "cost": F.when(item % 4 == 0, "free entry").when(item % 4 == 1, "USD 25").when(item % 4 == 2, "eur $12.50 or Fab 5"),
        "link": F.when(item % 4 == 0, text(" https://x.example/?a=1&amp;b=", number)).when(item % 4 == 1, "javascript:alert(1)").when(item % 4 == 2, text("https://www.brisbane.qld.gov.au/trumba?trumbaEmbed=view%3Devent%26eventid%3D", number)),
        "image": F.when(item % 3 == 0, text("https://x.example/p", number, ".jpg?w=1&amp;h=2")).when(item % 3 == 1, "http://x.example/p.png").otherwise("https://x.example/p"),
        "datetime": F.lit("some evening"), "tags": F.concat("tags", F.array(*more)),
    })
    out = clean.published(rows, "Old Town")
    return out.select("ord", "title", "location", "description", "cost", "link", "image", "datetime", F.array_join("tags", "|").alias("tags"))


_BUILT = "Wed, 04 Mar 1998 00:00:00 GMT"
#: The week's events as feeds say them; titles, places and tags have no character that XML escapes but those put in here.
_DIGEST = f"""c AS (SELECT lower(r_name) AS city_key, upper(r_name) AS city, replace(lower(r_name), ' ', '-') AS slug, '{A}' AS week_start, '{B}' AS week_end FROM region),
e AS (SELECT *, lower(to_base(list_reduce(list_prepend(0::BIGINT, list_transform(range(1, length(b) + 1), lambda i: ord(substr(b, i, 1))::BIGINT)), lambda h, u: (h * 31 + u) & 4294967295), 36)) AS id,
  CASE WHEN item % 5 = 0 THEN 'about <' || title || '>' ELSE '' END AS about, CASE item % 4 WHEN 0 THEN 'FREE' WHEN 1 THEN '$' || (item % 90 + 5) END AS cost, CASE WHEN item % 3 = 0 THEN 'https://x.example/?a=1&b=' || item ELSE '' END AS link,
  coalesce(score >= 7 AND coalesce(nullif(datetime_end_iso, ''), d) <= '{B}', false) AS pick, CASE WHEN item % 7 <> 0 THEN 'on ' || datetime_iso END AS shown
  FROM (SELECT *, city_key || '|' || title || '|' || datetime_iso || '|' || location AS b FROM v WHERE d BETWEEN '{A}' AND '{B}'))"""


def _told(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    item, number = F.col("item"), F.col("item").cast("string")
    week = listing(spark, sf_dir).filter(F.substring("datetime_iso", 1, 10).between(A, B))
    events = week.withColumns({
        "description": F.when(item % 5 == 0, F.concat(F.lit("about <"), "title", F.lit(">"))), "cost": F.when(item % 4 == 0, "FREE").when(item % 4 == 1, F.concat(F.lit("$"), (item % 90 + 5).cast("string"))),
        "link": F.when(item % 3 == 0, F.concat(F.lit("https://x.example/?a=1&b="), number)), "datetime": F.when(item % 7 != 0, F.concat(F.lit("on "), "datetime_iso")),
    })
    return events, read(spark, sf_dir, "region").select(F.lower("r_name").alias("city_key"), F.col("r_name").alias("city"), F.replace(F.lower("r_name"), F.lit(" "), F.lit("-")).alias("slug"), F.lit(A).alias("week_start"), F.lit(B).alias("week_end"))


@registered(
    f""", {_DIGEST}, p AS (SELECT *, '{SITE}/' || slug AS home FROM e JOIN c USING (city_key)),
i AS (SELECT slug || '/feed' AS name, 1 AS part, ord, concat(chr(10), '    <item>', chr(10), '      <title>', title, '</title>', chr(10), '      <link>', CASE WHEN link <> '' THEN replace(link, '&', '&amp;') ELSE home || '/e/' || replace(rtrim(trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g'))[1:60]), ' ', '-') || '-' || id || '/' END, '</link>', chr(10),
  '      <guid isPermaLink="false">', home, '#', id, '</guid>', chr(10), '      <pubDate>', strftime(datetime_iso::TIMESTAMP - INTERVAL 10 HOUR, '%a, %d %b %Y %H:%M:%S GMT'), '</pubDate>', chr(10), '      <category>', category, '</category>', chr(10),
  '      <description>', concat_ws(' · ', shown, location, cost), CASE WHEN about <> '' THEN chr(10) || chr(10) || replace(replace(about, '<', '&lt;'), '>', '&gt;') ELSE '' END, '</description>', chr(10), '    </item>') AS body FROM p WHERE score IS NULL OR score >= 4),
h AS (SELECT slug || '/feed' AS name, 0 AS part, NULL AS ord, concat('<?xml version="1.0" encoding="UTF-8"?>', chr(10), '<rss version="2.0" xmlns:atom="http://www.w3.org/2005/Atom">', chr(10), '  <channel>', chr(10), '    <title>', city, ' — this week''s events</title>', chr(10), '    <link>{SITE}/', slug, '/</link>', chr(10),
  '    <atom:link href="{SITE}/', slug, '/feed.xml" rel="self" type="application/rss+xml"/>', chr(10), '    <description>Events in ', city, ' for the week of {A} to {B}, ranked by fit.</description>', chr(10), '    <language>en-AU</language>', chr(10), '    <lastBuildDate>{_BUILT}</lastBuildDate>') AS body FROM c
  UNION ALL SELECT slug || '/feed', 2, NULL, concat(chr(10), '  </channel>', chr(10), '</rss>', chr(10)) FROM c)
SELECT name, part, ord, sha256(body) AS digest FROM (FROM i UNION ALL FROM h)"""
)
def rss_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every city's RSS feed of the week."""
    events, cities = _told(spark, sf_dir)
    return digests.rss_pieces(events, cities, ZONE, SITE, _BUILT).select("name", "part", "ord", F.sha2("body", 256).alias("digest"))


_SIGNS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in model.CATEGORY_EMOJI.items())


@registered(
    f""", {_DIGEST}, g AS (SELECT *, upper(slug) AS name, CASE category {_SIGNS} END AS sign, min(ord) FILTER (NOT pick) OVER (PARTITION BY city_key, category) AS first FROM e JOIN c USING (city_key)),
i AS (SELECT name, CASE WHEN pick THEN 2 ELSE 4 END AS part, CASE WHEN NOT pick THEN lpad(first::VARCHAR, 20, '0') END AS naive, ord, concat(CASE WHEN pick THEN '### ' || sign || ' ' ELSE '#### ' END, CASE WHEN link <> '' THEN '[' || title || '](' || link || ')' ELSE title END, chr(10), '📆 ', coalesce(shown, '—'), CASE WHEN pick THEN '  ' END, chr(10),
  '📍 ', location, CASE WHEN pick THEN '  ' END, chr(10), '💰 ', CASE WHEN cost IS NULL THEN 'See link' WHEN cost = 'FREE' THEN 'Free' ELSE cost END, CASE WHEN pick THEN '  ' END, chr(10), '`', array_to_string(tags[1:6], '` `'), '`', chr(10), CASE WHEN about <> '' THEN chr(10) || about || chr(10) END, chr(10)) AS body FROM g),
n AS (SELECT city_key, count(*) AS n, count(*) FILTER (pick) AS p FROM e GROUP BY 1), m AS (SELECT upper(slug) AS name, city, coalesce(n, 0) AS n, coalesce(p, 0) AS p FROM c LEFT JOIN n USING (city_key)),
h AS (SELECT DISTINCT name, 4 AS part, lpad(first::VARCHAR, 20, '0') AS naive, NULL::BIGINT AS ord, concat('### ', sign, ' ', category, chr(10), chr(10)) AS body FROM g WHERE NOT pick
  UNION ALL SELECT name, 0, NULL, NULL, concat('# ', city, ' — This Week''s Events', chr(10), '**2 March 1998 – 8 March 1998**  ', chr(10), '*', p, ' top picks · ', n, ' events total*', chr(10), chr(10)) FROM m
  UNION ALL SELECT name, 1, NULL, NULL, '## ⭐ Top Picks' || chr(10) || chr(10) FROM m WHERE p > 0 UNION ALL SELECT name, 3, NULL, NULL, '## 📋 All Events' || chr(10) || chr(10) FROM m WHERE n > p)
SELECT name, part, naive, ord, sha256(body) AS digest FROM (FROM i UNION ALL FROM h)"""
)
def digest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every city's Markdown digest of the week: picks, then the others by category."""
    return digests.digest_pieces(*_told(spark, sf_dir)).select("name", "part", "naive", "ord", F.sha2("body", 256).alias("digest"))
