"""The queries of the listing engine on the driver's tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee import model
from marquee.functions import listing as L
from marquee.operators import corpus, dedupe, query
from marquee.plans.tables import SQL_INTERACTIONS, SQL_LISTING, TODAY, WEEK, interactions, listing, read, sql_implied, week_listing

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
A, B = WEEK
NEXT = "1998-03-15"


def registered(sql: str | None = None, base: str = SQL_LISTING):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = f"WITH {base} {sql}" if base and not sql.lstrip().startswith(",") else f"WITH {base}{sql}" if base else sql
        return f

    return add


@registered(f"SELECT ord, title, datetime_iso FROM v WHERE d <= '{B}' AND e >= '{A}'")
def overlap_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing(spark, sf_dir).filter(L.overlaps(F.col("datetime_iso"), F.col("datetime_end_iso"), A, B)).select("ord", "title", "datetime_iso")


@registered(f"SELECT ord, coalesce(e < '{TODAY}', false) AS past FROM v")
def past_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing(spark, sf_dir).select("ord", L.is_past(F.col("datetime_iso"), F.col("datetime_end_iso"), TODAY).alias("past"))


@registered(f"SELECT CASE WHEN d IS NULL THEN 'no-date' WHEN e < '{A}' THEN 'past' WHEN d > '{B}' THEN 'later' ELSE 'kept' END AS reason, count(*) AS n FROM v GROUP BY 1")
def window_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = F.col("datetime_iso"), F.col("datetime_end_iso")
    reason = F.when(L.day(start).isNull(), "no-date").when(L.last_day_of(start, end) < A, "past").when(L.day(start) > B, "later").otherwise("kept")
    return listing(spark, sf_dir).groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@registered(
    f"""SELECT ord, title, coalesce(score < 4, false) AS low FROM v WHERE category = 'Concert / Music' AND d <= '1998-03-31' AND e >= '1998-03-01'
AND list_contains(tags, 'small') AND item % 13 <> 0 AND social AND datetime_iso[12:13] <> '' AND (CAST(datetime_iso[12:13] AS INT) BETWEEN 5 AND 11 OR CAST(datetime_iso[12:13] AS INT) >= 17 OR CAST(datetime_iso[12:13] AS INT) < 5)
AND NOT coalesce(e < '{TODAY}', false)"""
)
def filter_bar(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = query.FilterState(category="Concert / Music", first="1998-03-01", last="1998-03-31", tags=("small",), vibes=("social",), bands=("morning", "evening"), today=TODAY)
    rows = listing(spark, sf_dir)
    return query.apply_filters(rows, state, rows.filter("item % 13 = 0").select("ord"), "ord").select("ord", "title", "low")


PICKABLE = f"sc >= 7 AND d BETWEEN '{A}' AND '{B}' AND (nullif(datetime_end_iso, '') IS NULL OR datetime_end_iso <= '{B}')"


@registered(f"SELECT * FROM (SELECT city_key, ord, title, score, row_number() OVER (PARTITION BY city_key ORDER BY sc DESC, sd, ord) AS pick_rank FROM v WHERE {PICKABLE}) WHERE pick_rank <= 9")
def top_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.top_picks(listing(spark, sf_dir), A, B, model.MAX_PICKS, "city_key").select("city_key", "ord", "title", "score", "pick_rank")


@registered(
    f""", w AS (SELECT * FROM v WHERE d BETWEEN '{A}' AND '{B}'), s AS (SELECT DISTINCT event_key FROM w WHERE item % 13 = 0),
o AS (SELECT * FROM w WHERE event_key NOT IN (SELECT event_key FROM s)),
p AS (SELECT ord, event_key FROM (SELECT *, row_number() OVER (PARTITION BY city_key ORDER BY sc DESC, sd, ord) AS k FROM o WHERE {PICKABLE}) WHERE k <= 9)
SELECT ord, 'saved' AS section FROM w WHERE event_key IN (SELECT event_key FROM s) UNION ALL SELECT ord, 'picks' FROM p
UNION ALL SELECT ord, 'rest' FROM o WHERE ord NOT IN (SELECT ord FROM p) AND event_key NOT IN (SELECT event_key FROM p)"""
)
def sections_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    week = week_listing(spark, sf_dir)
    return query.split_sections(week, week.filter("item % 13 = 0"), A, B, "event_key", "city_key").select("ord", "section")


@registered("SELECT * FROM (SELECT city_key, ord, row_number() OVER (PARTITION BY city_key ORDER BY sc DESC, sd, ord) AS place FROM v) WHERE place <= 100")
def score_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("city_key").orderBy(*L.canonical_order(F.col("score"), F.col("datetime_iso"), F.col("ord")))
    return listing(spark, sf_dir).select("city_key", "ord", F.row_number().over(w).alias("place")).filter("place <= 100")


@registered(
    f"""SELECT city_key, ord, place, total_matched, total_matched > 50 AS more_available FROM (SELECT city_key, ord,
row_number() OVER (PARTITION BY city_key ORDER BY coalesce(d BETWEEN '{A}' AND '{B}', false) DESC, datetime_iso, ord) AS place, count(*) OVER (PARTITION BY city_key) AS total_matched FROM v) WHERE place <= 50"""
)
def window_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.window_order(listing(spark, sf_dir), A, B, 50, "city_key").select("city_key", "ord", "place", "total_matched", "more_available")


@registered(
    f"""SELECT city_key, ord, bucket, bucket_place, row_number() OVER (PARTITION BY city_key, bucket ORDER BY CASE WHEN bucket_place = 0 THEN '' WHEN bucket_place = 1 THEN se ELSE sd END, sc DESC, CASE WHEN bucket_place = 0 THEN sd END, ord) AS place
FROM (SELECT *, CASE WHEN d IS NULL THEN 'undated' WHEN d < '{TODAY}' THEN 'ongoing' WHEN d > '{NEXT}' THEN 'later' ELSE d END AS bucket, CASE WHEN d IS NULL THEN 3 WHEN d < '{TODAY}' THEN 1 WHEN d > '{NEXT}' THEN 2 ELSE 0 END AS bucket_place FROM v)"""
)
def group_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.date_groups(listing(spark, sf_dir), TODAY, NEXT, "city_key").select("city_key", "ord", "bucket", "bucket_place", "place")


@registered("SELECT ord, category AS grp, row_number() OVER (PARTITION BY city_key, category ORDER BY sd, sc DESC, ord) AS place FROM v")
def group_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.category_groups(listing(spark, sf_dir), "city_key").select("ord", "grp", "place")


@registered(f"SELECT ord, strftime(unnest(generate_series(CAST(greatest(d, '{A}') AS DATE), CAST(least(e, '{B}') AS DATE), INTERVAL 1 DAY)), '%Y-%m-%d') AS day FROM v WHERE d <= '{B}' AND e >= '{A}'")
def day_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.expand_days(listing(spark, sf_dir), A, B).select("ord", F.date_format("day", "yyyy-MM-dd").alias("day"))


@registered(
    """SELECT 'category' AS facet, category AS value, count(*) AS n, min(ord) AS first FROM v GROUP BY category
UNION ALL SELECT 'venue', venue_name, count(*), min(ord) FROM v GROUP BY venue_name
UNION ALL SELECT 'tag', t, count(*), min(ord) FROM (SELECT ord, unnest(tags) AS t FROM v) WHERE t NOT IN ('stimulating', 'creative', 'hands on', 'social') GROUP BY t"""
)
def facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.facets(listing(spark, sf_dir))


@registered(
    """SELECT 'tag' AS kind, t AS name, count(*) AS n FROM (SELECT unnest(tags) AS t FROM v WHERE score >= 4) GROUP BY t
UNION ALL SELECT 'vibe', 'social', count(*) FROM v WHERE score >= 4 AND social UNION ALL SELECT 'vibe', 'creative', count(*) FROM v WHERE score >= 4 AND creative
UNION ALL SELECT 'vibe', 'intellectual', count(*) FROM v WHERE score >= 4 AND intellectual UNION ALL SELECT 'vibe', 'hands_on', count(*) FROM v WHERE score >= 4 AND hands_on"""
)
def live_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.live_counts(listing(spark, sf_dir).filter("score >= 4"))


@registered(f"SELECT city_key, least(max(e), strftime(last_day(DATE '{B}'), '%Y-%m-%d')) AS date_max FROM v GROUP BY city_key")
def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.date_bounds(listing(spark, sf_dir), B, "city_key")


@registered(f"SELECT city_key, greatest(least(min(d), '{A}'), '1998-03-02') AS week_start, greatest(max(d), '{B}') AS week_end FROM v GROUP BY city_key")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.coverage(listing(spark, sf_dir), A, B, TODAY, "city_key")


@registered(f"SELECT city_key, count(*) AS event_count, count(*) FILTER ({PICKABLE}) AS top_pick_count FROM v GROUP BY city_key")
def city_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = L.top_pick(F.col("score"), F.col("datetime_iso"), F.col("datetime_end_iso"), A, B)
    return listing(spark, sf_dir).groupBy("city_key").agg(F.count(F.lit(1)).alias("event_count"), F.count_if(pick).alias("top_pick_count"))


@registered("SELECT t AS tag, count(*) AS df, round(least(1, greatest(0.1, ln((SELECT count(*) FROM v) / count(*)) / ln((SELECT count(*) FROM v)))), 9) AS weight FROM (SELECT unnest(tags) AS t FROM v) GROUP BY t")
def tag_specificity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.tag_weights(listing(spark, sf_dir)).withColumn("weight", F.round("weight", 9))


DOC_TAGS = "d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda x: x <> '') AS tags FROM documents)"


def doc_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda x: x != "").alias("tags"))


@registered(
    """, c AS (SELECT t AS tag, count(*) AS n FROM (SELECT unnest(tags) AS t FROM d) GROUP BY t),
p AS (SELECT s.tag, c.tag AS plural, CASE WHEN s.n >= c.n THEN s.tag ELSE c.tag END AS canonical FROM c JOIN c s ON c.tag = s.tag || 's')
SELECT DISTINCT tag, canonical FROM (SELECT tag, canonical FROM p UNION ALL SELECT plural, canonical FROM p)""",
    DOC_TAGS,
)
def tag_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.tag_variants(doc_tags(spark, sf_dir))


@registered(
    "SELECT ord, array_to_string(list_filter(tags, lambda t: NOT list_contains(["
    + ", ".join(f"'{t}'" for t in model.VACUOUS_TAGS)
    + "], t) AND NOT list_contains(list_filter(string_split_regex(lower(city_key || ' ' || location || ' ' || title[1:5]), '[^a-z0-9]+'), lambda w: length(w) >= 4), t)), ' ') AS tags FROM v"
)
def useless_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.concat_ws(" ", "location", F.substring("title", 1, 5))
    return listing(spark, sf_dir).select("ord", F.array_join(L.strip_useless(F.col("tags"), F.col("city_key"), place), " ").alias("tags"))


_SUBJECTS = ("orchestra", "hiking", "brewery", "improv", "trivia", "yoga", "cinema", "rainforest", "arcade", "student")
_IMPLIED, _ALL_IMPLIED = sql_implied("i", "tags")


@registered(f", i AS (SELECT ord, [{list(_SUBJECTS)}[item % 10 + 1]] AS tags FROM v), {_IMPLIED} SELECT ord, array_to_string(tags, ',') AS tags FROM {_ALL_IMPLIED}")
def implied_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    subjects = F.array(*map(F.lit, _SUBJECTS))
    tag = F.element_at(subjects, (F.col("item") % 10).cast("int") + 1)
    return corpus.imply_tags(listing(spark, sf_dir).select("ord", F.array(tag).alias("tags"))).select("ord", F.array_join("tags", ",").alias("tags"))


@registered(
    """SELECT ord, title FROM (SELECT ord, title, trim(regexp_replace(lower(title || ' ' || location || ' ' || category || ' ' || array_to_string(tags, ' ')), '[^a-z0-9]+', ' ', 'g')) AS h FROM v)
WHERE (contains(h, 'smlal') OR len(list_filter(string_split(h, ' '), lambda w: abs(length(w) - 5) <= 1 AND damerau_levenshtein(w, 'smlal') <= 1)) > 0)
AND (contains(h, 'concrt') OR len(list_filter(string_split(h, ' '), lambda w: abs(length(w) - 6) <= 1 AND damerau_levenshtein(w, 'concrt') <= 1)) > 0)"""
)
def search_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query.apply_filters(listing(spark, sf_dir), query.FilterState(query="smlal concrt", past="all")).select("ord", "title")


PAIR_SQL = """, w AS (SELECT city_key, d, trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')) AS t, min(ord) AS ord FROM v WHERE d BETWEEN '{A}' AND '{B}' GROUP BY 1, 2, 3),
p AS (SELECT x.city_key, least(x.ord, y.ord) AS a, greatest(x.ord, y.ord) AS b, x.d = y.d AS same_day, x.t AS t1, y.t AS t2 FROM w x JOIN w y ON x.city_key = y.city_key
  AND (y.d = x.d AND x.ord < y.ord OR CAST(y.d AS DATE) = CAST(x.d AS DATE) + 1))""".replace("{A}", A).replace("{B}", B)


@registered(PAIR_SQL + " SELECT a, b, same_day, (t1 = t2 OR length(t1) >= 6 AND length(t2) >= 6 AND (starts_with(t1, t2) OR starts_with(t2, t1)) AND same_day) AS prefix_match FROM p")
def dedupe_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    week = week_listing(spark, sf_dir)
    pairs = dedupe.block_pairs(week, "city_key")
    names = week.select(F.col("ord"), L.normal_text(F.col("title")).alias("t"))
    both = pairs.join(names.select(F.col("ord").alias("a"), F.col("t").alias("t1")), "a").join(names.select(F.col("ord").alias("b"), F.col("t").alias("t2")), "b")
    start = (F.length("t1") >= 6) & (F.length("t2") >= 6) & (F.startswith("t1", F.col("t2")) | F.startswith("t2", F.col("t1"))) & F.col("same_day")
    return both.select("a", "b", "same_day", ((F.col("t1") == F.col("t2")) | start).alias("prefix_match"))


@registered()
def dedupe_survivor(spark: SparkSession, sf_dir: str) -> DataFrame:
    week = dedupe._kept(week_listing(spark, sf_dir).select("ord", "city_key", "title", "datetime_iso", "location", "tags"))
    place = F.col("location")
    links = dedupe.settled_links(week, "city_key", place=place).union(dedupe.same_title_links(week, "city_key", place=place))
    comps = dedupe.components(week.select("ord"), links)
    none = F.lit("")
    scored = week.withColumn("completeness", L.completeness(none, F.col("location"), none, none, F.col("tags"), none, F.col("datetime_iso")))
    return dedupe.survivors(scored, comps).select("ord", "comp", "group_size", "completeness")


@registered("SELECT provider, count(*) AS found, count(*) FILTER (k = 1) AS alone FROM (SELECT DISTINCT event_key, provider, k FROM v JOIN (SELECT event_key, count(DISTINCT provider) AS k FROM v GROUP BY event_key) USING (event_key)) GROUP BY provider")
def provider_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.provider_yield(listing(spark, sf_dir), "event_key")


@registered("SELECT city_key, event_key, ord FROM (SELECT *, row_number() OVER (PARTITION BY city_key, event_key ORDER BY datetime_iso DESC, ord) AS k FROM v) WHERE k = 1")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.latest(listing(spark, sf_dir), ["city_key", "event_key"], "datetime_iso", "ord").select("city_key", "event_key", "ord")


@registered(
    """, prev AS (SELECT event_key, max(score) AS score FROM v WHERE d < '1998-01-01' OR item % 2 = 0 GROUP BY event_key)
SELECT ord, prev.score IS NOT NULL AS reused, coalesce(prev.score, 5) AS score FROM v LEFT JOIN prev USING (event_key)"""
)
def reuse_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir)
    prev = rows.filter("substring(datetime_iso, 1, 10) < '1998-01-01' and datetime_iso <> '' or item % 2 = 0").groupBy("event_key").agg(F.max("score").alias("score"))
    return corpus.reuse(rows.select("ord", "event_key"), prev, ["event_key"], "score", 5.0).select("ord", "reused", "score")


HOST_SQL = "h AS (SELECT page_id, url, nullif(regexp_replace(lower(split_part(regexp_replace(trim(url), '^https?://', '', 'i'), '/', 1)), '^www\\.', ''), '') AS host FROM pages)"


@registered(" SELECT page_id, host FROM h", HOST_SQL)
def host_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", L.host(F.col("url")).alias("host"))


@registered(
    """, dom AS (SELECT host AS domain, 'full' AS source, 2 AS place FROM (SELECT DISTINCT host FROM h) UNION ALL SELECT DISTINCT regexp_extract(host, '[^.]+\\.[^.]+$'), 'site', 1 FROM h)
SELECT page_id, host, arg_min(source, place) AS source FROM h LEFT JOIN dom ON host = domain OR ends_with(host, '.' || domain) GROUP BY page_id, host""",
    HOST_SQL,
)
def suffix_host_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    hosts = pages.select(L.host(F.col("url")).alias("domain")).distinct()
    full = hosts.select("domain", F.lit("full").alias("source"), F.lit(2).alias("place"))
    site = hosts.select(F.regexp_extract("domain", r"[^.]+\.[^.]+$", 0).alias("domain"), F.lit("site").alias("source"), F.lit(1).alias("place")).distinct()
    return corpus.host_sources(pages, full.unionByName(site))


@registered(
    """ SELECT s.s_suppkey AS place, round(2 * 6371 * asin(sqrt(pow(sin(radians(s.s_nationkey * 2.0::DOUBLE - 27) / 2), 2) + cos(radians(27.0::DOUBLE)) * cos(radians(s.s_nationkey * 2.0::DOUBLE)) * pow(sin(radians(s.s_suppkey % 10 * 1.5::DOUBLE) / 2), 2))), 6) AS km
FROM supplier s""",
    "",
)
def haversine_fence(spark: SparkSession, sf_dir: str) -> DataFrame:
    km = L.distance_km(F.lit(27.0), F.lit(0.0), F.col("s_nationkey") * 2.0, (F.col("s_suppkey") % 10) * 1.5)
    return read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("place"), F.round(km, 6).alias("km"))


KEY_SQL = """k AS (SELECT p_partkey AS item, 'tag:' || unnest(list_distinct(string_split(p_name || ' ' || lower(p_type), ' '))) AS key FROM part WHERE p_partkey <= 200
UNION ALL SELECT p_partkey, 'cat:c' || (p_partkey % 6) FROM part WHERE p_partkey <= 200 UNION ALL SELECT p_partkey, 'vibe:social' FROM part WHERE p_partkey <= 200 AND p_partkey % 2 = 0),
prof AS (SELECT user_id, key, sum(delta) AS weight FROM (
  SELECT user_id, key, CASE WHEN kind = 'dislike' THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS delta FROM v_interaction JOIN k USING (item) WHERE kind <> 'dislike' OR starts_with(key, 'tag:')
  UNION ALL SELECT user_id, 'cat:__disliked__', 1.0::DOUBLE FROM v_interaction WHERE kind = 'dislike') GROUP BY user_id, key HAVING sum(delta) <> 0)"""


def item_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of the 200 items that interactions name."""
    part = read(spark, sf_dir, "part").filter("p_partkey <= 200")
    tags = part.select(F.col("p_partkey").alias("item"), F.explode(F.array_distinct(F.split(F.concat("p_name", F.lit(" "), F.lower("p_type")), " "))).alias("key")).withColumn("key", F.concat(F.lit("tag:"), "key"))
    cats = part.select(F.col("p_partkey").alias("item"), F.concat(F.lit("cat:c"), (F.col("p_partkey") % 6).cast("string")).alias("key"))
    vibes = part.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("item"), F.lit("vibe:social").alias("key"))
    return tags.unionByName(cats).unionByName(vibes)


@registered(" SELECT user_id, key, weight FROM prof", f"{SQL_INTERACTIONS}, {KEY_SQL}")
def taste_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.taste_profile(interactions(spark, sf_dir), item_keys(spark, sf_dir))


@registered(
    """, g AS (SELECT *, CASE WHEN starts_with(key, 'tag:') THEN 0 WHEN starts_with(key, 'vibe:') THEN 1 ELSE 2 END AS g FROM prof),
st AS (SELECT user_id, g, max(abs(weight)) FILTER (NOT contains(key, '__')) AS top FROM g GROUP BY 1, 2),
ok AS (SELECT user_id FROM g WHERE g = 2 GROUP BY user_id HAVING sum(abs(weight)) >= 3),
m AS (SELECT user_id, item, g, greatest(-1, least(1, sum(weight / top) / [3.0, 2.0, 1.0][g + 1])) AS r FROM g JOIN st USING (user_id, g) JOIN k USING (key) WHERE top > 0 AND user_id IN (SELECT user_id FROM ok) GROUP BY 1, 2, 3),
b AS (SELECT user_id, item, round(greatest(-4, least(4, 4 * sum([0.55, 0.25, 0.2][g + 1] * sign(r) * pow(abs(r), 1.5)))), 6) AS boost FROM m GROUP BY 1, 2)
SELECT user_id, item, boost, place FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY boost DESC, item) AS place FROM b) WHERE place <= 10""",
    f"{SQL_INTERACTIONS}, {KEY_SQL}",
)
def rank_by_taste(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = item_keys(spark, sf_dir)
    boosts = corpus.taste_boost(corpus.taste_profile(interactions(spark, sf_dir), keys), keys).withColumn("boost", F.round("boost", 6))
    w = Window.partitionBy("user_id").orderBy(F.desc("boost"), "item")
    return boosts.withColumn("place", F.row_number().over(w)).filter("place <= 10")


@registered(
    """ SELECT s AS source, count(*) AS weeks_hit, max(w) AS last_week FROM (SELECT DISTINCT event_type AS s, strftime(date_trunc('week', ts), '%Y-%m-%d') AS w FROM events)
WHERE w IN (SELECT DISTINCT strftime(date_trunc('week', ts), '%Y-%m-%d') AS w FROM events ORDER BY w DESC LIMIT 26) GROUP BY s""",
    "",
)
def ledger_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = read(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("week"))
    return corpus.ledger(hits)


@registered(" SELECT coalesce(event_type, 'TOTAL') AS stage, count(*) AS calls, round(sum(value), 4) AS total FROM events GROUP BY ROLLUP (event_type)", "")
def usage_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = read(spark, sf_dir, "events").rollup("event_type").agg(F.count(F.lit(1)).alias("calls"), F.round(F.sum("value"), 4).alias("total"))
    return rolled.select(F.coalesce("event_type", F.lit("TOTAL")).alias("stage"), "calls", "total")


@registered(
    """ SELECT ord, lower(to_base(list_reduce(list_prepend(0::BIGINT, list_transform(range(1, length(b) + 1), lambda i: ord(substr(b, i, 1))::BIGINT)), lambda h, c: (h * 31 + c) & 4294967295), 36)) AS hash
FROM (SELECT ord, city_key || '|' || title || '|' || datetime_iso || '|' || location AS b FROM v)"""
)
def event_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing(spark, sf_dir).select("ord", L.event_hash(F.col("city_key"), F.col("title"), F.col("datetime_iso"), F.col("location")).alias("hash"))


@registered("SELECT ord, CASE WHEN length(datetime_iso) <= 10 THEN NULL WHEN CAST(datetime_iso[12:13] AS INT) BETWEEN 5 AND 11 THEN 'morning' WHEN CAST(datetime_iso[12:13] AS INT) BETWEEN 12 AND 16 THEN 'afternoon' ELSE 'evening' END AS band FROM v")
def date_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing(spark, sf_dir).select("ord", L.band(F.col("datetime_iso")).alias("band"))


@registered(" SELECT event_id, strftime(ts, '%A %-d %b') AS shown FROM events", "")
def human_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", L.human_day(F.col("ts")).alias("shown"))


@registered(
    """ SELECT prefix, count(*) AS pages FROM (SELECT array_to_string(p[1:unnest([2, 3])], '/') AS prefix, unnest([2, 3]) AS n, len(p) AS k FROM (SELECT string_split(regexp_replace(url, '^https?://', ''), '/') AS p FROM pages)) WHERE k > n GROUP BY prefix HAVING count(*) >= 2""",
    "",
)
def sitemap_prefix_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.prefix_fanout(read(spark, sf_dir, "pages"), 2)


@registered(" SELECT o_custkey AS film, o_orderkey AS session FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n, min(o_orderdate) OVER (PARTITION BY o_custkey) AS first FROM orders) WHERE n <= 2 AND date_diff('day', CAST(first AS DATE), CAST(o_orderdate AS DATE)) <= 14", "")
def session_like_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey")
    rows = read(spark, sf_dir, "orders").withColumn("n", F.count(F.lit(1)).over(w)).withColumn("first", F.min("o_orderdate").over(w))
    return rows.filter((F.col("n") <= 2) & (F.datediff("o_orderdate", "first") <= 14)).select(F.col("o_custkey").alias("film"), F.col("o_orderkey").alias("session"))


@registered(
    f""", links AS (SELECT DISTINCT event_key FROM v WHERE item % 17 = 0 AND d BETWEEN '{A}' AND '{B}'), n AS (SELECT event_key, row_number() OVER (ORDER BY event_key) - 1 AS pos FROM links)
SELECT pos, event_key, min(ord) AS ord FROM n JOIN v USING (event_key) GROUP BY pos, event_key"""
)
def saved_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    week = week_listing(spark, sf_dir)
    ids = week.filter("item % 17 = 0").agg(F.array_sort(F.collect_set("event_key")).alias("ids")).select(F.posexplode("ids").alias("pos", "event_key"))
    return ids.join(listing(spark, sf_dir), "event_key").groupBy("pos", "event_key").agg(F.min("ord").alias("ord"))


@registered(
    f""", f AS (SELECT event_key, ord, 0 AS part FROM v WHERE d BETWEEN '{A}' AND '{B}' AND provider = 'A' UNION ALL SELECT event_key, ord, 1 FROM v WHERE d BETWEEN '{A}' AND '{B}' AND provider <> 'A')
SELECT event_key, ord FROM f JOIN (SELECT event_key, min(part) AS part FROM f GROUP BY event_key) USING (event_key, part)"""
)
def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    week = week_listing(spark, sf_dir).select("event_key", "ord", "provider")
    return corpus.union_priority("event_key", week.filter("provider = 'A'"), week.filter("provider <> 'A'")).select("event_key", "ord")


@registered(
    """ SELECT coalesce(a.k, b.k) AS host, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' WHEN a.v IS NOT DISTINCT FROM b.v THEN 'same' ELSE 'changed' END AS change
FROM (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 3 <> 0) a FULL JOIN (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 'X' ELSE c_mktsegment END AS v FROM customer WHERE c_custkey % 7 <> 0) b ON a.k = b.k""",
    "",
)
def change_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("host"), F.col("c_mktsegment").alias("v"))
    new = c.withColumn("v", F.when(F.col("host") % 5 == 0, "X").otherwise(F.col("v"))).filter("host % 7 <> 0")
    return corpus.change_set(c.filter("host % 3 <> 0"), new, "host", "v")


@registered(" SELECT window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT *, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M') AS window_start FROM events) GROUP BY 1, 2", "")
def tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = read(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return w.select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("window_start"), "event_type", "n", "total")


@registered(
    """ SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started, count(*) AS n FROM (SELECT *, sum(CASE WHEN gap IS NULL OR gap >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s
FROM (SELECT *, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events)) GROUP BY user_id, s""",
    "",
)
def sessionize(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "events").groupBy("user_id", F.session_window("ts", "30 minutes")).agg(F.count(F.lit(1)).alias("n"))
    return s.select("user_id", F.date_format("session_window.start", "yyyy-MM-dd HH:mm:ss").alias("started"), "n")


@registered()
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marquee.functions.markup import html_text as readable

    return read(spark, sf_dir, "pages").select("page_id", readable("html", "url").alias("text"))


@registered()
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marquee.functions.markup import clean_text as cleaned

    return read(spark, sf_dir, "documents").select("doc_id", cleaned("text").alias("text"))


@registered()
def display_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marquee.functions.markup import strip_display

    return read(spark, sf_dir, "documents").select("doc_id", strip_display(F.col("text")).alias("text"))


@registered()
def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from datetime import datetime

    from marquee.sources.pages import extract

    return extract(read(spark, sf_dir, "pages"), datetime(2026, 9, 28)).select("page_id", "rung", "via", "title", "start", "url")


@registered(" SELECT event_id, strftime(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Brisbane', '%Y-%m-%d %H:%M:%S') AS local FROM events", "")
def zone_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = F.from_utc_timestamp(F.col("ts").cast("timestamp"), "Australia/Brisbane")
    return read(spark, sf_dir, "events").select("event_id", F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("local"))


@registered("SELECT ord, CASE WHEN item % 4 = 0 THEN 0.0::DOUBLE WHEN item % 4 = 1 THEN (item % 90 + 5)::DOUBLE END AS amount FROM v")
def cost_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marquee.functions import records as R

    n = (F.col("item") % 90 + 5).cast("string")
    raw = F.when(F.col("item") % 4 == 0, "Free entry").when(F.col("item") % 4 == 1, F.concat(F.lit("$"), n)).when(F.col("item") % 4 == 2, F.concat(F.lit("from $"), n)).otherwise("See link")
    return listing(spark, sf_dir).select("ord", R.cost_amount(raw).alias("amount"))


@registered("SELECT ord, rtrim(trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g'))[1:60]).replace(' ', '-') AS slug FROM v")
def slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing(spark, sf_dir).select("ord", L.slug(F.col("title")).alias("slug"))


@registered(
    f""", b AS (SELECT city_key, ord, greatest(d, '{A}') AS a, least(e, '{B}') AS z, row_number() OVER (PARTITION BY city_key ORDER BY greatest(d, '{A}'), least(e, '{B}'), ord) AS k FROM v WHERE d <= '{B}' AND e >= '{A}'),
f AS (SELECT DISTINCT city_key, 0::BIGINT AS k, NULL::BIGINT AS ord, 0::BIGINT AS lane, []::VARCHAR[] AS ends FROM b
  UNION ALL SELECT city_key, k, ord, lane, list_concat(list_concat(ends[1:lane - 1], [z]), ends[lane + 1:]) FROM (
    SELECT b.*, f.ends, coalesce(list_position(list_transform(f.ends, lambda x: x < b.a), true), len(f.ends) + 1) AS lane FROM f JOIN b ON b.city_key = f.city_key AND b.k = f.k + 1))
SELECT city_key, ord, (lane - 1)::INTEGER AS lane FROM f WHERE k > 0""",
    f"RECURSIVE {SQL_LISTING}",
)
def pack_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marquee.operators.layout import pack_lanes as packed

    week = query.expand_days(listing(spark, sf_dir), A, B).groupBy("city_key", "ord").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    return packed(week, "city_key").select("city_key", "ord", "lane")


@registered()
def ical_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marquee.sinks.feeds import ical

    return ical(week_listing(spark, sf_dir))


@registered()
def rss_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marquee.sinks.feeds import rss

    return rss(week_listing(spark, sf_dir))


@registered()
def markdown_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marquee.sinks.feeds import markdown

    return markdown(query.top_picks(listing(spark, sf_dir), A, B, model.MAX_PICKS, "city_key"))


@registered(
    """ SELECT city, n, total FROM (SELECT coalesce(c_mktsegment, 'ALL') AS city, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer GROUP BY CUBE (c_mktsegment))""",
    "",
)
def segment_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").cube("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))
    return c.select(F.coalesce("c_mktsegment", F.lit("ALL")).alias("city"), "n", "total")


@registered(
    """ SELECT event_id, (SELECT max(o_orderkey) FROM orders o WHERE o.o_custkey = e.user_id AND o.o_orderdate = (SELECT max(o_orderdate) FROM orders p WHERE p.o_custkey = e.user_id AND p.o_orderdate <= e.ts)) AS o_orderkey FROM events e""",
    "",
)
def asof_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with its user's latest order so far: both sides in one stream per user, the last order carried on."""
    events = read(spark, sf_dir, "events").select(F.col("user_id").alias("k"), "ts", F.lit(1).alias("side"), "event_id", F.lit(None).cast("long").alias("order"))
    orders = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("ts")).agg(F.max("o_orderkey").alias("order"))
    both = events.unionByName(orders.select("k", "ts", F.lit(0).alias("side"), F.lit(None).cast("long").alias("event_id"), "order"))
    w = Window.partitionBy("k").orderBy("ts", "side").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("o_orderkey", F.last("order", ignorenulls=True).over(w)).filter("side = 1").select("event_id", "o_orderkey")


_SHOWN = """SELECT ord, CASE WHEN d IS NULL THEN '' WHEN nullif(datetime_end_iso, '') > d THEN
  strftime(CAST(d AS DATE), '%a %-d %b') || CASE WHEN d[1:4] <> datetime_end_iso[1:4] THEN ' ' || d[1:4] ELSE '' END || CASE WHEN length(datetime_iso) > 10 THEN ', ' || strftime(CAST(datetime_iso AS TIMESTAMP), '%-I:%M %p') ELSE '' END
  || ' – ' || strftime(CAST(datetime_end_iso AS DATE), '%a %-d %b') || CASE WHEN d[1:4] <> datetime_end_iso[1:4] THEN ' ' || datetime_end_iso[1:4] ELSE '' END
ELSE strftime(CAST(d AS DATE), '%a %-d %b') || CASE WHEN length(datetime_iso) > 10 THEN ', ' || strftime(CAST(datetime_iso AS TIMESTAMP), '%-I:%M %p') ELSE '' END END AS shown
FROM (SELECT ord, nullif(datetime_iso, '') AS datetime_iso, nullif(datetime_end_iso, '') AS datetime_end_iso, d FROM v)"""


@registered(_SHOWN)
def shown_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marquee.functions.dates import human_datetime as shown

    return listing(spark, sf_dir).select("ord", shown(F.col("datetime_iso"), F.col("datetime_end_iso")).alias("shown"))


@registered(
    """ SELECT event_id, strftime(CASE WHEN dayofweek(d) = 0 THEN d + 1 ELSE CAST(date_trunc('week', d) AS DATE) END, '%Y-%m-%d') AS coming, strftime(date_trunc('week', d), '%Y-%m-%d') AS week,
strftime(last_day(d), '%Y-%m-%d') AS month_end, strftime(CASE WHEN dayofweek(d) = 0 THEN d ELSE d + CAST(6 - dayofweek(d) AS INTEGER) END, '%Y-%m-%d') AS weekend FROM (SELECT event_id, CAST(ts AS DATE) AS d FROM events)""",
    "",
)
def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marquee.functions import dates as D

    d = F.col("ts").cast("date")
    return read(spark, sf_dir, "events").select("event_id", D.coming_week(d)["start"].alias("coming"), D.start_of_week(d).alias("week"), D.end_of_month(d).alias("month_end"), D.weekend(d)["start"].alias("weekend"))


@registered("SELECT ord, trim(string_split(location, ',')[1]) AS venue, trim(regexp_replace(regexp_replace(lower(location), '[^a-z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g')) AS venue_key FROM v")
def venue_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marquee.functions import records as R

    return listing(spark, sf_dir).select("ord", R.raw_venue(F.col("location")).alias("venue"), R.venue_key(F.col("location")).alias("venue_key"))


@registered(
    " SELECT doc_id, CASE WHEN length(text) <= 200 THEN text ELSE trim(CASE WHEN strpos(reverse(text[1:200]), ' ') > 0 AND 200 - strpos(reverse(text[1:200]), ' ') > 120 THEN text[1:200 - strpos(reverse(text[1:200]), ' ')] ELSE text[1:200] END) || '…' END AS teaser FROM documents",
    "",
)
def teasers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marquee.functions.records import truncate

    return read(spark, sf_dir, "documents").select("doc_id", truncate(F.col("text")).alias("teaser"))


@registered()
def page_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with enough text and dates to be worth reading, and why others are not."""
    from marquee.functions.dates import date_hits
    from marquee.functions.markup import html_text as readable
    from marquee.functions.records import blocked

    rows = read(spark, sf_dir, "pages").withColumn("text", readable("html", "url"))
    hits, size = date_hits(F.col("text")), F.length("text")
    return rows.select("page_id", size.alias("n_text"), hits.alias("n_dates"), blocked(F.lit(200), F.col("html"), size).alias("blocked"), ((size >= 1200) & (hits >= 5)).alias("passes"))


@registered(
    """, t AS (SELECT city_key, ord, sc, sd, CASE WHEN city_key = 'asia' THEN 0 WHEN list_contains(tags, 'red') OR list_contains(tags, 'anvil') THEN -1 WHEN list_contains(tags, 'ring') OR list_contains(tags, 'small') THEN 1 ELSE 0 END AS tier FROM v)
SELECT * FROM (SELECT city_key, ord, tier, row_number() OVER (PARTITION BY city_key ORDER BY tier DESC, sc DESC, sd, ord) AS place FROM t) WHERE place <= 200 OR tier = -1"""
)
def preferred_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing(spark, sf_dir)
    cities = read(spark, sf_dir, "region").select(F.lower("r_name").alias("city_key")).distinct()
    prefs = cities.filter("city_key <> 'asia'").select("city_key", F.array(F.lit("ring"), F.lit("small")).alias("wanted"), F.array(F.lit("red"), F.lit("anvil")).alias("unwanted"))
    return query.preferred_order(rows, prefs, "city_key").filter("place <= 200 or tier = -1").select("city_key", "ord", "tier", "place")


@registered(
    """ SELECT item, a = '' OR b = '' OR contains(a, b) OR contains(b, a) OR (len(x) > 0 AND len(y) > 0 AND 2.0 * shared / (len(x) + len(y)) > 0.6) OR array_to_string(string_split(a, ' ')[1:2], ' ') = array_to_string(string_split(b, ' ')[1:2], ' ')
  OR list_has_any(list_transform(range(3, length(ia) + 1), lambda k: ia[1:k]), wb) OR list_has_any(list_transform(range(3, length(ib) + 1), lambda k: ib[1:k]), wa) AS agree,
  len(list_filter(string_split(a, ' '), lambda w: w <> '')) >= 4 AS distinctive FROM h""",
    """p AS (SELECT p_partkey AS item, p_name || CASE p_partkey % 4 WHEN 0 THEN ' hall' WHEN 1 THEN ', new ' || p_brand WHEN 2 THEN '' ELSE ' ' || p_name END AS a,
  CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN p_name WHEN 2 THEN p_type || ' place' WHEN 3 THEN 'The ' || left(p_name, 1) || left(split_part(p_name, ' ', 2), 1) || 'n' ELSE upper(p_name) || '!' END AS b FROM part),
n AS (SELECT item, trim(regexp_replace(regexp_replace(lower(a), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS a, trim(regexp_replace(regexp_replace(lower(b), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS b FROM p),
g AS (SELECT *, list_transform(range(1, length(a)), lambda i: a[i:i + 1]) AS x, list_transform(range(1, length(b)), lambda i: b[i:i + 1]) AS y,
  list_filter(string_split(a, ' '), lambda w: length(w) >= 3) AS wa, list_filter(string_split(b, ' '), lambda w: length(w) >= 3) AS wb FROM n),
h AS (SELECT *, array_to_string(list_transform(wa, lambda w: w[1]), '') AS ia, array_to_string(list_transform(wb, lambda w: w[1]), '') AS ib,
  coalesce(list_sum(list_transform(list_distinct(x), lambda k: least(len(list_filter(x, lambda z: z = k)), len(list_filter(y, lambda z: z = k))))), 0) AS shared FROM g)""",
)
def venue_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether two spellings of a place agree, and whether the first would be distinctive as a title."""
    name, item = F.col("p_name"), F.col("p_partkey")
    a = F.concat(name, F.when(item % 4 == 0, " hall").when(item % 4 == 1, F.concat(F.lit(", new "), "p_brand")).when(item % 4 == 2, "").otherwise(F.concat(F.lit(" "), name)))
    short = F.concat(F.lit("The "), F.substring(name, 1, 1), F.substring(F.split_part(name, F.lit(" "), F.lit(2)), 1, 1), F.lit("n"))
    b = F.when(item % 5 == 0, "").when(item % 5 == 1, name).when(item % 5 == 2, F.concat("p_type", F.lit(" place"))).when(item % 5 == 3, short).otherwise(F.concat(F.upper(name), F.lit("!")))
    rows = read(spark, sf_dir, "part").select(item.alias("item"), L.place_text(a).alias("a"), L.place_text(b).alias("b"))
    return rows.select("item", L.venues_agree(F.col("a"), F.col("b")).alias("agree"), L.distinctive_title(F.col("a")).alias("distinctive"))


@registered(
    """ SELECT event_id, round(CASE WHEN hi <= lo THEN 0 ELSE (m - lo * 60) / ((hi - lo) * 60)::DOUBLE * 100 END, 6) AS percent FROM (SELECT event_id, extract(hour FROM ts) * 60 + extract(minute FROM ts) AS m, user_id % 12 AS lo, 8 + user_id % 7 AS hi FROM events)""",
    "",
)
def lane_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marquee.functions.dates import lane_percent as percent

    m = F.hour("ts") * 60 + F.minute("ts")
    return read(spark, sf_dir, "events").select("event_id", F.round(percent(m, F.col("user_id") % 12, 8 + F.col("user_id") % 7), 6).alias("percent"))


@registered(
    """ SELECT page_id, regexp_matches(link, '^https://', 'i') AND regexp_matches(regexp_extract(link, '^[^?#]*'), '[.](jpe?g|png|webp|gif|avif)$', 'i') AS image
FROM (SELECT page_id, url || CASE page_id % 5 WHEN 0 THEN '/a.JPG?w=800' WHEN 1 THEN '/b.webp#x' WHEN 2 THEN '/c.html?f=x.png' WHEN 3 THEN '.avif' ELSE '/d.svg' END AS link FROM pages)""",
    "",
)
def image_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 5
    link = F.concat("url", F.when(k == 0, "/a.JPG?w=800").when(k == 1, "/b.webp#x").when(k == 2, "/c.html?f=x.png").when(k == 3, ".avif").otherwise("/d.svg"))
    return read(spark, sf_dir, "pages").select("page_id", L.image_url(link).alias("image"))
