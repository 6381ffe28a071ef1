"""Queries of gathering: crawls, recurrence sets, streams of page data, cut answers, dense windows, leaders, splits, suffixes, caches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import model
from marquee.operators import crawl
from marquee.plans.queries import registered
from marquee.plans.tables import read

# --- a crawl over sites of sixty pages each: page k of a site is an index of pages 3k + 1 to 3k + 3, or lists the links of its text

SITE = 60
WORDS = ("events", "brisbane", "melbourne", "music", "whats-on/brisbane", "past-events", "news")
TERMS = ["brisbane", "qld", "queensland"]


def _priority(url):
    return crawl.sitemap_priority(url, TERMS)


def site_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Seeds and sitemap bodies made of the pages."""
    page, k = F.col("page_id"), F.col("page_id") % SITE
    host = F.concat(F.lit("s"), F.floor(page / SITE), F.lit(".example.org"))
    word = lambda p: F.element_at(F.array(*map(F.lit, WORDS)), (p % len(WORDS)).cast("int") + 1)
    url = lambda p: F.concat(F.lit("https://"), F.col("host"), F.lit("/"), word(p), F.lit("/"), (p % SITE).cast("string"))
    rows = read(spark, sf_dir, "pages").select("page_id", host.alias("host"), k.alias("k"), F.col("url").alias("real"), "html", F.when((k >= 20) & (k % 5 != 4), F.regexp_extract_all("html", F.lit(r'href="(/[^"\s<]+)"'), F.lit(1))).alias("hrefs"))
    children = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: url(F.col("page_id") - k + 3 * k + i))
    dead = F.concat(F.lit("https://"), F.col("host"), F.lit("/events/dead"), k % 7)
    parent = url(F.col("page_id") - k + F.greatest(F.lit(0), F.floor((k - 1) / 3)))
    index = F.concat(F.array(dead), children, F.array(F.col("real"), parent))
    own = F.concat(F.lit("https://"), F.col("host"))
    pages = F.transform("hrefs", lambda x: F.concat(own, F.lit("/events"), x))
    pages = F.concat(pages, F.transform(F.slice(pages, 1, 2), lambda x: F.concat(x, F.lit("/more-about-it"))), F.array(F.concat(own, F.lit("/past/events")), F.col("real")))
    locs = F.when(k < 20, index).otherwise(pages)
    inner = F.array_join(F.transform(locs, lambda x: F.concat(F.lit("<url><loc> "), x, F.lit("</loc></url>"))), "\n")
    body = F.when(k < 20, F.concat(F.lit("<?xml version='1.0'?><sitemapindex>"), inner, F.lit("</sitemapindex>"))).when(k % 5 == 4, F.col("html")).otherwise(F.concat(F.lit("<urlset xmlns='x'>"), inner, F.lit("</urlset>")))
    bodies = rows.select(url(page).alias("url"), body.alias("body"))
    seeds = rows.filter("k < 2").select("host", url(page).alias("url"), (-F.col("k")).alias("place"))
    return seeds, bodies


_WORD = "['" + "', '".join(WORDS) + "']"


def _url(p: str) -> str:
    return f"'https://' || host || '/' || ({_WORD})[({p}) % {len(WORDS)} + 1] || '/' || (({p}) % {SITE})"


def _score(u: str) -> str:
    flags = lambda p: f"regexp_matches(lower({u}), '{p.removeprefix('(?i)')}')"
    here = " OR ".join(f"contains(lower({u}), '{t}')" for t in TERMS)
    return f"(CASE WHEN {flags(model.LISTING_PATH)} THEN 4 ELSE 0 END + CASE WHEN {here} THEN 3 WHEN {flags(model.OTHER_REGION)} THEN -4 ELSE 0 END)"


SQL_SITES = f"""
p AS (SELECT page_id, page_id % {SITE} AS k, 's' || (page_id // {SITE}) || '.example.org' AS host, url AS real, html FROM pages),
l AS (SELECT host, {_url("page_id")} AS url, k, CASE WHEN k < 20 THEN 'index' WHEN k % 5 = 4 THEN 'none' ELSE 'pages' END AS kind,
  CASE WHEN k < 20 THEN list_concat(['https://' || host || '/events/dead' || k % 7, {_url("page_id - k + 3 * k + 1")}, {_url("page_id - k + 3 * k + 2")}, {_url("page_id - k + 3 * k + 3")}],
    [real, {_url("page_id - k + greatest(0, CAST(floor((k - 1) / 3) AS BIGINT))")}])
  ELSE list_concat(list_transform(regexp_extract_all(html, 'href="(/[^"\\s<]+)"', 1), lambda x: 'https://' || host || '/events' || x),
    list_transform(regexp_extract_all(html, 'href="(/[^"\\s<]+)"', 1)[1:2], lambda x: 'https://' || host || '/events' || x || '/more-about-it'), ['https://' || host || '/past/events', real]) END AS locs FROM p),
docs AS (SELECT DISTINCT ON (url) host, url, kind, list_filter(list_transform(locs, lambda x, i: {{'p': -{_score("x")}, 'r': 0, 'i': i - 1, 'url': x}}), lambda y: starts_with(y.url, 'https://' || host || '/')) AS found,
  len(locs) AS n, list_filter(list_transform(locs, lambda x, i: {{'i': i - 1, 'url': x}}), lambda y: true) AS listed FROM l),
walk AS (SELECT host, 0 AS n, 0 AS fetched, NULL::VARCHAR AS url, NULL::VARCHAR AS kind, NULL::INTEGER AS step, list(q) AS queue, []::VARCHAR[] AS seen
  FROM (SELECT host, {{'p': -{_score("url")}, 'r': 0, 'i': -k, 'url': url}} AS q FROM (SELECT host, k, {_url("page_id")} AS url FROM p WHERE k < 2)) GROUP BY host
  UNION ALL SELECT w.host, w.n + 1, w.fetched + CASE WHEN coalesce(d.kind, 'none') = 'none' THEN 0 ELSE 1 END, w.top.url, coalesce(d.kind, 'none'), CASE WHEN coalesce(d.kind, 'none') <> 'none' THEN w.fetched + 1 END,
    list_concat(list_filter(w.queue, lambda q: q.url <> w.top.url), CASE WHEN d.kind = 'index' THEN list_transform(list_filter(d.found, lambda q: NOT list_contains(w.seen, q.url) AND q.url <> w.top.url), lambda q: {{'p': q.p, 'r': w.fetched + 1, 'i': q.i, 'url': q.url}}) ELSE [] END),
    list_append(w.seen, w.top.url)
  FROM (SELECT *, list_sort(queue)[1] AS top FROM walk WHERE len(queue) > 0 AND fetched < {crawl.FETCHES}) w LEFT JOIN docs d ON d.url = w.top.url),
visits AS (SELECT host, url, step, kind FROM walk WHERE n > 0)"""


@registered(" SELECT * FROM visits", "RECURSIVE " + SQL_SITES.strip())
def sitemap_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which sitemaps of each site are fetched, in order, and which URLs turn out to be none."""
    return crawl.crawl(*site_pages(spark, sf_dir), _priority)


def _index_sql(path: str) -> str:
    rx = lambda p: p.removeprefix("(?i)")
    parts = f"list_filter(string_split({path}, '/'), lambda s: s <> '')"
    return f"""(NOT regexp_matches({path}, '{rx(model.ARCHIVE_PATH)}', 'i') AND len({parts}) BETWEEN 1 AND 3 AND (regexp_matches('/' || {parts}[-1] || '/', '{rx(model.LISTING_PATH)}', 'i')
  OR (len({parts}) > 1 AND NOT contains({parts}[-1], '-') AND length({parts}[-1]) <= 14)))"""


@registered(
    f""", sums AS (SELECT v.host, v.step, d.listed, sum(d.n) OVER (PARTITION BY v.host ORDER BY v.step) - d.n AS before FROM visits v JOIN docs d USING (url) WHERE v.kind = 'pages'),
offers AS (SELECT host, step, x.i AS place, x.url AS url FROM (SELECT host, step, before, unnest(listed) AS x FROM sums) WHERE before + x.i < 8000 AND starts_with(x.url, 'https://' || host || '/')),
paths AS (SELECT *, regexp_replace(regexp_extract(url, '^https://[^/?#]*([^?#]*)', 1), '/$', '') AS path FROM offers),
parts AS (SELECT *, list_filter(string_split(path, '/'), lambda s: s <> '') AS parts FROM paths),
below AS (SELECT host, path, count(*) AS below FROM (SELECT host, unnest(list_transform(range(1, least(len(parts) - 1, 2) + 1), lambda k: '/' || array_to_string(parts[1:k], '/'))) AS path FROM parts) GROUP BY ALL),
scored AS (SELECT o.*, coalesce(below, 0) AS n, {_index_sql("o.path")} AS fits FROM parts o LEFT JOIN below b USING (host, path)),
chosen AS (SELECT host, url, max({_score("url")} * 10000 + least(n, 2000) - length(path) / 100) AS score, min({{'late': NOT fits, 'step': step, 'place': place}}) AS first
  FROM scored WHERE fits OR (n >= 15 AND NOT regexp_matches(path, '{model.ARCHIVE_PATH.removeprefix("(?i)")}', 'i')) GROUP BY host, url)
SELECT host, url, rank FROM (SELECT host, url, row_number() OVER (PARTITION BY host ORDER BY score DESC, first) AS rank FROM chosen) WHERE rank <= 5""",
    "RECURSIVE " + SQL_SITES.strip(),
)
def sitemap_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best listing pages that each site's sitemaps offer."""
    seeds, bodies = site_pages(spark, sf_dir)
    maps = crawl.read_once(bodies)
    visits = crawl.crawl(seeds, bodies, _priority, maps=maps)
    return crawl.candidates(crawl.offered(visits, bodies, maps=maps), _priority)


# --- recurrence sets: one series for each order

WINDOW = ("1998-03-01 00:00:00", "1998-04-30 00:00:00")


def order_series(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Series and replaced instances made of the orders."""
    c, day = F.col("o_custkey"), F.col("o_orderdate").cast("timestamp_ntz")
    start = day + F.make_dt_interval(F.lit(0), (c % 24).cast("int"))
    after = lambda n: start + F.make_dt_interval(n)
    freq = F.element_at(F.create_map(*map(F.lit, ("1-URGENT", "DAILY", "2-HIGH", "WEEKLY", "3-MEDIUM", "MONTHLY", "4-NOT SPECIFIED", "MONTHLY", "5-LOW", "YEARLY"))), F.col("o_orderpriority"))
    none = F.lit(None).cast("array<string>")
    byday = F.when((freq == "WEEKLY") & (c % 2 == 0), F.array(F.lit("TH"), F.lit("MO"))).when(F.col("o_orderpriority") == "3-MEDIUM", F.array(F.element_at(F.array(*map(F.lit, ("2TU", "-1FR", "SU", "5WE"))), (c % 4 + 1).cast("int")))).otherwise(none)
    monthday = F.when((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (c % 3 > 0), F.array(F.when(c % 3 == 1, 31).otherwise(-1)))
    rows = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("uid"), start.alias("start"), after(F.lit(0)).alias("_"), c.alias("c"), freq.alias("freq"), byday.alias("byday"), monthday.alias("bymonthday"))
    series = rows.select(
        "uid", "start", (F.col("start") + F.expr("INTERVAL 2 HOUR")).alias("end"), F.when(F.col("c") % 7 > 0, F.col("freq")).alias("freq"), (F.col("c") % 3 + 1).cast("int").alias("step"),
        F.when(F.col("c") % 4 == 0, (5 + F.col("c") % 200).cast("int")).alias("count"), F.when(F.col("c") % 4 == 1, F.col("start") + F.expr("INTERVAL 900 DAY")).alias("until"), "byday", "bymonthday",
        F.when(F.col("c") % 6 == 0, F.array(F.lit("1998-03-10 09:30:00").cast("timestamp_ntz"), F.lit("1999-01-01 00:00:00").cast("timestamp_ntz"))).alias("rdates"),
        F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.lit("1998-03-05").cast("timestamp_ntz") + F.make_dt_interval(i.cast("int"), (F.col("c") % 24).cast("int"))).alias("exdates"),
    )
    moved = rows.filter("c % 5 = 0").select("uid", (F.lit("1998-03-20").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (F.col("c") % 24).cast("int"))).alias("recurrence_id")).withColumn("start", F.col("recurrence_id") + F.expr("INTERVAL 3 HOUR")).withColumn("end", F.lit(None).cast("timestamp_ntz"))
    return series, moved


@registered(
    f""", p AS (SELECT *, unnest(range(0, CASE freq WHEN 'DAILY' THEN 2600 WHEN 'WEEKLY' THEN 380 WHEN 'MONTHLY' THEN 90 ELSE 8 END)) * step AS k FROM s WHERE freq IS NOT NULL),
months AS (SELECT *, CAST(date_trunc('month', day) + to_months((CASE freq WHEN 'YEARLY' THEN 12 ELSE 1 END * k)::INTEGER) AS DATE) AS m FROM p WHERE freq IN ('MONTHLY', 'YEARLY')),
inm AS (SELECT *, unnest(range(0, 31)) AS j FROM months),
md AS (SELECT *, m + j::INTEGER AS d, day(last_day(m)) AS n FROM inm WHERE j < day(last_day(m))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY uid, m, isodow(d) ORDER BY d) AS nth, row_number() OVER (PARTITION BY uid, m, isodow(d) ORDER BY d DESC) AS back FROM md),
days AS (
  SELECT uid, k, CAST(day + k::INTEGER AS DATE) AS d FROM p WHERE freq = 'DAILY'
  UNION SELECT uid, k, CAST(date_trunc('week', day) AS DATE) + (7 * k)::INTEGER + unnest(CASE WHEN c % 2 = 0 THEN [0, 3] ELSE [isodow(day) - 1] END)::INTEGER FROM p WHERE freq = 'WEEKLY'
  UNION SELECT uid, k, d FROM ranked WHERE priority = '3-MEDIUM' AND CASE c % 4 WHEN 0 THEN isodow(d) = 2 AND nth = 2 WHEN 1 THEN isodow(d) = 5 AND back = 1 WHEN 2 THEN isodow(d) = 7 ELSE isodow(d) = 3 AND nth = 5 END
  UNION SELECT uid, k, d FROM ranked WHERE priority = '4-NOT SPECIFIED' AND day(d) = CASE c % 3 WHEN 1 THEN 31 WHEN 2 THEN n ELSE day(day) END
  UNION SELECT uid, k, d FROM ranked WHERE priority = '5-LOW' AND day(d) = day(day)),
ruled AS (SELECT uid, t FROM (SELECT uid, d + to_hours((c % 24)::INTEGER) AS t, s.start, until, cnt, row_number() OVER (PARTITION BY uid ORDER BY d) AS i
  FROM (SELECT * FROM days JOIN s USING (uid) WHERE d + to_hours((c % 24)::INTEGER) >= s.start) s) WHERE (cnt IS NULL OR i <= cnt) AND (until IS NULL OR t <= until)),
several AS (SELECT uid, t FROM ruled UNION SELECT uid, unnest([TIMESTAMP '1998-03-10 09:30:00', TIMESTAMP '1999-01-01 00:00:00']) FROM s WHERE c % 6 = 0 UNION SELECT uid, start FROM s WHERE c % 6 = 0 AND freq IS NULL),
every AS (SELECT uid, t FROM several WHERE t BETWEEN TIMESTAMP '{WINDOW[0]}' AND TIMESTAMP '{WINDOW[1]}' UNION SELECT uid, start FROM s WHERE freq IS NULL AND c % 6 > 0),
kept AS (SELECT uid, t, c, start FROM every JOIN s USING (uid) WHERE NOT (t BETWEEN TIMESTAMP '1998-03-05' AND TIMESTAMP '1998-03-15' AND hour(t) = c % 24 AND minute(t) = 0 AND t < TIMESTAMP '1998-03-15' ))
SELECT uid, strftime(t, '%Y-%m-%d %H:%M') AS recurrence_id, strftime(CASE WHEN moved THEN t + INTERVAL 3 HOUR ELSE t END, '%Y-%m-%d %H:%M') AS start, strftime(CASE WHEN NOT moved THEN t + INTERVAL 2 HOUR END, '%Y-%m-%d %H:%M') AS end_time
FROM (SELECT *, c % 5 = 0 AND t = TIMESTAMP '1998-03-20' + to_hours((c % 24)::INTEGER) AS moved FROM kept)""",
    """s AS (SELECT o_orderkey AS uid, o_custkey AS c, CAST(o_orderdate AS DATE) AS day, o_orderdate + to_hours((o_custkey % 24)::INTEGER) AS start, o_orderpriority AS priority, o_custkey % 3 + 1 AS step,
  CASE WHEN o_custkey % 7 > 0 THEN CASE o_orderpriority WHEN '1-URGENT' THEN 'DAILY' WHEN '2-HIGH' THEN 'WEEKLY' WHEN '5-LOW' THEN 'YEARLY' ELSE 'MONTHLY' END END AS freq,
  CASE WHEN o_custkey % 4 = 0 THEN 5 + o_custkey % 200 END AS cnt, CASE WHEN o_custkey % 4 = 1 THEN o_orderdate + to_hours((o_custkey % 24)::INTEGER) + INTERVAL 900 DAY END AS until FROM orders)""",
)
def recurrence_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instances of every order's series in a window: rules, counts, ends, additions, exceptions, replaced instances."""
    from marquee.operators.recurrence import expand

    show = lambda name: F.date_format(name, "yyyy-MM-dd HH:mm")
    return expand(*order_series(spark, sf_dir), *WINDOW).select("uid", show("recurrence_id").alias("recurrence_id"), show("start").alias("start"), show("end").alias("end_time"))


# --- streams of page data and cut answers


@registered(" SELECT doc_id, left(text, 80) AS title, strftime(DATE '1998-03-01' + (doc_id % 60)::INTEGER, '%Y-%m-%d') AS start, (doc_id % 3)::BIGINT AS related FROM documents WHERE text IS NOT NULL", "")
def flight_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of pages whose payload comes in chunks of 37 characters, each a script of its own."""
    from marquee.sources.streams import flight_values

    start = F.date_format(F.date_add(F.lit("1998-03-01").cast("date"), (F.col("doc_id") % 60).cast("int")), "yyyy-MM-dd")
    docs = read(spark, sf_dir, "documents").filter("text is not null").select("doc_id", F.substring("text", 1, 80).alias("title"), start.alias("start"))
    related = F.slice(F.array(F.lit('"{[a]"'), F.lit('"}\\\\"')), F.lit(1), (F.col("doc_id") % 3).cast("int"))
    value = F.concat(F.lit('{"event":'), F.to_json(F.struct("title", "start")), F.lit(',"related":['), F.array_join(related, ","), F.lit("]}"))
    stream = F.concat(F.lit('0:"$L1"\n1a:'), value, F.lit("\n2:I[\"x\"]\n3:{\"cut\":["))
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.length(stream) - 1) / 37).cast("int")), lambda i: F.substr(stream, i * 37 + 1, F.lit(37)))
    scripts = F.transform(pieces, lambda p: F.concat(F.lit("<script>self.__next_f.push([1,"), F.regexp_replace(F.regexp_replace(F.to_json(F.struct(p.alias("c"))), r'^\{"c":', ""), r"\}$", ""), F.lit("])</script>")))
    page = F.concat(F.lit("<html><body>"), F.array_join(scripts, "\n"), F.lit("</body></html>"))
    values = docs.select("doc_id", F.explode(flight_values(page)).alias("v")).filter(F.get_json_object("v", "$.event").isNotNull())
    return values.select("doc_id", F.get_json_object("v", "$.event.title").alias("title"), F.get_json_object("v", "$.event.start").alias("start"), F.coalesce(F.json_array_length(F.get_json_object("v", "$.related")), F.lit(0)).cast("long").alias("related"))


@registered(
    r""", a AS (SELECT doc_id, '[' || array_to_string(list_transform(words, lambda w, i: '{"i":' || (i - 1) || ',"w":"' || replace(replace(w, '\', '\\'), '"', '\"') || '"}'), ',') || ']' AS j FROM w),
c AS (SELECT doc_id, left(j, CAST(length(j) * (doc_id % 11) // 10 AS BIGINT)) AS j FROM a),
b AS (SELECT doc_id, CASE WHEN contains(j, ']') THEN left(j, length(j) - strpos(reverse(j), ']') + 1) ELSE j END AS j FROM c),
v AS (SELECT doc_id, CASE WHEN json_valid(j) THEN j WHEN strpos(reverse(j), ',}') > 0 AND json_valid(left(j, length(j) - strpos(reverse(j), ',}')) || ']') THEN left(j, length(j) - strpos(reverse(j), ',}')) || ']' END AS j FROM b)
SELECT doc_id, coalesce(json_array_length(j), 0)::BIGINT AS n, json_extract_string(j, '$[#-1].w') AS last_word FROM v""",
    "w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\n]+'), lambda x: x <> '') AS words FROM documents)",
)
def cut_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many elements of an array in a fenced answer survive its being cut off, and the last one."""
    from marquee.sources.streams import json_array

    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[ \n]+"), lambda x: x != "")
    quoted = lambda w: F.replace(F.replace(w, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    array = F.concat(F.lit("["), F.array_join(F.transform(words, lambda w, i: F.concat(F.lit('{"i":'), i, F.lit(',"w":"'), quoted(w), F.lit('"}'))), ","), F.lit("]"))
    rows = read(spark, sf_dir, "documents").select("doc_id", array.alias("j"))
    answer = F.concat(F.lit("Here you are:\n```json\n"), F.substr("j", F.lit(1), F.floor(F.length("j") * (F.col("doc_id") % 11) / 10).cast("int")), F.lit("\n```\n"))
    rows = rows.select("doc_id", json_array(answer).alias("v"))
    return rows.select("doc_id", F.size("v").cast("long").alias("n"), F.try_variant_get(F.get("v", F.size("v") - 1), "$.w", "string").alias("last_word"))


# --- long texts in parts

_PARAGRAPHS = "doc AS (SELECT doc_id, replace(text, '. ', chr(10) || chr(10)) AS text FROM documents WHERE text IS NOT NULL)"


def _paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").filter("text is not null").select("doc_id", F.replace("text", F.lit(". "), F.lit("\n\n")).alias("text"))


_BATCHES = f"""{_PARAGRAPHS},
par AS (SELECT doc_id, list_filter(string_split_regex(text, '\\n\\s*\\n'), lambda p: regexp_matches(p, '\\S')) AS ps, text FROM doc),
walk AS (SELECT doc_id, 0 AS i, 0::BIGINT AS batch, 0::BIGINT AS size FROM par
  UNION ALL SELECT w.doc_id, w.i + 1, CASE WHEN w.size = 0 OR w.size + length(ps[w.i + 1]) + 2 > 600 THEN w.batch + 1 ELSE w.batch END,
    CASE WHEN w.size = 0 OR w.size + length(ps[w.i + 1]) + 2 > 600 THEN length(ps[w.i + 1]) ELSE w.size + length(ps[w.i + 1]) + 2 END
  FROM walk w JOIN par USING (doc_id) WHERE w.i < len(ps)),
batches AS (SELECT doc_id, batch, string_agg(ps[i], chr(10) || chr(10) ORDER BY i) AS body FROM walk JOIN par USING (doc_id) WHERE i > 0 GROUP BY ALL UNION ALL SELECT doc_id, 1, text FROM par WHERE len(ps) = 0)"""


@registered(" SELECT doc_id, batch, length(body) AS n_chars, sha256(body) AS digest FROM batches", f"RECURSIVE {_BATCHES}")
def paragraph_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of every document packed in order into parts of 600 characters."""
    from marquee.functions.batches import split_batches

    rows = _paragraphs(spark, sf_dir).select("doc_id", F.posexplode(split_batches(F.col("text"), 600)).alias("at", "body"))
    return rows.select("doc_id", (F.col("at") + 1).cast("long").alias("batch"), F.length("body").cast("long").alias("n_chars"), F.sha2("body", 256).alias("digest"))


_HIT_SQL = " + ".join(f"len(regexp_extract_all(body, '{p}'))" for p in model.DATE_HITS)


@registered(
    f" SELECT * FROM (SELECT doc_id, batch, hits, row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, batch) AS rank FROM (SELECT doc_id, batch, {_HIT_SQL} AS hits FROM batches) WHERE hits > 0) WHERE rank <= 3",
    f"RECURSIVE {_BATCHES}",
)
def date_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three parts of every document that hold the most dates."""
    from marquee.functions.batches import densest_batches

    rows = densest_batches(_paragraphs(spark, sf_dir), "text", "doc_id", 600)
    return rows.select("doc_id", *(F.col(c).cast("long").alias(c) for c in ("batch", "hits", "rank")))


@registered(
    f""", pieces AS ({" UNION ALL ".join(f"SELECT doc_id, {i} AS kind, regexp_extract_all(text, '{p}') AS hits, string_split_regex(text, '{p}') AS gaps FROM doc" for i, p in enumerate(model.DATE_HITS))}),
found AS (SELECT doc_id, kind, i, length(hits[i]) AS n, sum(length(gaps[i])) OVER w + coalesce(sum(length(hits[i - 1])) OVER w, 0) AS start FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM pieces) WINDOW w AS (PARTITION BY doc_id, kind ORDER BY i)),
windows AS (SELECT doc_id, length(text) AS size, unnest(CASE WHEN length(text) <= 2000 THEN [0] ELSE range(0, length(text) - 1, 1000) END) AS pos FROM doc),
counted AS (SELECT w.doc_id, w.pos, count(f.start) AS hits FROM windows w LEFT JOIN found f ON f.doc_id = w.doc_id AND f.start >= w.pos AND f.start + f.n <= w.pos + CASE WHEN w.size <= 2000 THEN w.size ELSE 2000 END GROUP BY ALL),
best AS (SELECT doc_id, pos, hits FROM counted QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, pos) = 1),
snaps AS (SELECT b.*, CASE WHEN length(text) > 2000 AND strpos(substr(text, pos + 1), chr(10) || chr(10)) BETWEEN 1 AND 1000 THEN pos + strpos(substr(text, pos + 1), chr(10) || chr(10)) + 1 END AS snap FROM best b JOIN doc USING (doc_id)),
moved AS (SELECT s.doc_id, count(f.start) AS hits FROM snaps s LEFT JOIN found f ON f.doc_id = s.doc_id AND f.start >= s.snap AND f.start + f.n <= s.snap + 2000 WHERE snap IS NOT NULL GROUP BY ALL)
SELECT s.doc_id, CASE WHEN m.hits >= s.hits THEN snap ELSE pos END::INTEGER AS start, s.hits::INTEGER AS hits FROM snaps s LEFT JOIN moved m USING (doc_id)""",
    _PARAGRAPHS,
)
def dense_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the 2000 characters of every document begin that hold the most dates."""
    from marquee.functions.batches import densest_window

    return _paragraphs(spark, sf_dir).select("doc_id", densest_window(2000)("text").alias("w")).select("doc_id", "w.start", "w.hits")


@registered(
    """, r AS (SELECT city_key, category, octet_length(encode(title || '|' || datetime_iso || '|' || location)) AS bytes FROM v),
c AS (SELECT city_key, sum(bytes) > 700000 AS large FROM r GROUP BY 1)
SELECT city_key, CASE WHEN large THEN category END AS category, count(*) AS rows, sum(bytes)::BIGINT AS bytes FROM r JOIN c USING (city_key) GROUP BY ALL"""
)
def split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of each city: one, or one for each category where that would be too large."""
    from marquee.functions.batches import split_by_size
    from marquee.plans.tables import listing

    return split_by_size(listing(spark, sf_dir), "city_key", "category", F.octet_length(F.concat_ws("|", "title", "datetime_iso", "location")), 700_000)


# --- duplicates by order, keys by their end, answers by content

_TITLES = """ev AS (SELECT p_partkey AS item, CASE p_partkey % 6 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' ' || lower(p_type) WHEN 2 THEN upper(p_name) || '!' WHEN 3 THEN 'The ' || p_name || ' ' || lower(p_type)
  WHEN 4 THEN '' ELSE p_name || ' ' || lower(p_type) || ' at the hall' END AS title, CASE WHEN p_partkey % 31 > 0 THEN '1998-03-' || lpad(((p_partkey // 40) % 28 + 1)::VARCHAR, 2, '0') END AS day FROM part)"""


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    item, name, kind = F.col("p_partkey"), F.col("p_name"), F.lower("p_type")
    k, words = item % 6, lambda *xs: F.concat_ws(" ", *xs)
    title = F.when(k == 0, name).when(k == 1, words(name, kind)).when(k == 2, F.concat(F.upper(name), F.lit("!"))).when(k == 3, words(F.lit("The"), name, kind)).when(k == 4, "").otherwise(words(name, kind, F.lit("at the hall")))
    day = F.when(item % 31 > 0, F.concat(F.lit("1998-03-"), F.lpad((F.floor(item / 40) % 28 + 1).cast("string"), 2, "0")))
    return read(spark, sf_dir, "part").select(item.alias("item"), title.alias("title"), day.alias("day"))


@registered(
    """, n AS (SELECT item, day, trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')) AS t FROM ev),
g AS (SELECT *, list_transform(range(1, length(t)), lambda i: t[i:i + 1]) AS x, row_number() OVER (PARTITION BY day ORDER BY item) AS i FROM n WHERE day IS NOT NULL AND t <> ''),
walk AS (SELECT day, 0::BIGINT AS i, [{'t': ''::VARCHAR, 'x': []::VARCHAR[]}] AS kept, NULL::BIGINT AS item FROM (SELECT DISTINCT day FROM g)
  UNION ALL SELECT w.day, g.i, CASE WHEN hit THEN w.kept ELSE list_append(w.kept, {'t': g.t, 'x': g.x}) END, CASE WHEN hit THEN NULL ELSE g.item END
  FROM walk w JOIN g ON g.day = w.day AND g.i = w.i + 1, LATERAL (SELECT len(list_filter(w.kept, lambda k: k.t <> '' AND (k.t = g.t OR (length(k.t) >= 6 AND length(g.t) >= 6 AND (starts_with(k.t, g.t) OR starts_with(g.t, k.t)))
    OR 2.0 * list_sum(list_transform(list_distinct(g.x), lambda b: least(len(list_filter(g.x, lambda z: z = b)), len(list_filter(k.x, lambda z: z = b))))) / (len(g.x) + len(k.x)) > 0.85))) > 0 AS hit) h)
SELECT item FROM walk WHERE item IS NOT NULL UNION ALL SELECT item FROM n WHERE day IS NULL OR t = ''""",
    "RECURSIVE " + _TITLES,
)
def sequential_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items that a pass in order keeps, each compared with kept ones of its day only."""
    from marquee.operators.leaders import leaders

    return leaders(_titles(spark, sf_dir), "item", F.col("title"), F.col("day")).select("item")


@registered(
    """, f AS (SELECT p_partkey AS item, lower(p_name) || ' ' || p_partkey % 9 AS k FROM part), o AS (SELECT p_partkey AS other, CASE p_partkey % 4 WHEN 0 THEN lower(p_brand) || ': ' || lower(p_name) || ' ' || p_partkey % 7 WHEN 1 THEN lower(p_name) || ' ' || p_partkey % 9
  WHEN 2 THEN 'gala: preview: ' || lower(p_name) || ' ' || p_partkey % 3 ELSE '' END AS k FROM part),
m AS (SELECT item, other FROM f JOIN o ON o.k = f.k OR ends_with(o.k, ': ' || f.k)), one AS (SELECT item, min(other) AS other FROM m GROUP BY item HAVING count(*) = 1)
SELECT f.item, one.other FROM f LEFT JOIN one USING (item)""",
    "z AS (SELECT 1)",
)
def match_by_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each film the one occasion that is called like it or ends in its name, if just one is."""
    from marquee.operators.leaders import only_match_by_end

    part = read(spark, sf_dir, "part")
    item, name = F.col("p_partkey"), F.lower("p_name")
    number = lambda n: (item % n).cast("string")
    films = part.select(item.alias("item"), F.concat_ws(" ", name, number(9)).alias("k"))
    title = F.when(item % 4 == 0, F.concat(F.lower("p_brand"), F.lit(": "), name, F.lit(" "), number(7))).when(item % 4 == 1, F.concat_ws(" ", name, number(9))).when(item % 4 == 2, F.concat(F.lit("gala: preview: "), name, F.lit(" "), number(3))).otherwise("")
    return only_match_by_end(films, "k", part.select(item.alias("other"), title.alias("k")), "k").select("item", F.col("match_other").alias("other"))


@registered(
    """ SELECT page_id, sha1('v2' || chr(10) || html) AS digest, CASE WHEN page_id % 3 = 0 THEN 'answer ' || page_id END AS answer, page_id % 3 = 0 AS hit FROM pages""",
    "",
)
def cached_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose answers are stored for this version, and those that have to be asked again."""
    from marquee.operators import caches

    pages = read(spark, sf_dir, "pages")
    of = lambda v: pages.select(caches.digest(v, F.col("html")).alias("digest"), F.concat_ws(" ", F.lit("answer"), "page_id").alias("answer"), F.col("page_id"))
    empty = spark.createDataFrame([], "digest string, version string, answer string")
    store = caches.added(empty, of("v1").filter("page_id % 3 = 1").drop("page_id"), "v1")
    store = caches.added(store, of("v2").filter("page_id % 3 = 0").drop("page_id"), "v2")
    hits, misses = caches.asked(pages, "html", store, "v2")
    known = hits.select("page_id", "digest", "answer", F.lit(True).alias("hit"))
    asked = misses.join(of("v2"), "digest").select("page_id", "digest", F.lit(None).cast("string").alias("answer"), F.lit(False).alias("hit"))
    return known.unionByName(asked)


_KINDS = _TITLES + """,
t AS (SELECT item, day, trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')) AS t FROM ev WHERE day IS NOT NULL),
u AS (SELECT min(item) AS item, day, t, list_transform(range(1, length(t)), lambda i: t[i:i + 1]) AS x FROM t WHERE t <> '' GROUP BY day, t),
p AS (SELECT least(l.item, r.item) AS a, greatest(l.item, r.item) AS b, l.day = r.day AS same_day, l.t AS t1, r.t AS t2,
  CASE WHEN l.t = r.t THEN 1.0 WHEN len(l.x) = 0 OR len(r.x) = 0 THEN 0.0 ELSE 2.0 * list_sum(list_transform(list_distinct(l.x), lambda g: least(len(list_filter(l.x, lambda z: z = g)), len(list_filter(r.x, lambda z: z = g))))) / (len(l.x) + len(r.x)) END AS sim
  FROM u l JOIN u r ON l.day = r.day AND l.item < r.item OR r.day::DATE = l.day::DATE + 1),
kinds AS (SELECT a, b, CASE WHEN same_day AND (t1 = t2 OR length(t1) >= 6 AND length(t2) >= 6 AND (starts_with(t1, t2) OR starts_with(t2, t1)) OR sim > 0.85) THEN 'settled' WHEN sim >= 0.45 AND (NOT same_day OR sim < 0.85) THEN 'candidate' END AS kind FROM p)"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marquee.operators.dedupe import block_pairs

    rows = _titles(spark, sf_dir).select(F.col("item").alias("ord"), "title", F.coalesce("day", F.lit("")).alias("datetime_iso"), F.lit(1).alias("all"))
    return block_pairs(rows, "all")


@registered(" SELECT a, b, kind FROM kinds WHERE kind IS NOT NULL", _KINDS)
def pair_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of one day or neighbouring days that are one, or that somebody has to say so about."""
    return _pairs(spark, sf_dir).filter("kind <> 'none'").select("a", "b", "kind")


@registered(
    """, asked AS (SELECT a, b FROM kinds WHERE kind = 'candidate' QUALIFY row_number() OVER (ORDER BY a, b) <= 3000)
SELECT a, b FROM kinds WHERE kind = 'settled' UNION SELECT a, b FROM asked WHERE (a + b) % 3 = 0""",
    _KINDS,
)
def confirmed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settled pairs and those of the first 3000 undecided ones that are answered with yes; a third has no answer."""
    from marquee.operators.dedupe import _kept, confirmed, to_ask

    pairs = _kept(_pairs(spark, sf_dir).filter("kind <> 'none'").select("all", "a", "b", "kind"))
    answers = to_ask(pairs, "all").filter("(a + b) % 3 < 2").select("a", "b", ((F.col("a") + F.col("b")) % 3 == 0).alias("same"))
    return confirmed(pairs, answers)
