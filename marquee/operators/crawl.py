"""Sitemap crawl: best-first over a graph of documents, each host with a budget of its own, all hosts at once.

A round takes, for every host, the best document that is known and not yet visited; what an index lists becomes known in the
next round. So there are as many rounds as the budget has fetches, whatever the number of hosts, and a round moves one row for
each host and its children. Documents that turn out to be no sitemaps cost nothing of the budget, so they never compete;
which of them were tried follows from the order of the visits.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee import model
from marquee.functions import listing as L
from marquee.operators.dedupe import _kept

FETCHES, URLS, CANDIDATES, DESCENDANTS = 14, 8000, 5, 15


def path_of(url: Column) -> Column:
    """The path of a URL, without query and fragment; / if it has none."""
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(path == "", "/").otherwise(path)


def sitemap_priority(url: Column, terms: list[str]) -> Column:
    """4 for a listing word, 3 for a term of the city, else -4 for another region."""
    lower = F.lower(url)
    here = reduce(lambda a, b: a | b, [F.contains(lower, F.lit(t)) for t in terms], F.lit(False))
    return F.when(lower.rlike(model.LISTING_PATH), 4).otherwise(0) + F.when(here, 3).when(lower.rlike(model.OTHER_REGION), -4).otherwise(0)


def listing_index(path: Column) -> Column:
    """Whether a path looks like an index of listings: its last segment is a listing word or, under another, a short plain one."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    last = F.element_at(parts, -1)
    word = F.concat(F.lit("/"), last, F.lit("/")).rlike(model.LISTING_PATH)
    short = (F.size(parts) > 1) & ~F.contains(last, F.lit("-")) & (F.length(last) <= 14)
    return F.when(path.rlike(model.ARCHIVE_PATH) | ~F.size(parts).between(1, 3), False).otherwise(F.coalesce(word | short, F.lit(False)))


def sitemaps(bodies: DataFrame) -> DataFrame:
    """url, index, locs of the bodies (url, body) that are sitemaps: the root element says whether locs are sitemaps or pages."""
    index = F.col("body").rlike(r"(?i)<sitemapindex[\s>]")
    # a filter on bodies would be pushed into what computes them and compute them twice; rows made from an array are not
    some = bodies.select("url", F.explode(F.array("body")).alias("body")).filter(F.col("body").rlike(r"(?i)<(sitemapindex|urlset)[\s>]"))
    return some.groupBy("url").agg(F.min("body").alias("body")).select("url", index.alias("index"), F.regexp_extract_all("body", F.lit(r"(?i)<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1)).alias("locs"))


def same_site(url: Column, host: Column) -> Column:
    """The URL's host is the host or one below it."""
    own = L.host(url)
    return F.coalesce((own == host) | F.endswith(own, F.concat(F.lit("."), host)), F.lit(False))


def _written(df: DataFrame) -> DataFrame:
    """Checkpointed, but computed only once for it."""
    df = df.persist()
    out = _kept(df)
    df.unpersist()
    return out


def read_once(bodies: DataFrame) -> DataFrame:
    """The sitemaps of the bodies as a checkpointed table, for crawl() and offered() of the same bodies."""
    return _written(sitemaps(bodies))


def crawl(seeds: DataFrame, bodies: DataFrame, priority: Callable[[Column], Column], fetches: int = FETCHES, maps: DataFrame | None = None) -> DataFrame:
    """host, url, step, kind of every document tried: index and pages in the order of their fetches, none (step null) for what is no sitemap.

    seeds: host, url, place. Of equal priority the one goes first that was known first: seeds by place, then children by the step of
    their parent and their place in it. Hosts or URLs that are null, and URLs of other sites, are never tried. A URL that is known twice counts from the first time.
    maps: read_once(bodies), if at hand.
    """
    maps = read_once(bodies) if maps is None else maps
    kinds = maps.select("url", F.when(F.col("index"), "index").otherwise("pages").alias("kind"))
    # what an index lists, with its kinds, so that a round reads no page sitemaps
    links = maps.filter("index").select(F.col("url").alias("parent"), F.posexplode("locs").alias("place", "url")).join(kinds, "url", "left")
    links = _written(links.groupBy("parent").agg(F.collect_list(F.struct("place", "url", "kind")).alias("listed")))

    def new(rows: DataFrame) -> DataFrame:
        rows = rows.filter(same_site(F.col("url"), F.col("host"))).groupBy("host", "url").agg(F.min(F.struct("r", F.col("place").cast("long").alias("i"))).alias("at"), F.min("kind").alias("kind"))
        key = F.struct((-priority(F.col("url"))).alias("p"), "at.r", "at.i", "url")
        return rows.select("host", "url", F.coalesce("kind", F.lit("none")).alias("kind"), key.alias("key"), F.lit(None).cast("int").alias("step"))

    parts = int(seeds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = _written(new(seeds.select("host", "url", F.lit(0).alias("r"), "place").join(kinds, "url", "left")))
    open_ = F.when((F.col("kind") != "none") & F.col("step").isNull(), F.col("key"))
    for step in range(1, fetches + 1):
        # the step comes from the data, so every round has the same generated code
        best = known.groupBy("host").agg(F.min(open_).alias("best"), (F.coalesce(F.max("step"), F.lit(0)) + 1).alias("now")).filter("best is not null")
        marked = known.join(best, "host", "left").select("host", "url", "kind", "key", F.when(F.col("key") == F.col("best"), F.col("now")).otherwise(F.col("step")).alias("step"))
        parents = best.select("host", F.col("best.url").alias("parent"), F.col("now").alias("r"))
        children = parents.join(links, "parent").select("host", "r", F.explode("listed").alias("l")).select("host", "r", "l.place", "l.url", "l.kind")
        # a union adds up partitions, which else would grow from round to round
        known = _written(marked.unionByName(new(children).join(known.select("host", "url"), ["host", "url"], "left_anti")).coalesce(parts))
        if known.filter(F.col("step") == step).isEmpty():
            break
    # at most `fetches` visits a host
    of_host = known.filter("step is not null").groupBy("host").agg(F.collect_list(F.struct("step", "key")).alias("visits"))
    failed = known.filter("kind = 'none'").join(of_host, "host", "left")
    before = F.exists("visits", lambda v: (v["step"] > F.col("key.r")) & (v["key"] > F.col("key")))
    tried = failed.filter(F.col("visits").isNull() | (F.size("visits") < fetches) | before)
    return known.filter("step is not null").select("host", "url", "step", "kind").unionByName(tried.select("host", "url", "step", "kind"))


def offered(visits: DataFrame, bodies: DataFrame, urls: int = URLS, maps: DataFrame | None = None) -> DataFrame:
    """host, url, step, place: the URLs of the same site among the first `urls` that a host's page sitemaps list, in order of the crawl. maps: read_once(bodies), if at hand."""
    maps = sitemaps(bodies) if maps is None else maps
    w = Window.partitionBy("host").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    listed = visits.filter("kind = 'pages'").join(maps.select("url", "locs"), "url")
    before = F.coalesce(F.sum(F.size("locs")).over(w), F.lit(0))
    cut = listed.select("host", "step", F.slice("locs", F.lit(1), F.greatest(F.lit(0), F.lit(urls) - before).cast("int")).alias("locs"))
    return cut.select("host", "step", F.posexplode("locs").alias("place", "url")).filter(same_site(F.col("url"), F.col("host"))).select("host", "url", "step", "place")


def candidates(urls: DataFrame, priority: Callable[[Column], Column], most: int = CANDIDATES, least: int = DESCENDANTS) -> DataFrame:
    """host, url, rank of the best listing indexes among the offered URLs: they look like one, or `least` others lie below their path.

    Ordered by priority, then by how many lie below (2000 at most), then by short paths; of equal ones the first offered.
    """
    path = F.regexp_replace(path_of(F.col("url")), "/$", "")
    rows = urls.withColumn("path", path).withColumn("parts", F.filter(F.split("path", "/"), lambda s: s != ""))
    above = F.transform(F.sequence(F.lit(1), F.least(F.size("parts") - 1, F.lit(2))), lambda n: F.concat(F.lit("/"), F.array_join(F.slice("parts", F.lit(1), n), "/")))
    below = rows.filter(F.size("parts") > 1).select("host", F.explode(above).alias("path")).groupBy("host", "path").agg(F.count(F.lit(1)).alias("below"))
    rows = rows.join(below, ["host", "path"], "left")
    n = F.coalesce("below", F.lit(0))
    chosen = rows.filter(listing_index(path_of(F.col("url"))) | ((n >= least) & ~F.col("path").rlike(model.ARCHIVE_PATH)))
    score = priority(F.col("url")) * 10_000 + F.least(n, F.lit(2000)) - F.length("path") / 100
    # a host offers at most URLS of them
    once = chosen.groupBy("host", "url").agg(F.max(score).alias("score"), F.min(F.struct((~listing_index(path_of(F.col("url")))).alias("late"), "step", "place")).alias("first"))
    w = Window.partitionBy("host").orderBy(F.desc("score"), "first")
    return once.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most).select("host", "url", "rank")
