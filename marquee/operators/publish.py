"""What a site publishes for machines: day, week and category files with their index, the sitemap, and the check of what was written.

A file is rows of pieces: a head, one piece for each event, a tail. Pieces are put in order by the shuffle that brings a file to the task
that writes it, so no text of a file is ever one value. Its size in bytes, which decides whether a week is split by category, is a sum.

    pieces = feed_pieces(events, cities, today, zone, site)
    write_pieces(pieces.unionByName(index_pieces(pieces, cities, today, zone)), folder)
    feed_faults(spark, folder, today).count() == 0

cities: city_key, city, week_start, week_end, generated_at (null: today) and, if it isn't the key, slug; one row for each city. today: city_key, today.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee import model
from marquee.functions import listing as L
from marquee.functions.markup import strip_display
from marquee.functions.records import cost_amount, truncate
from marquee.sinks.calendars import slug_of, with_offset
from marquee.sinks.keyed_files import KeyedFiles

#: A week file of more bytes is split by category too.
SPLIT_BYTES = 200 * 1024
ROOT = "/ai/"
HEAD, EVENT, TAIL = 0, 1, 2


def quoted(text: Column) -> Column:
    """A text as a JSON string, null as null."""
    whole = F.to_json(F.struct(text.alias("x")))
    return F.when(text.isNull(), "null").otherwise(F.substr(whole, F.lit(6), F.length(whole) - 6))


def category_slug(label: Column) -> Column:
    """The short name of a category; community for any other."""
    pairs = [F.lit(x) for pair in model.CATEGORY_SLUGS.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), label), F.lit("community"))


def page_path(slug: Column, city: Column, title: Column, start: Column, place: Column) -> Column:
    return F.concat(F.lit("/"), slug, F.lit("/e/"), slug_of(city, title, start, place), F.lit("/"))


_LISTED = ("city_key", "ord", "title", "datetime_iso", "datetime_end_iso", "location", "category", "score")


def compact(events: DataFrame, zone: str, site: str, slug: str = "city_key", keep: tuple[str, ...] = ()) -> DataFrame:
    """The listings as they are published: city_key, ord, naive, id, title, start, end, location, category, price, free, description, url, and those of keep.

    events: the columns of listings; cost and description may be absent. Events without a title or a date that can be read are left out."""
    for absent in {"cost", "description"} - set(events.columns):
        events = events.withColumn(absent, F.lit(None).cast("string"))
    shown = lambda c: F.regexp_replace(strip_display(F.coalesce(c, F.lit(""))), "<[^>]+>", "")
    iso, end, place, city = F.col("datetime_iso"), F.col("datetime_end_iso"), F.coalesce("location", F.lit("")), F.col("city_key")
    date = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2})?)?$"
    offset = lambda c: F.when(c.rlike(date) & F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd")).isNotNull(), with_offset(F.when(c.rlike(date), c), zone))
    price = cost_amount(F.col("cost"))
    title = F.coalesce("title", F.lit(""))
    # identity and address first: a lambda in a select would read the aliases that stand before it in place of the columns
    events = events.withColumn("_id", L.event_hash(city, title, F.coalesce(iso, F.lit("")), place))
    events = events.withColumn("_url", F.concat(F.lit(site), page_path(F.col(slug), city, title, F.coalesce(iso, F.lit("")), place)))
    events = events.withColumn("_about", shown(F.col("description")))
    rows = events.select(
        *keep, "city_key", "ord", iso.alias("naive"),
        F.col("_id").alias("id"), shown(F.col("title")).alias("title"), offset(iso).alias("start"), offset(end).alias("end"),
        place.alias("location"), F.coalesce("category", F.lit("")).alias("category"), price.alias("price"), F.coalesce(price == 0, F.lit(False)).alias("free"),
        truncate(F.col("_about")).alias("description"), F.col("_url").alias("url"),
    )
    return rows.filter("title <> '' AND start IS NOT NULL")


def _object(fields: list[tuple[str, Column]], indent: int) -> Column:
    pad = " " * indent
    return F.concat_ws(",\n", *(F.concat(F.lit(f'{pad}"{name}": '), value) for name, value in fields))


def _event_text() -> Column:
    c = F.col
    price = F.coalesce(F.regexp_replace(c("price").cast("string"), r"\.0$", ""), F.lit("null"))
    fields = [(n, quoted(c(n))) for n in ("id", "title", "start", "end", "location", "category")]
    fields += [("price", price), ("free", c("free").cast("string")), ("description", quoted(c("description"))), ("url", quoted(c("url")))]
    return F.concat(F.lit("    {\n"), _object(fields, 6), F.lit("\n    }"))


def _cities(cities: DataFrame, today: DataFrame) -> DataFrame:
    slug = F.col("slug") if "slug" in cities.columns else F.col("city_key")
    rows = cities.join(today.select("city_key", "today"), "city_key").withColumn("slug", slug)
    return rows.withColumn("generated_at", F.coalesce("generated_at", "today")).withColumn("from", F.greatest("week_start", "today"))


def _files(c: DataFrame, zone: str) -> DataFrame:
    """city_key, kind, key, name, head: every file that a city may have; none once its week is over."""
    days = F.transform(F.sequence(F.col("from").cast("date"), F.col("week_end").cast("date")), lambda d: F.date_format(d, "yyyy-MM-dd"))
    week = F.concat(F.lit("week-"), F.col("week_start"))
    entry = lambda kind, key, name: F.struct(F.lit(kind).alias("kind"), key.alias("key"), F.concat(F.col("slug"), F.lit("/"), name).alias("name"))
    parts = [entry("category", F.lit(x), F.concat(week, F.lit(f"/{slug}"))) for x, slug in model.CATEGORY_SLUGS.items()]
    all_ = F.concat(F.transform(days, lambda d: entry("day", d, d)), F.array(entry("week", F.col("week_start"), week), *parts))
    rows = c.filter("week_end >= today AND week_end >= week_start").withColumn("_f", F.explode(all_)).select("*", "_f.*").drop("_f")
    common = [("data_as_of", "generated_at"), ("city", "city"), ("city_key", "city_key")]
    start = [(n, quoted(F.col(v))) for n, v in common] + [("timezone", quoted(F.lit(zone)))]
    day = _object([*start, ("date", quoted(F.col("key")))], 2)
    span = _object([*start, ("week_start", quoted(F.col("week_start"))), ("week_end", quoted(F.col("week_end")))], 2)
    head = F.concat(F.lit("{\n"), F.when(F.col("kind") == "day", day).otherwise(span), F.lit(',\n  "events": ['))
    return rows.select("city_key", "kind", "key", "name", head.alias("head"))


def feed_pieces(events: DataFrame, cities: DataFrame, today: DataFrame, zone: str, site: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """city_key, kind (day, week, category), key, name, part, naive, ord, body: the pieces of all files of all cities.

    A day file for every day that is left of the week, a file of the week, and one of each category with events where the week's is over
    split_bytes. Events below the score floor are left out, those of no score stay; a file's events are in order of naive start, then ord.
    A city whose week is over has no file. A day without events has a file with none."""
    text, sizes = _texts_and_sizes(events, cities, today, zone, site, split_bytes)
    first = sizes.filter("n_events > 0").select("name", F.struct("_naive", "_ord").alias("_first"))
    # one of repeated rows comes first
    among = F.row_number().over(Window.partitionBy("name", "naive", "ord").orderBy("body"))
    joint = F.when((F.struct(F.col("naive").alias("_naive"), F.col("ord").alias("_ord")) == F.col("_first")) & (F.col("_among") == 1), "\n").otherwise(",\n")
    rows = text.withColumn("_among", among).join(F.broadcast(first), "name").withColumn("body", F.concat(joint, "body")).drop("_first", "_among")
    ends = F.array(F.struct(F.lit(HEAD).alias("part"), F.col("head").alias("body")), F.struct(F.lit(TAIL).alias("part"), _tail().alias("body")))
    none = [F.lit(None).cast("string").alias("naive"), F.lit(None).cast("long").alias("ord")]
    return rows.unionByName(sizes.withColumn("_e", F.explode(ends)).select("city_key", "kind", "key", "name", "_e.part", *none, "_e.body"))


def feed_sizes(events: DataFrame, cities: DataFrame, today: DataFrame, zone: str, site: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """What file_sizes says of the pieces that feed_pieces gives, without making them: the events are read once."""
    return _texts_and_sizes(events, cities, today, zone, site, split_bytes)[1].select("city_key", "kind", "key", "name", "n_events", "n_bytes")


def _tail() -> Column:
    return F.when(F.col("n_events") > 0, "\n  ]\n}").otherwise("]\n}")


def _texts_and_sizes(events: DataFrame, cities: DataFrame, today: DataFrame, zone: str, site: str, split_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The events' pieces of all files that may be, without what joins them, and the files that there are: head, n_events, n_bytes, first event."""
    c = _cities(cities, today)
    span = c.filter("week_end >= today").select("city_key", "from", "week_start", "week_end", "slug")
    iso, end = F.col("datetime_iso"), F.col("datetime_end_iso")
    shown = events.select(*_LISTED, *(x for x in ("cost", "description") if x in events.columns)).filter(f"score IS NULL OR score >= {model.LOW_SCORE}")
    # the span of all weeks as literals drops the other rows before they meet any other table
    all_weeks = span.agg(F.min("week_start").alias("a"), F.max("week_end").alias("z")).first()
    shown = shown.withColumn("first", L.day(iso)).withColumn("last", L.last_day_of(iso, end)).filter((F.col("first") <= F.lit(all_weeks["z"])) & (F.col("last") >= F.lit(all_weeks["a"])))
    shown = shown.join(span, "city_key").filter("first <= week_end AND last >= week_start")
    # a date that names both sides of the join: the filter on what is read of it can't move below, to rows of other weeks
    shown = shown.withColumn("datetime_iso", F.when(F.col("first") <= F.col("week_end"), iso))
    rows = compact(shown, zone, site, "slug", ("first", "last", *span.columns[1:]))
    days = F.when(
        (F.col("last") >= F.col("from")) & (F.greatest("first", "from") <= F.least("last", "week_end")),
        F.transform(F.sequence(F.greatest("first", "from").cast("date"), F.least("last", "week_end").cast("date")), lambda d: F.struct(F.lit("day").alias("kind"), F.date_format(d, "yyyy-MM-dd").alias("key"))),
    )
    week = F.struct(F.lit("week").alias("kind"), F.col("week_start").alias("key"))
    category = F.when(F.col("category").isin(*model.CATEGORY_SLUGS), F.array(F.struct(F.lit("category").alias("kind"), F.col("category").alias("key"))))
    targets = F.flatten(F.array_compact(F.array(days, F.array(week), category)))
    base = F.concat(F.lit("week-"), F.col("week_start"))
    name = F.when(F.col("_t.kind") == "day", F.col("_t.key")).when(F.col("_t.kind") == "week", base).otherwise(F.concat(base, F.lit("/"), category_slug(F.col("category"))))
    text = rows.withColumn("body", _event_text()).withColumn("_t", F.explode(targets))
    text = text.select("city_key", "_t.kind", "_t.key", F.concat("slug", F.lit("/"), name).alias("name"), F.lit(EVENT).alias("part"), "naive", "ord", "body")
    least = F.min(F.struct("naive", "ord"))
    sums = text.groupBy("name").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.octet_length("body")).alias("_bytes"), least["naive"].alias("_naive"), least["ord"].alias("_ord"))
    sizes = _files(c, zone).join(sums, "name", "left").withColumn("n_events", F.coalesce("_n", F.lit(0).cast("long")))
    # an event follows a line break, all but the first a comma too
    inner = F.coalesce(F.col("_bytes") + 2 * F.col("n_events") - 1, F.lit(0))
    sizes = sizes.withColumn("n_bytes", F.octet_length("head") + inner + F.octet_length(_tail()))
    large = F.max(F.when(F.col("kind") == "week", F.col("n_bytes"))).over(Window.partitionBy("city_key")) > split_bytes
    return text, sizes.withColumn("_large", large).filter("kind <> 'category' OR (_large AND n_events > 0)")


def file_sizes(pieces: DataFrame) -> DataFrame:
    """city_key, kind, key, name, n_events, n_bytes of each file."""
    return pieces.groupBy("city_key", "kind", "key", "name").agg(F.count_if(F.col("part") == EVENT).alias("n_events"), F.sum(F.octet_length("body")).alias("n_bytes"))


def city_entries(pieces: DataFrame, cities: DataFrame, today: DataFrame) -> DataFrame:
    """city_key, city, slug, data_as_of, days, week, week_categories: what the index says of each city, those without files too.

    pieces: those of the files, or what feed_sizes gives. Categories come in their fixed order; days and the files of one week are few."""
    sizes = (pieces if "n_bytes" in pieces.columns else file_sizes(pieces)).withColumn("path", F.concat(F.lit(ROOT), "name", F.lit(".json")))
    rank = F.array_position(F.array(*map(F.lit, model.CATEGORIES)), F.col("key"))
    of = lambda kind, x: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, x)))
    named = F.struct(rank.alias("rank"), F.col("key").alias("category"), category_slug(F.col("key")).alias("slug"), F.col("path").alias("file"))
    files = sizes.groupBy("city_key").agg(of("day", F.col("path")).alias("days"), F.max(F.when(F.col("kind") == "week", F.col("path"))).alias("week"), of("category", named).alias("cats"))
    rows = _cities(cities, today).join(files, "city_key", "left")
    bare = F.transform("cats", lambda x: F.struct(x["category"].alias("category"), x["slug"].alias("slug"), x["file"].alias("file")))
    return rows.select("city_key", "city", "slug", F.col("generated_at").alias("data_as_of"), F.coalesce("days", F.array().cast("array<string>")).alias("days"), "week", F.coalesce(bare, F.array().cast("array<struct<category:string,slug:string,file:string>>")).alias("week_categories"))


def index_pieces(pieces: DataFrame, cities: DataFrame, today: DataFrame, zone: str) -> DataFrame:
    """The pieces of the index, one for each city in order of its key; its date is the latest of any city."""
    entries = city_entries(pieces, cities, today).select("city_key", F.to_json(F.struct("city", "city_key", "slug", F.lit(zone).alias("timezone"), "data_as_of", "days", "week", "week_categories"), {"ignoreNullFields": "false"}).alias("x"))
    first = entries.agg(F.min("city_key").alias("_first"))
    body = F.concat(F.when(F.col("city_key") == F.col("_first"), "\n    ").otherwise(",\n    "), "x")
    mid = entries.crossJoin(first).select("city_key", F.lit(EVENT).alias("part"), body.alias("body"))
    latest = today.join(cities, "city_key", "left_semi").agg(F.max("today").alias("d"))
    none = F.lit(None).cast("string").alias("city_key")
    head = latest.select(none, F.lit(HEAD).alias("part"), F.concat(F.lit('{\n  "data_as_of": '), quoted(F.col("d")), F.lit(',\n  "cities": [')).alias("body"))
    tail = latest.select(none, F.lit(TAIL).alias("part"), F.lit("\n  ]\n}").alias("body"))
    rows = mid.unionByName(head).unionByName(tail)
    return rows.select("city_key", F.lit("index").alias("kind"), F.lit("index").alias("key"), F.lit("index").alias("name"), "part", F.col("city_key").alias("naive"), F.lit(None).cast("long").alias("ord"), "body")


def write_pieces(pieces: DataFrame, folder: str, suffix: str = ".json") -> None:
    """Puts the files in place and prunes those of earlier runs, with this suffix, that this one didn't write."""
    pieces.sparkSession.dataSource.register(KeyedFiles)
    rows = pieces.repartition("name").sortWithinPartitions("name", "part", "naive", "ord").select("name", "body")
    rows.write.format("keyed_files").mode("overwrite").option("suffix", suffix).option("pieces", "true").save(folder)


_EVENT = "array<struct<id:string,title:string,start:string,`end`:string,url:string>>"
_ENTRY = "array<struct<city_key:string,days:array<string>,week:string,week_categories:array<struct<file:string>>>>"


def feed_faults(spark: SparkSession, folder: str, today: DataFrame) -> DataFrame:
    """name, id, fault: what is wrong with the files in a folder, read back from it; no rows if all is well.

    Faults: not JSON, no events, a file that the index names and nobody wrote, a day or week that is past for its city, an event without id,
    title, start or url, an event that doesn't touch its file's day or week. A file is read by one task, as JSON of many lines has to be."""
    schema = f"city_key string, date string, week_start string, week_end string, events {_EVENT}, cities {_ENTRY}, _bad string"
    raw = spark.read.schema(schema).options(multiLine=True, recursiveFileLookup=True, pathGlobFilter="*.json", columnNameOfCorruptRecord="_bad").json(folder)
    root = folder.removeprefix("file:").rstrip("/") + "/"
    files = raw.select("*", F.element_at(F.split(F.url_decode("_metadata.file_path"), root, 2), -1).alias("name")).join(today.select("city_key", "today"), "city_key", "left")
    fault = lambda x: F.lit(x).alias("fault")
    none = F.lit(None).cast("string").alias("id")
    index = files.filter("name = 'index.json' AND _bad IS NULL").select(F.explode("cities").alias("x"))
    listed = index.select(F.explode(F.array_compact(F.flatten(F.array(F.col("x.days"), F.array("x.week"), F.transform("x.week_categories", lambda c: c["file"]))))).alias("path"))
    named = listed.select(F.expr(f"substring(path, {len(ROOT) + 1})").alias("name")).distinct()
    good = files.filter("name <> 'index.json' AND _bad IS NULL")
    whole = [
        files.filter("_bad IS NOT NULL").select("name", none, fault("not JSON")),
        good.filter("events IS NULL").select("name", none, fault("no events")),
        named.join(files.select("name"), "name", "left_anti").select("name", none, fault("missing")),
        good.filter("coalesce(date, week_end) < today").select("name", none, fault("past")),
    ]
    e = good.select("name", F.coalesce("date", "week_start").alias("a"), F.coalesce("date", "week_end").alias("b"), F.explode("events").alias("e")).select("name", "a", "b", "e.*")
    lacking = F.filter(F.array(*(F.when(F.coalesce(n, F.lit("")) == "", F.lit(n)) for n in ("id", "title", "start", "url"))), lambda x: x.isNotNull())
    lacks = e.select("name", "id", F.explode(lacking).alias("n")).select("name", "id", F.concat(F.lit("no "), "n").alias("fault"))
    first, last = F.substring("start", 1, 10), F.substring(F.coalesce("end", "start"), 1, 10)
    apart = e.filter((first > F.col("b")) | (last < F.col("a"))).select("name", "id", fault("not in its span"))
    for more in (*whole[1:], lacks, apart):
        whole[0] = whole[0].unionByName(more)
    return whole[0]


def sitemap(events: DataFrame, cities: DataFrame, today: DataFrame, site: str) -> DataFrame:
    """loc, lastmod, changefreq, priority of every page: the root, each city's, its categories', its timeframes' and its events'.

    Timeframes change by the day and carry the latest date of any city, the others the date of their city's data. Every loc ends in a slash."""
    c = _cities(cities, today)
    latest = today.join(cities, "city_key", "left_semi").agg(F.max("today").alias("latest"))
    page = lambda loc, mod, freq, priority: F.struct(loc.alias("loc"), mod.alias("lastmod"), F.lit(freq).alias("changefreq"), F.lit(priority).alias("priority"))
    at = lambda *parts: F.concat(F.lit(site + "/"), *parts, F.lit("/"))
    made, slug = F.col("generated_at"), F.col("slug")
    pages = [page(at(slug), made, "weekly", "0.9")]
    pages += [page(at(slug, F.lit("/" + x)), made, "weekly", "0.7") for x in model.CATEGORY_SLUGS.values()]
    pages += [page(at(slug, F.lit("/" + x)), F.col("latest"), "daily", "0.8") for x in model.TIMEFRAMES]
    root = latest.select(page(F.lit(site + "/"), F.col("latest"), "weekly", "1.0").alias("p"))
    fixed = c.crossJoin(latest).select(F.explode(F.array(*pages)).alias("p"))
    text = lambda n: F.coalesce(n, F.lit(""))
    path = page_path(slug, F.col("city_key"), text("title"), text("datetime_iso"), text("location"))
    own = events.select(*_LISTED).join(c.select("city_key", "slug", "generated_at"), "city_key").select(page(F.concat(F.lit(site), path), made, "weekly", "0.5").alias("p"))
    return root.unionByName(fixed).unionByName(own).select("p.*")
