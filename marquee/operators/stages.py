"""Stages of the weekly batch as DataFrame functions: pre-pass, annotation, locality, carry-forward, usage, selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee import model
from marquee.functions import listing as L


def prepass(candidates: DataFrame, first: str, last: str) -> DataFrame:
    """Adds reason: no-title, no-date, past, later or kept, the first that holds."""
    start, end = F.col("datetime_iso"), F.col("datetime_end_iso")
    reason = (
        F.when(F.coalesce(F.trim("title"), F.lit("")) == "", "no-title")
        .when(L.day(start).isNull(), "no-date")
        .when(L.last_day_of(start, end) < first, "past")
        .when(L.day(start) > last, "later")
        .otherwise("kept")
    )
    return candidates.withColumn("reason", reason)


def annotate(rows: DataFrame, vocabulary: list[str], most: int = 8) -> DataFrame:
    """Tags of the vocabulary in their order, at most `most`; a category outside the list becomes the last one; vibes are true or false; rows marked drop go."""
    known = F.array(*map(F.lit, vocabulary))
    tags = F.slice(F.array_distinct(F.filter(F.transform("tags", lambda t: F.lower(F.trim(t))), lambda t: F.array_contains(known, t))), 1, most)
    out = rows.withColumn("tags", tags).withColumn("category", F.when(F.col("category").isin(*model.CATEGORIES), F.col("category")).otherwise(model.CATEGORIES[-1]))
    for v in model.VIBES:
        out = out.withColumn(v, F.col(v).eqNullSafe(True))
    return out.filter(~F.coalesce(F.col("drop"), F.lit(False))).drop("drop")


def reuse_annotations(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Takes tags and category of the same key, unless a description that was known has changed. known: key, description, tags, category."""
    k = known.select(F.col(key), F.col("description").alias("_d"), F.col("tags").alias("_t"), F.col("category").alias("_c"))
    same = F.col("_t").isNotNull() & ((F.coalesce("_d", F.lit("")) == "") | (F.col("_d") == F.coalesce("description", F.lit(""))))
    out = rows.join(k, key, "left").withColumn("reused", same)
    return out.withColumn("tags", F.when(same, F.col("_t")).otherwise(F.col("tags"))).withColumn("category", F.when(same, F.col("_c")).otherwise(F.col("category"))).drop("_d", "_t", "_c")


def locate(rows: DataFrame, places: DataFrame) -> DataFrame:
    """Joins locations to a place cache with three answers: resolved, no_such_place (known to be none), unknown (not asked or failed).

    places: location, lat, lng, found."""
    p = places.select(F.col("location").alias("_l"), "lat", "lng", F.col("found").alias("_f"))
    out = rows.join(p, F.trim(rows["location"]) == F.col("_l"), "left").drop("_l")
    return out.withColumn("place_status", F.when(F.col("_f"), "resolved").when(F.col("_f") == F.lit(False), "no_such_place").otherwise("unknown")).drop("_f")


def inside(rows: DataFrame, lat: Column, lng: Column, radius_km: Column) -> DataFrame:
    """Drops rows known to be too far away; rows without evidence stay."""
    far = L.distance_km(F.col("lat"), F.col("lng"), lat, lng) > radius_km
    return rows.filter(~((F.col("place_status") == "resolved") & F.coalesce(far, F.lit(False))))


def misses(rows: DataFrame, places: DataFrame) -> DataFrame:
    """Locations to ask for, the commonest first."""
    asked = rows.select(F.trim("location").alias("location")).filter("location <> ''").groupBy("location").agg(F.count(F.lit(1)).alias("n"))
    return asked.join(places.select("location"), "location", "left_anti").orderBy(F.desc("n"), "location")


def carry_forward(fresh: DataFrame, previous: DataFrame, key: str, today: str) -> DataFrame:
    """Fresh rows, and rows of before that have a date, aren't over, and weren't found again."""
    start, end = F.col("datetime_iso"), F.col("datetime_end_iso")
    still = previous.filter(L.day(start).isNotNull() & ~L.is_past(start, end, today)).join(fresh.select(key).distinct(), key, "left_anti")
    return fresh.withColumn("carried", F.lit(False)).unionByName(still.withColumn("carried", F.lit(True)), allowMissingColumns=True)


def usage_totals(calls: DataFrame, prices: DataFrame) -> DataFrame:
    """Per stage and in TOTAL: calls, tokens and their price. calls: stage, model, prompt, output. prices: model, per million of each."""
    usd = (F.col("prompt") * F.col("prompt_price") + F.col("output") * F.col("output_price")) / 1_000_000
    rows = calls.join(prices, "model", "left").withColumn("usd", usd)
    out = rows.rollup("stage").agg(F.count(F.lit(1)).alias("calls"), F.sum("prompt").alias("prompt"), F.sum("output").alias("output"), F.sum("usd").alias("usd"))
    return out.withColumn("stage", F.coalesce("stage", F.lit("TOTAL")))


def registry(sources: DataFrame, domain: str = "domain") -> DataFrame:
    """Adds id: the given one, else the host without its last label as a slug; repeated ids get -2, -3 and so on."""
    derived = L.slug(F.regexp_replace(L.host(F.col(domain)), r"\.[^.]+$", ""))
    named = sources.withColumn("_id", F.coalesce(F.nullif(F.col("id"), F.lit("")), derived))
    n = F.row_number().over(Window.partitionBy("_id").orderBy("ord"))
    return named.withColumn("id", F.when(n == 1, F.col("_id")).otherwise(F.concat("_id", F.lit("-"), n.cast("string")))).drop("_id")


def earns_place(sources: DataFrame, hits: DataFrame, today: str, weeks: int = 8, grace_days: int = 28) -> DataFrame:
    """Sources that were hit in the last weeks or are new; all while there is less history. sources: source, added. hits: source, week."""
    recent = hits.select("week").distinct().orderBy(F.desc("week")).limit(weeks)
    depth = recent.agg(F.count(F.lit(1)).alias("_depth"))
    good = hits.join(F.broadcast(recent), "week").select("source").distinct().withColumn("_hit", F.lit(True))
    rows = sources.join(good, "source", "left").join(F.broadcast(depth))
    young = F.coalesce(F.datediff(F.lit(today).cast("date"), F.col("added").cast("date")) <= grace_days, F.lit(False))
    return rows.filter((F.col("_depth") < weeks) | F.col("_hit").isNotNull() | young).drop("_hit", "_depth")


def venue_names(rows: DataFrame, overrides: DataFrame, cache: DataFrame) -> DataFrame:
    """venue_name by priority: override, cache (null there: not a venue), else the raw name. Both: raw, canonical."""
    from marquee.functions.records import raw_venue

    out = rows.withColumn("_raw", raw_venue(F.col("location")))
    o = overrides.select(F.col("raw").alias("_raw"), F.col("canonical").alias("_o"))
    c = cache.select(F.col("raw").alias("_raw"), F.col("canonical").alias("_c"), F.lit(True).alias("_known"))
    out = out.join(o, "_raw", "left").join(c, "_raw", "left")
    name = F.coalesce("_o", F.when(F.col("_known"), F.col("_c")).otherwise(F.nullif("_raw", F.lit(""))))
    return out.withColumn("venue_name", name).drop("_raw", "_o", "_c", "_known")


def enrichment(candidates: DataFrame, details: DataFrame) -> DataFrame:
    """Descriptions from detail pages for rows without one; a text that several pages share says nothing and is left out. details: url, text."""
    distinct = details.filter("text <> ''").groupBy("url").agg(F.min("text").alias("text"))
    own = distinct.groupBy("text").agg(F.count(F.lit(1)).alias("_pages"), F.min("url").alias("_url")).filter("_pages = 1").select("_url", "text")
    out = candidates.join(own, candidates["link"] == own["_url"], "left")
    return out.withColumn("description", F.when(F.coalesce("description", F.lit("")) == "", F.coalesce("text", F.lit(""))).otherwise(F.col("description"))).drop("_url", "text")
