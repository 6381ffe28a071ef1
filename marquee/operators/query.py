"""The reader's query: filter bar, sections, facets, counts, ordering, grouping."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import zip_longest
from math import isqrt
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee import model
from marquee.functions import listing as L


@dataclass(frozen=True)
class FilterState:
    """What a reader asks for. category None, venue None, empty tuples and query "" ask for nothing."""

    category: str | None = None
    venue: str | None = None
    first: str | None = None
    last: str | None = None
    tags: tuple[str, ...] = ()
    vibes: tuple[str, ...] = ()
    bands: tuple[str, ...] = ()
    query: str = ""
    least_score: float = model.LOW_SCORE
    past: str = "no-past"
    today: str = ""

    def active(self) -> bool:
        return self != FilterState(today=self.today)


_LABELS: dict[int, list[int]] = {}


def numbered(df: DataFrame, *keys: str, name: str = "ord", ranges: int | None = None) -> DataFrame:
    """Adds a running number in the order of keys without sorting all rows in one task.

    Rows are cut into ranges of the first key at values fixed here, counted once, and each range is numbered for itself from
    the count of those before. Cuts and counts are literals of the plan, so every part of a query that uses it, whatever it
    filters or reads, sees the same numbers; a query that doesn't read the number neither shuffles nor sorts for it. df must
    give the same rows whenever it is read."""
    n = ranges or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = df.agg(F.percentile_approx(keys[0], [i / n for i in range(1, n)], 10_000)).first()[0]
    if not cuts:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*keys)).cast("long"))
    part = F.coalesce(_cuts_below(F.col(keys[0]), sorted(set(cuts))), F.lit(0))
    ranged = df.withColumn("_part", part)
    sizes = {r["_part"]: r["n"] for r in ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before = F.array(*(F.lit(sum(v for k, v in sizes.items() if k < i)).cast("long") for i in range(len(set(cuts)) + 1)))
    # the numbers of ranges as they are would fall on some two thirds of the partitions, several on one
    label = F.get(F.array(*(F.lit(i).cast("long") for i in _labels(df.sparkSession, len(set(cuts)) + 1))), F.col("_part"))
    row = F.row_number().over(Window.partitionBy(label).orderBy(*keys))
    return ranged.withColumn(name, F.get(before, F.col("_part")) + row).drop("_part")


def _labels(spark: SparkSession, n: int) -> list[int]:
    """n different numbers, dealt evenly over the partitions of a shuffle by them."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if tasks not in _LABELS:
        some = spark.range(40 * tasks + 100).select("id", F.pmod(F.hash("id"), F.lit(tasks)).alias("p")).collect()
        of = {}
        for r in sorted(some):
            of.setdefault(r["p"], []).append(r["id"])
        _LABELS[tasks] = [i for turn in zip_longest(*of.values()) for i in turn if i is not None]
    labels = _LABELS[tasks]
    return labels[:n] if n <= len(labels) else list(range(n))


def _cuts_below(key: Column, cuts: list) -> Column:
    """How many of the sorted cuts lie below the key: the run of cuts first, then the place in it, as a row can't look at all of them."""
    step = max(1, isqrt(len(cuts)))
    runs = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    lits = lambda xs: F.array(*map(F.lit, xs))
    below = lambda xs: F.size(F.filter(xs, lambda c: c < key))
    full = below(lits([run[-1] for run in runs]))
    return F.when(full == len(runs), len(cuts)).otherwise(L.let(full, lambda i: i * step + below(F.get(F.array(*map(lits, runs)), i))))


def passes_others(f: FilterState) -> Column:
    """Every condition but the score floor."""
    start, end = F.col("datetime_iso"), F.col("datetime_end_iso")
    parts: list[Column] = [F.lit(True)]
    if f.query.strip():
        hay = L.normal_text(F.concat_ws(" ", "title", "location", "category", F.array_join("tags", " ")))
        parts.append(L.let(hay, lambda h: reduce(and_, [L.token_matches(h, t) for t in f.query.lower().split()])))
    if f.category:
        parts.append(F.col("category") == f.category)
    if f.venue is not None:
        parts.append(F.col("venue_name") == f.venue)
    if f.first and f.last:
        parts.append(L.overlaps(start, end, f.first, f.last))
    if f.tags:
        parts.append(F.size(F.array_except(F.array(*map(F.lit, f.tags)), F.col("tags"))) == 0)
    if f.bands:
        parts.append(F.coalesce(L.band(start).isin(*f.bands), F.lit(False)))
    if f.past != "all" and f.today:
        past = L.is_past(start, end, f.today)
        parts.append(past if f.past == "only-past" else ~past)
    parts += [F.col(v).eqNullSafe(True) for v in f.vibes]
    return reduce(and_, parts)


def apply_filters(events: DataFrame, f: FilterState, hidden: DataFrame | None = None, key: str = "event_key") -> DataFrame:
    """Rows that pass all but the floor, with `low` true where the floor alone hides them."""
    if hidden is not None:
        events = events.join(hidden, key, "left_anti")
    return events.filter(passes_others(f)).withColumn("low", F.coalesce(F.col("score") < f.least_score, F.lit(False)))


def top_picks(events: DataFrame, first: str, last: str, most: int = model.MAX_PICKS, *by: str) -> DataFrame:
    """The best eligible rows of each `by`, with pick_rank."""
    good = events.filter(L.top_pick(F.col("score"), F.col("datetime_iso"), F.col("datetime_end_iso"), first, last))
    w = Window.partitionBy(*by).orderBy(*L.canonical_order(F.col("score"), F.col("datetime_iso"), F.col("ord")))
    return good.withColumn("pick_rank", F.row_number().over(w)).filter(F.col("pick_rank") <= most)


def split_sections(events: DataFrame, saved: DataFrame, first: str, last: str, key: str = "event_key", *by: str) -> DataFrame:
    """Adds section: saved, picks or rest. A key that is picked leaves rest with all its rows."""
    marked = events.join(saved.select(key).distinct().withColumn("_saved", F.lit(True)), key, "left")
    open_rows = marked.filter(F.col("_saved").isNull())
    picks = top_picks(open_rows, first, last, model.MAX_PICKS, *by)
    chosen = picks.select("ord", "pick_rank")
    twins = picks.select(key).distinct().withColumn("_taken", F.lit(True))
    out = marked.join(chosen, "ord", "left").join(twins, key, "left")
    section = F.when(F.col("_saved"), "saved").when(F.col("pick_rank").isNotNull(), "picks").when(F.col("_taken").isNull(), "rest")
    return out.withColumn("section", section).filter("section is not null").drop("_saved", "_taken")


def facets(events: DataFrame) -> DataFrame:
    """facet, value, n, first: categories, venues and tags without the names of vibes."""
    part = lambda name, df: df.groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first")).select(F.lit(name).alias("facet"), "value", "n", "first")
    tags = events.select("ord", F.explode("tags").alias("value")).filter(~F.lower("value").isin(*model.VIBE_LABELS))
    return part("category", events.select("ord", F.col("category").alias("value")).filter("value <> ''")).unionByName(
        part("venue", events.select("ord", F.col("venue_name").alias("value")).filter("value <> ''"))
    ).unionByName(part("tag", tags))


def live_counts(events: DataFrame, vibes: tuple[str, ...] = model.VIBES) -> DataFrame:
    tags = events.select(F.explode("tags").alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n")).select(F.lit("tag").alias("kind"), "name", "n")
    counts = events.agg(*(F.count_if(F.col(v)).alias(v) for v in vibes))
    return tags.unionByName(counts.unpivot([], list(vibes), "name", "n").select(F.lit("vibe").alias("kind"), "name", "n"))


def date_bounds(events: DataFrame, week_end: str, *by: str) -> DataFrame:
    latest = F.coalesce(F.max(L.last_day_of(F.col("datetime_iso"), F.col("datetime_end_iso"))), F.lit(week_end))
    cap = F.date_format(F.last_day(F.lit(week_end).cast("date")), "yyyy-MM-dd")
    return events.groupBy(*by).agg(latest.alias("latest")).select(*by, F.least("latest", cap).alias("date_max"))


def coverage(events: DataFrame, week_start: str, week_end: str, today: str, *by: str) -> DataFrame:
    starts = L.day(F.col("datetime_iso"))
    monday = F.date_format(F.date_trunc("week", F.lit(today).cast("date")), "yyyy-MM-dd")
    out = events.groupBy(*by).agg(F.min(starts).alias("a"), F.max(starts).alias("b"))
    return out.select(*by, F.greatest(F.least("a", F.lit(week_start)), monday).alias("week_start"), F.greatest("b", F.lit(week_end)).alias("week_end"))


def date_groups(events: DataFrame, first: str, last: str, *by: str) -> DataFrame:
    """Adds bucket (a day, ongoing, later, undated), its place and the row's place in it."""
    start = L.day(F.col("datetime_iso"))
    bucket = F.when(start.isNull(), "undated").when(start < first, "ongoing").when(start > last, "later").otherwise(start)
    rows = events.withColumn("bucket", bucket).withColumn("bucket_place", F.when(F.col("bucket") == "ongoing", 1).when(F.col("bucket") == "later", 2).when(F.col("bucket") == "undated", 3).otherwise(0))
    score, date, end = F.coalesce(F.col("score"), F.lit(0.0)), L.sort_date(F.col("datetime_iso")), L.sort_date(F.col("datetime_end_iso"))
    in_days = F.col("bucket_place") == 0
    one = F.when(in_days, F.lit("")).when(F.col("bucket") == "ongoing", end).otherwise(date)
    w = Window.partitionBy(*by, "bucket").orderBy(one, score.desc(), F.when(in_days, date), "ord")
    return rows.withColumn("place", F.row_number().over(w))


def category_groups(events: DataFrame, *by: str) -> DataFrame:
    fixed = F.array(*map(F.lit, model.CATEGORIES))
    rows = events.withColumn("grp", F.coalesce(F.nullif("category", F.lit("")), F.lit("Uncategorised")))
    score = F.coalesce(F.col("score"), F.lit(0.0))
    w = Window.partitionBy(*by, "grp").orderBy(L.sort_date(F.col("datetime_iso")), score.desc(), "ord")
    return rows.withColumn("grp_place", F.nullif(F.array_position(fixed, F.col("grp")), F.lit(0))).withColumn("place", F.row_number().over(w))


def expand_days(events: DataFrame, first: str, last: str) -> DataFrame:
    """One row for each day of the window that a listing covers."""
    d = lambda s: F.lit(s).cast("date")
    start, end = L.day(F.col("datetime_iso")).cast("date"), L.last_day_of(F.col("datetime_iso"), F.col("datetime_end_iso")).cast("date")
    a, b = F.greatest(start, d(first)), F.least(end, d(last))
    return events.filter(L.overlaps(F.col("datetime_iso"), F.col("datetime_end_iso"), first, last)).filter(a <= b).withColumn("day", F.explode(F.sequence(a, b)))


def preferred_order(events: DataFrame, prefs: DataFrame, *by: str) -> DataFrame:
    """Adds tier and place: what a reader wants first, what they don't last, the canonical order within. prefs: one row of each `by` at most, with wanted and unwanted tags.

    Rows are counted by tier, score and day first, so a task sorts one day of a tier and score, never a whole `by`."""
    tiered = events.join(prefs, list(by), "left").withColumn("tier", L.pref_tier(F.col("tags"), F.col("wanted"), F.col("unwanted"))).drop("wanted", "unwanted")
    date = L.sort_date(F.col("datetime_iso"))
    rows = tiered.withColumn("_score", F.coalesce(F.col("score"), F.lit(0.0))).withColumn("_day", F.substring(date, 1, 10))
    group = [*by, "tier", "_score", "_day"]
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy(F.desc("tier"), F.desc("_score"), "_day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    days = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", before)
    days = days.select("_before", *(F.col(c).alias(f"_of_{i}") for i, c in enumerate(group)))
    same = reduce(and_, [rows[c].eqNullSafe(days[f"_of_{i}"]) if c in by else rows[c] == days[f"_of_{i}"] for i, c in enumerate(group)])
    place = F.col("_before") + F.row_number().over(Window.partitionBy(*group).orderBy(date, "ord"))
    return rows.join(days, same).withColumn("place", place).drop("_score", "_day", "_before", *days.columns)


def window_order(events: DataFrame, first: str, last: str, limit: int, *by: str) -> DataFrame:
    """The first `limit` rows of each `by`, those that start in the window before others, with totals."""
    inside = F.coalesce(L.day(F.col("datetime_iso")).between(first, last), F.lit(False))
    w = Window.partitionBy(*by).orderBy(inside.desc(), "datetime_iso", "ord")
    totals = events.groupBy(*by).agg(F.count(F.lit(1)).alias("total_matched"))
    ranked = events.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= limit)
    return ranked.join(totals, list(by)).withColumn("more_available", F.col("total_matched") > limit)
