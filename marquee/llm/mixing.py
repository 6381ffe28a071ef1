"""Mixing sources to target weights by Pareto order sampling.

A document's size is its number of words. All sources together take SHARE times the sum of sizes, shared by weight; a
source's target stops at LIMIT times its size, and what it can't take goes to the others by weight. A source first takes
every document as many whole times as its target allows. The rest of the target is drawn: with f the rest over the
source's size and m its mean size, a document of size s has the inclusion probability p = f * 2m / (m + s); p of 1 or
more is a certain copy, all others are ranked by the odds of a random number over the odds of p (Pareto order sampling),
and taken in this order up to the fixed total that comes nearest to the target. The random number is a hash of seed,
doc_id and text, so reruns agree and no state is kept.

No source is ever sorted whole: ranks fall into BINS bins, a source's bins are summed, and the bin that holds the end of
its sample is divided into BINS again, LEVELS times in all. Of the last one only the sums of equal ranks are ordered; all
certain copies have rank 0 and are one such sum. The table of sources is small beside the documents; its weights need one
total order.

Cases: a null text has size 0; null is a source like others and the last; rows that repeat doc_id and text have one rank
and are taken or left together; sources without words have target 0; an empty table gives no rows; other columns of
any name are carried by mix() and ignored by amounts().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.llm import common

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2.0
SEED = "mix"
BINS = 256
LEVELS = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """source, source_size, source_docs, target from rows of source and size."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    filling = Window.orderBy("room", "place").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("room", "place").rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    shared = (
        by_source.withColumn("place", place)
        .withColumn("weight", weight)
        .withColumn("most", limit * F.col("source_size"))
        .withColumn("room", F.col("most") / F.col("weight"))
        .withColumn("level", (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(filling), F.lit(0.0))) / F.sum("weight").over(rest))
        .withColumn("level", F.min_by(F.when(F.col("level") <= F.col("room"), F.col("level")), F.when(F.col("level") <= F.col("room"), F.struct("room", "place"))).over(everything))
    )
    return shared.select("source", "source_size", "source_docs", F.least(F.col("weight") * F.col("level"), F.col("most")).alias("target"))


def random_number(doc_id: Column, text: Column, seed: str) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def _ranked(rows: DataFrame) -> DataFrame:
    """Adds whole, rest (words still to draw), rank and bin to rows that have size, u and their source's columns."""
    f = F.col("rest") / F.col("source_size")
    mean = F.col("source_size") / F.col("source_docs")
    p = f * 2.0 * mean / (mean + F.col("size"))
    u = F.col("u")
    rank = F.when(F.col("rest") <= 0, None).when(p >= 1, 0.0).otherwise((u / (1 - u)) * ((1 - p) / p))
    return (
        rows.withColumn("whole", F.when(F.col("target") <= 0, 0).otherwise(F.floor(F.col("target") / F.col("source_size"))).cast("int"))
        .withColumn("rest", F.when(F.col("target") <= 0, 0.0).otherwise(F.col("target") - F.col("whole") * F.col("source_size")))
        .withColumn("rank", rank)
    )


def _cell(level: int) -> Column:
    """The number of the bin that holds a rank when the line of ranks is divided so many times."""
    return F.floor(float(BINS**level) * (F.col("rank") / (1 + F.col("rank"))))


def _ends(ranked: DataFrame) -> DataFrame:
    """source, last_cell, last_rank: where each source's sample ends."""
    ranked = ranked.filter("rank is not null").select("source", "size", "rest", "rank")
    last = None
    for level in range(1, LEVELS + 1):
        inside = ranked.withColumn("before", F.lit(0).cast("long")) if last is None else _inside(ranked, last, level - 1)
        bins = inside.groupBy("source", _cell(level).alias("cell")).agg(F.sum("size").alias("words"), F.max("rest").alias("rest"), F.max("before").alias("before"))
        so_far = F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("cell"))
        ends = bins.withColumn("so_far", so_far).filter("so_far >= rest").groupBy("source").agg(F.min(F.struct("cell", (F.col("so_far") - F.col("words")).alias("before"))).alias("end"))
        last = common.cut(ends.select("source", F.col("end.cell").alias("last_cell"), F.col("end.before").alias("before")))
    same = _inside(ranked, last, LEVELS).groupBy("source", "rank").agg(F.sum("size").alias("words"), F.max("rest").alias("rest"), F.max("before").alias("before"), F.max("last_cell").alias("last_cell"))
    same = same.withColumn("upto", F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("rank")))
    nearer = F.col("upto") - F.col("rest") <= F.col("rest") - (F.col("upto") - F.col("words"))
    return same.groupBy("source").agg(F.max("last_cell").alias("last_cell"), F.max(F.when(nearer, F.col("rank"))).alias("last_rank"))


def _inside(ranked: DataFrame, last: DataFrame, level: int) -> DataFrame:
    return common.with_table(ranked, last, ["source"]).filter(_cell(level) == F.col("last_cell"))


def _copies(ranked: DataFrame, ends: DataFrame) -> DataFrame:
    cell = _cell(LEVELS)
    drawn = (cell < F.col("last_cell")) | ((cell == F.col("last_cell")) & (F.col("rank") <= F.col("last_rank")))
    return common.with_table(ranked, ends, ["source"]).withColumn("copies", F.col("whole") + F.coalesce(drawn, F.lit(False)).cast("int"))


def _sized(docs: DataFrame, seed: str, *kept: Column) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(*kept, F.col("source").cast("string").alias("source"), common.n_words(text).alias("size"), random_number(F.col("doc_id"), text, seed).alias("u"))


def amounts(docs: DataFrame, seed: str = SEED, **shares) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    sized = common.cut(_sized(docs, seed, F.col("doc_id").cast("long").alias("doc_id")))
    ranked = _ranked(common.with_table(sized, common.cut(source_targets(sized, **shares)), ["source"]))
    mixed = _copies(ranked, common.cut(_ends(ranked)))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, seed: str = SEED, **shares) -> DataFrame:
    """The mix: the rows of docs, each as many times as it is taken."""
    slim = common.cut(_sized(docs, seed))
    by_source = common.cut(source_targets(slim, **shares))
    ends = common.cut(_ends(_ranked(common.with_table(slim, by_source, ["source"]))))
    rows = _copies(_ranked(common.with_table(_sized(docs, seed, F.struct("*").alias("row")), by_source, ["source"])), ends)
    return common.times(rows.select("row", "copies"), F.col("copies")).select("row.*")


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    (CAST(('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 13)) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS source_docs FROM sized GROUP BY source),
weighed AS (
  SELECT *, (ARRAY[5, 2, 1])[(place % 3 + 1)::INT] AS weight, 2.0::DOUBLE * source_size AS most
  FROM (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place FROM sources)),
levels AS (
  SELECT *, most / weight AS room,
    (1.5::DOUBLE * CAST(sum(source_size) OVER () AS BIGINT) - coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
      / CAST(sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level
  FROM weighed),
targets AS (
  SELECT source, source_size, source_docs,
    least(weight * (SELECT level FROM levels WHERE level <= room ORDER BY room, place LIMIT 1), most) AS target
  FROM levels),
parts AS (
  SELECT s.*, t.source_size, t.source_docs, t.target,
    CASE WHEN target <= 0 THEN 0 ELSE CAST(floor(target / source_size) AS BIGINT) END AS whole
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
chances AS (
  SELECT *, CASE WHEN target <= 0 THEN 0.0::DOUBLE ELSE target - whole * source_size END AS rest,
    source_size::DOUBLE / source_docs AS mean
  FROM parts),
ranked AS (
  SELECT *, CASE WHEN rest <= 0 THEN NULL WHEN p >= 1 THEN 0.0::DOUBLE ELSE (u / (1 - u)) * ((1 - p) / p) END AS rank
  FROM (SELECT *, CASE WHEN rest > 0 THEN rest / source_size * 2.0::DOUBLE * mean / (mean + size) END AS p FROM chances)),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
    sum(size) OVER (PARTITION BY source, rank) AS same
  FROM ranked WHERE rank IS NOT NULL
  UNION ALL SELECT *, NULL, NULL FROM ranked WHERE rank IS NULL)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN rank IS NOT NULL AND upto - rest <= rest - (upto - same) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM summed
"""
