"""Projections of the driver's tables to listings, interactions and documents, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import model
from marquee.operators.query import numbered

WEEK = ("1998-03-02", "1998-03-08")
TODAY = "1998-03-04"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: read(spark, sf_dir, n)
    # dates as text before the rows are numbered: filters that move below the joins would format them anew for each use
    day = lambda date: date.cast("date").cast("string")
    dated = t("lineitem").withColumns({"_ship": day(F.col("l_shipdate")), "_end": day(F.date_add(F.col("l_shipdate").cast("date"), (F.col("l_linenumber") % 7).cast("int")))})
    line = numbered(dated, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    rows = (
        line.join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    part, number, quantity = F.col("l_partkey"), F.col("l_linenumber"), F.col("l_quantity").cast("long")
    ship, end = F.col("_ship"), F.col("_end")
    kind = F.element_at(F.array(*map(F.lit, ("Public Lecture", "Workshop / Class", "Concert / Music", "Social / Meetup", "Arts / Exhibition", "Community / Other"))), (part % 6).cast("int") + 1)
    tag_text = F.concat(F.col("p_name"), F.lit(" "), F.lower("p_type"))
    return rows.select(
        "ord",
        F.lower("r_name").alias("city_key"),
        F.col("p_name").alias("title"),
        F.when(part % 50 == 0, "").when(part % 3 == 0, ship).otherwise(F.concat(ship, F.lit("T"), F.lpad((part % 24).cast("string"), 2, "0"), F.lit(":00:00"))).alias("datetime_iso"),
        F.when((part % 50 == 0) | (number % 3 == 0), "").otherwise(end).alias("datetime_end_iso"),
        F.concat("s_name", F.lit(", "), "n_name").alias("location"),
        F.col("s_name").alias("venue_name"),
        F.when(quantity % 11 != 0, (1 + quantity % 10).cast("double")).alias("score"),
        kind.alias("category"),
        F.split(tag_text, " ").alias("tags"),
        F.col("l_returnflag").alias("provider"),
        (part % 2 == 0).alias("social"),
        (part % 5 == 0).alias("creative"),
        (part % 7 == 0).alias("intellectual"),
        (part % 11 == 0).alias("hands_on"),
        part.alias("item"),
        F.concat("p_name", F.lit("|"), F.when(part % 50 == 0, "").otherwise(ship)).alias("event_key"),
    )


def week_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings that start in the week."""
    return listing(spark, sf_dir).filter(F.substring("datetime_iso", 1, 10).between(*WEEK))


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type").isin("purchase", "signup"), "like").when(F.col("event_type") == "error", "dislike").otherwise("share")
    return read(spark, sf_dir, "events").select("event_id", "user_id", "ts", kind.alias("kind"), (F.col("event_id") % 200 + 1).alias("item"))


SQL_LISTING = """v_listing AS (
SELECT row_number() OVER (ORDER BY l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax) AS ord,
  lower(r.r_name) AS city_key, p.p_name AS title,
  CASE WHEN l.l_partkey % 50 = 0 THEN '' WHEN l.l_partkey % 3 = 0 THEN strftime(l.l_shipdate, '%Y-%m-%d')
    ELSE concat(strftime(l.l_shipdate, '%Y-%m-%d'), 'T', lpad(CAST(l.l_partkey % 24 AS VARCHAR), 2, '0'), ':00:00') END AS datetime_iso,
  CASE WHEN l.l_partkey % 50 = 0 OR l.l_linenumber % 3 = 0 THEN '' ELSE strftime(l.l_shipdate + INTERVAL 1 DAY * (l.l_linenumber % 7), '%Y-%m-%d') END AS datetime_end_iso,
  concat(s.s_name, ', ', n.n_name) AS location, s.s_name AS venue_name,
  CASE WHEN CAST(l.l_quantity AS BIGINT) % 11 = 0 THEN NULL ELSE CAST(1 + (CAST(l.l_quantity AS BIGINT) % 10) AS DOUBLE) END AS score,
  CASE l.l_partkey % 6 WHEN 0 THEN 'Public Lecture' WHEN 1 THEN 'Workshop / Class' WHEN 2 THEN 'Concert / Music' WHEN 3 THEN 'Social / Meetup' WHEN 4 THEN 'Arts / Exhibition' ELSE 'Community / Other' END AS category,
  string_split(concat(p.p_name, ' ', lower(p.p_type)), ' ') AS tags, l.l_returnflag AS provider,
  l.l_partkey % 2 = 0 AS social, l.l_partkey % 5 = 0 AS creative, l.l_partkey % 7 = 0 AS intellectual, l.l_partkey % 11 = 0 AS hands_on, l.l_partkey AS item,
  concat(p.p_name, '|', CASE WHEN l.l_partkey % 50 = 0 THEN '' ELSE strftime(l.l_shipdate, '%Y-%m-%d') END) AS event_key
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
v AS (SELECT *, nullif(datetime_iso[1:10], '') AS d, coalesce(nullif(datetime_end_iso[1:10], ''), nullif(datetime_iso[1:10], '')) AS e,
  coalesce(nullif(datetime_iso, ''), '9999') AS sd, coalesce(nullif(datetime_end_iso, ''), '9999') AS se, coalesce(score, 0) AS sc FROM v_listing)"""
SQL_INTERACTIONS = """v_interaction AS (SELECT event_id, user_id, ts,
  CASE WHEN event_type IN ('purchase', 'signup') THEN 'like' WHEN event_type = 'error' THEN 'dislike' ELSE 'share' END AS kind, event_id % 200 + 1 AS item FROM events)"""


def sql_implied(table: str, tags: str, passes: int = 4) -> tuple[str, str]:
    """CTEs that add to the column `tags` of a table all that they imply, and the name of the last."""
    rules = ", ".join(f"CASE WHEN regexp_matches(t, '{'|'.join(p)}') THEN '{name}' END" for name, p in model.IMPLIED_TAGS.items())
    ctes = []
    for i in range(passes):
        ctes.append(f"{table}_a{i} AS (SELECT * REPLACE (list_concat({tags}, flatten(list_transform({tags}, lambda t: list_filter([{rules}], lambda y: y IS NOT NULL)))) AS {tags}) FROM {table if i == 0 else f'{table}_b{i - 1}'})")
        ctes.append(f"{table}_b{i} AS (SELECT * REPLACE (list_filter({tags}, lambda z, k: list_position({tags}, z) = k) AS {tags}) FROM {table}_a{i})")
    return ",\n".join(ctes), f"{table}_b{passes - 1}"
