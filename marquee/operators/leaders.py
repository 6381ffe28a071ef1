"""Duplicates by order: rows that resemble an earlier kept row go. And keys that match by their end, if just one does.

What a row-by-row pass decides depends on what it kept before, along chains. Here similar titles of a block are joined first, by sets
of bigrams that share a rare one, and then rounds decide: a title with no earlier similar one left open is kept, one that is similar
to a kept one goes. There are as many rounds as the longest chain, not as rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import listing as L
from marquee.operators.dedupe import _kept

ALIKE = 0.85
PREFIX = 6


def similar_titles(titles: DataFrame, alike: float = ALIKE) -> DataFrame:
    """block, a, b of titles (block, t; each once) of which one starts the other, both of 6 letters at least, or whose dice is over `alike`; a < b.

    A pair over the threshold shares one of the first bigrams of each, rarest first; prefixes share their first letters. Both are
    equi-joins with the block, so no title meets all others of it.
    """
    rows = titles.withColumn("g", L.numbered_bigrams(F.col("t")))
    grams = rows.select("block", "t", F.size("g").alias("n"), F.explode("g").alias("gram"))
    common = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("titles"))
    ranked = grams.join(common, "gram").groupBy("block", "t").agg(F.array_sort(F.collect_list(F.struct("titles", "gram"))).alias("by"), F.max("n").alias("n"))
    # 2 * shared > alike * (n + m) and shared <= m give shared > n * alike / (2 - alike)
    first = F.col("n") - F.floor(F.col("n") * F.lit(alike / (2 - alike))).cast("int")
    lead = ranked.select("block", "t", "n", F.explode(F.transform(F.slice("by", F.lit(1), F.greatest(first, F.lit(1))), lambda s: s["gram"])).alias("gram"))
    other = lead.select("block", "gram", F.col("t").alias("b"), F.col("n").alias("m"))
    close = lead.withColumnRenamed("t", "a").join(other, ["block", "gram"]).filter((F.col("a") < F.col("b")) & (2 * F.least("n", "m") > alike * (F.col("n") + F.col("m")))).select("block", "a", "b").distinct()
    sets = rows.select("block", "t", "g")
    close = close.join(sets.withColumnsRenamed({"t": "a", "g": "x"}), ["block", "a"]).join(sets.withColumnsRenamed({"t": "b", "g": "y"}), ["block", "b"])
    close = close.filter(2.0 * F.size(F.array_intersect("x", "y")) / (F.size("x") + F.size("y")) > alike).select("block", "a", "b")
    head = rows.filter(F.length("t") >= PREFIX).select("block", F.substring("t", 1, PREFIX).alias("head"), "t")
    starts = head.withColumnRenamed("t", "a").join(head.withColumnRenamed("t", "b"), ["block", "head"]).filter((F.col("a") < F.col("b")) & F.startswith("b", "a")).select("block", "a", "b")
    return close.unionByName(starts).distinct()


def leaders(rows: DataFrame, order: str, title: Column, block: Column, most_rounds: int = 1000) -> DataFrame:
    """The rows that a pass in order keeps: a row goes if its title is like that of a kept row of its block.

    Rows without a block or with an empty title always stay. Of equal titles of a block the first in order stands for all. order must be unique.
    """
    keyed = rows.withColumn("_block", block).withColumn("_t", L.normal_text(title))
    free = F.col("_block").isNull() | (F.coalesce("_t", F.lit("")) == "")
    firsts = _kept(keyed.filter(~free).groupBy(F.col("_block").alias("block"), F.col("_t").alias("t")).agg(F.min(order).alias("at")))
    pairs = similar_titles(firsts.select("block", "t"))
    at = lambda side, name: firsts.select("block", F.col("t").alias(side), F.col("at").alias(name))
    pairs = pairs.join(at("a", "i"), ["block", "a"]).join(at("b", "j"), ["block", "b"])
    edges = _kept(pairs.select(F.least("i", "j").alias("before"), F.greatest("i", "j").alias("after")))
    gone = edges.select(F.col("after").alias("at")).limit(0)
    for _ in range(most_rounds):
        # open edges end in rows that are not decided; a row that no open edge ends in is kept
        if edges.isEmpty():
            break
        kept = edges.select(F.col("before").alias("at")).distinct().join(edges.select(F.col("after").alias("at")).distinct(), "at", "left_anti")
        out = _kept(edges.join(kept, edges["before"] == kept["at"], "left_semi").select(F.col("after").alias("at")).distinct())
        gone = gone.unionByName(out)
        left = edges.join(out, edges["before"] == out["at"], "left_anti")
        edges = _kept(left.join(out, left["after"] == out["at"], "left_anti"))
    else:
        raise RuntimeError(f"leaders not settled after {most_rounds} rounds")
    stay = firsts.select("at").join(gone, "at", "left_anti").withColumnRenamed("at", order)
    return keyed.filter(free).drop("_block", "_t").unionByName(keyed.filter(~free).drop("_block", "_t").join(stay, order, "left_semi").select(*rows.columns))


def only_match_by_end(rows: DataFrame, key: str, others: DataFrame, other_key: str, between: str = ": ") -> DataFrame:
    """rows with the one of others, columns prefixed with match_, whose key equals theirs or ends in `between` and theirs; null where none or several fit.

    Every end of the other keys becomes a key of an equi-join, and ends that several have are dropped before it. Null and empty keys fit nothing.
    """
    parts = F.split(F.col(other_key), between)
    ends = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), between))
    of = F.struct(*(F.col(c).alias(f"match_{c}") for c in others.columns))
    exploded = others.filter(F.col(other_key) != "").select(F.explode(F.array_distinct(ends)).alias("_end"), of.alias("_of"))
    one = exploded.filter("_end <> ''").groupBy("_end").agg(F.count(F.lit(1)).alias("_n"), F.first("_of").alias("_of")).filter("_n = 1")
    return rows.join(one, rows[key] == one["_end"], "left").select(*(rows[c] for c in rows.columns), "_of.*")
