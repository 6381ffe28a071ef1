"""Duplicate listings: blocked fuzzy pairs, components, survivors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.functions import listing as L


def _titled(events: DataFrame, by: tuple[str, ...], place: Column | None, link: Column | None) -> DataFrame:
    p = F.lit("") if place is None else L.place_text(place)
    s = F.lit(False) if link is None else F.coalesce(L.specific_link(link), F.lit(False))
    return events.select(*by, "ord", L.day(F.col("datetime_iso")).alias("d"), L.normal_text(F.col("title")).alias("t"), p.alias("p"), s.alias("s")).filter("d is not null and t <> ''")


#: Similarity from which titles are one, from which somebody has to say, and how many pairs are asked about.
SAME, MAYBE, ASKED = 0.85, 0.45, 3000


def block_pairs(events: DataFrame, *by: str, place: Column | None = None, link: Column | None = None, maybe: float = MAYBE) -> DataFrame:
    """Pairs a < b (by ord) on the same day or neighbouring days, with the block as an equi-join key, their similarity, and whether they are settled as one.

    On one day titles must match, and places agree unless the title is distinctive. On neighbouring days titles must be alike,
    places agree, and just one of the two have a link of its own. Without place or link nothing is known of them. kind is settled, candidate or none:
    candidates are matching titles at places that don't agree, and titles alike by `maybe` at least; neither is merged without an answer.
    Rows with the same block, title, place and link are compared once through their representatives, so a title repeated n times costs n rows, not n squared."""
    distinct = _titled(events, by, place, link).groupBy(*by, "d", "t", "p", "s").agg(F.min("ord").alias("ord")).withColumns({"g": L.coded_bigrams(F.col("t")), "q": L.coded_bigrams(F.col("p"))})
    side = lambda n, ord_: [F.col(c).alias(f"{c}{n}") for c in ("d", "t", "p", "s", "g", "q")] + [F.col("ord").alias(ord_)]
    left = distinct.select(*by, _days(), *side(1, "a"))
    right = distinct.select(*by, F.col("d").alias("block"), *side(2, "b"))
    pairs = _met(left, right, *by, "block").filter("d1 < d2 or (d1 = d2 and a < b)")
    same_day, agree, match = F.col("d1") == F.col("d2"), _agree(), L.titles_match(F.col("t1"), F.col("t2"), F.col("sim"))
    sim = L.set_dice(F.col("t1"), F.col("t2"), F.col("g1"), F.col("g2"))
    settled = F.when(same_day, match & (agree | L.distinctive_title(F.col("t1")))).otherwise((F.col("sim") >= 0.85) & agree & (F.col("s1") != F.col("s2")))
    open_ = F.when(same_day, match | ((F.col("sim") >= maybe) & (F.col("sim") < SAME))).otherwise(F.col("sim") >= maybe)
    kind = F.when(F.col("settled"), "settled").when(open_, "candidate").otherwise("none")
    # A filter on what is computed here would move below it and compute it for each use, were it not for the generators.
    near = pairs.withColumn("sim", F.explode(F.array(sim))).withColumn("settled", F.explode(F.array(settled)))
    return near.select(*by, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), same_day.alias("same_day"), "sim", "settled", kind.alias("kind"))


def _days() -> Column:
    """The day of a row and the next one, as blocks."""
    return F.explode(F.array("d", F.date_format(F.date_add(F.col("d").cast("date"), 1), "yyyy-MM-dd"))).alias("block")


#: Parts into which the left rows of one key are dealt, so that a large block is not one task.
PARTS = 8


def _met(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """left.join(right, keys) where rows are few and pairs many: adaptive execution, which goes by bytes, would put all of it in one task."""
    n = max(2, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = left.withColumn("_part", F.pmod(F.xxhash64("t1", "a" if "a" in left.columns else "d1"), F.lit(PARTS)))
    spread = right.withColumn("_part", F.explode(F.array(*(F.lit(i).cast("long") for i in range(PARTS)))))
    return dealt.repartition(n, *keys, "_part").join(spread.repartition(n, *keys, "_part").hint("merge"), [*keys, "_part"]).drop("_part")


def _agree() -> Column:
    p, q = F.col("p1"), F.col("p2")
    return L.venues_agree(p, q, L.set_dice(p, q, F.col("q1"), F.col("q2")))


def settled_links(events: DataFrame, *by: str, place: Column | None = None, link: Column | None = None) -> DataFrame:
    """a, b of the settled pairs of block_pairs. Titles are compared once for each day, and places only under titles that match."""
    rows = _titled(events, by, place, link).groupBy(*by, "d", "t", "p", "s").agg(F.min("ord").alias("ord"))
    titles = rows.select(*by, "d", "t", "s").distinct().withColumn("g", L.coded_bigrams(F.col("t")))
    side = lambda df, n, *more: df.select(*by, *(F.col(c).alias(f"{c}{n}") for c in ("d", "t", "s")), *more)
    left, right = side(titles, 1, F.col("g").alias("g1"), _days()), side(titles, 2, F.col("g").alias("g2"), F.col("d").alias("block"))
    t1, t2, same_day = F.col("t1"), F.col("t2"), F.col("d1") == F.col("d2")
    alike = _met(left, right, *by, "block").withColumn("sim", F.explode(F.array(L.set_dice(t1, t2, F.col("g1"), F.col("g2")))))
    alike = alike.filter(F.when(same_day, L.titles_match(t1, t2, F.col("sim"))).otherwise((F.col("sim") >= 0.85) & (F.col("s1") != F.col("s2")))).drop("block", "sim", "g1", "g2")
    of = lambda n, ord_: side(rows.withColumn("q", L.coded_bigrams(F.col("p"))), n, F.col("p").alias(f"p{n}"), F.col("q").alias(f"q{n}"), F.col("ord").alias(ord_))
    firsts = alike.join(of(1, "a"), [*by, "d1", "t1", "s1"])
    pairs = _met(firsts, of(2, "b"), *by, "d2", "t2", "s2").filter("d1 < d2 or a < b")
    return pairs.filter(F.when(same_day, L.distinctive_title(t1) | _agree()).otherwise(_agree())).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def to_ask(pairs: DataFrame, *by: str, most: int = ASKED) -> DataFrame:
    """The candidates of block_pairs that are asked about: the first `most` of each `by`, by a and b."""
    w = Window.partitionBy(*by).orderBy("a", "b")
    return pairs.filter("kind = 'candidate'").withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= most).drop("_n")


def confirmed(pairs: DataFrame, answers: DataFrame) -> DataFrame:
    """a, b of the pairs that are one: settled ones, and candidates with an answer (a, b, same) that says so. No answer, null and contradictory ones mean no."""
    yes = answers.groupBy("a", "b").agg(F.min(F.coalesce("same", F.lit(False))).alias("_same")).filter("_same").select("a", "b")
    said = pairs.filter("kind = 'candidate'").select("a", "b").join(yes, ["a", "b"], "left_semi")
    return pairs.filter("kind = 'settled'").select("a", "b").unionByName(said).distinct()


def dedupe_stats(events: DataFrame, pairs: DataFrame, asked: DataFrame, links: DataFrame, comps: DataFrame) -> DataFrame:
    """One row: input, settled_pairs, asked_pairs, confirmed, removed, output. comps: ord, comp of all events."""
    n = lambda df, name, x=F.count(F.lit(1)): df.agg(x.cast("long").alias(name))
    settled = pairs.filter("kind = 'settled'")
    parts = [n(events, "input"), n(settled, "settled_pairs"), n(asked, "asked_pairs"), n(links.join(settled, ["a", "b"], "left_anti"), "confirmed"), n(comps.filter("ord <> comp"), "removed"), n(comps.filter("ord = comp"), "output")]
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part)  # one row each
    return out


def same_title_links(events: DataFrame, *by: str, place: Column | None = None) -> DataFrame:
    """Each later row of a day, title and place, linked to the first."""
    rows = _titled(events, by, place, None)
    first = rows.groupBy(*by, "d", "t", "p").agg(F.min("ord").alias("a"))
    return rows.join(first, [*by, "d", "t", "p"]).filter("ord > a").select("a", F.col("ord").alias("b"))


def components(nodes: DataFrame, links: DataFrame, most_rounds: int = 200) -> DataFrame:
    """ord, comp: the least ord reachable over links a, b. Labels spread to neighbours and jump to their own label until none changes; an error if that takes more than most_rounds."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = _kept(both)
    labels = _kept(nodes.select("ord", F.col("ord").alias("comp")))
    for _ in range(most_rounds):
        heard = both.join(labels.withColumnRenamed("ord", "b"), "b").groupBy("a").agg(F.min("comp").alias("heard"))
        step = labels.join(heard, labels["ord"] == heard["a"], "left").select("ord", F.col("comp").alias("old"), F.least("comp", F.coalesce("heard", "comp")).alias("mid"))
        jump = step.select(F.col("ord").alias("mid"), F.col("mid").alias("far"))
        new = _kept(step.join(jump, "mid", "left").select("ord", "old", F.least("mid", F.coalesce("far", "mid")).alias("comp")))
        labels = new.select("ord", "comp")
        if new.filter("comp <> old").isEmpty():
            return labels
    raise RuntimeError(f"components not settled after {most_rounds} rounds")


def _kept(df: DataFrame) -> DataFrame:
    """Lineage cut in the session's spark.checkpoint.dir. Only a session on this machine alone gets a folder made where that is unset."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if folder is None:
            import tempfile

            folder = tempfile.mkdtemp(prefix="marquee-")
        context.setCheckpointDir(folder)
    return df.checkpoint()


def survivors(events: DataFrame, comps: DataFrame, completeness: str = "completeness") -> DataFrame:
    """The most complete row of each component, the earliest of equals, with the size of its group."""
    rows = events.join(comps, "ord")
    w = Window.partitionBy("comp").orderBy(F.desc(completeness), "ord")
    return rows.withColumn("group_size", F.count(F.lit(1)).over(Window.partitionBy("comp"))).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
