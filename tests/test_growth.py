"""What a row costs must not grow with the length of its texts or with how often an expression is named."""

import datetime
import random
import time

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.functions import listing as L
from marquee.operators import corpus, dedupe, query
from marquee.plans import tables


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_identity_of_long_texts(spark):
    def plain(text):
        raw, h = text.encode("utf-16-be"), 0
        for i in range(0, len(raw), 2):
            h = (h * 31 + int.from_bytes(raw[i : i + 2], "big")) & 0xFFFFFFFF
        digits = ""
        while h:
            h, d = divmod(h, 36)
            digits = "0123456789abcdefghijklmnopqrstuvwxyz"[d] + digits
        return digits or "0"

    titles = ["", "a", "Gala 🎭 é", None, "x" * 100_000, "é🎭" * 50_000]
    began = time.time()
    rows = spark.createDataFrame(list(enumerate(titles)), "i int, t string").select("i", L.event_hash(F.col("t"), F.lit(None).cast("string"), F.lit("b"), F.lit("")).alias("h"))
    got = {r["i"]: r["h"] for r in rows.collect()}
    assert got == {i: plain("|".join(x for x in (t, "b", "") if x is not None)) for i, t in enumerate(titles)}
    assert time.time() - began < 30


def test_implied_tags_once(spark):
    words = ["orchestra", "improv", "hiking", "yoga", "rainforest", "opera", "x", "arcade", "brewery", "musical", None, "stand-up", "cinema"]
    pick = random.Random(5)
    lists = [None, [], [None, "x", None], *([pick.choice(words) for _ in range(pick.randrange(8))] for _ in range(40))]
    rows = spark.createDataFrame(list(enumerate(lists)), "i int, tags array<string>")
    slow = rows
    for _ in range(4):
        slow = slow.withColumn("tags", L.implied_once(F.col("tags")))
    fast = corpus.imply_tags(rows)
    assert {r["i"]: r["tags"] for r in fast.collect()} == {r["i"]: r["tags"] for r in slow.collect()}
    assert "RLIKE" not in optimized(fast)


def test_numbering_looks_at_few_cuts(spark):
    keys = [None, -5, *range(0, 300, 3), 1000]
    rows = spark.createDataFrame([(k,) for k in keys], "k long")
    for cuts in ([7], [0, 3, 4], list(range(1, 290, 2))):
        got = rows.select("k", query._cuts_below(F.col("k"), cuts).alias("n")).collect()
        assert all(r["n"] == sum(c < r["k"] for c in cuts if r["k"] is not None) for r in got)
    spread = spark.range(2000).select((F.col("id") * 7 % 2000).alias("k"))
    assert [r["ord"] for r in query.numbered(spread, "k", ranges=100).orderBy("k").collect()] == list(range(1, 2001))


def test_dates_of_listings_are_formatted_once(spark):
    rows = tables.week_listing(spark, "/root/testdata/sf0.001").select("ord", "datetime_iso")
    above = optimized(rows).split("Window [")[0]
    assert "date_format(" not in above and "cast(l_shipdate" not in above


def test_similarity_of_a_pair_once(spark):
    rows = spark.createDataFrame([(1, "red ring", "1998-03-02", 1), (2, "red rings", "1998-03-02", 1)], "ord long, title string, datetime_iso string, all int")
    kept = dedupe.block_pairs(rows, "all").filter("kind <> 'none'").select("a", "b", "kind")
    assert kept.collect() == [(1, 2, "settled")]
    assert optimized(kept).count("array_intersect(") == 1


def test_places_of_useless_tags_once(spark):
    place = F.concat_ws(" ", "c", F.lit("Riverside Hall"))
    rows = spark.createDataFrame([(["riverside", " Live ", "new farm", None, "", "ok"], "x")], "tags array<string>, c string")
    out = rows.select(L.strip_useless(F.col("tags"), F.lit("Brisbane"), place).alias("tags"))
    assert out.first()["tags"] == ["new farm", "ok"]
    inner = optimized(out).split("lambdafunction(filter(")[1]
    assert "split(" not in inner


def test_settled_links_are_those_of_pairs(spark):
    pick = random.Random(7)
    titles = ["red ring", "Red rings", "blue bolt", "blue bolt and nut show", "Blue bolt & nut show!", "", "big gala night of jazz", "big gala night of jaz"]
    places = [None, "", "Town Hall", "The Town Hall, X", "Queensland Performing Arts Centre", "QPAC theatre", "Riverside 12", "Harbour"]
    links = [None, "https://a.example", "https://a.example/x?y=1"]
    rows = [(i, pick.choice("xy"), pick.choice(titles), pick.choice(["1998-03-02T10:00:00", "1998-03-03", "1998-03-04", "", None]), pick.choice(places), pick.choice(links)) for i in range(300)]
    events = spark.createDataFrame(rows, "ord long, city string, title string, datetime_iso string, location string, link string")
    for more in ({}, {"place": F.col("location")}, {"place": F.col("location"), "link": F.col("link")}):
        want = dedupe.block_pairs(events, "city", **more).filter("settled").select("a", "b").collect()
        got = dedupe.settled_links(events, "city", **more).collect()
        assert sorted(want) == sorted(got) and want


def test_implied_tags_of_computed_ones(spark):
    rows = spark.createDataFrame([(["riverside", "hiking"], "Riverside Hall"), (None, "x")], "tags array<string>, p string").repartition(2)
    made = rows.withColumn("tags", L.strip_useless(F.col("tags"), F.lit("c"), F.col("p")))
    out = corpus.imply_tags(made).select(F.filter("tags", lambda t: t != "walking").alias("tags")).collect()
    assert {tuple(r["tags"] or ()) for r in out} == {("hiking", "nature", "outdoor"), ()}


def test_identities_come_from_arrow_buffers(spark):
    texts = ["a", "", "Gala 🎭 é", "late show", "\x7f\x80", "z" * 70]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "i int, t string").repartition(3)
    out = rows.select("i", L._hash31(F.col("t")).alias("h"))
    plain = lambda t: sum(int.from_bytes(t.encode("utf-16-be")[i : i + 2], "big") * 31 ** (len(t.encode("utf-16-be")) // 2 - 1 - i // 2) for i in range(0, len(t.encode("utf-16-be")), 2)) % 2**32
    assert {r["i"]: r["h"] for r in out.collect()} == {i: plain(t) for i, t in enumerate(texts * 3)}
    assert "], 250" in optimized(out)


def test_preferred_places_without_a_task_for_a_city(spark):
    pick = random.Random(3)
    nan = float("nan")
    rows = [(pick.choice(["x", "y", None]), i, pick.choice([None, 0.0, -0.0, 7.0, nan]), pick.choice(["", None, "1998-03-02", "1998-03-02T10:00:00"]), pick.choice([["ring"], ["red", "ring"], [], None])) for i in range(400)]
    events = spark.createDataFrame(rows, "city string, ord long, score double, datetime_iso string, tags array<string>")
    prefs = spark.createDataFrame([("x", ["ring"], ["red"])], "city string, wanted array<string>, unwanted array<string>")
    out = query.preferred_order(events, prefs, "city")
    tiered = events.join(prefs, "city", "left").withColumn("tier", L.pref_tier(F.col("tags"), F.col("wanted"), F.col("unwanted")))
    w = Window.partitionBy("city").orderBy(F.desc("tier"), *L.canonical_order(F.col("score"), F.col("datetime_iso"), F.col("ord")))
    want = {r["ord"]: (r["tier"], r["p"]) for r in tiered.withColumn("p", F.row_number().over(w)).collect()}
    assert {r["ord"]: (r["tier"], r["place"]) for r in out.collect()} == want
    assert "row_number() windowspecdefinition(city" in optimized(out) and "_score" in optimized(out).split("row_number() windowspecdefinition(")[1].split("ASC")[0]


def test_counted_rules_end_by_arithmetic(spark):
    from marquee.operators import recurrence

    schema = "uid int, start timestamp_ntz, freq string, step int, count int, until timestamp_ntz, byday array<string>, bymonthday array<int>, rdates array<timestamp_ntz>, exdates array<timestamp_ntz>"
    at = datetime.datetime
    rows = [(i, at(1997, 12, 30, 9), freq, step, count, None, byday, None, None, None) for i, (freq, step, count, byday) in enumerate([(f, s, n, d) for f in ("DAILY", "WEEKLY") for s in (1, 3) for n in (-1, 0, 1, 5, 65) for d in (None, ["MO", "TH"])])]
    rows.append((len(rows), at(1990, 1, 1, 9), "DAILY", 10**8, 10**6, None, None, None, None, None))
    edge = lambda t: F.lit(t).cast("timestamp_ntz")
    out = recurrence.instances(edge("1998-01-05 00:00:00"), edge("1998-03-05 00:00:00"))
    frame = spark.createDataFrame(rows, schema).select("uid", out.alias("got"))
    for r in frame.collect():
        _, start, freq, step, count, _, byday, *_ = rows[r["uid"]]
        days = [start + datetime.timedelta(days=k) for k in range(1, 4000) if step < 100]
        days = [start, *days]
        week = lambda d: (d - start + datetime.timedelta(days=start.weekday())).days // 7
        fits = lambda d: (byday is None or d.weekday() in (0, 3)) and ((d - start).days % step == 0 if freq == "DAILY" else week(d) % step == 0 and (byday is not None or d.weekday() == start.weekday()))
        want = [d for d in days if fits(d)][: max(count, 0)]
        assert r["got"] == [d for d in want if at(1998, 1, 5) <= d <= at(1998, 3, 5)], r
    assert optimized(frame).count("array_distinct(") == 1


def test_parts_of_a_text_are_packed_once(spark):
    from marquee.functions.batches import split_batches

    rows = spark.createDataFrame([("a\n\nb",), ("",), (None,)], "t string").select(split_batches(F.col("t"), 1).alias("p"))
    assert [r["p"] for r in rows.collect()] == [["a", "b"], [""], None]
    assert optimized(rows).count("aggregate(") == 1
