"""An event is cleaned once: one pass through Python, no shuffle by its key, and a tag's spelling is looked at once."""

import random
from collections import Counter

from pyspark.sql import functions as F

import __spark_entry__
from marquee.functions import markup
from marquee.operators import clean, corpus, query


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def odd_events(spark, n=300):
    pick = random.Random(11)
    tags = ["Markets ", "market", "gig", "gigs", "GIGS", "bas", "bass", "basss", "Food &amp;amp; <i>Wine</i>", "riverside", "Riverside ", "old", "free", "Workshop", "s", "", None, "orchestra", "hiking", "improv", "a < b", "ΟΔΟΣ", "new farm", " x y"]
    places = [None, "", "Riverside &amp; <b>Hall</b>", "Gigs Place", "market-bass"]
    costs = [None, "", "free", " FREE entry ", "USD 0", "$0.00", "usd 25 or EUR$30", "&#36;0"]
    dates = [None, "", "2026-09-11T19:00:00", "2026-09-11", "2026-02-30", "0000-01-01", "soon"]
    lists = lambda: pick.choice([None, [], [pick.choice(tags) for _ in range(pick.randrange(9))]])
    rows = [(i, pick.choice(["<b>a</b>\n b", None, "x"]), pick.choice(places), pick.choice(costs), pick.choice(dates), pick.choice(dates), pick.choice([None, " later &amp; on "]), lists()) for i in range(n)]
    return spark.createDataFrame(rows, "ord long, title string, location string, cost string, datetime_iso string, datetime_end_iso string, datetime string, tags array<string>").repartition(3)


def test_published_is_steps_of_cleaned(spark):
    events = odd_events(spark)
    read = lambda df: {r["ord"]: r for r in df.collect()}
    got, want = read(clean.published(events, "Old Town")), read(clean.tag_steps(clean.clean_events(events), "Old Town"))
    assert got == want and any(r["tags"] and "market" in r["tags"] for r in got.values())
    assert read(clean.published(events, "Old Town", most=0)) == want == read(clean.tag_steps(clean.clean_events(events), "Old Town", most=1))


def test_events_pass_python_once(spark):
    plan = optimized(__spark_entry__.queries()["clean_events"](spark, "/root/testdata/sf0.001"))
    assert plan.count("ArrowEvalPython") == 1 and "LeftOuter" not in plan and "collect_set" not in plan


def test_tags_are_counted_as_written(spark):
    events = spark.createDataFrame([(["Gig ", "gigs", "&lt;b&gt;gigs", "s", "", None],), (None,), ([],)], "tags array<string>")
    variants = corpus.tag_variants(events, lambda t: F.lower(markup.clean_text(t)))
    assert sorted(map(tuple, variants.collect())) == [("gig", "gigs"), ("gigs", "gigs")]
    below = optimized(variants).split("Aggregate [t#")[1]
    assert "ArrowEvalPython" not in below and "Filter" not in below


def test_texts_of_a_batch(spark):
    texts = ["&amp;amp;lt;b&gt; x", None, "<" * 200_000, "a < b > c <d", "\\n\\'\\\\x", "\x1c a  b ", "", "&lt", None, "&#x41;&notit;"]
    want = ["x", "", "<" * 200_000, "a c <d", "'\\x", "a b", "", "<", "", "A¬it;"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string").coalesce(1)
    got = rows.select("i", markup.clean_text("x").alias("y")).orderBy("i").collect()
    assert [r["y"] for r in got] == want
    lists = spark.createDataFrame([(0, None), (1, ["<i>", None, "a"]), (2, []), (3, [" a "])], "i int, x array<string>").coalesce(1)
    assert [r["y"] for r in lists.select("i", markup.clean_texts("x").alias("y")).orderBy("i").collect()] == [None, ["", "", "a"], [], ["a"]]


def test_ranges_fall_on_all_partitions(spark):
    rows = spark.range(4000).select((F.col("id") * 7 % 4000).alias("k"))
    counts = Counter(r[0] for r in query.numbered(rows, "k", ranges=4).select(F.spark_partition_id()).collect())
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    labels = spark.createDataFrame([(i,) for i in query._labels(spark, tasks)], "i long").select(F.pmod(F.hash("i"), F.lit(tasks)))
    assert len({r[0] for r in labels.collect()}) == tasks and sum(counts.values()) == 4000
    assert "cast(" not in optimized(query.numbered(rows, "k", ranges=4)).split("windowspecdefinition(")[1].split(",")[0]
