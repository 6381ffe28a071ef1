"""The listing engine: every query against its SQL, functions against pinned values, extraction, sinks, streams."""

from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from marquee.functions import listing as L
from marquee.functions import markup
from marquee.operators import corpus, dedupe, query
from marquee.plans import queries as plans
from marquee.sinks import feeds
from marquee.sources import pages

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_query_matches_sql(spark, sql, name):
    df = plans.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(map(str, (tuple(r) for r in df.select(columns).collect())))
    assert got == sorted(map(str, sql.execute(f"SELECT {', '.join(columns)} FROM ({plans.ORACLES[name]})").fetchall()))


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLES)))
def test_query_without_sql_runs(spark, name):
    df = plans.QUERIES[name](spark, SF)
    assert len(set(df.columns)) == len(df.columns)
    df.collect()


def values(spark, rows, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, [f"c{i}" for i in range(len(rows[0]))]).select(*columns).collect()]


def test_event_hash_pins(spark):
    rows = [
        ("goldcoast", "Trivia Night", "2026-09-08", "Home of the Arts, Bundall"),
        ("brisbane", "Live Music", "2026-09-05T19:00:00", "The Triffid, Newstead"),
        ("brisbane", "Live Music", "2026-09-05T19:00:00", "Ric's Bar, Fortitude Valley"),
    ]
    assert [r[0] for r in values(spark, rows, L.event_hash(*map(F.col, ("c0", "c1", "c2", "c3"))))] == ["180ed8d", "nrxadx", "68lwo1"]


def test_one_edit(spark):
    rows = [("market", "market"), ("marekt", "market"), ("markt", "market"), ("markets", "market"), ("merket", "market"), ("mraket", "amrket"), ("abcd", "badc"), ("a", "abc")]
    assert [r[0] for r in values(spark, rows, L.one_edit(F.col("c0"), F.col("c1")))] == [True, True, True, True, True, False, False, False]


def test_dice_and_titles(spark):
    rows = [("night", "nacht"), ("board game", "board game meetup"), ("", "x"), ("same", "same")]
    got = values(spark, rows, F.round(L.dice(F.col("c0"), F.col("c1")), 2), L.titles_match(F.col("c0"), F.col("c1")))
    assert got == [(0.25, False), (0.72, True), (0.0, False), (1.0, True)]


def test_end_in_text(spark):
    rows = [("3 - 9 Mar", "2026-03-03"), ("3 Mar to 4 Apr", "2026-03-03"), ("soon", "2026-03-03")]
    assert [r[0] for r in values(spark, rows, L.end_in_text(F.col("c0"), F.col("c1")))] == ["2026-03-09", "2026-04-04", None]


def test_implied_tags_chain(spark):
    df = spark.createDataFrame([(["orchestra"],), (["hiking"],), (["knitting"],)], ["tags"])
    got = [set(r.tags) for r in corpus.imply_tags(df).collect()]
    assert got == [{"orchestra", "live music", "classical", "music"}, {"hiking", "walking", "nature", "outdoor"}, {"knitting"}]


def test_components_and_survivors(spark):
    nodes = spark.createDataFrame([(i, i % 3) for i in range(1, 9)], "ord long, completeness int")
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 8), (5, 6)], "a long, b long")
    comps = dedupe.components(nodes, links)
    assert {r.ord: r.comp for r in comps.collect()} == {1: 1, 2: 1, 3: 1, 8: 1, 4: 4, 5: 5, 6: 5, 7: 7}
    kept = {r.comp: (r.ord, r.group_size) for r in dedupe.survivors(nodes, comps).collect()}
    assert kept == {1: (2, 4), 4: (4, 1), 5: (5, 2), 7: (7, 1)}


def test_numbering_is_that_of_a_global_sort(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    assert all(r.ord == r.k + 1 for r in query.numbered(df, "k").collect())


def test_undated_and_unscored_rows(spark):
    df = spark.createDataFrame([("", "", None), ("2026-09-30", "", 3.0), ("2026-09-01", "2026-10-02", 9.0)], "datetime_iso string, datetime_end_iso string, score double")
    s, e = F.col("datetime_iso"), F.col("datetime_end_iso")
    got = [tuple(r) for r in df.select(L.is_past(s, e, "2026-09-30"), L.overlaps(s, e, "2026-09-28", "2026-10-04"), L.score_floor(F.col("score")), L.band(s)).collect()]
    assert got == [(False, False, True, None), (False, True, False, None), (False, True, True, None)]


NOW = datetime(2026, 9, 28)


def test_json_ld_and_embedded():
    page = '<script type="application/ld+json">{"@graph": [{"@type": "MusicEvent", "name": "Jazz", "startDate": "2026-10-01", "location": {"name": "Hall", "address": {"streetAddress": "1 A St"}}}]}</script>'
    [(rung, via, r)] = pages.records(page, NOW)
    assert (rung, via, r["title"], r["venue"], r["address"]) == (2, "jsonld", "Jazz", "Hall", "1 A St")
    page = '<script id="__NEXT_DATA__" type="application/json">{"p": {"items": [{"title": "Quiz", "startDate": "2026-10-02"}, {"title": "No date"}]}}</script>'
    assert [(via, r["title"]) for _, via, r in pages.records(page, NOW)] == [("embedded", "Quiz")]
    assert pages.records("not a page", NOW) == [] and pages.records(None, NOW) == []


def test_calendar_rules():
    body = "BEGIN:VCALENDAR\nBEGIN:VEVENT\nDTSTART:20260928T190000\nDTEND:20260928T200000\nSUMMARY:Quiz\nRRULE:FREQ=WEEKLY;COUNT=3\nEXDATE:20261005T190000\nEND:VEVENT\nBEGIN:VEVENT\nDTSTART:20260929\nSUMMARY:Off\nSTATUS:CANCELLED\nEND:VEVENT\nEND:VCALENDAR"
    assert [r["start"] for _, _, r in pages.records(body, NOW)] == ["2026-09-28T19:00:00", "2026-10-12T19:00:00"]


def test_readable_text_and_clean_up(spark):
    assert markup.readable('<nav>menu</nav><p>a <a href="/x">b</a></p><script>z</script>', "http://h.de/") == "a b (http://h.de/x)"
    df = spark.createDataFrame([("Tom &amp;amp; <b>Jerry</b>\\'s  show", "**See** [site](http://x.y) , now!!")], ["a", "b"])
    assert tuple(df.select(markup.clean_text("a"), markup.strip_display(F.col("b"))).first()) == ("Tom & Jerry 's show", "See site, now!")


def test_ical_feed(spark):
    df = spark.createDataFrame([(1, "brisbane", "Jazz, late; loud", "2026-09-30T19:00:00", "", "Hall")], "ord int, city_key string, title string, datetime_iso string, datetime_end_iso string, location string")
    body = feeds.ical(df).first().body
    assert "DTSTART:20260930T190000\r\nDTEND:20260930T210000\r\nSUMMARY:Jazz\\, late\\; loud" in body


def test_taste_stream(spark, tmp_path):
    from marquee.streaming.profiles import taste_stream

    rows = [(1, 1, 7, "like", ["tag:a", "cat:x"]), (2, 1, 7, "like", ["tag:a", "cat:x"]), (3, 1, 8, "dislike", ["tag:a", "cat:x"]), (4, 1, 7, "undo", [])]
    schema = "event_id long, user_id long, item long, kind string, keys array<string>"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    run = taste_stream(stream).writeStream.outputMode("update").format("memory").queryName("taste").option("checkpointLocation", str(tmp_path / "cp")).start()
    run.processAllAvailable()
    run.stop()
    assert {(r.key, r.weight) for r in spark.table("taste").collect()} == {("tag:a", -1.0), ("cat:x", 0.0)}


def test_costs(spark):
    from marquee.functions import records as R

    rows = [("Free entry",), ("$25",), ("AUD 12.50",), ("$5 to $15",), ("",), ("EUR 9",), ("0",), ("See site",)]
    c = F.col("c0")
    got = values(spark, rows, R.cost_amount(c), R.cost_label(c), R.cost_range(c)["high"])
    assert got == [(0.0, "free", None), (25.0, "$25", None), (12.5, "$12.50", None), (None, "$5 to $15", 15.0), (None, None, None), (9.0, "EUR 9", None), (0.0, "free", None), (None, None, None)]
    offers = [r[0] for r in values(spark, rows[:4], R.offer(c, F.lit("http://x.y")))]
    assert '"@type":"AggregateOffer"' in offers[3] and '"price":25.0' in offers[1]


def test_venues(spark):
    from marquee.functions import records as R

    rows = [("Level 2, The Triffid, Newstead", "Hall 1"), ("The Bar & Grill", "Hall 2"), ("", "x")]
    got = values(spark, rows, R.raw_venue(F.col("c0")), R.venue_key(F.col("c0")), R.numbers_conflict(F.col("c0"), F.col("c1")))
    assert got == [("The Triffid", "level 2 the triffid newstead", True), ("The Bar & Grill", "bar and grill", False), ("", "", False)]


def test_zone_gap_and_overlap(spark):
    from marquee.functions import dates as D

    rows = [("2026-10-04T02:30:00",), ("2026-10-04T03:30:00",), ("2026-04-05T02:30:00",)]
    got = [str(r[0]) for r in values(spark, rows, F.date_format(D.to_instant(F.col("c0"), "Australia/Sydney"), "yyyy-MM-dd HH:mm"))]
    assert got == ["None", "2026-10-03 16:30", "2026-04-04 15:30"]


def test_shown_dates(spark):
    from marquee.functions import dates as D

    rows = [("2026-09-30T19:00:00", "2026-10-02"), ("2026-12-30", "2027-01-02"), ("2026-09-30", ""), ("", "")]
    a, b = F.col("c0"), F.col("c1")
    got = values(spark, rows, D.human_datetime(a, b), D.display_datetime(F.lit("soon"), a, b, "2026-10-01"))
    assert got == [("Wed 30 Sep, 7:00 PM – Fri 2 Oct", "On now — until 2 Oct"), ("Wed 30 Dec 2026 – Sat 2 Jan 2027", "soon"), ("Wed 30 Sep", "soon"), ("", "soon")]


def test_numbers_are_a_permutation_under_filters_and_columns(spark):
    from marquee.plans.tables import listing, week_listing

    whole = {r.ord: (r.title, r.event_key) for r in listing(spark, SF).select("ord", "title", "event_key").collect()}
    assert sorted(whole) == list(range(1, len(whole) + 1))
    for columns in (["ord", "title", "event_key"], ["ord", "title", "event_key", "provider", "score"]):
        week = week_listing(spark, SF).select(*columns).collect()
        assert week and all(whole[r.ord] == (r.title, r.event_key) for r in week)
        again = week_listing(spark, SF).filter("provider = 'A'").select(*columns, F.col("provider").alias("p")).collect()
        assert again and all(whole[r.ord] == (r.title, r.event_key) for r in again)


def test_numbers_of_ties_nulls_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, 3), (None, 1), (5, 2), (5, 1), (9, 0), (-1, 7)], "a int, b int")
    got = {(r.a, r.b): r.ord for r in query.numbered(rows, "a", "b", ranges=3).collect()}
    assert [got[k] for k in ((None, 1), (None, 3), (-1, 7), (5, 1), (5, 2), (9, 0))] == [1, 2, 3, 4, 5, 6]
    assert query.numbered(rows.filter("b > 99"), "a", "b").collect() == []


def test_a_query_without_numbers_does_not_sort_for_them(spark):
    from marquee.plans.tables import listing

    plan = listing(spark, SF).groupBy("city_key").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_settled_pairs_look_at_places_and_links(spark):
    rows = [
        (1, "c", "Trivia Night", "2026-03-03T19:00:00", "The Triffid", "https://a.org/x"),
        (2, "c", "Trivia night!", "2026-03-03T19:00:00", "The Triffid, Newstead", "https://b.org/"),
        (3, "c", "Trivia Night", "2026-03-03", "Junk Bar", ""),
        (4, "c", "Strong is the new pretty", "2026-03-03", "South Bank Parklands", ""),
        (5, "c", "Strong is the new pretty", "2026-03-03", "Playhouse, QPAC", ""),
        (6, "c", "Trivia Night", "2026-03-04", "The Triffid", "https://b.org/"),
        (7, "c", "Trivia Night", "2026-03-04", "The Triffid", "https://c.org/y"),
    ]
    events = spark.createDataFrame(rows, "ord long, city_key string, title string, datetime_iso string, location string, link string")
    got = dedupe.block_pairs(events, "city_key", place=F.col("location"), link=F.col("link")).filter("settled").collect()
    assert {(r.a, r.b) for r in got} == {(1, 2), (4, 5), (1, 6), (2, 7), (6, 7)}
    blind = dedupe.block_pairs(events, "city_key").filter("settled").collect()
    assert {(r.a, r.b) for r in blind} == set()


def test_places_and_acronyms(spark):
    rows = [("queensland performing arts centre south brisbane", "playhouse qpac"), ("the triffid", "the triffid newstead"), ("", "x"), ("junk bar", "netherworld"), ("city hall", "city hall annex"), ("old museum brisbane", "old museum annex")]
    got = values(spark, rows, L.acronym_match(F.col("c0"), F.col("c1")), L.venues_agree(F.col("c0"), F.col("c1")))
    assert got == [(True, True), (False, True), (False, True), (False, False), (False, True), (False, True)]


def test_tiers_windows_and_prices(spark):
    from marquee.functions import records as R
    from marquee.functions.dates import date_window

    rows = [(["a", "b"], ["a"], ["b"]), (["a"], ["a"], []), (["c"], ["a"], ["b"]), (["a"], None, None)]
    df = spark.createDataFrame(rows, "t array<string>, w array<string>, u array<string>")
    assert [r[0] for r in df.select(L.pref_tier(F.col("t"), F.col("w"), F.col("u"))).collect()] == [-1, 1, 0, 0]
    assert date_window("2026-03-02", "2026-03-08", "2026-03-15") == ("2026-03-15", "2026-03-15")
    assert date_window("2026-03-02", "2026-03-08", "2026-03-16") == ("2026-03-02", "2026-03-15")
    labels = [r[0] for r in values(spark, [("See link",), ("TBA",), ("$20",), ("from $20",), ("?",), ("Free entry",)], R.cost_label(F.col("c0")))]
    assert labels == [None, None, "$20", "from $20", None, "free"]
