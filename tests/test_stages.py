from pyspark.sql import functions as F

from marquee.operators import stages

EVENT = "k string, title string, datetime_iso string, datetime_end_iso string, location string"


def events(spark):
    rows = [("a", "Jazz", "2026-09-30", "", "Hall, Town"), ("b", " ", "2026-09-30", "", "Hall, Town"), ("c", "Old", "2026-09-01", "2026-09-20", "Far"), ("d", "Far off", "2027-01-01", "", ""), ("e", "Some day", "", "", "Nowhere"), ("f", "Run", "2026-09-01", "2026-10-20", "Level 1, Pub")]
    return spark.createDataFrame(rows, EVENT)


def test_prepass(spark):
    got = {r.k: r.reason for r in stages.prepass(events(spark), "2026-09-28", "2026-10-04").collect()}
    assert got == {"a": "kept", "b": "no-title", "c": "past", "d": "later", "e": "no-date", "f": "kept"}


def test_annotate(spark):
    schema = "tags array<string>, category string, social boolean, intellectual boolean, hands_on boolean, creative boolean, drop boolean"
    rows = [([" Jazz", "x", "jazz", "film"], "Talk / Lecture", None, True, False, None, None), (["film"], "Concert / Music", True, None, None, None, True)]
    [r] = stages.annotate(spark.createDataFrame(rows, schema), ["film", "jazz"]).collect()
    assert (r.tags, r.category, r.social, r.intellectual) == (["jazz", "film"], "Community / Other", False, True)


def test_reuse_of_annotations(spark):
    rows = spark.createDataFrame([("a", "new", ["x"], "C"), ("b", "same", ["x"], "C"), ("c", "any", ["x"], "C")], "k string, description string, tags array<string>, category string")
    known = spark.createDataFrame([("a", "old", ["y"], "D"), ("b", "same", ["y"], "D"), ("c", "", ["z"], "E")], "k string, description string, tags array<string>, category string")
    got = {r.k: (r.tags, r.category, r.reused) for r in stages.reuse_annotations(rows, known, "k").collect()}
    assert got == {"a": (["x"], "C", False), "b": (["y"], "D", True), "c": (["z"], "E", True)}


def test_locality_keeps_rows_without_evidence(spark):
    places = spark.createDataFrame([("Hall, Town", 0.0, 0.1, True), ("Far", 10.0, 10.0, True), ("Nowhere", None, None, False)], "location string, lat double, lng double, found boolean")
    rows = stages.locate(events(spark), places)
    assert {r.k: r.place_status for r in rows.collect()} == {"a": "resolved", "b": "resolved", "c": "resolved", "d": "unknown", "e": "no_such_place", "f": "unknown"}
    assert {r.k for r in stages.inside(rows, F.lit(0.0), F.lit(0.0), F.lit(50.0)).collect()} == {"a", "b", "d", "e", "f"}
    assert [r.location for r in stages.misses(events(spark), places).collect()] == ["Level 1, Pub"]


def test_carry_forward(spark):
    fresh = events(spark).filter("k = 'a'")
    got = {r.k: r.carried for r in stages.carry_forward(fresh, events(spark), "k", "2026-09-28").collect()}
    assert got == {"a": False, "b": True, "d": True, "f": True}


def test_usage_and_registry(spark):
    calls = spark.createDataFrame([("rank", "m", 1000, 10), ("rank", "m", 1000, 10), ("extract", "m", 500, 0)], "stage string, model string, prompt long, output long")
    prices = spark.createDataFrame([("m", 1.0, 2.0)], "model string, prompt_price double, output_price double")
    got = {r.stage: (r.calls, r.prompt, round(r.usd, 6)) for r in stages.usage_totals(calls, prices).collect()}
    assert got == {"rank": (2, 2000, 0.00204), "extract": (1, 500, 0.0005), "TOTAL": (3, 2500, 0.00254)}
    sources = spark.createDataFrame([(1, "", "https://www.the-hall.com/x"), (2, None, "the-hall.org"), (3, "own", "z.com")], "ord int, id string, domain string")
    assert [r.id for r in stages.registry(sources).orderBy("ord").collect()] == ["the-hall", "the-hall-2", "own"]


def test_earned_places(spark):
    sources = spark.createDataFrame([("old", "2025-01-01"), ("hit", "2025-01-01"), ("young", "2026-09-20")], "source string, added string")
    hits = spark.createDataFrame([("hit", f"2026-0{m}-01") for m in range(1, 10)], "source string, week string")
    assert {r.source for r in stages.earns_place(sources, hits, "2026-09-28").collect()} == {"hit", "young"}
    assert stages.earns_place(sources, hits.limit(3), "2026-09-28").count() == 3


def test_venues_and_details(spark):
    overrides = spark.createDataFrame([("Pub", "The Pub")], "raw string, canonical string")
    cache = spark.createDataFrame([("Hall", "Town Hall"), ("Nowhere", None)], "raw string, canonical string")
    got = {r.k: r.venue_name for r in stages.venue_names(events(spark), overrides, cache).collect()}
    assert got == {"a": "Town Hall", "b": "Town Hall", "c": "Far", "d": None, "e": None, "f": "The Pub"}
    rows = spark.createDataFrame([("u1", ""), ("u2", ""), ("u3", "own"), ("u4", "")], "link string, description string")
    details = spark.createDataFrame([("u1", "about"), ("u2", "shared"), ("u4", "shared"), ("u3", "other")], "url string, text string")
    assert {r.link: r.description for r in stages.enrichment(rows, details).collect()} == {"u1": "about", "u2": "", "u3": "own", "u4": ""}
