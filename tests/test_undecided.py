from pyspark.sql import functions as F

from marquee.operators import dedupe

EVENTS = "ord long, city string, title string, datetime_iso string, location string, link string"


def test_pairs_have_classes_and_answers_decide(spark):
    rows = [
        (1, "b", "Trivia Night", "2026-09-05", "Netherworld", None), (2, "b", "Trivia Night", "2026-09-05", "The Junk Bar", None), (3, "b", "Sunset Jazz by the River", "2026-09-05", None, None),
        (4, "b", "Sunset Jazz by a River Bank", "2026-09-05", None, None), (5, "b", "Sunset Jazz by the River", "2026-09-06", None, None), (6, "b", "Chess", "2026-09-05", None, None),
        (7, "b", "Sunset Jazz by the Rivers", "2026-09-05", None, None), (8, "c", "Chess", "2026-09-05", None, None), (9, "b", "", "2026-09-05", None, None), (10, "b", None, None, None, None),
    ]
    events = spark.createDataFrame(rows, EVENTS)
    pairs = dedupe.block_pairs(events, "city", place=F.col("location"), link=F.col("link"))
    kinds = {(r.a, r.b): r.kind for r in pairs.collect()}
    assert kinds[1, 2] == "candidate" and kinds[3, 4] == "candidate" and kinds[3, 5] == "candidate" and kinds[3, 7] == "settled" and kinds[1, 6] == "none"
    assert all(8 not in p and 9 not in p and 10 not in p for p in kinds)
    candidates = sorted(p for p, k in kinds.items() if k == "candidate")
    assert sorted((r.a, r.b) for r in dedupe.to_ask(pairs, "city").collect()) == candidates
    assert [(r.a, r.b) for r in dedupe.to_ask(pairs, "city", most=2).orderBy("a", "b").collect()] == candidates[:2]
    answers = spark.createDataFrame([(1, 2, True), (3, 4, True), (3, 4, False), (3, 5, None), (1, 6, True), (99, 100, True)], "a long, b long, same boolean")
    links = dedupe.confirmed(pairs, answers)
    assert sorted((r.a, r.b) for r in links.collect()) == [(1, 2), (3, 7)]
    comps = dedupe.components(events.select("ord"), links)
    stats = dedupe.dedupe_stats(events, pairs, dedupe.to_ask(pairs, "city"), links, comps).collect()
    assert [tuple(r) for r in stats] == [(10, 1, len(candidates), 1, 2, 8)]
    assert dedupe.confirmed(pairs.limit(0), answers).collect() == [] and dedupe.confirmed(pairs, answers.limit(0)).count() == 1
