import random

from pyspark.sql import functions as F

from marquee.operators.layout import day_bars, first_fit, pack_lanes, timed_slots


def plain(bars):
    """First fit, bar by bar."""
    ends, lanes = [], {}
    for first, last, ord_ in sorted(bars):
        lane = next((i for i, e in enumerate(ends) if e < first), len(ends))
        ends[lane : lane + 1] = [last]
        lanes[ord_] = lane
    return lanes


def test_runs_equal_first_fit():
    rnd = random.Random(3)
    for _ in range(300):
        bars = []
        for i in range(rnd.randrange(1, 60)):
            a = rnd.randrange(7)
            bars.append((a, rnd.randrange(a, 7), i))
        classes = sorted({b[:2] for b in bars})
        runs = first_fit([(*c, sum(b[:2] == c for b in bars)) for c in classes])
        got = {}
        for c in classes:
            for k, (_, _, o) in enumerate(sorted(b for b in bars if b[:2] == c)):
                (run,) = [r for r in runs if r[:2] == c and r[2] <= k < r[2] + r[4]]
                got[o] = run[3] + k - run[2]
        assert got == plain(bars)


def test_lanes_of_groups_over_blocks(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(400):
        a = rnd.randrange(7)
        rows.append((("a", "b", None)[min(2, rnd.randrange(6))], i, a, rnd.randrange(a, 7), "x"))
    spans = spark.createDataFrame(rows, "city string, ord long, first int, last int, lane string")
    got = {(r["city"], r["ord"]): r["lane"] for r in pack_lanes(spans, "city", block=7).collect()}
    want = {(c, o): lane for c in ("a", "b", None) for o, lane in plain([(r[2], r[3], r[1]) for r in rows if r[0] == c]).items()}
    assert got == want


def test_lanes_of_nothing_and_of_spans_without_days(spark):
    schema = "city string, ord long, first int, last int"
    assert pack_lanes(spark.createDataFrame([], schema), "city").collect() == []
    got = pack_lanes(spark.createDataFrame([("a", 1, None, 3), ("a", 2, 0, 0)], schema), "city").orderBy("ord").collect()
    assert [r["lane"] for r in got] == [None, 0]


def test_week(spark):
    rows = [
        ("a", 1, "2026-09-07T19:30", ""),  # a slot
        ("a", 2, "2026-09-07T06:15:00", "2026-09-07T08:00:00"),  # before eight, ends the same day
        ("a", 3, "2026-02-14T10:00:00", "2027-01-03"),  # a run with a time
        ("a", 4, "2026-09-09", ""),  # a day
        ("a", 5, "2026-09-08", "2026-09-09"),
        ("a", 6, "2026-09-14T10:00:00", ""),  # next week
        ("a", 7, "", ""),
        ("a", 8, None, None),
        ("a", 9, "2026-09-13T23:59:00", None),
        ("b", 10, "2026-09-07T12:00:00", "2026-09-06"),  # ends before it starts: a slot
    ]
    events = spark.createDataFrame(rows, "city_key string, ord long, datetime_iso string, datetime_end_iso string")
    slots = {r["ord"]: (r["day"], r["minutes"], r["first_hour"], r["last_hour"]) for r in timed_slots(events, "2026-09-07").collect()}
    assert slots == {1: ("2026-09-07", 1170, 6, 24), 2: ("2026-09-07", 375, 6, 24), 9: ("2026-09-13", 1439, 6, 24), 10: ("2026-09-07", 720, 8, 23)}
    bars = {r["ord"]: (r["start_col"], r["end_col"], r["lane"]) for r in day_bars(events, "2026-09-07").collect()}
    assert bars == {3: (2, 9, 1), 5: (3, 5, 2), 4: (4, 5, 3)}
    assert timed_slots(events.filter(F.lit(False)), "2026-09-07").collect() == []
