import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marquee.functions import batches
from marquee.operators import caches, crawl, leaders, recurrence
from marquee.sources import streams

SERIES = "uid string, start timestamp_ntz, end timestamp_ntz, freq string, step int, count int, until timestamp_ntz, byday array<string>, bymonthday array<int>, rdates array<timestamp_ntz>, exdates array<timestamp_ntz>"


def at(text):
    return datetime.fromisoformat(text) if text else None


def series(uid, start, freq=None, step=None, count=None, until=None, byday=None, bymonthday=None, rdates=None, exdates=None, end=None):
    return uid, at(start), at(end), freq, step, count, at(until), byday, bymonthday, [at(t) for t in rdates] if rdates is not None else None, [at(t) for t in exdates] if exdates is not None else None


def found(spark, rows, overrides=None, low="2026-08-01 00:00:00", high="2026-09-30 00:00:00"):
    frame = spark.createDataFrame(rows, SERIES)
    moved = spark.createDataFrame(overrides, "uid string, recurrence_id timestamp_ntz, start timestamp_ntz, end timestamp_ntz") if overrides is not None else None
    out = {}
    for r in sorted(recurrence.expand(frame, moved, low, high).collect(), key=lambda r: (r.uid, r.recurrence_id)):
        out.setdefault(r.uid, []).append(r.start.isoformat(sep=" ", timespec="minutes"))
    return out


def test_rules_unroll_in_the_window(spark):
    rows = [
        series("weekly", "2026-07-06 18:00", "WEEKLY", 2, byday=["WE", "MO"], until="2026-08-20 00:00"),
        series("second tuesday", "2026-01-13 10:00", "MONTHLY", byday=["2TU"]),
        series("last friday", "2026-01-30 10:00", "MONTHLY", byday=["-1FR"]),
        series("fifth wednesday", "2026-01-28 10:00", "MONTHLY", byday=["5WE"]),
        series("31st", "2026-01-31 10:00", "MONTHLY"),
        series("last day", "2026-01-31 10:00", "MONTHLY", bymonthday=[-1]),
        series("counted", "2026-07-30 09:00", "DAILY", count=4),
        series("weekends", "2026-08-01 09:00", "DAILY", byday=["SA", "SU"], until="2026-08-09 09:00"),
        series("leap", "2024-02-29 09:00", "YEARLY"),
        series("once", "2020-01-01 09:00"),
        series("unknown", "2020-01-01 09:00", "HOURLY"),
        series("nothing", None, "DAILY"),
        series("none left", "2026-08-01 09:00", "DAILY", count=0),
    ]
    assert found(spark, rows) == {
        "weekly": ["2026-08-03 18:00", "2026-08-05 18:00", "2026-08-17 18:00", "2026-08-19 18:00"],
        "second tuesday": ["2026-08-11 10:00", "2026-09-08 10:00"],
        "last friday": ["2026-08-28 10:00", "2026-09-25 10:00"],
        "31st": ["2026-08-31 10:00"],
        "last day": ["2026-08-31 10:00"],
        "counted": ["2026-08-01 09:00", "2026-08-02 09:00"],
        "weekends": ["2026-08-01 09:00", "2026-08-02 09:00", "2026-08-08 09:00", "2026-08-09 09:00"],
        "once": ["2020-01-01 09:00"],
        "unknown": ["2020-01-01 09:00"],
    }


def test_dates_are_added_taken_away_and_replaced(spark):
    rows = [
        series("a", "2026-08-03 18:00", "WEEKLY", count=4, rdates=["2026-08-05 12:00", "2026-08-10 18:00"], exdates=["2026-08-17 18:00", "2030-01-01 00:00"], end="2026-08-03 20:00"),
        series("b", "2026-08-03 18:00", rdates=["2026-08-04 18:00"]),
        series("c", "2026-08-03 18:00", exdates=["2026-08-03 18:00"]),
    ]
    moved = [("a", at("2026-08-10 18:00"), at("2026-08-11 19:00"), None), ("a", at("2026-08-17 18:00"), at("2026-08-18 18:00"), None), ("x", at("2026-08-10 18:00"), at("2026-08-11 19:00"), None)]
    assert found(spark, rows, moved) == {"a": ["2026-08-03 18:00", "2026-08-05 12:00", "2026-08-11 19:00", "2026-08-24 18:00"], "b": ["2026-08-03 18:00", "2026-08-04 18:00"]}
    assert found(spark, []) == {}


def test_zones_apply_to_what_comes_out(spark):
    rows = spark.createDataFrame([(at("2026-08-03 18:00"), "Australia/Brisbane"), (at("2026-08-03 18:00"), None)], "t timestamp_ntz, zone string")
    assert [r.x for r in rows.select(recurrence.raw_time(F.col("t"), F.col("zone")).alias("x")).collect()] == ["2026-08-03T08:00:00.000Z", "2026-08-03T18:00:00"]


def sitemap(kind, *locs):
    return f"<{kind}>" + "".join(f"<loc> {x} </loc>" for x in locs) + f"</{kind}>"


def plain_crawl(seeds, bodies, priority, fetches):
    queue, seen, out, fetched = list(seeds), set(), [], 0
    while queue and fetched < fetches:
        queue.sort(key=lambda u: -priority(u))
        url = queue.pop(0)
        if url in seen:
            continue
        seen.add(url)
        body = bodies.get(url)
        if body is None or not ("<sitemapindex" in body or "<urlset" in body):
            out.append((url, None, "none"))
            continue
        fetched += 1
        index = "<sitemapindex" in body
        out.append((url, fetched, "index" if index else "pages"))
        if index:
            queue += [x.strip() for x in body.replace("</loc>", "<loc>").split("<loc>")[1::2] if x.strip() not in seen and x.strip().startswith("https://h.org/")]
    return sorted(out, key=str)


def test_crawl_equals_a_queue(spark):
    rng = random.Random(4)
    words = ["events", "brisbane", "sydney", "x"]
    urls = [f"https://h.org/{rng.choice(words)}/{rng.choice(words)}/{i}" for i in range(40)]
    bodies = {u: sitemap("sitemapindex", *rng.sample(urls, 5), "https://other.org/events/1", "https://h.org/gone") if i % 3 else sitemap("urlset", "https://h.org/a") if i % 2 else "<html>" for i, u in enumerate(urls)}
    score = lambda u: (4 if "/events/" in u else 0) + (3 if "brisbane" in u else -4 if "sydney" in u else 0)
    seeds = spark.createDataFrame([("h.org", u, i) for i, u in enumerate(urls[1:3])] + [("h.org", urls[1], 9), (None, urls[3], 0), ("h.org", None, 1)], "host string, url string, place int")
    frame = spark.createDataFrame([*bodies.items(), (urls[1], bodies[urls[1]]), (None, "<urlset>"), ("https://h.org/null", None)], "url string, body string")
    for fetches in (1, 4, 14):
        got = crawl.crawl(seeds, frame, lambda u: crawl.sitemap_priority(u, ["brisbane"]), fetches).collect()
        assert sorted(((r.url, r.step, r.kind) for r in got), key=str) == plain_crawl(urls[1:3], bodies, score, fetches)
    assert crawl.crawl(seeds.limit(0), frame, lambda u: F.lit(0)).collect() == []


def test_listing_indexes(spark):
    paths = {"/events": True, "/events/tedx-brisbane": False, "/whats-on/": True, "/Queensland/Brisbane": True, "/brisbane": False, "/past-events": False, "/a/b/c/events": False, "/": False, "": False, "/events/a-very-long-single": False}
    rows = spark.createDataFrame([(p,) for p in paths], "p string").select("p", crawl.listing_index(F.col("p")).alias("x")).collect()
    assert {r.p: r.x for r in rows} == paths


def test_offered_urls_stop_at_the_limit(spark):
    bodies = spark.createDataFrame([("https://h.org/1", sitemap("urlset", "https://h.org/a", "https://x.org/b", "https://h.org/c")), ("https://h.org/2", sitemap("urlset", "https://h.org/d", "https://h.org/e"))], "url string, body string")
    visits = spark.createDataFrame([("h.org", "https://h.org/1", 1, "pages"), ("h.org", "https://h.org/2", 2, "pages")], "host string, url string, step int, kind string")
    of = lambda n: sorted(r.url[-1] for r in crawl.offered(visits, bodies, n).collect())
    assert of(8000) == ["a", "c", "d", "e"] and of(4) == ["a", "c", "d"] and of(0) == []


def chunked(stream, size):
    return "".join(f"<script>self.__next_f.push([1, {json.dumps(stream[i : i + size])}])</script>" for i in range(0, len(stream), size))


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_flight_streams_come_together(spark, size):
    value = {"title": 'a "quoted" {brace} ]', "list": [1, {"x": "\\"}], "é": " "}
    stream = f'0:"$L1"\n1a:{json.dumps(value)}\n2b:I[1,2]\nff:{{"cut":['
    frame = spark.createDataFrame([(chunked(stream, size),), ("<p>nothing</p>",), (None,), ('<script>self.__next_f.push([1,"1:{broken"])</script>',)], "html string")
    got = [[json.loads(v) for v in r.v] for r in frame.select(streams.flight_values(F.col("html")).alias("v")).collect()]
    assert got[0][:2] == [value, [1, 2]] and got[1:] == [[], [], []]


def test_long_chunks_do_not_recurse(spark):
    stream = "1:" + json.dumps(["\\" * 200_000 + "x" * 1_000_000])
    rows = spark.createDataFrame([(chunked(stream, 10**7),)], "html string").select(streams.flight_values(F.col("html")).alias("v")).collect()
    assert len(json.loads(rows[0].v[0])[0]) == 1_200_000


def test_cut_arrays_keep_whole_elements(spark):
    whole = json.dumps([{"a": i, "b": "x, y"} for i in range(4)], separators=(",", ":"))
    texts = {
        f"```json\n{whole}\n```": 4, f"Sure: {whole} Bye.": 4, whole[:-9]: 3, whole[: whole.index('{"a":1')]: 1, whole[: whole.index('{"a":2') + 3]: 2,
        "[]": 0, "no array": 0, "[1, 2": 0, "[{]": 0, "": 0, "[[1],[2]]": 2,
        '[{"a":1},{"b":"]"},{"c":"': 1,
    }
    rows = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", F.size(streams.json_array(F.col("t"))).alias("n")).collect()
    got = {r.t: r.n for r in rows}
    assert got.pop(None) == 0
    assert got == texts


def plain_batches(text, most):
    import re

    out, now = [], ""
    for p in (p for p in re.split(r"\n\s*\n", text) if p.strip()):
        if now and len(now) + len(p) + 2 > most:
            out.append(now)
            now = p
        else:
            now = f"{now}\n\n{p}" if now else p
    out += [now] if now else []
    return out or [text]


def test_paragraphs_are_packed_in_order(spark):
    rng = random.Random(1)
    texts = ["", " \n\n ", "one", "a\n\nb", "x" * 50 + "\n \n" + "y" * 3, "\n\nlead\n\n\n\ntail\n\n"] + ["\n\n".join("z" * rng.randrange(1, 15) for _ in range(30)) for _ in range(20)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "i int, t string").select("i", batches.split_batches(F.col("t"), 20).alias("b")).collect()
    got = {r.i: r.b for r in rows}
    assert got.pop(99) is None
    assert got == {i: plain_batches(t, 20) for i, t in enumerate(texts)}


def test_the_densest_window_holds_the_dates(spark):
    filler = "word " * 600
    texts = [None, "", "3 Mar", filler + "\n\nMon 3 Mar, Tue 4 Mar\n\n" + filler, filler * 2, "Mon " + filler + "Tue Wed"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", batches.densest_window(2000)("t").alias("w")).orderBy("i").collect()
    got = [(r.w.start, r.w.hits) for r in rows]
    assert got[:3] == [(0, 0), (0, 0), (0, 1)] and got[3][1] == 4 and got[4] == (0, 0) and got[5][1] == 2
    assert texts[3][got[3][0] :].startswith("Mon 3 Mar") or "Mon 3 Mar" in texts[3][got[3][0] : got[3][0] + 2000]


def test_files_are_split_by_size(spark):
    rows = spark.createDataFrame([("a", "x", 5), ("a", "y", 6), ("a", None, 1), ("b", "x", 12), ("c", "x", 3), (None, "x", 20), (None, "y", 1)], "city string, cat string, n int")
    got = sorted((tuple(r) for r in batches.split_by_size(rows, "city", "cat", F.col("n"), 11).collect()), key=str)
    assert got == sorted([("a", "x", 1, 5), ("a", "y", 1, 6), ("a", "", 1, 1), ("b", "x", 1, 12), ("c", None, 1, 3), (None, "x", 1, 20), (None, "y", 1, 1)], key=str)
    assert batches.split_by_size(rows.limit(0), "city", "cat", F.col("n"), 11).collect() == []


def plain_leaders(rows):
    import re
    from collections import Counter

    grams = lambda t: Counter(t[i : i + 2] for i in range(len(t) - 1))

    def alike(a, b):
        if a == b or len(a) >= 6 and len(b) >= 6 and (a.startswith(b) or b.startswith(a)):
            return True
        x, y = grams(a), grams(b)
        return bool(x and y) and 2 * sum((x & y).values()) / (sum(x.values()) + sum(y.values())) > 0.85

    kept = []
    for i, title, day in sorted(rows):
        t = re.sub("[^a-z0-9]+", " ", (title or "").lower()).strip()
        if not day or not t or not any(d == day and alike(t, k) for _, k, d in kept if k and d):
            kept.append((i, t, day))
    return sorted(i for i, _, _ in kept)


def test_leaders_equal_a_pass_in_order(spark):
    rng = random.Random(6)
    base = ["Live Music at The Triffid", "Live Music", "Live Music Sundays", "Sunset Jazz by the River", "Sunset Jazz by the Rivers", "aaaaaaaaaa", "Yo", "yo!"]
    rows = [(i, "".join(c for c in rng.choice(base) if rng.random() > 0.04), rng.choice(["d1", "d2", None])) for i in range(200)]
    rows += [(1000 + i, "abcdefghij" * 3 + "xyz"[: i % 4] + "q" * i, "chain") for i in range(12)] + [(2000, None, "d1"), (2001, "", "d1")]
    got = leaders.leaders(spark.createDataFrame(rows, "n int, title string, day string").repartition(3), "n", F.col("title"), F.col("day"))
    assert sorted(r.n for r in got.collect()) == plain_leaders(rows)
    assert leaders.leaders(got.limit(0), "n", F.col("title"), F.col("day")).collect() == []


def test_only_one_match_by_end(spark):
    films = spark.createDataFrame([(1, "holy cannoli"), (2, "sense"), (3, "gone"), (4, None), (5, "")], "id int, k string")
    others = spark.createDataFrame([("o1", "opening night: premiere: holy cannoli"), ("o2", "wine: sense"), ("o3", "sense"), ("o4", None), ("o5", "bygone"), ("o6", "")], "o string, k string")
    got = sorted((r.id, r.match_o) for r in leaders.only_match_by_end(films, "k", others, "k").collect())
    assert got == [(1, "o1"), (2, None), (3, None), (4, None), (5, None)]


def test_a_second_run_asks_nothing(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, "")], "id int, text string")
    empty = spark.createDataFrame([], "digest string, version string, answer string")
    hits, misses = caches.asked(rows, "text", empty, "v1")
    assert hits.count() == 0 and sorted(r.text for r in misses.collect()) == ["", "a", "b"]
    answers = misses.select("digest", F.when(F.col("text") != "", F.upper("text")).alias("answer"))
    for _ in range(2):
        caches.commit(path, answers, "v1")
    store = spark.read.parquet(path)
    assert store.count() == 3
    hits, misses = caches.asked(rows, "text", store, "v1")
    assert misses.count() == 0 and sorted(((r.id, r.answer) for r in hits.collect())) == [(1, "A"), (2, "B"), (3, "A"), (5, None)]
    assert caches.asked(rows, "text", store, "v2")[1].count() == 3
    assert caches.added(store, answers, "v1").count() == 3


def test_hydration_is_a_rung_of_the_ladder():
    from marquee.sources import pages

    node = {"deep": [{"title": "Gig", "startDate": "2026-09-05T19:30", "venue": "Hall"}]}
    bodies = [f"<script>window.__NUXT__ = {json.dumps(node)};</script>", f"<script>__sveltekit_ab1={json.dumps(node)}</script>", f"<script>window.__remixContext = {json.dumps(node)};\n</script>", chunked("1a:" + json.dumps(node), 9)]
    for body in bodies:
        assert [(rung, via, r["title"], r["venue"]) for rung, via, r in pages.records(body, datetime(2026, 9, 1))] == [(3, "embedded", "Gig", "Hall")]
    assert pages.records("<script>window.__NUXT__={a:1}</script>" + chunked("1a:{", 9), datetime(2026, 9, 1)) == []


def test_bodies_are_read_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def noted(url):
        seen.add(1)
        return sitemap("urlset", "https://h.org/events/1", "https://h.org/2") if url.endswith("1") else "none"

    urls = [f"https://h.org/{i}" for i in range(11, 31)]
    bodies = spark.createDataFrame([(u,) for u in urls], "url string").select("url", F.udf(noted)("url").alias("body"))
    seeds = spark.createDataFrame([("h.org", u, i) for i, u in enumerate(urls)], "host string, url string, place long")
    maps = crawl.read_once(bodies)
    visits = crawl.crawl(seeds, bodies, lambda u: F.lit(0), maps=maps)
    best = crawl.candidates(crawl.offered(visits, bodies, maps=maps), lambda u: F.lit(0)).collect()
    assert [(r.host, r.url, r["rank"]) for r in best] == [("h.org", "https://h.org/events/1", 1)]
    assert seen.value == len(urls)
