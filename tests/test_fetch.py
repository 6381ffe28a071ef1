import json

from marquee.sources import fetch

CALLS: dict[str, int] = {}


def fake(url, validator):
    CALLS[url] = CALLS.get(url, 0) + 1
    if "down" in url:
        raise OSError("no route")
    if "flaky" in url and CALLS[url] < 2:
        return 503, None, ""
    return (304, validator, None) if validator else (200, "v1", f"body of {url}")


def test_pages_by_host(spark):
    spark.dataSource.register(fetch.Pages)
    urls = ["http://a.x/1", "http://a.x/flaky", ["http://b.x/2", "v0"], "http://down.x/"]
    df = spark.read.format("marquee_pages").option("fetcher", "tests.test_fetch:fake").option("urls", json.dumps(urls)).load()
    rows = {r.url: r for r in df.collect()}
    assert df.rdd.getNumPartitions() == 3
    assert (rows["http://a.x/1"].status, rows["http://a.x/1"].body) == (200, "body of http://a.x/1")
    assert (rows["http://a.x/flaky"].status, rows["http://a.x/flaky"].tries) == (200, 2)
    assert (rows["http://b.x/2"].status, rows["http://b.x/2"].body) == (304, None)
    assert (rows["http://down.x/"].status, rows["http://down.x/"].failed) == (None, "no route")
