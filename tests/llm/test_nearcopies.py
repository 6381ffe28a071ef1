import numpy as np
import pytest

import corpus_pipeline
from marquee.llm import common, nearcopies, simhash


def brute(rows):
    """The (doc_id, text) that stay."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i])
    return sorted((min(g, key=lambda r: (r[0] is None, r[0] or 0))[0] for g in groups.values()), key=str)


def copies():
    rng = np.random.default_rng(5)
    rows, passage = [], [f"p{i}" for i in range(40)]
    for n in [1, 3, 5, 6, 8, 20, 60, 60, 100, 100, 200, 400, 1000]:
        base = [f"w{i}" for i in rng.integers(0, 5000, n)]
        for changes in (0, 0, 1, 2, 3, n // 60, n // 40, n // 30, n // 20):
            text = list(base)
            for at in rng.integers(0, n, changes):
                text[at] = f"c{rng.integers(0, 5000)}"
            rows.append(" ".join(text))
        rows.append(" ".join(base[: n * 4 // 5]))
        rows.append(" ".join(base + passage))
        rows.append(" ".join(passage + base[::-1]))
    chain = [f"w{i}" for i in rng.integers(0, 5000, 100)]
    for step in range(30):
        chain = [*chain[4:], *(f"c{i}" for i in rng.integers(0, 5000, 4))]
        rows.append(" ".join(chain))
    rows += ["", None, " \n"]
    return [(int(d), t) for d, t in zip(rng.permutation(len(rows)), rows, strict=True)]


@pytest.mark.parametrize("often", [3, 1])
def test_stage_against_brute_force(spark, monkeypatch, often):
    monkeypatch.setattr(nearcopies, "OFTEN", often)
    monkeypatch.setattr(nearcopies, "SAMPLE", 8 if often > 1 else 1)
    monkeypatch.setattr(nearcopies, "PAIRS", 50)
    rows = copies()
    kept = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted((r.doc_id for r in kept.collect()), key=str) == brute(rows)


def test_odd_documents(odd_documents, no_documents):
    kept = nearcopies.distinct(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == brute([(r.doc_id, r.text) for r in odd_documents.collect()])
    assert nearcopies.distinct(no_documents).collect() == []


def test_parity_maps_lose_no_pair():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    for n, m, same in [(0, 0, 0), (0, 5, 0), (1, 1, 1), (64, 65, 64), (300, 300, 290), (300, 900, 200), (1000, 1100, 0), (2000, 70, 70)]:
        x, y = np.unique(values[:n]), np.unique(values[n - same : n - same + m])
        off = nearcopies.apart(nearcopies.parity(x), nearcopies.parity(y))
        assert off <= len(np.setxor1d(x, y))
        assert off > 0.22 * max(n, m) or 5 * same >= 4 * (n + m - same) or n > 8 * m


def test_only_texts_that_may_be_similar_are_moved(spark, monkeypatch):
    moved, texts_of = [], nearcopies.texts_of
    monkeypatch.setattr(nearcopies, "texts_of", lambda pairs, *more: moved.append(pairs.count()) or texts_of(pairs, *more))
    rng = np.random.default_rng(8)
    words = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 9000, n))
    line, one = words(30), words(100)
    rows = [(i, line + " " + words(80)) for i in range(40)] + [(40, one), (41, one + " more")]
    kept = nearcopies.distinct(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(41))
    assert moved == [1, 0]


def test_few_rows_are_few_tasks(spark, monkeypatch):
    tasks, cut = [], common.cut
    monkeypatch.setattr(common, "cut", lambda df: tasks.append((out := cut(df)).rdd.getNumPartitions()) or out)
    spark.conf.set("spark.sql.shuffle.partitions", 24)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 99)], "u long, v long")
        roots = {r.node: r.root for r in simhash.stars(edges).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert roots == {i: 0 for i in range(1, 61)} | {100: 99} or roots == {i: 0 for i in range(61)} | {100: 99, 99: 99}
    assert max(tasks[1:]) == 1
