import numpy as np
import pytest
import xxhash

from marquee.llm import simhash


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def expected(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(fps)
    least = {}
    for (d, _), r in zip(rows, roots):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return sorted(((d, f"{f:016x}", least.get(r)) for (d, _), f, r in zip(rows, fps, roots)), key=str)


def test_against_brute_force(odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    got = sorted((tuple(r) for r in simhash.components(odd_documents).collect()), key=str)
    assert got == expected(rows)


@pytest.mark.parametrize("crowd", [1000, 7])
def test_crowded_blocks(spark, crowd):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 1 << 62))
    fps = {centre}
    for _ in range(250):
        x = centre
        for b in rng.integers(0, 64, rng.integers(1, 7)):
            x ^= 1 << int(b)
        fps.add(x)
    fps |= {int(x) for x in rng.integers(0, 1 << 63, 200)}
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in fps]
    rows = spark.createDataFrame([(i, f) for i, f in enumerate(signed)], "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash.with_components(rows, crowd=crowd).collect()}
    roots = brute_components(fps)
    least = {}
    for i, r in enumerate(roots):
        least[r] = min(i, least.get(r, i))
    assert got == {i: least[r] for i, r in enumerate(roots)}


def test_distinct_keeps_one_of_each(odd_documents, no_documents):
    kept = simhash.distinct(odd_documents)
    assert kept.columns == odd_documents.columns
    pairs = {(r.doc_id, r.component_id) for r in simhash.components(odd_documents).collect()}
    assert {r.doc_id for r in kept.collect()} == {d for d, c in pairs if d == c}
    assert simhash.distinct(no_documents).collect() == [] and simhash.components(no_documents).collect() == []


def test_distinct_decides_by_row(spark):
    rng = np.random.default_rng(11)
    text = lambda: " ".join(f"w{i}" for i in rng.integers(0, 5000, 60))
    shared, lone, clean, other, unnamed = (text() for _ in range(5))
    rows = [(1, shared), (None, shared), (None, lone), (2, shared), (2, clean), (7, other), (7, other), (None, unnamed), (None, unnamed)]
    kept = [tuple(r) for r in simhash.distinct(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(kept, key=str) == sorted([(1, shared), (None, lone), (2, clean), (7, other), (None, unnamed)], key=str)
