import hashlib
import math
import random

from marquee.llm import annulus

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance double"


def plain(rows, centroids=16, rounds=3):
    scaled = lambda x: int(x) * 64 if abs(x) >= 2**53 else math.floor(x * 64)
    kept = [(i, [scaled(x) for x in v]) for i, v, *_ in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in first[:centroids]]
    squared = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((squared(v, c), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        of = {}
        for _, v in kept:
            of.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(col) // len(of[j]) for col in zip(*of[j], strict=True)] if j in of else c for j, c in enumerate(centres)]
    out = [(i, *nearest(v)) for i, v in kept]
    fit = lambda d: d if d < 2**63 else None
    known = lambda ds: None if any(d >= 2**63 for d in ds) else fit(sum(ds))
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted([(i, j, fit(d), known([e for _, e, k in out if k == j]), known([e for _, e, _ in out]), names[j]) for i, d, j in out], key=str)


def found(spark, rows):
    return sorted(map(tuple, annulus.cluster(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()), key=str)


def row(i, values):
    return i, values, "x", 0.5


def test_equals_plain_rounds_with_odd_rows(spark):
    rng = random.Random(1)
    rows = [row(i, [rng.gauss(i % 5, 0.6) for _ in range(64)]) for i in range(150)]
    rows += [row(None, [0.5] * 64), row(7, [0.5] * 64), row(7, [0.5] * 64), rows[3], rows[3]]
    rows += [row(200, None), row(201, [1.0]), row(202, [None] + [1.0] * 63), row(203, [float("nan")] * 64), row(204, [float("-inf")] + [1.0] * 63), row(205, [])]
    assert found(spark, rows) == plain(rows)


def test_ties_go_to_the_smaller_number(spark):
    rows = [row(i, [float((i >> b) & 1) for b in range(3)] + [0.0] * 61) for i in range(64)]
    assert found(spark, rows) == plain(rows)


def test_components_of_any_size_are_exact(spark):
    rng = random.Random(2)
    rows = [row(i, [rng.choice([rng.random(), 1e30 * rng.random(), -1e300, 3e5, 2.0**60]) for _ in range(64)] if i % 3 == 0 else [rng.gauss(0, 1) for _ in range(64)]) for i in range(60)]
    assert found(spark, rows) == plain(rows)


def test_few_vectors_and_none(spark):
    rows = [row(i, [float(i)] * 64) for i in range(3)]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []
    assert found(spark, [row(1, None)]) == []


def test_annulus_leaves_out_far_norms():
    centres = [[i * 10] + [0] * 63 for i in range(16)]
    search = annulus.Annulus(centres)
    import numpy as np

    x = np.array([[c[0] + 4] + [0] * 63 for c in centres], float)
    number, squared = search.nearest(x)
    assert number.tolist() == list(range(16)) and squared.tolist() == [16.0] * 16
    assert [search.one([int(v) for v in r]) for r in x] == [(i, 16) for i in range(16)]
