"""Centroid clustering by annulus search: Lloyd's rounds over whole numbers, exact, with candidates chosen by norm.

Centroids are sorted by norm. A vector's distance to the centroid whose norm is next to its own is an upper bound; by the
triangle inequality nothing nearer has a norm outside |x| - bound to |x| + bound, so a binary search finds the
candidates, ties at the edge among them, and only those are compared, exactly. The 16 centroids travel with the task; vectors
are never shuffled. A round returns sums of each task (64 numbers a centroid), which Spark adds.

Products of components up to SAFE are whole numbers below 2 ** 53, so double arithmetic is exact for them. Vectors or
centroids with larger components go by Python's whole numbers; sums leave a task in pieces of 32 bits.

Cases: vectors that are null, of another length, or hold null or non-finite components are left out. Rows with a null
vec_id are clustered, but start no centroid unless others are too few. Repeated ids are rows of their own; equal hashes
are ordered by components. Fewer vectors than centroids: as many centroids as vectors. An empty table gives no rows. A distance
or inertia over 2 ** 63 - 1 is null. Further columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import cut, small_batches

CENTROIDS, ROUNDS, LENGTH, SCALE = 16, 3, 64, 64
SAFE = 1 << 22
PIECE = 32
LARGEST = (1 << 63) - 1
SUMS = "cluster int, piece int, n long, total array<long>"
ASSIGNED = "vec_id long, cluster int, distance long"


def usable(vectors: DataFrame, length: int = LENGTH) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    values = F.col("embedding").cast("array<double>")
    return vectors.filter((F.size("embedding") == length) & F.forall(values, lambda x: F.coalesce(fine(x), F.lit(False)))).select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("embedding"))


def whole(values: np.ndarray, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) as doubles, exact where the second result, one flag a row, is true."""
    with np.errstate(over="ignore"):
        x = np.floor(values * scale)
    return x, (np.abs(x) <= SAFE).all(axis=1)


def exactly(row: np.ndarray, scale: int = SCALE) -> list[int]:
    """The same as Python's whole numbers; from 2 ** 53 on doubles are whole before they are scaled."""
    return [int(x) * scale if abs(x) >= 1 << 53 else math.floor(float(x) * scale) for x in row]


def _squared(a: list[int], b: list[int]) -> int:
    return sum((x - y) * (x - y) for x, y in zip(a, b, strict=True))


class Annulus:
    """Centroids by norm. nearest() gives the number of the nearest one and the squared distance for each vector."""

    def __init__(self, centroids: list[list[int]]):
        norms = [math.isqrt(sum(x * x for x in c)) for c in centroids]
        self.number = sorted(range(len(centroids)), key=lambda i: (norms[i], i))
        self.exact = [centroids[i] for i in self.number]
        self.norm = [norms[i] for i in self.number]
        self.safe = np.array([all(abs(x) <= SAFE for x in c) for c in self.exact], bool)
        # an unsafe centroid takes no part in double arithmetic
        self.doubles = np.array([c if ok else [0] * len(c) for c, ok in zip(self.exact, self.safe, strict=True)], np.float64)
        self.squares = (self.doubles * self.doubles).sum(axis=1)
        self.edge = np.array([min(n, 1 << 200) for n in self.norm], np.float64)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For vectors with components up to SAFE."""
        number = np.array(self.number)
        square = (x * x).sum(axis=1)
        norm = np.sqrt(square)
        fit = np.flatnonzero(self.safe)
        if not len(fit):
            out = [self.one([int(v) for v in row]) for row in x]
            return np.array([n for n, _ in out]), np.array([min(d, LARGEST) for _, d in out], np.float64)
        guess = fit[np.minimum(np.searchsorted(self.edge[fit], norm), len(fit) - 1)]
        best = square + self.squares[guess] - 2 * np.einsum("ij,ij->i", x, self.doubles[guess])
        found = number[guess]
        bound = np.sqrt(best)
        # norms are rounded down by less than one, roots by far less
        low = np.searchsorted(self.edge, norm - bound - 2, "left")
        high = np.searchsorted(self.edge, norm + bound + 2, "right")
        for j in fit:
            rows = np.flatnonzero((low <= j) & (j < high) & (guess != j))
            if len(rows):
                d = square[rows] + self.squares[j] - 2 * (x[rows] @ self.doubles[j])
                better = (d < best[rows]) | ((d == best[rows]) & (number[j] < found[rows]))
                best[rows[better]], found[rows[better]] = d[better], number[j]
        for j in np.flatnonzero(~self.safe):
            for i in np.flatnonzero((low <= j) & (j < high)):
                d = _squared([int(v) for v in x[i]], self.exact[j])
                if (d, self.number[j]) < (int(best[i]), int(found[i])):
                    best[i], found[i] = d, self.number[j]
        return found, best

    def one(self, x: list[int]) -> tuple[int, int]:
        """For any vector."""
        from bisect import bisect_left, bisect_right

        norm = math.isqrt(sum(v * v for v in x))
        guess = min(bisect_left(self.norm, norm), len(self.norm) - 1)
        bound = math.isqrt(_squared(x, self.exact[guess]))
        near = range(bisect_left(self.norm, norm - bound - 2), bisect_right(self.norm, norm + bound + 2))
        distance, number = min((_squared(x, self.exact[j]), self.number[j]) for j in near)
        return number, distance


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        if len(batch):
            yield batch, batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)


def _pieces(cluster: int, n: int, total: list[int]) -> list[tuple[int, int, int, list[int]]]:
    """Sums in pieces of PIECE bits, the highest with the sign. The first carries n."""
    rows = []
    while True:
        small = all(-(1 << PIECE) < t < 1 << PIECE for t in total)
        rows.append((cluster, len(rows), 0 if rows else n, [t if small else t & ((1 << PIECE) - 1) for t in total]))
        if small:
            return rows
        total = [t >> PIECE for t in total]


def _sums(centroids: list[list[int]], scale: int):
    def run(batches):
        search, k = Annulus(centroids), len(centroids)
        count, total = np.zeros(k, np.int64), [[0] * len(centroids[0]) for _ in range(k)]
        for _, values in _matrices(batches):
            x, fits = whole(values, scale)
            small = x[fits]
            if len(small):
                found, _ = search.nearest(small)
                count += np.bincount(found, minlength=k)
                for c in np.unique(found):
                    # at most as many rows as a batch has, so the sums are exact in doubles
                    total[c] = [a + int(b) for a, b in zip(total[c], small[found == c].sum(axis=0), strict=True)]
            for row in values[~fits]:
                row = exactly(row, scale)
                c, _ = search.one(row)
                count[c] += 1
                total[c] = [a + b for a, b in zip(total[c], row, strict=True)]
        rows = [r for c in np.flatnonzero(count).tolist() for r in _pieces(c, int(count[c]), total[c])]
        if rows:
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["cluster", "piece", "n", "total"])

    return run


def _moved(vectors: DataFrame, centroids: list[list[int]], scale: int) -> list[list[int]]:
    """The centroids after one round. The driver gets one row for each centroid, piece and component."""
    sums = vectors.mapInArrow(_sums(centroids, scale), SUMS).select("cluster", "piece", "n", F.posexplode("total").alias("place", "part"))
    sums = sums.groupBy("cluster", "piece", "place").agg(F.sum("n").alias("n"), F.sum("part").alias("part"))
    total = [[0] * len(c) for c in centroids]
    count = [0] * len(centroids)
    for row in sums.collect():
        total[row.cluster][row.place] += row.part << (PIECE * row.piece)
        if not row.piece and not row.place:
            count[row.cluster] = row.n
    return [[t // n for t in ts] if n else c for c, ts, n in zip(centroids, total, count, strict=True)]


def _assigned(centroids: list[list[int]], scale: int):
    def run(batches):
        search = Annulus(centroids)
        for batch, values in _matrices(batches):
            x, fits = whole(values, scale)
            cluster, distance = np.zeros(len(x), np.int32), [0] * len(x)
            if fits.any():
                found, squared = search.nearest(x[fits])
                cluster[fits] = found
                for i, d in zip(np.flatnonzero(fits).tolist(), squared.tolist(), strict=True):
                    distance[i] = int(d)
            for i in np.flatnonzero(~fits):
                cluster[i], distance[i] = search.one(exactly(values[i], scale))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster), pa.array([d if d <= LARGEST else None for d in distance], pa.int64())], ["vec_id", "cluster", "distance"])

    return run


def first_centroids(vectors: DataFrame, centroids: int = CENTROIDS, scale: int = SCALE) -> list[list[int]]:
    """The vectors with the least hashes of their ids, in that order."""
    rows = vectors.orderBy(F.asc_nulls_last(F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)), "embedding").limit(centroids)
    return [exactly(np.array(r.embedding), scale) for r in rows.collect()]


def cluster(vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, length: int = LENGTH, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every usable vector."""
    small_batches(vectors.sparkSession, 10_000)
    vectors = usable(vectors, length)
    centres = first_centroids(vectors, centroids, scale)
    for _ in range(rounds if centres else 0):
        centres = _moved(vectors, centres, scale)
    rows = cut(vectors.mapInArrow(_assigned(centres, scale), ASSIGNED)) if centres else vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("total"), F.count("*").alias("n"), F.count("distance").alias("known")).collect() if centres else []
    inertia = {r.cluster: int(r.total) if r.known == r.n else None for r in sums}
    whole_sum = None if None in inertia.values() else sum(inertia.values())
    fit = lambda v: F.lit(v if v is not None and v <= LARGEST else None).cast("long")
    name = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    # one entry for each centroid
    of = lambda values: F.get(F.array(*values), F.col("cluster")) if values else F.lit(None)
    return rows.select(
        "vec_id",
        "cluster",
        "distance",
        of([fit(inertia.get(i, 0)) for i in range(len(centres))]).cast("long").alias("cluster_inertia"),
        fit(whole_sum).alias("inertia"),
        of([F.lit(name(c)) for c in centres]).cast("string").alias("centroid_sha256"),
    )


def _oracle() -> str:
    """The rounds one after another, every vector compared with every centroid."""
    steps = []
    for i in range(ROUNDS + 1):
        steps.append(f"""d{i} AS (SELECT k.id, c.cluster, list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance FROM kept k, c{i} c),
    a{i} AS (SELECT id, cluster, distance FROM d{i} QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, cluster) = 1)""")
        if i < ROUNDS:
            steps.append(f"""s{i} AS (SELECT a.cluster, p.place, sum(k.v[p.place])::BIGINT AS s, count(*) AS n FROM a{i} a JOIN kept k USING (id), places p GROUP BY ALL),
    m{i} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY place) AS v FROM s{i} GROUP BY cluster),
    c{i + 1} AS (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (cluster))""")
    end = ROUNDS
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE len(embedding) = {LENGTH} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {LENGTH}),
    places AS (SELECT unnest(range(1, {LENGTH + 1})) AS place),
    c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster, v FROM kept QUALIFY cluster < {CENTROIDS}),
    {", ".join(steps)}
    SELECT k.vec_id, a.cluster::INTEGER AS cluster, a.distance, sum(a.distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia, sum(a.distance) OVER ()::BIGINT AS inertia,
        sha256(array_to_string(c.v, ',')) AS centroid_sha256
    FROM a{end} a JOIN kept k USING (id) JOIN c{end} c USING (cluster)"""


ORACLE = _oracle()
