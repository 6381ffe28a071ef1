"""Exact top-k by inner product: best-first search in M-trees.

Vectors are turned into whole numbers. Largest inner product becomes nearest neighbour in a metric by one more
coordinate: with L the greatest length of all, a vector x gets sqrt(L^2 - |x|^2) and a query q gets 0, so the squared
distance is |q|^2 + L^2 - 2 q.x and falls as the product grows.

The top page is a table of routing objects: at most ROUTES rows of each length of vector, drawn by hash, with the number
of rows that are nearest to each and their covering radius. It is the only thing sent to every task, and it doesn't grow
beyond ROUTES. A routing object's rows are dealt to units of about PART rows, so one that a third of all rows are nearest
to is many units. Queries are a distributed table. First each goes to the units of its nearest routing object, which
gives a k-th best product; then to the units of those other routing objects whose radius lets a row beat it. A unit's
rows and queries meet in one task as a stream, rows first, QUERIES queries to a copy of the unit at most.

A unit is an M-tree: pages of PAGE entries, each entry a routing object with its covering radius and its distance to the
parent's routing object. A query walks it best first: a page is opened only if the least distance that its radius allows
can still beat the k-th best product, and |d(query, parent) - d(parent, entry)|, known before any distance is computed,
already drops entries. Products are whole numbers: in 64 bits where no sum can pass 2^62, in Python's integers else; bounds
in floating point are widened by SLACK.

Cases: vectors that are null, empty, or hold null or non-finite components take no part, nor do rows with a null vec_id;
vectors of another length than the query's are no candidates; rows that repeat a vec_id are rows like others: each is
answered for itself, and each is a candidate of the other; a score among the best that no long holds, or a component
whose 1024-fold no double holds, is an error; an empty table or no query gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.llm import common

K = 10
SCALE = 1024
PAGE = 256
PART = 8192
ROUTES = 2048
QUERIES = 16_384
SLACK = 1e-6
SAFE = 1 << 62
LONG = 1 << 63
FOUND = "query bigint, query_id bigint, vec_id bigint, row bigint, score bigint"


def usable(rows: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part."""
    e = F.col("embedding").cast("array<double>")
    good = F.col("vec_id").isNotNull() & (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(good).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"))


def whole(vectors: list | np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as doubles, which hold these whole numbers exactly."""
    v = np.floor(scale * np.asarray(vectors, np.float64))
    if not np.isfinite(v).all():
        raise OverflowError("a component is too large to be scaled")
    return v


def products(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of whole vectors with one, exact: int64, or Python integers where a sum may not fit."""
    if np.abs(v).max(initial=0.0) * np.abs(q).max(initial=0.0) * len(q) < SAFE:
        return v.astype(np.int64) @ q.astype(np.int64)
    exact = [int(x) for x in q]
    return np.array([sum(int(a) * b for a, b in zip(x, exact, strict=True)) for x in v.tolist()], object)


def raised(v: np.ndarray, longest2: float) -> np.ndarray:
    """Vectors with the coordinate that makes the largest product the nearest neighbour."""
    return np.concatenate([v, np.sqrt(np.maximum(longest2 - (v * v).sum(axis=1), 0))[:, None]], axis=1)


class Tree:
    """An M-tree over rows of one length, built from the top: every page splits by the routing object nearest to each entry."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, v: np.ndarray, longest2: float, page: int = PAGE):
        self.ids, self.rows, self.v, self.page = ids, rows, v, page
        self.most = float(np.abs(v).max(initial=0.0))
        self.whole = v.astype(np.int64) if self.most < 2**62 else None
        self.x = raised(v, longest2)
        self.slack = SLACK * (1 + np.sqrt(longest2))
        self.nodes: list[tuple] = []
        self.root = self.build(np.arange(len(ids)), None)

    def distances(self, rows: np.ndarray, to: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(((self.x[rows] - to) ** 2).sum(axis=1), 0))

    def build(self, rows: np.ndarray, centre: np.ndarray | None) -> int:
        """A node: (is leaf, rows or routing objects, their distances to the parent's, their radii, children)."""
        at = len(self.nodes)
        self.nodes.append(())
        if len(rows) <= self.page:
            to = np.zeros(len(rows)) if centre is None else self.distances(rows, centre)
            self.nodes[at] = (True, rows, to, None, None)
            return at
        fan = int(min(self.page, -(-len(rows) // (self.page // 2))))
        chosen = rows[np.linspace(0, len(rows) - 1, fan).astype(np.int64)]
        d2 = -2 * self.x[rows] @ self.x[chosen].T + (self.x[chosen] ** 2).sum(axis=1)
        nearest = d2.argmin(axis=1)
        largest = np.bincount(nearest, minlength=fan).max()
        if largest == len(rows):  # all alike: any division is as good
            nearest = np.arange(len(rows)) % fan
        routes, to, radii, children = [], [], [], []
        for k in range(fan):
            mine = rows[nearest == k]
            if len(mine):
                own = self.x[chosen[k]]
                routes.append(chosen[k])
                to.append(0.0 if centre is None else float(np.sqrt(((own - centre) ** 2).sum())))
                radii.append(float(self.distances(mine, own).max()))
                children.append(self.build(mine, own))
        self.nodes[at] = (False, np.array(routes), np.array(to), np.array(radii), children)
        return at

    def scores(self, rows: np.ndarray, q: np.ndarray, whole_q: np.ndarray | None) -> np.ndarray:
        return products(self.v[rows], q) if whole_q is None else self.whole[rows] @ whole_q

    def best(self, q: np.ndarray, longest2: float, k: int, own: int, floor: int | None = None) -> list[tuple[int, int, int]]:
        """(score, vec_id, row) of the k best candidates of a query with at least the score floor, best first. own: the query's row."""
        point = np.append(q, 0.0)
        q2 = float(point @ point)
        small = self.whole is not None and self.most * np.abs(q).max(initial=0.0) * len(q) < SAFE
        whole_q = q.astype(np.int64) if small else None
        top: list[tuple[int, int, int]] = []  # a heap of (score, -vec_id, -row), the worst first

        def reach() -> float:
            least = top[0][0] if len(top) == k else floor
            if least is None:
                return np.inf
            return np.sqrt(max(0.0, q2 + longest2 - 2.0 * float(least))) + self.slack

        queue = [(0.0, self.root, None)]
        while queue:
            least, at, to_parent = heapq.heappop(queue)
            r = reach()
            if least > r:
                break
            leaf, rows, parent, radii, children = self.nodes[at]
            if to_parent is None:
                near = np.arange(len(rows))
            else:
                bound = np.abs(to_parent - parent) - (0 if leaf else radii)
                near = np.flatnonzero(bound <= r + self.slack)
            if leaf:
                rows = rows[near]
                rows = rows[self.rows[rows] != own]
                scores = self.scores(rows, q, whole_q)
                if len(top) == k or floor is not None:
                    some = np.flatnonzero(scores >= (top[0][0] if len(top) == k else floor))
                    rows, scores = rows[some], scores[some]
                for s, i, n in zip(scores.tolist(), self.ids[rows].tolist(), self.rows[rows].tolist(), strict=True):
                    if len(top) < k:
                        heapq.heappush(top, (s, -i, -n))
                    elif (s, -i, -n) > top[0]:
                        heapq.heapreplace(top, (s, -i, -n))
            else:
                d = self.distances(rows[near], point)
                for j, dist in zip(near.tolist(), d.tolist(), strict=True):
                    low = max(0.0, dist - radii[j])
                    if low <= r + self.slack:
                        heapq.heappush(queue, (low - self.slack, children[j], dist))
        return sorted(((s, -i, -n) for s, i, n in top), key=lambda x: (-x[0], x[1], x[2]))


def _lists(column: pa.Array) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.split(flat, np.cumsum(np.diff(column.offsets.to_numpy()))[:-1]) if len(column) else []


def _far(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distances of all points to all centres, without their differences in memory at once."""
    out = np.empty((len(points), len(centres)))
    for i in range(len(centres)):
        out[:, i] = np.sqrt(((points - centres[i]) ** 2).sum(axis=1))
    return out


def _by_size(vectors: list[np.ndarray]):
    sizes = np.array([len(x) for x in vectors])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield int(size), at, whole(np.stack([vectors[i] for i in at]))


def routes(rows: DataFrame, part: int, most: int) -> tuple[dict[int, np.ndarray], float]:
    """Routing objects of each length of vector, as whole vectors, and the square of the greatest length."""
    square = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, x: a + (SCALE * F.abs(x) + 1) * (SCALE * F.abs(x) + 1))
    sizes = rows.groupBy(F.size("embedding").alias("size")).agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("longest")).collect()
    if not sizes:
        return {}, 0.0
    if not np.isfinite(max(r["longest"] for r in sizes)):
        raise OverflowError("a component is too large to be scaled")
    wanted = {r["size"]: min(most, -(-r["n"] // part)) for r in sizes}
    share = F.element_at(F.create_map(*(F.lit(x) for r in sizes for x in (r["size"], min(1.0, (4 * wanted[r["size"]] + 16) / r["n"])))), F.size("embedding"))
    draw = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.filter(draw < share).select("embedding", draw.alias("draw"), "vec_id").collect()
    out: dict[int, np.ndarray] = {}
    for size, same in groupby(sorted(drawn, key=lambda r: (len(r["embedding"]), r["draw"], r["vec_id"], r["embedding"])), key=lambda r: len(r["embedding"])):
        different = np.array(list(dict.fromkeys(tuple(r["embedding"]) for r in same))[: wanted[size]])
        out[size] = whole(different)
    for size in wanted:
        out.setdefault(size, np.zeros((1, size)))
    return out, max(r["longest"] for r in sizes) * (1 + 1e-9)


def placed(rows: DataFrame, centres: dict[int, np.ndarray], longest2: float) -> DataFrame:
    """vec_id, embedding, route (the nearest routing object), far (the distance to it)."""
    points = {size: raised(c, longest2) for size, c in centres.items()}

    def run(batches):
        for batch in batches:
            route, far = np.zeros(len(batch), np.int64), np.zeros(len(batch))
            for size, at, v in _by_size(_lists(batch.column("embedding"))):
                d = _far(raised(v, longest2), points[size])
                route[at] = d.argmin(axis=1)
                far[at] = d.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(route), pa.array(far)], [*batch.schema.names, "route", "far"])

    return rows.mapInArrow(run, f"vec_id long, embedding {rows.schema['embedding'].dataType.simpleString()}, route long, far double")


def asked(queries: DataFrame, centres: dict[int, np.ndarray], longest2: float, table: dict[tuple[int, int], tuple[int, float]], home: bool) -> DataFrame:
    """The queries' rows, one for each routing object that they have to be compared with: the nearest, or else all others that may hold better rows than floor."""
    slack = SLACK * (1 + np.sqrt(longest2))

    def run(batches):
        for batch in batches:
            take, route = [], []
            floors = batch.column("floor").to_pylist()
            for size, at, v in _by_size(_lists(batch.column("embedding"))):
                points = np.concatenate([v, np.zeros((len(v), 1))], axis=1)
                d = _far(points, raised(centres[size], longest2))
                n, radius = (np.array([table.get((size, k), (0, 0.0))[i] for k in range(len(centres[size]))]) for i in (0, 1))
                d[:, n == 0] = np.inf
                nearest = d.argmin(axis=1)
                if home:
                    take.append(at)
                    route.append(nearest)
                    continue
                q2 = (v * v).sum(axis=1)
                reach = np.array([np.inf if floors[i] is None else np.sqrt(max(0.0, q2[j] + longest2 - 2.0 * floors[i])) + slack for j, i in enumerate(at.tolist())])
                near = d - radius - slack <= reach[:, None]
                near[:, n == 0] = False
                near[np.arange(len(v)), nearest] = False
                a, b = np.nonzero(near)
                take.append(at[a])
                route.append(b)
            if take:
                rows = pa.array(np.concatenate(take).astype(np.int64))
                yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in batch.columns), pa.array(np.concatenate(route).astype(np.int64))], [*batch.schema.names, "route"])

    kind = queries.schema["embedding"].dataType.simpleString()
    return queries.select("row", "vec_id", "embedding", "floor").mapInArrow(run, f"row long, vec_id long, embedding {kind}, floor long, route long")


def met(vectors: DataFrame, queries: DataFrame, table: dict[tuple[int, int], tuple[int, float]], n_queries: int, longest2: float, k: int, page: int, part: int, block: int) -> DataFrame:
    """The k best rows of each query in each unit that it is sent to."""
    pieces = {key: max(1, -(-n // part)) for key, (n, _) in table.items()}
    copies = max(1, -(-n_queries // block))
    spark = vectors.sparkSession
    # one row for each routing object, most_routes for each length of vector at most: small enough to send everywhere
    units_of = F.broadcast(spark.createDataFrame([(*key, n) for key, n in pieces.items()], "size int, route long, pieces int"))
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    columns = ("size", "route", "piece", "copy", "kind", "row", "vec_id", "floor", "embedding")
    number = F.col("pieces")
    with_pieces = lambda x: x.withColumn("size", F.size("embedding")).join(units_of, ["size", "route"])
    rows = with_pieces(vectors).withColumns({"piece": F.pmod(F.xxhash64("row"), number).cast("int"), "copy": each(F.lit(copies)), "kind": F.lit(0), "floor": F.lit(None).cast("long")})
    asks = with_pieces(queries).withColumns({"piece": each(number), "copy": F.pmod(F.xxhash64("row"), F.lit(copies)).cast("int"), "kind": F.lit(1)})
    units = min(10_000, 4 * copies * sum(pieces.values()))  # more than there are units, so that few share a task
    both = rows.select(*columns).unionByName(asks.select(*columns)).repartition(units, "size", "route", "piece", "copy")

    def run(batches):
        now, held, tree = None, [], None
        out: list[tuple[int, int, int, int, int]] = []
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("size", "route", "piece", "copy")), strict=True))
            ids, numbers, floors, kinds = (batch.column(c).to_pylist() for c in ("vec_id", "row", "floor", "kind"))
            vectors = _lists(batch.column("embedding"))
            for i, key in enumerate(keys):
                if key != now:
                    now, held, tree = key, [], None
                if kinds[i] == 0:
                    held.append((ids[i], numbers[i], vectors[i]))
                    continue
                if not held:
                    continue
                if tree is None:
                    held.sort(key=lambda x: x[:2])
                    tree = Tree(np.array([h[0] for h in held]), np.array([h[1] for h in held]), whole(np.stack([h[2] for h in held])), longest2, page)
                for score, vec_id, row in tree.best(whole(vectors[i]), longest2, k, numbers[i], floors[i]):
                    if not -LONG <= score < LONG:
                        raise OverflowError(f"the score of {ids[i]} and {vec_id} does not fit 64 bits")
                    out.append((numbers[i], ids[i], vec_id, row, score))
                if len(out) > 20_000:
                    yield _found(out)
                    out = []
        if out:
            yield _found(out)

    return both.sortWithinPartitions("size", "route", "piece", "copy", "kind").mapInArrow(run, FOUND)


def _found(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["query", "query_id", "vec_id", "row", "score"])


def search(rows: DataFrame, query_of: Column, k: int = K, page: int = PAGE, part: int = PART, most_routes: int = ROUTES, block: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score of every row that query_of is true for."""
    rows = usable(rows)
    centres, longest2 = routes(rows, part, most_routes)
    vectors = common.cut(placed(rows, centres, longest2).withColumn("row", F.monotonically_increasing_id()))
    of_route = vectors.groupBy(F.size("embedding").alias("size"), "route").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius"))
    table = {(r["size"], r["route"]): (r["n"], r["radius"]) for r in of_route.collect()}  # at most most_routes rows a length
    if not table:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    queries = vectors.filter(query_of)
    n_queries = queries.count()
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    best = lambda found: found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    at_home = asked(queries.withColumn("floor", F.lit(None).cast("long")), centres, longest2, table, home=True)
    first = common.cut(best(met(vectors, at_home, table, n_queries, longest2, k, page, part, block)))
    if len(table) == len(centres):  # one routing object for each length: all rows were at home
        return first.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    floors = first.filter(F.col("rank") == k).select(F.col("query").alias("row"), F.col("score").alias("floor"))
    elsewhere = asked(queries.join(floors, "row", "left"), centres, longest2, table, home=False)
    second = met(vectors, elsewhere, table, n_queries, longest2, k, page, part, block)
    ranked = best(first.drop("rank").unionByName(second))
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def top_k(rows: DataFrame, query_of: Column, k: int = K) -> DataFrame:
    """The k best of every row that query_of (of vec_id) is true for, among all other rows."""
    return search(rows, query_of, k)


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.row AS query, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.row <> c.row WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10
"""
