"""One of each group of near copies by the Jaccard similarity of word shingles, exact: SimHash first, then what it can't see.

Each text has a SimHash fingerprint of its shingles; marquee.llm.simhash links those that few bits tell apart by its
Gray-order index, and every link is verified by the similarity of the whole sets. A similarity of SIMILARITY leaves some ten
of 64 bits different, more than any index of equal blocks can search, so the links found are a beginning, and a prefix
filter completes them:

A text's set holds the XXH64 values of its shingles. Texts of SIMILARITY or more share at least `need` = ceil(SIMILARITY *
n) of their n values, so in any one order of all values the least value they share is among the first n - need + 1 of
each (prefix filter), at places that leave room for the overlap (positional filter). Values that are frequent in a
sample of texts come last in that order, which keeps common passages out of the prefixes; the order decides on cost
only, never on what is found. Texts that share a prefix value are candidates, and sets are compared whole.

Equal sets are one candidate. First each candidate meets two of those it shares a value with: the most central, whose
prefix values have the most texts in all, as the text that a crowd was copied from has, and one drawn by hash. This joins
crowds of copies without comparing all pairs; then every pair of candidates that is still in two components is compared. A crowd
that shares its rare values and still isn't similar is compared pair by pair.

Before texts of a pair are moved, their parity maps are compared (bitmap filter): a value flips one bit of a map, so maps differ
in at most as many bits as sets in values, and a pair whose maps differ in more bits than its sets may is given up. This too loses
no pair; what is left is compared by the texts.

Cases: texts without words have equal (empty) sets; a text of SHINGLE words or fewer is one shingle; of a component the
row with the least doc_id stays, one without a doc_id only if no other is there, and of rows with equal doc_ids one; an
empty table gives no rows; other columns of any name are kept.
"""

from __future__ import annotations

import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import common, simhash

SHINGLE = 5
SIMILARITY = 0.8
SAMPLE = 8
OFTEN = 3
MOST_COMMON = 50_000
PAIRS = 1 << 20
UNSENT = 16
WANTED = 1_000_000


def shingle_set(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    return np.unique(simhash.shingle_hashes(text, shingle))


def _ordered(values: np.ndarray, names: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The values by rank, those without one first. names: sorted."""
    if not len(names) or not len(values):
        return values
    at = np.minimum(np.searchsorted(names, values), len(names) - 1)
    return values[np.argsort(np.where(names[at] == values, rank[at], -1), kind="stable")]


def parity(values: np.ndarray) -> bytes:
    """A bit for each value, flipped by each of the distinct values that fall on it; the number of bits is a power of two."""
    bits = 1 << max(6, (len(values) - 1).bit_length())
    return np.packbits(np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1, bitorder="little").tobytes()


def apart(x: bytes, y: bytes) -> int:
    """At least so many values are in one of the sets only. x, y: their parity maps; the longer is folded to the shorter."""
    least = min(len(x), len(y))
    fold = lambda m: np.bitwise_xor.reduce(np.frombuffer(m, np.uint8).reshape(-1, least))
    return int(np.bitwise_count(fold(x) ^ fold(y)).sum())


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    at = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(_signed(np.concatenate([np.zeros(0, np.uint64), *parts]))))


def common_values(rows: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The values that many texts of a sample hold, sorted, and their ranks by frequency."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate([np.zeros(0, np.uint64), *(shingle_set(t or b"", shingle) for t in texts)])))], ["v"])

    sample = rows.select("text").filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    often = sample.mapInArrow(run, "v long").groupBy("v").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= OFTEN)
    top = often.orderBy(F.desc("n"), "v").limit(MOST_COMMON).toArrow()
    names = top.column("v").to_numpy().astype(np.int64).view(np.uint64)
    by = np.argsort(names)
    return names[by], (len(names) - np.arange(len(names)))[by]


def prefixes(rows: DataFrame, shingle: int, share: Fraction, names: np.ndarray, rank: np.ndarray) -> DataFrame:
    """r1, r2, doc_id, k1 and k2 (a 128-bit name of the set), n (its size), vals, its prefix, fp, the fingerprint, and bits, the parity map."""

    def run(batches):
        from xxhash import xxh3_128_intdigest

        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            every = [simhash.shingle_hashes(t, shingle) for t in texts]
            whole = [np.unique(x) for x in every]
            keys = [xxh3_128_intdigest(x.tobytes()) for x in whole]
            first = [_ordered(x, names, rank)[: len(x) - -(-share.numerator * len(x) // share.denominator) + 1] for x in whole]
            halves = [pa.array(_signed(np.array([k >> s & 0xFFFFFFFFFFFFFFFF for k in keys], np.uint64))) for s in (64, 0)]
            columns = {k: batch.column(k) for k in ("r1", "r2", "doc_id")} | {"k1": halves[0], "k2": halves[1], "n": pa.array([len(x) for x in whole], pa.int32()), "vals": _lists(first), "fp": pa.array(np.array([simhash.majority(x) for x in every], np.uint64).view(np.int64)), "bits": pa.array([parity(x) for x in whole], pa.binary())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return rows.select("r1", "r2", "doc_id", "text").mapInArrow(run, "r1 long, r2 long, doc_id long, k1 long, k2 long, n int, vals array<long>, fp long, bits binary")


def _by_value(rows: DataFrame, found, schema: str) -> DataFrame:
    """found(columns, start of each group) over whole groups of equal v. rows: numbers without nulls."""
    rows = rows.repartition("v").sortWithinPartitions("v")

    def given(batch):
        v = batch.column("v").to_numpy()
        start = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
        for arrays in found({k: batch.column(k).to_numpy() for k in batch.schema.names}, np.append(start, len(v))):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays.values()], list(arrays))

    def run(batches):
        held = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            v = batch.column("v").to_numpy()
            if v[0] == v[-1] or sum(map(len, held)) < 20_000:
                continue
            last = int(np.flatnonzero(v != v[-1])[-1]) + 1
            yield from given(pa.Table.from_batches([*held[:-1], batch.slice(0, last)]).combine_chunks().to_batches()[0])
            held = [batch.slice(last)]
        if held:
            yield from given(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return rows.mapInArrow(run, schema)


def _shared(x: dict, start: np.ndarray):
    size = np.repeat(np.diff(start), np.diff(start))
    several = {k: c[size > 1] for k, c in x.items()}
    yield {"_row": several["_row"], "n": (several["at"] >> 32).astype(np.int32), "pos": (several["at"] & 0xFFFFFFFF).astype(np.int32), "v": several["v"], "size": size[size > 1]}


def _fit(x: dict, i: np.ndarray, j: np.ndarray, share: Fraction) -> np.ndarray:
    """Whether sets that share the value at these places, and none before it, can be similar enough."""
    n, m = x["n"][i].astype(np.int64), x["n"][j].astype(np.int64)
    most = np.minimum(n - x["pos"][i], m - x["pos"][j])
    return (x["_row"][i] != x["_row"][j]) & (most * (share.numerator + share.denominator) >= share.numerator * (n + m))


def _pairs(x: dict, i: np.ndarray, j: np.ndarray) -> dict:
    a, b = x["_row"][i], x["_row"][j]
    return {"a": np.minimum(a, b), "b": np.maximum(a, b)}


def _to_pivots(share: Fraction):
    def found(x, start):
        at, sizes = np.arange(start[-1]), np.diff(start)
        group = np.repeat(np.arange(len(sizes)), sizes)
        drawn = common.mix(x["_row"].view(np.uint64) + np.uint64(common.BASE))
        for order in (np.lexsort((drawn, -x["central"], group)), np.lexsort((drawn, group))):
            pivot = np.repeat(order[start[:-1]], sizes)
            fit = _fit(x, at, pivot, share)
            yield _pairs(x, at[fit], pivot[fit])

    return found


def _across(share: Fraction):
    def found(x, start):
        ends = np.repeat(start[1:], np.diff(start))
        later = ends - np.arange(start[-1]) - 1
        upto, i = np.cumsum(later), 0
        while i < len(later):
            end = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + PAIRS, "right")))
            n = later[i:end]
            first = np.repeat(np.arange(i, end), n)
            second = first + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            fit = (x["root"][first] != x["root"][second]) & _fit(x, first, second, share)
            yield _pairs(x, first[fit], second[fit])
            i = end

    return found


def _of_few(rows: DataFrame, table: DataFrame, how: str) -> DataFrame:
    """rows joined by _row with a checkpointed table; rows stay where they are if it has WANTED rows at most."""
    return rows.join(F.broadcast(table) if table.limit(WANTED + 1).count() <= WANTED else table, "_row", how)


def alike(pairs: DataFrame, sets: DataFrame, share: Fraction) -> DataFrame:
    """The pairs a, b but those whose parity maps show that they aren't similar enough. sets: _row, n, bits."""

    def run(batches):
        for batch in batches:
            x = {k: batch.column(k).to_pylist() for k in ("n_a", "n_b", "bits_a", "bits_b")}
            kept = [(share.denominator - share.numerator) * (n + m) >= (share.denominator + share.numerator) * apart(p, q) for n, m, p, q in zip(*x.values(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    of = lambda k: sets.select(F.col("_row").alias(k), F.col("n").alias(f"n_{k}"), F.col("bits").alias(f"bits_{k}"))
    both = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    return both.mapInArrow(run, "a long, b long")


def texts_of(pairs: DataFrame, sets: DataFrame, rows: DataFrame) -> DataFrame:
    """_row and packed, the text, of the rows in pairs a, b; no other text is moved."""
    named = pairs.select(F.col("a").alias("_row")).union(pairs.select("b")).distinct()
    wanted = common.few(common.cut(named.join(sets.select("_row", "r1", "r2"), "_row")))
    found = common.with_table(rows.select("r1", "r2", "text"), wanted, ["r1", "r2"], "inner", WANTED).select("_row", "text")

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array([zlib.compress(t or b"", 1) for t in texts], pa.binary())], ["_row", "packed"])

    return found.mapInArrow(run, "_row long, packed binary").dropDuplicates(["_row"])


def similar(pairs: DataFrame, sets: DataFrame, rows: DataFrame, shingle: int, share: Fraction) -> DataFrame:
    """Those of the checkpointed pairs a, b whose sets are similar enough, as edges u, v. sets: _row, r1, r2, n, bits. rows: r1, r2, text."""

    def run(batches):
        before, x = None, None
        for batch in batches:
            kept = []
            for a, pa_, pb in zip(batch.column("a").to_pylist(), batch.column("packed_a").to_pylist(), batch.column("packed_b").to_pylist(), strict=True):
                if a != before:
                    before, x = a, shingle_set(zlib.decompress(pa_), shingle)
                y = shingle_set(zlib.decompress(pb), shingle)
                same = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(share.denominator * same >= share.numerator * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["u", "v"]).filter(pa.array(kept, pa.bool_()))

    pairs = common.few(common.cut(alike(common.few(pairs), sets, share)))
    texts = texts_of(pairs, sets, rows)
    of = lambda k: texts.select(F.col("_row").alias(k), F.col("packed").alias(f"packed_{k}"))
    both = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "packed_a", "packed_b")
    return common.few(common.cut(both.mapInArrow(run, "u long, v long")))


def linked_fingerprints(sets: DataFrame) -> DataFrame:
    """Pairs a, b of rows whose fingerprints are equal or linked; one row stands for those of a fingerprint."""
    least = common.cut(sets.groupBy("fp").agg(F.min("_row").alias("first")))
    equal = sets.join(least, "fp").filter("_row <> first").select("_row", "first")
    of = lambda k: least.select(F.col("fp").alias(k), F.col("first").alias(f"row_{k}"))
    near = simhash.links(least.select("fp")).join(of("u"), "u").join(of("v"), "v").select("row_u", "row_v")
    return equal.union(near).toDF("x", "y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def links(sets: DataFrame, rows: DataFrame, shingle: int, share: Fraction) -> DataFrame:
    """Edges u, v: enough of them that components are those of all similar pairs. sets: _row, r1, r2, n, vals, fp, bits of distinct sets. rows: r1, r2, text."""
    # all places are shuffled, so they are kept short; values that differ in their last bits only make candidates too many
    places = sets.select("n", "_row", F.posexplode("vals").alias("pos", "v")).select(F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("pos").cast("long")).alias("at"), "_row", F.shiftrightunsigned("v", UNSENT).alias("v"))
    shared = common.cut(_by_value(places, _shared, "_row long, n int, pos int, v long, size long"))
    central = shared.groupBy("_row").agg(F.sum("size").alias("central"))
    near = common.cut(_by_value(shared.drop("size").join(central, "_row"), _to_pivots(share), "a long, b long").union(linked_fingerprints(sets.select("_row", "fp"))).distinct())
    edges = similar(near, sets, rows, shingle, share)
    roots = simhash.stars(edges)
    placed = _of_few(shared, common.cut(roots.withColumnRenamed("node", "_row")), "left").select("_row", "n", "pos", "v", F.coalesce("root", "_row").alias("root"))
    others = common.cut(_by_value(placed, _across(share), "a long, b long").distinct().join(near, ["a", "b"], "left_anti"))
    return edges.union(similar(others, sets, rows, shingle, share))


def distinct(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs, one of each component of similar texts."""
    share = Fraction(str(similarity))
    if not 0 < share <= 1:
        raise ValueError("similarity is above 0 and at most 1")
    common.small_batches(docs.sparkSession)
    rows = simhash.keyed(docs)
    slim = common.cut(prefixes(rows, shingle, share, *common_values(rows, shingle)).withColumn("_row", F.monotonically_increasing_id()))
    groups = common.cut(slim.groupBy("k1", "k2").agg(simhash.first_row("_row").alias("first")).select("first", F.col("first._row").alias("node")))
    copies = common.cut(slim.select("_row").join(groups.select(F.col("node").alias("_row")), "_row", "left_anti"))
    one = _of_few(slim, copies, "left_anti")
    return simhash.one_of_each(rows, slim.select("r1", "r2"), groups, links(one, rows, shingle, share))
