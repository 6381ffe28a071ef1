"""SimHash near-dedup over a Gray-order hierarchical index.

A fingerprint has a bit for each bit that is set in over half of the XXH64 values (seed 42) of the text's 3-word
shingles. Distinct fingerprints alone take part in the search, so exact copies cost one entry. Fingerprints at DISTANCE
or fewer differing bits have at least one of DISTANCE + 1 equal blocks of 16 bits; each fingerprint is dealt to its four
blocks. A block with over CROWD fingerprints is split in the same way by the 48 bits left, and what is still crowded is
dealt to pairs of salted parts, so every pair still meets somewhere and no task holds a whole crowd.

Where they meet, fingerprints are sorted by Gray rank, which puts those with long common bit patterns side by side.
Every FAN neighbours form a node that holds the bits all of them share; a node above holds what its nodes share, and a
node itself only the bits that its parent lacks. The search goes down from the top for all fingerprints at once, adds up
differing bits on the way, and drops a whole group when they pass DISTANCE. Of the links found, a task gives on one edge
per fingerprint, to the least one linked to it there; alternating stars over these edges give the components.

Cases: a null text or one without words has fingerprint zero and links like others; rows that repeat a doc_id each get a
row; a null doc_id counts for no component's least and has null if no other is in it; an empty table gives no rows;
other columns of any name are ignored by components() and kept by distinct().
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.llm import common

DISTANCE = 3
SHINGLE = 3
SEED = 42
CROWD = 1000
FAN = 8
FRONTIER = 2_000_000

_LANES = np.array([int.from_bytes(bytes(b >> i & 1 for i in range(8)), "little") for b in range(256)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    n = len(hashes)
    if not n:
        return 0
    lanes = _LANES[hashes.astype("<u8").view(np.uint8).reshape(n, 8)]
    sums = np.add.reduceat(lanes, np.arange(0, n, 255), axis=0)
    counts = np.ascontiguousarray(sums).view(np.uint8).reshape(len(sums), 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """A value for each shingle of a text, in their order; a text of fewer words is one shingle."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    pieces = (joined[a:b] for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True))
    return np.fromiter((xxh64_intdigest(x, SEED) for x in pieces), np.uint64, len(words) - shingle + 1)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    return majority(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, *kept: Column) -> DataFrame:
    """The kept columns and fp, the fingerprint as a signed 64-bit value."""
    common.small_batches(docs.sparkSession)
    rows = docs.select(*kept, F.col("text").cast("string").alias("text"))
    schema = rows.drop("text").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches):
        for batch in batches:
            text = batch.column("text").cast(pa.binary()).to_pylist()
            fp = np.array([fingerprint(t or b"") for t in text], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fp)], [*batch.schema.names[:-1], "fp"])

    return rows.mapInArrow(run, schema)


def gray_rank(fp: Column) -> Column:
    """The place of a 64-bit value in the order of reflected Gray codes."""
    for step in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, step))
    return fp


def _turned(fp: Column, bits: int) -> Column:
    return fp if bits == 0 else F.shiftleft(fp, bits).bitwiseOR(F.shiftrightunsigned(fp, 64 - bits))


def _crowded(rows: DataFrame, crowd: int) -> DataFrame:
    many = rows.groupBy("place").agg(F.count(F.lit(1)).alias("crowd")).filter(F.col("crowd") > crowd)
    return rows.join(many, "place", "left")


def meetings(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """fp, turned (fp with the common block first), place, a, b: who is compared with whom. fps: distinct fingerprints."""
    block = F.explode(F.array(*(F.struct(F.lit(r).alias("r"), _turned(F.col("fp"), 16 * r).alias("turned")) for r in range(4)))).alias("x")
    rows = fps.select("fp", block).select("fp", "x.turned", (F.col("x.r").cast("long") * 65536 + F.shiftrightunsigned(F.col("x.turned"), 48)).alias("place"))
    rows = _crowded(rows, crowd)
    parts = F.array(*(F.lit(r).cast("long") * 4096 + F.shiftrightunsigned(F.col("turned"), 12 * (3 - r)).bitwiseAND(F.lit(4095).cast("long")) for r in range(4)))
    inner = F.transform(parts, lambda p: (F.col("place") + 1) * 65536 + p)
    rows = rows.select("fp", "turned", F.explode(F.when(F.col("crowd").isNull(), F.array(-F.col("place") - 1)).otherwise(inner)).alias("place"))
    rows = _crowded(rows, crowd).withColumn("parts", F.coalesce(F.ceil(F.col("crowd") / crowd), F.lit(1)))
    salt = F.pmod(F.xxhash64("fp"), F.col("parts"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    rows = rows.withColumn("salt", salt).withColumn("other", other)
    return rows.select("fp", "turned", "place", F.least("salt", "other").alias("a"), F.greatest("salt", "other").alias("b"))


class Index:
    """Levels of nodes over sorted fingerprints of several groups; the top level has one node for each group."""

    def __init__(self, values: np.ndarray, group: np.ndarray):
        full = np.full(len(values), 0xFFFFFFFFFFFFFFFF, np.uint64)
        self.levels = [(values, full, None)]
        while True:
            values, mask, _ = self.levels[-1]
            new = np.append(True, group[1:] != group[:-1])
            if new.all():
                break
            start = np.flatnonzero(new)
            place = np.arange(len(group)) - start[np.cumsum(new) - 1]
            first = np.flatnonzero(place % FAN == 0)
            every, either = np.bitwise_and.reduceat(values & mask, first), np.bitwise_or.reduceat(values & mask, first)
            common_mask = np.bitwise_and.reduceat(mask, first) & ~(every ^ either)
            self.levels.append((values[first], common_mask, np.append(first, len(values))))
            group = group[first]
        self.new = [m if i + 1 == len(self.levels) else m & ~np.repeat(self.levels[i + 1][1], np.diff(self.levels[i + 1][2])) for i, (_, m, _) in enumerate(self.levels)]

    def search(self, queries: np.ndarray, values: np.ndarray, top: np.ndarray, distance: int):
        """Pairs (query, entry) with query < entry at most distance bits apart. top: each query's node on the top level."""
        node, off = top, np.zeros(len(queries), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            pattern, _, _ = self.levels[level]
            off = off + np.bitwise_count((values[queries] ^ pattern[node]) & self.new[level][node])
            near = off <= distance
            queries, node, off = queries[near], node[near], off[near]
            if level:
                first = self.levels[level][2]
                n = first[node + 1] - first[node]
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                node, queries, off = np.repeat(first[node], n) + step, np.repeat(queries, n), np.repeat(off, n)
        later = queries < node
        return queries[later], node[later]


def least_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each one's component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def _edges(values: np.ndarray, fp: np.ndarray, group: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    new = np.append(True, group[1:] != group[:-1])
    top = np.cumsum(new) - 1
    index = Index(values, group)
    sizes = np.bincount(top)[top]
    a, b, at, pos = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.cumsum(sizes), 0
    while pos < len(values):
        end = max(pos + 1, int(np.searchsorted(at, (at[pos - 1] if pos else 0) + FRONTIER, "right")))
        x, y = index.search(np.arange(pos, end), values, top[pos:end], distance)
        a.append(x)
        b.append(y)
        pos = end
    label = least_linked(len(values), np.concatenate(a), np.concatenate(b))
    moved = np.flatnonzero(label != np.arange(len(values)))
    return fp[moved], fp[label[moved]]


def links(fps: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """Edges u, v between distinct fingerprints: enough of them that components are those of all links."""
    if not 0 <= distance <= 3:
        raise ValueError("four blocks find links of at most 3 bits")
    rows = meetings(fps, crowd).repartition("place", "a", "b").sortWithinPartitions("place", "a", "b", gray_rank(F.col("turned")))

    def run(batches):
        held = None
        for batch in batches:
            held = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            key = [held.column(k).to_numpy() for k in ("place", "a", "b")]
            last = np.flatnonzero((key[0] != key[0][-1]) | (key[1] != key[1][-1]) | (key[2] != key[2][-1]))
            whole = int(last[-1]) + 1 if len(last) else 0
            if whole < 20_000:
                continue
            yield from found(held.slice(0, whole))
            held = held.slice(whole)
        if held is not None and len(held):
            yield from found(held)

    def found(batch):
        key = np.stack([batch.column(k).to_numpy() for k in ("place", "a", "b")])
        group = np.cumsum(np.append(0, (key[:, 1:] != key[:, :-1]).any(axis=0)))
        u, v = _edges(batch.column("turned").to_numpy().view(np.uint64), batch.column("fp").to_numpy(), group, distance)
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return rows.mapInArrow(run, "u long, v long").distinct()


def stars(edges: DataFrame, most_rounds: int = 200) -> DataFrame:
    """node, root for every node of the edges u, v: large and small stars in turn until nothing changes; an error if that takes more than most_rounds."""
    edges = common.cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    seen, n = None, edges.count()
    few = lambda df: common.few(df, n)
    for _ in range(most_rounds):
        edges = few(edges)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = few(few(large.unionByName(least.filter("u <> m").select("u", F.col("m").alias("v")))).distinct())
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u")
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small_least.select("u", F.col("m").alias("v")))
        edges = common.cut(few(few(small).distinct()))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.count_if(F.lit(False))).first()
        if now == seen:
            return few(edges).groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
        seen, n = now, now[0]
    raise RuntimeError(f"components not settled after {most_rounds} rounds")


def with_components(rows: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """Adds component_id to rows of doc_id and fp."""
    least = common.cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = stars(links(least.select("fp"), distance, crowd))
    linked = least.join(roots, least["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = linked.join(linked.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return rows.join(named, "fp")


def components(docs: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    rows = common.cut(fingerprints(docs, F.col("doc_id").cast("long").alias("doc_id")))
    return with_components(rows, distance, crowd).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keyed(docs: DataFrame) -> DataFrame:
    """r1 and r2, a 128-bit name of doc_id and text, both of these, and doc, the row."""
    rows = docs.select(F.struct(*[F.col(n) for n in docs.columns]).alias("doc")).select("doc", F.col("doc")["doc_id"].cast("long").alias("doc_id"), F.col("doc")["text"].cast("string").alias("text"))
    return rows.select(F.xxhash64("doc_id", "text").alias("r1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("r2"), "doc_id", "text", "doc")


def first_row(*more: str) -> Column:
    """The row that stays: the least doc_id, one without a doc_id last, of equals the least name."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "r1", "r2", *more))


def one_of_each(rows: DataFrame, keys: DataFrame, groups: DataFrame, edges: DataFrame) -> DataFrame:
    """One of the keyed rows of each component. keys: r1 and r2 of all rows; groups: node and first, the group's row that stays; edges: u, v between nodes.

    Most rows stay where they are: the table that meets them names only those that go and those that are repeated."""
    roots = stars(edges).withColumnRenamed("node", "_n")
    linked = groups.join(roots, groups["node"] == roots["_n"], "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first"))
    kept = linked.select(F.col("first.r1").alias("r1"), F.col("first.r2").alias("r2"), F.lit(True).alias("_stays"))
    counted = keys.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("_times")).join(kept.hint("shuffle_hash"), ["r1", "r2"], "left")
    named = common.cut(counted.filter("_stays is null or _times > 1").select("r1", "r2", F.col("_stays").isNotNull().alias("_again")))
    found = common.with_table(rows.select("r1", "r2", "doc"), named, ["r1", "r2"])
    whole = found.filter("_again is null").select("doc.*")
    again = named.filter("_again").select("r1", "r2")
    if again.isEmpty():
        return whole
    repeated = common.with_table(rows.select("r1", "r2", "doc"), again, ["r1", "r2"], "inner")
    one = repeated.withColumn("_n", F.row_number().over(Window.partitionBy("r1", "r2").orderBy("r1"))).filter("_n = 1")
    return whole.union(one.select("doc.*"))


def distinct(docs: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """One row of docs of each component: that with the least doc_id, one without a doc_id if no other is in it."""
    rows = keyed(docs)
    slim = fingerprints(rows, F.col("r1"), F.col("r2"), F.col("doc_id"))
    groups = common.cut(slim.groupBy("fp").agg(first_row().alias("first")).withColumnRenamed("fp", "node"))
    return one_of_each(rows, rows.select("r1", "r2"), groups, links(groups.select(F.col("node").alias("fp")), distance, crowd))
