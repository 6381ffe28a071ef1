"""Distributed search for windows that several documents share, common to both substring operators.

Each operator marks, for every window of a document, one anchor inside it by a rule that sees nothing but the window, so
equal windows have equal anchors. Anchors are named by content. A round of naming finds the names that two documents have;
the last round sends what lies around those, and its reducers decide which windows also start in a document with a smaller
doc_id.

All rounds move packed columns: a row is what one batch of documents has for one bucket of names. What a batch can
settle itself - a name that two of its documents have, a window that a smaller doc_id of the batch has - goes past the
buckets as finished rows dealt evenly, and one copy of it goes to its bucket. So a name that a third of all documents
have costs its bucket one entry for each batch, not one for each document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import common

NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
BATCH = 8 << 20
TASKS = 20_000
MOVED = "bucket long, docs binary, owners binary, body binary"
FOUND = "doc_id long, text_hash int, found binary"


def anchors_of_windows(values: np.ndarray, low: int, high: int) -> np.ndarray:
    """For each s the position of the smallest value in [s + low, s + high], the last of equal ones. values: NONE if no candidate."""
    v, at, n, size = values[low:], np.arange(low, len(values), dtype=np.int32), high - low + 1, 1

    def joined(step: int):
        right = v[step:] <= v[: len(v) - step]
        return np.where(right, v[step:], v[: len(v) - step]), np.where(right, at[step:], at[: len(at) - step])

    while 2 * size <= n:
        v, at = joined(size)
        size *= 2
    if size < n:
        v, at = joined(n - size)
    return at


def binary(parts: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Bytes of parts cut at starts (elements; the end is implied)."""
    data = np.ascontiguousarray(parts)
    width = data.dtype.itemsize * (data.shape[1] if data.ndim > 1 else 1)
    offsets = np.append(starts, len(parts)).astype(np.int64) * width
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())


def firsts(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1])) if len(sorted_keys) else np.zeros(0, np.int64)


DOC = np.dtype([("doc_id", "<i8"), ("text_hash", "<i4")])


def finished(docs: np.ndarray, owner: np.ndarray, what: np.ndarray, bucket: int | None = None) -> pa.RecordBatch | None:
    """One row for each document with what was found in it; with bucket, as rows that pass a reducer by."""
    if not len(owner):
        return None
    order = np.argsort(owner, kind="stable")
    owner, what = owner[order], what[order]
    first = firsts(owner)
    heads = docs[owner[first]]
    body = binary(what, first)
    if bucket is None:
        return pa.RecordBatch.from_arrays([pa.array(heads["doc_id"].astype(np.int64)), pa.array(heads["text_hash"].astype(np.int32)), body], ["doc_id", "text_hash", "found"])
    spread = bucket + common.mix(heads["doc_id"].astype(np.uint64) + np.uint64(1)) % np.uint64(1 << 20)
    return pa.RecordBatch.from_arrays([pa.array(spread.astype(np.int64)), binary(heads, np.arange(len(heads))), pa.nulls(len(heads), pa.binary()), body], ["bucket", "docs", "owners", "body"])


def dealt(docs: np.ndarray, bucket: np.ndarray, owner: np.ndarray, what: np.ndarray, encode: Callable) -> pa.RecordBatch | None:
    """One row for each bucket. owner: the document, or len(docs) for an entry that stands for two or more. encode: entries to bytes."""
    if not len(owner):
        return None
    order = np.argsort(bucket, kind="stable")
    bucket, owner, what = bucket[order], owner[order], what[order]
    first = firsts(bucket)
    ends = np.append(first[1:], len(bucket))
    heads, places, bodies = [], [], []
    for a, b in zip(first, ends, strict=True):
        own, place = np.unique(owner[a:b], return_inverse=True)
        heads.append(docs[own[own < len(docs)]].tobytes())
        places.append(place.astype("<u2" if len(own) < 65536 else "<u4").tobytes())
        bodies.append(encode(what[a:b]))
    return pa.RecordBatch.from_arrays([pa.array(bucket[first].astype(np.int64)), *(pa.array(x, pa.binary()) for x in (heads, places, bodies))], ["bucket", "docs", "owners", "body"])


def gathered(batches: Iterator[pa.RecordBatch], decode: Callable, buckets: int, settle: Callable) -> Iterator[pa.RecordBatch]:
    """The reducer: rows sorted by bucket; settle(docs, owner, what) gives (owner, found) of a whole bucket. decode: bytes to entries."""
    now, rows = None, []

    def close():
        if rows:
            docs, owners, bodies, at = [], [], [], 0
            for d, o, w in rows:
                d = np.frombuffer(d, DOC)
                entries = decode(w)
                o = np.frombuffer(o, "<u2" if len(o) == 2 * len(entries) else "<u4").astype(np.int64)
                docs.append(d)
                owners.append(np.where(o < len(d), o + at, -1))
                bodies.append(entries)
                at += len(d)
            docs = np.concatenate(docs)
            out = finished(docs, *settle(docs, np.concatenate(owners), np.concatenate(bodies)))
            rows.clear()
            if out is not None:
                yield from (out.slice(i, 2000) for i in range(0, len(out), 2000))

    for batch in batches:
        passing = []
        for bucket, d, o, w in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if bucket >= buckets:
                passing.append((d, w))
                continue
            if bucket != now:
                yield from close()
                now = bucket
            rows.append((d, o, w))
        if passing:
            heads = np.frombuffer(b"".join(d for d, _ in passing), DOC)
            yield pa.RecordBatch.from_arrays([pa.array(heads["doc_id"].astype(np.int64)), pa.array(heads["text_hash"].astype(np.int32)), pa.array([w for _, w in passing], pa.binary())], ["doc_id", "text_hash", "found"])
    yield from close()


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.hash(text).alias("text_hash"), text.alias("text"))


def once(rows: DataFrame) -> DataFrame:
    """The rows of keyed() with a number of copies: rows that are equal in doc_id and text become one. Only texts of repeated keys are shuffled."""
    keys = ["doc_id", "text_hash"]
    repeated = common.cut(rows.groupBy(*keys).count().filter("count > 1").select(*keys, F.lit(True).alias("repeated")))
    if repeated.isEmpty():
        return rows.withColumn("copies", F.lit(1))
    marked = common.with_table(rows, repeated, keys)
    one = marked.filter("repeated is null").select(*keys, "text", F.lit(1).alias("copies"))
    return one.unionByName(marked.filter("repeated").groupBy(*keys, "text").agg(F.count("*").cast("int").alias("copies")))


def by_bucket(moved: DataFrame, buckets: int, run: Callable, schema: str = FOUND) -> DataFrame:
    return moved.repartition(min(buckets, TASKS), "bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def with_found(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents with the list of what was found in each, or null. Both rounds join alike, so texts are shuffled once."""
    lists = found.groupBy("doc_id", "text_hash").agg(F.collect_list("found").alias("found"))
    return docs.join(lists.hint("shuffle_hash"), ["doc_id", "text_hash"], "left")


def heads_of(batch: pa.RecordBatch) -> np.ndarray:
    out = np.zeros(len(batch), DOC)
    out["doc_id"] = batch.column("doc_id").to_numpy(zero_copy_only=False)
    out["text_hash"] = batch.column("text_hash").to_numpy(zero_copy_only=False)
    return out


def with_id(batch: pa.RecordBatch) -> pa.RecordBatch:
    return batch.filter(batch.column("doc_id").is_valid())


def regrouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about BATCH bytes, without the documents in which nothing was found."""
    held, size = [], 0
    for batch in batches:
        if "found" in batch.schema.names:
            batch = batch.filter(batch.column("found").is_valid())
        at = 0
        while at < len(batch):
            text = batch.column("text")
            rows = 256
            piece = batch.slice(at, rows)
            held.append(piece)
            size += sum(b.size for b in text.slice(at, rows).buffers() if b is not None) * len(piece) // max(1, len(batch))
            at += rows
            if size >= BATCH:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if held and sum(map(len, held)):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


#: Names only find candidates, which are compared in full, so 48 bits of them travel.
NAME_BITS = np.uint64((1 << 48) - 1)


def names_out(names: np.ndarray) -> bytes:
    return np.ascontiguousarray(names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def names_in(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def short(names: np.ndarray) -> np.ndarray:
    """Names as rows of 6 bytes."""
    return np.ascontiguousarray(names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def shared_names(docs: DataFrame, names_of: Callable, buckets: int) -> DataFrame:
    """A round of naming: for each document the names that it shares with another. names_of(batch) gives (document, name) pairs, each once."""

    def send(batches):
        for batch in regrouped(with_id(batch) for batch in batches):
            heads = heads_of(batch)
            owner, name = names_of(batch)
            name = name & NAME_BITS
            order = np.argsort(name, kind="stable")
            owner, name = owner[order], name[order]
            first = firsts(name)
            count = np.diff(np.append(first, len(name)))
            twice = np.repeat(count > 1, count)
            out = finished(heads, owner[twice], short(name[twice]), buckets)
            if out is not None:
                yield from (out.slice(i, 2000) for i in range(0, len(out), 2000))
            one = name[first]
            out = dealt(heads, one % np.uint64(buckets), np.where(count > 1, len(heads), owner[first]), one, names_out)
            if out is not None:
                yield out

    def settle(docs, owner, name):
        order = np.argsort(name, kind="stable")
        owner, name = owner[order], name[order]
        first = firsts(name)
        count = np.add.reduceat(np.where(owner < 0, 2, 1), first) if len(first) else np.zeros(0, int)
        shared = np.repeat(count > 1, np.diff(np.append(first, len(name)))) & (owner >= 0)
        return owner[shared], short(name[shared])

    moved = docs.mapInArrow(send, MOVED)  # a filter on doc_id would be pushed below the join with the texts, which then were shuffled once more
    return by_bucket(moved, buckets, lambda batches: gathered(batches, names_in, buckets, settle))


def names_by_document(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(document, name) of the list column found, sorted by document and name."""
    lists = batch.column("found")
    flat = lists.flatten()
    per_part = np.array([len(x) // 6 for x in flat.to_pylist()], np.int64)
    parts = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    owner = np.repeat(np.repeat(np.arange(len(batch)), parts), per_part)
    name = names_in(b"".join(flat.to_pylist()))
    return owner, name


def held(owner: np.ndarray, name: np.ndarray, known_owner: np.ndarray, known_name: np.ndarray) -> np.ndarray:
    """Whether each (owner, name) is among the known ones; owners are few, so pairs are compared by a mixed key and then themselves."""
    key = lambda o, n: common.mix(n ^ common.mix(o.astype(np.uint64) + np.uint64(1)))
    known = np.sort(key(known_owner, known_name))
    if not len(known):
        return np.zeros(len(owner), bool)
    mine = key(owner, name & NAME_BITS)
    at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
    return known[at] == mine


def digest(parts: bytes) -> str:
    return hashlib.sha256(parts).hexdigest()
