"""Shared helpers: text as numpy columns, words, content hashes, cutting lineage.

White space is the six ASCII characters space, \\t, \\n, \\v, \\f and \\r everywhere; a word is a maximal run of other bytes.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
CHUNK = 1 << 18
SENT = 50_000
SALTS = 64
TASK_ROWS = 50_000
BUCKET = 32 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_KEYS = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most `rows` rows, so that long texts don't fill a worker's memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from there.

    The folder is the session's spark.checkpoint.dir. Only a session on this machine alone gets one made where that is unset.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if folder is None:
            import tempfile

            folder = tempfile.mkdtemp(prefix="marquee-checkpoints-")
        context.setCheckpointDir(folder)
    return df.checkpoint()


def few(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A checkpointed df on no more partitions than its rows need: each task of a shuffle writes files and blocks of its own, however few rows it has."""
    return df.coalesce(max(1, -(-(df.count() if rows is None else rows) // TASK_ROWS)))


def columnar(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values as one array, and the n + 1 offsets of the values in it. Null is empty."""
    column = column.fill_null("") if column.null_count else column
    return columnar_bytes(column.cast(pa.large_string()))


def columnar_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The same of binary values or strings without nulls."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    base = int(at[0])
    body = np.frombuffer(data, np.uint8)[base : int(at[-1])] if data is not None and at[-1] > base else np.zeros(0, np.uint8)
    return body, at - base


def chunks(offsets: np.ndarray, size: int = CHUNK):
    """Ranges of whole values with about `size` bytes each, one value at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, min(last, n)
        first = last


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverses modulo 2 ** 64, for i up to n at least."""
    if not _powers or len(_powers["up"]) <= n:
        size = max(2 * CHUNK, n + 1)
        for name, base in (("up", BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hash(keys: np.ndarray) -> np.ndarray:
    """Prefix sums of keys[i] * BASE ** i, one longer than keys."""
    up, _ = powers(len(keys) + 1)
    out = np.zeros(len(keys) + 1, np.uint64)
    np.cumsum(keys * up[: len(keys)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end), equal for equal content wherever it stands."""
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in data, and the number of words of each value."""
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1]))
    end = np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + 1
    first = np.searchsorted(start, offsets)
    return start, end, np.diff(first)


def n_words(text):
    """Column: the number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def times(rows: DataFrame, copies) -> DataFrame:
    """The rows, each as many times as copies says. A filter on a computed column would be pushed into what computes it and repeat that; rows made from an array are not."""
    return rows.withColumn("_one", F.explode_outer(F.array_repeat(F.lit(1), copies))).filter("_one is not null").drop("_one")


def with_table(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "left", sent: int = SENT) -> DataFrame:
    """rows with the columns of a checkpointed table of groups; keys may be null. Groups are few beside rows, and one may hold a third of these.

    The table goes to every task if it has `sent` rows at most; else both sides are shuffled by the keys and a salt."""
    table = table.select(*(F.col(c).alias(f"_t_{c}") if c in keys else F.col(c) for c in table.columns))
    on = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys))
    if table.limit(sent + 1).count() <= sent:
        out = rows.join(F.broadcast(table), on, how)
    else:
        salted = table.withColumn("_t_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = rows.withColumn("_salt", (F.monotonically_increasing_id() % SALTS).cast("int")).join(salted, on & (F.col("_salt") == F.col("_t_salt")), how).drop("_salt", "_t_salt")
    return out.drop(*(f"_t_{k}" for k in keys))


def let(value, body):
    """Column: body of a value that is computed once, however often body or a lambda in it uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values, join, zero, block: int = 64):
    """Column: for each place of an array what join makes of all values up to it. Blocks are joined first, so the work is all but linear."""
    fold = lambda xs: F.aggregate(xs, zero, join)
    part = lambda v, b, n: F.slice(v, b * block + 1, n)
    numbers = lambda v: F.transform(F.sequence(F.lit(0), F.floor(F.size(v) / block).cast("int")), lambda b: b)

    def scan(v, sums):
        before = F.transform(numbers(v), lambda b: fold(F.slice(sums, F.lit(1), b)))
        return let(before, lambda o: F.transform(v, lambda x, i: join(F.get(o, F.floor(i / block).cast("int")), fold(part(v, F.floor(i / block).cast("int"), i % block + 1)))))

    return let(values, lambda v: let(F.transform(numbers(v), lambda b: fold(part(v, b, F.lit(block)))), lambda sums: scan(v, sums)))


def bucket_count(docs: DataFrame, size: int = BUCKET) -> int:
    """Buckets for what is found in texts: one for each `size` bytes of them, so that a bucket stays small however many there are."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(32, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // size))
