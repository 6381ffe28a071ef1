"""LM scoring by a hidden Markov model that Baum-Welch trains over the whole corpus.

A state draws the class of a word, the class draws the word. Each of at most OWN frequent words is a class of its own; all
others fall into one of ENDINGS classes by their first and last letters, in which a word seen c times has (c + 1) of
the class's C + V + 1 parts and an unseen one has a part. So what depends on the state stays small enough to travel with
every task, whatever the vocabulary, and what grows with the corpus, the counts of all its words, stays a table.

1. Words of training documents are counted: once in each batch, then by Spark.
2. The count that at most OWN words reach makes those classes; another word holds at most one in OWN of all tokens, so no key
   of the joins below is hot.
3. Documents are written once as class numbers, two bytes a token, with the words that have no class of their own.
4. A bounded sample, pieces of SAMPLE_PIECE tokens at hashed places of some SAMPLE documents, starts the model on the driver.
5. ROUNDS of Baum-Welch over all training documents: tasks run forward and backward over pieces of PIECE tokens (later pieces
   begin as the states are occupied on the whole) and return expected counts, summed by Spark in blocks of classes.
6. The scaled forward recursion gives each whole text's likelihood, exactly: stretches of STRETCH tokens after a text's first
   are run from every state at once and chained, so very long texts need no more steps.
7. Words without a class of their own meet their counts in a join; documents get back sums.

Tokens are the words, A-Z as a-z, and one end. base_score takes each token for itself, (c + 1) / (N + V + 1).

Cases: a null or empty text is an end alone. Rows with a null doc_id have the hash of the empty string, so they train. Repeated
rows and ids are rows of their own. Without training documents all counts are zero and classes equally likely. An empty table
gives no rows. Further columns of the input are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import common
from marquee.llm.common import cut, small_batches

STATES = 8
OWN, ENDINGS = 8192, 8192
ROUNDS = 3
PIECE, TOGETHER, STRETCH = 128, 8192, 4096
SAMPLE, SAMPLE_PIECE, SAMPLE_ROUNDS = 1000, 256, 15
PRIOR = 50.0
BLOCK = 1024
BATCH = 4 << 20
WRITTEN = "row long, doc_id long, held_out boolean, tokens long, own_sum double, own_known long, classes binary, words array<string>, times array<int>"
RESULT = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def held_out(doc_id="doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 7 == 2


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def tokenized(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Number of words of each text, each word's place among the distinct ones, and these."""
    data, offsets = common.columnar(texts)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    start, end, per = common.word_spans(data, offsets)
    if not len(start):
        return per, np.zeros(0, np.int64), pa.array([], pa.string())
    size = end - start
    at = np.append(0, np.cumsum(size))
    # words without what stands between them
    body = data[~common._SPACE[data]]
    words = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(body.tobytes())).dictionary_encode()
    return per, words.indices.to_numpy().astype(np.int64), words.dictionary.cast(pa.string())


def _slices(batches: Iterator[pa.RecordBatch], size: int = BATCH) -> Iterator[pa.RecordBatch]:
    """Parts of batches with about `size` bytes of text, whole texts."""
    for batch in batches:
        if len(batch):
            _, offsets = common.columnar(batch.column("text"))
            for a, b in common.chunks(offsets, size):
                yield batch.slice(a, b - a)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) of the documents, the end not among them."""

    def run(batches):
        for batch in _slices(batches):
            _, at, words = tokenized(batch.column("text"))
            yield pa.RecordBatch.from_arrays([words, pa.array(np.bincount(at, minlength=len(words)).astype(np.int64))], ["word", "c"])

    return docs.select("text").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def ending(word: str) -> int:
    """The class, counted from OWN, of a word without one of its own."""
    return zlib.crc32(f"{word[:2]} {word[-3:]}".encode("utf-8", "surrogatepass")) % ENDINGS


@dataclass
class Classes:
    """own: frequent words with their counts. mass, kinds: tokens and distinct words of each class of endings. documents: ends."""

    own: dict[str, int]
    count: np.ndarray
    mass: np.ndarray
    kinds: np.ndarray
    documents: int

    @property
    def end(self) -> int:
        return OWN + ENDINGS

    @property
    def tokens(self) -> int:
        return int(self.count.sum() + self.mass.sum()) + self.documents

    @property
    def distinct(self) -> int:
        return len(self.own) + int(self.kinds.sum()) + (self.documents > 0)

    @property
    def parts(self) -> np.ndarray:
        """log10 of what an unseen word of a class is one part of; 0 for words of their own and the end."""
        return np.concatenate([np.zeros(OWN), np.log10(self.mass + self.kinds + 1.0), [0.0]])

    def share(self) -> np.ndarray:
        """How often each class is drawn, whatever the state."""
        weight = np.concatenate([self.count, np.zeros(OWN - len(self.count)), self.mass, [self.documents]]) + 1.0
        return weight / weight.sum()


def classes_of(counts: DataFrame, documents: int) -> Classes:
    """counts: a checkpointed table. The driver gets a histogram of powers, the frequent words and one row for each class of endings."""
    power = F.floor(F.log2("c") * 16).cast("int")
    histogram = counts.groupBy(power.alias("power")).agg(F.count("*").alias("n")).orderBy(F.desc("power")).collect()
    least, reached = 1 << 30, 0
    for row in histogram:
        reached += row.n
        if reached > OWN:
            break
        least = row.power
    frequent = counts.filter(power >= least).orderBy(F.desc("c"), "word").collect()

    def fold(batches):
        mass, kinds = np.zeros(ENDINGS, np.int64), np.zeros(ENDINGS, np.int64)
        for batch in batches:
            at = np.array([ending(w) for w in batch.column("word").to_pylist()], np.int64)
            mass += np.bincount(at, batch.column("c").to_numpy(), ENDINGS).astype(np.int64)
            kinds += np.bincount(at, minlength=ENDINGS)
        some = np.flatnonzero(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(mass[some]), pa.array(kinds[some])], ["class", "mass", "kinds"])

    rows = counts.filter(power < least).mapInArrow(fold, "class int, mass long, kinds long").groupBy("class").agg(F.sum("mass").alias("mass"), F.sum("kinds").alias("kinds")).collect()
    mass, kinds = np.zeros(ENDINGS, np.int64), np.zeros(ENDINGS, np.int64)
    for r in rows:
        mass[r["class"]], kinds[r["class"]] = r.mass, r.kinds
    return Classes({r.word: i for i, r in enumerate(frequent)}, np.array([r.c for r in frequent], np.int64), mass, kinds, documents)


def written(docs: DataFrame, classes: Classes) -> DataFrame:
    """Each document as class numbers, with its other words and how often it has them."""

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        logs = np.log10(classes.count + 1.0)
        for batch in _slices(batches):
            per, at, words = tokenized(batch.column("text"))
            words = words.to_pylist()
            kind = np.array([classes.own.get(w, -1) for w in words], np.int64)
            rare = np.flatnonzero(kind < 0)
            for i in rare.tolist():
                kind[i] = OWN + ending(words[i])
            own = kind < OWN
            n = len(batch)
            doc = np.repeat(np.arange(n), per)
            mine = own[at] if len(at) else np.zeros(0, bool)
            sums = np.bincount(doc[mine], logs[kind[at[mine]]], n) if mine.any() else np.zeros(n)
            known = np.bincount(doc[mine], minlength=n)
            first = np.append(0, np.cumsum(per))
            # the tokens of a document and its end
            numbers = np.full(len(at) + n, classes.end, np.uint16)
            numbers[np.arange(len(at)) + doc] = kind[at] if len(at) else 0
            stops = (first + np.arange(n + 1)) * 2
            pair, often = np.unique(doc[~mine] * len(words) + at[~mine], return_counts=True)
            of, word = np.divmod(pair, max(1, len(words)))
            cuts = np.searchsorted(of, np.arange(n + 1)).astype(np.int32)
            others = pa.ListArray.from_arrays(pa.array(cuts), pa.array(words, pa.string()).take(pa.array(word)))
            times = pa.ListArray.from_arrays(pa.array(cuts), pa.array(often.astype(np.int32)))
            body = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(stops.astype(np.int64).tobytes()), pa.py_buffer(numbers.tobytes())]).cast(pa.binary())
            columns = [pa.array(np.arange(number, number + n)), batch.column("doc_id"), batch.column("held_out"), pa.array(per + 1), pa.array(sums), pa.array(known), body, others, times]
            number += n
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in WRITTEN.split(", ")])

    return docs.mapInArrow(run, WRITTEN)


@dataclass
class Model:
    """first: states of a first token. later: of any token. move: from state to state. draw: classes by state, (class, state)."""

    first: np.ndarray
    later: np.ndarray
    move: np.ndarray
    draw: np.ndarray


def beginning(share: np.ndarray, states: int = STATES, seed: int = 5) -> Model:
    rng = np.random.Generator(np.random.PCG64(seed))
    draw = share[:, None] * (0.5 + rng.random((len(share), states)))
    move = np.full((states, states), 0.3 / states) + 0.7 * np.eye(states)
    even = np.full(states, 1 / states)
    return Model(even, even, move, draw / draw.sum(axis=0))


def numbers_of(body: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All class numbers and where each document's begin, one more than documents."""
    data, offsets = common.columnar_bytes(body)
    return data.view(np.uint16), offsets // 2


def expected(model: Model, numbers: np.ndarray, start: np.ndarray, length: np.ndarray, first: np.ndarray, sums: Model) -> None:
    """Adds the expected counts of pieces of numbers, forward and backward, to sums. first: whether a piece begins a document."""
    order = np.argsort(-length, kind="stable")
    start, length, first = start[order], length[order], first[order]
    n, top = len(start), int(length[0])
    live = np.searchsorted(-length, -np.arange(top), "left")
    move, draw = model.move.astype(np.float32), model.draw.astype(np.float32)
    alpha, scale, seen = [], [], []
    now = np.where(first[:, None], model.first, model.later).astype(np.float32)
    for t in range(top):
        k = live[t]
        b = draw[numbers[start[:k] + t]]
        a = (now[:k] if t == 0 else now[:k] @ move) * b
        c = a.sum(axis=1, keepdims=True)
        a /= c
        alpha.append(a)
        scale.append(c)
        seen.append(b)
        now = a
    beta, classes, weights = np.ones((n, move.shape[0]), np.float32), [], []
    pairs = np.zeros(move.shape, np.float64)
    for t in range(top - 1, -1, -1):
        k = live[t]
        gamma = alpha[t] * beta[:k]
        gamma /= gamma.sum(axis=1, keepdims=True)
        classes.append(numbers[start[:k] + t])
        weights.append(gamma)
        if t:
            ahead = seen[t] * beta[:k] / scale[t]
            pairs += alpha[t - 1][:k].T @ ahead
            beta[:k] = ahead @ move.T
        else:
            sums.first += gamma[first].sum(axis=0)
    sums.move += pairs * model.move
    classes, weights = np.concatenate(classes), np.concatenate(weights)
    for s in range(move.shape[0]):
        sums.draw[:, s] += np.bincount(classes, weights[:, s], len(sums.draw))


def add_up(model: Model, numbers: np.ndarray, stops: np.ndarray, sums: Model) -> None:
    """The expected counts of whole documents, in pieces, some at a time."""
    size = np.diff(stops)
    per = -(-size // PIECE)
    doc = np.repeat(np.arange(len(size)), per)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    start = stops[:-1][doc] + number * PIECE
    length = np.minimum(PIECE, stops[1:][doc] - start)
    for a in range(0, len(doc), TOGETHER):
        s = slice(a, a + TOGETHER)
        expected(model, numbers, start[s], length[s], number[s] == 0, sums)


def nothing(model: Model) -> Model:
    return Model(np.zeros(len(model.first)), np.zeros(len(model.first)), np.zeros(model.move.shape), np.zeros(model.draw.shape))


def better(sums: Model, share: np.ndarray) -> Model:
    """The model that the expected counts call for; what was never seen keeps some weight."""
    first = sums.first + 0.1
    move = sums.move + 0.1
    held = sums.draw.sum(axis=0)
    draw = (sums.draw + PRIOR * share[:, None]) / (held + PRIOR)
    return Model(first / first.sum(), (held + 0.1) / (held + 0.1).sum(), move / move.sum(axis=1, keepdims=True), draw)


def trained(rows: DataFrame, classes: Classes, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """rows: the training documents as `written` returns them, checkpointed."""
    share = classes.share()
    model = beginning(share, states)
    if not classes.documents:
        return model
    chosen = rows.filter((F.xxhash64("row").bitwiseAND(F.lit((1 << 40) - 1))) < int((1 << 40) * min(1.0, SAMPLE / classes.documents)))
    tokens = F.octet_length("classes") / 2
    place = F.floor(F.pmod(F.xxhash64("row", F.lit(1)), F.lit(1 << 30)) / float(1 << 30) * F.greatest(F.lit(1), tokens - SAMPLE_PIECE + 1)).cast("int")
    pieces = [np.frombuffer(bytes(r.piece), np.uint16) for r in chosen.select(F.substring("classes", place * 2 + 1, F.lit(2 * SAMPLE_PIECE)).alias("piece")).collect()]
    if pieces:
        numbers, stops = np.concatenate(pieces), np.append(0, np.cumsum([len(p) for p in pieces]))
        for _ in range(SAMPLE_ROUNDS):
            add_up(model, numbers, stops, sums := nothing(model))
            model = better(sums, share)
    for _ in range(rounds):
        model = better(_summed(rows, model), share)
    return model


def _summed(rows: DataFrame, model: Model) -> Model:
    """Expected counts of all rows: blocks of classes from each task, summed block by block."""
    states = len(model.first)

    def run(batches):
        sums = nothing(model)
        for batch in batches:
            if len(batch):
                add_up(model, *numbers_of(batch.column("classes")), sums)
        parts = [np.concatenate([sums.first[None], sums.move])] + [sums.draw[a : a + BLOCK] for a in range(0, len(sums.draw), BLOCK)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([p.astype(np.float32).tobytes() for p in parts], pa.binary())], ["block", "body"])

    def fold(batches):
        held = {}
        for batch in batches:
            for block, body in zip(batch.column("block").to_pylist(), batch.column("body").to_pylist(), strict=True):
                values = np.frombuffer(body, np.float32).astype(np.float64)
                held[block] = held[block] + values if block in held else values
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())], ["block", "body"])

    kind = "block int, body binary"
    blocks = {r.block: np.frombuffer(bytes(r.body), np.float64).reshape(-1, states) for r in rows.select("classes").mapInArrow(run, kind).repartition("block").mapInArrow(fold, kind).collect()}
    draw = np.concatenate([blocks[i] for i in range(1, len(blocks))])
    return Model(blocks[0][0], np.zeros(states), blocks[0][1:], draw)


def likelihood(model: Model, numbers: np.ndarray, stops: np.ndarray, stretch: int = STRETCH) -> np.ndarray:
    """log10 of the probability of each document's classes, by the scaled forward recursion over all of it."""
    size, states = np.diff(stops), len(model.first)
    per = -(-size // stretch)
    doc = np.repeat(np.arange(len(size)), per)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    # a first stretch is run once, a later one once for each state before it
    runs = np.where(number == 0, 1, states)
    unit = np.repeat(np.arange(len(doc)), runs)
    entry = np.arange(len(unit)) - np.repeat(np.cumsum(runs) - runs, runs)
    start = (stops[:-1][doc] + number * stretch)[unit]
    length = np.minimum(stretch, stops[1:][doc[unit]] - start)
    order = np.argsort(-length, kind="stable")
    now = np.where((number[unit] == 0)[:, None], model.first, model.move[entry])[order]
    total = np.zeros(len(unit))
    at, left = start[order], length[order]
    for t in range(int(left[0]) if len(left) else 0):
        k = int(np.searchsorted(-left, -t, "left"))
        a = (now[:k] if t == 0 else now[:k] @ model.move) * model.draw[numbers[at[:k] + t]]
        c = a.sum(axis=1)
        now[:k] = a / c[:, None]
        total[:k] += np.log(c)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    now, total = now[back], total[back]
    head = np.cumsum(runs) - runs
    out = total[head[number == 0]]
    held = now[head[number == 0]]
    # the stretches of long documents, one after another
    for i in np.flatnonzero(number > 0):
        ways = slice(head[i], head[i] + states)
        most = total[ways].max()
        weight = held[doc[i]] * np.exp(total[ways] - most)
        held[doc[i]] = weight @ now[ways]
        c = held[doc[i]].sum()
        held[doc[i]] /= c
        out[doc[i]] += most + np.log(c)
    return out / np.log(10)


def scored(rows: DataFrame, counts: DataFrame, classes: Classes, model: Model) -> DataFrame:
    """The scores of documents as `written` returns them, checkpointed."""
    parts, end_sum = classes.parts, float(np.log10(classes.documents + 1.0))

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            numbers, stops = numbers_of(batch.column("classes"))
            value = likelihood(model, numbers, stops) - np.add.reduceat(parts[numbers], stops[:-1])
            names = ["row", "doc_id", "held_out", "tokens", "own_sum", "own_known"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(value)], [*names, "model"])

    whole = rows.select("row", "doc_id", "held_out", "tokens", "own_sum", "own_known", "classes").mapInArrow(run, "row long, doc_id long, held_out boolean, tokens long, own_sum double, own_known long, model double")
    words = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.times").alias("often"))
    found = words.join(counts, "word").groupBy("row").agg(F.sum(F.col("often") * F.log10(F.col("c") + 1.0)).alias("sum"), F.sum("often").alias("known"))
    some = F.coalesce("sum", F.lit(0.0))
    tokens = F.lit(classes.tokens)
    base = F.col("own_sum") + some + end_sum - F.col("tokens") * float(np.log10(classes.tokens + classes.distinct + 1.0))
    known = F.col("own_known") + F.coalesce("known", F.lit(0)) + int(classes.documents > 0)
    return whole.join(found, "row", "left").select("doc_id", "held_out", F.col("tokens").alias("n_tokens"), known.cast("long").alias("n_known"), tokens.cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("model") + some).alias("score"))


def fitted(docs: DataFrame) -> tuple[DataFrame, DataFrame, Classes, Model]:
    """The documents as written, the counts, classes and model."""
    small_batches(docs.sparkSession, 1000)
    texts = _texts(docs)
    counts = cut(word_counts(texts.filter(~F.col("held_out"))))
    documents = texts.filter(~F.col("held_out")).count()
    classes = classes_of(counts, documents)
    rows = cut(written(texts, classes))
    return rows, counts, classes, trained(rows.filter(~F.col("held_out")), classes)


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    return scored(*fitted(docs)).select(*RESULT)
