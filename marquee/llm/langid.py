"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built of labelled text. A text is parsed against it from left to right into
longest matches: a phrase ends where the automaton has no step on, and the next begins there. The language that needs
the fewest phrases to the byte, each language's count divided by what its automaton's size makes likely, wins.

The automata's text is a bounded sample: SAMPLE_DOCS labelled documents of each language, PER_DOC bytes of each and
SAMPLE_BYTES in all, drawn by a hash of doc_id, so more rows don't change its size. A table of states and bytes stays
within TABLE entries whatever the number of languages. Texts are parsed in lockstep, PIECE bytes at a time, each piece
of a text on its own; all of every text is parsed.

Letters are lower-cased where they are ASCII; digits, marks and spaces are all one symbol. The score is the winner's
share of the languages' likelihoods, exp(-phrases * GAIN) scaled to one.

Cases: a null text and one without a letter are `und` with score 0, and so is every text if nothing was labelled; ties
go to the language that is least; null doc_ids are not learned from; an empty table gives no rows; other columns of any
name are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm import common

SAMPLE_DOCS = 200
PER_DOC = 1000
SAMPLE_BYTES = 40_000
TABLE = 64_000_000
PIECE = 256
GAIN = 60.0
UNKNOWN = "und"

_FOLD = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


def fold(text: bytes) -> bytes:
    return text.translate(_FOLD)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame) -> list[tuple[str, bytes]]:
    """(language, sample text), languages in order. Collects at most SAMPLE_DOCS * PER_DOC characters of each language."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.substring(F.col("text").cast("string"), 1, PER_DOC).alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & (F.length("text") > 0))
    rows = rows.withColumn("draw", F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1 << 30, int(SAMPLE_DOCS / n * (1 << 30))))))
    taken = rows.filter(F.col("draw") < F.element_at(share, F.col("lang"))).collect()
    texts: dict[str, list[bytes]] = {}
    for r in sorted(taken, key=lambda r: (r["draw"], r["doc_id"], r["text"])):
        texts.setdefault(r["lang"], []).append(fold(r["text"].encode()))
    return [(k, b" ".join(v)[:SAMPLE_BYTES]) for k, v in sorted(texts.items())]


def automaton(text: bytes, codes: np.ndarray, n_codes: int) -> np.ndarray:
    """Steps of the suffix automaton: state, symbol -> state, or -1. State 0 is the start."""
    steps: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for b in text:
        now = len(steps)
        steps.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and b not in steps[p]:
            steps[p][b] = now
            p = link[p]
        if p >= 0:
            q = steps[p][b]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                copy = len(steps)
                steps.append(dict(steps[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and steps[p].get(b) == q:
                    steps[p][b] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    table = np.full((len(steps), n_codes), -1, np.int32)
    for state, out in enumerate(steps):
        for b, to in out.items():
            table[state, codes[b]] = to
    return table


@lru_cache(1)
def model(texts: tuple[tuple[str, bytes], ...]):
    """Codes of bytes (0: in no sample) and the languages' automata, each as one flat table. One for all tasks of a worker."""
    known = sorted(set(b"".join(t for _, t in texts)))
    codes = np.zeros(256, np.int32)
    codes[known] = np.arange(1, len(known) + 1)
    most = TABLE // (2 * (len(known) + 1) * max(1, len(texts)))
    return codes, len(known) + 1, [automaton(t[:most], codes, len(known) + 1).reshape(-1) for _, t in texts]


def phrases(table: np.ndarray, n_codes: int, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Phrases of each row of codes. rows: position, row; rows sorted by length, longest first."""
    count = np.zeros(rows.shape[1], np.int64)
    state = np.zeros(rows.shape[1], np.int32)
    live = rows.shape[1] - np.searchsorted(lengths[::-1], np.arange(rows.shape[0]), "right")
    for i in range(rows.shape[0]):
        n = live[i]
        if not n:
            break
        symbol = rows[i, :n]
        to = table[state[:n] * n_codes + symbol]
        stuck = to < 0
        count[:n] += stuck
        again = table[symbol[stuck]]
        to[stuck] = np.maximum(again, 0)
        state[:n] = to
    return count + 1


def rates(texts: list[bytes], codes: np.ndarray, n_codes: int, tables: list[np.ndarray]) -> np.ndarray:
    """Phrases to the byte of each text against each language."""
    folded = [fold(t) for t in texts]
    lengths = np.array([len(t) for t in folded], np.int64)
    pieces = np.maximum(1, -(-lengths // PIECE))
    owner = np.repeat(np.arange(len(texts)), pieces)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    size = np.minimum(lengths[owner] - place * PIECE, PIECE)
    begin = (np.cumsum(lengths) - lengths)[owner] + place * PIECE
    order = np.argsort(-size, kind="stable")
    data = codes[np.frombuffer(b"".join(folded) + bytes(PIECE), np.uint8)]
    out = np.zeros((len(texts), len(tables)))
    for a in range(0, len(order), 8192):
        part = order[a : a + 8192]
        rows = np.ascontiguousarray(data[begin[part] + np.arange(PIECE)[:, None]][: max(1, int(size[part].max(initial=0)))])
        for k, table in enumerate(tables):
            np.add.at(out[:, k], owner[part], phrases(table, n_codes, rows, size[part]))
    scale = np.array([np.log(max(4, len(t) // n_codes)) for t in tables])
    return out / np.maximum(lengths, 1)[:, None] * (scale / scale.mean())


def predictions(texts: list[bytes | None], learned: tuple[tuple[str, bytes], ...]) -> tuple[list[str], np.ndarray]:
    names = [k for k, _ in learned]
    label, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
    asked = [i for i, t in enumerate(texts) if t is not None and names and any(map(str.isalpha, t.decode()))]
    if asked:
        r = rates([texts[i] for i in asked], *model(learned))
        best = r.argmin(axis=1)
        likely = np.exp(-GAIN * (r - r.min(axis=1, keepdims=True)))
        score[asked] = 1 / likely.sum(axis=1)
        for i, b in zip(asked, best, strict=True):
            label[i] = names[b]
    return label, score


def identify(docs: DataFrame, learned: list[tuple[str, bytes]] | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score. learned: (language, text) instead of a sample of docs."""
    common.small_batches(docs.sparkSession)
    learned = tuple(sample(docs) if learned is None else learned)

    def run(batches):
        for batch in batches:
            label, score = predictions(batch.column("text").cast(pa.binary()).to_pylist(), learned)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(label, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
