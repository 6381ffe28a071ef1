"""Toxicity by a linear-chain conditional random field.

Words are tokens with two states, clean and toxic. A token's features are its letters in lower case as a whole, its first
4, 5, 6 and 8 bytes and its last 4; they are hashed to FEATURES weights. Labels are per document, so tokens are
labelled first: a feature marks toxicity if it stands in at least MARKS_SHARE of the toxic training documents (MARKS_LEAST
at least) and, per document of either kind, PURITY times as often in toxic ones; tokens of a toxic document with such a
feature are toxic, all others clean. The field's weights and transitions are fitted to these by gradient ascent on the
penalised conditional likelihood. Forward-backward then gives every token of every text its marginal; a document's score
is a logistic function of its greatest marginal and its expected number of toxic tokens, fitted on training documents
that the field did not see. Runs of tokens with a marginal over one half are the offending spans.

Learning uses a bounded sample: at most SAMPLE labelled documents of each class (the field itself is
fitted on FITTED of each), TEXT characters of each, drawn by a hash
of doc_id; one document stands for those with any of eight least shingle hashes in common, so copies don't vote. Scoring reads all of
every text, in chains of CHAIN words.

Cases: a null or empty text has no tokens and the score of a text without evidence; null doc_ids are scored and never
learned from; a doc_id with several labels is learned with the greatest; without labels of both classes every score is
the share of label 1 among those there are, 0 without any; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm import common

SAMPLE = {1: 1500, 0: 4500}
FITTED = 1500
TEXT = 8000
FEATURES = 1 << 18
CHAIN = 64
MARKS_SHARE = 0.015
MARKS_LEAST = 4
PURITY = 20.0
STEPS = 30
PENALTY = 1e-3

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?\"')]}")] = True
N_KINDS = 6


@dataclass
class Field:
    weights: np.ndarray
    transitions: np.ndarray
    logistic: np.ndarray


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def tokens(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of words, words of each text, and the feature numbers, one row for each kind."""
    start, end, counts = common.word_spans(data, offsets)
    last = end - (_MARK[data[end - 1]] & (end - start > 1)) if len(end) else end
    prefix = common.prefix_hash(common.BYTE_KEYS[_LOWER[data]])
    spans = [(start, last)] + [(start, np.minimum(start + k, last)) for k in (4, 5, 6, 8)] + [(np.maximum(last - 4, start), last)]
    features = np.stack([((common.span_hash(prefix, a, b) ^ np.uint64(i * 0x9E3779B9)) & np.uint64(FEATURES - 1)).astype(np.int32) for i, (a, b) in enumerate(spans)])
    return start, last, counts, features


def chains(counts: np.ndarray):
    """For words of texts: chain and place in it, and the number of chains."""
    first = np.cumsum(counts) - counts
    within = np.arange(counts.sum()) - np.repeat(first, counts)
    per_text = -(-counts // CHAIN)
    chain = np.repeat(np.cumsum(per_text) - per_text, counts) + within // CHAIN
    return chain, within % CHAIN, int(per_text.sum())


def marginals(emission: np.ndarray, chain: np.ndarray, place: np.ndarray, n: int, transitions: np.ndarray):
    """Each token's chance of the toxic state, and the expected transitions (all chains, 2 x 2)."""
    ratio = np.ones((CHAIN, n))
    ratio[place, chain] = np.exp(np.clip(emission, -30, 30))
    length = np.bincount(chain, minlength=n)
    t = np.exp(transitions)
    live = np.arange(CHAIN)[:, None] < length
    clean, toxic = np.zeros((CHAIN, n)), np.zeros((CHAIN, n))
    a0, a1 = np.ones(n), ratio[0]
    for i in range(CHAIN):
        if i:
            a0, a1 = a0 * t[0, 0] + a1 * t[1, 0], (a0 * t[0, 1] + a1 * t[1, 1]) * ratio[i]
        total = a0 + a1
        a0, a1 = a0 / total, a1 / total
        clean[i], toxic[i] = a0, a1
    out = np.zeros((CHAIN, n))
    pairs = np.zeros((2, 2))
    b0, b1 = np.ones(n), np.ones(n)
    for i in range(CHAIN - 1, -1, -1):
        if i + 1 < CHAIN:
            on = live[i + 1]
            r1 = ratio[i + 1] * b1
            joint = np.stack([clean[i] * t[0, 0] * b0, clean[i] * t[0, 1] * r1, toxic[i] * t[1, 0] * b0, toxic[i] * t[1, 1] * r1])
            pairs += (joint / joint.sum(axis=0))[:, on].sum(axis=1).reshape(2, 2)
            n0, n1 = t[0, 0] * b0 + t[0, 1] * r1, t[1, 0] * b0 + t[1, 1] * r1
            total = n0 + n1
            b0, b1 = np.where(on, n0 / total, 1.0), np.where(on, n1 / total, 1.0)
        p0, p1 = clean[i] * b0, toxic[i] * b1
        out[i] = p1 / (p0 + p1)
    return out[place, chain], pairs


def evidence(p: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text: 1, the log odds of the greatest marginal, and the logarithm of the expected number of toxic tokens plus one."""
    out = np.zeros((len(counts), 3))
    out[:, 0], out[:, 1] = 1, -10
    some = np.flatnonzero(counts > 0)
    if len(some):
        first = (np.cumsum(counts) - counts)[some]
        top = np.clip(np.maximum.reduceat(p, first), 1e-9, 1 - 1e-9)
        out[some, 1] = np.clip(np.log(top / (1 - top)), -10, 10)
        out[some, 2] = np.log1p(np.add.reduceat(p, first))
    return out


def token_labels(features: np.ndarray, doc: np.ndarray, toxic: np.ndarray, used: np.ndarray) -> np.ndarray:
    """True for the tokens of toxic documents that have a feature which marks toxicity in the documents used."""
    n_toxic, n_clean = max(1, int((toxic & used).sum())), max(1, int((~toxic & used).sum()))
    counted = used[doc]
    seen = np.zeros((2, FEATURES), np.int64)
    marks = np.zeros(features.shape[1], bool)
    for kind in features:
        pair = np.unique(doc[counted].astype(np.int64) * FEATURES + kind[counted])
        of_toxic = toxic[pair // FEATURES]
        seen[1] = np.bincount(pair[of_toxic] % FEATURES, minlength=FEATURES)
        seen[0] = np.bincount(pair[~of_toxic] % FEATURES, minlength=FEATURES)
        good = (seen[1] >= max(MARKS_LEAST, MARKS_SHARE * n_toxic)) & (seen[1] / n_toxic >= PURITY * (seen[0] + 0.25) / n_clean)
        marks |= good[kind]
    return marks & toxic[doc]


def fit(texts: list[bytes], toxic: np.ndarray) -> Field:
    """The field, from whole documents and their labels."""
    rate = float(toxic.mean()) if len(toxic) else 0.0
    if not 0 < rate < 1:
        flat = -30.0 if rate == 0 else 30.0
        return Field(np.zeros(FEATURES, np.float32), np.zeros((2, 2)), np.array([flat, 0.0, 0.0]))
    offsets = np.cumsum([0, *map(len, texts)])
    parts = []
    for a, b in common.chunks(offsets):  # hashing takes some forty bytes for each of the text
        parts.append(tokens(np.frombuffer(b"".join(texts[a:b]), np.uint8), offsets[a : b + 1] - offsets[a])[2:])
    counts, features = np.concatenate([c for c, _ in parts]), np.concatenate([f for _, f in parts], axis=1)
    del parts
    doc = np.repeat(np.arange(len(texts)), counts)
    chosen = _one_of_each(features[0], counts)
    part = np.arange(len(texts)) % 3
    marked = token_labels(features, doc, toxic, chosen & (part != 0))
    fitted = chosen & (part != 0)
    for kind in (toxic, ~toxic):
        fitted[np.flatnonzero(fitted & kind)[FITTED:]] = False
    learn = fitted[doc]
    f, y, members = features[:, learn], marked[learn].astype(float), np.where(fitted, counts, 0)
    chain, place, n = chains(members)
    first = place == 0
    wanted = np.zeros((2, 2))
    np.add.at(wanted, (y[:-1].astype(int)[~first[1:]], y[1:].astype(int)[~first[1:]]), 1)
    weights, transitions = np.zeros(FEATURES), np.zeros((2, 2))
    square_w, square_t = np.full(FEATURES, 1e-6), np.full((2, 2), 1e-6)
    start = np.log((y.sum() + 1) / (len(y) + 2)) / N_KINDS
    weights += start
    for _ in range(STEPS):
        p, pairs = marginals(weights[f].sum(axis=0), chain, place, n, transitions)
        slope = np.zeros(FEATURES)
        for kind in f:
            slope += np.bincount(kind, weights=y - p, minlength=FEATURES)
        slope -= PENALTY * len(y) / FEATURES * (weights - start)
        square_w += slope**2
        weights += 0.5 * slope / np.sqrt(square_w)
        slope_t = wanted - pairs - PENALTY * transitions
        square_t += slope_t**2
        transitions += 0.2 * slope_t / np.sqrt(square_t)
    rest = chosen & (part == 0)
    keep = rest[doc]
    chain, place, n = chains(np.where(rest, counts, 0))
    p, _ = marginals(weights[features[:, keep]].sum(axis=0), chain, place, n, transitions)
    x = evidence(p, np.where(rest, counts, 0))[rest]
    return Field(weights.astype(np.float32), transitions, _logistic(x, toxic[rest].astype(float)))


def _one_of_each(words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Leaves one document of those that have any of eight least hashes of five words in common."""
    keep, seen, at = np.ones(len(counts), bool), set(), 0
    for i, n in enumerate(counts.tolist()):
        if n >= 5:
            w = words[at : at + n].astype(np.uint64)
            h = common.mix(w[:-4] * np.uint64(3) + w[1:-3] * np.uint64(5) + w[2:-2] * np.uint64(7) + w[3:-1] * np.uint64(11) + w[4:] * np.uint64(13))
            least = {(k, int(common.mix(h ^ np.uint64(k)).min())) for k in range(1, 9)}
            keep[i] = not least & seen
            seen |= least
        at += n
    return keep


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w += np.linalg.solve(hessian, x.T @ (y - p) - 0.1 * w)
    return w


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[bytes], np.ndarray]:
    """Labelled texts that are not held out, about SAMPLE of each class at most."""
    rows = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("_doc")).agg(F.max("toxic").cast("int").alias("_toxic"))
    rows = rows.filter(~held_out(F.col("_doc"))).withColumn("_draw", F.pmod(F.xxhash64("_doc", F.lit("toxicity")), F.lit(1 << 30)))
    counts = {r["_toxic"]: r["n"] for r in rows.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return [], np.zeros(0, bool)
    most = F.element_at(F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1 << 30, int(SAMPLE[k] / n * (1 << 30)))))), F.col("_toxic"))
    chosen = rows.filter(F.col("_draw") < most).select("_doc", "_toxic", "_draw")
    # about SAMPLE rows of each class, however many labels there are: small enough to send everywhere
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.substring(F.col("text").cast("string"), 1, TEXT).alias("_text")).join(F.broadcast(chosen), "_doc")
    taken = sorted(texts.collect(), key=lambda r: (r["_draw"], r["_doc"], r["_text"] or ""))
    return [(r["_text"] or "").encode() for r in taken], np.array([r["_toxic"] == 1 for r in taken], bool)


def score_texts(data: np.ndarray, offsets: np.ndarray, field: Field):
    """Scores of the texts, and for each text its tokens over one half as (start, end) bytes."""
    start, end, counts, features = tokens(data, offsets)
    chain, place, n = chains(counts)
    emission = np.zeros(len(start))
    for kind in features:
        emission += field.weights[kind]
    p, _ = marginals(emission, chain, place, n, field.transitions)
    score = 1 / (1 + np.exp(-np.clip(evidence(p, counts) @ field.logistic, -30, 30)))
    hits = np.flatnonzero(p > 0.5)
    return score, start[hits], end[hits], np.repeat(np.arange(len(counts)), counts)[hits]


def _spans(text: bytes, start: np.ndarray, end: np.ndarray) -> str:
    """start:end in code points, tokens that stand side by side as one span."""
    out, at, chars = [], 0, 0
    for a, b in zip(start.tolist(), end.tolist(), strict=True):
        chars += len(text[at:a].decode())
        stop = chars + len(text[a:b].decode())
        if out and not text[at:a].strip():
            out[-1] = (out[-1][0], stop)
        else:
            out.append((chars, stop))
        at, chars = b, stop
    return ",".join(f"{a}:{b}" for a, b in out)


def rate(docs: DataFrame, labels: DataFrame | None = None, field: Field | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, spans. Give labels to learn from, or a fitted field."""
    common.small_batches(docs.sparkSession)
    field = field or fit(*sample(docs, labels))

    def run(batches):
        for batch in batches:
            data, offsets = common.columnar(batch.column("text"))
            scores, spans = [], [""] * len(batch)
            for a, b in common.chunks(offsets):
                body = data[offsets[a] : offsets[b]]
                score, start, end, owner = score_texts(body, offsets[a : b + 1] - offsets[a], field)
                scores.append(score)
                for i in np.unique(owner):
                    mine, base = owner == i, offsets[a + i] - offsets[a]
                    spans[a + i] = _spans(body[base : offsets[a + i + 1] - offsets[a]].tobytes(), start[mine] - base, end[mine] - base)
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(spans, pa.string())], ["doc_id", "held_out", "score", "predicted", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, spans string")
