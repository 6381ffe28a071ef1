"""Substring dedup over words by recompression.

Words are 64-bit symbols of level 0. Each of ROUNDS rounds names first the runs, maximal repetitions of one symbol, by
symbol and length, and then pairs: a coin, a bit hashed from round and symbol, makes every symbol a left or a right one, and
each left symbol followed by a right one becomes the name of the pair. Last, each symbol is named together with those
after it until PHRASE words are reached. Names are hashes of what they stand for, so all documents give equal things
equal names; Spark rounds find out which names the corpus shares:

1. Of each phrase that stands for a window the symbol with the most words is sent and grouped by name: those in two
   documents at least are shared.
2. Phrases whose symbol is shared are sent and grouped in the same way; what holds another symbol is not repeated.
3. Windows of WINDOW words that a shared phrase stands for are compared, and those that also start in a smaller doc_id go.

Which phrase stands for a window is seen from the window alone. Every symbol carries the range of words that its name and
its ends were derived from: a run must see that its neighbours differ, an unpaired symbol the neighbour it did not pair
with. A window's candidates are the phrases whose range lies inside it; of those the least hash stands for it. A window
without any (long runs and periods leave none) takes the least symbol of level ROUNDS inside it, else the least word. So
equal windows have equal names wherever they stand, and no repeat is lost.

Windows count as equal by 96 bits of two hashes over the two halves of their words' XXH128 (64 bits alone would collide at
10 ** 10 windows, and a polynomial over bytes collides on words that are built for it); names, 48 bits, only find candidates.

Cases: a null or empty text has no words and keeps none; documents under 50 words keep all; rows with a null doc_id are
neither smaller nor larger than others, so they keep all and remove nothing; rows that repeat a doc_id don't remove each
other's words; an empty table gives no rows; other columns of any name are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import common, repeats

WINDOW = 50
ROUNDS = 3
PHRASE = 16
FAR = np.int64(1) << np.int64(60)
WORD_WINDOW = np.dtype([("h", "<u8"), ("g", "<u4"), ("start", "<u4")])
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


@dataclass
class Symbols:
    """Symbols in order: name, first word, document, and the range [low, high) of words that name and ends depend on, one word beyond the document where it depends on its end. Both ends rise from symbol to symbol."""

    name: np.ndarray
    at: np.ndarray
    doc: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def of(self, kept: np.ndarray) -> Symbols:
        return Symbols(*(x[kept] for x in (self.name, self.at, self.doc, self.low, self.high)))

    def beside(self) -> tuple[np.ndarray, np.ndarray]:
        """The range's low end of each one's neighbour before it, and the high end of that after it."""
        before, after = self.at - 1, np.append(self.at[1:] + 1, FAR)
        same = self.doc[1:] == self.doc[:-1]
        before[1:][same] = self.low[:-1][same]
        after[:-1][same] = self.high[1:][same]
        return before, after


def _named(*parts) -> np.ndarray:
    out = np.uint64(0)
    for i, part in enumerate(parts):
        out = common.mix(out * np.uint64(0xD6E8FEB86659FD93) + part + np.uint64(i + 1))
    return out


def runs(s: Symbols, level: int) -> Symbols:
    """Every maximal run of one symbol as one symbol; single ones keep their names."""
    if not len(s.name):
        return s
    before, after = s.beside()
    first = np.flatnonzero(np.append(True, (s.name[1:] != s.name[:-1]) | (s.doc[1:] != s.doc[:-1])))
    last = np.append(first[1:], len(s.name)) - 1
    n = (last - first + 1).astype(np.uint64)
    name = np.where(n > 1, _named(s.name[first], n, np.uint64(2 * level)), s.name[first])
    return Symbols(name, s.at[first], s.doc[first], before[first], after[last])


def pairs(s: Symbols, level: int) -> Symbols:
    """Every left symbol and the right one after it as one symbol."""
    if not len(s.name):
        return s
    right = (common.mix(s.name + np.uint64(level + 1)) & np.uint64(1)).astype(bool)
    before, after = s.beside()
    joined = np.zeros(len(s.name), bool)
    joined[:-1] = ~right[:-1] & right[1:] & (s.doc[1:] == s.doc[:-1])
    second = np.append(False, joined[:-1])
    low, high, name = np.where(right & ~second, before, s.low), np.where(~right, after, s.high), s.name.copy()
    name[:-1][joined[:-1]] = _named(s.name[:-1][joined[:-1]], s.name[1:][joined[:-1]], np.uint64(2 * level + 1))
    return Symbols(name, s.at, s.doc, low, high).of(~second)


def symbols(words: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    """The symbols of words after some rounds."""
    at = np.arange(len(words), dtype=np.int64)
    s = Symbols(words, at, doc, at, at + 1)
    for level in range(rounds):
        s = pairs(runs(s, level), level)
    return s


def ends_of(s: Symbols, ends: np.ndarray) -> np.ndarray:
    """One past each symbol's last word. ends: the same of each document."""
    stop = np.append(s.at[1:], 0)
    last_of_doc = np.append(s.doc[1:] != s.doc[:-1], True)
    stop[last_of_doc] = ends[s.doc[last_of_doc]]
    return stop


def phrases(s: Symbols, ends: np.ndarray) -> tuple[Symbols, np.ndarray]:
    """The symbols with those after each until PHRASE words, as far as their documents go, and the name of the longest symbol of each, the greatest of equally long ones."""
    if not len(s.name):
        return s, s.name
    stop = ends_of(s, ends)
    last = np.searchsorted(stop, s.at + PHRASE)
    i = np.flatnonzero((last < len(stop)) & (s.doc[np.minimum(last, len(stop) - 1)] == s.doc))
    last = last[i]
    size = np.minimum(stop - s.at, 63).astype(np.uint64)
    key = ~(size << np.uint64(58) | s.name >> np.uint64(6))
    longest = key[least_of(key, i, last + 1)]
    names = common.span_hash(common.prefix_hash(s.name), i, last + 1)
    return Symbols(names, s.at[i], s.doc[i], s.low[i], s.high[last]), longest


def least_of(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each range [first, last) the place of its least value; 0 for an empty one."""
    n = last - first
    out, best, size = np.zeros(len(n), np.int64), np.arange(len(values)), 1
    while (n >= size).any():
        mine = np.flatnonzero((n >= size) & (n < 2 * size))
        a, b = best[first[mine]], best[last[mine] - size]
        out[mine] = np.where(values[b] < values[a], b, a)
        if (n < 2 * size).all():
            break
        a, b = best[:-size], best[size:]
        best, size = np.where(values[b] < values[a], b, a), 2 * size
    return out


def least_inside(s: Symbols, at: np.ndarray, width: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """For each window [at, at + width) whether any symbol's range lies in it, and the place of the least name of those that do."""
    first, last = np.searchsorted(s.low, at), np.searchsorted(s.high, at + width, "right")
    return last > first, least_of(s.name, first, last)


@dataclass
class Words:
    """The words of some documents: two prefix hashes of them, the first word of each document, symbols, and the windows with their documents."""

    prefix: np.ndarray
    second: np.ndarray
    first: np.ndarray
    names: np.ndarray
    symbols: Symbols
    at: np.ndarray
    doc: np.ndarray


def word_names(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the XXH128 of each word's bytes; each distinct word is hashed once."""
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    at = np.append(0, np.cumsum(end - start)).astype(np.int64)
    body = data[~common._SPACE[data]]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(body.tobytes())]).dictionary_encode()
    halves = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words.dictionary.to_pylist())), "<u8").reshape(-1, 2)
    places = words.indices.to_numpy()
    return np.ascontiguousarray(halves[places, 0]), np.ascontiguousarray(halves[places, 1])


def read(data: np.ndarray, offsets: np.ndarray, exact: bool = False) -> Words:
    """exact: the second hashes too."""
    start, end, counts = common.word_spans(data, offsets)
    words, other = word_names(data, start, end)
    other = other if exact else words[:0]
    doc = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(max(0, len(words) - WINDOW + 1))
    at = at[doc[at] == doc[at + WINDOW - 1]]
    return Words(common.prefix_hash(words), common.prefix_hash(other), np.append(0, np.cumsum(counts)), words, symbols(words, doc), at, doc[at])


def window_names(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """For each window the name of what stands for it, and that of its longest symbol; both are the same where no phrase does."""
    found, longest = phrases(w.symbols, w.first[1:])
    by_phrase, place = least_inside(found, w.at)
    name, symbol = np.zeros(len(w.at), np.uint64), np.zeros(len(w.at), np.uint64)
    name[by_phrase], symbol[by_phrase] = found.name[place[by_phrase]], _named(longest[place[by_phrase]], np.uint64(0))
    rest = np.flatnonzero(~by_phrase)
    if len(rest):
        inside, place = least_inside(w.symbols, w.at[rest])
        at = np.arange(len(w.names), dtype=np.int64)
        _, word = least_inside(Symbols(w.names, at, at, at, at + 1), w.at[rest])
        name[rest] = symbol[rest] = np.where(inside, _named(w.symbols.name[place], np.uint64(1)), _named(w.names[word], np.uint64(2)))
    return name, symbol


def _each_once(owner: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((name, owner))
    owner, name = owner[order], name[order]
    new = np.append(True, (owner[1:] != owner[:-1]) | (name[1:] != name[:-1])) if len(owner) else np.zeros(0, bool)
    return owner[new], name[new]


def _by_chunk(data: np.ndarray, offsets: np.ndarray, found) -> tuple[np.ndarray, ...]:
    """What found(first document, its end, data, offsets) gives for each chunk, as whole arrays."""
    parts = [found(a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in common.chunks(offsets)]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def symbol_names(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Round 1: the longest symbols of the phrases that stand for windows."""

    def found(a, b, data, offsets):
        w = read(data, offsets)
        owner, name = _each_once(w.doc, window_names(w)[1] & repeats.NAME_BITS)
        return owner + a, name

    return _by_chunk(*common.columnar(batch.column("text")), found)


def phrase_names(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Round 2: the phrases whose longest symbols are shared, as found says."""
    known_owner, known = repeats.names_by_document(batch)

    def found(a, b, data, offsets):
        w = read(data, offsets)
        name, symbol = window_names(w)
        inside = (known_owner >= a) & (known_owner < b)
        kept = repeats.held(w.doc + a, symbol, known_owner[inside], known[inside])
        owner, name = _each_once(w.doc[kept], name[kept] & repeats.NAME_BITS)
        return owner + a, name

    return _by_chunk(*common.columnar(batch.column("text")), found)


def removed_windows(docs: DataFrame, buckets: int) -> DataFrame:
    """doc_id, text_hash, found: the first words of the windows that a smaller doc_id has."""
    shared = repeats.with_found(docs, repeats.shared_names(docs, symbol_names, buckets))
    named = repeats.with_found(docs, repeats.shared_names(shared, phrase_names, buckets))

    def send(batches):
        for batch in repeats.regrouped(batches):
            known_owner, known = repeats.names_by_document(batch)

            def found(a, b, data, offsets, known_owner=known_owner, known=known):
                w = read(data, offsets, exact=True)
                name, _ = window_names(w)
                inside = (known_owner >= a) & (known_owner < b)
                keep = repeats.held(w.doc + a, name, known_owner[inside], known[inside])
                at, doc = w.at[keep], w.doc[keep]
                out = np.zeros(len(at), WORD_WINDOW)
                out["h"] = common.span_hash(w.prefix, at, at + WINDOW)
                out["g"] = common.span_hash(w.second, at, at + WINDOW) >> np.uint64(32)
                out["start"] = at - w.first[doc]
                return doc + a, out

            yield from send_windows(repeats.heads_of(batch), *_by_chunk(*common.columnar(batch.column("text")), found), buckets)

    moved = named.mapInArrow(send, repeats.MOVED)
    return repeats.by_bucket(moved, buckets, lambda batches: repeats.gathered(batches, lambda b: np.frombuffer(b, WORD_WINDOW), buckets, _settle))


def send_windows(heads, owner, w, buckets):
    if not len(w):
        return
    ids = heads["doc_id"][owner]
    order = np.lexsort((ids, w["g"], w["h"]))
    owner, w, ids = owner[order], w[order], ids[order]
    new = np.append(True, (w["h"][1:] != w["h"][:-1]) | (w["g"][1:] != w["g"][:-1]))
    least = ids[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = ids > least
    out = repeats.finished(heads, owner[later], w["start"][later], buckets)
    if out is not None:
        yield from (out.slice(i, 2000) for i in range(0, len(out), 2000))
    owner, w = owner[~later], w[~later]
    out = repeats.dealt(heads, (w["h"] >> np.uint64(32)) % np.uint64(buckets), owner, w, np.ndarray.tobytes)
    if out is not None:
        yield out


def _settle(docs, owner, w):
    ids = docs["doc_id"][owner]
    order = np.lexsort((ids, w["g"], w["h"]))
    owner, w, ids = owner[order], w[order], ids[order]
    new = np.append(True, (w["h"][1:] != w["h"][:-1]) | (w["g"][1:] != w["g"][:-1]))
    later = ids > ids[np.flatnonzero(new)][np.cumsum(new) - 1]
    return owner[later], np.ascontiguousarray(w["start"][later])


def covered(starts: np.ndarray, n: int, width: int = WINDOW) -> np.ndarray:
    """Which of n units lie in [start, start + width) of any start."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + width, n), -1)
    return np.cumsum(edges[:-1]) > 0


def dedup(docs: DataFrame, texts: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256; texts: kept_text too."""
    common.small_batches(docs.sparkSession)
    rows = repeats.once(repeats.keyed(docs))
    found = removed_windows(rows, common.bucket_count(rows))

    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text")}
            for doc_id, text, lists in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), batch.column("found").to_pylist(), strict=True):
                words, gone = text.split(), 0
                n = len(words)
                if lists:
                    cover = covered(np.frombuffer(b"".join(lists), "<u4").astype(np.int64), n)
                    gone = int(cover.sum())
                    words = [w for w, c in zip(words, cover.tolist(), strict=True) if not c]
                kept = b" ".join(words)
                for k, v in zip(out, (doc_id, n, gone, repeats.digest(kept), kept.decode() if texts else None), strict=True):
                    out[k].append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            names = list(out) if texts else list(out)[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in zip(names, kinds, strict=False)], names)

    with_lists = common.times(repeats.with_found(rows, found), F.col("copies")).select("doc_id", "text", "found")
    return with_lists.mapInArrow(run, RESULT + (", kept_text string" if texts else ""))


def removed_words(docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", F.col("n_removed"))
