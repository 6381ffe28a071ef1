"""Substring dedup over bytes by a hash-compared suffix sort.

Sorting every suffix of a corpus is out of reach, so suffixes are sampled first: a 50-byte window is represented by the
16-byte string inside it whose hash is least. marquee.llm.repeats finds the representatives that two documents share.
Around each of those a context of 84 bytes holds every window that it stands for. Contexts with one representative meet
in one bucket. Equal contexts (hashes bring them together, bytes are compared) are one class: all of its windows start
in its least doc_id, and in every other member they go. Where one representative has several classes, the windows of
each class's first member are sorted as suffixes: a mergesort whose comparisons find the longest common extension of two
suffixes by binary search over prefix polynomial hashes, 6 steps for 50 bytes, and look at the byte after it. Suffixes
whose extension reaches 50 stand side by side; their bytes are compared before they count as equal, and from then on they
are sorted as one. Each such group of windows goes where its least doc_id is not.

Cases: a null or empty text has no bytes; texts under 50 bytes keep all; rows with a null doc_id keep all and remove
nothing; rows that repeat a doc_id don't remove each other's bytes; an empty table gives no rows; other columns of any
name are ignored. Bytes kept may start or end inside a character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import common, repeats
from marquee.llm.recompress import covered

WINDOW = 50
GRAM = 16
REACH = WINDOW - GRAM
SLICE = 250_000
CONTEXT = REACH + WINDOW
ENTRY = np.dtype([("name", "<u8"), ("start", "<u4"), ("first", "u1"), ("n", "u1"), ("text", "u1", (CONTEXT,))])
GONE = np.dtype([("start", "<u4"), ("bits", "<u8")])
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def representatives(data: np.ndarray, offsets: np.ndarray):
    """For each window, in order: its first byte, its document, its representative's place and name."""
    n = len(data)
    nothing = np.zeros(0, np.int64)
    if n < WINDOW:
        return nothing, nothing, nothing, np.zeros(0, np.uint64)
    prefix = common.prefix_hash(common.BYTE_KEYS[data])
    at = np.arange(n - GRAM + 1)
    _, down = common.powers(n + 1)
    values = common.mix((prefix[GRAM:] - prefix[: n - GRAM + 1]) * down[: n - GRAM + 1])
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    anchor = repeats.anchors_of_windows(values, 0, REACH)
    at = np.flatnonzero(doc[: n - WINDOW + 1] == doc[WINDOW - 1 :])
    place = anchor[at]
    return at, doc[at], place, values[place]


def occurrences(data: np.ndarray, offsets: np.ndarray):
    """document, place, name, first window and number of windows of each representative."""
    at, doc, place, name = representatives(data, offsets)
    first = repeats.firsts(place)
    return doc[first], place[first].astype(np.int64), name[first], at[first], np.diff(np.append(first, len(place)))


def _names(batch: pa.RecordBatch):
    data, offsets = common.columnar(batch.column("text"))
    owners, names = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for a, b in common.chunks(offsets):
        doc, _, name, _, _ = occurrences(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        order = np.lexsort((name, doc))
        doc, name = doc[order], name[order]
        new = np.append(True, (doc[1:] != doc[:-1]) | (name[1:] != name[:-1])) if len(doc) else np.zeros(0, bool)
        owners.append(doc[new] + a)
        names.append(name[new])
    return np.concatenate(owners), np.concatenate(names)


def _entries(data: np.ndarray, offsets: np.ndarray, known_owner: np.ndarray, known: np.ndarray):
    doc, place, name, at, n = occurrences(data, offsets)
    keep = repeats.held(doc, name, known_owner, known)
    doc, place, name, at, n = doc[keep], place[keep], name[keep], at[keep], n[keep]
    out = np.zeros(len(doc), ENTRY)
    out["name"], out["start"], out["n"] = name, at - offsets[doc], n
    out["first"] = at - (place - REACH)
    columns = np.arange(CONTEXT)
    where = (place - REACH)[:, None] + columns
    inside = (columns >= out["first"][:, None]) & (columns < (out["first"].astype(np.int64) + n + WINDOW - 1)[:, None])
    out["text"] = np.where(inside, data[np.clip(where, 0, max(0, len(data) - 1))], 0)
    return doc, out


def _packed(entries: np.ndarray) -> bytes:
    """Entries by column, compressed: contexts overlap and are text."""
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(b"".join(np.ascontiguousarray(entries[k]).tobytes() for k in ENTRY.names))


def _unpacked(data: bytes) -> np.ndarray:
    import zstandard

    raw, at = zstandard.ZstdDecompressor().decompress(data), 0
    out = np.zeros(len(raw) // ENTRY.itemsize, ENTRY)
    for k in ENTRY.names:
        size = ENTRY[k].itemsize * len(out)
        out[k] = np.frombuffer(raw[at : at + size], ENTRY[k].base).reshape(out[k].shape)
        at += size
    return out


def classes(entries: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that puts equal contexts together, least doc_id first; where a class begins in it; where a name does."""
    width = CONTEXT + 2
    body = np.concatenate([entries["text"], entries["first"][:, None], entries["n"][:, None]], axis=1)
    places = common.powers(width)[0][:width]
    keys = np.empty(len(body), np.uint64)
    for a in range(0, len(body), 4096):  # a key is eight times as wide as a byte
        keys[a : a + 4096] = common.mix((common.BYTE_KEYS[body[a : a + 4096]] * places).sum(axis=1, dtype=np.uint64))
    order = np.lexsort((ids, keys, entries["name"]))
    body, name = body[order], entries["name"][order]
    new_name = np.append(True, name[1:] != name[:-1])
    return order, new_name | np.append(True, (body[1:] != body[:-1]).any(axis=1)), new_name


def suffix_groups(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each suffix the index of one that has the same WINDOW bytes, the same for all of them.

    A bottom-up mergesort, all merges of a level at once: an element finds its place in the run beside its own by binary
    search. Suffixes that meet with equal bytes go on as one, so a window that stands in many texts is not sorted many times.
    """
    n = len(starts)
    leader = np.arange(n)
    if not n:
        return leader
    prefix = common.prefix_hash(common.BYTE_KEYS[text])
    _, down = common.powers(len(prefix))

    def extension(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes two suffixes have in common, 8 at least (they have the same lead), WINDOW at most."""
        low, high = np.full(len(a), 8), np.full(len(a), WINDOW)
        for _ in range(6):
            mid = (low + high + 1) // 2
            same = (prefix[a + mid] - prefix[a]) * down[a] == (prefix[b + mid] - prefix[b]) * down[b]
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def before(a: np.ndarray, b: np.ndarray, ties: np.ndarray) -> np.ndarray:
        lcp = extension(a, b)
        at = np.minimum(lcp, WINDOW - 1)
        return np.where(lcp == WINDOW, ties, text[a + at] < text[b + at])

    def equal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hashes first, then the bytes themselves."""
        same = extension(a, b) == WINDOW
        pairs, span = np.flatnonzero(same), np.arange(WINDOW)
        for i in range(0, len(pairs), 1 << 14):
            at = pairs[i : i + (1 << 14)]
            same[at] = (text[a[at][:, None] + span] == text[b[at][:, None] + span]).all(axis=1)
        return same

    lead = np.zeros(n, np.uint64)
    for i in range(8):
        lead = lead << np.uint64(8) | text[starts + i].astype(np.uint64)
    order = np.argsort(lead, kind="stable")
    group = np.cumsum(np.append(0, lead[order][1:] != lead[order][:-1]))
    run = np.arange(n) - repeats.firsts(group)[group]
    while True:
        runs = np.zeros(int(group.max()) + 1, np.int64) if len(group) else np.zeros(1, np.int64)
        np.maximum.at(runs, group, run + 1)
        live = runs[group] > 1
        order, group, run = order[live], group[live], run[live]
        if not len(order):
            break
        at = starts[order]
        begin = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (run[1:] != run[:-1])))
        end = np.append(begin[1:], len(order))
        mine = np.repeat(np.arange(len(begin)), end - begin)
        beside = mine + np.where(run % 2 == 0, 1, -1)
        paired = (run % 2 == 1) | ((beside < len(begin)) & (group[begin[np.minimum(beside, len(begin) - 1)]] == group))
        beside = np.where(paired, beside, mine)
        low = begin[beside].copy()
        high = np.where(paired, end[beside], low)
        ties = run % 2 == 1
        while True:
            some = np.flatnonzero(low < high)
            if not len(some):
                break
            mid = (low[some] + high[some]) // 2
            ahead = before(at[mid], at[some], ties[some])
            low[some] = np.where(ahead, mid + 1, low[some])
            high[some] = np.where(ahead, high[some], mid)
        place = np.arange(len(order)) - begin[mine] + (low - begin[beside]) + np.where(ties, begin[beside], begin[mine])
        merged = np.empty_like(order)
        merged[place] = order
        order, run, at = merged, run // 2, starts[merged]
        near = np.flatnonzero((group[1:] == group[:-1]) & (run[1:] == run[:-1]))
        again = np.zeros(len(order), bool)
        again[near + 1] = equal(at[near], at[near + 1])
        first = np.maximum.accumulate(np.where(again, 0, np.arange(len(order))))
        leader[order[again]] = order[first[again]]
        order, group, run = order[~again], group[~again], run[~again]
    while True:
        up = leader[leader]
        if (up == leader).all():
            return leader
        leader = up


def _later_windows(e: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each entry the windows that another one with a smaller doc_id has, by sorting all of them."""
    n = e["n"].astype(np.int64)
    owner = np.repeat(np.arange(len(e)), n)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    starts = owner * CONTEXT + np.repeat(e["first"].astype(np.int64), n) + step
    leader = suffix_groups(np.ascontiguousarray(e["text"]).reshape(-1), starts)
    who = ids[owner]
    least = np.full(len(starts), np.iinfo(np.int64).max)
    np.minimum.at(least, leader, who)
    gone = who > least[leader]
    hit = np.zeros(len(e), np.uint64)
    np.bitwise_or.at(hit, owner[gone], np.uint64(1) << step[gone].astype(np.uint64))
    return hit


def removed_bits(entries: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each entry the windows, counted from its first, that another entry with a smaller doc_id has."""
    bits = np.zeros(len(entries), np.uint64)
    if not len(entries):
        return bits
    order, new_class, new_name = classes(entries, ids)
    heads = np.flatnonzero(new_class)
    own = np.cumsum(new_class) - 1
    ordered = ids[order]
    later = ordered > ordered[heads][own]
    every = (np.uint64(1) << entries["n"].astype(np.uint64)) - np.uint64(1)
    bits[order[later]] = every[order[later]]
    name = np.cumsum(new_name) - 1
    several = np.bincount(name[heads])[name[heads]] > 1
    chosen = order[heads[several]]
    if len(chosen):
        hit = np.zeros(len(chosen), np.uint64)
        e, of_name = entries[chosen], name[heads[several]]
        upto = np.cumsum(e["n"].astype(np.int64))
        first = 0
        while first < len(chosen):  # whole names at a time, so that windows in hand stay few
            last = int(np.searchsorted(upto, (upto[first - 1] if first else 0) + SLICE, "right"))
            last = int(np.searchsorted(of_name, of_name[max(first, last - 1)], "right"))
            hit[first:last] = _later_windows(e[first:last], ids[chosen[first:last]])
            first = last
        # members of a class with the head's doc_id have its windows too
        ours = np.zeros(len(heads), np.uint64)
        ours[several] = hit
        equal = ~later
        bits[order[equal]] |= ours[own[equal]]
    return bits


def _gone(entries: np.ndarray, bits: np.ndarray) -> np.ndarray:
    out = np.zeros(len(entries), GONE)
    out["start"], out["bits"] = entries["start"], bits
    return out


def removed_windows(docs: DataFrame, buckets: int) -> DataFrame:
    shared = repeats.with_found(docs, repeats.shared_names(docs, _names, buckets))

    def send(batches):
        for batch in repeats.regrouped(batches):
            heads = repeats.heads_of(batch)
            known_owner, known = repeats.names_by_document(batch)
            data, offsets = common.columnar(batch.column("text"))
            owners, found = [], []
            for a, b in common.chunks(offsets):
                inside = (known_owner >= a) & (known_owner < b)
                doc, e = _entries(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], known_owner[inside] - a, known[inside])
                owners.append(doc + a)
                found.append(e)
            owner, e = np.concatenate(owners), np.concatenate(found)
            if not len(e):
                continue
            ids = heads["doc_id"][owner]
            order, new_class, _ = classes(e, ids)
            least = ids[order][np.flatnonzero(new_class)][np.cumsum(new_class) - 1]
            later = np.zeros(len(e), bool)
            later[order] = ids[order] > least
            every = (np.uint64(1) << e["n"].astype(np.uint64)) - np.uint64(1)
            out = repeats.finished(heads, owner[later], _gone(e, every)[later], buckets)
            if out is not None:
                yield from (out.slice(i, 2000) for i in range(0, len(out), 2000))
            owner, e = owner[~later], e[~later]
            out = repeats.dealt(heads, (e["name"] & repeats.NAME_BITS) % np.uint64(buckets), owner, e, _packed)
            if out is not None:
                yield out

    def settle(docs, owner, e):
        bits = removed_bits(e, docs["doc_id"][owner])
        hit = bits > 0
        return owner[hit], _gone(e, bits)[hit]

    moved = shared.mapInArrow(send, repeats.MOVED)
    return repeats.by_bucket(moved, buckets, lambda batches: repeats.gathered(batches, _unpacked, buckets, settle))


def kept_spans(gone: np.ndarray, n: int) -> np.ndarray:
    """Which of n bytes are removed."""
    if not len(gone):
        return np.zeros(n, bool)
    at = np.flatnonzero(gone["bits"][:, None] >> np.arange(REACH + 1, dtype=np.uint64) & np.uint64(1))
    return covered(gone["start"].astype(np.int64)[at // (REACH + 1)] + at % (REACH + 1), n)


def dedup(docs: DataFrame, texts: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256; texts: kept, the bytes, too."""
    common.small_batches(docs.sparkSession)
    rows = repeats.once(repeats.keyed(docs))
    found = removed_windows(rows, common.bucket_count(rows))

    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for doc_id, text, lists in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), batch.column("found").to_pylist(), strict=True):
                removed = spans = 0
                kept = text
                if lists:
                    cover = kept_spans(np.frombuffer(b"".join(lists), GONE), len(text))
                    removed, spans = int(cover.sum()), int(cover[0]) + int((cover[1:] & ~cover[:-1]).sum())
                    kept = np.frombuffer(text, np.uint8)[~cover].tobytes()
                for k, v in zip(out, (doc_id, len(text), removed, spans, repeats.digest(kept), kept if texts else None), strict=True):
                    out[k].append(v)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            names = list(out) if texts else list(out)[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in zip(names, kinds, strict=False)], names)

    with_lists = common.times(repeats.with_found(rows, found), F.col("copies")).select("doc_id", "text", "found")
    return with_lists.mapInArrow(run, RESULT + (", kept binary" if texts else ""))
