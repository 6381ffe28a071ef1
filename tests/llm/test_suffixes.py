import hashlib

import numpy as np

from marquee.llm import suffixes


def brute(rows):
    least = {}
    for doc_id, text in rows:
        t = (text or "").encode()
        if doc_id is not None:
            for i in range(len(t) - 49):
                least[t[i : i + 50]] = min(doc_id, least.get(t[i : i + 50], doc_id))
    out = []
    for doc_id, text in rows:
        t = (text or "").encode()
        gone = np.zeros(len(t) + 1, bool)
        if doc_id is not None:
            for i in range(len(t) - 49):
                if least[t[i : i + 50]] < doc_id:
                    gone[i : i + 50] = True
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_against_brute_force(odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    got = sorted((tuple(r) for r in suffixes.dedup(odd_documents).collect()), key=str)
    assert got == brute(rows)
    assert sum(r[2] for r in got) > 5000


def test_empty_table(no_documents):
    assert suffixes.dedup(no_documents).collect() == []


def test_suffix_groups():
    rng = np.random.default_rng(5)
    for kinds in (1, 2, 4, 200):
        text = rng.integers(0, kinds, 3000).astype(np.uint8)
        text[1000:1300] = text[200:500]
        starts = rng.permutation(2900)[:2000]
        leader = suffixes.suffix_groups(text, starts)
        body = [text[s : s + 50].tobytes() for s in starts]
        assert all(body[i] == body[j] for i, j in enumerate(leader))
        assert len(set(leader.tolist())) == len(set(body))


def test_slices_of_names_change_nothing(monkeypatch):
    rng = np.random.default_rng(9)
    e = np.zeros(400, suffixes.ENTRY)
    e["name"] = rng.integers(0, 12, 400)  # equal windows have equal names, so texts follow from names
    e["first"], e["n"] = rng.integers(0, 10, 400), rng.integers(1, 25, 400)
    e["text"] = rng.integers(97, 99, (12, suffixes.CONTEXT))[e["name"]]
    e["text"][np.arange(400), rng.integers(40, suffixes.CONTEXT, 400)] = 120
    ids = rng.integers(0, 50, 400)
    whole = suffixes.removed_bits(e, ids)
    monkeypatch.setattr(suffixes, "SLICE", 60)
    assert (suffixes.removed_bits(e, ids) == whole).all() and (whole > 0).any()
