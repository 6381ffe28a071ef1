import hashlib
from collections import defaultdict

import numpy as np

from marquee.llm import recompress


def brute(rows):
    starts = defaultdict(set)
    for doc_id, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - 49):
            starts[tuple(words[i : i + 50])].add(doc_id)
    out = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - 49):
            if doc_id is not None and any(d is not None and d < doc_id for d in starts[tuple(words[i : i + 50])]):
                gone |= set(range(i, i + 50))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_against_brute_force(odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    got = sorted((tuple(r) for r in recompress.dedup(odd_documents).collect()), key=str)
    assert got == brute(rows)
    assert sum(r[2] for r in got) > 1000


def test_words_that_collide_modulo_a_power_of_two_stay(spark):
    a = "a"
    for _ in range(10):
        a += a.translate(str.maketrans("ab", "ba"))
    tail = " ".join(f"w{i}" for i in range(49))
    rows = [(1, f"{a} {tail}"), (2, f"{a.translate(str.maketrans('ab', 'ba'))} {tail}")]
    got = sorted(tuple(r) for r in recompress.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute(rows) and got[1][2] == 0


def test_repeated_rows_cost_no_square(spark):
    text = " ".join(f"word{i}" for i in range(700))
    rows = [(5, text)] * 2000 + [(9, text + " more"), (2, " ".join(text.split()[:60])), (None, text), (None, text)]
    got = sorted((tuple(r) for r in recompress.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute(rows)


def test_empty_table(no_documents):
    assert recompress.dedup(no_documents).collect() == []


def test_equal_windows_have_equal_names():
    rng = np.random.default_rng(1)
    passages = [rng.integers(0, kinds, 50) for kinds in (2, 5, 1000)]
    passages += [np.zeros(50, int), np.arange(50) % 2, np.arange(50) % 7, np.r_[np.zeros(25, int), np.arange(25)], np.r_[np.arange(20), np.zeros(30, int)], np.repeat(np.arange(5), 10)]
    for passage in passages:
        seen, kinds = set(), int(passage.max()) + 1
        for k in range(60):
            left, right = (rng.integers(0, kinds, rng.integers(0, 40)) if k % 2 else passage[rng.integers(0, 50)].repeat(rng.integers(0, 30)) for _ in "ab")
            words = [str(w).encode() for w in np.concatenate([left, passage, right])]
            text = b" ".join(words)
            w = recompress.read(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
            want = [str(x).encode() for x in passage]
            seen |= {pair for s, pair in zip(w.at, zip(*(n.tolist() for n in recompress.window_names(w)))) if words[s : s + 50] == want}
        assert len(seen) == 1


def test_runs_and_pairs_become_symbols():
    words = np.array([7, 7, 7, 1, 2, 7, 7, 7, 1, 2, 7, 7], np.uint64)
    doc = np.array([0] * 10 + [1] * 2)
    got = recompress.runs(recompress.Symbols(words, np.arange(12), doc, np.arange(12), np.arange(12) + 1), 0)
    assert got.at.tolist() == [0, 3, 4, 5, 8, 9, 10] and got.name[0] == got.name[3] != got.name[6] and got.name[1] == 1
    assert (got.low[3], got.high[3]) == (4, 9) and got.low[0] == -1 and got.high[5] == 11 and got.low[6] == 9 and got.high[6] > 12
    top = recompress.symbols(np.tile(np.array([5, 6, 9, 4], np.uint64), 20), np.zeros(80, int), 12)
    assert len(top.name) < 10


def test_least_of_ranges():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 30, 200)
    first = rng.integers(0, 190, 500)
    last = np.minimum(200, first + rng.integers(0, 60, 500))
    got = recompress.least_of(values, first, last)
    assert all(values[g] == values[a:b].min() and a <= g < b for g, a, b in zip(got, first, last) if b > a)


def test_what_is_found_depends_on_the_symbols(spark, odd_documents, monkeypatch):
    plain = recompress.symbols
    rng = np.random.default_rng(3)

    def strange(words, doc, rounds=recompress.ROUNDS):
        s = plain(words, doc, rounds)
        s.name = rng.integers(0, 1 << 62, len(s.name)).astype(np.uint64)
        return s

    monkeypatch.setattr(recompress, "symbols", strange)
    import pyarrow as pa

    text = pa.array(["w" + " w".join(map(str, range(80)))] * 2)
    owner, name = recompress.symbol_names(pa.RecordBatch.from_arrays([text], ["text"]))
    assert not set(name[owner == 0]) & set(name[owner == 1])
    monkeypatch.setattr(recompress, "symbols", plain)
    owner, name = recompress.symbol_names(pa.RecordBatch.from_arrays([text], ["text"]))
    assert set(name[owner == 0]) == set(name[owner == 1])
