"""Packing, top-k search, language ID, toxicity."""

import itertools
import math
import operator
import random
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from marquee.llm import langid, mtree, packing, toxicity



WORDS = {"en": ["the", "house", "water", "light", "window", "garden", "people", "winter"], "de": ["das", "haus", "wasser", "licht", "fenster", "garten", "leute", "winterzeit"]}


def test_packing_round_trip(odd_documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = packing.pack(odd_documents).collect()
    want = sorted(tuple(whole.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in odd_documents.collect())
    docs, at = [], 0
    for r in rows:  # pieces of a document stand one after the other
        assert r.start == (0 if r.start == 0 else at) and len(r.ids) == r.length and r.length & (r.length - 1) == 0 and r.length <= 2048 and r.offset == 0
        docs.append([]) if r.start == 0 else None
        docs[-1] += r.ids
        at = r.start + r.length
    assert sorted(map(tuple, docs)) == want
    assert len({r.sequence_id for r in rows}) == len(rows)
    digests = {r.sequence_id: r.ids_crc32 for r in packing.pack(odd_documents, digest=True).collect()}
    assert digests == {r.sequence_id: zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows}


@pytest.mark.parametrize("text", ["İ ́ ÀÉ don't WE'LL x<|endoftext|>y", "日本 語 １２３ ½", "a..b, c., \x85 \xa0 d", "ΑΣ Σ ǅ ß"])
def test_parts_encode_like_the_whole(text):
    words = packing.words_of(packing.TOKENIZER)
    assert packing.token_ids(text.encode(), words).tolist() == packing._encoder(packing.TOKENIZER).encode(text, add_special_tokens=False).ids + [1]


def test_pieces_cover():
    for n in (1, 2, 3, 2047, 2048, 2049, 10_000):
        parts = packing.pieces(n)
        assert sum(s for _, s in parts) == n and [a for a, _ in parts] == list(itertools.accumulate([0] + [s for _, s in parts[:-1]]))


def plain_top_k(rows, query_of, k=10):
    """Query, rank, candidate and score by Python integers, every row against every other."""
    whole = [(i, [math.floor(1024 * v) for v in x]) for i, x in rows if i is not None and x and None not in x and np.isfinite(x).all()]
    out = []
    for a, (i, q) in enumerate(whole):
        if query_of(i):
            best = sorted((-sum(map(operator.mul, q, x)), j) for b, (j, x) in enumerate(whole) if a != b and len(x) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(400, 8)).astype(np.float32)
    v[50:120] = v[50]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(None, v[3].tolist()), (900, None), (901, [1.0, None] * 4), (902, [float("nan")] * 8), (903, [float("inf")] * 8), (904, []), (950, [1.0, 2.0]), (951, [2.0, 1.0])]
    rows += [(100, v[7].tolist()), (100, v[100].tolist()), (3, v[3].tolist())]
    df = spark.createDataFrame([(*r, "v", 1) for r in rows], "vec_id long, embedding array<float>, row string, size int")
    want = plain_top_k(rows, lambda i: i % 50 == 0)
    for options in ({"part": 60, "page": 8, "block": 3, "most_routes": 4}, {"part": 20, "page": 4}, {}):
        got = sorted(tuple(r) for r in mtree.search(df, F.col("vec_id") % 50 == 0, **options).collect())
        assert got == want
    assert mtree.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert mtree.top_k(df, F.col("vec_id") < 0).collect() == []


def test_top_k_of_large_components_and_repeated_ids(spark):
    rows = [(2000, [2000.0, 1.0]), (1, [3000.0, 0.0]), (2, [1500.0, 5.0]), (3, [1.0, 2.0]), (3, [1.0, 2.0]), (2000, [-5.0, 1e5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = mtree.top_k(df, F.col("vec_id") == 2000).collect()
    assert sorted(tuple(r) for r in got) == plain_top_k(rows, lambda i: i == 2000)
    wide = [(i, [(-1.0) ** i * 2.0**k, 3.0 + i, 2.0**-9]) for i, k in enumerate((0, 20, 21, 21, 18, 12, 21, 3))]
    df = spark.createDataFrame(wide, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in mtree.search(df, F.col("vec_id") % 2 == 0, k=3).collect()) == plain_top_k(wide, lambda i: i % 2 == 0, 3)
    df = spark.createDataFrame([(1, [1e12]), (2, [1e12])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit"):
        mtree.top_k(df, F.col("vec_id") == 1).collect()


def sentences(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def test_language_of_held_out_text(spark, no_documents):
    rng = random.Random(4)
    rows = [(i, sentences(rng, lang, rng.randrange(3, 60)), lang, "s", "x") for i in range(300) for lang in [rng.choice(["en", "de"])]]
    odd = [(1000, None, None, None, "x"), (1001, "", "en", None, "x"), (1002, "123 !? \t", "en", None, "x"), (None, "water garden", "en", None, "x"), (5, "haus wasser " * 5000, "de", None, "x")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, source string, score string")
    got = langid.identify(docs).collect()
    assert len(got) == len(rows) + len(odd)
    truth = {r[0]: r[2] for r in rows if r[0] != 5}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 40 and sum(truth[r.doc_id] == r.lang_pred for r in held) / len(held) > 0.97
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == "und" for i in (1000, 1001, 1002)) and by_id[None].lang_pred == "en"
    assert all(0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert langid.identify(no_documents).collect() == []


def test_phrases_are_longest_matches():
    codes, n, tables = langid.model((("a", b"abcabd"),))
    rows = [b"abcabd", b"abdabc", b"zz", b"cababd"]
    for text, want in zip(rows, (1, 2, 3, 2)):
        at = codes[np.frombuffer(text, np.uint8)][:, None]
        assert langid.phrases(tables[0], n, np.ascontiguousarray(at), np.array([len(text)]))[0] == want


def test_marginals_against_all_paths():
    rng = np.random.default_rng(3)
    e, t = rng.normal(size=5), rng.normal(size=(2, 2))
    weight, p, pairs = 0.0, np.zeros(5), np.zeros((2, 2))
    for path in itertools.product((0, 1), repeat=5):
        w = np.exp(sum(e[i] for i in range(5) if path[i]) + sum(t[a, b] for a, b in zip(path, path[1:])))
        weight += w
        p += w * np.array(path)
        for a, b in zip(path, path[1:]):
            pairs[a, b] += w
    got, got_pairs = toxicity.marginals(e, np.zeros(5, int), np.arange(5), 1, t)
    assert np.allclose(got, p / weight) and np.allclose(got_pairs, pairs / weight)


def test_toxicity_of_held_out_documents(spark, no_documents):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(500):
        words = [rng.choice("abcdefgh") + rng.choice(["lo", "mi", "ta"]) + str(rng.randrange(60)) for _ in range(40)]
        toxic = int(i % 4 == 0)
        for k in range(3 * toxic):
            words[rng.randrange(40)] = rng.choice(["vile", "rotten", "awfulness", "awfully"])
        rows.append((i, " ".join(words), "en", "s", 1.0))
        labels.append((i, 1, toxic))
    rows += [(None, None, None, None, None), (7000, "", "en", "s", 0.0), (7001, "rotten vile " * 4000, "en", "s", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double")
    truth = spark.createDataFrame(labels + [(None, 1, 1), (9999, 1, None)], "doc_id long, quality long, toxic long")
    got = {r.doc_id: r for r in toxicity.rate(docs, truth).collect()}
    held = [i for i in range(500) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i].predicted == (i % 4 == 0) for i in held) / len(held) > 0.97
    assert got[7001].predicted == 1 and got[7000].predicted == 0 and got[7001].spans.startswith("0:")
    start, end = got[0].spans.split(",")[0].split(":")
    assert rows[0][1][int(start) : int(end)].split()[0] in ("vile", "rotten", "awfulness", "awfully")
    assert toxicity.rate(no_documents, truth).collect() == []
    assert {r.score for r in toxicity.rate(docs, truth.limit(0)).collect()} == {1 / (1 + np.exp(30.0))}
