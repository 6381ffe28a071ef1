import re
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from marquee.llm import mixing, packing, quality, secrets
from tests.llm.test_nearcopies import brute
from tests.llm.test_text_rules import counts


def masked(text):
    """The text with every secret masked, by re."""
    if text is None:
        return None
    found = []
    for rule in secrets.MASKED:
        found += [(m.start(), m.end()) for m in re.finditer(rule.pattern, text) if len(m[rule.group]) >= rule.least]
    out, at = "", 0
    for start, end in sorted(found):
        if start >= at:
            out += text[at:start] + secrets.MASK
        at = max(at, end)
    return out + text[at:]


def test_run_against_plain_stages(spark, odd_documents, no_documents, tmp_path):
    """Each stage's rows against a plain version on the rows of the one before, and run() against the stages."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = odd_documents.select(*columns)
    extra = [(900, "see token=abcdefgh1 " + "prose words go on " * 3 + " ".join(f"w{i}" for i in range(60)), "en", "s1", 1)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near dedup", "secret scan", "source mix", "packing"]
    rows = lambda df: Counter(tuple(r) for r in df.select(*columns).collect())
    after, now = [], spark.read.parquet(str(tmp_path / "documents.parquet"))
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, str(tmp_path))
        now.write.parquet(str(tmp_path / f"stage{i}"))
        now = spark.read.parquet(str(tmp_path / f"stage{i}"))
        after.append(now)
    assert all(x.columns == columns for x in after[:-1])

    judged = quality.judge(docs).filter("kept").select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    first = after[0].collect()
    assert Counter((r.doc_id, *counts(r.text)) for r in first) == Counter(tuple(r) for r in judged.collect()) and first

    second = after[1].collect()
    assert sorted((r.doc_id for r in second), key=str) == brute([(r.doc_id, r.text) for r in first])
    assert rows(after[1]) <= rows(after[0])

    third = Counter()
    for r in second:
        text = masked(r.text)
        third[(r.doc_id, text, r.lang, r.source, r.n_chars if text == r.text else len(text))] += 1
    assert rows(after[2]) == third and any("[SECRET]" in (k[1] or "") for k in third)

    con = pytest.importorskip("duckdb").connect()
    documents = after[2].toPandas()
    takes = con.execute(f"SELECT doc_id, size, taken FROM ({mixing.ORACLE})").fetchall()
    assert len(documents) == len(takes)
    copies = Counter({(d, s): t // s for d, s, t in takes if s})
    assert Counter((r.doc_id, counts(r.text)[0]) for r in after[3].collect() if counts(r.text)[0]) == +copies

    pieces = Counter()
    for r in after[3].collect():
        ids = np.array(packing._encoder(packing.TOKENIZER).encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        for start, size in packing.pieces(len(ids)):
            pieces[(r.doc_id, start, size, zlib.crc32(ids[start : start + size].tobytes()), len(ids))] += 1
    digest = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert Counter(tuple(r[c] for c in digest) for r in after[4].collect()) == pieces
    assert Counter(tuple(r[c] for c in digest) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == pieces

    now = no_documents.select(*columns)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, "")
    assert now.collect() == []


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1


@pytest.mark.parametrize("name", ["op3_mtree", "op8_secrets", "op9_mixing"])
def test_queries_match_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    df = __spark_entry__.queries()[name](spark, d)
    columns = sorted(df.columns)
    got = sorted(map(str, (tuple(r) for r in df.select(columns).collect())))
    want = sorted(map(str, con.execute(f"SELECT {', '.join(columns)} FROM ({__spark_entry__.oracle_sql()[name]})").fetchall()))
    assert got == want
