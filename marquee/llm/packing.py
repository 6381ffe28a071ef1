"""Packing by power-of-two decomposition.

A document of n tokens, its end token included, is cut into pieces whose lengths are the powers of two of n's binary
form, largest first, and as many pieces of the longest allowed length before them as fit. Every piece is a sequence of
its own, so no sequence holds tokens of two documents and none is padded; equal lengths form a bucket, which a trainer
draws its batches from. Nothing is shuffled: a document's pieces follow from its own length.

Cases: a null or empty text is its end token alone, one piece of length 1; null and repeated doc_ids are packed like
others, each row for itself; an empty table gives no rows; other columns are not read. sequence_id carries the bucket
(log2 of the length) in its upper six bits, then the input partition, then a running number, so it is unique whatever
doc_id holds. A text is encoded in parts between ASCII white space, which the tokenizer drops at the start of every
pre-token; the parts' ids are remembered up to CACHE parts, so memory stays bounded.
"""

from __future__ import annotations

import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import common

LONGEST = 2048
END = 1
TOKENIZER = "word_bpe_49k.json"
CACHE = 600_000
SCHEMA = "doc_id long, start long, length long, ids array<int>, doc_tokens long, sequence_id long, offset long"


@lru_cache(4)
def _encoder(tokenizer: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(tokenizer))


@lru_cache(1)
def _byte_letters() -> list[str]:
    """The letter that byte-level BPE writes for each byte: printable Latin-1 stands for itself, the others follow from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)]


class Words(dict):
    """Ids of parts of a text, as bytes of little-endian 32-bit values.

    Latin letters, with a full stop or comma at most after them, go straight to the tokenizer's BPE model, as its own
    normalizer and splitter would send them there; all else goes through the whole tokenizer.
    """

    def __init__(self, tokenizer: str):
        super().__init__()
        self.whole = _encoder(tokenizer).encode
        self.model = _encoder(tokenizer).model.tokenize
        self.marks = {mark: self.ids(mark) for mark in ".,"} | {"": b""}

    def ids(self, part: str) -> bytes:
        return np.array(self.whole(part, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, letters: str) -> bytes:
        lower = letters.lower()
        if not lower.isascii():
            table = _byte_letters()
            lower = "".join([table[b] for b in lower.encode()])
        return array("I", [t.id for t in self.model(lower)]).tobytes()

    def __missing__(self, key: bytes) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        part = key.decode()
        mark = part[-1:] if part[-1:] in self.marks else ""
        letters = part[: len(part) - len(mark)]
        ids = self.word(letters) + self.marks[mark] if letters and max(letters) < "\u0180" and letters.lower().isalpha() else self.ids(part)
        if len(key) <= 64:
            self[key] = ids
        return ids


@lru_cache(2)
def words_of(tokenizer: str) -> Words:
    """One memory for all tasks of a worker."""
    return Words(tokenizer)


def token_ids(text: bytes, words: Words, end: int = END) -> np.ndarray:
    return np.frombuffer(b"".join(map(words.__getitem__, text.split())) + np.array([end], "<u4").tobytes(), "<u4")


def pieces(n: int, longest: int = LONGEST) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens."""
    out = [(i * longest, longest) for i in range(n // longest)]
    at, rest = n // longest * longest, n % longest
    while rest:
        size = 1 << (rest.bit_length() - 1)
        out.append((at, size))
        at, rest = at + size, rest - size
    return out


def pack(docs: DataFrame, longest: int = LONGEST, tokenizer: str = TOKENIZER, end: int = END, digest: bool = False) -> DataFrame:
    """One row per piece. digest: ids_crc32 in place of ids."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")
    common.small_batches(docs.sparkSession)
    schema = SCHEMA.replace("ids array<int>", "ids_crc32 long") if digest else SCHEMA

    def run(batches):
        words = words_of(tokenizer)
        part, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = {k: [] for k in ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id")}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                ids = token_ids(text or b"", words, end)
                for start, size in pieces(len(ids), longest):
                    piece = ids[start : start + size]
                    for k, v in zip(out, (doc_id, start, size, zlib.crc32(piece.tobytes()) if digest else piece.astype(np.int32), len(ids), (size.bit_length() - 1) << 57 | part << 33 | made), strict=True):
                        out[k].append(v)
                    made += 1
                if len(out["ids"]) >= 20_000:
                    yield _rows(out, digest)
                    out = {k: [] for k in out}
            yield _rows(out, digest)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def _rows(out: dict[str, list], digest: bool) -> pa.RecordBatch:
    arrays = {k: pa.array(v, pa.int64()) for k, v in out.items() if k != "ids"}
    ids = pa.array(out["ids"], pa.int64() if digest else pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays(
        [arrays["doc_id"], arrays["start"], arrays["length"], ids, arrays["doc_tokens"], arrays["sequence_id"], pa.array(np.zeros(len(ids), np.int64))],
        ["doc_id", "start", "length", "ids_crc32" if digest else "ids", "doc_tokens", "sequence_id", "offset"],
    )
