"""Long texts in parts: paragraphs packed under a limit, the densest parts, the densest window."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import model
from marquee.functions.dates import date_hits
from marquee.functions.listing import let

_HITS = [re.compile(p, re.ASCII) for p in model.DATE_HITS]


def split_batches(text: Column, most: int = 6000) -> Column:
    """Array of parts of a text: whole paragraphs, joined by an empty line, while a part stays within `most` characters.

    A paragraph longer than that is a part of its own. A text without a paragraph is one part, itself; null gives null.
    """
    paragraphs = F.filter(F.split(text, r"\n\s*\n"), lambda p: p.rlike(r"\S"))
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"))

    def add(s: Column, p: Column) -> Column:
        full = (s["now"] != "") & (F.length(s["now"]) + F.length(p) + 2 > most)
        joined = F.when(s["now"] == "", p).otherwise(F.concat(s["now"], F.lit("\n\n"), p))
        return F.struct(F.when(full, F.concat(s["done"], F.array(s["now"]))).otherwise(s["done"]).alias("done"), F.when(full, p).otherwise(joined).alias("now"))

    packed = F.aggregate(paragraphs, empty, add, lambda s: F.when(s["now"] == "", s["done"]).otherwise(F.concat(s["done"], F.array(s["now"]))))
    return let(packed, lambda p: F.when(F.size(p) > 0, p).otherwise(F.when(text.isNotNull(), F.array(text))))


def densest_batches(rows: DataFrame, text: str, key: str, most: int = 12_000, k: int = 3) -> DataFrame:
    """key, batch, hits, rank of each text's parts with the most dates, those without any left out; the earlier of equal ones first.

    Parts are ranked inside their row, so nothing is shuffled.
    """
    scored = F.transform(split_batches(F.col(text), most), lambda b, i: F.struct((-date_hits(b)).alias("less"), (i + 1).alias("batch")))
    best = F.slice(F.array_sort(F.filter(scored, lambda s: s["less"] < 0)), 1, k)
    return rows.select(key, F.posexplode(best).alias("at", "s")).select(key, F.col("s.batch").alias("batch"), (-F.col("s.less")).alias("hits"), (F.col("at") + 1).alias("rank"))


def window_of(text: str, size: int) -> tuple[int, int]:
    """Start and hits of the densest window, from the positions of all hits; the first of equally dense ones."""
    if len(text) <= size:
        return 0, sum(1 for p in _HITS for _ in p.finditer(text))
    step = max(1000, size // 4)
    starts = np.arange(0, len(text) - 1, step)
    spans = [np.array([m.span() for m in p.finditer(text)], np.int64).reshape(-1, 2) for p in _HITS]
    # of one pattern hits don't overlap, so both ends rise: those inside are a difference of ranks
    inside = lambda s, a: np.maximum(0, np.searchsorted(s[:, 1], a + size, "right") - np.searchsorted(s[:, 0], a, "left"))
    hits = sum(inside(s, starts) for s in spans)
    best = int(hits.argmax())
    start = int(starts[best])
    snap = text.find("\n\n", start)
    if snap >= 0 and snap - start < step and sum(int(inside(s, np.array([snap + 2]))[0]) for s in spans) >= hits[best]:
        start = snap + 2
    return start, int(hits[best])


def densest_window(size: int = 12_000):
    """Column function: struct of start and hits of the window of `size` characters that holds the most whole dates.

    Windows start every quarter of the size, 1000 characters at least, and are moved on to a paragraph's start where that loses no hit. Null has none.
    """

    @F.pandas_udf("start int, hits int")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([window_of(t or "", size) for t in batch], columns=["start", "hits"])

    return run


def split_by_size(rows: DataFrame, by: str, part: str, size: Column, limit: int) -> DataFrame:
    """by, part, rows, bytes of the files to write: one for each `by`, part null, or one for each part of those over the limit.

    Sizes are summed by part first, so one large `by` is no hot key; a null part of a split one is a file too.
    """
    sums = rows.groupBy(by, part).agg(F.count(F.lit(1)).alias("rows"), F.sum(size).cast("long").alias("bytes"))
    whole = sums.groupBy(by).agg(F.sum("bytes").alias("_total"))
    large = sums.join(whole, sums[by].eqNullSafe(whole[by])).drop(whole[by]).withColumn("_split", F.col("_total") > limit)
    return large.groupBy(by, F.when(F.col("_split"), F.coalesce(F.col(part), F.lit(""))).alias(part)).agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
