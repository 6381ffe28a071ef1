"""Incremental state on Structured Streaming: taste profiles, windows, a ledger by upsert."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

CHANGE = "user_id long, key string, weight double"


def taste_stream(interactions: DataFrame) -> DataFrame:
    """Running weights of each user's keys. interactions: user_id, event_id, item, kind (like, dislike, share or undo), keys.

    A signal counts once per item and kind; undo takes back exactly what the item's signals had added."""

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        weights, seen = state.get if state.exists else ([], [])
        weights, seen = {k: w for k, w in weights}, {(i, kind): list(ks) for i, kind, ks in seen}
        touched = set()
        for frame in frames:
            for row in frame.sort_values("event_id").itertuples():
                kinds = ["like", "dislike", "share"] if row.kind == "undo" else [row.kind]
                for kind in kinds:
                    done = seen.pop((row.item, kind), None) if row.kind == "undo" else None
                    if row.kind != "undo" and (row.item, kind) in seen:
                        continue
                    keys = done if row.kind == "undo" else [k for k in row.keys if kind != "dislike" or k.startswith("tag:")]
                    if keys is None:
                        continue
                    if row.kind != "undo":
                        seen[(row.item, kind)] = list(keys)
                    sign = (-1.0 if kind == "dislike" else 1.0) * (-1.0 if row.kind == "undo" else 1.0)
                    for k in keys:
                        weights[k] = weights.get(k, 0.0) + sign
                        touched.add(k)
        state.update(([(k, w) for k, w in weights.items() if w], [(i, kind, ks) for (i, kind), ks in seen.items()]))
        out = sorted(touched)
        yield pd.DataFrame({"user_id": [key[0]] * len(out), "key": out, "weight": [weights[k] for k in out]})

    state = "weights array<struct<key: string, weight: double>>, seen array<struct<item: long, kind: string, keys: array<string>>>"
    return interactions.groupBy("user_id").applyInPandasWithState(step, CHANGE, state, "update", GroupStateTimeout.NoTimeout)


def windowed(events: DataFrame, length: str = "1 hour", late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """Counts and sums by event-time window, rows later than the watermark dropped (an addition of this engine)."""
    w = F.window("ts", length, slide) if slide else F.window("ts", length)
    out = events.withWatermark("ts", late).groupBy(w, "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("window_start"), "event_type", "n", "total")


def first_seen(events: DataFrame, key: str, late: str = "7 days") -> DataFrame:
    """Each key once within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def upsert(path: str, keys: list[str]):
    """A foreachBatch writer that replaces rows of the same keys; a batch that runs twice leaves the same table."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        try:
            versions = spark.read.parquet(f"{path}/*").select(F.max(F.col("_version"))).first()[0]
        except Exception as e:  # the first batch finds no table
            if "PATH_NOT_FOUND" not in str(e):
                raise
            versions = None
        if versions is not None and versions > number:
            return
        old = spark.read.parquet(f"{path}/{number - 1}").drop("_version") if versions is not None and number else batch.limit(0)
        new = old.join(batch.select(*keys).distinct(), keys, "left_anti").unionByName(batch)
        new.withColumn("_version", F.lit(number)).write.mode("overwrite").parquet(f"{path}/{number}")

    return write
