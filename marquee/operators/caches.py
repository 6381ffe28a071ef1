"""Answers kept by content: a table of digest, version and answer, asked by a join, added to without repeating."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def digest(version: str, text: Column) -> Column:
    """The key of a question: the version of whoever answers and the whole text. Null has none."""
    return F.sha1(F.concat(F.lit(version + "\n"), text))


def asked(rows: DataFrame, text: str, store: DataFrame, version: str) -> tuple[DataFrame, DataFrame]:
    """(hits, misses): rows with the answer that is stored, and the distinct questions (digest, text) without one.

    store: digest, version, answer, the answer null or not; of another version it is no answer. Rows with a null text are in neither. Equal
    texts ask once. An empty answer is an answer. Two entries of one digest count as one, the lesser answer.
    """
    keyed = rows.filter(F.col(text).isNotNull()).withColumn("digest", digest(version, F.col(text)))
    known = store.filter(F.col("version") == version).groupBy("digest").agg(F.min("answer").alias("answer"))
    hits = keyed.join(known, "digest")
    misses = keyed.join(known.select("digest"), "digest", "left_anti").groupBy("digest").agg(F.min(text).alias("text"))
    return hits, misses


def added(store: DataFrame, answers: DataFrame, version: str) -> DataFrame:
    """The store with new answers (digest, answer): what is there stays, so the same answers added twice change nothing."""
    new = answers.groupBy("digest").agg(F.min("answer").alias("answer")).select("digest", F.lit(version).alias("version"), "answer")
    return store.unionByName(new.join(store.select("digest", "version"), ["digest", "version"], "left_anti").select(*store.columns))


def commit(store_path: str, answers: DataFrame, version: str) -> None:
    """Appends to a Parquet store what it doesn't have. A task or job that is repeated adds nothing twice; readers see whole files only."""
    spark = answers.sparkSession
    try:
        store = spark.read.schema("digest string, version string, answer string").parquet(store_path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        store = spark.createDataFrame([], "digest string, version string, answer string")
    new = answers.groupBy("digest").agg(F.min("answer").alias("answer")).select("digest", F.lit(version).alias("version"), "answer")
    new.join(store.select("digest", "version"), ["digest", "version"], "left_anti").write.mode("append").parquet(store_path)
