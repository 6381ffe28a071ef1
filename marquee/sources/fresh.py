"""Only what is new: files changed since an output was written, and units of work not yet done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def listed(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """path, changed, size of the files below a folder; nothing is read of them. A folder that isn't there has none."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        files = reader.load(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "path string, changed timestamp, size long")
    return files.select("path", F.col("modificationTime").alias("changed"), F.col("length").alias("size"))


def newer_than(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """The listed inputs that changed after the newest output, all if there is none. A file as old as the output is done."""
    last = outputs.agg(F.max("changed").alias("last"))
    return inputs.join(F.broadcast(last), F.col("last").isNull() | (F.col("changed") > F.col("last"))).drop("last")


def fresh_rows(rows: DataFrame, outputs: DataFrame) -> DataFrame:
    """Rows of a file source whose file changed after the newest output: whole files are left out by their metadata."""
    last = outputs.agg(F.max("changed").alias("last")).first()["last"]
    return rows if last is None else rows.filter(F.col("_metadata.file_modification_time") > F.lit(last))


def to_do(units: DataFrame, done: DataFrame, *keys: str, force: bool = False) -> DataFrame:
    """The units (keys such as source and week) that aren't done yet, each once; all if forced. Null keys are never done."""
    units = units.dropDuplicates(list(keys))
    return units if force else units.join(done.select(*keys).distinct(), list(keys), "left_anti")
