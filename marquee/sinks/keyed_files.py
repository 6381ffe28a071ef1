"""One file for each key, as a data source: staged by tasks, put in place on commit, stale files pruned after it.

    spark.dataSource.register(KeyedFiles)
    rows.select("name", "body").write.format("keyed_files").mode("overwrite").option("suffix", ".ics").save(folder)

The folder must be one that the driver and all executors share. Names are paths below it; a row is one file, so a task holds one body at a
time. With option pieces, rows of one name that follow each other in a task are one file, written as they come. A job that fails leaves the
old files as they are. Mode overwrite prunes files with the suffix that the job didn't write; append doesn't.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

STAGING = "_staging"


@dataclass
class Written(WriterCommitMessage):
    folder: str


def _checked(name: str | None) -> str:
    clean = os.path.normpath(name or "")
    if not name or os.path.isabs(clean) or clean.split(os.sep)[0] in ("..", ".", STAGING):
        raise ValueError(f"not a file name below the folder: {name!r}")
    return clean


def _files(folder: str) -> Iterator[str]:
    for at, _, names in os.walk(folder):
        for name in names:
            yield os.path.relpath(os.path.join(at, name), folder)


class KeyedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "keyed_files"

    def schema(self) -> str:
        return "name string, body string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return KeyedFilesWriter(self.options["path"].removeprefix("file:"), self.options.get("suffix", ""), overwrite, uuid.uuid4().hex, self.options.get("pieces", "false").lower() == "true")


class KeyedFilesWriter(DataSourceWriter):
    def __init__(self, path: str, suffix: str, overwrite: bool, job: str, pieces: bool = False):
        self.path, self.suffix, self.overwrite, self.pieces = path, suffix, overwrite, pieces
        self.staging = os.path.join(path, STAGING, job)

    def write(self, iterator) -> Written:
        # every attempt has a folder of its own, so what a lost one left is never taken
        folder = os.path.join(self.staging, uuid.uuid4().hex)
        os.makedirs(folder)
        last = None
        for row in iterator:
            if row["body"] is None:
                continue
            more, last = self.pieces and row["name"] == last, row["name"]
            at = os.path.join(folder, _checked(row["name"]) + self.suffix)
            os.makedirs(os.path.dirname(at), exist_ok=True)
            with open(at, "a" if more else "x", encoding="utf-8", newline="") as f:
                f.write(row["body"])
        return Written(folder)

    def commit(self, messages) -> None:
        folders = [m.folder for m in messages if m is not None]
        written: set[str] = set()
        for folder in folders:
            for name in _files(folder):
                if name in written:
                    self.abort(messages)
                    raise ValueError(f"two rows for one file: {name}")
                written.add(name)
        for folder in folders:
            for name in list(_files(folder)):
                at = os.path.join(self.path, name)
                os.makedirs(os.path.dirname(at), exist_ok=True)
                os.replace(os.path.join(folder, name), at)
        shutil.rmtree(os.path.join(self.path, STAGING), ignore_errors=True)
        if self.overwrite:
            for name in list(_files(self.path)):
                if name.endswith(self.suffix) and name not in written:
                    os.remove(os.path.join(self.path, name))

    def abort(self, messages) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)
