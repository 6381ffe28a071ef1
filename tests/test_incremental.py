import os
import time

import pytest
from pyspark.sql import functions as F

from marquee.sinks.keyed_files import KeyedFiles
from marquee.sources import fresh
from marquee.streaming import reminders as R


def texts(folder):
    return {os.path.relpath(os.path.join(a, n), folder): open(os.path.join(a, n), "rb").read() for a, _, ns in os.walk(folder) for n in ns if not n.endswith(".crc")}


def test_files_are_replaced_and_pruned(spark, tmp_path):
    spark.dataSource.register(KeyedFiles)
    out = str(tmp_path / "out")
    write = lambda rows, mode="overwrite": spark.createDataFrame(rows, "name string, body string").repartition(3).write.format("keyed_files").mode(mode).option("suffix", ".ics").save(out)
    write([("a/one", "1\r\nx"), ("two", "ü"), ("gone", None)])
    assert texts(out) == {"a/one.ics": b"1\r\nx", "two.ics": "ü".encode()}
    os.makedirs(out, exist_ok=True)
    open(os.path.join(out, "note.txt"), "w").write("kept")
    first = texts(out)
    write([("a/one", "1\r\nx"), ("two", "ü")])
    assert texts(out) == first
    write([("three", "3")], "append")
    assert sorted(texts(out)) == ["a/one.ics", "note.txt", "three.ics", "two.ics"]
    write([("two", "new")])
    assert texts(out) == {"two.ics": b"new", "note.txt": b"kept"}


@pytest.mark.parametrize("bad", [[("two", "x"), ("../up", "y")], [("same", "x"), ("same", "y")], [("two", "x"), (None, "y")]])
def test_a_failed_job_leaves_the_old_files(spark, tmp_path, bad):
    spark.dataSource.register(KeyedFiles)
    out = str(tmp_path / "out")
    rows = lambda r: spark.createDataFrame(r, "name string, body string").repartition(2).write.format("keyed_files").mode("overwrite").save(out)
    rows([("two", "old"), ("one", "1")])
    with pytest.raises(Exception):  # noqa: B017
        rows(bad)
    assert texts(out) == {"two": b"old", "one": b"1"}
    assert not (tmp_path / "up").exists()


def test_only_changed_files_are_read(spark, tmp_path):
    folder, out = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    for i, name in enumerate("abc"):
        (folder / f"{name}.txt").write_text(name)
        os.utime(folder / f"{name}.txt", (1_700_000_000 + 100 * i,) * 2)
    inputs = fresh.listed(spark, str(folder), "*.txt")
    none = fresh.listed(spark, str(out))
    assert fresh.newer_than(inputs, none).count() == 3
    rows = spark.read.text(str(folder))
    assert fresh.fresh_rows(rows, none).count() == 3
    out.mkdir()
    (out / "done").write_text("x")
    os.utime(out / "done", (1_700_000_100,) * 2)
    done = fresh.listed(spark, str(out))
    assert [r.path[-5:] for r in fresh.newer_than(inputs, done).collect()] == ["c.txt"]
    assert [r.value for r in fresh.fresh_rows(rows, done).collect()] == ["c"]
    os.utime(folder / "a.txt", (1_700_000_900,) * 2)
    assert sorted(r.value for r in fresh.fresh_rows(spark.read.text(str(folder)), done).collect()) == ["a", "c"]


def test_units_done_this_week_are_skipped(spark):
    units = spark.createDataFrame([("a", "w1"), ("b", "w1"), ("b", "w1"), (None, "w1")], "source string, week string")
    done = spark.createDataFrame([("a", "w1"), ("b", "w0"), (None, "w1")], "source string, week string")
    assert sorted((tuple(r) for r in fresh.to_do(units, done, "source", "week").collect()), key=str) == [("b", "w1"), (None, "w1")]
    assert fresh.to_do(units, done, "source", "week", force=True).count() == 3
    assert fresh.to_do(units, done.limit(0), "source", "week").count() == 3


def test_times_and_digests():
    assert R.due_ms("2026-09-07T11:00:00") == R.due_ms("2026-09-07") + 2 * R.HOUR
    assert R.due_ms(None) is None and R.due_ms("soon") is None and R.due_ms("2026-13-01") is None
    assert [R.shown_time(x) for x in ("2026-09-07T00:05:00", "2026-09-07T13:30:00", "2026-09-07")] == ["12:05 AM", "1:30 PM", "Today"]
    assert R.digest_of([]) == ("Today's Events", "No bookmarked events today.")
    assert R.digest_of([("A", "2026-09-07T11:00:00", "Hall")]) == ("Today: A", "11:00 AM at Hall")
    title, body = R.digest_of([(c, "2026-09-07", "") for c in "ABCDE"])
    assert title == "Today's Events (5)" and body.split("\n") == ["• A (Today)", "• B (Today)", "• C (Today)", "+ 2 more coming up today"]


def test_reminders_fire_by_the_clock_of_the_stream(spark, tmp_path):
    import json

    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    source, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    source.mkdir()
    steps = [
        [(1, "2026-09-06 12:00:00", "save", 10, "Gig", "2026-09-07T11:00:00", None, "Hall"), (1, "2026-09-06 12:00:00", "save", 11, "Fair", "2026-09-07", "2026-09-08", ""), (2, "2026-09-06 12:00:00", "save", 12, "Talk", "2026-09-07T09:30:00", None, None), (2, "2026-09-06 12:00:00", "save", 13, "Old", "2020-01-01T09:30:00", None, None)],
        [(1, "2026-09-07 07:59:00", "tick", 0, None, None, None, None)],
        [(2, "2026-09-07 08:00:30", "unsave", 12, None, None, None, None)],
        [(9, "2026-09-07 10:30:00", "tick", 0, None, None, None, None)],
        [(9, "2026-09-08 09:00:00", "tick", 0, None, None, None, None)],
        [(9, "2026-09-10 09:00:00", "tick", 0, None, None, None, None)],
        [(9, "2026-09-10 09:00:01", "tick", 0, None, None, None, None)],
    ]
    names = ["user_id", "ts", "kind", "item", "title", "start", "end", "place"]
    schema = "user_id long, ts timestamp, kind string, item long, title string, start string, end string, place string"
    for i, rows in enumerate(steps):
        (source / f"{i}.json").write_text("\n".join(json.dumps(dict(zip(names, r, strict=True))) for r in rows))
        os.utime(source / f"{i}.json", (time.time() - 100 + i,) * 2)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(source))
    query = R.reminders(stream).writeStream.format("parquet").option("checkpointLocation", str(state)).option("path", str(out)).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    spark.conf.set(provider, before)
    got = sorted((r.user_id, r.kind, r.due, r.item, r.title) for r in spark.read.parquet(str(out)).withColumn("due", F.date_format("due", "dd HH:mm")).collect())
    assert got == sorted(
        [
            (1, "digest", "07 08:00", None, "Today's Events (2)"), (1, "reminder", "07 08:00", 11, "Fair"), (1, "reminder", "07 10:00", 10, "Gig"), (1, "digest", "08 08:00", None, "Today: Fair"),
        ]
    )
