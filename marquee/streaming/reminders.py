"""Reminders and morning digests as event-time timers: one hour before a saved event, 08:00 for one without a time, one digest a day."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

NOTICE = "user_id long, kind string, due timestamp, item long, title string, body string"
_ITEM = StructType([StructField("item", LongType())])
_SAVED = StructType([StructField("title", StringType()), StructField("start", StringType()), StructField("end", StringType()), StructField("place", StringType())])
_AT = StructType([StructField("ms", LongType())])
SHOWN = 3
HOUR = 3_600_000


def _naive_ms(text: str) -> int | None:
    try:
        return int(datetime.fromisoformat(text).replace(tzinfo=UTC).timestamp() * 1000)
    except ValueError:
        return None


def due_ms(start: str | None) -> int | None:
    """When to remind of a start: an hour before it, or at 08:00 of a day; null if it is neither."""
    if not start:
        return None
    if "T" in start:
        at = _naive_ms(start)
        return None if at is None else at - HOUR
    at = _naive_ms(start) if len(start) == 10 else None
    return None if at is None else at + 8 * HOUR


def shown_time(start: str) -> str:
    """11:00 AM; Today for a day without a time."""
    if "T" not in start:
        return "Today"
    at = datetime.fromisoformat(start)
    return f"{at.hour % 12 or 12}:{at.minute:02d} {'PM' if at.hour >= 12 else 'AM'}"


def digest_of(events: list[tuple[str, str, str]]) -> tuple[str, str]:
    """Title and body of a digest of (title, start, place)."""
    if not events:
        return "Today's Events", "No bookmarked events today."
    if len(events) == 1:
        title, start, place = events[0]
        return f"Today: {title}", shown_time(start) + (f" at {place}" if place else "")
    lines = [f"• {title} ({shown_time(start)})" for title, start, _ in events[:SHOWN]]
    if len(events) > SHOWN:
        lines.append(f"+ {len(events) - SHOWN} more coming up today")
    return f"Today's Events ({len(events)})", "\n".join(lines)


class Reminders(StatefulProcessor):
    """State of one user: what is saved, and when the next digest is due. Timers carry the rest."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.saved = handle.getMapState("saved", _ITEM, _SAVED)
        self.digest = handle.getValueState("digest", _AT)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        for frame in rows:
            for row in frame.sort_values("ts", kind="stable").itertuples():
                now = max(now, int(row.ts.timestamp() * 1000))
                old = self.saved.getValue((row.item,)) if self.saved.containsKey((row.item,)) else None
                if row.kind == "unsave":
                    if old is not None:
                        self.saved.removeKey((row.item,))
                elif row.kind == "save" and row.start:
                    self.saved.updateValue((row.item,), (row.title or "", row.start, row.end or row.start, row.place or ""))
                    at = due_ms(row.start)
                    if at is not None and at > now:
                        self.handle.registerTimer(at)
        self._next_digest(now)
        yield pd.DataFrame()

    def _next_digest(self, now: int) -> None:
        """A timer for 08:00 of the first day after now that something saved falls on, unless one is set for as early a day."""
        days = []
        for _, (_, start, end, _) in self.saved.iterator():
            first, last = _naive_ms(start[:10]), _naive_ms(end[:10])
            if first is None or last is None:
                continue
            at = first + 8 * HOUR
            if at <= now:
                at += ((now - at) // (24 * HOUR) + 1) * 24 * HOUR
            if at <= last + 8 * HOUR:
                days.append(at)
        due = min(days, default=None)
        known = self.digest.get()[0] if self.digest.exists() else None
        if known is not None and known != due and known > now:
            self.handle.deleteTimer(known + 1)
            known = None
        if due is not None and due != known:
            # a millisecond later than reminders, so that a digest has a timer of its own
            self.handle.registerTimer(due + 1)
            self.digest.update((due,))
        elif due is None and self.digest.exists():
            self.digest.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        out = []
        saved = sorted((item[0], *value) for item, value in self.saved.iterator())
        if self.digest.exists() and self.digest.get()[0] + 1 == at:
            due = at - 1
            day = datetime.fromtimestamp(due / 1000, UTC).strftime("%Y-%m-%d")
            today = [(t, s, p) for _, t, s, e, p in saved if s[:10] <= day <= e[:10]]
            if today:
                title, body = digest_of(today)
                out.append((key[0], "digest", due, None, title, body))
            self._next_digest(due)
        for item, title, start, _, place in saved:
            if due_ms(start) == at:
                out.append((key[0], "reminder", at, item, title, shown_time(start) + (f" at {place}" if place else "")))
        frame = pd.DataFrame(out, columns=["user_id", "kind", "due", "item", "title", "body"])
        frame["due"] = pd.to_datetime(frame["due"], unit="ms")
        frame["item"] = frame["item"].astype("Int64")
        yield frame

    def close(self) -> None:
        pass


def reminders(saves: DataFrame, late: str = "0 seconds") -> DataFrame:
    """Notices (NOTICE) of a stream of user_id, ts, kind (save or unsave; others only move the clock), item, title, start, end, place.

    The stream's watermark is the clock. A start in the past gets no reminder; one that is changed or unsaved before its time neither. Each day
    at 08:00 one digest names what falls on it, and none where nothing does; rows count before the timers of their batch. Needs the RocksDB state store.
    """
    return saves.withWatermark("ts", late).groupBy("user_id").transformWithStateInPandas(statefulProcessor=Reminders(), outputStructType=NOTICE, outputMode="Append", timeMode="EventTime")
