"""Dates as pages write them, day first: `Fri 3 October 2026, 7pm`, `3-5 Oct`, `until 5 Oct`, `tomorrow 8.30pm`, `Thu 3`.

What repeats (`every Friday`, `Fridays`, `weekly`) or names no day is no date: null rather than a guess. A year that is not
given is the one that puts the date nearest after the reference day, up to two months before it being still this year.
"""

from __future__ import annotations

import re
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of months and days by their first three letters.
MONTHS = {m: i + 1 for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}
DAYS = {d: i for i, d in enumerate("mon tue wed thu fri sat sun".split())}
MONTH = r"(?P<month>jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?"
DAY = r"(?P<day>\d{1,2})(?:st|nd|rd|th)?"
YEAR = r"(?:,?\s+(?P<year>\d{4}))?"
REPEATS = re.compile(r"\b(every|each|weekly|fortnightly|monthly|daily|(?:mon|tues|wednes|thurs|fri|satur|sun)days)\b", re.I)
FORMS = [
    re.compile(r"\b(?P<year>\d{4})-(?P<m>\d{2})-(?P<day>\d{2})\b"),
    re.compile(r"\b(?P<day>\d{1,2})/(?P<m>\d{1,2})/(?P<year>\d{4}|\d{2})\b"),
    re.compile(rf"\b{DAY}\s+(?:of\s+)?{MONTH}{YEAR}\b", re.I),
    re.compile(rf"\b{MONTH}\s+{DAY}\b(?!:){YEAR}", re.I),
]
WEEKDAY = re.compile(r"\b(?P<next>next\s+)?(?P<name>mon|tue|wed|thu|fri|sat|sun)[a-z]*\b\.?(?:\s+(?P<day>\d{1,2})(?:st|nd|rd|th)?\b(?!\s*[:.]\d|\s*[ap]m))?", re.I)
CLOCK = re.compile(r"\b(?P<h>\d{1,2})(?:[:.](?P<min>\d{2}))?\s*(?P<half>[ap])\.?m\b|\b(?P<h24>[01]?\d|2[0-3]):(?P<m24>[0-5]\d)\b|\b(?P<word>noon|midday|midnight)\b", re.I)
RANGE = re.compile(rf"\b(?P<first>\d{{1,2}})(?:st|nd|rd|th)?(?:\s+(?P<month1>[a-z]{{3,9}}))?\s*(?:-|–|—|to)\s*{DAY}\s+{MONTH}{YEAR}\b", re.I)


def _made(y: int, m: int, d: int) -> date | None:
    try:
        return date(y, m, d)
    except ValueError:
        return None


def _near(m: int, d: int, ref: date) -> date | None:
    now = _made(ref.year, m, d)
    return now if now and now >= ref - timedelta(days=61) else _made(ref.year + 1, m, d) or now


def _of(match: re.Match, ref: date) -> date | None:
    g = match.groupdict()
    m = int(g["m"]) if g.get("m") else MONTHS[g["month"][:3].lower()]
    if g.get("year"):
        y = int(g["year"])
        return _made(y + 2000 if y < 100 else y, m, int(g["day"]))
    return _near(m, int(g["day"]), ref)


def _clock(text: str) -> str:
    t = CLOCK.search(text)
    if not t:
        return ""
    if t["word"]:
        return "T00:00:00" if t["word"].lower() == "midnight" else "T12:00:00"
    if t["h24"]:
        return f"T{int(t['h24']):02d}:{t['m24']}:00"
    h = int(t["h"])
    if not 1 <= h <= 12:
        return ""
    return f"T{h % 12 + 12 * (t['half'].lower() == 'p'):02d}:{t['min'] or '00'}:00"


def _day(text: str, ref: date) -> date | None:
    for form in FORMS:
        if (m := form.search(text)) and (found := _of(m, ref)):
            return found
    lower = text.lower()
    for word, days in (("today", 0), ("tonight", 0), ("tomorrow", 1)):
        if re.search(rf"\b{word}\b", lower):
            return ref + timedelta(days=days)
    w = WEEKDAY.search(text)
    if not w:
        return None
    n = DAYS[w["name"].lower()]
    if w["day"]:  # `Thu 3`: the next third of a month that is a Thursday
        for i in range(92):
            d = ref + timedelta(days=i)
            if d.day == int(w["day"]) and d.weekday() == n:
                return d
        return None
    ahead = (n - ref.weekday()) % 7
    return ref + timedelta(days=ahead or 7 if w["next"] else ahead)


def parse(text: str | None, ref: date) -> tuple[str | None, str | None]:
    """(start, end) as ISO text, null where the text doesn't say."""
    text = (text or "").strip()
    if not text or REPEATS.search(text):
        return None, None
    until = re.match(r"(?i)^(?:on\s+now\s+)?(?:until|till|ends)\s+(.*)$", text)
    if until:
        end = _day(until[1], ref)
        return (ref.isoformat(), end.isoformat()) if end and end >= ref else (None, None)
    if r := RANGE.search(text):
        end = _of(r, ref)
        m1 = MONTHS.get((r["month1"] or "")[:3].lower()) if r["month1"] else end and end.month
        if end and m1:
            start = _made(end.year - (m1 > end.month), m1, int(r["first"]))
            if start and start <= end:
                return start.isoformat() + _clock(text), end.isoformat()
    day = _day(text, ref)
    return (day.isoformat() + _clock(text), None) if day else (None, None)


def column(ref: date):
    """A pandas UDF: text to struct(start, end)."""

    @F.pandas_udf(T.StructType([T.StructField("start", T.StringType()), T.StructField("end", T.StringType())]))
    def spoken(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse(t, ref) for t in texts], columns=["start", "end"], dtype="object")

    return spoken
