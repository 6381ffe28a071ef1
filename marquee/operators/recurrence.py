"""Recurrence sets: rules unrolled in their row, RDATE added, EXDATE taken away, single instances replaced by RECURRENCE-ID.

Times are wall clock (timestamp_ntz); a zone, where there is one, is applied to what comes out. A rule's periods are numbered from
its start; without COUNT those that end before the window are skipped by arithmetic, so a long daily series costs what the window holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import listing as L

#: Periods of one rule at most, and days that are unrolled ahead.
STEPS, AHEAD = 5000, 60
DAYS = ("MO", "TU", "WE", "TH", "FR", "SA", "SU")


def _weekday(code: Column) -> Column:
    """0 for MO to 6 for SU of a BYDAY code, with or without an ordinal; null for others."""
    return F.nullif(F.array_position(F.array(*map(F.lit, DAYS)), F.upper(F.substring(code, -2, 2))), F.lit(0)).cast("int") - 1


def _ordinal(code: Column) -> Column:
    return F.regexp_extract(code, r"^([+-]?\d+)", 1).try_cast("int")


def _in_month(first: Column, code: Column) -> Column:
    """The days of a month that a BYDAY code names: all such weekdays, or the nth from its start or end."""
    last = F.last_day(first)
    start = F.date_add(first, F.pmod(_weekday(code) - F.weekday(first), F.lit(7)))
    every = F.filter(F.transform(F.sequence(F.lit(0), F.lit(4)), lambda k: F.date_add(start, k * 7)), lambda d: d <= last)
    n = _ordinal(code)
    return F.when(n.isNull(), every).otherwise(F.filter(F.array(F.get(every, F.when(n > 0, n - 1).otherwise(F.size(every) + n))), lambda d: d.isNotNull()))


def _days(freq: Column, start: Column, i: Column, step: Column, byday: Column, bymonthday: Column) -> Column:
    """The days of period i of a rule that begins on the day start."""
    named = F.coalesce(F.size(byday) > 0, F.lit(False))
    day = F.date_add(start, i * step)
    daily = F.when(~named | F.exists(byday, lambda c: _weekday(c) == F.weekday(day)), F.array(day)).otherwise(F.array().cast("array<date>"))
    monday = F.date_add(F.date_sub(start, F.weekday(start)), i * step * 7)
    weekly = F.when(named, F.transform(byday, lambda c: F.date_add(monday, _weekday(c)))).otherwise(F.array(F.date_add(monday, F.weekday(start))))

    def of_month(first: Column) -> Column:
        last = F.dayofmonth(F.last_day(first))
        numbers = F.when(F.coalesce(F.size(bymonthday) > 0, F.lit(False)), bymonthday).otherwise(F.array(F.dayofmonth(start)))
        real = F.filter(F.transform(numbers, lambda d: F.when(d < 0, last + d + 1).otherwise(d)), lambda d: d.between(1, last))
        return F.when(named, F.flatten(F.transform(byday, lambda c: _in_month(first, c)))).otherwise(F.transform(real, lambda d: F.date_add(first, (d - 1).cast("int"))))

    month = F.trunc(start, "month")
    return F.when(freq == "DAILY", daily).when(freq == "WEEKLY", weekly).when(freq == "MONTHLY", of_month(F.add_months(month, i * step).cast("date"))).otherwise(of_month(F.add_months(month, i * step * 12).cast("date")))


def instances(low: Column, high: Column) -> Column:
    """Array of the starts of a series from low to high, in order: the rule's own with COUNT and UNTIL, and RDATE, without EXDATE.

    Columns: start, freq (null or another than DAILY, WEEKLY, MONTHLY, YEARLY: no rule), step, count, until, byday, bymonthday, rdates,
    exdates. A series without rule or RDATE is its start, in the window or not; UNTIL belongs to the rule.
    """
    c = F.col
    start, rule = F.to_date("start"), F.coalesce(c("freq").isin("DAILY", "WEEKLY", "MONTHLY", "YEARLY"), F.lit(False))
    step = F.greatest(F.coalesce("step", F.lit(1)), F.lit(1))
    length = F.when(c("freq") == "DAILY", 1).when(c("freq") == "WEEKLY", 7).when(c("freq") == "MONTHLY", 31).otherwise(366) * step
    shortest = F.when(c("freq") == "DAILY", 1).when(c("freq") == "WEEKLY", 7).when(c("freq") == "MONTHLY", 28).otherwise(365) * step
    named = F.coalesce(F.size("byday") > 0, F.lit(False))
    often = c("freq").isin("DAILY", "WEEKLY")
    # days and weeks that name no weekday give one instance a period, so COUNT is an end; weeks that name some give one at least, all but the first
    counted, clock = c("count").isNotNull(), c("start").cast("timestamp_ntz") - start.cast("timestamp_ntz")
    plain = counted & often & ~named
    ahead = (F.greatest(c("count"), F.lit(0)).cast("long") - 1) * step * F.when(c("freq") == "DAILY", 1).otherwise(7)
    ahead = F.least(ahead, F.greatest(F.date_diff(F.to_date(high), start), F.lit(0)).cast("long") + 1).cast("int")
    last = F.when(plain, F.date_add(start, ahead).cast("timestamp_ntz") + clock)
    full = counted & (c("freq") == "WEEKLY") & F.exists("byday", lambda x: _weekday(x).isNotNull())
    open_ = plain | ~counted
    skipped = F.when(open_, F.greatest(F.lit(0), F.floor(F.date_diff(F.to_date(low), start) / length).cast("int") - 1)).otherwise(F.lit(0))
    end = F.least(high, F.coalesce("until", high), last)
    most = F.least(F.lit(STEPS - 1), F.floor(F.date_diff(F.to_date(end), start) / shortest).cast("int") + 1)
    most = F.when(full, F.least(most, F.greatest(c("count"), F.lit(0)))).otherwise(most)
    periods = F.when(most >= skipped, F.sequence(skipped, F.greatest(most, skipped))).otherwise(F.array().cast("array<int>"))
    days = lambda v: F.flatten(F.transform(periods, lambda i: F.array_sort(F.array_distinct(_days(c("freq"), v["day"], i, v["step"], c("byday"), c("bymonthday"))))))
    times = lambda v: F.filter(F.transform(days(v), lambda d: d.cast("timestamp_ntz") + v["clock"]), lambda t: (t >= c("start")) & (t <= v["end"]))
    # what all periods share is computed once a row
    times = L.let(F.struct(start.alias("day"), step.alias("step"), clock.alias("clock"), end.alias("end")), times)
    # named once each: what is named twice is planned and unrolled twice
    ruled = F.slice(times, F.lit(1), F.when(open_, 1 << 30).otherwise(F.greatest(c("count"), F.lit(0))))
    none = F.array().cast("array<timestamp_ntz>")
    rdates, exdates = F.coalesce("rdates", none), F.coalesce("exdates", none)
    first = F.when(rule, ruled).otherwise(F.array(c("start")))
    several = F.filter(F.array_union(first, rdates), lambda t: t.between(low, high))
    return F.array_sort(F.array_except(F.when(rule | (F.size(rdates) > 0), several).otherwise(F.array(c("start"))), exdates))


def expand(series: DataFrame, overrides: DataFrame | None, window_start: str, window_end: str) -> DataFrame:
    """uid, recurrence_id, start, end of every instance of the series in the window.

    series: uid (unique), start, end and the columns of `instances`. overrides: uid, recurrence_id, start, end, each standing for the instance that
    would have begun at recurrence_id; those of no instance count for nothing, and of several for one instance the latest start wins. Whether an
    instance is in the window is judged by the time it replaces; with a column zone the window is in UTC, else wall clock. Series without a start give nothing; the end keeps the first instance's length.
    """
    edge = lambda t: F.lit(t).cast("timestamp_ntz")
    if "zone" in series.columns:
        edge = lambda t: F.coalesce(F.convert_timezone(F.lit("UTC"), F.col("zone"), F.lit(t).cast("timestamp_ntz")), F.lit(t).cast("timestamp_ntz"))
    rows = series.filter("start is not null").select("uid", F.explode(instances(edge(window_start), edge(window_end))).alias("recurrence_id"), (F.col("end") - F.col("start")).alias("_length"))
    rows = rows.select("uid", "recurrence_id", F.col("recurrence_id").alias("start"), (F.col("recurrence_id") + F.col("_length")).alias("end"))
    if overrides is None:
        return rows
    moved = overrides.groupBy("uid", "recurrence_id").agg(F.max(F.struct("start", "end")).alias("_moved"))
    pick = lambda name: F.when(F.col("_moved").isNotNull(), F.col(f"_moved.{name}")).otherwise(F.col(name)).alias(name)
    return rows.join(moved, ["uid", "recurrence_id"], "left").select("uid", "recurrence_id", pick("start"), pick("end"))


def raw_time(time: Column, zone: Column) -> Column:
    """Wall clock text where no zone is known, else the instant in UTC."""
    text = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")
    instant = F.date_format(F.convert_timezone(zone, F.lit("UTC"), time), "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(zone.isNull(), text).otherwise(F.concat(instant, F.lit(".000Z")))
