"""Week layout: the hours of timed listings, and first-fit rows for listings that cover days.

First fit is order-dependent, but of its order only the span matters: bars go in by first day, last day and ord, so all bars of one span
take the lowest free rows in turn. A fold over the counts of a group's spans, a few dozen for a week, therefore tells the rows of every bar;
the bars themselves are never gathered. A bar's number within its span comes from blocks of ord, so no span is sorted in one task.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from marquee.functions import dates as D
from marquee.functions import listing as L

# The hours that a week shows at least.
FIRST_HOUR, LAST_HOUR = 8, 23
#: Values of ord in one block; an ord that is a running number puts no more bars in it.
BLOCK = 1 << 16


def first_fit(counts: list[tuple]) -> list[tuple]:
    """(first, last, nth, lane, n): bars nth to nth + n - 1 of a span lie in lanes lane to lane + n - 1. counts: (first, last, bars), in order."""
    taken: list[list] = []  # runs of lanes that end on one day: lanes, end
    out = []
    for first, last, left in counts:
        nth = lane = 0
        runs: list[list] = []
        for lanes, end in taken:
            use = min(left, lanes) if end < first else 0
            if use:
                out.append((first, last, nth, lane, use))
            runs += [[use, last], [lanes - use, end]]
            nth, left, lane = nth + use, left - use, lane + lanes
        if left:
            out.append((first, last, nth, lane, left))
        taken = []
        for lanes, end in [*runs, [left, last]]:
            if taken and taken[-1][1] == end:
                taken[-1][0] += lanes
            elif lanes:
                taken.append([lanes, end])
    return out


def pack_lanes(spans: DataFrame, by: str, block: int = BLOCK) -> DataFrame:
    """Adds lane (from 0), the lowest row that is free from a span's first day on, in order of first, last and ord.

    spans: `by`, ord (whole, no two alike in a group), first, last; further columns stay, but not any named lane. Spans without a first or
    last day have no lane. An empty table gives an empty one."""
    spans = spans.drop("lane").withColumn("_block", F.floor(F.col("ord") / block))
    whole = spans.filter("first IS NOT NULL AND last IS NOT NULL")
    sizes = whole.groupBy(by, "first", "last", "_block").agg(F.count(F.lit(1)).alias("_n"))
    span = Window.partitionBy(by, "first", "last").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(span), F.lit(0)))
    counts = whole.groupBy(by, "first", "last").agg(F.count(F.lit(1)).alias("_bars"))
    run = T.StructType().add(by, spans.schema[by].dataType).add("first", spans.schema["first"].dataType).add("last", spans.schema["last"].dataType)

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["first", "last"])
        rows = first_fit(list(zip(frame["first"], frame["last"], frame["_bars"], strict=True)))
        return pd.DataFrame([(frame[by].iloc[0], *r) for r in rows], columns=[by, "first", "last", "nth", "lane", "n"])

    runs = counts.groupBy(by).applyInPandas(fold, T.StructType([*run.fields, *(T.StructField(c, T.LongType()) for c in ("nth", "lane", "n"))]))
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (by, "first", "last")]
    meet = (F.col("r.nth") < F.col("s._before") + F.col("s._n")) & (F.col("s._before") < F.col("r.nth") + F.col("r.n"))
    placed = sizes.alias("s").join(runs.alias("r"), same[0] & same[1] & same[2] & meet)
    placed = placed.groupBy(*(F.col(f"s.{c}").alias(f"_{c}") for c in (by, "first", "last", "_block"))).agg(F.first("s._before").alias("_before"), F.collect_list(F.struct("r.nth", "r.lane", "r.n")).alias("_runs"))
    nth = F.row_number().over(Window.partitionBy(by, "first", "last", "_block").orderBy("ord")) - 1
    bars = spans.withColumn("_nth", nth)
    bars = bars.join(placed, F.col(by).eqNullSafe(F.col(f"_{by}")) & (F.col("first") == F.col("_first")) & (F.col("last") == F.col("_last")) & (F.col("_block") == F.col("__block")), "left")
    at = F.col("_before") + F.col("_nth")
    mine = F.get(F.filter("_runs", lambda r: (r["nth"] <= at) & (at < r["nth"] + r["n"])), 0)
    return bars.select(*(c for c in spans.columns if c != "_block"), (mine["lane"] + at - mine["nth"]).cast("int").alias("lane"))


def _run(start, end):
    """Whether a listing goes on past its first day."""
    return F.coalesce((L.day(start) != "") & (L.day(end) > L.day(start)), F.lit(False))


def timed_slots(events: DataFrame, week_start: str, by: str = "city_key") -> DataFrame:
    """by, ord, day, minutes, first_hour, last_hour, percent of listings that have a time and one day, in the seven days from week_start.

    The hours are the group's: eight to eleven at night, wider where a listing needs it. A lane's order is that of minutes, then ord."""
    start, end = F.col("datetime_iso"), F.col("datetime_end_iso")
    day, minutes = L.day(start), D.start_minutes(start)
    slots = events.select(by, "ord", day.alias("day"), minutes.alias("minutes"), _run(start, end).alias("_run")).filter("NOT _run AND minutes IS NOT NULL")
    slots = slots.filter(F.col("day").between(week_start, F.date_format(F.date_add(F.lit(week_start).cast("date"), 6), "yyyy-MM-dd"))).drop("_run")
    hour = F.floor(F.col("minutes") / 60).cast("int")
    hours = slots.groupBy(by).agg(F.least(F.lit(FIRST_HOUR), F.min(hour)).alias("first_hour"), F.least(F.lit(24), F.greatest(F.lit(LAST_HOUR), F.max(hour) + 1)).alias("last_hour"))
    mine = hours.withColumnRenamed(by, "_by")
    joined = slots.join(mine, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")
    return joined.withColumn("percent", D.lane_percent(F.col("minutes"), F.col("first_hour"), F.col("last_hour")))


def day_bars(events: DataFrame, week_start: str, by: str = "city_key", block: int = BLOCK) -> DataFrame:
    """by, ord, start_col, end_col, lane of listings that cover days of the week from week_start without being a timed slot.

    Columns are lines of a grid whose first column is the hours, so the first day starts at 2 and the last ends at 9; lanes count from 1."""
    start, end = F.col("datetime_iso"), F.col("datetime_end_iso")
    last_day = F.date_format(F.date_add(F.lit(week_start).cast("date"), 6), "yyyy-MM-dd")
    first, last = L.day(start), F.coalesce(L.day(end), L.day(start))
    slot = D.start_minutes(start).isNotNull() & ~_run(start, end)
    rows = events.filter(~F.coalesce(slot, F.lit(False)) & (first <= last_day) & (last >= week_start))
    index = lambda d: F.date_diff(d.cast("date"), F.lit(week_start).cast("date"))
    a = index(F.greatest(first, F.lit(week_start)))
    spans = rows.select(by, "ord", a.alias("first"), F.greatest(a, index(F.least(last, last_day))).alias("last"))
    return pack_lanes(spans, by, block).select(by, "ord", (F.col("first") + 2).alias("start_col"), (F.col("last") + 3).alias("end_col"), (F.col("lane") + 1).alias("lane"))
