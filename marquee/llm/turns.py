"""Conversation structure repair: damaged conversations and the cheapest edits that mend them, by a retained-subsequence DP.

`damage` drops, empties, repeats and reroles turns by a hash of conversation and turn. `repair` looks for faults and for the
cheapest list of edits (keep, rerole, delete, insert) after which the roles are an optional system turn and pairs of user
and assistant.

The DP chooses the turns that are retained, kept or with another role. Between two retained turns all others are deleted,
so a gap costs the difference of prefix deletion sums, and the pair of roles alone says how many turns are inserted. For
each role of the last retained turn only the running minimum matters: four values a conversation. Audits break ties: of
two lists with equal cost the ASCII-least stays. Lists that used up the same turns are never prefixes of each other unless
equal, so their ranks among the four say all and no strings are compared. Conversations advance together, as numpy columns.

Conversations of up to LONG rows are grouped by Spark, whole. Longer ones, counted first, are sorted over all tasks and cut
into segments of at most SEGMENT rows: each segment gives cost and rank from every role it may be entered with to every
role it may be left with; those of a conversation are chained (64 numbers a segment), and the segments then write down
their own piece of the edits. Repeated turns are found by grouping, salted. Only the audit and the digest, which the result
asks for as one value, run through one task, as a stream of segments.

Cases: rows of a conversation are ordered by turn (nulls first), role, text. A null role or text is one space, so it is
blank or must get another role; a null turn counts in no gap; a null conv_id is a conversation of its own. A row with several
faults counts for the first: blank, duplicate, truncated. Repeated rows are duplicates. An empty table gives no rows; one
without rows after damage gives zeros, an empty audit and the digest of nothing. Gaps over 2 ** 63 - 1 stop there. Further
columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import cut, small_batches, times, with_table

LONG = 2000
SEGMENT = 512
TOGETHER = 4096

BLANKS = " \t\n\v\f\r"
STATES = ["", "system", "user", "assistant"]
EDITS = ["D", "IK", "IR", "K", "R"]
DELETE, KEEP_AFTER, REROLE_AFTER, KEEP, REROLE = range(5)
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"

_NEVER = 1 << 40
#: Inserts between a retained turn in one state and one in another, -1 where no inserts help: a system turn comes first or not at all.
_INSERTS = np.array([[-1, 0, 0, 1], [-1, -1, 0, 1], [-1, -1, 1, 0], [-1, -1, 0, 1]])
#: Inserts that end a conversation.
_ENDING = np.array([0, 2, 1, 0])
_LEGAL = {"su", "ua", "au"}


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, there); dropped rows stay with there = false, so that their conversation isn't lost."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"), spaced("text").alias("text"), (F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn"))) % 20).alias("hit"))
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("hit") != 0).alias("there"), F.when(F.col("hit") == 3, 2).otherwise(1).alias("copies"))
    return times(rows, F.col("copies")).drop("copies")


def _with_faults(rows: DataFrame) -> DataFrame:
    solid = F.rtrim(F.col("text"), F.lit(BLANKS))
    last = F.substring(solid, -1, 1)
    return rows.select("conv_id", "turn", "role", "text", "there", (solid == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))


def repair(rows: DataFrame, long: int = LONG, segment: int = SEGMENT) -> DataFrame:
    """One row (RESULT) for each conversation of rows as `damage` returns them."""
    small_batches(rows.sparkSession, 2000)
    rows = _with_faults(rows)
    crowded = cut(rows.groupBy("conv_id").agg(F.count("*").alias("_rows")).filter(F.col("_rows") > long).select("conv_id", F.lit(True).alias("_long")))
    if crowded.isEmpty():
        return _whole(rows)
    marked = with_table(rows, crowded, ["conv_id"])
    return _whole(marked.filter("_long is null").drop("_long")).unionByName(_segmented(marked.filter("_long").drop("_long"), segment))


def steps(start: np.ndarray, length: np.ndarray, entries: list[int], role: np.ndarray, gone: np.ndarray, torn: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Costs and ranks (unit, entry, state) of the cheapest edits of each unit of rows, and the edits that lead there, step by step.

    A unit is length[i] rows from start[i] on, longest unit first; entries: the states it may be entered with. role: the
    state of each row's own role, 0 if none; gone: rows that must be deleted; torn: truncated rows.
    """
    n, e = len(start), len(entries)
    cost = np.full((n, e, 4), _NEVER, np.int64)
    for i, s in enumerate(entries):
        cost[:, i, s] = 0
    rank = np.zeros((n, e, 4), np.int64)
    trail = []
    for t in range(int(length[0]) if n else 0):
        live = int(np.searchsorted(-length, -t, "left"))
        at = start[:live] + t
        c, r = cost[:live], rank[:live]
        own, free = role[at][:, None, None, None], (~gone[at])[:, None, None, None]
        to = np.arange(4)[None, None, None, :]
        same = own == to
        inserts = _INSERTS[None, None]
        retained = c[..., None] + 2 * inserts + np.where(same, 0, 2) + torn[at][:, None, None, None]
        retained = np.where(free & (inserts >= 0) & (same | (to > 1)), retained, _NEVER)
        code = np.where(inserts > 0, np.where(same, KEEP_AFTER, REROLE_AFTER), np.where(same, KEEP, REROLE))
        before = r[..., None] * 8
        key = np.minimum(retained, _NEVER) * 64 + before + code
        dropped = np.minimum(c + 3, _NEVER) * 64 + r * 8 + DELETE
        came = key.argmin(axis=2)
        best = np.take_along_axis(key, came[:, :, None, :], 2)[:, :, 0, :]
        keeps = best < dropped
        key = np.where(keeps, best, dropped)
        came = np.where(keeps, came, np.arange(4))
        order = key & 63
        cost[:live] = key >> 6
        rank[:live] = (order[..., None, :] < order[..., :, None]).sum(-1)
        trail.append((came * 8 + (key & 7)).astype(np.uint8))
    return cost, rank, trail


def edits(start: np.ndarray, length: np.ndarray, trail: list[np.ndarray], entry: np.ndarray, state: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's edit and the state after it, walking back from `state`. entry: the place among the entries."""
    code, to, state = np.zeros(rows, np.int64), np.zeros(rows, np.int64), state.copy()
    for t in range(len(trail) - 1, -1, -1):
        live = len(trail[t])
        step = trail[t][np.arange(live), entry[:live], state[:live]]
        at = start[:live] + t
        code[at], to[at] = step & 7, state[:live]
        state[:live] = step >> 3
    return code, to


def _written(code: np.ndarray, to: np.ndarray, roles: list[str], texts: list[str]) -> tuple[str, list[str]]:
    """The audit of consecutive rows and the turns that they leave."""
    audit, turns = [], []
    for c, s, role, text in zip(code.tolist(), to.tolist(), roles, texts, strict=True):
        audit.append(EDITS[c])
        if c != DELETE:
            if c in (KEEP_AFTER, REROLE_AFTER):
                turns.append("user:" if s == 3 else "assistant:")
            turns.append(f"{role if c in (KEEP, KEEP_AFTER) else STATES[s]}:{text}")
    return "".join(audit), turns


def _ending(state: int) -> list[str]:
    """The turns that end a conversation."""
    return {0: [], 1: ["user:", "assistant:"], 2: ["assistant:"], 3: []}[state]


def _states(roles: list[str]) -> np.ndarray:
    return np.array([{"s": 1, "u": 2, "a": 3}.get(r[:1], 0) for r in roles], np.int64)


def _illegal(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in _LEGAL for a, b in zip(roles, roles[1:], strict=False))


def _runs(ids: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Where each run of equal ids begins, and the end."""
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    value = ids.fill_null(0).to_numpy(zero_copy_only=False)
    new = np.flatnonzero((value[1:] != value[:-1]) | (known[1:] != known[:-1])) + 1
    return np.concatenate([[0], new, [len(value)]])


def _together(batches: Iterator[pa.RecordBatch], rows: int = TOGETHER) -> Iterator[pa.Table]:
    """Tables of whole conversations from rows sorted by conv_id."""
    held = []
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        if sum(map(len, held)) >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            last = int(_runs(table.column("conv_id").combine_chunks())[-2])
            if last:
                yield table.slice(0, last)
            held = table.slice(last).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _gaps(turns: list[int | None]) -> int:
    known = {t for t in turns if t is not None}
    return min(max(known) - min(known) + 1 - len(known), (1 << 63) - 1) if known else 0


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _together(batches):
        first = _runs(table.column("conv_id").combine_chunks())
        ids = table.column("conv_id").take(first[:-1]).to_pylist()
        unit = np.repeat(np.arange(len(ids)), np.diff(first))
        there = table.column("there").to_numpy()
        table, unit = table.filter(table.column("there")), unit[there]
        turns, roles, texts = (table.column(c).to_pylist() for c in ("turn", "role", "text"))
        blank, torn = table.column("blank").to_numpy(), table.column("cut").to_numpy()
        seen, again = set(), np.zeros(len(table), bool)
        for i, key in enumerate(zip(unit.tolist(), roles, texts, strict=True)):
            if key in seen:
                again[i] = True
            seen.add(key)
        again &= ~blank
        torn = torn & ~blank & ~again
        length = np.bincount(unit, minlength=len(ids))
        start = np.cumsum(length) - length
        order = np.argsort(-length, kind="stable")
        a, n = start[order], length[order]
        cost, rank, trail = steps(a, n, [0], _states(roles), blank | again, torn)
        total = (cost[:, 0] + 2 * _ENDING) * 8 + rank[:, 0]
        state = total.argmin(axis=1)
        code, to = edits(a, n, trail, np.zeros(len(ids), np.int64), state, len(table))
        ended = np.empty(len(ids), np.int64)
        ended[order] = state
        price = np.empty(len(ids), np.int64)
        price[order] = total.min(axis=1) >> 3
        out = []
        for i, conv in enumerate(ids):
            s, e = int(start[i]), int(start[i] + length[i])
            audit, kept = _written(code[s:e], to[s:e], roles[s:e], texts[s:e])
            kept += _ending(int(ended[i]))
            out.append((conv, _gaps(turns[s:e]), int(blank[s:e].sum()), int(again[s:e].sum()), int(torn[s:e].sum()), _illegal(roles[s:e]), int(price[i]), audit + "I" * int(_ENDING[ended[i]]), hashlib.sha256("\n".join(kept).encode("utf-8", "surrogatepass")).hexdigest()))
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    names = [c.split()[0] for c in RESULT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


_ORDER = [F.asc_nulls_first, F.asc, F.asc]


def _sorting():
    return [o(c) for o, c in zip(_ORDER, ("turn", "role", "text"), strict=True)]


def _whole(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), *_sorting()).mapInArrow(_repaired, RESULT)


SEGMENTS = """conv_id long, part int, number int, turns array<long>, roles array<string>, texts array<string>, blank array<boolean>,
    again array<boolean>, torn array<boolean>"""
PASSAGE = "conv_id long, part int, number int, cost array<long>, rank array<long>, gaps array<long>, counts array<long>, ends array<string>"
CHOICE = "conv_id long, part int, number int, entry int, state int, last boolean"
SUMS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def _segmented(rows: DataFrame, size: int) -> DataFrame:
    """The same for conversations of any length."""
    every = rows.select("conv_id").distinct()
    rows = cut(rows.filter("there").drop("there").withColumn("_n", F.monotonically_increasing_id()))
    same = ["conv_id", "role", "text"]
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "_n")
    firsts = cut(rows.groupBy("conv_id", F.sha2(F.concat_ws("\0", "role", "text"), 256).alias("_key")).agg(F.min(place).alias("_first"), F.count("*").alias("_k")).filter("_k > 1").drop("_k"))
    rows = with_table(rows.withColumn("_key", F.sha2(F.concat_ws("\0", *same[1:]), 256)), firsts, ["conv_id", "_key"])
    again = F.coalesce(place != F.col("_first"), F.lit(False)) & ~F.col("blank")
    rows = rows.select("conv_id", "turn", "role", "text", "_n", "blank", again.alias("again"), (F.col("cut") & ~F.col("blank") & ~again).alias("torn"))
    order = [F.asc_nulls_first("conv_id"), *_sorting(), F.asc("_n")]
    segments = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_n").mapInArrow(lambda batches: _cut_up(batches, size), SEGMENTS))
    passages = segments.drop("texts").mapInPandas(_passages, PASSAGE)
    chained = cut(passages.repartition("conv_id").sortWithinPartitions("conv_id", "part", "number").mapInPandas(_chained, f"{CHOICE}, sums struct<{SUMS.split(', ', 1)[1].replace(' ', ':').replace(',:', ',')}>"))
    choices = chained.drop("sums").withColumnsRenamed({"part": "_part", "number": "_number", "conv_id": "_conv"})
    mine = segments.join(choices, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")) & (F.col("number") == F.col("_number")))
    pieces = mine.select("conv_id", "part", "number", "roles", "texts", "blank", "again", "torn", "entry", "state", "last").mapInPandas(_pieces, "conv_id long, part int, number int, audit string, body string, any boolean")
    streamed = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "number").mapInArrow(_streamed, "conv_id long, audit string, repaired_sha256 string")
    sums = chained.filter("last").select("conv_id", "sums.*")
    none = hashlib.sha256(b"").hexdigest()
    joined = every
    for table in (sums, streamed):
        table = table.withColumnRenamed("conv_id", "_conv")
        joined = joined.join(table, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    names = [c.split()[0] for c in SUMS.split(", ")[1:]]
    return joined.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"))


def _cut_up(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, number, held, now = TaskContext.get().partitionId(), 0, [], None
    kinds = {"turns": pa.int64(), "roles": pa.string(), "texts": pa.string(), "blank": pa.bool_(), "again": pa.bool_(), "torn": pa.bool_()}

    def out():
        nonlocal number, held
        columns = [pa.array([list(c)], pa.list_(k)) for c, k in zip(zip(*held, strict=True), kinds.values(), strict=True)]
        batch = pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([part], pa.int32()), pa.array([number], pa.int32()), *columns], ["conv_id", "part", "number", *kinds])
        number, held = number + 1, []
        return batch

    for batch in batches:
        for conv, *row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "blank", "again", "torn")), strict=True):
            if held and (conv != now or len(held) >= size):
                yield out()
            now = conv
            held.append(row)
    if held:
        yield out()


def _segment_steps(row, entries: list[int]):
    n = len(row.roles)
    flag = lambda xs: np.array(list(xs), bool)
    return steps(np.zeros(1, np.int64), np.array([n]), entries, _states(list(row.roles)), flag(row.blank) | flag(row.again), flag(row.torn))


def _passages(frames):
    """For each segment costs and ranks from each entry to each exit, and what else is needed of it."""
    import pandas as pd

    for frame in frames:
        out = []
        for row in frame.itertuples():
            cost, rank, _ = _segment_steps(row, [0, 1, 2, 3])
            turns = [int(t) for t in row.turns if t is not None and t == t]
            roles = list(row.roles)
            counts = [sum(map(bool, x)) for x in (row.blank, row.again, row.torn)] + [_illegal(roles)]
            gaps = [min(turns), max(turns), len(set(turns))] if turns else []
            out.append((row.conv_id, row.part, row.number, cost[0].ravel().tolist(), rank[0].ravel().tolist(), gaps, counts, [roles[0][:1], roles[-1][:1]]))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in PASSAGE.split(", ")])


def _chained(frames):
    """Entry and exit of every segment on the cheapest way through its conversation; the last segment carries the conversation's sums."""
    import pandas as pd

    def close(rows):
        cost, rank, back = np.array([0, _NEVER, _NEVER, _NEVER]), np.zeros(4, np.int64), []
        for r in rows:
            c, k = np.array(r.cost).reshape(4, 4), np.array(r.rank).reshape(4, 4)
            key = np.minimum(cost[:, None] + c, _NEVER) * 64 + rank[:, None] * 8 + k
            came = key.argmin(axis=0)
            best = key[came, np.arange(4)]
            order = best & 63
            cost, rank = best >> 6, (order[None, :] < order[:, None]).sum(1)
            back.append(came)
        total = (cost + 2 * _ENDING) * 8 + rank
        state = int(total.argmin())
        known = [r.gaps for r in rows if len(r.gaps)]
        distinct = sum(int(g[2]) for g in known) - sum(int(a[1]) == int(b[0]) for a, b in zip(known, known[1:], strict=False))
        gaps = min(int(known[-1][1]) - int(known[0][0]) + 1 - distinct, (1 << 63) - 1) if known else 0
        counts = np.array([list(r.counts) for r in rows]).sum(axis=0).tolist()
        counts[3] += sum(a.ends[1] + b.ends[0] not in _LEGAL for a, b in zip(rows, rows[1:], strict=False))
        sums = {"gaps": gaps, "blank": counts[0], "duplicate": counts[1], "truncated": counts[2], "illegal": counts[3], "cost": int(total.min() >> 3)}
        out, last = [], True
        for r, came in zip(reversed(rows), reversed(back), strict=True):
            out.append((r.conv_id, r.part, r.number, int(came[state]), state, last, sums if last else None))
            state, last = int(came[state]), False
        return pd.DataFrame(out, columns=["conv_id", "part", "number", "entry", "state", "last", "sums"])

    now, held = None, []
    for frame in frames:
        for row in frame.itertuples():
            conv = None if pd.isna(row.conv_id) else row.conv_id
            if held and conv != now:
                yield close(held)
                held = []
            now = conv
            held.append(row)
    if held:
        yield close(held)


def _pieces(frames):
    import pandas as pd

    for frame in frames:
        out = []
        for row in frame.itertuples():
            _, _, trail = _segment_steps(row, [row.entry])
            n = np.array([len(row.roles)])
            code, to = edits(np.zeros(1, np.int64), n, trail, np.zeros(1, np.int64), np.array([row.state]), int(n[0]))
            audit, turns = _written(code, to, list(row.roles), list(row.texts))
            if row.last:
                audit += "I" * int(_ENDING[row.state])
                turns += _ending(row.state)
            out.append((row.conv_id, row.part, row.number, audit, "\n".join(turns), bool(turns)))
        yield pd.DataFrame(out, columns=["conv_id", "part", "number", "audit", "body", "any"])


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and audit of each conversation from its pieces in order; of the texts one piece is held at a time."""
    now, audit, digest, begun = None, None, None, False

    def out():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array(["".join(audit)]), pa.array([digest.hexdigest()])], ["conv_id", "audit", "repaired_sha256"])

    for batch in batches:
        for conv, a, body, some in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "body", "any")), strict=True):
            if audit is None or conv != now:
                if audit is not None:
                    yield out()
                now, audit, digest, begun = conv, [], hashlib.sha256(), False
            audit.append(a)
            if some:
                digest.update((b"\n" if begun else b"") + body.encode("utf-8", "surrogatepass"))
                begun = True
    if audit is not None:
        yield out()


def _priced(value: str, more: str, text: str) -> str:
    """SQL: a cost of nine digits with its audit, with more cost and text added; null stays null."""
    return f"lpad((left({value}, 9)::BIGINT + {more})::VARCHAR, 9, '0') || substr({value}, 10) || {text}"


def _oracle() -> str:
    """The DP row by row as a recursive query; values are cost and audit in one string, so least() breaks ties."""
    took = lambda s: f"CASE WHEN r.own = '{s}' THEN 'K' ELSE 'R' END"
    fee = lambda s: f"(CASE WHEN r.own = '{s}' THEN 0 ELSE 2 END + r.torn)"

    def kept(s: str, straight: list[str], after: list[str]) -> str:
        ways = [_priced(f"p.{v}", fee(s), took(s)) for v in straight] + [_priced(f"p.{v}", f"2 + {fee(s)}", f"'I' || {took(s)}") for v in after]
        return f"least({_priced(f'p.v{s}', '3', chr(39) + 'D' + chr(39))}, CASE WHEN NOT r.gone THEN least({', '.join(ways)}) END)"

    deleted = _priced("p.v0", "3", "'D'")
    system = f"least({_priced('p.vs', '3', chr(39) + 'D' + chr(39))}, CASE WHEN NOT r.gone AND r.own = 's' THEN {_priced('p.v0', 'r.torn', chr(39) + 'K' + chr(39))} END)"
    final = f"least(v0, {_priced('vs', '4', chr(39) + 'II' + chr(39))}, {_priced('vu', '2', chr(39) + 'I' + chr(39))}, va)"
    return rf"""
    WITH RECURSIVE hashed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(k) + 1), lambda i: ord(substr(k, i, 1))::BIGINT)),
                lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, j: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 20 AS hit
        FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations)),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
            CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE hit WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM hashed WHERE hit <> 0),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n, left(role, 1) AS own, rtrim(text, e' \t\n\x0b\x0c\r') AS solid FROM damaged),
    faults AS (SELECT *, solid = '' AS blank, solid <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again, lag(own) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM numbered),
    marked AS (SELECT *, blank OR again AS gone, CASE WHEN NOT blank AND NOT again AND right(solid, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS torn FROM faults),
    walk AS (
        SELECT conv_id, 0::BIGINT AS n, '000000000' AS v0, NULL::VARCHAR AS vs, NULL::VARCHAR AS vu, NULL::VARCHAR AS va, ''::VARCHAR AS x FROM (SELECT DISTINCT conv_id FROM conversations)
        UNION ALL
        SELECT p.conv_id, r.n, {deleted}, {system}, {kept('u', ['v0', 'vs', 'va'], ['vu'])}, {kept('a', ['vu'], ['v0', 'vs', 'va'])}, ''
        FROM walk p JOIN marked r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.n = p.n + 1),
    ended AS (SELECT conv_id, {final} AS best FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1),
    edits AS (SELECT conv_id, best, regexp_replace(substr(best, 10), 'D', '', 'g') AS shown FROM ended),
    steps AS (
        SELECT conv_id, unnest(regexp_extract_all(substr(best, 10), 'I*[DKR]|I+$')) AS step, unnest(range(1, len(regexp_extract_all(substr(best, 10), 'I*[DKR]|I+$')) + 1)) AS n FROM edits),
    shown AS (
        SELECT s.conv_id, s.n, s.step, m.role, m.text, coalesce(m.own = 's' AND right(s.step, 1) = 'K', false) AS system,
            sum(len(replace(s.step, 'D', '')) - CASE WHEN coalesce(m.own = 's' AND right(s.step, 1) = 'K', false) THEN 1 ELSE 0 END) OVER (PARTITION BY s.conv_id ORDER BY s.n) AS upto
        FROM steps s LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.n = s.n),
    turns AS (
        SELECT conv_id, n, step, unnest(range(len(replace(step, 'D', '')))) AS i, upto, role, text, system FROM shown),
    lines AS (
        SELECT conv_id, n, i, CASE WHEN substr(step, i + 1, 1) = 'K' THEN role || ':' || text ELSE
            CASE WHEN (upto - len(step) + i) % 2 = 0 THEN 'user:' ELSE 'assistant:' END || CASE WHEN substr(step, i + 1, 1) = 'R' THEN text ELSE '' END END AS line
        FROM turns WHERE step <> 'D'),
    texts AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY n, i) AS body FROM lines GROUP BY conv_id),
    counts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate, sum(torn) AS truncated,
            count(*) FILTER (n > 1 AND before || own NOT IN ('su', 'ua', 'au')) AS illegal
        FROM marked GROUP BY conv_id)
    SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
        coalesce(illegal, 0)::BIGINT AS illegal, left(best, 9)::BIGINT AS cost, substr(best, 10) AS audit, sha256(coalesce(body, '')) AS repaired_sha256
    FROM edits e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM e.conv_id"""


ORACLE = _oracle()
