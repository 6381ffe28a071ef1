import hashlib
import heapq
import random
import zlib

from marquee.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string, audit string, cost long"
SPACES = " \t\n\v\f\r"


def damaged(rows):
    out = {}
    for conv, turn, role, text, *_ in rows:
        group = out.setdefault(conv, [])
        show = lambda v: " " if v is None else str(v)
        hit = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if hit == 1:
            text = ""
        if hit == 2:
            text = "".join(c for c in text if c not in ".!?")
        if hit == 4:
            role = "user"
        group += [(turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    for group in out.values():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def cheapest(rows, gone, torn):
    """Dijkstra over (rows used, last role), one edit at a time; the least (cost, audit) first."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, kept = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, kept
        if (i, last) in done:
            continue
        done.add((i, last))
        for name in ("user", "assistant"):
            if name[0] in after[last]:
                heapq.heappush(heap, (cost + 2, audit + "I", i, name[0], (*kept, f"{name}:")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, kept))
            if not gone[i]:
                if role[:1] and role[:1] in after[last]:
                    heapq.heappush(heap, (cost + torn[i], audit + "K", i + 1, role[0], (*kept, f"{role}:{text}")))
                for name in ("user", "assistant"):
                    if name[0] in after[last]:
                        heapq.heappush(heap, (cost + 2 + torn[i], audit + "R", i + 1, name[0], (*kept, f"{name}:{text}")))


def plain(rows):
    out = []
    for conv, group in damaged(rows).items():
        blank = [not text.strip(SPACES) for _, _, text in group]
        again = [not blank[i] and (r, t) in [(x, y) for _, x, y in group[:i]] for i, (_, r, t) in enumerate(group)]
        torn = [not blank[i] and not again[i] and t.strip(SPACES)[-1] not in ".!?" for i, (_, _, t) in enumerate(group)]
        known = {t for t, _, _ in group if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(group, group[1:], strict=False))
        cost, audit, kept = cheapest(group, [a or b for a, b in zip(blank, again, strict=True)], torn)
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        out.append((conv, gaps, sum(blank), sum(again), sum(torn), illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def odd_rows():
    rng = random.Random(3)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "u2", "Assistant"]
    texts = ["Yes.", "No!", "why", "so it goes?  ", "", " \n", None, "ünï.", "a.b", "Right. "]
    rows = []
    for conv in [*range(150), None]:
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 3]), rng.choice(roles), rng.choice(texts), "x", 1))
    return rows + rows[:20]


def test_repair_equals_the_cheapest_edits(spark):
    rows = odd_rows()
    want = plain(rows)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert sorted(map(tuple, turns.repair(turns.damage(frame)).collect()), key=str) == want


def test_long_conversations_are_cut_into_segments(spark):
    rng = random.Random(5)
    rows = odd_rows() + [(7000, t // 2 if t % 7 else None, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a.", "b", "c?"]) * rng.randrange(1, 9), None, None) for t in range(400)]
    rows += [(7001, 5, "user", "again.", None, None)] * 90
    want = plain(rows)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted(map(tuple, turns.repair(turns.damage(frame), long=3, segment=4).collect()), key=str) == want


def test_dropped_turns_leave_their_conversation(spark):
    conv, turn = next((c, 0) for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    for long in (2000, 0):
        row = turns.repair(turns.damage(spark.createDataFrame([(conv, turn, "user", "Hi.")] * 2, "conv_id long, turn long, role string, text string")), long=long).collect()
        assert [tuple(r) for r in row] == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_no_conversations(spark):
    assert turns.repair(turns.damage(spark.createDataFrame([], SCHEMA))).collect() == []
