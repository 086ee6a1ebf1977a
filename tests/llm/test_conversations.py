"""Operator 11 against a plain shortest-path search over whole conversations."""

import hashlib
import heapq
import random
import zlib

from pyspark.sql import functions as F

from ferrule.llm import common, conversations

SCHEMA = "conv_id long, turn long, role string, text string"
NOT_WORD = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(key.encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else "".join(c for c in text if c not in ".!?") if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def plain(rows):
    """One conversation's digest: Dijkstra over (rows done, state), the heap ordered by cost,
    then by the letters so far."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        end = text.rstrip(NOT_WORD)
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, at, state, lines = heapq.heappop(heap)
        if (at, state) in done:
            continue
        if at == len(rows) and state in ("", "a"):
            break
        done.add((at, state))
        want = "assistant" if state == "u" else "user"
        heapq.heappush(heap, (cost + 2, letters + "I", at, want[0], (*lines, f"{want}:")))
        if at < len(rows):
            _, _, role, text = rows[at]
            heapq.heappush(heap, (cost + 3, letters + "D", at + 1, state, lines))
            if faults[at] not in ("blank", "duplicate"):
                extra = faults[at] == "truncated"
                heapq.heappush(heap, (cost + 2 + extra, letters + "R", at + 1, want[0], (*lines, f"{want}:{text}")))
                if initials[at] == want[0] or initials[at] == "s" and state == "":
                    heapq.heappush(heap, (cost + extra, letters + "K", at + 1, initials[at], (*lines, f"{role}:{text}")))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows, convs):
    by = {c: [] for c in convs}
    for r in rows:
        by[r[0]].append(r)
    return {c: plain(v) for c, v in by.items()}


def got(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(conversations.op11_conversations(spark, sf_dir)) == expected(damage(rows), {r[0] for r in rows})


def messy(n, seed, convs):
    r = random.Random(seed)
    return [(r.choice(convs), r.choice([None, *range(n // 3)]), r.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]),
             r.choice(["Yes.", "No?", "cut", " ", "", None, "so\n", "ok. ", *[f"text {i}!" for i in range(n)]])) for _ in range(n)]


def test_long_conversations_in_small_chunks(spark):
    """Chunks of three rows and ranges of a few: the fix-up passes and the stitching give the plain result."""
    rows = messy(400, 1, [1, 2, None]) + messy(30, 2, list(range(10, 20)))
    df = spark.createDataFrame(rows, SCHEMA)
    clean = [(c, t, " " if x is None else x, " " if y is None else y) for c, t, x, y in rows]
    want = expected(clean, {r[0] for r in rows})
    for chunk_rows, range_bytes in ((3, 1000), (50, 1 << 20)):
        assert got(conversations.repair(df, chunk_rows=chunk_rows, chunk_bytes=60, range_bytes=range_bytes)) == want


def test_damage(spark):
    rows = messy(200, 3, [1, 2, None])
    have = conversations.damaged(spark.createDataFrame(rows, SCHEMA))
    have = [(r.conv_id, r.turn, r.role, r.text) for r in have.collect() for _ in range(r.times)]
    assert sorted(have, key=repr) == sorted(damage(rows), key=repr)


def test_copies_run_over_chunks(spark):
    """A row that stands there often is one row with a count, cut into chunks."""
    df = spark.createDataFrame([(1, 0, "user", "a?", 1), (1, 1, "assistant", "b.", 1000), (1, 2, "user", "c?", 1)], SCHEMA + ", times long")
    r = conversations.repair(df, chunk_rows=64).first()
    assert (r.duplicate, r.cost, r.audit) == (999, 999 * 3 + 2, "KK" + "D" * 999 + "KI")


def test_empty_and_clashing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.repair(empty, empty).collect() == []
    rows = messy(60, 4, [1, None])
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("chunk", "codes", "copies", "fault", "next", "s_conv", "kind")])
    every = spark.createDataFrame([(1,), (None,), (7,), (7,)], "conv_id long")
    out = got(conversations.repair(df, every))
    assert out[7] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) and set(out) == {1, None, 7}
    clean = [(c, t, " " if x is None else x, " " if y is None else y) for c, t, x, y in rows]
    assert {k: v for k, v in out.items() if k != 7} == expected(clean, {1, None})
