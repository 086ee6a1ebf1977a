"""Operator 11: repair of conversation structure by a rank-convergence parallel Viterbi search.

A conversation's rows, in order, become an edit script (Keep, Rerole, Delete, Insert) of
least cost after which the role initials read ``(s?(ua)+)?``.  Four states say what the
repaired rows so far look like: nothing, ``s``, ending in ``u``, ending in ``a``.  Backward
costs (state to the cost of finishing from there) follow from the last row to the first;
only their differences matter, and few vectors exist up to a constant.

Rows are dealt out by ranges of (conversation, turn, role, text) and packed, in order, into
chunks: a byte per row.  A long conversation spans many chunks, which run at once:

1. every chunk runs backward from a speculative vector (as if the conversation ended there);
2. fix-up passes: a chunk whose successor's vector differs from the one it assumed by more
   than a constant runs again from that vector, until none does; the constants add up to the
   costs (a pass costs one join over the chunks that are still wrong);
3. each chunk tells where a trace that enters in each of the four states leaves it; one
   row per chunk, composed in order, gives the state in which each chunk is entered;
4. chunks trace their own least audit from there.

The audit of a conversation and the hash of its repaired text are sequential by nature: a
last pass streams the chunks of each conversation in order, a chunk at a time.
"""

from __future__ import annotations

import hashlib
import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

CHUNK_ROWS, CHUNK_BYTES, RANGE_BYTES = 1 << 16, 4 << 20, 8 << 20

#: Costs of the edits, and of leaving a truncated row in.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: States: 0 nothing yet, 1 after s, 2 after u, 3 after a.  The state after an inserted or
#: reroled row, and the cost of ending there (a missing answer, or question and answer).
_GROWS, END = (2, 2, 3, 2), (0, 2 * INSERT, INSERT, 0)
_AT_END = ("", "II", "I", "")
#: The state after a kept row by its initial (s, u, a, other).
_KEEPS = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})
_INITIALS = {"s": 0, "u": 1, "a": 2}
_MUST, _CUT = 4, 8  # bits of a row's code: to be deleted, truncated
_BLANK = " \t\n\x0b\x0c\r"
#: Neighbours whose initials may stand together.
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True


@cache
def _step(after: tuple, code: int) -> tuple[tuple, int, tuple]:
    """Costs after a row to those before it, less their least, that least, and for each state
    the least letters that lead over the row at that cost with the state behind it."""
    cut = TRUNCATED if code & _CUT else 0
    ways = []
    for s in range(4):
        to = {"D": (DELETE + after[s], s)}
        if not code & _MUST:
            kept = _KEEPS[code & 3].get(s)
            if kept is not None:
                to["K"] = (cut + after[kept], kept)
            to["R"] = (REROLE + cut + after[_GROWS[s]], _GROWS[s])
        ways.append(to)
    over = [min(c for c, _ in w.values()) for w in ways]
    before = list(over)
    before[2], before[3] = min(over[2], INSERT + over[3]), min(over[3], INSERT + over[2])
    before[0], before[1] = (min(over[s], INSERT + before[2]) for s in (0, 1))
    moves = []
    for s in range(4):
        letters, at = "", s
        while True:
            fits = {x: t for x, (c, t) in ways[at].items() if c == before[at]}
            if INSERT + before[_GROWS[at]] == before[at]:
                fits["I"] = None
            x = min(fits)
            letters += x
            if x != "I":
                moves.append((letters, fits[x]))
                break
            at = _GROWS[at]
    least = min(before)
    return tuple(c - least for c in before), least, tuple(moves)


def backward(codes: bytes, end: tuple, trace: bool = False):
    """(costs before the rows less a constant, that constant[, moves row by row])."""
    v, total, moves = tuple(end), 0, []
    for c in reversed(codes):
        v, least, m = _step(v, c)
        total += least
        if trace:
            moves.append(m)
    return (v, total, moves[::-1]) if trace else (v, total)


def damaged(rows: DataFrame) -> DataFrame:
    """The test damage by crc32(``conv_id:turn``) modulo 20 (nulls: one space): 0 drops the row, 1
    empties its text, 2 removes ``[.!?]``, 3 repeats it, 4 makes the role user."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    x = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("_k"))
    text = F.when(F.col("_k") == 1, F.lit("")).when(F.col("_k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return x.where("_k <> 0").select("conv_id", "turn", F.when(F.col("_k") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
                                     F.when(F.col("_k") == 3, 2).otherwise(1).cast("long").alias("times"))


def _faults(rows: DataFrame) -> DataFrame:
    """Distinct rows with ``copies`` and the first fault of the first copy (the others are
    blank or duplicate)."""
    x = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("copies"))
    x = x.withColumn("t1", F.xxhash64("text")).withColumn("t2", F.xxhash64(F.lit(1), F.col("text")))
    first = x.groupBy("conv_id", "role", "t1", "t2").agg(F.min("turn").alias("f_turn"), F.bool_or(F.col("turn").isNull()).alias("f_null"))
    first = first.select(F.col("conv_id").alias("f_conv"), F.col("role").alias("f_role"), F.col("t1").alias("f1"), F.col("t2").alias("f2"), "f_turn", "f_null")
    x = x.join(first, x["conv_id"].eqNullSafe(first["f_conv"]) & (F.col("role") == F.col("f_role")) & (F.col("t1") == F.col("f1")) & (F.col("t2") == F.col("f2")))
    later = F.when(F.col("f_null"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("f_turn"))
    end = F.rtrim(F.col("text"), F.lit(_BLANK))
    fault = F.when(end == "", "blank").when(later, "duplicate").when(~F.right(end, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("none")
    return x.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))


_CHUNK = "conv_id long, chunk long, codes binary, roles array<string>, texts array<string>"


def _chunks(chunk_rows: int, chunk_bytes: int):
    """Rows in order to chunks: a code per row (copies included), role and text of those that
    need not go."""
    def run(batches):
        part, number = TaskContext.get().partitionId() << 32, 0
        conv, codes, roles, texts, held, open_ = None, bytearray(), [], [], 0, False
        done: list[list] = [[], [], [], [], []]

        def close():
            nonlocal codes, roles, texts, held, number
            for col, v in zip(done, (conv, part + number, bytes(codes), roles, texts)):
                col.append(v)
            codes, roles, texts, held, number = bytearray(), [], [], 0, number + 1

        def out():
            types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.string())]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(done, types)], names=["conv_id", "chunk", "codes", "roles", "texts"])
            for c in done:
                c.clear()
            return made

        for b in batches:
            at = 0
            while at < b.num_rows:
                few = b.slice(at, 512)
                at += few.num_rows
                for c, role, text, copies, fault in zip(*[x.to_pylist() for x in few.columns]):
                    if open_ and (c != conv or len(codes) >= chunk_rows or held >= chunk_bytes):
                        close()
                    conv, open_ = c, True
                    initial = _INITIALS.get(role[:1], 3)
                    if fault in ("blank", "duplicate"):
                        codes.append(initial | _MUST)
                    else:
                        codes.append(initial | (_CUT if fault == "truncated" else 0))
                        roles.append(role)
                        texts.append(text)
                        held += len(role) + len(text)
                    rest = copies - 1
                    while rest > 0:
                        if len(codes) >= chunk_rows:
                            close()
                            if len(done[0]) >= 64:
                                yield out()
                        n = min(rest, chunk_rows - len(codes))
                        codes += bytes([initial | _MUST]) * n
                        rest -= n
                yield out()
        if open_:
            close()
            yield out()

    return run


_STATE = "chunk long, next long, used array<int>, start array<int>, least long"


def _assumed(batches):
    """Chunks (chunk, next, codes, assumed vector) run backward."""
    for b in batches:
        rows = []
        for chunk, nxt, codes, end in zip(*[c.to_pylist() for c in b.columns]):
            v, least = backward(codes, tuple(end))
            rows.append((chunk, nxt, end, list(v), least))
        cols = list(zip(*rows)) or [[]] * 5
        types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["chunk", "next", "used", "start", "least"])


def _converge(codes: DataFrame, links: DataFrame) -> DataFrame:
    """Vectors of the chunks of conversations with several: speculative, then fixed up."""
    several = links.where("next IS NOT NULL OR prev IS NOT NULL").select(F.col("chunk").alias("l_chunk"), "next")
    end = F.array(*[F.lit(c) for c in END])
    own = codes.join(several, F.col("chunk") == F.col("l_chunk")).select("chunk", "next", "codes", end.alias("end"))
    state = common.save(own.mapInArrow(_assumed, _STATE), "repair-vectors")
    while True:
        after = state.select(F.col("chunk").alias("a_chunk"), F.col("start").alias("wanted"))
        wrong = state.join(after, F.col("next") == F.col("a_chunk")).where("used <> wanted").select(F.col("chunk").alias("w_chunk"), "next", "wanted")
        wrong = common.save(wrong, "repair-wrong")
        if wrong.isEmpty():
            return state
        again = codes.join(wrong, F.col("chunk") == F.col("w_chunk")).select("chunk", "next", "codes", "wanted").mapInArrow(_assumed, _STATE)
        kept = state.join(wrong.select("w_chunk"), F.col("chunk") == F.col("w_chunk"), "left_anti")
        state = common.save(kept.unionByName(again), "repair-vectors")


def _exits(batches):
    """Chunks to the states in which traces that enter in 0..3 leave them."""
    for b in batches:
        rows = []
        for conv, chunk, codes, used in zip(*[c.to_pylist() for c in b.columns]):
            at = list(range(4))
            for m in backward(codes, tuple(used), True)[2]:
                at = [m[s][1] for s in at]
            rows.append((conv, chunk, at))
        cols = list(zip(*rows)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), pa.list_(pa.int32())])], names=["conv_id", "chunk", "exits"])


def _enters(batches):
    """Exit maps in the order of the chunks to the state in which each chunk is entered."""
    conv, state, first = None, 0, True
    for b in batches:
        chunks, enter = [], []
        for c, chunk, exits in zip(*[x.to_pylist() for x in b.columns]):
            if first or c != conv:
                conv, state, first = c, 0, False
            chunks.append(chunk)
            enter.append(state)
            state = exits[state]
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(enter, pa.int32())], names=["e_chunk", "enter"])


_PIECE = "conv_id long, chunk long, kind int, codes binary, roles array<string>, texts array<string>, audit string, least long, start int"


def _traces(batches):
    """Chunks with the vector behind them and the state before them: their part of the audit."""
    for b in batches:
        rows = []
        for conv, chunk, codes, used, enter, last in zip(*[c.to_pylist() for c in b.columns]):
            v, least, moves = backward(codes, tuple(used), True)
            s, letters = enter, []
            for m in moves:
                x, s = m[s]
                letters.append(x)
            if last:
                letters.append(_AT_END[s])
            rows.append((conv, chunk, 0, None, None, None, "".join(letters), least, v[enter]))
        cols = list(zip(*rows)) or [[]] * 9
        types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string(), pa.int64(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[c.split()[0] for c in _PIECE.split(", ")])


class _Repair:
    """One conversation, chunk after chunk."""

    def __init__(self, conv):
        self.conv, self.sha, self.any, self.audit, self.state = conv, hashlib.sha256(), False, [], 0
        self.cost, self.illegal, self.last = None, 0, None

    def line(self, role: str, text: str) -> None:
        self.sha.update(("\n" if self.any else "").encode() + f"{role}:{text}".encode())
        self.any = True

    def add(self, audit: str, least: int, start: int, codes: bytes, roles: list[str], texts: list[str]) -> None:
        self.cost = least + (start if self.cost is None else self.cost)
        self.audit.append(audit)
        initial = np.frombuffer(codes, np.uint8) & 3
        self.illegal += int((~_LEGAL[initial[:-1], initial[1:]]).sum()) + (self.last is not None and not _LEGAL[self.last, initial[0]])
        self.last = int(initial[-1])
        at = own = 0
        for x in audit:
            if x == "I":
                self.line(("user", "user", "assistant", "user")[self.state], "")
                self.state = _GROWS[self.state]
                continue
            code = codes[at]
            at += 1
            if x == "K":
                self.line(roles[own], texts[own])
                self.state = _KEEPS[code & 3][self.state]
            elif x == "R":
                self.line(("user", "user", "assistant", "user")[self.state], texts[own])
                self.state = _GROWS[self.state]
            own += not code & _MUST


def _repairs(batches):
    """Pieces in order (a chunk's trace, then its rows) to a row per conversation."""
    now = trace = None
    for b in batches:
        done = []
        for at in range(b.num_rows):  # a chunk at a time
            conv, _, kind, codes, roles, texts, audit, least, start = (c[at].as_py() for c in b.columns)
            if kind == 0:
                trace = audit, least, start
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now)
                    now = _Repair(conv)
            else:
                now.add(*trace, codes, roles, texts)
        if done:
            yield _rows(done)
    if now is not None:
        yield _rows([now])


def _rows(done: list[_Repair]) -> pa.RecordBatch:
    cols = list(zip(*[(r.conv, r.illegal, r.cost, "".join(r.audit), r.sha.hexdigest()) for r in done]))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["r_conv", "illegal", "cost", "audit", "repaired_sha256"])


def repair(rows: DataFrame, convs: DataFrame | None = None, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Faults, costs, edits and repaired text of every conversation.

    ``rows``: ``conv_id, turn, role, text`` and, if there, ``times`` (how often a row stands
    there).  A conversation's rows are taken by turn, nulls first, rows of one turn by role and
    text; a null role or text is one space, a null conv_id a conversation like any other.
    ``convs`` (a ``conv_id`` column) names conversations that must be in the result though they
    have no rows: zeros, an empty audit and the hash of the empty string.  A row whose role is
    empty or starts otherwise than with s, u or a can't be kept.  Returns ``conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256``; ``gaps`` is null where it
    doesn't fit into a long.
    """
    spark = rows.sparkSession
    times = F.col("times") if "times" in rows.columns else F.lit(1).cast("long")
    space = F.lit(" ")
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), times.alias("times"))
    faults = common.save(_faults(rows), "repair-rows")
    # Counts.
    others = F.col("copies") - 1
    named = {f: F.col("fault") == f for f in ("blank", "duplicate", "truncated")}
    counts = [F.sum(F.when(named["blank"], F.col("copies")).otherwise(0)).alias("blank"),
              F.sum(F.when(named["blank"], 0).otherwise(others + named["duplicate"].cast("long"))).alias("duplicate"), F.sum(named["truncated"].cast("long")).alias("truncated")]
    by_turn = faults.groupBy("conv_id", "turn").agg(*counts)
    wide = [F.max("turn").cast("decimal(38,0)"), F.min("turn").cast("decimal(38,0)")]
    gaps = F.coalesce(wide[0] - wide[1] + 1 - F.count("turn"), F.lit(0))
    totals = by_turn.groupBy(F.col("conv_id").alias("s_conv")).agg(gaps.try_cast("long").alias("gaps"), *[F.sum(c).cast("long").alias(c) for c in named])
    # Chunks.
    size = faults.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    order = ["conv_id", "turn", "role", "text"]
    dealt = faults.repartitionByRange(max(1, math.ceil(size / range_bytes)), *order).sortWithinPartitions(*order)
    chunks = common.save(dealt.select("conv_id", "role", "text", "copies", "fault").mapInArrow(_chunks(chunk_rows, chunk_bytes), _CHUNK), "repair-chunks")
    codes = chunks.select("conv_id", "chunk", "codes")
    w = Window.partitionBy("conv_id").orderBy("chunk")  # a row per chunk
    links = common.save(codes.select("conv_id", "chunk", F.lead("chunk").over(w).alias("next"), F.lag("chunk").over(w).alias("prev")), "repair-links")
    state = _converge(codes.drop("conv_id"), links)
    own = state.select(F.col("chunk").alias("v_chunk"), "used", F.col("next").isNull().alias("is_last"))
    exits = codes.join(own, F.col("chunk") == F.col("v_chunk")).select("conv_id", "chunk", "codes", "used").mapInArrow(_exits, "conv_id long, chunk long, exits array<int>")
    enters = exits.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(_enters, "e_chunk long, enter int")
    known = codes.join(own, F.col("chunk") == F.col("v_chunk"), "left").join(enters, F.col("chunk") == F.col("e_chunk"), "left")
    traces = known.select("conv_id", "chunk", "codes", F.coalesce("used", F.array(*[F.lit(c) for c in END])).alias("used"), F.coalesce("enter", F.lit(0)).alias("enter"),
                          F.coalesce("is_last", F.lit(True)).alias("is_last")).mapInArrow(_traces, _PIECE)
    bodies = chunks.select("conv_id", "chunk", F.lit(1).alias("kind"), "codes", "roles", "texts", F.lit(None).cast("string").alias("audit"),
                           F.lit(None).cast("long").alias("least"), F.lit(None).cast("int").alias("start"))
    pieces = traces.unionByName(bodies).repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "kind")
    repaired = pieces.mapInArrow(_repairs, "r_conv long, illegal long, cost long, audit string, repaired_sha256 string")
    out = totals.join(repaired, F.col("s_conv").eqNullSafe(F.col("r_conv")))
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    if convs is None:
        return out.select(F.col("s_conv").alias("conv_id"), *names)
    every = convs.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = every.join(out.withColumn("has", F.lit(True)), F.col("conv_id").eqNullSafe(F.col("s_conv")), "left")
    none = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return out.select("conv_id", *[F.when(F.col("has"), F.col(c)).otherwise(F.lit(none.get(c, 0))).alias(c) for c in names])


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``conversations`` after the test damage."""
    rows = common.table(spark, sf_dir, "conversations")
    return repair(damaged(rows), rows)
