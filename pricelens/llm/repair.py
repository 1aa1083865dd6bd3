"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation is brought into the form ``(s?(ua)+)?`` (role initials: system,
user, assistant) by the cheapest edits: Keep a turn (0), give it the role user
or assistant (Rerole, 3), Delete it (4; blank and repeated turns must go) or
Insert an empty turn of user or assistant anywhere (3); a truncated turn that
stays adds 3.  Four states tell what the repaired turns end with: nothing yet,
system, user, assistant.

Reconstruction takes linear space.  A cost vector runs forward from the start
to the middle, another backward from the end to it; the state in which an
optimal repair crosses the middle is chosen, and both halves are solved alike.
Of equally cheap repairs the one whose audit (the edits' initials in order) is
ASCII-least is taken: the forward vector carries, beside each state's cost, the
rank of its best audit among the four.  All audits up to a turn hold as many
letters other than I and end in one, so none is the beginning of another and
the ranks decide ties whatever follows.

Turns are sorted over all tasks and cut into blocks of at most ``BLOCK_ROWS``.
A block gives each conversation in it (of those that another block may
continue, for every state it could start in) its cost vector; only these
summaries of a conversation meet, the same crossing is made between its
blocks, and each block is then solved by itself from its state to the next.  A
conversation may thus be of any length: no task holds more of it than a block
or its summaries (about 200 bytes a block).

Defined results: a null role or text is one space; turns are ordered by number
(nulls first), then role, then the SHA-256 of the text; a null conversation id
is a conversation of its own; rows that repeat all columns are turns of their
own, the later ones repeated turns; an unknown role's initial is no state, so
such a turn is reroled or deleted; other columns are ignored; an empty table
gives empty tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import slots, stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK_ROWS = 4096
# what the repaired turns end with
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ROLES = (None, "system", "user", "assistant")
# a turn's fault
SOUND, BLANK, REPEATED, CUT = range(4)
# an end in which the conversation is closed by what is still missing
CLOSED = -1
NEVER = 1 << 60
_SPACE = r"\x20\x09-\x0D"


# ---- one block: plain dynamic programming over four states --------------------
def _inserts(state: int, to: int) -> list[int] | None:
    """The states passed by the fewest inserted turns from ``state`` to ``to``."""
    steps = []
    while state != to:
        state = ASSISTANT if state == USER else USER
        steps.append(state)
        if len(steps) > 2:
            return None
    return steps


def _actions(state: int, initial: int, fault: int) -> list[tuple[int, int, str]]:
    """(cost, next state, letter) of what may be done with a turn in ``state``."""
    out = [(DELETE, state, "D")]
    if fault not in (BLANK, REPEATED):
        stays = TRUNCATED if fault == CUT else 0
        spoken = ASSISTANT if state == USER else USER
        out.append((REROLE + stays, spoken, "R"))
        if initial == spoken or (initial == SYSTEM and state == NOTHING):
            out.append((KEEP + stays, initial, "K"))
    return out


def _edges(initial: int, fault: int) -> list[list[tuple[int, int, str]]]:
    """For each state after a turn: (state before, cost, audit) of the best way, inserts in front."""
    out = []
    for after in range(4):
        ways = []
        for before in range(4):
            best = None
            for mid in range(4):
                gap = _inserts(before, mid)
                for cost, to, letter in _actions(mid, initial, fault) if gap is not None else ():
                    if to == after:
                        way = (cost + INSERT * len(gap), "I" * len(gap) + letter)
                        best = way if best is None else min(best, way)
            if best is not None:
                ways.append((before, *best))
        out.append(ways)
    return out


EDGES = [[_edges(initial, fault) for fault in range(4)] for initial in range(4)]
# what closes a conversation: nothing to say is a sound end, as is an assistant's turn
CLOSING = [0, 2 * INSERT, INSERT, 0]


def forward(turns: list[tuple[int, int]], lo: int, hi: int, cost: list[int], rank: list[int]) -> tuple[list[int], list[int]]:
    """Cost vector behind turns lo to hi, and the ranks of the states' best audits."""
    for initial, fault in turns[lo:hi]:
        best = []
        for ways in EDGES[initial][fault]:
            way = None
            for before, c, audit in ways:
                if cost[before] < NEVER:
                    w = (cost[before] + c, rank[before], audit)
                    way = w if way is None or w < way else way
            best.append(way)
        order = sorted({w[1:] for w in best if w is not None})
        cost = [NEVER if w is None else w[0] for w in best]
        rank = [len(order) if w is None else order.index(w[1:]) for w in best]
    return cost, rank


def backward(turns: list[tuple[int, int]], lo: int, hi: int, cost: list[int]) -> list[int]:
    """Cost vector in front of turns lo to hi, given the one behind them."""
    for initial, fault in reversed(turns[lo:hi]):
        front = [NEVER] * 4
        for after, ways in enumerate(EDGES[initial][fault]):
            for before, c, _ in ways:
                front[before] = min(front[before], c + cost[after])
        cost = front
    return cost


def _only(state: int) -> list[int]:
    return [0 if s == state else NEVER for s in range(4)]


def behind(end: int) -> list[int]:
    return CLOSING if end == CLOSED else _only(end)


def crossing(cost: list[int], rank: list[int], rest: list[int]) -> int:
    """The state in which the audit-least optimal repair crosses."""
    return min(range(4), key=lambda s: (min(NEVER, cost[s] + rest[s]), rank[s]))


def hirschberg(turns: list[tuple[int, int]], start: int, end: int) -> list[tuple[int, str]]:
    """(state before, audit letters) of each turn on the audit-least optimal repair."""
    out: list[tuple[int, str]] = []

    def solve(lo: int, hi: int, start: int, end: int) -> int:
        if hi - lo == 1:
            cost, rank = forward(turns, lo, hi, _only(start), [0] * 4)
            to = crossing(cost, rank, behind(end))
            out.append((start, next(audit for before, _, audit in EDGES[turns[lo][0]][turns[lo][1]][to] if before == start)))
            return to
        mid = (lo + hi) // 2
        to = crossing(*forward(turns, lo, mid, _only(start), [0] * 4), backward(turns, mid, hi, behind(end)))
        solve(lo, mid, start, to)
        return solve(mid, hi, to, end)

    if turns:
        solve(0, len(turns), start, end)
    return out


# ---- all conversations ----------------------------------------------------------
def key_of(column: str):
    """A conversation's id as text, null apart from every text."""
    return F.when(F.col(column).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(column).cast("string")))


def ordered_turns(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """All turns in order, numbered by ``pos`` and stored; a long conversation lies over several partitions."""
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    rows = df.select(F.col(f"`{id_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text")) \
        .select(key_of("conv_id").alias("key"), "*", F.sha2("text", 256).alias("digest"), F.monotonically_increasing_id().alias("_at"))
    order = ["key", F.asc_nulls_first("turn"), "role", "digest", "_at"]
    rows = rows.repartitionByRange(slots(df.sparkSession), *order).sortWithinPartitions(*order).drop("_at")
    return stage(rows.withColumn("pos", F.monotonically_increasing_id()), "repair-turns")


def _faults(turns: DataFrame) -> DataFrame:
    """Of each turn, without its text: key, pos, blk, initial, fault."""
    blank = ~F.col("text").rlike(f"[^{_SPACE}]")
    cut = F.col("text").rlike(f"[^{_SPACE}.!?][{_SPACE}]*\\z")
    first = turns.groupBy("key", "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("is_first"))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(NOTHING)
    narrow = turns.select("key", "pos", code.alias("initial"), F.when(blank, BLANK).alias("blank"), cut.alias("cut"))
    # both sides by pos, which is unique: no hot key
    return narrow.join(first, "pos", "left").select(
        "key", "pos", F.shiftright("pos", BLOCK_ROWS.bit_length() - 1).alias("blk"), "initial",
        F.coalesce("blank", F.when(F.col("is_first").isNull(), REPEATED), F.when(F.col("cut"), CUT), F.lit(SOUND)).alias("fault"))


def _runs(keys: list[str]) -> Iterator[tuple[int, int]]:
    lo = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[lo]:
            yield lo, i
            lo = i


_LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}


def _summaries(block: pa.Table) -> pa.Table:
    """Each conversation's part in a block: counts, and its cost vectors and ranks from each state it may start in."""
    block = block.sort_by("pos")
    keys, initial, fault = (block.column(c).to_pylist() for c in ("key", "initial", "fault"))
    turns = list(zip(initial, fault, strict=True))
    out = []
    for lo, hi in _runs(keys):
        open_ended = lo == 0 or hi == len(keys)
        vectors = [forward(turns, lo, hi, _only(s), [0] * 4) if s == NOTHING or open_ended else ([NEVER] * 4, [0] * 4) for s in range(4)]
        out.append({"key": keys[lo], "blk": block.column("blk")[0].as_py(), "costs": sum((v[0] for v in vectors), []), "ranks": sum((v[1] for v in vectors), []),
                    "first": initial[lo], "last": initial[hi - 1], "illegal": sum(p not in _LEGAL for p in zip(initial[lo:hi], initial[lo + 1:hi])),
                    **{n: fault[lo:hi].count(k) for n, k in (("blank", BLANK), ("duplicate", REPEATED), ("truncated", CUT))}})
    return pa.Table.from_pylist(out, _SUMMARY)


_COUNTS = ("illegal", "blank", "duplicate", "truncated")
_SUMMARY = pa.schema([("key", pa.string()), ("blk", pa.int64()), ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32())), ("first", pa.int32()), ("last", pa.int32()),
                      *[(c, pa.int64()) for c in _COUNTS]])
_CROSSED = pa.schema([("key", pa.string()), ("blk", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), *[(c, pa.int64()) for c in _COUNTS]])


def _cross(parts: list[dict]) -> list[dict]:
    """The states in which a conversation's repair passes from block to block."""
    costs = [[p["costs"][4 * s:4 * s + 4] for s in range(4)] for p in parts]
    ranks = [[p["ranks"][4 * s:4 * s + 4] for s in range(4)] for p in parts]
    rest = [CLOSING]
    for c in reversed(costs):
        rest.append([min(NEVER, *(c[s][e] + rest[-1][e] for e in range(4))) for s in range(4)])
    out, state = [], NOTHING
    for i, p in enumerate(parts):
        end = crossing(costs[i][state], ranks[i][state], rest[-2 - i])
        last = i == len(parts) - 1
        cost = costs[i][state][end] + (CLOSING[end] if last else 0)
        between = 0 if last or (p["last"], parts[i + 1]["first"]) in _LEGAL else 1
        out.append({"key": p["key"], "blk": p["blk"], "start": state, "end": CLOSED if last else end, "cost": cost,
                    **{c: p[c] for c in _COUNTS}, "illegal": p["illegal"] + between})
        state = end
    return out


def _crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summaries sorted by conversation and block, a conversation at a time."""
    held: list[dict] = []
    for batch in batches:
        rows, out = batch.to_pylist(), []
        for row in rows:
            if held and held[0]["key"] != row["key"]:
                out += _cross(held)
                held = []
            held.append(row)
        yield pa.RecordBatch.from_pylist(out, _CROSSED)
    if held:
        yield pa.RecordBatch.from_pylist(_cross(held), _CROSSED)


_EDITS = pa.schema([("key", pa.string()), ("blk", pa.int64()), ("pos", pa.int64()), ("sub", pa.int32()), ("role", pa.string()), ("own", pa.bool_()), ("audit", pa.string())])


def _solve(block: pa.Table, ends: pa.Table) -> pa.Table:
    """A block's edits: the turns that result (``pos`` and ``sub`` give their
    order) and, on a row without a place, the audit of each conversation's part."""
    block = block.sort_by("pos")
    keys, at = block.column("key").to_pylist(), block.column("pos").to_pylist()
    turns = list(zip(block.column("initial").to_pylist(), block.column("fault").to_pylist(), strict=True))
    way = {e["key"]: (e["start"], e["end"]) for e in ends.select(["key", "start", "end"]).to_pylist()}
    blk = block.column("blk")[0].as_py() if len(keys) else None
    out = []
    for lo, hi in _runs(keys):
        start, end = way[keys[lo]]
        audit, base = [], {"key": keys[lo], "blk": blk, "audit": None}

        def insert(state: int, n: int, pos: int, sub: int, base=base, out=out) -> int:
            for i in range(n):
                state = ASSISTANT if state == USER else USER
                out.append(base | {"pos": pos, "sub": sub + i, "role": ROLES[state], "own": False})
            return state

        state = start
        for i, (before, letters) in enumerate(hirschberg(turns[lo:hi], start, end)):
            n = len(letters) - 1
            state = insert(before, n, at[lo + i], -n)
            if letters[-1] == "K":
                state = turns[lo + i][0]
                out.append(base | {"pos": at[lo + i], "sub": 0, "role": None, "own": True})
            elif letters[-1] == "R":
                state = ASSISTANT if state == USER else USER
                out.append(base | {"pos": at[lo + i], "sub": 0, "role": ROLES[state], "own": True})
            audit.append(letters)
        if end == CLOSED:
            n = CLOSING[state] // INSERT
            insert(state, n, at[hi - 1], 1)
            audit.append("I" * n)
        out.append(base | {"pos": None, "sub": None, "role": None, "own": None, "audit": "".join(audit)})
    return pa.Table.from_pylist(out, _EDITS)


def repair(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(report, repaired turns).

    The report has one row a conversation: conv_id, gaps (turn numbers missing
    between the least and the greatest), blank, duplicate, truncated, illegal,
    cost, audit.  Repaired turns: conv_id, pos and sub (their order), role, text.
    """
    turns = ordered_turns(df, id_col, turn_col, role_col, text_col)
    steps = stage(_faults(turns), "repair-steps")
    parts = steps.groupBy("blk").applyInArrow(_summaries, "key string, blk long, costs array<long>, ranks array<int>, first int, last int, " + ", ".join(f"{c} long" for c in _COUNTS))
    parts = parts.repartition("key").sortWithinPartitions("key", "blk")
    ends = stage(parts.mapInArrow(_crossings, "key string, blk long, start int, end int, cost long, " + ", ".join(f"{c} long" for c in _COUNTS)), "repair-crossings")
    edits = stage(steps.groupBy("blk").cogroup(ends.groupBy("blk")).applyInArrow(
        _solve, "key string, blk long, pos long, sub int, role string, own boolean, audit string"), "repair-edits")
    audits = edits.where("audit is not null").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("blk", "audit"))).alias("a")) \
        .select("key", F.array_join(F.transform("a", lambda x: x["audit"]), "").alias("audit"))
    sums = ends.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")])
    spans = turns.groupBy("key").agg(F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.count_distinct("turn").alias("n"), F.max("conv_id").alias("conv_id"))
    report = spans.join(sums, "key").join(audits, "key").select(
        "conv_id", F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("n"), F.lit(0).cast("bigint")).alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    e = edits.where("audit is null").select("pos", "sub", F.col("role").alias("new_role"), "own")
    fixed = e.join(turns.select("pos", "conv_id", "role", "text"), "pos").select(
        "conv_id", "pos", "sub", F.coalesce("new_role", "role").alias("role"), F.when(F.col("own"), F.col("text")).otherwise("").alias("text"))
    return report, fixed


def digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines, read as a sorted
    stream: no task holds a conversation whole."""
    rows = turns.select(key_of("conv_id").alias("key"), "conv_id", "pos", "sub", F.concat("role", F.lit(":"), "text").alias("line")) \
        .repartition("key").sortWithinPartitions("key", "pos", "sub")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for k, line in zip(batch.column("key").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if k != key:
                    if digest is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(line.encode())
            yield pa.RecordBatch.from_pydict({"key": [k for k, _ in done], "sha256": [d for _, d in done]}, schema=_DIGEST)
        if digest is not None:
            yield pa.RecordBatch.from_pydict({"key": [key], "sha256": [digest.hexdigest()]}, schema=_DIGEST)

    return rows.select("key", "line").mapInArrow(run, "key string, sha256 string")


_DIGEST = pa.schema([("key", pa.string()), ("sha256", pa.string())])
