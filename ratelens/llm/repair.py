r"""Conversation structure repair by Hirschberg's divide and conquer (list item 12).

A conversation is repaired by the cheapest edits that make its roles read
``(s?(ua)+)?``: Keep (0), Rerole to user or assistant (1), Delete (2, the
only choice for blank and repeated rows), Insert an empty turn (5); a
truncated row that stays costs 5 more.  Four states say what was last put
out (nothing, system, user, assistant), so the edits of a row, with the
insertions before it, are one 4 x 4 step of costs.

The reconstruction keeps no table of rows by states.  A forward vector of
four costs runs to the middle, a backward vector comes from the end, and the
state crossed in the middle is the one of least total cost; both halves are
solved again between the now known states.  Among crossings of equal cost
the one with the ASCII-least edits so far is right: edits up to a row end
with that row's own letter, so no one of them is the beginning of another
and the first difference decides.  The forward vector therefore carries,
beside each cost, the rank of its edits among the four.

On Spark: rows get global numbers in (conversation, turn, role, text) order;
a conversation is cut into segments at every ``SEGMENT`` rows.  Tasks reduce
each segment to its 4 x 4 costs and ranks, which compose like single steps:
Hirschberg over the segments of a conversation (one short row for each
``SEGMENT`` rows) fixes the states at their borders, then every segment is
solved in its own task.  So the longest conversation is dealt out like many
short ones.  Repeated rows are found by the least row number of each
(conversation, role, text digest), summed map-side.

Edge cases: a null role or text reads as one space (a text of one space is
blank); a null turn comes first and counts for no gap; a null conversation id
is one conversation; equal turns are ordered by role and text; a role that
starts with none of s, u, a cannot be kept; conversations without rows left
get zeros, empty edits and no rows; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from typing import Any, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, written
from .sharding import number_rows

#: rows of a segment
SEGMENT = 4096
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_INITIALS = "sua"
NO_FAULT, BLANK, DUPLICATE, CUT_OFF = range(4)
_SPACE = " \t\n\x0b\x0c\r"

#: one step: for every state before, {state after: (cost, edits)}; edits need only be comparable within a row
Step = Sequence[dict[int, tuple[int, Any]]]


# ---- steps and Hirschberg's reconstruction

def _next_role(state: int) -> int:
    return ASSISTANT if state == USER else USER


def row_step(code: int) -> Step:
    """Cheapest edits of a row with ``code`` = 4 * fault + initial (s, u, a, other), insertions before it included."""
    fault, initial = divmod(code, 4)
    out: list[dict[int, tuple[int, str]]] = []
    for start in range(4):
        best: dict[int, tuple[int, str]] = {}
        state = start
        for inserted in range(3):  # a third insertion in a row only repeats the state after the first
            extra = TRUNCATED if fault == CUT_OFF else 0
            choices = [(state, DELETE, "D")]
            if fault not in (BLANK, DUPLICATE):
                choices.append((_next_role(state), REROLE + extra, "R"))
                if (initial == 0 and state == NOTHING) or (initial in (1, 2) and _next_role(state) == USER + initial - 1):
                    choices.append((SYSTEM + initial, KEEP + extra, "K"))
            for after, cost, letter in choices:
                option = (INSERT * inserted + cost, "I" * inserted + letter)
                best[after] = min(best.get(after, option), option)
            state = _next_role(state)
        out.append(best)
    return out


ROW_STEPS: list[Step] = [row_step(code) for code in range(16)]
#: the end of a conversation is reached in NOTHING (no rows) or after an assistant
END_STEP: Step = [{0: (0, "")}, {0: (2 * INSERT, "II")}, {0: (INSERT, "I")}, {0: (0, "")}]


def forward(steps: Sequence[Step], start: int) -> dict[int, tuple[int, int]]:
    """Reached state -> (least cost, rank of its least edits among the reached states)."""
    at = {start: (0, 0)}
    for step in steps:
        best: dict[int, tuple[int, int, Any]] = {}
        for state, (cost, rank) in at.items():
            for after, (more, edits) in step[state].items():
                option = (cost + more, rank, edits)
                if after not in best or option < best[after]:
                    best[after] = option
        order = sorted(best, key=lambda s: best[s][1:])
        at = {s: (best[s][0], k) for k, s in enumerate(order)}
    return at


def backward(steps: Sequence[Step], end: int) -> dict[int, int]:
    """State -> least cost from it to ``end``."""
    to = {end: 0}
    for step in reversed(steps):
        costs = {s: min((more + to[after] for after, (more, _) in step[s].items() if after in to), default=None) for s in range(4)}
        to = {s: c for s, c in costs.items() if c is not None}
    return to


def crossings(steps: Sequence[Step], start: int, end: int) -> list[int]:
    """States before every step and after the last on the cheapest way whose edits are ASCII-least."""
    if len(steps) < 2:
        return [start, end][:len(steps) + 1]
    mid = len(steps) // 2
    there, back = forward(steps[:mid], start), backward(steps[mid:], end)
    cross = min((cost + back[s], rank, s) for s, (cost, rank) in there.items() if s in back)[2]
    return crossings(steps[:mid], start, cross)[:-1] + crossings(steps[mid:], cross, end)


def segment_step(codes: bytes) -> Step:
    """A segment's rows as one step; the edits are ranks."""
    steps = [ROW_STEPS[c] for c in codes]
    return [forward(steps, s) for s in range(4)]


def segment_edits(codes: bytes, start: int, end: int) -> str:
    """The least edits of a segment between known states."""
    steps = [ROW_STEPS[c] for c in codes]
    states = crossings(steps, start, end)
    return "".join(step[a][b][1] for step, a, b in zip(steps, states, states[1:]))


# ---- rows, faults, segments

def damaged(rows: DataFrame) -> DataFrame:
    """The rows of ``conversations`` after the damage that crc32 of "conv_id:turn" deals out, as __conv, conv_id, turn, role, text."""
    def text_of(name: str) -> Column:
        return F.coalesce(quoted(name).cast("string"), F.lit(" "))

    deal = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    text = F.when(deal == 1, F.lit("")).when(deal == 2, F.regexp_replace(text_of("text"), "[.!?]", "")).otherwise(text_of("text"))
    times = F.when(deal == 0, F.lit(0)).when(deal == 3, F.lit(2)).otherwise(F.lit(1))
    return (rows.withColumn("__times", times)
            .select("conv_id", "turn", F.when(deal == 4, F.lit("user")).otherwise(text_of("role")).alias("role"), text.alias("text"),
                    F.explode(F.array_repeat(F.lit(0), F.col("__times"))).alias("__again")).drop("__again"))


def numbered(rows: DataFrame) -> DataFrame:
    """__conv, conv_id, turn, role, text, row (global number), seg; null roles and texts are one space."""
    plain = rows.select("conv_id", quoted("turn").cast("bigint").alias("turn"), F.coalesce(quoted("role").cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(quoted("text").cast("string"), F.lit(" ")).alias("text"))
    placed = number_rows(plain, ["conv_id", "turn", "role", "text"])
    return placed.select(conv_key().alias("__conv"), "*", F.expr(f"row div {SEGMENT}").alias("seg"))


def conv_key() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


def row_codes(rows: DataFrame) -> DataFrame:
    """__conv, seg, row, turn, code: 4 * first fault + initial of every numbered row."""
    bare = F.rtrim("text", F.lit(_SPACE))
    narrow = rows.select("__conv", "seg", "row", "turn", "role", F.md5("text").alias("__digest"), (bare == "").alias("blank"),
                         F.right(bare, F.lit(1)).isin(".", "!", "?").alias("whole"))
    same = ["__conv", "role", "__digest"]
    repeated = narrow.groupBy(*same).agg(F.min("row").alias("__first"), F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n")
    fault = (F.when(F.col("blank"), BLANK).when(F.col("row") > F.col("__first"), DUPLICATE)
             .when(~F.col("whole"), CUT_OFF).otherwise(NO_FAULT))
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    return narrow.join(repeated, same, "left").select("__conv", "seg", "row", "turn", (4 * fault + initial).alias("code"))


_SEGMENT_T = ("__conv string, seg bigint, codes binary, least_turn bigint, most_turn bigint, n_turns bigint, "
              "steps array<array<bigint>>")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (conversation, segment, row) to one row a segment."""
    schema = pa.schema([("__conv", pa.string()), ("seg", pa.int64()), ("codes", pa.binary()), ("least_turn", pa.int64()),
                        ("most_turn", pa.int64()), ("n_turns", pa.int64()), ("steps", pa.list_(pa.list_(pa.int64())))])

    def reduced(key: tuple, codes: list[int], turns: list) -> tuple:
        known = [t for t in turns if t is not None]
        step = segment_step(bytes(codes))
        flat = [[s, after, cost, rank] for s in range(4) for after, (cost, rank) in step[s].items()]
        return (*key, bytes(codes), known[0] if known else None, known[-1] if known else None, len(set(known)), flat)

    key, codes, turns, done = None, [], [], []
    for b in batches:
        for conv, seg, turn, code in zip(*(b.column(k).to_pylist() for k in ("__conv", "seg", "turn", "code"))):
            if key != (conv, seg):
                if codes:
                    done.append(reduced(key, codes, turns))
                key, codes, turns = (conv, seg), [], []
            codes.append(code)
            turns.append(turn)
        if len(done) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
            done = []
    if codes:
        done.append(reduced(key, codes, turns))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_PATHS_T = "__conv string, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", path array<struct<seg: bigint, `from`: int, `to`: int, after: string>>"


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of a conversation to its counts and the states at the segments' borders."""
    path_t = pa.list_(pa.struct([("seg", pa.int64()), ("from", pa.int32()), ("to", pa.int32()), ("after", pa.string())]))
    legal = {(0, 1), (1, 2), (2, 1)}
    for b in batches:
        rows = []
        for conv, segments in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            segments.sort(key=lambda s: s["seg"])
            steps: list[Step] = []
            seen, turns, last, illegal = np.zeros(4, np.int64), 0, None, 0
            before = None
            for s in segments:
                step: list[dict] = [{}, {}, {}, {}]
                for start, after, cost, rank in s["steps"]:
                    step[start][after] = (cost, rank)
                steps.append(step)
                codes = np.frombuffer(s["codes"], np.uint8)
                seen += np.bincount(codes >> 2, minlength=4)
                initials = [*([] if before is None else [before]), *(codes & 3).tolist()]
                illegal += sum(pair not in legal for pair in zip(initials, initials[1:]))
                before = initials[-1]
                turns += s["n_turns"] - (last is not None and s["least_turn"] == last)
                last = last if s["most_turn"] is None else s["most_turn"]
            known = [s["least_turn"] for s in segments if s["least_turn"] is not None]
            gaps = last - known[0] + 1 - turns if known else 0
            steps.append(END_STEP)
            states = crossings(steps, NOTHING, 0)
            cost = sum(step[x][y][0] for step, x, y in zip(steps, states, states[1:]))
            after = END_STEP[states[-2]][0][1]
            path = [{"seg": s["seg"], "from": x, "to": y, "after": after if k == len(segments) - 1 else ""}
                    for k, (s, x, y) in enumerate(zip(segments, states, states[1:]))]
            rows.append((conv, gaps, *(int(seen[f]) for f in (BLANK, DUPLICATE, CUT_OFF)), illegal, cost, path))
        cols = list(zip(*rows)) or [()] * (len(COUNTS) + 2)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.string(), *[pa.int64()] * len(COUNTS), path_t])],
                                         names=["__conv", *COUNTS, "path"])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """codes, from, to, after -> the segment's edits."""
    for b in batches:
        out = [segment_edits(codes, start, end) + after
               for codes, start, end, after in zip(*(b.column(k).to_pylist() for k in ("codes", "from", "to", "after")))]
        yield pa.RecordBatch.from_arrays([b.column("__conv"), b.column("seg"), b.column("from"), pa.array(out, pa.string())],
                                         names=["__conv", "seg", "from", "edits"])


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(conversations, edits, rows) of conv_id, turn, role, text rows.

    conversations: __conv and COUNTS; edits: __conv, seg, from (state before
    the segment), edits (letters of the segment's rows in order); rows: the
    numbered rows, for ``repaired_rows``.
    """
    rows = numbered(rows)
    coded = row_codes(rows).repartition("__conv", "seg").sortWithinPartitions("__conv", "seg", "row")
    segments = written(coded.mapInArrow(_segments, _SEGMENT_T), "segments")
    shapes = F.struct("seg", "codes", "least_turn", "most_turn", "n_turns", "steps")
    paths = written(segments.groupBy("__conv").agg(F.collect_list(shapes).alias("s")).mapInArrow(_paths, _PATHS_T), "paths")
    borders = paths.select("__conv", F.explode("path").alias("p")).select("__conv", "p.*")
    edits = segments.select("__conv", "seg", "codes").join(borders, ["__conv", "seg"]).mapInArrow(
        _edits, "__conv string, seg bigint, `from` int, edits string")
    return paths.drop("path"), written(edits, "edits"), rows


# ---- repaired rows

def _in_order(rows: DataFrame, edits: DataFrame, by: list[str]) -> DataFrame:
    """Each segment's edits, then its rows, partitioned by ``by`` and sorted by conversation and row."""
    none = F.lit(None)
    leading = edits.select("__conv", "seg", F.lit(-1).cast("long").alias("row"), none.cast("string").alias("role"),
                           none.cast("string").alias("text"), "from", "edits")
    told = rows.select("__conv", "seg", "row", "role", "text", none.cast("int").alias("from"), none.cast("string").alias("edits"))
    return told.unionByName(leading).repartition(*by).sortWithinPartitions("__conv", "seg", "row")


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, str, str, str]]:
    """(conversation, row, number at the row, role, text, edit) of what the edits put out, in order."""
    names = ["", "", "user", "assistant"]
    state, edits, at, tail = NOTHING, "", 0, 0
    for b in batches:
        for conv, row, role, text, start, told in zip(*(b.column(k).to_pylist() for k in ("__conv", "row", "role", "text", "from", "edits"))):
            if row < 0:
                state, edits, at, tail = start, told, 0, len(told.rstrip("I"))
                continue
            part, mine = 0, False
            while at < len(edits) and (not mine or at >= tail):  # insertions before the row, its own letter; at the end those after it
                letter = edits[at]
                at += 1
                if letter == "D":
                    mine = True
                    continue
                if letter == "K":
                    mine, state = True, SYSTEM + _INITIALS.index(role[0])
                    yield conv, row, part, role, text, letter
                else:
                    mine, state = mine or letter == "R", _next_role(state)
                    yield conv, row, part, names[state], "" if letter == "I" else text, letter
                part += 1


def repaired_rows(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """__conv, row, part, role, text, edit: the repaired conversations; order by row and part."""
    schema = pa.schema([("__conv", pa.string()), ("row", pa.int64()), ("part", pa.int32()), ("role", pa.string()),
                        ("text", pa.string()), ("edit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for out in _replay(batches):
            held.append(out)
            if len(held) >= 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    return _in_order(rows, edits, ["__conv", "seg"]).mapInArrow(
        run, "__conv string, row bigint, part int, role string, text string, edit string")


def repaired_digests(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """__conv, repaired_sha256 of the repaired ``role:text`` lines; a digest has one order, so a conversation streams through one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(done):
            return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1].hexdigest() for d in done], pa.string())],
                                              names=["__conv", "repaired_sha256"])
        done: list = []
        for conv, _, _, role, text, _ in _replay(batches):
            if done and done[-1][0] == conv:
                done[-1][1].update(f"\n{role}:{text}".encode())
            else:
                if len(done) >= 4096:
                    yield out(done)
                    done = []
                done.append((conv, hashlib.sha256(f"{role}:{text}".encode())))
        if done:
            yield out(done)

    return _in_order(rows, edits, ["__conv"]).mapInArrow(run, "__conv string, repaired_sha256 string")


def repair_report(original: DataFrame, rows: DataFrame) -> DataFrame:
    """conv_id of every conversation of ``original`` with COUNTS, audit (all edits in order) and repaired_sha256 of its ``rows``."""
    counts, edits, placed = repair(rows)
    audits = edits.groupBy("__conv").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", "edits"))), lambda x: x["edits"]), "").alias("audit"))
    ids = original.select("conv_id").distinct().withColumn("__conv", conv_key())
    out = ids.join(counts, "__conv", "left").join(audits, "__conv", "left").join(repaired_digests(placed, edits), "__conv", "left")
    zero = F.lit(0).cast("long")
    return out.select("conv_id", *[F.coalesce(c, zero).alias(c) for c in COUNTS], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
