"""Conversation structure repair: the cheapest edits that make roles alternate, found by iterative-deepening A*."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from readflow.session import materialize

#: Characters that do not count as text.
BLANKS = " \t\n\x0b\x0c\r"
#: Costs of the edits Delete, Insert, Keep and Rerole, and what an undeleted truncated row adds.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: Where a conversation may stand: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
DONE = (START, ASSISTANT)
#: The state after an inserted or reroled row, by the state before it.
NEXT = (USER, USER, ASSISTANT, USER)
#: Rows that are searched at once; longer conversations are searched piece by piece and the pieces joined.
PIECE = 32
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: A row's code is 0 to 3 (initial s, u, a or another) and one of these.
_FINE, _CUT_OFF, _MUST_GO = 0, 4, 8
#: Codes of fine rows that may follow one another.
_HARMONY = {(0, 1), (1, 2), (2, 1)}


def _least_costs(codes: bytes) -> list[int]:
    """Per place a lower bound on the cost of the rows from there on.

    A faulty row costs its deletion at least; of two fine neighbours whose roles may not follow one
    another, at least one is edited, or something comes between; such pairs are counted disjointly.
    """
    bounds, after = [0] * (len(codes) + 1), None
    for i in range(len(codes) - 1, -1, -1):
        code, more = codes[i], 0
        if code >= _CUT_OFF:
            more = DELETE
        elif code == 3 or (after is not None and (code, after) not in _HARMONY):
            more, after = REROLE, None
        else:
            after = code
        bounds[i] = bounds[i + 1] + more
    return bounds


def cheapest(codes: bytes, start: int = START, goals: tuple[int, ...] = DONE, last: bool = True) -> tuple[int, str] | None:
    """(cost, initials of the edits) of the cheapest way from ``start`` through all rows to one of ``goals``, the
    ASCII-least of them; None if there is none.

    Iterative deepening: depth-first search tries the edits in ASCII order under a bound on cost plus
    ``_least_costs``; a bound that fails is raised by the least that was lacking anywhere. States that
    failed are remembered with the budget they are known to need, so that none is searched twice with
    too little. As nothing cheaper exists and edits are tried in order, the first accepting path is the answer.
    Only the ``last`` piece of a conversation may end in insertions, so that a path has one form.
    """
    n, bounds = len(codes), _least_costs(codes)
    if not last and not _reachable(codes, start, goals):
        return None
    needs: dict[tuple[int, int], int] = {}
    path: list[str] = []

    def moves(i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        if i < n:
            yield "D", DELETE, state, i + 1
        if i < n or last:
            yield "I", INSERT, NEXT[state], i
        if i < n and codes[i] < _MUST_GO:
            extra, role = (TRUNCATED if codes[i] >= _CUT_OFF else 0), codes[i] % 4
            if role == 0 and state == START:
                yield "K", extra, SYSTEM, i + 1
            elif role == NEXT[state] - 1:
                yield "K", extra, NEXT[state], i + 1
            yield "R", REROLE + extra, NEXT[state], i + 1

    def lacking(i: int, state: int, left: int) -> float:
        """What the budget ``left`` lacks from here on; 0 if it was enough, ``path`` then is the way."""
        if i == n and state in goals:
            return 0
        least = float("inf")
        for edit, cost, to, at in moves(i, state):
            lack = needs.get((at, to), bounds[at]) - left + cost
            if lack <= 0:
                path.append(edit)
                lack = lacking(at, to, left - cost)
                if not lack:
                    return 0
                path.pop()
            least = min(least, lack)
        needs[i, state] = left + least
        return least

    budget = bounds[0]
    while more := lacking(0, start, budget):
        budget += more
    return budget, "".join(path)


def _reachable(codes: bytes, start: int, goals: tuple[int, ...]) -> bool:
    """Whether any way leads from ``start`` to one of ``goals`` before the last piece."""
    system = start == START and any(c < _MUST_GO and c % 4 == 0 for c in codes)
    return any(g in (USER, ASSISTANT) or g == start or (g == SYSTEM and system) for g in goals)


def plan_edits(codes: bytes, piece: int = PIECE) -> tuple[int, str]:
    """(cost, audit) of a whole conversation: one byte a row in, one letter an edit out.

    Pieces of ``piece`` rows are searched for every state before and after them, and joined from the
    end on: the work grows in proportion with the rows, however many edits a conversation needs. Two
    ways through a piece with equal sums of cost differ inside the piece, so the smaller one there is
    the smaller one altogether.
    """
    cuts = list(range(0, max(len(codes), 1), piece))
    best: list[tuple[int, str, int] | None] = [(0, "", s) if s in DONE else None for s in range(4)]
    chosen = []
    for k, first in reversed(list(enumerate(cuts))):
        part, last = codes[first : first + piece], k == len(cuts) - 1
        here: list[tuple[int, str, int] | None] = []
        for start in range(4) if k else (START,):
            ways = []
            if last:
                cost, audit = cheapest(part, start)
                ways.append((cost, audit, START))
            else:
                for end in range(4):
                    if best[end] is not None and (found := cheapest(part, start, (end,), False)):
                        ways.append((found[0] + best[end][0], found[1], end))
            here.append(min(ways, default=None))
        chosen.append(here)
        best = here
    state, audit = START, []
    for here in reversed(chosen):
        _, own, state = here[state]
        audit.append(own)
    return best[START][0], "".join(audit)


def examine(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every row of every conversation with its place and faults: conv, place (from 1), turn, role, text, fault, first_of_turn, illegal.

    Rows stand by turn (nulls first), then role, then text. ``fault`` is the first that holds of
    ``blank`` (nothing but ASCII blanks), ``duplicate`` (role and text stood earlier) and ``truncated`` (the last
    character that is no blank is none of ``.!?``), else null. A null role or text counts as one blank;
    rows with a null key are one conversation. Other columns are not read. Places come from a sort
    by conversation that may spill; what stood earlier is the least place per role and text.
    """
    order = W.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "role", "text")
    before = F.lag(F.substring("role", 1, 1)).over(order)
    placed = rows.select(
        F.col(key).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    placed = placed.select(
        "*", F.row_number().over(order).cast("bigint").alias("place"), before.alias("before"),
        (F.col("turn").isNotNull() & ~F.coalesce(F.lag("turn").over(order) == F.col("turn"), F.lit(False))).alias("first_of_turn"))
    placed = materialize(placed, "turns")
    seen = placed.groupBy("conv", "role", F.md5(F.col("text").cast("binary")).alias("m")).agg(F.min("place").alias("p"))
    seen = seen.select(F.col("conv").alias("c"), "p", F.lit(True).alias("fresh"))
    trimmed = F.rtrim("text", F.lit(BLANKS))
    fault = (
        F.when(trimmed == "", "blank").when(F.col("fresh").isNull(), "duplicate")
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "truncated"))
    pair = F.concat("before", F.substring("role", 1, 1))
    return (
        placed.join(seen, F.col("conv").eqNullSafe(F.col("c")) & (F.col("place") == F.col("p")), "left")
        .select("conv", "place", "turn", "role", "text", fault.alias("fault"), "first_of_turn",
                (F.col("before").isNotNull() & ~pair.isin("su", "ua", "au")).alias("illegal")))


def row_code(role: Column, fault: Column) -> Column:
    """A row as one small number: what its role's initial is, and whether it must go or is cut off."""
    initial = F.substring(role, 1, 1)
    kind = F.when(fault.isin("blank", "duplicate"), _MUST_GO).when(fault == "truncated", _CUT_OFF).otherwise(_FINE)
    known = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return (kind + known).cast("tinyint")


def repair_plans(turns: DataFrame) -> DataFrame:
    """(conv, cost, audit) for every conversation of ``examine``'s rows.

    A task sees its conversations in order, one row after the other, and keeps one byte per row of
    the one at hand.
    """
    kind = turns.schema["conv"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ends in _runs(batches):
            made = [(conv, *plan_edits(bytes(codes))) for conv, codes in ends]
            yield pa.RecordBatch.from_arrays(
                [pa.array([m[0] for m in made], batch.schema.field(0).type), pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.string())],
                names=["conv", "cost", "audit"])

    rows = turns.select("conv", row_code(F.col("role"), F.col("fault")).alias("code"), "place")
    return rows.repartition("conv").sortWithinPartitions("conv", "place").mapInArrow(search, f"conv {kind}, cost bigint, audit string")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[tuple]]]:
    """Per batch the conversations that ended in it: (key, bytes of its rows); the last batch ends the last one."""
    held: tuple | None = None
    batch = None
    for batch in batches:
        ends = []
        for conv, code in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held is None or held[0] != conv:
                if held is not None:
                    ends.append(held)
                held = (conv, bytearray())
            held[1].append(code)
        if ends:
            yield batch, ends
    if held is not None:
        yield batch, [held]


def repaired_turns(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired conversations row by row: conv, at (from 1), edit (Keep, Rerole or Insert), turn, role, text.

    A plan goes ahead of its conversation's rows and is read along with them; inserted rows have an
    empty text and no turn. A conversation whose rows are all deleted has none.
    """
    schema = turns.schema
    kind, turn_kind = schema["conv"].dataType.simpleString(), schema["turn"].dataType.simpleString()

    def carry_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, at, state, out = "", 0, START, 0

        def insertions(conv):
            nonlocal at, state, out
            while at < len(plan) and plan[at] == "I":
                state, at, out = NEXT[state], at + 1, out + 1
                yield conv, out, "Insert", None, ROLES[state], ""

        for batch in batches:
            made = []
            for conv, place, turn, role, text, audit in zip(*(c.to_pylist() for c in batch.columns)):
                if not place:
                    plan, at, state, out = audit, 0, START, 0
                else:
                    edit, at = plan[at], at + 1
                    if edit != "D":
                        if edit == "R":
                            role = ROLES[NEXT[state]]
                        state, out = SYSTEM if edit == "K" and role[:1] == "s" else NEXT[state], out + 1
                        made.append((conv, out, "Keep" if edit == "K" else "Rerole", turn, role, text))
                made.extend(insertions(conv))
            columns = list(zip(*made)) or [()] * 6
            types = [batch.schema.field(0).type, pa.int64(), pa.string(), batch.schema.field(2).type, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["conv", "at", "edit", "turn", "role", "text"])

    heads = plans.select("conv", F.lit(0).cast("bigint").alias("place"), F.lit(None).cast(turn_kind).alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), "audit")
    rows = heads.unionByName(turns.select("conv", "place", "turn", "role", "text", F.lit("").alias("audit")))
    placed = rows.repartition("conv").sortWithinPartitions("conv", "place")
    return placed.mapInArrow(carry_out, f"conv {kind}, at bigint, edit string, turn {turn_kind}, role string, text string")


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, sha256) of each conversation's ``role:text``, joined by line ends; rows pass one by one, none are gathered."""
    kind = repaired.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, field = None, None, None
        for batch in batches:
            made, field = [], batch.schema.field(0).type
            for here, role, text in zip(*(c.to_pylist() for c in batch.columns[:3])):
                line = f"{role}:{text}".encode()
                if state is None or here != conv:
                    if state is not None:
                        made.append((conv, state.hexdigest()))
                    conv, state = here, hashlib.sha256(line)
                else:
                    state.update(b"\n" + line)
            if made:
                yield out(made, field)
        if state is not None:
            yield out([(conv, state.hexdigest())], field)

    def out(made, field):
        return pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], field), pa.array([m[1] for m in made], pa.string())], names=["conv", "sha256"])

    rows = repaired.select("conv", "role", "text", "at").repartition("conv").sortWithinPartitions("conv", "at")
    return rows.mapInArrow(run, f"conv {kind}, sha256 string")


def report(turns: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal) per conversation; ``gaps`` are the turns missing between the first and the last."""
    def count(which: Column) -> Column:
        return F.sum(which.cast("bigint"))

    gaps = F.max("turn") - F.min("turn") + 1 - count(F.col("first_of_turn"))
    faults = [count(F.coalesce(F.col("fault") == f, F.lit(False))).alias(f) for f in ("blank", "duplicate", "truncated")]
    return turns.groupBy("conv").agg(F.coalesce(gaps, F.lit(0)).cast("bigint").alias("gaps"), *faults, count(F.col("illegal")).alias("illegal"))


def repair(rows: DataFrame, key: str = "conv_id", **names) -> tuple[DataFrame, DataFrame]:
    """(repaired rows as in ``repaired_turns``, one row per conversation: conv, counts of faults, cost, audit).

    A good conversation is an optional system row and then pairs of user and assistant, or nothing.
    Edits: Keep, Rerole to user or assistant, Delete (blank and duplicate rows must go), Insert an
    empty row; of the cheapest ways the one whose initials are smallest in ASCII. Roles count by
    their initial; an empty role has none and cannot be kept. An empty table gives two empty ones.
    """
    turns = materialize(examine(rows, key, **names), "examined")
    plans = materialize(repair_plans(turns), "repair-plans")
    found = report(turns).withColumnRenamed("conv", "c")
    counts = plans.join(found, F.col("conv").eqNullSafe(F.col("c"))).drop("c")
    return repaired_turns(turns, plans), counts
