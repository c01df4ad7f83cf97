"""Conversation structure repair by Hirschberg's divide and conquer over a four-state machine.

A repaired conversation has the role initials ``(s?(ua)+)?``. Its states are 0 (nothing said yet),
1 (behind the system turn), 2 (behind a user turn) and 3 (behind an assistant turn, where it may end).
The cheapest way through the states is found without a table of all turns: costs from the front and
from the back meet in the middle, the crossing is fixed, and both halves are solved likewise. Long
conversations are cut into blocks that are summed up, crossed and solved by many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import chain
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from millrace.llm.common import stored

# White space, signs that end a text, and the costs of the edits.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1
# The state behind a new turn, whose role follows from the state before it.
ONWARD = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
LEGAL = ("su", "ua", "au")
# What is added to end in state 3, or in state 0 with nothing said.
CLOSING = ("", "II", "I", "")
# Kinds of turns: x must go; else the initial of the role (o is any other), a capital if cut off.
KINDS = "xsuaoSUAO"
STATES = range(4)
NEVER = 1 << 40
BLOCK_TURNS = 8192

# For each state before and each behind: cost, and the place of the edits' text among all that
# start in the same state.
Step = tuple[tuple[tuple[int, int], ...], ...]
# For each state: cost less the least of all, and the place of the edits so far among the states'.
Front = tuple[tuple[int, int], ...]


def _edits(kind: str) -> list[dict[int, tuple[int, str]]]:
    """For each state before a turn and each behind it the cheapest edits, ASCII-least of equals."""
    out: list[dict[int, tuple[int, str]]] = []
    for before in STATES:
        found: list[tuple[int, int, str]] = []
        state = before
        # More than two insertions come back to a state that fewer reach.
        for inserted in range(3):
            cost, letters = INSERT * inserted, "I" * inserted
            found.append((state, cost + DELETE, f"{letters}D"))
            if kind != "x":
                cost += CUT_OFF * kind.isupper()
                behind = KEPT.get(kind.lower(), {}).get(state)
                if behind is not None:
                    found.append((behind, cost + KEEP, f"{letters}K"))
                found.append((ONWARD[state], cost + REROLE, f"{letters}R"))
            state = ONWARD[state]
        best: dict[int, tuple[int, str]] = {}
        for behind, cost, letters in sorted(found, key=lambda x: x[1:]):
            best.setdefault(behind, (cost, letters))
        out.append(best)
    return out


EDITS = {kind: _edits(kind) for kind in KINDS}


def _step(edits: list[dict[int, tuple[int, str]]]) -> Step:
    rows = []
    for best in edits:
        places = {letters: k for k, letters in enumerate(sorted(letters for _, letters in best.values()))}
        rows.append(tuple((best[t][0], places[best[t][1]]) if t in best else (NEVER, 0) for t in STATES))
    return tuple(rows)


STEPS: dict[str, Step] = {kind: _step(edits) for kind, edits in EDITS.items()}


def _start(state: int) -> Front:
    return tuple((0 if s == state else NEVER, 0) for s in STATES)


def _advanced(front: Front, step: Step) -> tuple[Front, int]:
    """The front behind one more turn or block, and by how much its least cost has grown.

    All texts of edits to one place hold the same number of letters that take a turn, and end in one;
    so none begins another, and the order of two that differ is settled where they first do.
    """
    best: list[tuple[int, tuple[int, int]]] = []
    for behind in STATES:
        best.append(
            min(
                (min(front[s][0] + step[s][behind][0], NEVER), (front[s][1], step[s][behind][1]))
                for s in STATES
            )
        )
    least = min(cost for cost, _ in best)
    order = sorted({place for cost, place in best if cost < NEVER})
    return tuple((cost - least, order.index(place)) if cost < NEVER else (NEVER, 0) for cost, place in best), least


def _retreated(back: tuple[int, ...], step: Step) -> tuple[int, ...]:
    """Costs from each state to the end, with one more turn or block before; less the least."""
    costs = [min(min(step[s][t][0] + back[t], NEVER) for t in STATES) for s in STATES]
    least = min(costs)
    return tuple(c - least if c < NEVER else NEVER for c in costs)


# Differences of costs are small, so few fronts occur and a turn is one look-up.
@lru_cache(maxsize=1 << 16)
def _advanced_by(front: Front, kind: str) -> tuple[Front, int]:
    return _advanced(front, STEPS[kind])


@lru_cache(maxsize=1 << 16)
def _retreated_by(back: tuple[int, ...], kind: str) -> tuple[int, ...]:
    return _retreated(back, STEPS[kind])


def crossings(
    items: Sequence[Any],
    first: int,
    last: int,
    advanced: Callable[[Front, Any], tuple[Front, int]],
    retreated: Callable[[tuple[int, ...], Any], tuple[int, ...]],
) -> list[int]:
    """The states between the items on the cheapest way from ``first`` to ``last``, both included.

    Of ways that cost the same it is the one with the ASCII-least edits. Memory is linear.
    """
    states = [first] * len(items) + [last]
    todo = [(0, len(items), first, last)]
    while todo:
        low, high, before, behind = todo.pop()
        states[low] = before
        if high - low < 2:
            continue
        middle = (low + high) // 2
        front = _start(before)
        for k in range(low, middle):
            front = advanced(front, items[k])[0]
        back = tuple(0 if s == behind else NEVER for s in STATES)
        for k in range(high - 1, middle - 1, -1):
            back = retreated(back, items[k])
        crossing = min(STATES, key=lambda s: (min(front[s][0] + back[s], NEVER), front[s][1]))
        todo += [(low, middle, before, crossing), (middle, high, crossing, behind)]
    return states


@lru_cache(maxsize=1 << 10)
def block_step(kinds: str) -> Step:
    """What a block of turns costs from each state to each, and the order of its edits."""
    rows = []
    for before in STATES:
        front, total = _start(before), 0
        for kind in kinds:
            front, grown = _advanced_by(front, kind)
            total += grown
        rows.append(tuple((min(cost + total, NEVER), place) for cost, place in front))
    return tuple(rows)


def solve_block(kinds: str, first: int, last: int) -> str:
    """The edits of a block between two states."""
    states = crossings(kinds, first, last, _advanced_by, _retreated_by)
    return "".join(EDITS[k][s][t][1] for k, s, t in zip(kinds, states, states[1:]))


@lru_cache(maxsize=1 << 15)
def _solve_short(kinds: str, first: int, last: int) -> str:
    return solve_block(kinds, first, last)


def chain_blocks(steps: Sequence[Step]) -> tuple[int, list[int]]:
    """Cost of a conversation of blocks, closed by what is missing, and the states between them."""
    front, total = _start(0), 0
    for step in steps:
        front, grown = _advanced(front, step)
        total += grown
    closed = [(cost + INSERT * len(CLOSING[s]), place, s) for s, (cost, place) in enumerate(front)]
    cost, _, last = min(closed)
    return cost + total, crossings(steps, 0, last, _advanced, _retreated)


def audit_of(kinds: str) -> tuple[int, str]:
    """Cost and edits of a whole conversation."""
    cost, states = chain_blocks([STEPS[k] for k in kinds])
    letters = "".join(EDITS[k][s][t][1] for k, s, t in zip(kinds, states, states[1:]))
    return cost, letters + CLOSING[states[-1]]


# --- on Spark ---------------------------------------------------------------------------


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def _written(rows: Iterator[tuple], schema: pa.Schema, most: int = 2048) -> Iterator[pa.RecordBatch]:
    """Record batches of rows as they come; one of long texts is closed early."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) == most or size > 4_000_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _streamed(df: DataFrame, schema: StructType, each: Callable[[Iterator[tuple]], Iterator[tuple]]) -> DataFrame:
    """``each`` over the rows of every partition, in their order and without holding them."""
    from pyspark.sql.pandas.types import to_arrow_schema

    types = to_arrow_schema(schema)
    return df.mapInArrow(lambda batches: _written(each(_rows(batches)), types), schema)


def _facts(rows: DataFrame) -> DataFrame:
    """One row per distinct turn (``conv, turn, role, digest``) with ``text``, its number of copies
    ``n``, what is wrong with it, and ``kinds``, a letter for each copy."""
    text = F.col("text")
    distinct = rows.withColumn("digest", F.sha2(text, 256)).groupBy("conv", "turn", "role", "digest")
    distinct = stored(distinct.agg(F.first("text").alias("text"), F.count("*").alias("n")))
    trimmed = F.rtrim(text, F.lit(BLANKS))
    facts = distinct.withColumns(
        {
            "blank": trimmed == "",
            "cut_off": ~F.right(trimmed, F.lit(1)).isin(*ENDS),
            "initial": F.substring("role", 1, 1),
            "place": F.struct(F.col("turn").isNotNull().alias("given"), "turn"),
        }
    )
    # A frequent text of one conversation is summed up before it is joined.
    seen = facts.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"))
    seen = seen.agg(F.min("place").alias("seen"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    facts = facts.join(seen, same)
    new = F.col("place").eqNullSafe(F.col("seen")) & ~F.col("blank")
    letter = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    kind = F.when(~new, "x").when(F.col("cut_off"), F.upper(letter)).otherwise(letter)
    copies = F.col("n") - new.cast("long")
    return facts.select(
        "conv",
        "turn",
        "role",
        "digest",
        "text",
        "n",
        "initial",
        F.concat(kind, F.repeat(F.lit("x"), (F.col("n") - 1).cast("int"))).alias("kinds"),
        F.when(F.col("blank"), F.col("n")).otherwise(0).alias("blank"),
        F.when(F.col("blank"), 0).otherwise(copies).alias("duplicate"),
        (new & F.col("cut_off")).cast("long").alias("truncated"),
    )


def _order(*names: str) -> list[Column]:
    return [F.col(name).asc_nulls_first() for name in names]


def _blocks(facts: DataFrame) -> DataFrame:
    """``conv, block, kinds, step, opening, ending, illegal``: runs of turns in their order.

    Turns are dealt by ranges of conversation and turn, so that a long conversation lies in several
    tasks; block numbers rise along it.
    """
    ordered = facts.select("conv", "turn", "role", "digest", "initial", "n", "kinds")
    keys = _order("conv", "turn", "role", "digest")
    ordered = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = ordered.select("conv", "initial", "n", "kinds")
    schema = StructType(
        [
            facts.schema["conv"],
            StructField("block", LongType()),
            StructField("kinds", StringType()),
            StructField("step", ArrayType(LongType(), False)),
            StructField("opening", StringType()),
            StructField("ending", StringType()),
            StructField("illegal", LongType()),
        ]
    )

    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        number = TaskContext.get().partitionId() << 32
        conv, kinds, size, opening, ending, illegal = None, [], 0, None, None, 0

        def closed() -> tuple:
            own = "".join(kinds)
            return conv, number, own, _flat(block_step(own)), opening, ending, illegal

        for new_conv, initial, n, letters in rows:
            if kinds and (new_conv != conv or size >= BLOCK_TURNS):
                yield closed()
                number += 1
                kinds, size, illegal = [], 0, 0
            pieces = [letters[k : k + BLOCK_TURNS] for k in range(0, len(letters), BLOCK_TURNS)]
            for k, piece in enumerate(pieces):
                if k:
                    yield closed()
                    number += 1
                    kinds, size, illegal = [], 0, 0
                if not kinds:
                    conv, opening = new_conv, initial
                elif ending + initial not in LEGAL:
                    illegal += 1
                # Copies stand beside each other, which is never legal.
                illegal += len(piece) - 1
                kinds.append(piece)
                size += len(piece)
                ending = initial
        if kinds:
            yield closed()

    return stored(_streamed(ordered, schema, cut))


def _flat(step: Step) -> list[int]:
    return [value for row in step for pair in row for value in pair]


def _unflat(values: list[int]) -> Step:
    pairs = [*zip(values[::2], values[1::2])]
    return tuple(tuple(pairs[4 * s : 4 * s + 4]) for s in STATES)


def _crossed(blocks: DataFrame) -> DataFrame:
    """``block, first, last, closing, conv, cost, illegal``: the states around each block; cost and
    illegal neighbours of the conversation stand at its last block. A task sees 32 numbers of a block."""
    schema = StructType(
        [
            StructField("block_of", LongType()),
            StructField("first", IntegerType()),
            StructField("last", IntegerType()),
            StructField("closing", StringType()),
            StructField("cost", LongType()),
            StructField("illegal_all", LongType()),
        ]
    )
    chained = blocks.select("conv", "block", "step", "opening", "ending", "illegal")
    chained = chained.repartition("conv").sortWithinPartitions(*_order("conv", "block"))

    def cross(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: list[tuple] = []

        def closed() -> Iterator[tuple]:
            cost, states = chain_blocks([_unflat(row[2]) for row in held])
            illegal = sum(row[5] for row in held)
            illegal += sum(a[4] + b[3] not in LEGAL for a, b in zip(held, held[1:]))
            for k, row in enumerate(held):
                ends = k + 1 == len(held)
                yield (
                    row[1],
                    states[k],
                    states[k + 1],
                    CLOSING[states[-1]] if ends else "",
                    cost if ends else 0,
                    illegal if ends else 0,
                )

        for row in rows:
            if held and row[0] != held[0][0]:
                yield from closed()
                held = []
            held.append(row)
        if held:
            yield from closed()

    return _streamed(chained, schema, cross)


def _audited(blocks: DataFrame) -> DataFrame:
    """``conv, block, audit, cost, illegal``: the edits of each block, found by many tasks."""
    crossed = blocks.select("conv", "block", "kinds").join(_crossed(blocks), F.col("block") == F.col("block_of"))
    crossed = crossed.select("conv", "block", "kinds", "first", "last", "closing", "cost", "illegal_all")
    schema = StructType(
        [
            blocks.schema["conv"],
            StructField("block", LongType()),
            StructField("audit", StringType()),
            StructField("cost", LongType()),
            StructField("illegal", LongType()),
        ]
    )

    def solve(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv, block, kinds, first, last, closing, cost, illegal in rows:
            solved = (_solve_short if len(kinds) <= 64 else solve_block)(kinds, first, last)
            yield conv, block, solved + closing, cost, illegal

    return stored(_streamed(crossed, schema, solve))


def _replayed(facts: DataFrame, audited: DataFrame, schema: StructType, each: Callable) -> DataFrame:
    """``each(conv, audit, lines)`` for every conversation; ``lines`` gives (edit, role, text) of the
    repaired turns in their order, and must be read to its end.

    A conversation's texts pass through one task in order, as its digest asks for, but are not held
    there; of each distinct turn only one copy comes.
    """
    turn = facts.schema["turn"].dataType
    edits = audited.select(
        "conv", F.lit(0).alias("kind"), "block", F.lit(None).cast(turn).alias("turn"),
        F.lit("").alias("role"), F.lit("").alias("digest"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("n"),
    )
    texts = facts.select(
        "conv", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("block"), "turn", "role", "digest", "text", "n"
    )
    both = edits.unionByName(texts).repartition("conv")
    both = both.sortWithinPartitions(*_order("conv", "kind", "block", "turn", "role", "digest"))
    both = both.select("conv", "kind", "role", "text", "n")

    def lines(audit: str, turns: Iterator[tuple]) -> Iterator[tuple[str, str, str]]:
        state, copies = 0, 0
        role = text = ""
        for letter in audit:
            if letter == "I":
                state = ONWARD[state]
                yield letter, ROLES[state], ""
                continue
            if not copies:
                _, _, role, text, copies = next(turns)
            copies -= 1
            if letter == "K":
                state = KEPT[role[:1]][state]
                yield letter, role, text
            elif letter == "R":
                state = ONWARD[state]
                yield letter, ROLES[state], text

    def replay(rows: Iterator[tuple]) -> Iterator[tuple]:
        row = next(rows, None)
        while row is not None:
            conv, parts = row[0], []
            while row[1] == 0:
                parts.append(row[3])
                row = next(rows)
            audit = "".join(parts)
            # The row that is already read, then those behind it, as far as the edits ask for them.
            yield from each(conv, audit, lines(audit, chain((row,), rows)))
            row = next(rows, None)

    return _streamed(both, schema, replay)


def _prepared(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return turns.select(
        turns[conv].alias("conv"),
        turns[turn].alias("turn"),
        F.coalesce(turns[role], F.lit(" ")).alias("role"),
        F.coalesce(turns[text], F.lit(" ")).alias("text"),
    )


def repair_conversations(
    turns: DataFrame,
    *,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """One row per conversation: what is wrong with it, and its cheapest repair.

    Columns: the conversation, ``gaps`` (turn numbers that are missing between the least and the
    largest), ``blank``, ``duplicate`` and ``truncated`` (turns by their first fault: nothing but
    white space; role and text seen earlier; the last character neither ``.``, ``!`` nor ``?``),
    ``illegal`` (neighbours whose role initials are not su, ua or au), ``cost`` and ``audit`` of the
    repair, and ``repaired_sha256`` of its lines ``role:text``.

    A repair keeps a turn (K, costs 0), gives it the role user or assistant (R, 2), deletes it (D, 3;
    blank and repeated turns must go) or inserts an empty turn of user or assistant (I, 2); a cut-off
    turn that stays costs 1 more. The result has the role initials ``(s?(ua)+)?``. ``audit`` holds the
    edits in order: the cheapest, and of equally cheap ones the ASCII-least.

    Copies of a turn are summed up before they move. Conversations are cut into blocks of at most
    ``BLOCK_TURNS`` turns, which are summed up and solved by many tasks; one task sees 32 numbers for
    each block of a conversation. The digest needs the texts of a conversation one after the other:
    they stream through one task, which holds only the edits.

    Defined cases: turns come by number, nulls first, equal numbers by role and by SHA-256 of the
    text; a null role or text counts as one space; turns without a conversation form one; roles are
    told by their first letter as it is written; very long texts are taken whole; other columns are
    ignored; an empty table gives no rows.
    """
    facts = stored(_facts(_prepared(turns, conv_column, turn_column, role_column, text_column)))
    audited = _audited(_blocks(facts))

    number = F.col("turn").cast("long")
    numbers = facts.groupBy("conv", "turn").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    )
    numbers = numbers.groupBy("conv").agg(
        F.coalesce(F.max(number) - F.min(number) + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )
    sums = audited.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    schema = StructType(
        [facts.schema["conv"], StructField("audit", StringType()), StructField("repaired_sha256", StringType())]
    )

    def digest(conv: Any, audit: str, lines: Iterator[tuple[str, str, str]]) -> Iterator[tuple]:
        own = hashlib.sha256()
        for k, (_, role, text) in enumerate(lines):
            own.update(f"{chr(10) if k else ''}{role}:{text}".encode())
        yield conv, audit, own.hexdigest()

    result = _replayed(facts, audited, schema, digest)
    for other in (numbers, sums):
        other = other.withColumnRenamed("conv", "other_conv")
        result = result.join(other, F.col("conv").eqNullSafe(F.col("other_conv"))).drop("other_conv")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return result.select(F.col("conv").alias(conv_column), *counts, "audit", "repaired_sha256")


def repaired_turns(
    turns: DataFrame,
    *,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """The turns of all repaired conversations: conversation, ``turn`` (from 0, without gaps), role,
    text, and ``edit`` (K, R or I). See :func:`repair_conversations`; a conversation of which nothing
    stays has no rows."""
    facts = stored(_facts(_prepared(turns, conv_column, turn_column, role_column, text_column)))
    audited = _audited(_blocks(facts))
    schema = StructType(
        [
            facts.schema["conv"],
            StructField("turn", LongType()),
            StructField("role", StringType()),
            StructField("text", StringType()),
            StructField("edit", StringType()),
        ]
    )

    def each(conv: Any, audit: str, lines: Iterator[tuple[str, str, str]]) -> Iterator[tuple]:
        for k, (edit, role, text) in enumerate(lines):
            yield conv, k, role, text, edit

    found = _replayed(facts, audited, schema, each)
    return found.select(
        F.col("conv").alias(conv_column),
        F.col("turn").alias(turn_column),
        F.col("role").alias(role_column),
        F.col("text").alias(text_column),
        "edit",
    )
