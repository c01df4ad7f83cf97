"""Conversation repair against plain versions of its rules."""

import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from functools import lru_cache
from hashlib import sha256

import pytest
from hypothesis import given, settings, strategies as st

from millrace.llm import conversations
from millrace.llm.conversations import KINDS, audit_of, block_step, chain_blocks, repair_conversations, repaired_turns, solve_block
from millrace.llm.queries import op12_conversations
from tests.llm.conftest import DATA

sys.setrecursionlimit(20_000)
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")


def cheapest(kinds):
    """Cost and edits by trying everything; ``kinds`` as in the library."""

    @lru_cache(None)
    def best(at, said, added):
        """From turn ``at``, the last initial being ``said``, with ``added`` insertions in a row."""
        found = []
        if at == len(kinds) and said in ("", "a"):
            found.append((0, ""))
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[said]
        new = after[-1]
        if added < 4:
            cost, letters = best(at, new, added + 1)
            found.append((cost + 2, "I" + letters))
        if at < len(kinds):
            kind = kinds[at]
            cost, letters = best(at + 1, said, 0)
            found.append((cost + 3, "D" + letters))
            if kind != "x":
                cut = kind.isupper()
                cost, letters = best(at + 1, new, 0)
                found.append((cost + 2 + cut, "R" + letters))
                if kind.lower() in after:
                    cost, letters = best(at + 1, kind.lower(), 0)
                    found.append((cost + cut, "K" + letters))
        return min(found, default=(10**6, ""))

    return best(0, "", 0)


@given(st.text(alphabet=KINDS, max_size=14))
@settings(max_examples=400, deadline=None)
def test_audits_are_the_cheapest_and_least(kinds):
    assert audit_of(kinds) == cheapest(kinds)


@given(st.text(alphabet="xsuaoUA", max_size=40), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_blocks_give_the_same(kinds, size):
    blocks = [kinds[k : k + size] for k in range(0, len(kinds), size)]
    cost, states = chain_blocks([block_step(b) for b in blocks])
    letters = "".join(solve_block(b, s, t) for b, s, t in zip(blocks, states, states[1:]))
    assert (cost, letters + conversations.CLOSING[states[-1]]) == audit_of(kinds) == cheapest(kinds)


def repaired(turns):
    """The result for the turns of one conversation, in order, as the contract has it."""
    faults, kinds, seen, illegal = Counter(), "", set(), 0
    for k, (_, role, text) in enumerate(turns):
        stripped = text.strip(" \t\n\x0b\x0c\r")
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        if not stripped:
            fault, kind = "blank", "x"
        elif (role, text) in seen:
            fault, kind = "duplicate", "x"
        elif stripped[-1] not in ".!?":
            fault, kind = "truncated", initial.upper()
        else:
            fault, kind = None, initial
        faults[fault] += 1
        kinds += kind
        seen.add((role, text))
        if k:
            illegal += turns[k - 1][1][:1] + role[:1] not in ("su", "ua", "au")
    cost, audit = cheapest(kinds)
    lines, at, initials = [], 0, ""
    for letter in audit:
        after = "user" if initials[-1:] != "u" else "assistant"
        if letter == "I":
            lines.append(f"{after}:")
        else:
            _, role, text = turns[at]
            at += 1
            if letter == "D":
                continue
            lines.append(f"{role if letter == 'K' else after}:{text}")
        initials += lines[-1][0]
    assert GRAMMAR.match(initials) and at == len(turns)
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    counts = [faults[f] for f in ("blank", "duplicate", "truncated")]
    return [gaps, *counts, illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest()], lines


def ordered(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append((turn, " " if role is None else role, " " if text is None else text))
    for turns in found.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), sha256(t[2].encode()).hexdigest()))
    return found


SCHEMA = "conv_id long, turn long, role string, text string, block string, kinds string, n string, digest string, conv string"


def check(spark, rows):
    given_rows = spark.createDataFrame([(*r, *"abcde") for r in rows], SCHEMA)
    found = {r[0]: [*r[1:]] for r in repair_conversations(given_rows).collect()}
    lines = defaultdict(list)
    for r in repaired_turns(given_rows).collect():
        lines[r["conv_id"]].append((r["turn"], f"{r['role']}:{r['text']}"))
    turns = ordered(rows)
    assert found.keys() == turns.keys()
    for conv, own in turns.items():
        want, want_lines = repaired(own)
        assert found[conv] == want, (conv, own)
        assert sorted(lines[conv]) == [*enumerate(want_lines)]


def test_random_conversations(spark):
    some = random.Random(5)
    texts = ["Yes.", "No!", "cut", "", " \t\n", None, "Done. ", "What? ", "very long. " * 3000]
    roles = ["user", "assistant", "system", "tool", "User", "", None]
    rows = [
        (conv if conv else None, some.choice([None, *range(6)]), some.choices(roles, [5, 5, 2, 1, 1, 1, 1])[0], some.choice(texts))
        for conv in range(150)
        for _ in range(some.randint(1, 9))
    ]
    check(spark, rows)


def test_a_long_conversation_lies_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(conversations, "BLOCK_TURNS", 7)
    some = random.Random(6)
    rows = [(1, t, some.choice(["user", "assistant", "system"]), some.choice([f"{t}.", "same.", f"{t}"])) for t in range(300)]
    # One turn with many copies.
    rows += [(1, 40, "user", "again.")] * 60 + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Yes.")]
    check(spark, rows)


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair_conversations(none).count() == 0 and repaired_turns(none).count() == 0


def test_the_query_on_the_whole_table(spark):
    if not DATA.exists():
        pytest.skip("test tables are not here")
    rows = []
    originals = spark.read.parquet(f"{DATA}/conversations.parquet").collect()
    for conv, turn, role, text in originals:
        fault = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        rows += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    found = {r["conv_id"]: [*r[1:]] for r in op12_conversations(spark, str(DATA)).collect()}
    turns = ordered(rows)
    assert found.keys() == {r["conv_id"] for r in originals}
    for conv, row in found.items():
        assert row == repaired(turns[conv])[0]
