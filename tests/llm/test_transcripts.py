"""Operator 11 against exhaustive search and a plain dynamic programme."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib

import pytest

from tests.conftest import SMOKE_DIR
from zoneflow.llm import transcripts
from zoneflow.llm.common import WorkTables

COLUMNS = "conv_id long, turn long, role string, text string, at string, slot string, piece string, n string"
LEGAL = {"su", "ua", "au"}
BLANKS = " \t\n\v\f\r"


def harmed(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0))


def fault_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        last = text.rstrip(BLANKS)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None)
        seen.add((role, text))
    return out


def accepted(initials):
    if initials.startswith("s"):
        initials = initials[1:]
        if not initials:
            return False
    return initials == "ua" * (len(initials) // 2)


def exhaustive(rows, faults, most_inserts):
    """Every sequence of edits: (cost, audit, repaired rows), the least of it."""
    best = None
    n = len(rows)
    for spots in itertools.chain.from_iterable(itertools.combinations_with_replacement(range(n + 1), k) for k in range(most_inserts + 1)):
        for roles in itertools.product(("user", "assistant"), repeat=len(spots)):
            for ops in itertools.product(("K", "Ru", "Ra", "D"), repeat=n):
                audit, made, cost = "", [], 0
                put = list(zip(spots, roles, strict=True))
                for k in range(n + 1):
                    for spot, role in put:
                        if spot == k:
                            audit, cost = audit + "I", cost + 5
                            made.append((role, ""))
                    if k == n:
                        continue
                    audit += ops[k][0]
                    if ops[k] == "D":
                        cost += 2
                        continue
                    if faults[k] in ("blank", "duplicate"):
                        cost = 10 ** 9
                    cost += 5 * (faults[k] == "truncated") + (ops[k] != "K")
                    made.append((rows[k][2] if ops[k] == "K" else {"u": "user", "a": "assistant"}[ops[k][1]], rows[k][3]))
                if accepted("".join(r[0][:1] or "?" for r in made)):
                    best = min(best or (10 ** 9, ""), (cost, audit, made))
    return best


def stepwise(rows, faults):
    """Row by row over the four states; a state keeps the least (cost, audit, rows)."""
    step = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}

    def with_inserts(states):
        for _ in range(3):
            for state, (cost, audit, made) in list(states.items()):
                role, after = step[state]
                new = (cost + 5, audit + "I", [*made, (role, "")])
                states[after] = min(states.get(after, new), new)
        return states

    now = {0: (0, "", [])}
    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for state, (cost, audit, made) in with_inserts(now).items():
            options = [(state, cost + 2, "D", None)]
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                options.append((step[state][1], cost + 1 + more, "R", step[state][0]))
                if role[:1] == step[state][0][0]:
                    options.append((step[state][1], cost + more, "K", role))
                if state == 0 and role[:1] == "s":
                    options.append((1, cost + more, "K", role))
            for to, price, op, as_role in options:
                new = (price, audit + op, made if op == "D" else [*made, (as_role, text)])
                after[to] = min(after.get(to, new), new)
        now = after
    end = with_inserts(now)
    return min(end[s] for s in (0, 3) if s in end)


def expected(original, repaired=stepwise):
    out = {}
    for conv in {r[0] for r in original}:
        rows = in_order([r for r in harmed(original) if r[0] == conv])
        faults = fault_of(rows)
        turns = [r[1] for r in rows if r[1] is not None]
        cost, audit, made = repaired(rows, faults)
        letters = [r[2][:1] for r in rows]
        text = "\n".join(f"{a}:{b}" for a, b in made)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                     faults.count("truncated"), sum(a + b not in LEGAL for a, b in itertools.pairwise(letters)), cost, audit,
                     hashlib.sha256(text.encode()).hexdigest())
    return out


def got(spark, rows):
    frame = spark.createDataFrame([(*r, *["x"] * 4) for r in rows], COLUMNS) if not hasattr(rows, "columns") else rows
    found = transcripts.repaired_digests(transcripts.damage(frame), frame)
    return {r[0]: tuple(r[1:]) for r in found.collect()}


ROLES = ["user", "assistant", "system", "tool", "User", "", None]
TEXTS = ["Fine.", "Well!", "cut", "", " \t\n", None, "a. ", "Ünïcode?", "x\ny."]


def made_up(seed, conversations, longest, roles=ROLES, texts=TEXTS):
    rng = random.Random(seed)
    return [(conv, turn, rng.choice(roles), rng.choice(texts))
            for conv in range(conversations) for turn in range(rng.randrange(longest + 1))]


def test_stepwise_reference_is_the_least_of_all_edits():
    for conv in range(60):
        rows = [r for r in made_up(conv, 1, 3)]
        rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
        faults = fault_of(rows)
        assert stepwise(rows, faults)[:2] == exhaustive(rows, faults, 2)[:2]


def test_whole_table(lspark):
    table = lspark.read.parquet(f"{SMOKE_DIR}/conversations.parquet")
    assert got(lspark, table) == expected([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("piece", [3, 4096])
def test_odd_rows_and_conversations_of_many_pieces(lspark, monkeypatch, piece):
    monkeypatch.setattr(transcripts, "PIECE", piece)
    monkeypatch.setattr(transcripts, "FAN", 2)
    rows = made_up(7, 40, 12) + [(1000, t, "user" if t % 3 else "assistant", f"{t % 50}.") for t in range(0, 300, 2)]
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "No turn."), (-5, None, "user", "Only.")]
    rows += [(2000, 5, "user", "Again.")] * 30 + [(2001, 1, "x" * 5000, "y" * 100_000)]
    assert got(lspark, rows) == expected(rows)


def test_system_first_and_ties(lspark):
    rows = [(1, 0, "system", "Be."), (1, 2, "user", "Q?"), (1, 3, "assistant", "A."), (2, 1, "system", "Alone."), (3, 1, "assistant", "A.")]
    rows += [(10 + k, t, r, x) for k, (r, x) in enumerate(itertools.product(["system", "user"], ["a.", "b"])) for t in range(2)]
    assert got(lspark, rows) == expected(rows)


def test_empty_table(lspark):
    assert got(lspark, []) == {}


def test_rules_do_not_change_repairs(lspark, monkeypatch):
    rows = made_up(3, 30, 10)
    many = got(lspark, rows)
    monkeypatch.setattr(transcripts, "ROUNDS", 0)
    assert got(lspark, rows) == many == expected(rows)


def test_grammar_is_shared_and_bounded(lspark):
    words = lspark.createDataFrame([("uaua" * 20,), ("suaua",), ("x",)], "symbols string")
    rounds = transcripts.grammar(words)
    assert 0 < len(rounds) <= transcripts.ROUNDS and all(len(r) <= transcripts.RULES for r in rounds)
    assert len(transcripts.encoded("uaua" * 20, rounds)) <= 10


def test_ropes_compare_like_texts():
    rng = random.Random(5)
    for _ in range(300):
        texts = ["".join(rng.choice("DIK") for _ in range(rng.randrange(6))) for _ in range(6)]
        ropes = [sum((transcripts.Rope(c) for c in t), transcripts.Rope()) for t in texts]
        for a, b in itertools.product(range(6), repeat=2):
            x, y = ropes[a] + ropes[b], ropes[b] + ropes[a]
            assert (x < y) == (texts[a] + texts[b] < texts[b] + texts[a]) and str(x) == texts[a] + texts[b]


def test_repaired_rows(lspark):
    rows = lspark.createDataFrame([(1, 1, "user", "Q?"), (1, 2, "user", "R."), (1, 3, "assistant", " ")],
                                  "conv_id long, turn long, role string, text string")
    conversations, repaired = transcripts.repair(rows, WorkTables(lspark))
    assert [tuple(r)[5:] for r in conversations.collect()] == [(1, 3, "KRD")]
    assert [tuple(r) for r in repaired.orderBy("at", "slot").select("op", "role", "text").collect()] == [
        ("K", "user", "Q?"), ("R", "assistant", "R.")]
