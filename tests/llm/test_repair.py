"""Repairs against a plain search over all edits, and odd conversations."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tallyhouse.llm import conversation_repair as repair

BLANK = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """(cost, audit, lines): rows of (role, text, must go, truncated), by the least (cost, audit) of every node and row."""
    follow = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    fill = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}

    def inserted(table):
        for _ in range(4):
            for node, (cost, audit, lines) in list(table.items()):
                role, to = fill[node]
                new = (cost + 3, audit + "I", [*lines, role + ":"])
                if to not in table or new[:2] < table[to][:2]:
                    table[to] = new
        return table

    table = inserted({0: (0, "", [])})
    for role, text, go, cut in rows:
        after = {}

        def offer(to, new, after=after):
            if to not in after or new[:2] < after[to][:2]:
                after[to] = new

        for node, (cost, audit, lines) in table.items():
            offer(node, (cost + 4, audit + "D", lines))
            if not go:
                if role[:1] in follow[node]:
                    offer(follow[node][role[:1]], (cost + 3 * cut, audit + "K", [*lines, f"{role}:{text}"]))
                to_role, to = fill[node]
                offer(to, (cost + 3 + 3 * cut, audit + "R", [*lines, f"{to_role}:{text}"]))
        table = inserted(after)
    return min(table[n] for n in (0, 3) if n in table)


def brute(rows):
    """The contract row by row, in plain Python."""
    by = {}
    for conv, turn, role, text in rows:
        own = by.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        own += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    out = []
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        seen, shaped, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            held = BLANK.findall(text)
            fault = "blank" if not held else "duplicate" if (role, text) in seen else "truncated" if held[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            shaped.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + "/" + b[1][:1] for a, b in zip(own[:-1], own[1:], strict=True)]
        wrong = sum(p not in ("s/u", "u/a", "a/u") for p in pairs)
        cost, audit, lines = cheapest(shaped)
        out.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], wrong, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def found(spark, rows):
    # Further columns, some named as the library names its own.
    df = spark.createDataFrame([(*r, 1, "x", True, "y") for r in rows], "conv_id long, turn int, role string, text string, conv int, digest string, gone boolean, audit string")
    return sorted((tuple(r) for r in repair.repair_damaged(df).select(*NAMES).collect()), key=str)


@pytest.mark.parametrize("length", [0, 1, 2, 3, 5, 9, 31, 32, 33, 64, 65, 200])
def test_auction_finds_the_least_cost_and_edits(length):
    rng = random.Random(length)
    roles = ["system", "user", "assistant", "tool"]
    for _ in range(60 if length < 40 else 8):
        shape = [(rng.choices(range(4), (1, 6, 6, 1))[0], rng.choices(range(4), (8, 2, 1, 1))[0]) for _ in range(length)]
        cost, audit = repair.solve(bytes(4 * fault + first for first, fault in shape))
        want = cheapest([(roles[first], "t", fault > 1, fault == 1) for first, fault in shape])
        assert (cost, audit) == want[:2]


def test_prices_never_exceed_an_arc_and_what_follows():
    rng = random.Random(5)
    rows = bytes(rng.randrange(16) for _ in range(100))
    price = repair.array("q", bytes(8 * 4 * 102))
    repair.auction(rows, price, 0, 101, 0)
    assert price[0] == repair.solve(rows)[0]
    for layer in range(101):
        for node in range(4):
            for edit, cost, to in repair.arcs(node, rows[layer] if layer < 100 else None):
                assert price[4 * layer + node] <= cost + price[4 * (layer + (edit != "I")) + to]


def test_work_grows_with_the_rows():
    rng = random.Random(6)
    for length in (200, 2000):
        rows = bytes(4 * rng.choices(range(4), (8, 2, 1, 1))[0] + rng.choices(range(4), (1, 6, 6, 1))[0] for _ in range(length))
        steps = 0

        class Counted(list):
            def __getitem__(self, i):
                nonlocal steps
                steps += 1
                return list.__getitem__(self, i)

        held, repair._OUT = repair._OUT, Counted(repair._OUT)
        try:
            repair.solve(rows)
        finally:
            repair._OUT = held
        assert steps < 400 * length


def test_runs_of_nulls():
    import pyarrow as pa

    assert repair._runs(pa.array([None, None, 1, 1, None, 2], pa.int64())) == [(0, 2), (2, 4), (4, 5), (5, 6)]
    assert repair.illegal(np.array([0, 1, 2, 1, 1, 0, 3])) == 3


def test_repair_against_plain_search(spark):
    rng = random.Random(1)
    texts = ["A question?", "An answer.", "cut off", "", " \n\t", "Really!  ", "wörd 中文。", "x" * 5000 + "."]
    rows = [(c, t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", ""]), rng.choice(texts)) for c in range(300) for t in range(rng.randint(1, 12))]
    assert found(spark, rows) == brute(rows)


def test_repair_odd_rows(spark):
    rng = random.Random(2)
    roles = ["user", "assistant", None, "system"]
    # Repeated rows, turns NULL or equal, gaps, a NULL conversation, NULL in every column, one long conversation with a third of the rows.
    rows = [(None, t, rng.choice(roles), rng.choice(["Yes.", None, "no"])) for t in (3, 1, None, 7, 7, -2)]
    rows += [(1, 5, "user", "same.")] * 6 + [(2, None, "user", "Hi!"), (2, None, None, None), (2, 4, "assistant", "Hello."), (2, 2**31 - 1, "user", "So?"), (2, -(2**31), "user", "So?")]
    rows += [(3, None, None, None), (4, 0, "assistant", "First."), (None, None, None, None)]
    rows += [(9, t, ["user", "assistant"][t % 2], f"row {t}{rng.choice(['.', '!', '', '?'])}") for t in range(3000)]
    rows += [(10 + c, t, roles[t % 2], f"row {t}.") for c in range(700) for t in range(rng.randint(1, 9))]
    assert found(spark, rows) == brute(rows)


def test_repair_of_conversations_without_rows(spark):
    dropped = [c for c in range(2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:5]
    got = found(spark, [(c, 0, "user", "Hi.") for c in dropped])
    assert got == sorted([(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in dropped], key=str)
    assert found(spark, []) == []
