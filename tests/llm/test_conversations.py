"""Conversation repair against a search over all edits, whole and in parts."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from zonewise.llm import conversations as C
from zonewise.llm import repair_grammar as G

SCHEMA = "conv string, turn bigint, role string, text string, present boolean"
SPACE = " \t\n\x0b\x0c\r"


def faults_of(rows):
    """``b``, ``d``, ``t`` or nothing for ``(role, text)`` rows in order."""
    out = []
    for i, (role, text) in enumerate(rows):
        solid = text.strip(SPACE)
        if not solid:
            out.append("b")
        elif (role, text) in rows[:i]:
            out.append("d")
        else:
            out.append("" if solid[-1] in ".!?" else "t")
    return out


def all_edits(rows):
    """Every way to an accepted end with at most two inserts in a row: (cost, audit, lines)."""
    found = faults_of(rows)
    ways = [(0, "", (), "")]
    for (role, text), fault in [*zip(rows, found), ((None, None), None)]:
        spread = []
        for cost, audit, lines, roles in ways:
            spread += [(cost, audit, lines, roles)]
            for first in "ua":
                one = (cost + 2, audit + "I", (*lines, f"{'user' if first == 'u' else 'assistant'}:"), roles + first)
                spread.append(one)
                for second in "ua":
                    name = "user" if second == "u" else "assistant"
                    spread.append((one[0] + 2, one[1] + "I", (*one[2], f"{name}:"), one[3] + second))
        spread = [w for w in spread if re.fullmatch("(s?(ua)*u?)?", w[3])]
        if role is None:
            ways = spread
            break
        ways = []
        for cost, audit, lines, roles in spread:
            ways.append((cost + 3, audit + "D", lines, roles))
            if fault in ("b", "d"):
                continue
            more = fault == "t"
            if role[:1] in ("s", "u", "a"):
                ways.append((cost + more, audit + "K", (*lines, f"{role}:{text}"), roles + role[:1]))
            for name in ("user", "assistant"):
                ways.append((cost + 2 + more, audit + "R", (*lines, f"{name}:{text}"), roles + name[0]))
        best = {}
        for w in ways:
            if re.fullmatch("(s?(ua)*u?)?", w[3]):
                state = (w[3][-1:], bool(w[3]))
                best[state] = min(best.get(state, w), w, key=lambda x: (x[0], x[1]))
        ways = list(best.values())
    cost, audit, lines, _ = min((w for w in ways if re.fullmatch("(s?(ua)+)?", w[3])), key=lambda x: (x[0], x[1]))
    return cost, audit, "\n".join(lines)


def brute(rows):
    """``rows``: (turn, role, text), in any order; the result row without its conversation."""
    rows = sorted(((t is not None, t or 0, " " if r is None else r, " " if x is None else x) for t, r, x in rows))
    turns = [t for known, t, _, _ in rows if known]
    pairs = [(r, x) for _, _, r, x in rows]
    found = faults_of(pairs)
    cost, audit, text = all_edits(pairs)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, found.count("b"), found.count("d"), found.count("t"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest(), text


def made(rng, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "s"]
    texts = ["Yes.", "No!", "Well", "", " ", None, "Done. ", "x?\n", "à", "Yes."]
    turn, out = 0, []
    for _ in range(n):
        turn += rng.choice([0, 1, 1, 1, 3])
        out.append((rng.choice([turn, turn, turn, turn, None]), rng.choice(roles), rng.choice(texts)))
    return out


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(5)
    return {f"c{i}": made(rng, rng.choice([1, 2, 3, 4, 5, 6, 7, 9])) for i in range(120)}


@pytest.mark.parametrize("long_rows", [C.LONG_ROWS, 3])
def test_every_edit(spark, cases, long_rows):
    rows = [(c, *r, True) for c, rs in cases.items() for r in rs] + [("none", 1, "user", "x", False), (None, 2, "user", "Hm.", True)]
    got = {r[0]: tuple(r[1:]) for r in C.repair(spark.createDataFrame(rows, SCHEMA), keep_text=True, long_rows=long_rows).collect()}
    want = {c: brute(rs) for c, rs in cases.items()} | {None: brute([(2, "user", "Hm.")])}
    want["none"] = (0,) * 6 + ("", hashlib.sha256(b"").hexdigest(), "")
    assert {c: (got[c], want[c]) for c in want if got.get(c) != want[c]} == {}
    assert len(got) == len(want)


def test_a_long_conversation_in_parts(spark):
    rng = random.Random(8)
    rows = [("long", t, "user" if (t + (rng.random() < 0.1)) % 2 else "assistant", f"Word {rng.randrange(900)}{rng.choice('.!?,')}", True) for t in range(3000)]
    rows += [("long", 7, "user", "Same.", True)] * 500
    df = spark.createDataFrame(rows, SCHEMA)
    whole = C.repair(df, keep_text=True).collect()
    parts = C.repair(df, keep_text=True, long_rows=10).collect()
    assert parts == whole and len(parts) == 1


def test_grammar_keeps_sequences():
    rng = random.Random(2)
    sequences = [[rng.randrange(3) for _ in range(rng.randrange(40))] for _ in range(60)] + [[4] * 100, [], [5]]
    grammar = G.Grammar()

    def spelled(s):
        return [s] if s < G.N_SYMBOLS else [t for part in grammar.rules[s - G.N_SYMBOLS] for t in spelled(part)]

    short = grammar.compress(sequences)
    assert [[t for s in q for t in spelled(s)] for q in short] == sequences
    assert sum(map(len, short)) < sum(map(len, sequences)) / 2
    assert [t for s in grammar.power(7, 1000) for t in spelled(s)] == [7] * 1000


def test_ropes_compare_as_texts():
    rng = random.Random(3)

    def rope(n):
        return "".join(rng.choice("DIKR") for _ in range(n)) if n < 9 else (rope(n // 2), rope(n - n // 2))

    for _ in range(200):
        a, b = rope(rng.randrange(60)), rope(rng.randrange(60))
        assert G.less(a, b) == (G.flat(a) < G.flat(b))


def test_damage(spark):
    rows = [(c, t, "assistant", "A b. C!") for c in range(20) for t in range(10)] + [(None, None, None, None)]
    got = C.damage(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        row = (c, t, "user" if kind == 4 else role, {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text), kind != 0)
        want += [row] * (2 if kind == 3 else 1)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_empty_table_and_other_columns(spark):
    assert C.repair(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame([(1, 1, "user", "Hi.", "x")], "conv bigint, turn int, role string, text string, part string")
    assert C.repair(odd).first()["audit"] == "KI"
