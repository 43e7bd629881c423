"""Cheapest edits of role and fault sequences, shared through a grammar.

A row is one of twelve symbols: the initial of its role (s, u, a or another) and its fault (none, truncated, or one for
which it must go).  Re-Pair replaces the most frequent pair of neighbouring symbols of all sequences by a rule
until no pair comes twice.  Each rule has one min-plus matrix, the product of those of its two parts: the least
cost from each state of the role grammar ``(s?(ua)+)?`` to each other, with the edits as a rope, so that rules share
the ropes of their parts.  A sequence is then a short product of the matrices of its symbols.

Of equally cheap edits the least in ASCII is kept.  Equal cost makes this sound part by part: where one of two edit strings
for the same rows goes on from the end of the other, it has more inserts and costs more, so two equally cheap ones
differ at some place, whatever follows.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator, Sequence

# Costs of the edits, and what a row left truncated costs.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

INITIALS = "sua"
OK, CUT, GONE = 0, 1, 2  # faults: none, truncated, must be deleted
N_SYMBOLS = 12

# States of the role grammar: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
_AFTER_USER_OK = (START, SYSTEM, ASSISTANT)


def symbol(initial: str, fault: int) -> int:
    return (INITIALS.find(initial) if initial and initial in INITIALS else 3) * 3 + fault


# ---------------------------------------------------------------- ropes

Rope = str | tuple
_SHORT = 32


def joined(a: Rope, b: Rope) -> Rope:
    if not a or not b:
        return a or b
    if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= _SHORT:
        return a + b
    return (a, b)


def leaves(rope: Rope) -> Iterator[str]:
    stack = [rope]
    while stack:
        top = stack.pop()
        if isinstance(top, str):
            yield top
        else:
            stack += [top[1], top[0]]


def flat(rope: Rope) -> str:
    return "".join(leaves(rope))


def less(a: Rope, b: Rope) -> bool:
    """Does ``a`` come before ``b`` in ASCII?"""
    if isinstance(a, str) and isinstance(b, str):
        return a < b
    left, right = leaves(a), leaves(b)
    x, y = "", ""
    while True:
        x = x or next(left, "")
        y = y or next(right, "")
        if not x or not y:
            return not x and bool(y)
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:], y[n:]


# ---------------------------------------------------------------- matrices

Entry = tuple[int, Rope]  # cost and edits
Matrix = dict[tuple[int, int], Entry]  # by (state before, state after); others cannot be reached


def better(new: Entry, old: Entry | None) -> bool:
    return old is None or new[0] < old[0] or (new[0] == old[0] and less(new[1], old[1]))


def product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = {}
    for (i, k), (cost, edits) in a.items():
        for j in range(4):
            step = b.get((k, j))
            if step is not None:
                old = out.get((i, j))
                if old is None or cost + step[0] <= old[0]:
                    new = cost + step[0], joined(edits, step[1])
                    if better(new, old):
                        out[i, j] = new
    return out


#: Any inserts: each costs the same, and no state is left and come back to in vain.
INSERTS: Matrix = {
    (i, j): (INSERT * n, "I" * n)
    for i, steps in {START: {START: 0, USER: 1, ASSISTANT: 2}, SYSTEM: {SYSTEM: 0, USER: 1, ASSISTANT: 2}, USER: {USER: 0, ASSISTANT: 1}, ASSISTANT: {ASSISTANT: 0, USER: 1}}.items()
    for j, n in steps.items()
}


def _row(initial: str, fault: int) -> Matrix:
    out: Matrix = {(i, i): (DELETE, "D") for i in range(4)}
    if fault != GONE:
        more = TRUNCATED if fault == CUT else 0
        moves = [(i, USER) for i in _AFTER_USER_OK] + [(USER, ASSISTANT)]
        for i, j in moves:
            keeps = (initial == "u") if j == USER else (initial == "a")
            out[i, j] = (KEEP + more, "K") if keeps else (REROLE + more, "R")
        if initial == "s":
            out[START, SYSTEM] = KEEP + more, "K"
    return out


#: Matrices of the symbols: inserts before the row, then the row.
TERMINALS = [product(INSERTS, _row("suao"[i // 3], i % 3)) for i in range(N_SYMBOLS)]


# ---------------------------------------------------------------- grammar


class Grammar:
    """Rules over sequences of symbols; ``rules[k]`` is the pair behind symbol ``N_SYMBOLS + k``."""

    def __init__(self) -> None:
        self.rules: list[tuple[int, int]] = []
        self.matrices: list[Matrix] = list(TERMINALS)
        self._powers: dict[tuple[int, int], int] = {}

    def add(self, pair: tuple[int, int]) -> int:
        self.rules.append(pair)
        self.matrices.append(product(self.matrices[pair[0]], self.matrices[pair[1]]))
        return len(self.matrices) - 1

    def power(self, sym: int, n: int) -> list[int]:
        """A short sequence that stands for ``n`` times ``sym``, by doubling."""
        out, bit = [], 1
        while bit <= n:
            if bit > 1 and (sym, bit) not in self._powers:
                half = self._powers.get((sym, bit // 2), sym)
                self._powers[sym, bit] = self.add((half, half))
            if n & bit:
                out.append(self._powers.get((sym, bit), sym))
            bit <<= 1
        return out

    def compress(self, sequences: Sequence[Sequence[int]]) -> list[list[int]]:
        """Re-Pair over all sequences at once; pairs do not reach from one into the next."""
        text: list[int] = []
        for sequence in sequences:
            text += sequence
            text.append(-1)
        n = len(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        places: dict[tuple[int, int], set[int]] = defaultdict(set)

        def note(i: int) -> None:
            j = after[i]
            if i >= 0 and j < n and text[i] >= 0 and text[j] >= 0:
                # Of a run of equal symbols every second pair counts.
                if text[i] != text[j] or before[i] < 0 or before[i] not in places[text[i], text[j]]:
                    places[text[i], text[j]].add(i)

        def forget(i: int) -> None:
            j = after[i] if i >= 0 else n
            if j < n and (text[i], text[j]) in places:
                places[text[i], text[j]].discard(i)

        for i in range(n - 1):
            note(i)
        heap = [(-len(at), pair) for pair, at in places.items() if len(at) > 1]
        heapq.heapify(heap)
        while heap:
            count, pair = heapq.heappop(heap)
            at = places.get(pair, ())
            if len(at) != -count:
                if len(at) > 1:
                    heapq.heappush(heap, (-len(at), pair))
                continue
            made = self.add(pair)
            changed = set()
            for i in sorted(at):
                j = after[i]
                if j >= n or (text[i], text[j]) != pair:
                    continue
                left, right = before[i], after[j]
                if left >= 0:
                    forget(left)
                forget(j)
                text[i], text[j] = made, -2
                after[i] = right
                if right < n:
                    before[right] = i
                for k in (left, i):
                    if k >= 0:
                        note(k)
                        if after[k] < n:
                            changed.add((text[k], text[after[k]]))
            places.pop(pair, None)
            for other in changed:
                if len(places.get(other, ())) > 1:
                    heapq.heappush(heap, (-len(places[other]), other))
        out, i = [[]], 0
        while i < n:
            if text[i] == -1:
                out.append([])
            else:
                out[-1].append(text[i])
            i = after[i]
        return out[:-1]

    def total(self, sequence: Sequence[int]) -> Matrix:
        """The matrix of a sequence, from every state."""
        out: Matrix = {(i, i): (0, "") for i in range(4)}
        for s in sequence:
            out = product(out, self.matrices[s])
        return out

    def best(self, sequence: Sequence[int]) -> tuple[int, str]:
        """Cost and edits of a whole sequence."""
        row: Matrix = {(START, START): (0, "")}
        for s in sequence:
            row = product(row, self.matrices[s])
        cost, edits = finish(row)[0]
        return cost, flat(edits)


def finish(row: Matrix) -> tuple[Entry, int]:
    """The best way from the start to an accepted end, with the state before the last inserts."""
    chosen: Entry | None = None
    state = START
    for (i, k), (cost, edits) in sorted(row.items()):
        for j in (START, ASSISTANT):
            step = INSERTS.get((k, j))
            if i == START and step is not None:
                new = cost + step[0], joined(edits, step[1])
                if better(new, chosen):
                    chosen, state = new, k
    return chosen, state
