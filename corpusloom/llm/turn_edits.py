"""The cheapest edits that make a sequence of turns a conversation, by dynamic programming with square-root checkpoints.

A conversation is right when its roles' initials are an optional system turn, then pairs of user and assistant, or
nothing at all. What may follow is told by one of four states; a state-cost vector holds, for each, the least cost of the turns still to
come. Costs only flow backward, so a block of turns is a matrix between such vectors, and long
conversations are many blocks.
"""

from __future__ import annotations

from math import isqrt

INFINITE = 1 << 50
STATES = 4
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(STATES)
FINAL = (0, INFINITE, INFINITE, 0)
DELETE, INSERT, KEEP, REROLE = "DIKR"  # as ASCII orders them
COST_DELETE, COST_INSERT, COST_REROLE, COST_TRUNCATED = 2, 5, 1, 5
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
CLASSES = "sua"  # initials that may be kept; others are the class after them

# What a kept turn of each class leads to, and what a user or assistant turn put there does.
KEPT = ((AFTER_SYSTEM, AFTER_USER, None, None), (None, AFTER_USER, None, None), (None, None, AFTER_ASSISTANT, None), (None, AFTER_USER, None, None))
NEXT = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)
PUT = ("user", "user", "assistant", "user")  # the role that is put in each state


def code(initial: str, fault: int) -> str:
    """One character for a turn: all that its edits depend on."""
    found = CLASSES.find(initial) if initial else -1
    return chr(65 + 4 * fault + (found if found >= 0 else 3))


def _inserted(costs: list[int]) -> tuple[int, ...]:
    """With turns put before: at most two, as a third leads back to where the first led."""
    user, assistant = min(costs[2], costs[3] + COST_INSERT), min(costs[3], costs[2] + COST_INSERT)
    return min(costs[0], user + COST_INSERT), min(costs[1], user + COST_INSERT), user, assistant


def _before(turn: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """The vector before a turn from the one after it, with turns put between."""
    fault, kind = divmod(ord(turn) - 65, 4)
    if fault in (BLANK, DUPLICATE):
        return _inserted([c + COST_DELETE for c in after])
    extra = COST_TRUNCATED if fault == TRUNCATED else 0
    costs = []
    for state in range(STATES):
        best = min(after[state] + COST_DELETE, after[NEXT[state]] + COST_REROLE + extra)
        to = KEPT[state][kind]
        costs.append(best if to is None else min(best, after[to] + extra))
    return _inserted(costs)


def ending() -> tuple[int, ...]:
    """The vector at a conversation's end."""
    return _inserted(list(FINAL))


def transfer(turns: str) -> list[int]:
    """A block as a matrix: entry (i, j) is the least cost of going from state i before it to state j right after its last turn."""
    columns = []
    for j in range(STATES):
        vector = tuple(0 if i == j else INFINITE for i in range(STATES))
        for turn in reversed(turns):
            vector = _before(turn, vector)
        columns.append(vector)
    return [min(columns[j][i], INFINITE) for i in range(STATES) for j in range(STATES)]


def applied(matrix: list[int], after: tuple[int, ...]) -> tuple[int, ...]:
    """The vector before a block from the one after it."""
    return tuple(min(matrix[STATES * i + j] + after[j] for j in range(STATES)) for i in range(STATES))


def _checkpoints(turns: str, after: tuple[int, ...], step: int) -> list[tuple[int, ...]]:
    """The vectors before every ``step``-th turn, last first; between them nothing is kept."""
    kept = []
    for i in range(len(turns) - 1, -1, -1):
        after = _before(turns[i], after)
        if i % step == 0:
            kept.append(after)
    return kept


def walked(turns: str, after: tuple[int, ...], entries: list[int], last: bool) -> list[tuple[str, int]]:
    """For each entry state, the edits of a block, ASCII-least among the cheapest, and the state behind it.

    ``after`` is the vector behind the block. Vectors are stored at every square root of the block's length and those
    between two of them are calculated again as the walk comes to them. With ``last``, turns put at the end are included.
    """
    step = max(1, isqrt(len(turns)))
    kept = _checkpoints(turns, after, step)
    kept.reverse()
    states, edits = list(entries), [[] for _ in entries]
    for at, first in enumerate(range(0, len(turns), step)):
        part = turns[first:first + step]
        vectors = [kept[at + 1] if at + 1 < len(kept) else after]
        for turn in reversed(part):
            vectors.append(_before(turn, vectors[-1]))
        vectors.reverse()
        for n, turn in enumerate(part):
            for k, state in enumerate(states):
                states[k] = _edited(turn, vectors[n], vectors[n + 1], state, edits[k])
    if last:
        for k, state in enumerate(states):
            while after[state]:
                edits[k].append(INSERT)
                state = NEXT[state]
            states[k] = state
    return [("".join(e), s) for e, s in zip(edits, states)]


def _edited(turn: str, before: tuple[int, ...], after: tuple[int, ...], state: int, out: list[str]) -> int:
    """The tight edits of one turn, turns put before it included, least letters first."""
    fault, kind = divmod(ord(turn) - 65, 4)
    extra = COST_TRUNCATED if fault == TRUNCATED else 0
    while True:
        cost = before[state]
        if cost == COST_DELETE + after[state]:
            out.append(DELETE)
            return state
        if cost == COST_INSERT + before[NEXT[state]]:
            out.append(INSERT)
            state = NEXT[state]
            continue
        to = KEPT[state][kind]
        if to is not None and cost == extra + after[to]:
            out.append(KEEP)
            return to
        out.append(REROLE)
        return NEXT[state]
