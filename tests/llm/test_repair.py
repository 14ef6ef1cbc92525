"""Conversation repair against a search over all edits."""

import heapq
import random
import zlib
from hashlib import sha256

import pytest

from corpusloom.llm import turn_edits as te
from corpusloom.llm.conversation_repair import repair_report, repaired_turns
from corpusloom.llm.queries import op12_conversation_repair

SPACES = " \t\n\x0b\x0c\r"


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        shown = text.strip(SPACES)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def allowed(state, initial):
    return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))


def search(turns):
    """(cost, audit, repaired lines) by the cheapest, then least, path over all edits."""
    found, done = faults(turns), set()
    heap = [(0, "", 0, "", ())]
    while heap:
        cost, audit, at, state, lines = heapq.heappop(heap)
        if at == len(turns) and state in ("", "a"):
            return cost, audit, lines
        if (at, state) in done:
            continue
        done.add((at, state))
        for role in ("user", "assistant"):
            if allowed(state, role[0]):
                heapq.heappush(heap, (cost + 5, audit + "I", at, role[0], (*lines, f"{role}:")))
        if at == len(turns):
            continue
        role, text = turns[at]
        heapq.heappush(heap, (cost + 2, audit + "D", at + 1, state, lines))
        if found[at] in ("blank", "duplicate"):
            continue
        extra = 5 * (found[at] == "truncated")
        if allowed(state, role[:1]):
            heapq.heappush(heap, (cost + extra, audit + "K", at + 1, role[:1], (*lines, f"{role}:{text}")))
        for other in ("user", "assistant"):
            if allowed(state, other[0]):
                heapq.heappush(heap, (cost + 1 + extra, audit + "R", at + 1, other[0], (*lines, f"{other}:{text}")))
    raise AssertionError


def report(turns):
    """Of (turn, role, text) in order."""
    numbers = [t for t, _, _ in turns if t is not None]
    pairs = [(r, x) for _, r, x in turns]
    found = faults(pairs)
    initials = [r[:1] for r, _ in pairs]
    cost, audit, lines = search(pairs)
    return (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *[found.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, sha256("\n".join(lines).encode()).hexdigest())


def conversations(seed, n=60):
    draw, rows = random.Random(seed), []
    for conv in range(n):
        kept = draw.choice([0.3, 0.9])
        for turn in range(draw.choice([0, 1, 2, 5, 9, 17])):
            usual = "system" if turn == 0 and conv % 3 == 0 else "user" if (turn + (conv % 3 == 0)) % 2 == 0 else "assistant"
            role = usual if draw.random() < kept else draw.choice(["user", "assistant", "system", "tool", "", "usher", "Assistant", "."])
            rows.append((conv, turn * draw.choice([1, 1, 1, 2]) if draw.random() < kept + 0.1 else None, role,
                         draw.choice(["Yes.", "no", " \t", "", "é?\n", "What!", "long " * 20, f"{turn}.", f"{conv} {turn}!", "."])))
    return rows + [(None, 1, "user", "x."), (None, 2, "assistant", "y."), (500, None, None, None), (501, None, "user", None), (501, None, "user", None)]


SCHEMA = "conv_id long, turn long, role string, text string, step int, edit string"


def ordered(rows):
    """Turns by conversation in the one order that is left open: none, as equal turn numbers are told apart here."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {c: sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0)) for c, turns in out.items()}


def single(rows):
    """Without turns of one number but different content, whose order the operator chooses."""
    seen, out = {}, []
    for conv, turn, role, text in rows:
        if seen.setdefault((conv, turn), (role, text)) == (role, text):
            out.append((conv, turn, role, text))
    return out


@pytest.mark.parametrize("block_bits", [0, 2, 12])
def test_report_against_search(spark, block_bits):
    rows = single(conversations(block_bits))
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA).repartition(4)
    more = spark.createDataFrame([(900,), (None,), (0,), (900,)], "conv_id long")
    got = {tuple(r)[0]: tuple(r)[1:] for r in repair_report(df, more, block_bits=block_bits).collect()}
    want = {c: report(turns) for c, turns in ordered(rows).items()} | {900: (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())}
    if 0 not in want:
        want[0] = want[900]
    assert got == want


def test_turns_and_ties(spark):
    rows = conversations(77)
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA).repartition(4)
    one = sorted(map(tuple, repaired_turns(df, block_bits=1).collect()), key=str)
    assert one == sorted(map(tuple, repaired_turns(df.repartition(2), block_bits=12).collect()), key=str)
    by_conv = {}
    for r in one:
        by_conv.setdefault(r[0], []).append(r)
    for conv, steps in by_conv.items():
        steps.sort(key=lambda r: r[1])
        assert [r[1] for r in steps] == list(range(len(steps)))
        left = "".join(r[5][:1] for r in steps if r[2] != "D")
        assert left.removeprefix("s").replace("ua", "") == "" and (left != "s")
    given = sorted((c, t, r, x) for c, turns in ordered(rows).items() for t, r, x in turns if c is not None and t is not None)
    assert sorted(r[0:1] + r[4:5] for r in one if r[2] != "I" and r[0] is not None and r[4] is not None) == [g[:2] for g in given]
    assert repaired_turns(df.limit(0)).collect() == [] == repair_report(df.limit(0)).collect()


def test_checkpoints_and_blocks_agree():
    draw = random.Random(5)
    for _ in range(200):
        turns = "".join(te.code(draw.choice(["u", "a", "s", "x", ""]), draw.choice([0, 0, 0, 1, 2, 3])) for _ in range(draw.randint(1, 40)))
        whole = te.walked(turns, te.ending(), [te.START], True)[0][0]
        cut = draw.randint(1, len(turns))
        behind = te.applied(te.transfer(turns[cut:]), te.ending()) if turns[cut:] else te.ending()
        first, state = te.walked(turns[:cut], behind, [te.START], not turns[cut:])[0]
        assert whole == first + (te.walked(turns[cut:], te.ending(), [state], True)[0][0] if turns[cut:] else "")


def test_long_conversation_keeps_few_vectors():
    turns = "".join(te.code("ua"[i % 2], 0) for i in range(20_000))
    assert te.walked(turns, te.ending(), [te.START], True)[0][0] == "K" * 20_000
    assert len(te._checkpoints(turns, te.ending(), 141)) == 142


def test_query(spark, tmp_path):
    rows = [r for r in single(conversations(3, 150)) if r[1] is not None or r[0] in (None, 500)]
    spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    damaged = []
    for conv, turn, role, text in rows:
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate:
            text = {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(fate, text)
            damaged += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    nothing = (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    want = {r[0]: nothing for r in rows} | {c: report(turns) for c, turns in ordered(damaged).items()}
    assert {tuple(r)[0]: tuple(r)[1:] for r in op12_conversation_repair(spark, str(tmp_path)).collect()} == want
