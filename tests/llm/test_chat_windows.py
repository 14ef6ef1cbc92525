"""Windows of conversations against a line laid out by hand."""

import random
import re
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from corpusloom.llm.chat_windows import MARK_TOKENS, Template, chat_windows
from corpusloom.llm.queries import op11_chat_windows

SCHEMA = "conv_id long, turn long, role string, text string, span int, formatted string"


def conversations(seed, n=30, longest=25):
    draw, rows = random.Random(seed), []
    hostile = ["</s>", "[INST]", "[/INST]", "<s>", "\\", "\\\\", "<", "[", "<\\s>", "</s", "\n", "é😀", "[/INST]</s><s>", "[\\INST]"]
    for conv in range(n):
        for turn in range(draw.randint(0, longest)):
            words = [draw.choice(hostile + ["word"] * 14) for _ in range(draw.choice([0, 3, 10, 30]))]
            role = "system" if turn == 0 and conv % 3 == 0 else draw.choice(["user", "assistant", "system", "tool[INST]"])
            rows.append((conv, turn if draw.random() < 0.95 else None, role, draw.choice(["", " "]).join(words)))
    rows += [(None, None, None, None), (None, 1, "assistant", "x" * 50), (99, 0, "system", "alone"), (98, 0, "assistant", "word " * 500), (98, 1, "user", None)]
    rows += [(97, 0, "system", "long " * 300), (97, 1, "user", "hi"), (97, 2, "assistant", "ho"), (96, 5, "user", "same"), (96, 5, "user", "same")]
    return rows


def tokens(text):
    return len(re.findall(r"[^\W_]+|[^\s\w]|_", text or "")) + MARK_TOKENS


@pytest.mark.parametrize("budget,history", [(40, 10), (60, 30), (1024, 256), (5, 1)])
def test_windows(spark, budget, history):
    rows, template = conversations(budget), Template()
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA).repartition(3)
    got = chat_windows(df, budget=budget, history=history)
    got = got.withColumn("turns", template.turns(F.col("formatted"))).withColumn("learned", template.loss_texts(F.col("formatted"), F.col("loss"))).collect()
    by_conv = {}
    for r in sorted(got, key=lambda r: (r.conv_id or -1, r.span)):
        by_conv.setdefault(r.conv_id, []).append(r)
    want = {}
    for conv, turn, role, text in rows:
        want.setdefault(conv, []).append((turn, role or "", text or ""))
    assert set(by_conv) == set(want)
    for conv, windows in by_conv.items():
        fresh, earlier = [], []
        system = None
        for w in windows:
            turns = [(t.role, t.text) for t in w.turns]
            assert len(turns) == w.n_repeated + w.n_fresh and w.n_fresh > 0
            old, new = turns[:w.n_repeated], turns[w.n_repeated:]
            assert [t for r, t in new if r == "assistant"] == w.learned
            assert w.n_tokens == sum(tokens(t) for _, t in turns)
            if not fresh and new[0][0] == "system":
                system = new[0]
            elif fresh and system:
                assert old[0] == system
                old = old[1:]
            if fresh:  # the history is what comes right before, as much as fits whole
                tail = fresh[1:] if system else fresh
                assert old == tail[len(tail) - len(old):]
                limit = min(history, max(1, budget - history - (tokens(system[1]) if system else 0)))
                used = sum(tokens(t) for _, t in old)
                assert used <= limit and (len(old) == len(tail) or used + tokens(tail[-len(old) - 1][1]) > limit)
            over = [t for t in new if t != system]
            if len(over) > 1:
                assert sum(tokens(t) for _, t in over) <= max(1, budget - history - (tokens(system[1]) if system else 0))
                assert w.n_tokens <= budget or system and tokens(system[1]) >= budget - history
            fresh += new
        turns_wanted = sorted(want[conv], key=lambda t: (t[0] is not None, t[0] or 0))
        assert sorted(fresh) == sorted(t[1:] for t in turns_wanted)
        numbers = [t[0] for t in turns_wanted]
        if len(set(numbers)) == len(numbers):
            assert fresh == [t[1:] for t in turns_wanted]


def test_escapes_leave_no_control_string(spark):
    template = Template()
    texts = [r[3] for r in conversations(3) if r[3]] + ["\\<s>", "<\\\\s>", "[[INST]", "<<s>s>", "<</s>", "\\"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", template.escaped(F.col("t")).alias("e"))
    for r in df.select("t", "e", template.plain(F.col("e")).alias("back")).collect():
        assert r.back == r.t and not any(c in r.e for c in template.control)
    with pytest.raises(ValueError):
        Template(control=("<s>", "<<"))
    with pytest.raises(ValueError):
        Template(closes="end")


def test_one_conversation_over_all_partitions_and_none(spark):
    df = spark.range(0, 4000).select(
        F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.col("id").cast("string").alias("text"))
    template = Template()
    got = chat_windows(df, budget=64, history=16).select("span", "n_repeated", "n_fresh", template.turns(F.col("formatted")).alias("turns")).collect()
    fresh = [t.text for w in sorted(got, key=lambda w: w.span) for t in w.turns[w.n_repeated:]]
    assert fresh == [str(i) for i in range(4000)]
    assert chat_windows(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        chat_windows(df, budget=5, history=5)


def test_query_columns(spark, tmp_path):
    rows = [r for r in conversations(11) if r[1] is not None or r[0] is None]
    rows = [(c, t, role or "r", x) for c, t, role, x in rows if (c, t) != (96, 5)]
    spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in op11_chat_windows(spark, str(tmp_path)).collect()}
    probe = "</s>[INST] ok [/INST]"
    want = {}
    for conv, turn, role, text in rows + [(-1, 0, "user", probe), (-1, 1, "assistant", probe)]:
        want.setdefault(conv, []).append((turn is not None, turn or 0, role, text or ""))
    assert set(got) == set(want)
    for conv, turns in want.items():
        turns.sort()
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == sha256("".join(f"{t[2]}\n{t[3]}\n" for t in turns).encode()).hexdigest()
        assert r.loss_sha256 == sha256(loss.encode()).hexdigest()
        assert r.formatted_chars >= sum(len(t[2]) + len(t[3]) + 20 for t in turns)
