"""Shards and source mixing against their definitions."""

import math
import random
import zlib
from collections import Counter

import pytest

from corpusloom.llm.mixing import BLOCKS, bisect_exponent, mix_sources
from corpusloom.llm.sharding import byte_shards


def test_shards_follow_the_middle_byte(spark):
    draw = random.Random(1)
    rows = [(i, "é" * draw.randint(0, 300)) for i in range(300)] + [(5000, None), (5001, ""), (6000, "z" * 20_000)]
    rows += [(7, "same")] * 40 + [(None, "no id"), (None, None)]
    df = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, size int").repartition(5)
    got = byte_shards(df, 8).collect()
    assert len(got) == len(rows)
    layout = sorted(got, key=lambda r: (r.shard, r.slot))
    key = [(-1 if r.doc_id is None else r.doc_id, r.text_crc32, r["size"]) for r in layout]
    assert key == sorted((-1 if i is None else i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in rows)
    total, at, slots = sum(k[2] for k in key), 0, Counter()
    for r in layout:
        assert r.shard == (2 * at + r["size"]) * 8 // (2 * total) and r.slot == slots[r.shard]
        at += r["size"]
        slots[r.shard] += 1


def test_more_shards_than_rows_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "bb")], "doc_id long, text string")
    assert {r.shard for r in byte_shards(df, 8).collect()} <= set(range(8))
    assert byte_shards(df.limit(0), 8).collect() == []


def documents(spark, seed=2):
    draw = random.Random(seed)
    rows, doc_id = [], 0
    for source, n in [("big", 900), ("mid", 200), ("small", 60), ("", 40), (None, 50)]:
        for _ in range(n):
            rows.append((doc_id, "w " * draw.randint(1, 40), source))
            doc_id += 1
    rows += [(doc_id, None, "empty"), (doc_id + 1, "  ", "empty"), (3, rows[3][1], rows[3][2])]
    return rows, spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, block int").repartition(4)


def tokens(text):
    return len((text or "").split())


def check_mix(rows, got, shares_to, budget):
    """Each source's tokens are its budget's within half a block, and passes are whole but for the last."""
    total = Counter()
    for _, text, source in rows:
        total[source] += tokens(text)
    live = {s: n for s, n in total.items() if n}
    alpha = shares_to(live)
    weights = {s: (n / sum(live.values())) ** alpha for s, n in live.items()}
    if budget is None:
        budget = max(n / weights[s] for s, n in live.items()) * sum(weights.values())
    for s, n in total.items():
        mine = [r for r in got if r.source == s]
        if not n:
            assert len(mine) == sum(1 for r in rows if r[2] == s) and {r.pass_no for r in mine} == {0}
            continue
        quota = budget * weights[s] / sum(weights.values())
        of_block = Counter()
        for r in mine:
            if r.pass_no == 0:
                of_block[r["_block"]] += r.n_tokens
        assert abs(sum(r.n_tokens for r in mine) - quota) <= max(max(of_block.values()), 40) / 2 + 1
        for p in range(int(quota // n)):
            assert Counter(r.doc_id for r in mine if r.pass_no == p) == Counter(i for i, _, t in rows if t == s)
        ranks = {(r.pass_no, r["_block"]): r.block_rank for r in mine}
        for p in {r.pass_no for r in mine}:
            used = sorted(v for (q, _), v in ranks.items() if q == p)
            assert used == list(range(1, len(used) + 1)) and len(used) <= BLOCKS


def test_repeat_limit(spark):
    rows, df = documents(spark)
    got = mix_sources(df, repeats=2.0).collect()

    def exponent(live):
        return 1 - math.log(2) / math.log(max(live.values()) / min(live.values()))

    check_mix(rows, got, exponent, None)
    assert {r.doc_id for r in got} == {r[0] for r in rows}


def test_entropy_and_budget(spark):
    rows, df = documents(spark)
    got = mix_sources(df, entropy=0.9, budget=9_000).collect()

    def exponent(live):
        def entropy(a):
            w = [(n / sum(live.values())) ** a for n in live.values()]
            return -sum(x / sum(w) * math.log(x / sum(w)) for x in w) / math.log(len(w))

        low, high = 0.0, 1.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if entropy(mid) >= 0.9 else (low, mid)
        return low

    check_mix(rows, got, exponent, 9_000)
    assert abs(sum(r.n_tokens for r in got) - 9_000) < 200


def test_mixing_corner_cases(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (2, None, None), (3, "", "")], "doc_id long, text string, source string")
    assert Counter(r.doc_id for r in mix_sources(df, repeats=2.0).collect()) == {1: 2, 2: 1, 3: 1}
    assert mix_sources(df.limit(0), repeats=2.0).collect() == []
    equal = spark.createDataFrame([(s, 10) for s in "abc"], "source string, tokens long")
    assert bisect_exponent(equal, entropy=0.5) == 1.0
    for wrong in ({}, {"entropy": 0.5, "repeats": 2.0}):
        with pytest.raises(ValueError):
            mix_sources(df, **wrong)
