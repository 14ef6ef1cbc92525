"""Exact and near duplicates against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from corpusloom.llm.block_naming import exact_duplicates, identities
from corpusloom.llm.components import components
from corpusloom.llm.gray_index import gray_rank, linked
from corpusloom.llm.simhash import fingerprint_components, near_duplicates, simhash


def by_hand(rows):
    groups = {}
    for i, (doc_id, text) in enumerate(rows):
        groups.setdefault(text or "", []).append((-1 if doc_id is None else doc_id, i))
    out = []
    for text, members in groups.items():
        keep = max(members)[0]
        out += [(doc_id, keep, len(members)) for doc_id, _ in members]
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [4, 8192])
def test_exact_duplicates(spark, block_bytes):
    draw = random.Random(4)
    shared = "h" * 100
    rows = [(1, "a"), (2, None), (3, ""), (4, "a"), (4, "a"), (None, "a"), (7, "é" * 300), (8, "é" * 300), (9, "é" * 299 + "è")]
    rows += [(10 + i, shared + draw.choice("xyz") + "m" * draw.randint(0, 3) + shared) for i in range(40)]
    rows += [(100 + i, "A") for i in range(30)] + [(200, "a "), (201, "long" * 3000), (202, "long" * 3000), (203, "long" * 2999 + "lonG")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, row_id string").repartition(3)
    got = exact_duplicates(df, block_bytes=block_bytes).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.keep_id, r.group_size) for r in got) == by_hand(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({t or "" for _, t in rows}) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_duplicates_of_nothing(spark):
    assert exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_names_do_not_mix_lengths(spark):
    texts = [b"", b"ab", b"abab", b"ab", b"ababab", b"abab", b"abababab", b"abababab", b"ababababab"]
    df = spark.createDataFrame(list(enumerate(map(bytearray, texts))), "row_id long, content binary")
    names = {r.row_id: (r.n_bytes, r.name) for r in identities(df, block_bytes=2).collect()}
    assert all((names[i] == names[j]) == (texts[i] == texts[j]) for i in range(len(texts)) for j in range(len(texts)))


def fingerprint_by_hand(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_by_hand():
    draw = random.Random(5)
    for text in [None, "", " \t\n", "One", "a b c", "a b c d", "É é A", "a\x0bb\x0cc d e f", "x " * 500, "p\x1cq r"]:
        assert simhash(text) == fingerprint_by_hand(text), text
    for _ in range(50):
        text = " ".join(draw.choice(["a", "B", "cé", "d"]) for _ in range(draw.randint(1, 40)))
        assert simhash(text) == fingerprint_by_hand(text)


def sets_by_hand(codes, limit, group=None):
    root = list(range(len(codes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if (group is None or group[i] == group[j]) and bin(codes[i] ^ codes[j]).count("1") <= limit:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(codes))]


def clouds(draw, n_clouds, size, spread):
    out = []
    for _ in range(n_clouds):
        centre = draw.getrandbits(64)
        for _ in range(size):
            code = centre
            for _ in range(draw.randint(0, spread)):
                code ^= 1 << draw.randrange(64)
            out.append(code)
    return out


def test_gray_rank_orders_single_bit_steps():
    codes = np.array([i ^ i >> 1 for i in range(1000)], np.uint64)
    assert gray_rank(codes).tolist() == list(range(1000))


@pytest.mark.parametrize("limit", [0, 2, 4])
def test_gray_index_finds_every_link(limit):
    draw = random.Random(limit)
    codes = clouds(draw, 12, 25, 5) + [draw.getrandbits(64) for _ in range(100)] + [0, 0, 2**64 - 1]
    group = [draw.randrange(3) for _ in codes]
    order = np.lexsort((gray_rank(np.array(codes, np.uint64)), group))
    codes, group = [codes[i] for i in order], [group[i] for i in order]
    label = linked(np.array(group), np.array(codes, np.uint64), limit)
    expected = sets_by_hand(codes, limit, group)
    pairs = {(a, b) for a, b in zip(label.tolist(), expected)}
    assert len(pairs) == len(set(expected)) == len(set(label.tolist()))


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(-20, 60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5), (7, 6), (6, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: -20 for i in range(-20, 61)} | {1000 + i: 1000 for i in range(50)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_fingerprint_components_are_whole(spark):
    draw = random.Random(8)
    codes = clouds(draw, 6, 60, 6) + clouds(draw, 30, 3, 3) + [draw.getrandbits(64) for _ in range(200)] + [0, 1, 3, 7, 15]
    codes = sorted(set(codes))
    signed = [(c - 2**64 if c >= 2**63 else c,) for c in codes]
    got = {r.node: r.root for r in fingerprint_components(spark.createDataFrame(signed * 2, "fingerprint long")).collect()}
    expected = sets_by_hand(codes, 4)
    mine = [got.get(s[0], s[0]) for s in signed]
    assert len(set(zip(mine, expected))) == len(set(expected)) == len(set(mine))


def test_near_duplicates_rows(spark):
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(5, base), (3, base + " end"), (9, base.upper().replace("W", "w")), (7, "quite another text of its own here"),
            (8, None), (2, "  "), (4, ""), (None, base), (5, base), (11, "word " * 5000)]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, fingerprint string")
    got = near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 3), (3, 3), (9, 3), (None, 3), (7, 7), (8, 2), (2, 2), (4, 2), (11, 11)}
    assert {r.fingerprint for r in got if r.component_id == 2} == {"0" * 16}
    assert all(r.fingerprint == f"{simhash(dict(rows)[r.doc_id]):016x}" for r in got if r.doc_id in (5, 7, 8, 11))
    assert near_duplicates(df.limit(0)).collect() == []
