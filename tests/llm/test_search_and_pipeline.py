"""Nearest neighbours against brute force; the pipeline stage by stage."""

import math
import random

import numpy as np
import pytest

import corpus_pipeline
from corpusloom.llm import projection_knn
from corpusloom.llm.bpe_codec import Codec
from corpusloom.llm.projection_knn import nearest_neighbours
from corpusloom.llm.simhash import simhash
from corpusloom.llm.stable_projection import Searcher, chi_square, chi_square_quantile, directions, leaf_of, split


def test_chi_square_law():
    draw = np.random.default_rng(0)
    sums = (draw.standard_normal((200_000, 8)) ** 2).sum(axis=1)
    for p in (0.1, 0.5, 0.97):
        assert abs((sums <= chi_square_quantile(p, 8)).mean() - p) < 0.01
    assert chi_square(0.0, 6) == 0.0


def test_tree_leaves_are_small_unless_all_alike():
    points = np.r_[np.random.default_rng(1).standard_normal((500, 4)), np.ones((300, 4))]
    tree = split(points, 20)
    leaf = leaf_of(tree, points)
    for n in np.unique(leaf):
        inside = points[leaf == n]
        assert len(inside) <= 20 or np.ptp(inside, axis=0).max() == 0


def clusters(n, dims, seed, scale=1.0):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((12, dims)) * 2
    return (centres[draw.integers(0, 12, n)] + draw.standard_normal((n, dims)) * 0.5) * scale


def brute(ids, vectors, query_id, query, k):
    keep = ids != query_id
    scores = (vectors[keep] * query).sum(axis=1)
    order = np.lexsort((ids[keep], -scores))[:k]
    return ids[keep][order].tolist(), scores[order].tolist()


def test_searcher_stops_early_and_finds_most():
    vectors = clusters(4000, 24, 3)
    longest = float(np.sqrt((vectors**2).sum(axis=1)).max())
    search = Searcher(np.arange(4000), vectors, longest, directions(24, 8, 1))
    asked, hits = np.arange(0, 4000, 100), 0
    who, ids, scores = search.nearest(asked, vectors[asked], 10, chi_square_quantile(0.97, 8))
    for i, q in enumerate(asked.tolist()):
        expected, _ = brute(np.arange(4000), vectors, q, vectors[q], 10)
        own = ids[who == i]
        assert len(own) == 10 and scores[who == i].tolist() == (vectors[own] * vectors[q]).sum(axis=1).tolist()
        hits += len(set(own.tolist()) & set(expected))
    assert hits >= 0.9 * 400
    near = search.nearest(asked, vectors[asked], 10, chi_square_quantile(0.97, 8), np.full(len(asked), 1e-12))
    assert len(near[0]) < 400  # what is known elsewhere ends the search


def test_searcher_keeps_ties_by_id():
    draw = np.random.default_rng(4)
    vectors = draw.integers(-2, 3, (3000, 6)).astype(np.float64)  # many equal products
    ids = draw.permutation(3000)
    longest = float(np.sqrt((vectors**2).sum(axis=1)).max())
    search = Searcher(ids, vectors, longest, directions(6, 8, 1))
    who, found, scores = search.nearest(ids[:300], vectors[:300], 15, 1e9)
    for i in range(300):
        assert (found[who == i].tolist(), scores[who == i].tolist()) == brute(ids, vectors, ids[i], vectors[i], 15)


def test_neighbours_have_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(projection_knn, "CELL", 300)
    monkeypatch.setattr(projection_knn, "QUERIES", 16)
    monkeypatch.setattr(projection_knn, "SAMPLE", 500)
    vectors = clusters(2500, 16, 5).astype(np.float32).astype(np.float64)
    vectors[1000:1400] = vectors[999]  # one very common vector
    ids = np.arange(2500) * 3
    df = spark.createDataFrame([(int(i), v.tolist(), "x") for i, v in zip(ids, vectors)], "vec_id long, embedding array<float>, score string").repartition(6)
    got = nearest_neighbours(df, df.where("vec_id % 20 = 0"), 20).collect()
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    assert set(by_query) == {int(i) for i in ids if i % 20 == 0}
    for q, found in by_query.items():
        found.sort()
        expected, scores = brute(ids, vectors, q, vectors[q // 3], 20)
        assert [f[0] for f in found] == list(range(1, 21))
        assert [f[1:] for f in found] == sorted((f[1:] for f in found), key=lambda x: (-x[1], x[0]))
        assert all(math.isclose(s, float((vectors[v // 3] * vectors[q // 3]).sum()), rel_tol=1e-12) for _, v, s in found)
        hits += len({v for _, v, _ in found} & set(expected))
        if 999 <= q // 3 < 1400:
            assert [v for _, v, _ in found] == expected
    assert hits >= 0.95 * 20 * len(by_query)


@pytest.mark.parametrize("small", [False, True])
def test_repeated_ids_queries_and_lengths(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(projection_knn, "CELL", 40)
        monkeypatch.setattr(projection_knn, "QUERIES", 8)
    draw = np.random.default_rng(2)
    rows = [(int(i), (draw.integers(-3, 4, 4 + 2 * (i % 3 == 0)) + 0.5).tolist()) for i in range(200)]
    rows += [rows[20]] * 30 + [(1000, [9.5] * 6)] * 25 + [(1001, [9.5] * 6), (1002, [9.5] * 6), (40, rows[60][1]), (41, rows[60][1]), (40, [0.5, -0.0]), (7, [0.0, 1.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int").repartition(5)
    found = {}
    for r in nearest_neighbours(df, df.where("vec_id % 20 = 0"), 20, confidence=0.9999999).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    distinct, want = {(i, tuple(v)) for i, v in rows}, {}
    for q, x in distinct:
        if q % 20 == 0:
            others = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in distinct if i != q and len(y) == len(x))
            want.setdefault(q, []).extend((n + 1, i, -s) for n, (s, i) in enumerate(others[:20]))
    assert {q: sorted(f) for q, f in found.items()} == {q: sorted(w) for q, w in want.items()}


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [2.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (40, [0.0, 0.0]), (9, [-1.0, -3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in nearest_neighbours(df, df.where("vec_id % 20 = 0"), 20).collect())
    assert got == [(0, 1, 1, 2.0), (0, 2, 20, 0.5), (0, 3, 9, -1.0), (20, 1, 1, 1.5), (20, 2, 0, 0.5), (20, 3, 9, -2.0)]
    assert nearest_neighbours(df.limit(0), df, 20).collect() == []
    assert nearest_neighbours(df, df.limit(0), 20).collect() == []
    with pytest.raises(ValueError):
        nearest_neighbours(df, df, 20, m=3)


def raw_documents():
    draw = random.Random(4)
    words = ["the", "and", "for", "über", "nicht", "auch", "les", "dans", "pour"]
    rows = []
    for i in range(120):
        at = 3 * (i % 3)
        text = " ".join(draw.choice(words[at:at + 3]) + draw.choice(["", "s", "en", "ly"]) for _ in range(draw.randint(30, 90)))
        rows.append((i, text, ("en", "de", "fr")[i % 3], "big" if i % 3 else "small"))
    rows += [(500 + i, rows[i][1], rows[i][2], "big") for i in range(10)]
    rows += [(600, None, "en", "big"), (601, "", "de", None), (602, "12 34", None, "small"), (None, rows[0][1], "en", "big"), (603, "the and", None, None)]
    return rows


def by_hand(stage, rows):
    if stage == "exact_dedup":
        best = {}
        for i, r in enumerate(rows):
            key = (-1 if r[0] is None else r[0], i)
            best[r[1]] = max(best.get(r[1], key), key)
        return [rows[i] for _, i in best.values()]
    codes = [simhash(r[1]) for r in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(i):
                if bin(codes[i] ^ codes[j]).count("1") <= 4:
                    root[i] = root[j] = min(root[i], root[j])
    return [min((rows[i] for i in range(len(rows)) if root[i] == r), key=lambda x: -1 if x[0] is None else x[0]) for r in set(root)]


def test_stages(spark):
    rows = raw_documents()
    docs = spark.createDataFrame([(i, t, lang, source, 1, "c") for i, t, lang, source in rows],
                                 "doc_id long, text string, lang string, source string, row_id int, fingerprint string")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "exact_dedup", "near_dedup", "mixing", "encoding"]
    known = stages["language"](spark, docs, "").cache()
    assert known.columns == docs.columns
    assert sorted(r.text for r in known.collect()) == sorted(t for i, t, *_ in rows if i not in (600, 601, 602))
    once = stages["exact_dedup"](spark, known, "").cache()
    take = lambda df: [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]
    order = lambda x: sorted(x, key=lambda r: (-1 if r[0] is None else r[0], r[1]))
    assert order(take(once)) == order(by_hand("exact_dedup", take(known)))
    near = stages["near_dedup"](spark, once, "").cache()
    assert order(take(near)) == order(by_hand("near_dedup", take(once))) and near.columns == docs.columns
    mix = stages["mixing"](spark, near, "").cache()
    assert set(take(mix)) == set(take(near)) and mix.columns == docs.columns
    assert 0 < mix.count() - near.count() <= near.where("source is null or source = 'small'").count()
    last = stages["encoding"](spark, mix, "").collect()
    import public_tokenizers

    codec = Codec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert len(last) == mix.count() and all(r.restored and r.n_tokens == len(r.ids) for r in last)
    texts = {(r.doc_id, codec.decode(r.ids).decode()) for r in last}
    assert texts == {(r[0], r[1]) for r in take(near)}


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_near_dedup_is_by_fingerprint_bits(spark):
    """Of each set that fingerprints of 4 or fewer differing bits link, the smallest id stays; texts further apart all stay."""
    draw = random.Random(6)
    rows = []
    for g in range(12):
        base = [f"g{g}w{draw.randrange(10_000)}" for _ in range(600)]
        for i in range(4):
            words = list(base)
            for at in draw.sample(range(600), i):
                words[at] = "edited"
            rows.append((10 * g + 3 - i, " ".join(words), "en", "s"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs.repartition(3), "")
    expected = by_hand("near_dedup", rows)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in expected)
    assert 12 <= len(expected) < len(rows)
