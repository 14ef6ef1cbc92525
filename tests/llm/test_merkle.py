"""The Merkle manifest against trees built in one place."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from corpusloom.llm.merkle import folded, merkle_manifest, record_digest
from corpusloom.llm.queries import op13_merkle_manifest


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(all_levels, at):
    out = []
    for level in all_levels[:-1]:
        out.append((level[at ^ 1] if at ^ 1 < len(level) else "", bool(at & 1)))
        at >>= 1
    return out


def record(*fields):
    return h(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def by_hand(rows):
    """{(doc_id, leaf): [(lang, subroot, root, steps)]} of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0], record(*row)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([d for _, d in sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for g in order}
    crown = levels([trees[g][-1][0] for g in order])
    out = {}
    for at, g in enumerate(order):
        members = sorted(groups[g], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        for i, key in enumerate(members):
            out.setdefault(key, []).append((g, trees[g][-1][0], crown[-1][0], siblings(trees[g], i), siblings(crown, at)))
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, path int"


def table(n, seed):
    draw = random.Random(seed)
    rows = [(i, draw.choice(["a", None, "é"]), draw.choice(["en", "en", "en", "de", None, "ü"]), draw.choice([None, 3]), draw.choice([None, "", "text", "日本 text" * 50]))
            for i in draw.sample(range(10 * n), n)]
    return rows + rows[:3] + [(None, None, None, None, None), (None, "x", "en", 1, "y"), (5, "only", "zz", 1, "alone")]


@pytest.mark.parametrize("n,tier", [(150, 2), (150, 3), (40, 10), (1, 1)])
def test_paths_and_roots(spark, n, tier):
    rows = table(n, n + tier)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(5)
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    got = merkle_manifest(df, record_digest(*fields), tier=tier).withColumn("back", folded(F.col("leaf"), F.col("path"), F.col("top_path"))).collect()
    want = by_hand(rows)
    assert len(got) == len(rows)
    for r in got:
        same = want[(r.doc_id, r.leaf)]
        found = [(s.digest, s.left) for s in r.path], [(s.digest, s.left) for s in r.top_path]
        assert (r.grp, r.subroot, r.root, *found) in same
        assert r.back == r.root
        span = (r["rank"], r["rank"] + 1)  # a sibling's interval continues the child's, and together they are the parent's
        for s in r.path:
            assert s.hi == span[0] if s.left else s.lo == span[1]
            assert (s.lo == s.hi) == (s.digest == "")
            span = (s.lo, span[1]) if s.left else (span[0], s.hi)
        assert span[0] == 0


def test_tier_changes_nothing_and_empty(spark):
    df = spark.createDataFrame([(*r, "", 1) for r in table(60, 3)], SCHEMA)
    leaf = record_digest(F.col("doc_id"), F.col("text"))
    one, two = ({(r.doc_id, r.leaf, r["rank"], r.grp, r.root, str(r.path)) for r in merkle_manifest(df, leaf, tier=t).collect()} for t in (1, 6))
    assert one == two
    assert merkle_manifest(df.limit(0), leaf).collect() == []
    with pytest.raises(ValueError):
        merkle_manifest(df, leaf, tier=0)


def test_one_group_over_many_partitions(spark):
    df = spark.range(0, 3000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"))
    got = merkle_manifest(df, record_digest(F.col("doc_id")), tier=5).select("doc_id", "rank", "root").collect()
    assert [r["rank"] for r in sorted(got, key=lambda r: r.doc_id)] == list(range(3000))
    assert {r.root for r in got} == {levels([record(i) for i in range(3000)])[-1][0]}


def test_query_columns(spark, tmp_path):
    rows = table(80, 9)
    spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = op13_merkle_manifest(spark, str(tmp_path)).collect()
    want, changed = by_hand(rows), {}
    for row in rows:
        meant = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None
        changed[(row[0], record(*row))] = record(*row[:3], row[3] + 1, row[4]) if meant else record(*row)
    assert len(got) == len(rows) and not all(r.verified for r in got) and any(r.verified for r in got)
    for r in got:
        proofs = set()
        for _, subroot, root, low, top in want[(r.doc_id, r.leaf)]:
            fold = changed[(r.doc_id, r.leaf)]
            for digest, left in low + top:
                fold = h(digest, fold) if left else h(fold, digest)
            proofs.add((subroot, root, h(*[d for d, _ in low + top]), fold, fold == root))
        assert (r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) in proofs
