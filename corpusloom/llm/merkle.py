"""A Merkle manifest of a table: a hash tree for each group of rows, and one tree over the groups' roots.

Every node carries the interval of leaf ranks that it covers. Levels are bucketed in tiers: a bucket is the nodes of one
tier under one node of the next, attached by containment of their intervals (ranks divided by the span), so it has at
most 2^tier nodes, and a group, however large, is many of them. Climbing, a bucket becomes the node above it;
descending, it receives that node's way to the root and hands each of its nodes a way of its own, whose siblings are
the differences between the intervals of a parent and its child.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.arrow_runs import whole_runs
from corpusloom.llm.columns import quoted
from corpusloom.llm.ordering import laid_out, ranked
from corpusloom.scratch import settle

TIER = 10  # levels of a bucket
PATH = "array<struct<level:int,lo:long,hi:long,digest:string,left:boolean>>"
_STEP = pa.struct([("level", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64()), ("digest", pa.string()), ("left", pa.bool_())])
Node = tuple[int, int, str]  # lo, hi, digest
Step = tuple[int, int, int, str, bool]  # level of the child, the sibling's lo and hi, its digest, whether it is before the child


def record_digest(*fields: Column) -> Column:
    """SHA-256, in lower-case hex, of the fields: ``-`` for null, else the UTF-8 byte count, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def folded(leaf: Column, *paths: Column) -> Column:
    """The root that a leaf's digest gives with the siblings of its ``paths``, each going on where the one before it ends."""
    def up(below: Column, step: Column) -> Column:
        return F.sha2(F.when(step["left"], F.concat(step["digest"], below)).otherwise(F.concat(below, step["digest"])), 256)

    return F.aggregate(F.concat(*paths), leaf, up)


def levels_of(digests: Sequence[str], first: int, unit: int, n_leaves: int) -> list[list[Node]]:
    """A bucket's nodes level by level up to the single one; ``first`` is the place of its first node in its tier.

    A node of the tier covers ``unit`` leaves, the group's last one what is left.
    """
    now = [((first + i) * unit, min((first + i + 1) * unit, n_leaves), d) for i, d in enumerate(digests)]
    levels = [now]
    while len(now) > 1:
        pairs = [now[i:i + 2] for i in range(0, len(now), 2)]
        now = [(p[0][0], p[-1][1], sha256("".join(node[2] for node in p).encode()).hexdigest()) for p in pairs]
        levels.append(now)
    return levels


def _raised(levels: list[list[Node]], height: int) -> list[list[Node]]:
    """The last bucket of a group may be short: its single node goes on alone up to the ``height`` of the others."""
    while len(levels) <= height:
        lo, hi, digest = levels[-1][0]
        levels.append([(lo, hi, sha256(digest.encode()).hexdigest())])
    return levels


def way_up(levels: list[list[Node]], at: int, lowest: int) -> list[Step]:
    """The steps from node ``at`` of the first level to the top; a child that is its parent's all has an empty sibling."""
    steps = []
    for j in range(len(levels) - 1):
        (a, b, _), (lo, hi, _) = levels[j][at], levels[j + 1][at >> 1]
        if lo < a:
            steps.append((lowest + j, lo, a, levels[j][at - 1][2], True))
        else:
            steps.append((lowest + j, b, hi, levels[j][at + 1][2] if b < hi else "", False))
        at >>= 1
    return steps


def _bucket(digests: list[str], number: int, size: int, n: int, at_tier: int, tier: int) -> list[list[Node]]:
    levels = levels_of(digests, number << tier, 1 << tier * at_tier, n)
    return _raised(levels, tier if size > 1 << tier else 0)


def _paths(ways: list[list[Step]]) -> pa.Array:
    ends, flat = [0], []
    for way in ways:
        flat += way
        ends.append(len(flat))
    columns = [pa.array([s[i] for s in flat], field.type) for i, field in enumerate(_STEP)]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(_STEP)))


def _climb(at_tier: int, tier: int):
    """Rows (g, bucket, rank, n, size, digest), sorted -> the node above each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, runs in whole_runs(batches, 2):
            digests, heads = table.column("digest").to_pylist(), table.take(pa.array([a for a, _ in runs]))
            bucket, n, size = (heads.column(c).to_pylist() for c in ("bucket", "n", "size"))
            tops = [_bucket(digests[a:b], bucket[i], size[i], n[i], at_tier, tier)[-1][0][2] for i, (a, b) in enumerate(runs)]
            yield from pa.table({
                "g": heads.column("g"), "rank": heads.column("bucket"), "n": heads.column("n"),
                "size": pa.array([-(-s >> tier) for s in size], pa.int64()), "digest": pa.array(tops, pa.string())}).combine_chunks().to_batches()

    return run


def _descend(at_tier: int, tier: int):
    """Rows (g, bucket, rank, n, size, digest, path, own), sorted -> (g, rank, digest, path, own) of the nodes.

    A bucket's first row, of rank -1, has the path of the node above it, where there is one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, runs in whole_runs(batches, 2):
            digests, rank = table.column("digest").to_pylist(), table.column("rank").to_pylist()
            bucket, n, size = (table.column(c).to_pylist() for c in ("bucket", "n", "size"))
            keep, ways = [], []
            for a, b in runs:
                above = []
                if rank[a] < 0:
                    above = [tuple(s.values()) for s in table.column("path")[a].as_py()]
                    a += 1
                levels = _bucket(digests[a:b], bucket[a], size[a], n[a], at_tier, tier)
                keep += range(a, b)
                ways += [way_up(levels, i, tier * at_tier) + above for i in range(b - a)]
            kept = table.select(["g", "rank", "digest", "own"])
            for some in range(0, len(keep), 1024):  # paths are long: batches of them are kept small
                rows = kept.take(pa.array(keep[some:some + 1024], pa.int64()))
                yield from pa.table({
                    "g": rows.column("g"), "rank": rows.column("rank"), "digest": rows.column("digest"),
                    "path": _paths(ways[some:some + 1024]), "own": rows.column("own")}).combine_chunks().to_batches()

    return run


def _tree(leaves: DataFrame, own_type: str, tier: int) -> tuple[DataFrame, DataFrame]:
    """``g, digest, n`` of every group's root, and ``g, rank, digest, path, own`` of every leaf.

    ``leaves`` is a written table of ``g`` (string, may be null), ``rank`` in it from 0, ``n`` leaves, ``digest`` and ``own``, passed through.
    """
    tiers = [leaves.withColumn("size", F.col("n"))]
    while True:
        nodes = tiers[-1].select("g", F.shiftright("rank", tier).alias("bucket"), "rank", "n", "size", "digest")
        dealt = nodes.repartition("g", "bucket").sortWithinPartitions("g", "bucket", "rank")
        above = settle(dealt.mapInArrow(_climb(len(tiers) - 1, tier), "g string, rank long, n long, size long, digest string"))
        if (above.agg(F.max("size")).first()[0] or 0) <= 1:  # one number a tier
            break
        tiers.append(above.withColumn("own", F.lit(None).cast(own_type)))
    paths = None
    for at_tier in reversed(range(len(tiers))):
        nodes = tiers[at_tier].select(
            "g", F.shiftright("rank", tier).alias("bucket"), "rank", "n", "size", "digest", F.lit(None).cast(PATH).alias("path"), "own")
        if paths is not None:
            nodes = nodes.unionByName(paths.select(
                "g", F.col("rank").alias("bucket"), F.lit(-1).cast("long").alias("rank"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("size"),
                "digest", "path", F.lit(None).cast(own_type).alias("own")))
        dealt = nodes.repartition("g", "bucket").sortWithinPartitions("g", "bucket", "rank")
        paths = dealt.mapInArrow(_descend(at_tier, tier), f"g string, rank long, digest string, path {PATH}, own {own_type}")
    return above.select("g", "digest", "n"), paths


def merkle_manifest(df: DataFrame, leaf: Column, *, id_col: str = "doc_id", group_col: str = "lang", carry: Sequence[tuple[str, Column]] = (),
                    tier: int = TIER) -> DataFrame:
    """``doc_id, grp, rank, leaf, subroot, root, path, top_path`` and the ``carry`` of every row of ``df``.

    Leaves have the digests ``leaf``. In each group (null is one) they ascend by id (null first), then digest. While a level has more than one node,
    every two consecutive ones, or the last one alone, become the SHA-256 (hex) of their digests in a row;
    the last node is the group's ``subroot``. The subroots, by group (null first, then bytewise), become ``root`` likewise.
    ``path`` leads from the leaf to the subroot, ``top_path`` from there to the root: one step a level with the interval of the
    sibling's leaves ``[lo, hi)`` (of its groups in ``top_path``), its digest, empty with an empty interval where there is none, and whether
    it lies left. A lone leaf is its subroot, a lone subroot the root. Repeated rows are leaves of their own; an empty table gives no rows.

    ``carry`` are (name, column) pairs of small values; they are calculated with the leaves and are not hashed. The driver sees
    one number a tier of ``2^tier``-fold buckets, and the root.
    """
    if not 1 <= tier <= 16:
        raise ValueError("tier must be from 1 to 16")
    own = F.struct(F.col(quoted(id_col)).alias("id"), *[c.alias(f"c{i}") for i, (_, c) in enumerate(carry)])
    rows = settle(df.select(
        F.col(quoted(group_col)).cast("string").alias("g"), leaf.alias("digest"), own.alias("own"), F.monotonically_increasing_id().alias("row"))
        .withColumn("id", F.col("own.id")))
    own_type = rows.schema["own"].dataType.simpleString()
    placed = settle(ranked(laid_out(rows, ["g", "id", "digest", "row"]), "g").select("g", "rank", "n", "digest", "own"))
    subroots, paths = _tree(placed, own_type, tier)

    tops = settle(subroots.select(F.lit("all").alias("every"), "g", "digest"))
    tops = settle(ranked(laid_out(tops, ["every", "g"]), "every").select(
        F.col("every").alias("g"), "rank", "n", "digest", F.struct(F.col("g").alias("grp")).alias("own")))
    root, top_paths = _tree(tops, "struct<grp:string>", tier)
    found = root.first()  # the one root of the one tree
    above = settle(top_paths.select(F.col("own.grp").alias("t_g"), F.col("digest").alias("subroot"), F.col("path").alias("top_path")))
    return paths.join(above, F.col("g").eqNullSafe(F.col("t_g"))).select(
        F.col("own.id").alias("doc_id"), F.col("g").alias("grp"), "rank", F.col("digest").alias("leaf"), "subroot",
        F.lit(found["digest"] if found else None).cast("string").alias("root"), "path", "top_path",
        *[F.col(f"own.c{i}").alias(name) for i, (name, _) in enumerate(carry)])
